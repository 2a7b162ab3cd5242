"""Query registry: name -> (Spark query, check SQL)."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codestrata.catalog.oracle import with_parts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None, extra: dict[str, str] | None = None):
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_parts(sql, extra)
        return fn

    return add


def _plain(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.array_join(column, "|")
    if isinstance(kind, T.MapType):
        pairs = F.transform(
            F.array_sort(F.map_entries(column)),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
        )
        return F.array_join(pairs, "|")
    return column


def plain(df: DataFrame) -> DataFrame:
    """Arrays and maps as texts, so that both engines hand the comparison the same values."""
    return df.select(*[_plain(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
