"""The one pass over file contents.

Map-only: each content row becomes a narrow row (metrics, blob id, import texts, README
structure).  Content itself is never shuffled; everything later works on the narrow rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.functions import imports as I
from codestrata.functions import paths as P
from codestrata.functions import readme as R
from codestrata.functions import text as X
from codestrata.schemas import FILE


def with_content_metrics(files: DataFrame) -> DataFrame:
    content = F.coalesce(F.col("content"), F.lit(""))
    return files.select(
        "*",
        X.line_count(content).alias("line_count"),
        F.length(content).alias("char_count"),
        F.octet_length(content).alias("content_bytes"),
    )


def with_raw_imports(files: DataFrame) -> DataFrame:
    """Adds ``language`` and ``imports_raw``."""
    content = F.coalesce(F.col("content"), F.lit(""))
    return files.withColumn("language", P.language(F.col("path"))).withColumn(
        "imports_raw", I.raw_imports(content, F.col("language"))
    )


def with_imports(files: DataFrame, package: str | None = None) -> DataFrame:
    """Adds ``language`` and the ``imports`` struct.  ``package`` names a column."""
    own = F.col(package) if package else None
    length = F.length(F.coalesce(F.col("content"), F.lit("")))
    return with_raw_imports(files).withColumn(
        "imports", I.import_struct(F.col("imports_raw"), length, F.col("language"), own)
    ).drop("imports_raw")


def readme_rows(contents: DataFrame) -> DataFrame:
    """README files with their ``structure``.  Unreadable or empty ones have none of it."""
    rows = contents.where(P.is_readme(F.col("path"))).select(
        *FILE, F.coalesce("content", F.lit("")).alias("content")
    )
    return rows.select(*FILE, "content", R.headers(F.col("content")).alias("headers")).select(
        *FILE, R.structure(F.col("content"), F.col("headers")).alias("structure")
    )


def parse_contents(contents: DataFrame) -> DataFrame:
    """Narrow rows of all collectable files and READMEs."""
    readme = P.is_readme(F.col("path"))
    wanted = contents.where(P.is_collectable(F.col("path")) | readme)
    metrics = with_content_metrics(with_raw_imports(wanted))
    headers = F.when(readme, R.headers(F.coalesce(F.col("content"), F.lit("")))).otherwise(
        X.empty_strings()
    )
    return metrics.select(
        *FILE,
        "blob_sha",
        "language",
        "line_count",
        "char_count",
        "content_bytes",
        "imports_raw",
        headers.alias("readme_headers"),
    )
