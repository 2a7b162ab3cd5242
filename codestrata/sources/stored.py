"""Landed tables on storage, split by a hash, and reading only what some names need of them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from codestrata.schemas import FILE

#: buckets of a stored table; the partition column is named after their number, so a reader knows it
BUCKETS = 256
BUCKET = "bucket_of_"
#: what says which bucket a row is in
FILE_NAME = ["repo_id", "path"]
REPO_NAME = ["repo_id"]
#: bits that tell wanted names from others: a table of at most 2048 rows of 4 KB
NAME_BITS = 1 << 26


def bucket_of(names: list[str], buckets: int):
    return F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")


def save_by_bucket(rows: DataFrame, path: str, names: list[str] = FILE_NAME, buckets: int = BUCKETS) -> None:
    """``rows`` in one folder per bucket.  ``names``: ``FILE_NAME`` spreads the files of a large repository over all buckets,
    ``REPO_NAME`` keeps a repository together."""
    column = f"{BUCKET}{buckets}_{'_'.join(names)}"
    (
        rows.withColumn(column, bucket_of(names, buckets))
        .hint("rebalance", column)  # splits large buckets, unites small ones in a file each
        .write.mode("overwrite")
        .partitionBy(column)
        .parquet(path)
    )


def read_by_bucket(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The whole table with its bucket column."""
    found = spark.read.parquet(path)
    if schema is None:
        return found
    return found.select(*schema.fieldNames(), *[c for c in found.columns if c.startswith(BUCKET)])


def pruned(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` of the buckets that ``wanted`` needs, if ``rows`` is such a table, without the bucket column.  At most one number a
    bucket comes to the driver."""
    for column in [c for c in rows.columns if c.startswith(BUCKET)]:
        number, _, names = column.removeprefix(BUCKET).partition("_")
        by = next(n for n in (FILE_NAME, REPO_NAME) if "_".join(n) == names)
        needed = [r[0] for r in wanted.select(bucket_of(by, int(number))).distinct().collect()]
        rows = rows.where(F.col(column).isin(needed)).drop(column)
    return rows


def only_named(rows: DataFrame, wanted: DataFrame, on: list[str] = FILE) -> DataFrame:
    """``rows`` whose name may be among ``wanted`` (a stored table), without a shuffle of ``rows``: whole buckets are left out, and the
    others' rows are tested against bits of the wanted names.  The bits have a fixed size, so some
    other rows pass, the more the more names there are; the caller joins the names in any case."""
    place = F.pmod(F.xxhash64(*on), F.lit(NAME_BITS)) + 1
    marks = wanted.select(F.bitmap_bucket_number(place).alias("_words"), F.bitmap_bit_position(place).alias("_bit"))
    marks = marks.groupBy("_words").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    rows = pruned(rows, wanted)
    tested = rows.withColumns({"_words": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
    tested = tested.join(F.broadcast(marks), "_words")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    mask = F.expr("shiftleft(1, cast(_bit % 8 as int))")
    return tested.where(byte.bitwiseAND(mask) != 0).select(*rows.columns)
