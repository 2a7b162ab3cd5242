"""Session settings and written intermediates."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Run-time settings the engine relies on.  Time texts are rendered in UTC; the
    rest are Spark's own means against skewed and badly sized partitions."""
    for name, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }.items():
        spark.conf.set(name, value)
    return spark


def workspace(spark: SparkSession) -> str:
    """Shared folder for intermediates: the cluster's ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a folder of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="codestrata-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def unsent(table: DataFrame) -> DataFrame:
    """``table``, which grows with the input, to be joined by sorting both sides.  Spark would go by its compressed size and send it to every
    task through the driver, which holds it unpacked: 700,000 rows of 10 MB take 200 MB there, for every such join of a query."""
    return table.hint("merge")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.  Cuts the lineage, so
    a lost executor costs a re-read and not a second pass over file contents;
    Parquet keeps column pruning and real sizes for later joins."""
    spark = df.sparkSession
    run = spark.sparkContext.applicationId  # one folder per application, to be removed after it
    path = f"{workspace(spark)}/codestrata/{run}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
