"""Helpers shared by the operators: scratch tables and column names that cannot clash."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word in the contracts on plain words.
SPACE = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only a local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="codestrata-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Written intermediates of one run, under the shared folder.  A lost executor costs a
    re-read; a table is removed as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/codestrata-llm/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> None:
    """Arrow batches of few rows and bytes, so that long texts and packed rows cannot fill a Python worker or Spark's buffers for it;
    workers started from now on find this package where the driver has it (else ship it with ``--py-files``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def give_back() -> None:
    """Hands memory that a worker has freed back to the system: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def free_name(name: str, df: DataFrame) -> str:
    """``name``, or with further underscores in front if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(text: str = "text") -> Column:
    """Tells rows apart that share a doc_id.  A null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))
