"""The newest record of every name as a view over deltas.

A batch adds a file with its own records and nothing else.  A reader takes the base and the deltas behind it and keeps the newest record
of each name.  Now and then the deltas are merged into a new base.  ``switches`` says which base and which deltas count; its
newest row goes in last, as one file, so a reader sees a delta or a base either whole or not at all, and a writer that was
stopped has changed nothing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codestrata.operators.skew import first_rows
from codestrata.schemas import struct

#: deltas behind a base before they are merged into the next one
DELTAS = 16
SWITCH = struct(number=T.LongType(), base=T.LongType(), deltas=T.ArrayType(T.LongType()))


class NewestView:
    """The newest row of each of ``names`` by ``order`` (largest last), under ``path``.  Versions of deltas are given by the writer; one
    that is written again replaces itself."""

    def __init__(self, spark: SparkSession, path: str, names: list[str], order: list[str], deltas: int = DELTAS):
        self.spark, self.path, self.names, self.order, self.deltas = spark, path.rstrip("/"), names, order, deltas

    def switch(self) -> tuple[int, int, list[int]]:
        """Number of the newest switch, its base (-1: none) and its deltas, ascending."""
        files, folder = self._folder("switches")
        if not files.exists(folder):
            return 0, -1, []
        last = self.spark.read.schema(SWITCH).parquet(f"{self.path}/switches").orderBy(F.desc("number")).first()
        return (last.number, last.base, last.deltas) if last else (0, -1, [])

    def append(self, rows: DataFrame, version: int) -> None:
        """Adds ``rows`` as delta ``version``.  A version that is part of the base already is a batch that is played again: its rows
        are there."""
        number, base, deltas = self.switch()
        if version <= base:
            return
        rows.write.mode("overwrite").parquet(f"{self.path}/deltas/version={version}")
        self._turn(number + 1, base, sorted({*deltas, version}))
        if len(deltas) >= self.deltas:
            self.compact()

    def compact(self) -> None:
        """Merges the deltas into a new base, beside the old one, and then switches to it."""
        number, base, deltas = self.switch()
        if deltas:
            self.read().write.mode("overwrite").parquet(f"{self.path}/bases/version={deltas[-1]}")
            self._turn(number + 1, deltas[-1], [])

    def read(self) -> DataFrame:
        """The newest row of each name."""
        _, base, deltas = self.switch()
        parts = [f"{self.path}/deltas/version={v}" for v in deltas] + ([f"{self.path}/bases/version={base}"] if base >= 0 else [])
        if not parts:
            raise FileNotFoundError(f"no view under {self.path}")
        rows = self.spark.read.parquet(parts[0])
        for part in parts[1:]:
            rows = rows.unionByName(self.spark.read.parquet(part), allowMissingColumns=True)
        return first_rows(rows, self.names, [F.col(c).desc() for c in self.order], 1, "_rank").drop("_rank")

    def clean(self) -> None:
        """Removes what no switch names any more: after the readers of older ones are done."""
        _, base, deltas = self.switch()
        for name, keep in (("deltas", deltas), ("bases", [base])):
            files, folder = self._folder(name)
            if files.exists(folder):
                for status in files.listStatus(folder):
                    if int(status.getPath().getName().removeprefix("version=")) not in keep:
                        files.delete(status.getPath(), True)

    def _turn(self, number: int, base: int, deltas: list[int]) -> None:
        row = self.spark.createDataFrame([(number, base, deltas)], SWITCH)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/switches")

    def _folder(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path


def files_view(spark: SparkSession, path: str, **more) -> NewestView:
    """Newest file records, as of :func:`codestrata.operators.latest.latest_artifact_per_file`."""
    return NewestView(spark, f"{path}/files", ["repo_id", "file_path"], ["run_at", "commit_sha"], **more)


def repos_view(spark: SparkSession, path: str, **more) -> NewestView:
    """Newest repository records: the header of the merged view."""
    return NewestView(spark, f"{path}/repos", ["repo_id"], ["run_at", "commit_sha"], **more)
