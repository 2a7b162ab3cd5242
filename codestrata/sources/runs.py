"""Runs on storage.

A run is written under its own number, and no reader sees it before its number is published, which is the last thing
written.  Its manifest stands there from the start: a run that was stopped shows as ``running`` and is taken up again.

Layout: ``manifest/run=N/phase=...`` (a row for each snapshot, ``running`` first, then as it ended), ``files``, ``repos`` and the
long tables by ``run=N``, files and repositories also by ``repo_id`` and ``commit_sha``, and ``published``, one row a run."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codestrata.functions.paths import artifact_name
from codestrata.operators.skew import join_listed
from codestrata.plans.collection import Collection
from codestrata.plans.facts import with_content
from codestrata.schemas import FILE, KEY, struct
from codestrata.sources.stored import only_named

#: tables by repository and commit; the others have no text or few rows
RECORDS = ["files", "repos"]
LONG_TABLES = ["edges", "entries", "errors", "rejects", "parts"]
RUN = T.StructField("run", T.LongType())
PUBLISHED = struct(number=T.LongType())


class RunStore:
    """All runs under ``path``.  One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # writing

    def begin(self, result: Collection, started_at: Column | None = None) -> int:
        """Writes the manifest rows as ``running`` and returns the run's number."""
        number = max([0, *self._numbers("manifest")]) + 1
        rows = result.running if started_at is None else result.running.withColumn("started_at", started_at)
        self._put(rows, "manifest", number, phase="running")
        return number

    def write(self, result: Collection, number: int, contents: DataFrame | None = None) -> None:
        """Writes the run's tables, the file records with their text if ``contents`` are given.  May be repeated."""
        files = result.files
        if contents is not None:
            names = files.select(*KEY, F.col("file_path").alias("path"))
            files = with_content(files, only_named(contents, names, FILE))
        for name, table in {"files": files, "repos": result.repos}.items():
            self._put(table, name, number, by=KEY)
        for name in LONG_TABLES:
            self._put(getattr(result, name), name, number)
        self._put(result.runs, "manifest", number, phase="final")

    def publish(self, number: int) -> None:
        """The switch: one row in one file, written once."""
        if number not in self.published():
            self.spark.createDataFrame([(number,)], PUBLISHED).coalesce(1).write.mode("append").parquet(f"{self.path}/published")

    def store(self, result: Collection, contents: DataFrame | None = None) -> int:
        """A whole run, from its ``running`` manifest to its publication."""
        number = self.begin(result)
        self.write(result, number, contents)
        self.publish(number)
        return number

    def resume(self, number: int, result: Collection, contents: DataFrame | None = None) -> None:
        """Takes up a run that was left open; what it wrote before is written over."""
        if number not in self.open_runs():
            raise ValueError(f"run {number} is not open")
        self.write(result, number, contents)
        self.publish(number)

    # reading

    def published(self) -> list[int]:
        """Numbers of the published runs: one number a run."""
        if not self._there("published"):
            return []
        return sorted(r.number for r in self.spark.read.schema(PUBLISHED).parquet(f"{self.path}/published").distinct().collect())

    def open_runs(self) -> list[int]:
        """Runs that began and were never published."""
        return sorted(set(self._numbers("manifest")) - set(self.published()))

    def manifest(self) -> DataFrame:
        """Every run's manifest as it stands: final rows of published runs, ``running`` ones of the others."""
        rows = self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/manifest").withColumn("run", F.col("run").cast("long"))
        done = F.col("run").isin(self.published())
        return rows.where((done & (F.col("phase") == "final")) | (~done & (F.col("phase") == "running"))).drop("phase")

    def table(self, name: str) -> DataFrame:
        """Rows of all published runs, with ``run``."""
        rows = self.spark.read.schema(self._schema(name)).parquet(f"{self.path}/{name}")
        return rows.where(F.col("run").isin(self.published()))

    def newest(self, name: str) -> DataFrame:
        """Of every snapshot the rows of the newest run that has it."""
        runs = self.manifest().where(F.col("run").isin(self.published())).groupBy(*KEY).agg(F.max("run").alias("run"))
        return join_listed(self.table(name), runs, [*KEY, "run"], "left_semi").drop("run")

    def load(self, repo_id: str, commit_sha: str) -> tuple[DataFrame, DataFrame]:
        """Repository record and file records of the newest run of one snapshot, files in the order of their artifact names.  The commit may be
        given by its start.  ``FileNotFoundError`` if there is none, ``ValueError`` if the start is that of several."""
        runs = self.manifest().where(F.col("run").isin(self.published()) & (F.col("repo_id") == repo_id) & F.startswith("commit_sha", F.lit(commit_sha)))
        found = runs.groupBy("commit_sha").agg(F.max("run").alias("run")).limit(2).collect()
        if not found:
            raise FileNotFoundError(f"no records for {repo_id} @ {commit_sha}")
        if len(found) > 1:
            raise ValueError(f"several commits of {repo_id} start with {commit_sha}")
        at = (F.col("run") == found[0].run) & (F.col("repo_id") == repo_id) & (F.col("commit_sha") == found[0].commit_sha)
        repos, files = (self.table(name).where(at).drop("run") for name in ("repos", "files"))
        return repos, files.orderBy(artifact_name(F.col("file_path")))

    # folders

    def _put(self, table: DataFrame, name: str, number: int, by: list[str] | None = None, phase: str | None = None) -> None:
        folder = f"{self.path}/{name}/run={number}" + (f"/phase={phase}" if phase else "")
        writer = (table.hint("rebalance", *by) if by else table).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(folder)

    def _folder(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _there(self, name: str) -> bool:
        files, path = self._folder(name)
        return files.exists(path)

    def _numbers(self, name: str) -> list[int]:
        """Runs that have a folder in ``name``."""
        files, path = self._folder(name)
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return [int(n.removeprefix("run=")) for n in names if n.startswith("run=")]

    def _schema(self, name: str) -> T.StructType:
        """The schema of the newest run's files; folder names are texts, and not numbers where a commit looks like one."""
        newest = max(self.published())
        inner = self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.path}/{name}/run={newest}").schema
        keys = [T.StructField(c, T.StringType()) for c in KEY if c not in inner.names]
        return T.StructType([*inner.fields, *keys, RUN])
