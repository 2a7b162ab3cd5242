"""Collection on commit triggers, as a stream.

Each trigger names a commit and its parent.  A micro-batch turns all its triggers into one set of
target files and runs one collection over them.  Results are written under the batch's own
partition, so a replayed batch overwrites itself; a commit that an earlier batch has
collected is left out.  If the collection fails, the batch's repositories are halved until those that fail stand alone: they
are set aside with their error, and the others are collected."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codestrata import schemas as S
from codestrata.functions import paths as P
from codestrata.operators import selection as L
from codestrata.operators.latest import latest_artifact_per_file
from codestrata.operators.skew import join_listed
from codestrata.plans.collection import Collection, collect_snapshots
from codestrata.schemas import FILE, KEY
from codestrata.session import materialize
from codestrata.sources.stored import pruned
from codestrata.streaming.newest import files_view, repos_view

REPO_BUCKETS = 64
FILE_BUCKETS = 16


@dataclass
class Tables:
    """Landed tables the triggers refer to; ``tree`` holds parents as well as heads."""

    tree: DataFrame
    contents: DataFrame
    commits: DataFrame


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_triggers(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Triggers landed as JSON lines."""
    reader = spark.readStream.schema(S.COMMIT_TRIGGER)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def with_mode(
    heads: DataFrame, earlier_runs: DataFrame | None, force_full: bool = False
) -> DataFrame:
    """``full`` for a commit without a parent and for the oldest commit of a repository seen
    for the first time, else ``incremental``.  Order is commit time, not arrival."""
    if force_full:
        return heads.withColumn("mode", F.lit("full"))
    known = heads.select("repo_id").where("false") if earlier_runs is None else earlier_runs
    by_time = F.struct("committed_at", "commit_sha")
    oldest = heads.groupBy("repo_id").agg(F.min_by("commit_sha", by_time).alias("commit_sha"))
    marked = heads.join(oldest.withColumn("_oldest", F.lit(True)), KEY, "left")
    full = F.col("parent_sha").isNull() | ((F.col("mode") == "full") & F.col("_oldest").isNotNull())
    mode = F.when(full, F.lit("full")).otherwise(F.lit("incremental"))
    return L.collection_mode(marked, known).withColumn("mode", mode).drop("_oldest")


def targets_of(heads: DataFrame, tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trees of the heads, and the files to collect: all of a full run's tree, the changed
    collectable names of an incremental one.  ``heads`` is a stored table."""
    head_tree = materialize(join_listed(tree, heads.select(*KEY, "mode"), KEY), "head_tree")
    parents = heads.where("mode = 'incremental'").select("repo_id", "parent_sha", "commit_sha")
    parent_rows = tree.select("repo_id", F.col("commit_sha").alias("parent_sha"), "path", "sha")
    parent_tree = join_listed(parent_rows, parents, ["repo_id", "parent_sha"])
    changed = L.changed_files(parent_tree, head_tree.where("mode = 'incremental'"), FILE)
    touched = changed.where(P.is_collectable(F.col("path"))).select(*FILE)
    return head_tree, head_tree.where("mode = 'full'").select(*FILE).unionByName(touched)


def one_each(triggers: DataFrame) -> DataFrame:
    """One trigger for each commit: of several the earliest, then the smallest parent and branch.  The same
    one whenever a batch is played."""
    others = [c for c in ("committed_at", "parent_sha", "branch") if c in triggers.columns]
    rest = [c for c in triggers.columns if c not in KEY]
    order = F.struct(*[F.col(c) for c in others], *[F.col(c) for c in rest if c not in others])
    first = triggers.groupBy(*KEY).agg(F.min_by(F.struct(*rest), order).alias("_t"))
    return first.select(*[F.col(c) if c in KEY else F.col(f"_t.{c}").alias(c) for c in triggers.columns])


def collect_batch(
    triggers: DataFrame,
    tables: Tables,
    earlier_runs: DataFrame | None,
    as_of: Column | None = None,
    force_full: bool = False,
) -> Collection | None:
    """One collection over all commits of a batch, or None if no source file changed."""
    heads = one_each(triggers)
    if earlier_runs is not None:
        heads = heads.join(earlier_runs.select(*KEY), KEY, "left_anti")
    heads = materialize(with_mode(heads, earlier_runs, force_full), "heads")
    head_tree, targets = targets_of(heads, pruned(tables.tree, heads))
    targets = materialize(targets, "targets")
    busy = heads.join(targets.select(*KEY).distinct(), KEY, "left_semi")
    newest = busy.agg(F.unix_micros(F.max("committed_at"))).first()[0]
    if newest is None:
        return None
    if as_of is None:
        as_of = F.timestamp_micros(F.lit(newest))  # no clock: a replay gives the same records
    return collect_snapshots(
        busy, head_tree.drop("mode"), tables.contents, tables.commits, as_of, "local", targets
    )


#: what a batch stores of a collection; the run table goes last
STORED = ["files", "repos", "edges", "entries", "errors", "rejects", "parts", "runs"]


def collect_apart(
    triggers: DataFrame, tables: Tables, earlier_runs: DataFrame | None, as_of: Column | None, force_full: bool
) -> tuple[list[dict[str, DataFrame]], list[tuple[DataFrame, str]]]:
    """Tables of the collections of a batch, written aside, and the triggers of the repositories that fail, with their error.
    ``triggers`` is a stored table.  All in one collection if that works; else each half of the repositories, and so on: a few
    that fail cost some collections each, however many others there are."""
    try:
        result = collect_batch(triggers, tables, earlier_runs, as_of, force_full)
        if result is None:
            return [], []
        return [{name: materialize(getattr(result, name), name) for name in STORED}], []
    except PySparkException as e:
        names = triggers.select(F.xxhash64("repo_id").alias("h")).distinct()
        middle, n = names.agg(F.percentile("h", 0.5), F.count(F.lit(1))).first()
        if n < 2:
            return [], [(triggers, str(e).split("JVM stacktrace")[0][:2000])]
        parts = [triggers.where(F.xxhash64("repo_id") <= F.lit(middle)), triggers.where(F.xxhash64("repo_id") > F.lit(middle))]
        halves = [collect_apart(p, tables, earlier_runs, as_of, force_full) for p in parts]
        return sum([h[0] for h in halves], []), sum([h[1] for h in halves], [])


def set_aside(triggers: DataFrame, error: str) -> DataFrame:
    return triggers.withColumn("error", F.lit(error))


def store_batch(result: Collection, heads: DataFrame, path: str, batch_id: int) -> None:
    """Writes the batch's partition of every table; records carry ``run_at``, the commit time."""
    store_tables([{name: getattr(result, name) for name in STORED}], heads, path, batch_id)


def store_tables(found: list[dict[str, DataFrame]], heads: DataFrame, path: str, batch_id: int) -> None:
    run_at = materialize(one_each(heads).select(*KEY, F.col("committed_at").alias("run_at")), "run_at")
    for name in STORED:
        table = found[0][name]
        for other in found[1:]:
            table = table.unionByName(other[name])
        write_batch(join_listed(table, run_at, KEY, "left"), f"{path}/{name}", batch_id)


def write_batch(table: DataFrame, path: str, batch_id: int) -> None:
    (
        table.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def start_collection_stream(
    triggers: DataFrame,
    tables: Tables,
    path: str,
    checkpoint: str,
    as_of: Column | None = None,
    latest_path: str | None = None,
    available_now: bool = True,
    force_full: bool = False,
    view_path: str | None = None,
) -> StreamingQuery:
    """Collects each arriving commit into the tables under ``path``; with ``latest_path`` the newest record of every file
    is kept there as a table of its own, with ``view_path`` as a view that a batch adds only its change to (see
    :mod:`codestrata.streaming.newest`), beside the newest repository records.  ``force_full`` collects whole trees whatever changed.
    Triggers of repositories that fail are in ``set_aside``; landed again, they are tried again."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = materialize(batch, "triggers")
        done = read_or_none(spark, f"{path}/runs")
        if done is not None:
            done = done.where(F.col("batch_id") < batch_id)
        usable, unusable = L.split_heads(batch)
        if not unusable.isEmpty():  # a trigger without a commit stops nobody else's
            write_batch(unusable, f"{path}/rejected_triggers", batch_id)
        # a commit that stands here and not in the runs is under way, or was stopped
        write_batch(one_each(usable).withColumn("status", F.lit("running")), f"{path}/started", batch_id)
        found, failed = collect_apart(materialize(usable, "usable"), tables, done, as_of, force_full)
        if failed:
            rows = [set_aside(*f) for f in failed]
            for other in rows[1:]:
                rows[0] = rows[0].unionByName(other)
            write_batch(rows[0], f"{path}/set_aside", batch_id)
        if not found:
            return
        # the run table goes last: a run that stands there has all its records
        store_tables(found, usable, path, batch_id)
        written = lambda name: spark.read.parquet(f"{path}/{name}").where(F.col("batch_id") == batch_id).drop("batch_id")
        if latest_path is not None:
            upsert_latest(written("files"), latest_path)
        if view_path is not None:
            files_view(spark, view_path).append(written("files"), batch_id)
            repos_view(spark, view_path).append(written("repos"), batch_id)

    writer = triggers.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def upsert_latest(
    records: DataFrame, path: str, repo_buckets: int = REPO_BUCKETS, file_buckets: int = FILE_BUCKETS
) -> None:
    """Keeps the newest record per ``(repo_id, file_path)`` under ``path``.  The table is split by
    hashes of both, so a batch rewrites only the parts it touches and a large repository is
    spread over several."""
    spark = records.sparkSession
    parts = ["repo_bucket", "file_bucket"]
    new = records.withColumns(
        {
            "repo_bucket": F.pmod(F.xxhash64("repo_id"), F.lit(repo_buckets)).cast("int"),
            "file_bucket": F.pmod(F.xxhash64("file_path"), F.lit(file_buckets)).cast("int"),
        }
    )
    old = read_or_none(spark, path)
    if old is not None:
        # at most repo_buckets x file_buckets rows
        touched = new.select(*parts).distinct()
        new = old.join(F.broadcast(touched), parts, "left_semi").unionByName(new)
    # written aside first: the table cannot be read and overwritten in one job
    merged = materialize(latest_artifact_per_file(new), "latest")
    (
        merged.hint("rebalance", *parts)  # splits the parts of a large repository
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )
