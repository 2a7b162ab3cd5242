"""Full and incremental collection over many snapshots at once."""

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.functions import paths as P
from codestrata.operators import history as H
from codestrata.operators import resolve as R
from codestrata.operators import selection as L
from codestrata.operators import structure as S
from codestrata.operators import validate as V
from codestrata.operators.skew import PART_ROWS, join_hot, join_listed
from codestrata.plans import facts as B
from codestrata.plans.parse import parse_contents
from codestrata.schemas import FILE, KEY, PARTS
from codestrata.session import materialize
from codestrata.sources.stored import only_named


class Collection:
    """Result tables of one collection.  Lists inside the records hold up to ``part_rows`` entries; where a list is longer, its
    length stands beside it and ``parts`` goes on with it.  Repository records are put together when they are
    first asked for."""

    def __init__(self, snapshots, tree, parsed, fetched, edges, records, skipped, as_of, mode, run_mode, more, part_rows):
        self._more, self._part_rows = more, part_rows
        self._snapshots, self._tree, self._parsed, self._fetched = snapshots, tree, parsed, fetched
        self._skipped, self._as_of, self._run_mode = skipped, as_of, run_mode
        self._emptied = None
        if mode == "local":
            empty = F.col("content_bytes") < C.MIN_FILE_BYTES
            self._emptied = records.where(empty)
            records = records.where(~empty)
        # one unreadable commit time fails the file, before it is validated
        unread = F.col("unreadable_commit_time")
        broken = records.where(unread.isNotNull()).select("*", V.unreadable_time_text(unread).alias("error"))
        checked = V.validate_files(records.where(unread.isNull()))
        invalid = checked.where(~F.col("is_valid")).withColumn("error", V.failure_text())
        hard = broken.select("*", F.array("error").alias("issues"), F.lit(False).alias("is_valid"))
        inner = ["content_bytes", "unreadable_commit_time"]
        #: (key, path, import, target)
        self.edges: DataFrame = edges
        #: valid file records
        self.files: DataFrame = checked.where(F.col("is_valid")).drop("issues", "is_valid", *inner)
        #: files that failed, with their issues and the error line
        self.rejects: DataFrame = invalid.unionByName(hard).drop(*inner)
        #: (key, error)
        self.errors: DataFrame = self.rejects.select(*KEY, "error")

    @cached_property
    def entries(self) -> DataFrame:
        """(key, kind, entry): every list and map of the repository records, in long form."""
        skipped = self._skipped.select(*KEY, "skip_reason")
        if self._emptied is not None:
            reason = F.lit("empty_file").alias("skip_reason")
            skipped = skipped.unionByName(self._emptied.select(*KEY, reason))
        counts = S.skip_reason_counts(skipped)
        return materialize(B.repo_entries(self._tree, self.files, counts, self.errors), "entries")

    @cached_property
    def _lists(self) -> tuple[DataFrame, DataFrame | None]:
        return B.repo_lists(self.entries, self._part_rows)

    @cached_property
    def repos(self) -> DataFrame:
        """Repository records."""
        record = B.repo_facts(
            self._snapshots, self._tree, self._parsed, self.files, self.entries, self._lists[0], self._as_of
        )
        return materialize(record, "repos")

    @cached_property
    def parts(self) -> DataFrame:
        """(key, path, kind, part, first, last, n, items): the lists' entries behind those in the records, in sorted parts of at
        most ``part_rows``, numbered from 1.  ``path`` is null for lists of the repository record."""
        found = self.entries.sparkSession.createDataFrame([], PARTS)
        if self._more is not None:
            found = found.unionByName(B.more_dependents(self._more))
        if self._lists[1] is not None:
            found = found.unionByName(self._lists[1])
        return found

    @cached_property
    def attempted(self) -> DataFrame:
        return self._fetched.groupBy(*KEY).agg(F.count(F.lit(1)).alias("files_attempted"))

    @cached_property
    def runs(self) -> DataFrame:
        """One manifest row per snapshot."""
        runs = run_records(self.repos, self.attempted, self._as_of, self._run_mode)
        if "mode" in self._snapshots.columns:
            runs = runs.drop("mode").join(self._snapshots.select(*KEY, "mode"), KEY, "left")
        return runs

    @cached_property
    def running(self) -> DataFrame:
        """The manifest rows while the run is under way."""
        return running_records(self._snapshots, self.attempted, self._as_of, self._run_mode)


def select_files(
    tree: DataFrame, targets: DataFrame | None = None, max_files: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Source rows to collect, and the skipped rows with their reason."""
    flagged = L.with_skip_reason(tree) if targets is None else L.target_files(targets, tree)
    chosen = flagged.where(F.col("skip_reason").isNull()).drop("skip_reason")
    skipped = flagged.where(F.col("skip_reason").isNotNull())
    return L.cap_files(chosen, max_files), skipped


def collect_snapshots(
    snapshots: DataFrame,
    tree: DataFrame,
    contents: DataFrame,
    commits: DataFrame,
    as_of: Column,
    mode: str = "local",
    targets: DataFrame | None = None,
    max_files: int | None = None,
    part_rows: int = PART_ROWS,
) -> Collection:
    """``mode='api'``: resolution among the fetched files, own package unknown, empty files
    fail validation.  ``mode='local'``: resolution over the whole tree, own package known,
    empty files are skipped, histories hold at most 50 commits.  With ``targets`` (changed names)
    only those files are collected, in the context of the whole tree.  ``snapshots`` may carry
    the ``mode`` to note on each run.  ``tree``, ``contents`` and ``commits`` may be stored by bucket (see
    :mod:`codestrata.sources.stored`): then only the buckets of wanted files are read."""
    if targets is not None:
        # the trees of the snapshots with a target only
        tree = join_listed(tree, materialize(targets.select(*KEY).distinct(), "touched"), KEY, "left_semi")
    # select first: contents of files that are skipped, capped or not changed are not parsed
    selected, skipped = select_files(tree, targets, max_files)
    selected = materialize(selected.select(*FILE, "sha", "size"), "selected")
    readmes = S.first_readme(tree).withColumnRenamed("readme_path", "path")
    wanted = materialize(selected.select(*FILE).unionByName(readmes.select(*FILE)), "wanted")
    # content is read once, without a shuffle; everything below uses the narrow rows
    parsed = materialize(parse_contents(only_named(contents, wanted)), "parsed")
    fetched = materialize(B.classified(B.fetch(selected, parsed), tree, mode), "fetched")
    scope = R.resolution_scope(tree, fetched, mode)
    edges = materialize(R.resolve_imports(fetched, scope), "edges")

    newest = C.LOG_COMMITS_PER_FILE if mode == "local" else None
    if targets is not None:
        # few files: drop the other histories first (a full run joins only the aggregates).  Written, as their files are
        # counted before they are joined, and what makes the commits would be done for both
        named = materialize(only_named(commits, wanted), "commits")
        commits = join_hot(named, selected.select(*FILE), FILE, "left_semi")
    horizon = H.commit_horizon(commits, as_of, newest=newest)
    activity = materialize(H.author_activity(horizon, as_of), "activity")
    history = H.file_history(activity, as_of)
    dependents, more = R.dependent_lists(edges, part_rows)
    records = materialize(B.file_facts(fetched, edges, dependents, history, as_of), "records")
    run_mode = "full" if targets is None else "incremental"
    return Collection(
        snapshots, tree, parsed, fetched, edges, records, skipped, as_of, mode, run_mode, more, part_rows
    )


def running_records(snapshots: DataFrame, attempted: DataFrame, as_of: Column, run_mode: str) -> DataFrame:
    """Manifest rows as they stand while a run is under way."""
    zero = F.lit(0).cast("bigint")
    return snapshots.join(attempted, KEY, "left").select(
        *KEY,
        "branch",
        P.run_name(F.col("repo_id"), F.col("branch"), F.col("commit_sha")).alias("run_name"),
        as_of.alias("started_at"),
        F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit("running").alias("status"),
        F.lit(run_mode).alias("mode"),
        F.coalesce("files_attempted", zero).alias("files_attempted"),
        zero.alias("files_succeeded"),
        zero.alias("files_failed"),
    )


def run_records(
    repos: DataFrame, attempted: DataFrame, as_of: Column, run_mode: str, done_at: Column | None = None
) -> DataFrame:
    """Final manifest row per snapshot: ``complete``, or ``partial`` if any file failed."""
    failed = F.col("n_collection_errors")
    return repos.join(attempted, KEY, "left").select(
        *KEY,
        "branch",
        P.run_name(F.col("repo_id"), F.col("branch"), F.col("commit_sha")).alias("run_name"),
        as_of.alias("started_at"),
        (as_of if done_at is None else done_at).alias("completed_at"),
        F.when(failed == 0, F.lit("complete")).otherwise(F.lit("partial")).alias("status"),
        F.lit(run_mode).alias("mode"),
        F.coalesce("files_attempted", F.lit(0)).alias("files_attempted"),
        F.col("files_collected").alias("files_succeeded"),
        failed.alias("files_failed"),
        "files_skipped",
        "collection_errors",
    )


def run_summary(runs: DataFrame) -> DataFrame:
    return runs.select(
        *KEY,
        "run_name",
        F.col("files_succeeded").alias("files_collected"),
        "files_skipped",
        "files_failed",
        "collection_errors",
    )


def full_collection(snapshots, tree, contents, commits, as_of, mode="local", max_files=None):
    return collect_snapshots(snapshots, tree, contents, commits, as_of, mode, None, max_files)


def incremental_collection(snapshots, tree, contents, commits, targets, as_of):
    """Changed files only.  Repository record and dependents cover the changed files, as
    each run describes what it collected; see ``operators.latest.repo_dependents`` for all."""
    return collect_snapshots(snapshots, tree, contents, commits, as_of, "local", targets)

