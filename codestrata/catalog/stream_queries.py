"""Streams, driven to their end over triggers landed from the given tables.

Every repository has two commits: the first holds all but the Spanish files; the second adds
those, drops the German files and edits the French ones."""

import uuid

from pyspark.sql import functions as F

from codestrata.catalog import fixtures as X
from codestrata.catalog.registry import plain, query
from codestrata.functions.times import instant
from codestrata.streaming.commits import Tables, read_triggers, start_collection_stream
from codestrata.streaming.newest import files_view, repos_view
from codestrata.session import workspace

FIRST, SECOND = "first", "second"


def both(rows, first, second):
    """Rows under the two commits; the conditions pick what each commit holds."""
    return (
        rows.where(first).withColumn("commit_sha", F.lit(FIRST))
        .unionByName(rows.where(second).withColumn("commit_sha", F.lit(SECOND)))
    )


def landed(spark, sf):
    rows = both(X.tree(spark, sf, "lang"), "lang <> 'es'", "lang <> 'de'")
    edited = F.when(F.expr("lang = 'fr' AND commit_sha = 'second'"), F.sha1("sha"))
    tree = rows.withColumn("sha", F.coalesce(edited, "sha")).drop("lang")
    contents = both(X.contents(spark, sf, "lang"), "lang <> 'es'", "lang <> 'de'").drop("lang")
    commits = X.commits(spark, sf).withColumn("commit_sha", F.lit(SECOND))
    return Tables(tree, contents, commits)


def land_triggers(spark, sf, folder):
    """One file of first commits, one of second commits."""
    repos = X.snapshots(spark, sf).select("repo_id").distinct().coalesce(1)
    rows = lambda sha, parent, at: repos.select(
        "repo_id",
        F.lit("main").alias("branch"),
        F.lit(sha).alias("commit_sha"),
        F.lit(parent).cast("string").alias("parent_sha"),
        F.lit(at).alias("committed_at"),
    )
    rows(FIRST, None, "2024-02-09T00:00:00Z").write.mode("append").json(folder)
    rows(SECOND, FIRST, "2024-02-10T00:00:00Z").write.mode("append").json(folder)


def run_stream(spark, sf, files_per_batch=None, latest=False, view=False):
    base = f"{workspace(spark)}/codestrata/stream-{uuid.uuid4().hex}"
    land_triggers(spark, sf, f"{base}/triggers")
    stream = start_collection_stream(
        read_triggers(spark, f"{base}/triggers", files_per_batch),
        landed(spark, sf),
        f"{base}/tables",
        f"{base}/checkpoint",
        as_of=instant(X.AS_OF_30),
        latest_path=f"{base}/latest" if latest else None,
        view_path=f"{base}/view" if view else None,
    )
    stream.awaitTermination()
    return base


EMPTY = "coalesce(strlen(content), 0) < 10"


@query(f"""SELECT repo_id, 'first' AS commit_sha, 'full' AS mode, count(*) FILTER (skip_reason IS NULL) AS files_attempted,
    count(*) FILTER (skip_reason IS NULL AND NOT {EMPTY}) AS files_succeeded,
    count(*) FILTER (skip_reason IS NOT NULL OR {EMPTY}) AS files_skipped
  FROM flags WHERE lang <> 'es' GROUP BY repo_id
  UNION ALL
  SELECT repo_id, 'second', 'incremental', count(*) FILTER (lang <> 'de' AND skip_reason IS NULL),
    count(*) FILTER (lang <> 'de' AND skip_reason IS NULL AND NOT {EMPTY}),
    count(*) FILTER (lang = 'de' OR skip_reason IS NOT NULL OR {EMPTY})
  FROM flags WHERE lang IN ('es', 'de', 'fr') AND coalesce(skip_reason, 'too_large') = 'too_large' GROUP BY repo_id""")
def stream_incremental_collection(spark, sf):
    base = run_stream(spark, sf)
    return spark.read.parquet(f"{base}/tables/runs").select(
        "repo_id", "commit_sha", "mode", "files_attempted", "files_succeeded", "files_skipped"
    )


@query("""SELECT repo_id, file_path, blob_sha, line_count, imports_raw,
    CASE WHEN lang IN ('es', 'fr') THEN 'second' ELSE 'first' END AS commit_sha
  FROM kept JOIN (SELECT repo_id, path AS file_path, lang FROM files) USING (repo_id, file_path)""")
def stream_latest_snapshot(spark, sf):
    """Newest record per file after both commits; deleted files stay with their last record."""
    base = run_stream(spark, sf, latest=True)
    return plain(
        spark.read.parquet(f"{base}/latest").select(
            "repo_id", "file_path", "blob_sha", "line_count", "imports_raw", "commit_sha"
        )
    )


@query("""SELECT repo_id, file_path, blob_sha, line_count, imports_raw,
    CASE WHEN lang IN ('es', 'fr') THEN 'second' ELSE 'first' END AS commit_sha
  FROM kept JOIN (SELECT repo_id, path AS file_path, lang FROM files) USING (repo_id, file_path)""")
def stream_newest_view(spark, sf):
    """As `stream_latest_snapshot`, with one commit of every repository in a batch, from a view over deltas that is merged once."""
    base = run_stream(spark, sf, files_per_batch=1, view=True)
    files_view(spark, f"{base}/view").compact()
    return plain(
        files_view(spark, f"{base}/view").read().select(
            "repo_id", "file_path", "blob_sha", "line_count", "imports_raw", "commit_sha"
        )
    )


@query("""SELECT repo_id, CASE WHEN bool_or(lang IN ('es', 'de', 'fr') AND coalesce(skip_reason, 'too_large') = 'too_large') THEN 'second' ELSE 'first' END AS commit_sha
  FROM flags GROUP BY repo_id""")
def stream_newest_header(spark, sf):
    """The newest repository record of each repository, from the same kind of view."""
    base = run_stream(spark, sf, files_per_batch=1, view=True)
    return repos_view(spark, f"{base}/view").read().select("repo_id", "commit_sha")
