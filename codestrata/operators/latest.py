"""Newest record of every file over many runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.operators.skew import first_rows
from codestrata.session import unsent


def latest_artifact_per_file(records: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """The newest run's record of each ``(repo_id, file_path)``.  Files last seen in an older
    run stay, and content is left out.  ``deleted`` (``repo_id, file_path``) optionally removes
    files that no longer exist."""
    narrow = records.drop("raw_content")
    order = [F.col("run_at").desc(), F.col("commit_sha").desc()]
    newest = first_rows(narrow, ["repo_id", "file_path"], order, 1, "_rank").drop("_rank")
    if deleted is None:
        return newest
    return newest.join(deleted.select("repo_id", "file_path"), ["repo_id", "file_path"], "left_anti")


def latest_edges(edges: DataFrame, newest: DataFrame) -> DataFrame:
    """Import edges of the newest record of each file: the edges of a whole repository, put
    together from several runs."""
    current = newest.select("repo_id", "commit_sha", F.col("file_path").alias("path"))
    return edges.join(unsent(current), ["repo_id", "commit_sha", "path"], "left_semi")


def repo_dependents(edges: DataFrame, newest: DataFrame) -> DataFrame:
    """Dependents over all files of a repository, also those the last run did not touch."""
    return latest_edges(edges, newest).select(
        "repo_id", F.col("target").alias("path"), F.col("path").alias("dependent")
    )


def latest_repo_header(repos: DataFrame) -> DataFrame:
    """The newest run's repository record."""
    order = [F.col("run_at").desc(), F.col("commit_sha").desc()]
    return first_rows(repos, ["repo_id"], order, 1, "_rank").drop("_rank")
