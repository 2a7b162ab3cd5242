"""Commit history: horizon, latest commit, frequencies, contributors.

Input is the ``commits`` table, one row per commit and file.  List order is semantic:
``ordinal`` is the position in the source (smaller = more recent)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.functions.times import days_between, minus_days
from codestrata.operators.skew import first_rows
from codestrata.schemas import FILE
from codestrata.session import unsent


def commit_order() -> Column:
    return F.struct("ordinal", "sha")


def commit_horizon(
    commits: DataFrame, as_of: Column, days: int = C.HISTORY_DAYS, newest: int | None = None
) -> DataFrame:
    """Commits of the last ``days`` days; with ``newest``, at most that many per file (what a
    local log returns).  A commit whose time cannot be read stays: its source listed it, and it
    makes the file fail later on."""
    moment = F.col("committed_at")
    kept = commits.where(moment.isNull() | (moment >= minus_days(as_of, days)))
    if newest is None:
        return kept
    order = [F.col("ordinal").asc(), F.col("sha").asc()]
    return first_rows(kept, FILE, order, newest, "_rank").drop("_rank")


def latest_commit(commits: DataFrame) -> DataFrame:
    """First commit in list order, per file."""
    row = F.struct("sha", "committed_at", "timestamp_raw", "author_name", "message")
    return (
        commits.groupBy(*FILE)
        .agg(F.min_by(row, commit_order()).alias("latest"))
        .select(
            *FILE,
            F.col("latest.sha").alias("most_recent_commit_sha"),
            F.col("latest.committed_at").alias("most_recent_commit_timestamp"),
            F.col("latest.timestamp_raw").alias("most_recent_commit_timestamp_raw"),
            F.col("latest.author_name").alias("most_recent_commit_author"),
            F.col("latest.message").alias("most_recent_commit_message"),
        )
    )


def commit_frequency(commits: DataFrame, as_of: Column) -> DataFrame:
    """Commits in the horizon and in the last 30 days, per file."""
    recent = F.col("committed_at") >= minus_days(as_of, C.RECENT_DAYS)
    return commits.groupBy(*FILE).agg(
        F.count(F.lit(1)).alias("commit_frequency_90d"),
        F.count_if(recent).alias("commit_frequency_30d"),
    )


def author_activity(commits: DataFrame, as_of: Column) -> DataFrame:
    """Commits per file and author: all counts, and the author's most recent commit.  Far
    smaller than the commits, and enough for every commit field."""
    row = F.struct("sha", "committed_at", "timestamp_raw", "author_name", "message")
    recent = F.col("committed_at") >= minus_days(as_of, C.RECENT_DAYS)
    unreadable = F.when(F.col("committed_at").isNull(), F.struct("ordinal", "timestamp_raw"))
    return commits.groupBy(*FILE, "author_name").agg(
        F.count(F.lit(1)).alias("n_commits"),
        F.count_if(recent).alias("n_recent"),
        F.min(commit_order()).alias("first_seen"),
        F.min_by(row, commit_order()).alias("latest"),
        F.min(unreadable).alias("unreadable"),
    )


def ranked_contributors(activity: DataFrame, n: int = C.TOP_CONTRIBUTORS) -> DataFrame:
    """The ``n`` authors with most commits per file; ties go to the one seen first."""
    order = [F.col("n_commits").desc(), F.col("first_seen").asc()]
    rows = activity.select(*FILE, "author_name", "n_commits", "first_seen")
    return first_rows(rows, FILE, order, n).drop("first_seen")


def top_contributors(activity: DataFrame, n: int = C.TOP_CONTRIBUTORS) -> DataFrame:
    """Contributor names, most commits first, as one short array per file."""
    ranked = ranked_contributors(activity, n)
    pairs = F.array_sort(F.collect_list(F.struct("rank", "author_name")))
    return ranked.groupBy(*FILE).agg(
        F.transform(pairs, lambda p: p["author_name"]).alias("top_contributors")
    )


def file_history(activity: DataFrame, as_of: Column) -> DataFrame:
    """All commit fields per file, from :func:`author_activity`."""
    totals = activity.groupBy(*FILE).agg(
        F.min_by("latest", "first_seen").alias("latest"),
        F.sum("n_commits").alias("commit_frequency_90d"),
        F.sum("n_recent").alias("commit_frequency_30d"),
        F.min("unreadable").alias("unreadable"),
    )
    return totals.join(unsent(top_contributors(activity)), FILE, "left").select(
        *FILE,
        F.col("latest.sha").alias("most_recent_commit_sha"),
        F.col("latest.committed_at").alias("most_recent_commit_timestamp"),
        F.col("latest.timestamp_raw").alias("most_recent_commit_timestamp_raw"),
        F.col("latest.author_name").alias("most_recent_commit_author"),
        F.col("latest.message").alias("most_recent_commit_message"),
        "commit_frequency_90d",
        "commit_frequency_30d",
        days_between(F.col("latest.committed_at"), as_of).alias("days_since_last_change"),
        "top_contributors",
        F.col("unreadable.timestamp_raw").alias("unreadable_commit_time"),
    )
