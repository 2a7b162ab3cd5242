"""Provenance and validation columns.  Issues starting with ``hard:`` reject a record; the
rest are warnings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.functions.text import empty_strings


def _present(*pairs: tuple[Column, Column | str]) -> Column:
    texts = [F.when(cond, F.lit(t) if isinstance(t, str) else t) for cond, t in pairs]
    return F.filter(F.array(*texts), lambda x: x.isNotNull())


def has_commits() -> Column:
    return F.coalesce(F.col("commit_frequency_90d"), F.lit(0)) > 0


def file_determined_by() -> Column:
    return F.array_sort(
        _present(
            (F.lit(True), "file_tree"),
            (F.col("char_count") > 0, "file_content"),
            (has_commits(), "commit_history"),
            (F.size("imports_raw") > 0, "import_parse"),
        )
    )


def could_not_determine() -> Column:
    fields = F.array(*[F.lit(f) for f in C.COMMIT_FIELDS])
    return F.when(has_commits(), empty_strings()).otherwise(fields)


def repo_determined_by() -> Column:
    return F.array_sort(
        _present(
            (F.lit(True), "file_tree"),
            (F.col("active_files") > 0, "commit_history"),
            (F.col("readme_length_chars") > 0, "readme"),
        )
    )


def file_issues() -> Column:
    """Needs ``file_path``, ``char_count``, ``language``, ``most_recent_commit_sha``, ``imports_raw``
    and ``could_not_determine``."""
    missing = F.size("could_not_determine")
    return _present(
        (F.col("file_path") == "", "hard: file_path is empty"),
        (
            F.col("char_count") == 0,
            "hard: raw_content is empty — file content could not be fetched",
        ),
        (F.col("language") == "unknown", "hard: language is unknown — extension not recognized"),
        (F.col("most_recent_commit_sha") == "", "warning: no commit history available"),
        (
            (F.size("imports_raw") == 0) & ~F.col("language").isin(C.DATA_LANGUAGES),
            "warning: no imports detected",
        ),
        (
            missing > 0,
            F.concat(
                F.lit("warning: could_not_determine is populated — "),
                missing.cast("string"),
                F.lit(" field(s) defaulted"),
            ),
        ),
    )


def repo_issues() -> Column:
    """Needs ``commit_sha``, ``source_file_count``, ``has_readme``, ``n_entry_points``,
    ``files_collected`` and ``files_skipped``."""
    total = F.col("files_collected") + F.col("files_skipped")
    rate = F.col("files_skipped") / F.nullif(total, F.lit(0))
    percent = F.bround(rate * 100, 0).cast("int")
    text = F.concat(
        F.lit("warning: high skip rate ("),
        percent.cast("string"),
        F.lit("%) — "),
        F.col("files_skipped").cast("string"),
        F.lit(" of "),
        total.cast("string"),
        F.lit(" files were skipped"),
    )
    return _present(
        (F.col("commit_sha") == "", "hard: commit_sha is empty — cannot identify collection point"),
        (
            F.col("source_file_count") == 0,
            "hard: source_file_count is zero — no source files were collected",
        ),
        (~F.col("has_readme"), "warning: no README found"),
        (F.col("n_entry_points") == 0, "warning: no entry point candidates found"),
        ((F.col("files_collected") > 0) & (rate > 0.5), text),
    )


def is_valid(issues: Column) -> Column:
    return ~F.exists(issues, lambda i: i.startswith("hard:"))


def validate_files(files: DataFrame) -> DataFrame:
    return files.withColumn("issues", file_issues()).withColumn("is_valid", is_valid(F.col("issues")))


def validate_repos(repos: DataFrame) -> DataFrame:
    return repos.withColumn("issues", repo_issues()).withColumn("is_valid", is_valid(F.col("issues")))


def unreadable_time_text(raw: Column) -> Column:
    """Error line of a file with a commit time that is no ISO text."""
    shown = F.replace(raw, F.lit("Z"), F.lit("+00:00"))
    return F.concat(F.lit("Invalid isoformat string: '"), shown, F.lit("'"))


def failure_text() -> Column:
    """Error line of a rejected file."""
    hard = F.filter("issues", lambda i: i.startswith("hard:"))
    return F.concat(F.col("file_path"), F.lit(": validation failed — "), F.array_join(hard, "; "))
