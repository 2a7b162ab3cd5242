"""Whole records and runs: the complete collection over all repositories."""

import hashlib
import uuid

from pyspark.sql import functions as F

from codestrata import schemas
from codestrata.catalog import fixtures as X
from codestrata.catalog.oracle import API_PARTS
from codestrata.catalog.registry import plain, query
from codestrata.functions.times import instant
from codestrata.operators import validate as V
from codestrata.operators.skew import list_parts
from codestrata.plans import collection as C
from codestrata.plans import facts as B
from codestrata.plans.facts import with_content
from codestrata.schemas import KEY
from codestrata.session import workspace
from codestrata.sources.artifacts import read_json_artifacts, read_json_lines, write_json_artifacts
from codestrata.sources.runs import RunStore
from codestrata.sources.stored import only_named

TIMES = ["fetched_at", "most_recent_commit_timestamp", "most_recent_commit_timestamp_raw"]
EXTRAS = ["active_files", "n_entry_points", "n_collection_errors", "n_directories", "n_test_directories"]


def inputs(spark, sf):
    return X.snapshots(spark, sf), X.tree(spark, sf), X.contents(spark, sf), X.commits(spark, sf)


def collect(spark, sf, mode="local", max_files=None):
    return C.full_collection(*inputs(spark, sf), instant(X.AS_OF_30), mode, max_files)


def file_columns(files):
    """File records with the commit time in microseconds and lists as texts."""
    micros = F.unix_micros("most_recent_commit_timestamp").alias("most_recent_commit_micros")
    return plain(files.select("*", micros).drop(*TIMES))


@query("SELECT * EXCLUDE (content_bytes) FROM kept")
def file_facts(spark, sf):
    return file_columns(collect(spark, sf).files)


@query("SELECT * FROM repo_records")
def repo_facts(spark, sf):
    return plain(collect(spark, sf).repos.drop("fetched_at", *EXTRAS))


@query("SELECT * EXCLUDE (content_bytes) FROM kept", extra=API_PARTS)
def file_facts_api(spark, sf):
    return file_columns(collect(spark, sf, "api").files)


@query("SELECT * FROM repo_records", extra=API_PARTS)
def repo_facts_api(spark, sf):
    """Whole histories, and the errors of the files that could not be fetched."""
    return plain(collect(spark, sf, "api").repos.drop("fetched_at", *EXTRAS))


@query("""SELECT repo_id, kind, part::INTEGER AS part, count(*) AS n, string_agg(value || '=' || n, '|' ORDER BY position, value) AS items
  FROM (SELECT *, (row_number() OVER (PARTITION BY repo_id, kind ORDER BY position, value) - 1) // 3 AS part FROM long_entries) GROUP BY ALL""",
       extra=API_PARTS)
def repo_entries(spark, sf):
    """Every list and map of the repository records, in sorted parts of three."""
    parts = B.more_entries(list_parts(collect(spark, sf, "api").entries, [*KEY, "kind"], "entry", 3))
    shown = F.transform("items", lambda e: F.concat(e["value"], F.lit("="), e["n"].cast("string")))
    return plain(parts.select("repo_id", "kind", "part", "n", shown.alias("items")))


@query("SELECT repo_id, file_path, determined_by FROM kept")
def file_determined_by(spark, sf):
    return plain(collect(spark, sf).files.select("repo_id", "file_path", "determined_by"))


@query("SELECT repo_id, file_path, could_not_determine FROM kept")
def could_not_determine(spark, sf):
    return plain(collect(spark, sf).files.select("repo_id", "file_path", "could_not_determine"))


@query("SELECT repo_id, determined_by FROM repo_records")
def repo_determined_by(spark, sf):
    return plain(collect(spark, sf).repos.select("repo_id", "determined_by"))


@query("""SELECT repo_id, file_path, array_to_string(issue_list, '|') AS issues,
  len(list_filter(issue_list, lambda i: i LIKE 'hard:%')) = 0 AS is_valid FROM issues WHERE content_bytes >= 10 OR char_count = 0""")
def validate_files(spark, sf):
    """All records the API mode rejects, and all the local mode keeps."""
    local = V.validate_files(collect(spark, sf).files)
    empty = collect(spark, sf, "api").rejects.where("char_count = 0")
    names = ["repo_id", "file_path", "issues", "is_valid"]
    return plain(local.select(names).unionByName(empty.select(names)))


@query("""SELECT repo_id, file_path, array_to_string(list_filter([
    CASE WHEN file_path = '' THEN 'hard: file_path is empty' END,
    CASE WHEN chars = 0 THEN 'hard: raw_content is empty — file content could not be fetched' END,
    CASE WHEN spoken = 'unknown' THEN 'hard: language is unknown — extension not recognized' END,
    CASE WHEN most_recent_commit_sha = '' THEN 'warning: no commit history available' END,
    CASE WHEN imports_raw = '' AND spoken NOT IN ('json', 'yaml', 'toml', 'markdown', 'shell') THEN 'warning: no imports detected' END,
    CASE WHEN could_not_determine <> '' THEN 'warning: could_not_determine is populated — 6 field(s) defaulted' END
  ], lambda i: i IS NOT NULL), '|') AS issues, file_path <> '' AND chars > 0 AND spoken <> 'unknown' AS is_valid FROM
  (SELECT * REPLACE (CASE WHEN char_count % 3 = 1 THEN '' ELSE file_path END AS file_path), CASE WHEN char_count % 5 = 2 THEN 0 ELSE char_count END AS chars,
    CASE WHEN char_count % 7 = 3 THEN 'unknown' WHEN char_count % 7 = 4 THEN 'yaml' ELSE language END AS spoken FROM kept)""")
def validate_files_every_rule(spark, sf):
    """All file records, some of them broken in each way a rule looks for."""
    n = F.col("char_count")
    broken = collect(spark, sf).files.withColumns({
        "file_path": F.when(n % 3 == 1, "").otherwise(F.col("file_path")),
        "language": F.when(n % 7 == 3, "unknown").when(n % 7 == 4, "yaml").otherwise(F.col("language")),
        "char_count": F.when(n % 5 == 2, 0).otherwise(n),
    })
    return plain(V.validate_files(broken).select("repo_id", "file_path", "issues", "is_valid"))


@query("""SELECT repo_id, replace(repo_id, '/', '__') || '__main__' || left(commit_sha, 7) AS run_name, files_collected, files_skipped,
  coalesce(e.n, 0) AS files_failed, collection_errors FROM repo_records LEFT JOIN (SELECT repo_id, count(*) AS n FROM failures GROUP BY ALL) e USING (repo_id)""",
       extra=API_PARTS)
def run_summary_api(spark, sf):
    """Where each run is, what it collected and what failed, with every error."""
    return plain(C.run_summary(collect(spark, sf, "api").runs).drop("commit_sha"))


REPO_ISSUES = """SELECT repo_id, array_to_string(list_filter([
    CASE WHEN source_file_count = 0 THEN 'hard: source_file_count is zero — no source files were collected' END,
    CASE WHEN NOT has_readme THEN 'warning: no README found' END,
    CASE WHEN entry_point_candidates = '' THEN 'warning: no entry point candidates found' END,
    CASE WHEN files_collected > 0 AND files_skipped / (files_collected + files_skipped) > 0.5 THEN
      'warning: high skip rate (' || CAST(round_even(100 * files_skipped / (files_collected + files_skipped), 0) AS INTEGER)
      || '%) — ' || files_skipped || ' of ' || (files_collected + files_skipped) || ' files were skipped' END
  ], lambda x: x IS NOT NULL), '|') AS issues, source_file_count > 0 AS is_valid FROM repo_records"""


@query(REPO_ISSUES)
def validate_repos(spark, sf):
    rows = V.validate_repos(collect(spark, sf).repos)
    return plain(rows.select("repo_id", "issues", "is_valid"))


API_EMPTY = "FROM sources WHERE coalesce(content, '') = ''"


@query(f"""SELECT repo_id, path || ': validation failed — hard: raw_content is empty — file content could not be fetched' AS error
  {API_EMPTY}""")
def collection_errors(spark, sf):
    return collect(spark, sf, "api").errors.drop("commit_sha")


@query(f"""SELECT h.repo_id, h.total AS total_file_count, h.taken - coalesce(e.n, 0) AS files_collected,
  h.total - h.taken AS files_skipped, coalesce(e.n, 0) AS files_failed FROM
  (SELECT repo_id, count(*) AS total, count(*) FILTER (skip_reason IS NULL) AS taken FROM flags GROUP BY ALL) h
  LEFT JOIN (SELECT repo_id, count(*) AS n {API_EMPTY} GROUP BY ALL) e USING (repo_id)""")
def repo_counts(spark, sf):
    return collect(spark, sf, "api").repos.select(
        "repo_id", "total_file_count", "files_collected", "files_skipped",
        F.col("n_collection_errors").alias("files_failed"),
    )


@query(f"""SELECT h.repo_id, replace(h.repo_id, '/', '__') || '__main__' || left(h.commit_sha, 7) AS run_name, 'full' AS mode,
  CASE WHEN e.n IS NULL THEN 'complete' ELSE 'partial' END AS status, h.taken AS files_attempted,
  h.taken - coalesce(e.n, 0) AS files_succeeded, coalesce(e.n, 0) AS files_failed FROM
  (SELECT repo_id, commit_sha, count(*) FILTER (skip_reason IS NULL) AS taken FROM flags GROUP BY ALL) h
  LEFT JOIN (SELECT repo_id, count(*) AS n {API_EMPTY} GROUP BY ALL) e USING (repo_id)""")
def collection_runs(spark, sf):
    return collect(spark, sf, "api").runs.select(
        "repo_id", "run_name", "mode", "status", "files_attempted", "files_succeeded", "files_failed"
    )


@query("""SELECT repo_id, files_collected, files_skipped, 0 AS files_failed FROM repo_records""")
def run_summary(spark, sf):
    return C.run_summary(collect(spark, sf).runs).select(
        "repo_id", "files_collected", "files_skipped", "files_failed"
    )


def folder(spark, name):
    return f"{workspace(spark)}/codestrata/{name}-{uuid.uuid4().hex}"


def with_texts(spark, sf, files):
    """File records with their text: all 31 fields."""
    names = files.select(*KEY, F.col("file_path").alias("path"))
    return with_content(files, only_named(X.contents(spark, sf), names))


@query("SELECT repo_id, file_path, fetched_at, imports_raw, dependents, most_recent_commit_micros, has_null FROM (SELECT *, '2024-02-10T00:00:00+00:00' AS fetched_at, most_recent_commit_micros IS NULL AS has_null FROM kept)")
def sink_artifacts_json(spark, sf):
    """JSON texts of all file records, written, and read back through JSON paths."""
    path = folder(spark, "json")
    write_json_artifacts(with_texts(spark, sf, collect(spark, sf).files), schemas.FILE_RECORD, path)
    rows = read_json_lines(spark, path).withColumnRenamed("value", "json").select("json")
    at = lambda p: F.get_json_object("json", f"$.{p}")
    listed = lambda p: F.array_join(F.from_json(at(p), "array<string>"), "|")
    stamp = at("most_recent_commit_timestamp")
    return rows.select(
        at("repo_id").alias("repo_id"), at("file_path").alias("file_path"),
        at("fetched_at").alias("fetched_at"), listed("imports_raw").alias("imports_raw"),
        listed("dependents").alias("dependents"),
        F.unix_micros(F.to_timestamp(stamp)).alias("most_recent_commit_micros"),
        F.col("json").contains('"most_recent_commit_timestamp":null').alias("has_null"),
    )


@query("SELECT * EXCLUDE (content_bytes, n_dependents) FROM kept")
def roundtrip_artifacts(spark, sf):
    """Records to JSON files and back, with exactly the fields of a record."""
    path = folder(spark, "roundtrip")
    write_json_artifacts(with_texts(spark, sf, collect(spark, sf).files), schemas.FILE_RECORD, path)
    back = read_json_artifacts(spark, path, schemas.FILE_RECORD, strict=True)
    return file_columns(back.drop("raw_content"))


@query("""SELECT k.* EXCLUDE (content_bytes, n_dependents), md5(coalesce(f.content, '')) AS content_md5 FROM kept k
  JOIN files f ON f.repo_id = k.repo_id AND f.path = k.file_path""")
def roundtrip_whole_records(spark, sf):
    """As `roundtrip_artifacts`, with the text."""
    path = folder(spark, "whole")
    write_json_artifacts(with_texts(spark, sf, collect(spark, sf).files), schemas.FILE_RECORD, path)
    back = read_json_artifacts(spark, path, schemas.FILE_RECORD, strict=True)
    return file_columns(back.withColumn("content_md5", F.md5("raw_content")).drop("raw_content"))


@query("SELECT * FROM repo_records", name="roundtrip_repo_artifacts")
def roundtrip_repos(spark, sf):
    """Repository records to JSON files and back."""
    path = folder(spark, "repos")
    write_json_artifacts(collect(spark, sf).repos, schemas.REPO_RECORD, path)
    return plain(read_json_artifacts(spark, path, schemas.REPO_RECORD, strict=True).drop("fetched_at"))


@query("""SELECT k.* EXCLUDE (content_bytes, n_dependents), md5(coalesce(f.content, '')) AS content_md5 FROM kept k
  JOIN files f ON f.repo_id = k.repo_id AND f.path = k.file_path WHERE k.repo_id = 'org/src3'""")
def load_run_records(spark, sf):
    """The file records of one repository, by the start of its commit, from a stored and published run of all of them."""
    store = RunStore(spark, folder(spark, "runs"))
    store.store(collect(spark, sf), X.contents(spark, sf))
    files = store.load("org/src3", hashlib.sha1(b"head:org/src3").hexdigest()[:7])[1]
    whole = files.withColumn("content_md5", F.md5("raw_content")).drop("raw_content", "n_dependents")
    return file_columns(whole)


@query(f"""SELECT h.repo_id, CASE WHEN run = 2 THEN 'running' WHEN e.n IS NULL THEN 'complete' ELSE 'partial' END AS status, run::BIGINT AS run,
  CASE WHEN run = 1 THEN h.taken - coalesce(e.n, 0) ELSE 0 END AS files_succeeded, CASE WHEN run = 1 THEN coalesce(e.n, 0) ELSE 0 END AS files_failed FROM
  (SELECT repo_id, count(*) FILTER (skip_reason IS NULL) AS taken FROM flags GROUP BY ALL) h
  LEFT JOIN (SELECT repo_id, count(*) AS n {API_EMPTY} GROUP BY ALL) e USING (repo_id), (SELECT unnest([1, 2]) AS run) r""")
def run_manifests(spark, sf):
    """Two runs of all repositories: one ended, and one that was stopped before it was published."""
    store, result = RunStore(spark, folder(spark, "manifests")), collect(spark, sf, "api")
    store.store(result)
    store.write(result, store.begin(result))
    return store.manifest().select("repo_id", "status", "run", "files_succeeded", "files_failed")


@query("""SELECT repo_id, count(*) AS n_files, sum(line_count) AS n_lines, sum(commit_frequency_90d) AS n_commits,
  sum(n_dependents) AS n_dependents FROM kept GROUP BY repo_id""")
def full_collection(spark, sf):
    return collect(spark, sf).files.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("line_count").alias("n_lines"),
        F.sum("commit_frequency_90d").alias("n_commits"), F.sum("n_dependents").alias("n_dependents"),
    )


CHANGED_PARTS = {
    "changed_edges": """SELECT e.* FROM edges e JOIN files f ON f.repo_id = e.repo_id AND f.path = e.path WHERE f.lang = 'fr'"""
}


@query(
    """SELECT k.repo_id, k.file_path, k.imports_internal, k.commit_frequency_90d,
  coalesce((SELECT string_agg(e.path, '|' ORDER BY e.path) FROM changed_edges e
            WHERE e.repo_id = k.repo_id AND e.target = k.file_path), '') AS dependents
  FROM kept k JOIN files f ON f.repo_id = k.repo_id AND f.path = k.file_path WHERE f.lang = 'fr'""",
    extra=CHANGED_PARTS,
)
def incremental_collection(spark, sf):
    """French files changed: only they are collected, and only they count as dependents."""
    snapshots, tree, contents, commits = inputs(spark, sf)
    changed = X.tree(spark, sf, "lang").where("lang = 'fr'").select(*schemas.FILE)
    result = C.incremental_collection(
        snapshots, tree, contents, commits, changed, instant(X.AS_OF_30)
    )
    return plain(
        result.files.select(
            "repo_id", "file_path", "imports_internal", "commit_frequency_90d", "dependents"
        )
    )
