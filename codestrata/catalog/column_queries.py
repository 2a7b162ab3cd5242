"""Path, time and parser expressions over whole tables."""

from pyspark.sql import functions as F

from codestrata.catalog import fixtures as X
from codestrata.catalog.oracle import W
from codestrata.catalog.registry import plain, query
from codestrata.functions import paths as P
from codestrata.functions.times import days_between, instant, iso_text, parse_commit_time
from codestrata.operators import selection as L
from codestrata.operators import structure as R
from codestrata.plans.facts import classified
from codestrata.plans.parse import readme_rows, with_imports, with_raw_imports


def per_path(spark, sf, **columns):
    return X.tree(spark, sf).select("repo_id", "path", *[c.alias(n) for n, c in columns.items()])


@query("SELECT repo_id, path, ext AS extension FROM flags")
def file_extension(spark, sf):
    return per_path(spark, sf, extension=P.extension(F.col("path")))


@query("SELECT repo_id, path, language FROM flags")
def detect_language(spark, sf):
    return per_path(spark, sf, language=P.language(F.col("path")))


@query("SELECT repo_id, path, skip_reason FROM flags")
def skip_reason(spark, sf):
    return per_path(spark, sf, skip_reason=P.skip_reason(F.col("path"), F.col("size")))


@query("SELECT repo_id, path, sha, size FROM sources")
def source_files(spark, sf):
    return L.source_files(X.tree(spark, sf)).select("repo_id", "path", "sha", "size")


@query("SELECT repo_id, path, coalesce(skip_reason, 'too_large') = 'too_large' AS collectable FROM flags")
def collectable_path(spark, sf):
    return per_path(spark, sf, collectable=P.is_collectable(F.col("path")))


@query("""SELECT repo_id, path FROM (SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY path) AS nth FROM sources)
  WHERE nth <= 7""")
def cap_files(spark, sf):
    return L.cap_files(L.source_files(X.tree(spark, sf)), 7).select("repo_id", "path")


@query("SELECT repo_id, path, CASE WHEN coalesce(strlen(content), 0) < 10 THEN 'empty_file' END AS skip_reason FROM files")
def empty_file_filter(spark, sf):
    return L.with_empty_file_reason(X.contents(spark, sf)).select("repo_id", "path", "skip_reason")


@query("SELECT repo_id, path, stem IN ('index', 'main', 'app', 'server') AND depth <= 1 AS is_entry_point FROM flags")
def is_entry_point(spark, sf):
    return per_path(spark, sf, is_entry_point=P.is_entry_point(F.col("path")))


@query("SELECT repo_id, path, regexp_matches(path, '(^|/)(tests?|__tests__|spec)/') AS is_in_test_dir FROM files")
def is_in_test_dir(spark, sf):
    return per_path(spark, sf, is_in_test_dir=P.is_in_test_directory(F.col("path")))


@query("SELECT repo_id, path, CAST(length(path) - length(replace(path, '/', '')) AS INTEGER) AS path_depth FROM files")
def path_depth(spark, sf):
    return per_path(spark, sf, path_depth=P.depth(F.col("path")))


@query("SELECT repo_id, path, left(sha256(path), 12) AS path_hash FROM files")
def path_hash(spark, sf):
    return per_path(spark, sf, path_hash=P.path_hash(F.col("path")))


@query("SELECT repo_id, path, replace(replace(path, '/', '__'), '.', '_') || '.json' AS artifact_name FROM files")
def artifact_name(spark, sf):
    return per_path(spark, sf, artifact_name=P.artifact_name(F.col("path")))


@query("SELECT DISTINCT repo_id, replace(repo_id, '/', '__') || '__main__' || left(commit_sha, 7) AS run_name FROM files")
def run_name(spark, sf):
    name = P.run_name(F.col("repo_id"), F.col("branch"), F.col("commit_sha"))
    return X.snapshots(spark, sf).select("repo_id", name.alias("run_name"))


# time ---------------------------------------------------------------------------------------


@query("""SELECT event_id, epoch_us(ts) - CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 7200000000
  ELSE epoch_us(ts) % 1000000 - 19800000000 END AS micros FROM events""")
def parse_commit_ts(spark, sf):
    """ISO with Z, ISO with an offset, and the log form."""
    ts = F.col("ts").cast("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "click", F.concat(iso, F.lit("Z")))
        .when(F.col("event_type") == "view", F.concat(iso, F.lit("+02:00")))
        .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" -0530")))
    )
    rows = X.table(spark, sf, "events")
    return rows.select("event_id", F.unix_micros(parse_commit_time(text)).alias("micros"))


@query("""SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2024-01-15 06:00:00') - epoch_us(ts)) / 86400000000) AS INTEGER) AS days
  FROM events""")
def days_since_last_change(spark, sf):
    """The moment lies inside the data, so half of the days are negative."""
    days = days_between(F.col("ts").cast("timestamp"), instant("2024-01-15T06:00:00+00:00"))
    return X.table(spark, sf, "events").select("event_id", days.alias("days"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
  ELSE strftime(ts, '.%f') END || '+00:00' AS iso FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN
  date_trunc('second', ts) ELSE ts END AS ts FROM events)""")
def iso_timestamps(spark, sf):
    ts = F.col("ts").cast("timestamp")
    some = F.when(F.col("event_type") == "view", F.date_trunc("second", ts)).otherwise(ts)
    return X.table(spark, sf, "events").select("event_id", iso_text(some).alias("iso"))


# parsers ------------------------------------------------------------------------------------


def _imports_of(spark, sf, languages):
    """Per file the three lists of one language family."""
    rows = with_imports(X.contents(spark, sf).where(P.language(F.col("path")).isin(languages)))
    return plain(
        rows.select("repo_id", "path", "imports.raw", "imports.internal", "imports.external")
    )


def _lists_sql(languages, flag="api_internal", where="true"):
    names = ", ".join(f"'{x}'" for x in languages)
    return f"""SELECT r.repo_id, r.path, array_to_string(r.raw, '|') AS raw, coalesce(i.names, '') AS internal,
  coalesce(i.others, '') AS external FROM raws r LEFT JOIN (
    SELECT repo_id, path, string_agg(module, '|' ORDER BY pos) FILTER ({flag}) AS names,
           string_agg(module, '|' ORDER BY pos) FILTER (NOT {flag}) AS others FROM lines GROUP BY ALL) i
  USING (repo_id, path) WHERE r.language IN ({names}) AND {where}"""


@query(_lists_sql(["python"]))
def imports_python(spark, sf):
    return _imports_of(spark, sf, ["python"])


@query(_lists_sql(["javascript", "typescript"]))
def imports_js(spark, sf):
    return _imports_of(spark, sf, ["javascript", "typescript"])


@query(_lists_sql(["java"]))
def imports_java(spark, sf):
    return _imports_of(spark, sf, ["java"])


@query(_lists_sql(["go"]))
def imports_go(spark, sf):
    return _imports_of(spark, sf, ["go"])


@query(_lists_sql(["rust"]))
def imports_rust(spark, sf):
    return _imports_of(spark, sf, ["rust"])


@query(_lists_sql(["ruby"]))
def imports_ruby(spark, sf):
    return _imports_of(spark, sf, ["ruby"])


@query("""SELECT repo_id, path, language, array_to_string(raw, '|') AS raw, CASE WHEN coalesce(content, '') <> '' AND language
  NOT IN ('python', 'javascript', 'typescript', 'java', 'go', 'rust', 'ruby')
  THEN 'import extraction not supported for language: ' || language ELSE '' END AS warnings, '' AS unresolved FROM raws""")
def imports_all(spark, sf):
    rows = with_imports(X.contents(spark, sf))
    return plain(
        rows.select(
            "repo_id", "path", "language", "imports.raw", "imports.warnings", "imports.unresolved"
        )
    )


ALL = ["python", "javascript", "typescript", "java", "go", "rust", "ruby"]


@query(_lists_sql(ALL, "internal"))
def imports_own_package(spark, sf):
    """Classification with the repository's own package known."""
    rows = with_raw_imports(X.contents(spark, sf)).drop("content", "blob_sha")
    known = classified(rows.where(F.col("language").isin(ALL)), X.tree(spark, sf), "local")
    return plain(
        known.select("repo_id", "path", F.col("imports_raw").alias("raw"), "internal", "external")
    )


@query("SELECT repo_id, package FROM packages")
def top_level_package(spark, sf):
    return R.top_level_package(X.tree(spark, sf)).select("repo_id", "package")


def _word(words: str) -> str:
    return f"regexp_matches(array_to_string(texts, ' '), '(?i)(^|[^{W}])(?:{words})')"


@query(
    f"""SELECT repo_id, path, array_to_string(texts, '|') AS headers, length(readme) AS length_chars,
  {_word("install")} AS has_installation, {_word(f"(?:api|reference|docs?)($|[^{W}])")} AS has_api_docs,
  {_word(f"(?:example|usage|getting[ -]started)($|[^{W}])")} AS has_examples FROM all_headers""",
    extra={
        "all_headers": r"""SELECT repo_id, path, coalesce(content, '') AS readme,
  list_transform(regexp_extract_all(coalesce(content, ''), '(?m)^#{1,2}\s+([^\n]+)', 1), lambda h: trim(h)) AS texts
  FROM named WHERE base = 'README.md'"""
    },
)
def readme_structure(spark, sf):
    rows = readme_rows(X.contents(spark, sf))
    return plain(rows.select("repo_id", "path", "structure.*"))
