"""Joins, aggregates and rankings over whole tables."""

from pyspark.sql import functions as F

from codestrata.catalog import fixtures as X
from codestrata.catalog.oracle import API_PARTS, fold
from codestrata.catalog.registry import plain, query
from codestrata.functions import paths as P
from codestrata.functions.times import instant
from codestrata.operators import history as H
from codestrata.operators import resolve as R
from codestrata.operators import selection as L
from codestrata.operators import structure as S
from codestrata.operators.latest import latest_artifact_per_file as newest_records
from codestrata.plans.facts import classified
from codestrata.plans.parse import parse_contents, with_imports, with_raw_imports
from codestrata.schemas import FILE, KEY
from codestrata.session import materialize, unsent


def source_imports(spark, sf, mode="local"):
    """Internal and external imports of all source files.  Contents are read once; the narrow
    result is written, since several branches of a plan read it."""
    parsed = parse_contents(X.contents(spark, sf))
    sources = L.source_files(X.tree(spark, sf)).select(*FILE)
    narrow = parsed.join(unsent(sources), FILE, "left_semi").select(*FILE, "language", "imports_raw")
    return materialize(classified(narrow, X.tree(spark, sf), mode), "imports")


def edges(spark, sf, mode="local"):
    files = source_imports(spark, sf, mode)
    scope = R.resolution_scope(X.tree(spark, sf), files, mode)
    return files, R.resolve_imports(files, scope)


# import resolution --------------------------------------------------------------------------


@query(f"""SELECT doc_id, {fold("raw")} AS normal FROM (SELECT doc_id,
  CASE lang WHEN 'en' THEN './' || path WHEN 'fr' THEN path || '/../x' WHEN 'de' THEN '../' || path || '/../../../y/'
  ELSE 'a/../../' || path || '//./z' END AS raw FROM files)""")
def normalize_import_path(spark, sf):
    rows = X.tree(spark, sf, "doc_id", "lang")
    raw = F.expr("""CASE lang WHEN 'en' THEN './' || path WHEN 'fr' THEN path || '/../x'
      WHEN 'de' THEN '../' || path || '/../../../y/' ELSE 'a/../../' || path || '//./z' END""")
    return rows.select("doc_id", P.normalize(raw).alias("normal"))


@query("SELECT repo_id, path, import, target FROM edges WHERE regexp_matches(import, '^([.][.]?/|/)')")
def resolve_relative_imports(spark, sf):
    _, found = edges(spark, sf)
    return found.where(P.is_path_import(F.col("import"))).drop("commit_sha")


@query("SELECT repo_id, path, import, target FROM edges WHERE NOT regexp_matches(import, '^([.][.]?/|/)')")
def resolve_module_imports(spark, sf):
    _, found = edges(spark, sf)
    return found.where(~P.is_path_import(F.col("import"))).drop("commit_sha")


@query("""SELECT l.repo_id, l.path, l.pos_in AS pos, l.module AS import FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_id, path ORDER BY pos) - 1 AS pos_in FROM lines
    WHERE internal AND skip_reason IS NULL) l
  WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.repo_id = l.repo_id AND e.path = l.path AND e.import = l.module)""")
def unresolved_imports(spark, sf):
    files, found = edges(spark, sf)
    return R.unresolved_imports(files, found).drop("commit_sha")


@query("""SELECT 'local' AS mode, repo_id, path, import, target FROM edges
  UNION ALL SELECT 'api', repo_id, path, import, target FROM api_edges""")
def resolution_scope(spark, sf):
    local = edges(spark, sf, "local")[1].withColumn("mode", F.lit("local"))
    api = edges(spark, sf, "api")[1].withColumn("mode", F.lit("api"))
    return local.unionByName(api).drop("commit_sha")


@query("SELECT repo_id, target AS path, path AS dependent FROM edges")
def dependents(spark, sf):
    return R.dependents(edges(spark, sf)[1]).drop("commit_sha")


@query("SELECT repo_id, target AS path, count(*) AS n_dependents FROM edges GROUP BY ALL")
def dependent_counts(spark, sf):
    return R.dependent_counts(edges(spark, sf)[1]).drop("commit_sha")


@query("""SELECT repo_id, path, part::INTEGER AS part, min(d) AS first, max(d) AS last, count(*) AS n, string_agg(d, '|' ORDER BY d) AS items
  FROM (SELECT repo_id, target AS path, path AS d, (row_number() OVER (PARTITION BY repo_id, target ORDER BY path) - 1) // 3 AS part FROM edges)
  GROUP BY ALL""")
def file_dependents(spark, sf):
    """All dependents of every file, in sorted parts of three."""
    return plain(R.dependent_parts(edges(spark, sf)[1], 3).drop("commit_sha"))


CHANGED = "lang IN ('es', 'de', 'fr')"


@query(f"""SELECT repo_id, path, CASE WHEN lang = 'de' THEN 'not_in_tree' ELSE skip_reason END AS skip_reason FROM flags
  WHERE {CHANGED}""")
def target_files(spark, sf):
    rows = X.tree(spark, sf, "lang")
    changed = rows.where(CHANGED).select(*FILE)
    return L.target_files(changed, rows.where("lang <> 'de'")).select("repo_id", "path", "skip_reason")


@query("""SELECT repo_id, branch, CASE WHEN repo_id IN (SELECT repo_id FROM commits WHERE event_type = 'signup')
  THEN 'incremental' ELSE 'full' END AS mode FROM (SELECT DISTINCT repo_id, lang AS branch FROM files)""")
def collection_mode(spark, sf):
    """Repositories with a sign-up event count as collected before."""
    heads = X.tree(spark, sf, F.col("lang").alias("branch")).select("repo_id", "branch").distinct()
    collected = X.commits(spark, sf, "event_type").where("event_type = 'signup'")
    return L.collection_mode(heads, collected)


# structure ----------------------------------------------------------------------------------


def sources(spark, sf):
    return L.source_files(X.tree(spark, sf))


@query("SELECT repo_id, skip_reason, count(*) AS n_files FROM flags WHERE skip_reason IS NOT NULL GROUP BY ALL")
def skip_reason_counts(spark, sf):
    return S.skip_reason_counts(L.with_skip_reason(X.tree(spark, sf))).drop("commit_sha")


@query("SELECT repo_id, language, count(*) AS n_files FROM sources GROUP BY ALL")
def language_distribution(spark, sf):
    rows = sources(spark, sf).withColumn("language", P.language(F.col("path")))
    return S.language_distribution(rows).drop("commit_sha")


@query("""SELECT repo_id, array_to_string(p[1:i], '/') || '/' AS directory, count(*) AS n_files
  FROM sources, (SELECT unnest(range(1, 12)) AS i) WHERE i <= depth GROUP BY ALL""")
def directory_structure(spark, sf):
    return S.directory_structure(sources(spark, sf)).drop("commit_sha")


@query("SELECT repo_id, max(depth) AS max_directory_depth FROM sources GROUP BY ALL")
def max_depth(spark, sf):
    return S.max_depth(sources(spark, sf)).drop("commit_sha")


@query("SELECT repo_id, path FROM sources WHERE depth <= 1 AND regexp_matches(lower(base), '^(index|main|app|server)([.][^.]*)?$')")
def entry_point_candidates(spark, sf):
    return S.entry_point_candidates(sources(spark, sf)).drop("commit_sha")


@query("SELECT repo_id, test_directory FROM test_dirs")
def test_directories(spark, sf):
    return S.test_directories(X.tree(spark, sf)).drop("commit_sha")


@query("SELECT repo_id, readme_path FROM readmes")
def first_readme(spark, sf):
    return S.first_readme(X.tree(spark, sf)).drop("commit_sha")


@query("SELECT repo_id, manifest_type FROM manifests")
def first_manifest(spark, sf):
    return S.first_manifest(X.tree(spark, sf)).drop("commit_sha")


@query("SELECT repo_id, path, coalesce(names, '') AS packages FROM raws LEFT JOIN outside_api USING (repo_id, path)",
       extra={"outside_api": """SELECT repo_id, path, string_agg(DISTINCT module, '|' ORDER BY module) AS names
  FROM lines WHERE NOT api_internal GROUP BY ALL"""})
def external_packages(spark, sf):
    rows = with_imports(X.contents(spark, sf))
    distinct = F.array_sort(F.array_distinct("imports.external"))
    return plain(rows.select("repo_id", "path", distinct.alias("packages")))


@query("SELECT r.repo_id, r.path, coalesce(m.missed, '') AS unresolved FROM sources r LEFT JOIN misses m USING (repo_id, path)")
def unresolved_union(spark, sf):
    """Texts the extractor could not classify (none) followed by those without a file."""
    files, found = edges(spark, sf)
    return plain(
        R.attach_resolution(files, found).select(
            "repo_id", "path", F.col("imports_unresolved").alias("unresolved")
        )
    )


# history ------------------------------------------------------------------------------------


def recent(spark, sf):
    as_of = instant(X.AS_OF_30)
    return H.commit_horizon(X.commits(spark, sf), as_of, newest=50), as_of


@query("SELECT repo_id, path, n90 AS commit_frequency_90d, n30 AS commit_frequency_30d FROM activity")
def commit_frequency(spark, sf):
    return H.commit_frequency(*recent(spark, sf)).drop("commit_sha")


WHOLE_HISTORY = {"history": API_PARTS["history"]}


def whole(spark, sf):
    """What the API lists: every commit of the horizon."""
    as_of = instant(X.AS_OF_30)
    return H.commit_horizon(X.commits(spark, sf), as_of), as_of


@query("SELECT repo_id, path, n90 AS commit_frequency_90d, n30 AS commit_frequency_30d FROM activity", extra=WHOLE_HISTORY)
def commit_frequency_api(spark, sf):
    return H.commit_frequency(*whole(spark, sf)).drop("commit_sha")


@query("SELECT repo_id, sum(n30) AS commit_frequency_30d FROM activity GROUP BY ALL", extra=WHOLE_HISTORY)
def repo_commit_frequency_api(spark, sf):
    return S.repo_commit_frequency(H.commit_frequency(*whole(spark, sf))).drop("commit_sha")


@query("SELECT repo_id, path, nth AS rank, author_name, n AS n_commits FROM authors WHERE nth <= 3", extra=WHOLE_HISTORY)
def top_contributors_api(spark, sf):
    return H.ranked_contributors(H.author_activity(*whole(spark, sf))).drop("commit_sha")


@query("""SELECT repo_id, rank, path, n AS commit_frequency_30d FROM (SELECT repo_id, path, coalesce(n30, 0) AS n,
  row_number() OVER (PARTITION BY repo_id ORDER BY coalesce(n30, 0) DESC, path) AS rank
  FROM sources LEFT JOIN activity USING (repo_id, path)) WHERE rank <= 5""", extra=WHOLE_HISTORY)
def most_active_files_api(spark, sf):
    counts = H.commit_frequency(*whole(spark, sf))
    files = sources(spark, sf).join(unsent(counts), FILE, "left").na.fill(0, ["commit_frequency_30d"])
    return S.most_active_files(files).drop("commit_sha")


@query("SELECT repo_id, sum(n30) AS commit_frequency_30d FROM activity GROUP BY ALL")
def repo_commit_frequency(spark, sf):
    return S.repo_commit_frequency(H.commit_frequency(*recent(spark, sf))).drop("commit_sha")


@query("""SELECT repo_id, path, sha AS most_recent_commit_sha, epoch_us(ts) AS micros, author AS most_recent_commit_author,
  message AS most_recent_commit_message FROM activity""")
def latest_commit(spark, sf):
    rows = H.latest_commit(recent(spark, sf)[0])
    return rows.select(
        "repo_id", "path", "most_recent_commit_sha",
        F.unix_micros("most_recent_commit_timestamp").alias("micros"),
        "most_recent_commit_author", "most_recent_commit_message",
    )


@query("SELECT repo_id, path, nth AS rank, author_name, n AS n_commits FROM authors WHERE nth <= 3")
def top_contributors(spark, sf):
    return H.ranked_contributors(H.author_activity(*recent(spark, sf))).drop("commit_sha")


@query("""SELECT repo_id, rank, path, n AS commit_frequency_30d FROM (SELECT repo_id, path, coalesce(n30, 0) AS n,
  row_number() OVER (PARTITION BY repo_id ORDER BY coalesce(n30, 0) DESC, path) AS rank
  FROM sources LEFT JOIN activity USING (repo_id, path)) WHERE rank <= 5""")
def most_active_files(spark, sf):
    counts = H.commit_frequency(*recent(spark, sf))
    files = sources(spark, sf).join(unsent(counts), FILE, "left").na.fill(0, ["commit_frequency_30d"])
    return S.most_active_files(files).drop("commit_sha")


@query("""SELECT repo_id, rank, path, line_count FROM (SELECT repo_id, path, line_count,
  row_number() OVER (PARTITION BY repo_id ORDER BY line_count DESC, path) AS rank
  FROM (SELECT *, CASE WHEN coalesce(content, '') = '' THEN 0 ELSE len(string_split(content, chr(10))) END AS line_count
    FROM sources)) WHERE rank <= 5""")
def largest_files(spark, sf):
    lines = parse_contents(X.contents(spark, sf)).select(*FILE, "line_count")
    files = sources(spark, sf).join(unsent(lines), FILE, "left").na.fill(0, ["line_count"])
    return S.largest_files(files).drop("commit_sha")


@query("""SELECT repo_id, path AS file_path, arg_max(sha, event_id) AS sha, max(event_id) AS run_at FROM commits GROUP BY ALL""")
def latest_artifact_per_file(spark, sf):
    """Each commit taken as a run that wrote a record of its file."""
    rows = X.commits(spark, sf, F.col("event_id").alias("run_at"))
    records = rows.select("repo_id", "commit_sha", F.col("path").alias("file_path"), "sha", "run_at")
    return newest_records(records).drop("commit_sha")
