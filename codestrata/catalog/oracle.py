"""Named SQL parts (DuckDB dialect) the check queries are put together from.

They restate the results independently of the Spark code: import texts are
unnested to rows, resolution is a join with ``arg_min``, paths are folded as strings."""

import re

from codestrata.catalog import fixtures as X
from codestrata.functions import constants as C

S = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
W = r"\pL\pN_"
QUOTE = "[''\"]"
NOT_QUOTE = "[^''\"]"


def strings(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def cases(column: str, labels: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items()) + " END"


def found(column: str, regex: str) -> str:
    return f"regexp_extract_all({column}, '{regex}', 1)"


def prefixed(prefix: str, items: str, suffix: str = "") -> str:
    return f"list_transform({items}, lambda x: '{prefix}' || x || '{suffix}')"


def fold(path: str) -> str:
    """Normalised relative path, folded over a text accumulator."""
    return f"""(CASE WHEN list_reduce(string_split({path}, '/'), lambda acc, s:
      CASE WHEN s IN ('', '.') THEN acc
           WHEN s = '..' AND (acc = '' OR acc = '..' OR acc LIKE '%/..') THEN
             CASE WHEN acc = '' THEN '..' ELSE acc || '/..' END
           WHEN s = '..' THEN CASE WHEN contains(acc, '/') THEN regexp_replace(acc, '/[^/]*$', '') ELSE '' END
           WHEN acc = '' THEN s ELSE acc || '/' || s END, '') = '' THEN '.'
      ELSE list_reduce(string_split({path}, '/'), lambda acc, s:
      CASE WHEN s IN ('', '.') THEN acc
           WHEN s = '..' AND (acc = '' OR acc = '..' OR acc LIKE '%/..') THEN
             CASE WHEN acc = '' THEN '..' ELSE acc || '/..' END
           WHEN s = '..' THEN CASE WHEN contains(acc, '/') THEN regexp_replace(acc, '/[^/]*$', '') ELSE '' END
           WHEN acc = '' THEN s ELSE acc || '/' || s END, '') END)"""


JS_ALL = (
    "list_concat(list_concat("
    + found("content", rf"(?:import|export){S}+(?:(?:[{W}{S[1:-1]}{{}},*]+|{QUOTE}{NOT_QUOTE}+{QUOTE}){S}+from{S}+)?{QUOTE}({NOT_QUOTE}+){QUOTE}")
    + ", "
    + found("content", rf"require{S}*\({S}*{QUOTE}({NOT_QUOTE}+){QUOTE}{S}*\)")
    + "), "
    + found("content", rf"import{S}*\({S}*{QUOTE}({NOT_QUOTE}+){QUOTE}{S}*\)")
    + ")"
)
GO_ALL = (
    "list_concat("
    + found("content", rf'(?m)^import{S}+"([^"]+)"')
    + ", flatten(list_transform("
    + found("content", rf"import{S}*\(([^)]+)\)")
    + ", lambda b: regexp_extract_all(b, '\"([^\"]+)\"', 1))))"
)

PARTS = {
    "files": f"""
SELECT doc_id, lang, source, {X.REPO_ID} AS repo_id, {X.HEAD_SHA} AS commit_sha, {X.PATH} AS path,
       {X.TREE_SHA} AS sha, {X.SIZE} AS size, {X.CONTENT} AS content FROM documents""",
    "named": r"""
SELECT *, string_split(path, '/') AS p, string_split(path, '/')[1:-2] AS dirs,
       string_split(path, '/')[-1] AS base,
       regexp_extract(ltrim(string_split(path, '/')[-1], '.'), '\.[^.]*$') AS raw_ext FROM files""",
    "flags": f"""
SELECT *, lower(raw_ext) AS ext, coalesce({cases('lower(raw_ext)', C.EXTENSION_LANGUAGES)}, 'unknown') AS language,
       list_filter(dirs, lambda d: d IN ({strings(C.SKIPPED_DIRECTORIES)}))[1] AS hidden,
       CASE WHEN lower(raw_ext) NOT IN ({strings(C.SOURCE_EXTENSIONS)}) THEN 'non_source_extension'
            WHEN hidden IS NOT NULL THEN 'path_component:' || hidden
            WHEN size > 102400 THEN 'too_large' END AS skip_reason,
       len(dirs) AS depth,
       lower(left(base, length(base) - length(raw_ext))) AS stem FROM named""",
    "sources": "SELECT * FROM flags WHERE skip_reason IS NULL",
    "packages": f"""
SELECT repo_id, first(p[1] ORDER BY length(p[1]), path) AS package FROM named
WHERE len(p) = 2 AND base = '__init__.py' AND p[1] NOT IN ({strings(C.TEST_DIRECTORIES)}) GROUP BY repo_id""",
    "texts": f"""
SELECT *, CASE
  WHEN language = 'python' THEN list_concat(
    {prefixed('import ', found('content', rf'(?m)^import{S}+([{W}.]+)'))},
    {prefixed('from ', found('content', rf'(?m)^from{S}+([.{W}]+){S}+import'), ' import ...')})
  WHEN language IN ('javascript', 'typescript') THEN {JS_ALL}
  WHEN language = 'java' THEN {prefixed('import ', found('content', rf'(?m)^import{S}+([{W}.]+){S}*;'))}
  WHEN language = 'go' THEN {GO_ALL}
  WHEN language = 'rust' THEN list_concat(
    {prefixed('use ', found('content', rf'(?m)^use{S}+([{W}:]+)'))},
    {prefixed('mod ', found('content', rf'(?m)^(?:pub{S}+)?mod{S}+([{W}]+){S}*;'))})
  WHEN language = 'ruby' THEN {found('content', rf"require(?:_relative)?{S}+{QUOTE}({NOT_QUOTE}+){QUOTE}")}
  ELSE CAST([] AS VARCHAR[]) END AS every FROM flags""",
    "raws": """
SELECT * EXCLUDE (every), coalesce(CASE WHEN language IN ('javascript', 'typescript', 'go')
  THEN list_filter(every, lambda x, i: list_position(every, x) = i) ELSE every END, []) AS raw FROM texts""",
    "lines": f"""
SELECT r.*, CASE WHEN language IN ('python', 'java') THEN string_split(r, ' ')[2]
                 WHEN language = 'rust' AND r LIKE 'mod %' THEN 'crate::' || string_split(r, ' ')[2]
                 WHEN language = 'rust' THEN string_split(r, ' ')[2] ELSE r END AS module,
  CASE language WHEN 'python' THEN r LIKE 'from .%'
    WHEN 'rust' THEN regexp_matches(r, '^(mod |use (crate|self|super)::)')
    WHEN 'ruby' THEN regexp_matches(r, '^[.][.]?/')
    WHEN 'javascript' THEN regexp_matches(r, '^([.][.]?/|/)')
    WHEN 'typescript' THEN regexp_matches(r, '^([.][.]?/|/)') ELSE false END AS api_internal,
  coalesce(api_internal OR (language = 'python' AND starts_with(module, package || '.')), api_internal) AS internal
FROM (SELECT repo_id, commit_sha, path, language, skip_reason, unnest(raw) AS r,
             generate_subscripts(raw, 1) AS pos FROM raws) r LEFT JOIN packages USING (repo_id)""",
    "requests": f"""
SELECT DISTINCT repo_id, commit_sha, path, module AS import, internal, api_internal,
  CASE WHEN regexp_matches(module, '^[.][.]?/') THEN
         {fold("regexp_extract(path, '^(.*)/', 1) || '/' || module")}
       WHEN module LIKE '/%' THEN ltrim(module, '/')
       ELSE replace(module, '.', '/') END AS stem_path,
  CASE WHEN regexp_matches(module, '^([.][.]?/|/)')
    THEN ['', '.js', '.ts', '.jsx', '.tsx', '/index.js', '/index.ts', '/index.jsx', '/index.tsx']
    ELSE ['.py', '/__init__.py'] END AS tries
FROM lines WHERE skip_reason IS NULL AND internal AND NOT regexp_matches(module, '[+`]|[$][{{]')""",
    "attempts": """
SELECT * EXCLUDE (tries), stem_path || unnest(tries) AS tried, generate_subscripts(tries, 1) AS nth FROM requests""",
    "edges": """
SELECT a.repo_id, a.commit_sha, a.path, a.import, arg_min(a.tried, a.nth) AS target
FROM attempts a JOIN files f ON f.repo_id = a.repo_id AND f.path = a.tried
GROUP BY a.repo_id, a.commit_sha, a.path, a.import""",
    "api_edges": """
SELECT a.repo_id, a.commit_sha, a.path, a.import, arg_min(a.tried, a.nth) AS target
FROM attempts a JOIN sources f ON f.repo_id = a.repo_id AND f.path = a.tried WHERE a.api_internal
GROUP BY a.repo_id, a.commit_sha, a.path, a.import""",
    "event_docs": f"""
SELECT *, {X.EVENT_DOC} AS doc_id FROM events, (SELECT count(*) AS n FROM documents)""",
    "commits": f"""
SELECT f.repo_id, f.commit_sha, f.path, f.lang, CAST(event_id AS VARCHAR) AS sha, {X.AUTHOR} AS author_name,
       {X.MESSAGE} AS message, ts, event_id, event_type FROM event_docs e JOIN files f ON f.doc_id = e.doc_id""",
    "history": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_id, path ORDER BY ts DESC, sha) AS nth
  FROM commits WHERE ts >= TIMESTAMP '2024-02-10' - INTERVAL 90 DAYS) WHERE nth <= 50""",
    "authors": """
SELECT repo_id, path, author_name, n, row_number() OVER (PARTITION BY repo_id, path ORDER BY n DESC, seen) AS nth
FROM (SELECT repo_id, path, author_name, count(*) AS n, min(nth) AS seen FROM history GROUP BY ALL)""",
    "activity": """
SELECT h.repo_id, h.path, count(*) AS n90, count(*) FILTER (h.ts >= TIMESTAMP '2024-01-11') AS n30,
       arg_min(h.sha, h.nth) AS sha, arg_min(h.ts, h.nth) AS ts, arg_min(h.author_name, h.nth) AS author,
       arg_min(h.message, h.nth) AS message,
       (SELECT string_agg(a.author_name, '|' ORDER BY a.nth) FROM authors a
        WHERE a.repo_id = h.repo_id AND a.path = h.path AND a.nth <= 3) AS top
FROM history h GROUP BY h.repo_id, h.path""",
    "resolved": """
SELECT repo_id, path, string_agg(target, '|' ORDER BY target) AS targets FROM edges GROUP BY repo_id, path""",
    "importers": """
SELECT repo_id, target AS path, string_agg(path, '|' ORDER BY path) AS importers, count(*) AS n FROM edges GROUP BY repo_id, target""",
    "misses": """
SELECT l.repo_id, l.path, string_agg(l.module, '|' ORDER BY l.pos) AS missed FROM lines l
WHERE l.internal AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.repo_id = l.repo_id AND e.path = l.path AND e.import = l.module)
GROUP BY l.repo_id, l.path""",
    "outside": """
SELECT repo_id, path, string_agg(DISTINCT module, '|' ORDER BY module) AS names FROM lines WHERE NOT internal GROUP BY repo_id, path""",
    "records": """
SELECT r.repo_id, r.commit_sha, r.path AS file_path,
  CASE WHEN r.content IS NULL THEN r.sha
       ELSE sha1(encode('blob ' || strlen(r.content)) || '\\x00'::BLOB || encode(r.content)) END AS blob_sha,
  substr(sha256(r.path), 1, 12) AS file_path_hash, '1.0.0' AS schema_version, r.language,
  CASE WHEN coalesce(r.content, '') = '' THEN 0 ELSE length(r.content) - length(replace(r.content, chr(10), '')) + 1 END AS line_count,
  coalesce(length(r.content), 0) AS char_count, coalesce(strlen(r.content), 0) AS content_bytes, r.size AS size_bytes,
  array_to_string(r.raw, '|') AS imports_raw, coalesce(t.targets, '') AS imports_internal,
  coalesce(o.names, '') AS imports_external, coalesce(m.missed, '') AS imports_unresolved,
  coalesce(i.importers, '') AS dependents, coalesce(i.n, 0) AS n_dependents, coalesce(a.sha, '') AS most_recent_commit_sha,
  epoch_us(a.ts) AS most_recent_commit_micros, coalesce(a.author, '') AS most_recent_commit_author,
  coalesce(a.message, '') AS most_recent_commit_message, coalesce(a.n30, 0) AS commit_frequency_30d,
  coalesce(a.n90, 0) AS commit_frequency_90d,
  coalesce(CAST(floor((epoch_us(TIMESTAMP '2024-02-10') - epoch_us(a.ts)) / 86400000000) AS INTEGER), -1) AS days_since_last_change,
  coalesce(a.top, '') AS top_contributors,
  r.stem IN ('index', 'main', 'app', 'server') AND r.depth <= 1 AS is_entry_point_candidate,
  len(list_filter(r.dirs, lambda d: d IN ('test', 'tests', '__tests__', 'spec'))) > 0 AS is_in_test_directory,
  r.depth AS relative_depth,
  CASE WHEN a.sha IS NOT NULL THEN 'commit_history|' ELSE '' END
    || CASE WHEN coalesce(r.content, '') <> '' THEN 'file_content|' ELSE '' END || 'file_tree'
    || CASE WHEN len(r.raw) > 0 THEN '|import_parse' ELSE '' END AS determined_by,
  CASE WHEN coalesce(r.content, '') <> '' AND r.language NOT IN ('python', 'javascript', 'typescript', 'java', 'go', 'rust', 'ruby')
       THEN 'import extraction not supported for language: ' || r.language ELSE '' END AS parse_warnings,
  CASE WHEN a.sha IS NULL THEN 'most_recent_commit_sha|most_recent_commit_timestamp|most_recent_commit_author|most_recent_commit_message|days_since_last_change|top_contributors'
       ELSE '' END AS could_not_determine
FROM raws r LEFT JOIN activity a USING (repo_id, path) LEFT JOIN resolved t USING (repo_id, path)
  LEFT JOIN importers i USING (repo_id, path) LEFT JOIN misses m USING (repo_id, path)
  LEFT JOIN outside o USING (repo_id, path) WHERE r.skip_reason IS NULL""",
    "issues": """
SELECT *, list_filter([
  CASE WHEN char_count = 0 THEN 'hard: raw_content is empty — file content could not be fetched' END,
  CASE WHEN language = 'unknown' THEN 'hard: language is unknown — extension not recognized' END,
  CASE WHEN most_recent_commit_sha = '' THEN 'warning: no commit history available' END,
  CASE WHEN imports_raw = '' AND language NOT IN ('json', 'yaml', 'toml', 'markdown', 'shell') THEN 'warning: no imports detected' END,
  CASE WHEN could_not_determine <> '' THEN 'warning: could_not_determine is populated — 6 field(s) defaulted' END
  ], lambda x: x IS NOT NULL) AS issue_list FROM records""",
    "kept": "SELECT * FROM records WHERE content_bytes >= 10",
    "skips": """
SELECT repo_id, skip_reason, count(*) AS n FROM (
  SELECT repo_id, skip_reason FROM flags WHERE skip_reason IS NOT NULL
  UNION ALL SELECT repo_id, 'empty_file' FROM records WHERE content_bytes < 10) GROUP BY ALL""",
    "readmes": rf"""
SELECT repo_id, first(path ORDER BY path) AS readme_path, first(coalesce(content, '') ORDER BY path) AS readme
FROM named WHERE base IN ({strings(C.README_NAMES)}) GROUP BY repo_id""",
    "headers": rf"""
SELECT repo_id, readme_path, readme, list_transform(regexp_extract_all(readme, '(?m)^#{{1,2}}{S}+([^\n]+)', 1),
  lambda h: regexp_replace(regexp_replace(h, '^{S}+', ''), '{S}+$', '')) AS texts FROM readmes""",
    "manifests": f"""
SELECT repo_id, first({cases('base', C.MANIFEST_TYPES)} ORDER BY path) AS manifest_type FROM named
WHERE base IN ({strings(C.MANIFEST_TYPES)}) GROUP BY repo_id""",
    "test_dirs": f"""
SELECT DISTINCT repo_id, array_to_string(dirs[1:list_position(list_transform(dirs, lambda d: d IN ({strings(C.TEST_DIRECTORIES)})), true)], '/') || '/' AS test_directory
FROM named WHERE len(list_filter(dirs, lambda d: d IN ({strings(C.TEST_DIRECTORIES)}))) > 0""",
    "prefixes": """
SELECT repo_id, file_path, array_to_string(string_split(file_path, '/')[1:i], '/') || '/' AS directory
FROM kept, (SELECT unnest(range(1, 12)) AS i) WHERE i <= relative_depth""",
    "repo_records": """
SELECT h.repo_id, h.commit_sha, 'main' AS branch, '1.0.0' AS schema_version, h.total AS total_file_count,
  coalesce(k.n, 0) AS source_file_count,
  (SELECT string_agg(language || '=' || n, '|' ORDER BY language) FROM (SELECT language, count(*) AS n FROM kept x WHERE x.repo_id = h.repo_id GROUP BY language)) AS language_distribution,
  (SELECT string_agg(directory || '=' || n, '|' ORDER BY directory) FROM (SELECT directory, count(*) AS n FROM prefixes x WHERE x.repo_id = h.repo_id GROUP BY directory)) AS directory_structure,
  coalesce(k.deep, 0) AS max_directory_depth, coalesce(length(r.readme), 0) > 0 AS has_readme,
  coalesce(length(r.readme), 0) AS readme_length_chars, coalesce(array_to_string(r.texts, '|'), '') AS readme_headers,
  m.manifest_type IS NOT NULL AS has_package_manifest, m.manifest_type,
  t.dirs IS NOT NULL AS has_test_directory, coalesce(t.dirs, '') AS test_directories,
  coalesce(k.entries, '') AS entry_point_candidates,
  coalesce((SELECT string_agg(file_path, '|' ORDER BY nth) FROM (SELECT file_path, row_number() OVER (ORDER BY commit_frequency_30d DESC, file_path) AS nth FROM kept x WHERE x.repo_id = h.repo_id) WHERE nth <= 5), '') AS most_active_files,
  coalesce((SELECT string_agg(file_path, '|' ORDER BY nth) FROM (SELECT file_path, row_number() OVER (ORDER BY line_count DESC, file_path) AS nth FROM kept x WHERE x.repo_id = h.repo_id) WHERE nth <= 5), '') AS largest_files,
  coalesce(k.n30, 0) AS commit_frequency_30d, coalesce(k.n, 0) AS files_collected, coalesce(s.n, 0) AS files_skipped,
  coalesce(s.reasons, '') AS skip_reasons, '' AS collection_errors,
  CASE WHEN coalesce(k.active, 0) > 0 THEN 'commit_history|' ELSE '' END || 'file_tree'
    || CASE WHEN coalesce(length(r.readme), 0) > 0 THEN '|readme' ELSE '' END AS determined_by
FROM (SELECT repo_id, commit_sha, count(*) AS total FROM files GROUP BY ALL) h
LEFT JOIN (SELECT repo_id, count(*) AS n, max(relative_depth) AS deep, sum(commit_frequency_30d) AS n30,
  count(*) FILTER (commit_frequency_30d > 0) AS active,
  string_agg(file_path, '|' ORDER BY file_path) FILTER (is_entry_point_candidate) AS entries FROM kept GROUP BY repo_id) k USING (repo_id)
LEFT JOIN headers r USING (repo_id) LEFT JOIN manifests m USING (repo_id)
LEFT JOIN (SELECT repo_id, string_agg(test_directory, '|' ORDER BY test_directory) AS dirs FROM test_dirs GROUP BY repo_id) t USING (repo_id)
LEFT JOIN (SELECT repo_id, sum(n) AS n, string_agg(skip_reason || '=' || n, '|' ORDER BY skip_reason) AS reasons FROM skips GROUP BY repo_id) s USING (repo_id)""",
}


EMPTY_ERROR = "path || ': validation failed — hard: raw_content is empty — file content could not be fetched'"

#: Parts that differ in API mode: whole histories, no own package, imports among the source files, and empty files fail.
API_PARTS = {
    "history": PARTS["history"].replace(" WHERE nth <= 50", ""),
    "lines": f"SELECT * REPLACE (api_internal AS internal) FROM ({PARTS['lines']})",
    "edges": PARTS["api_edges"],
    "kept": "SELECT * FROM records WHERE char_count > 0",
    "skips": "SELECT repo_id, skip_reason, count(*) AS n FROM flags WHERE skip_reason IS NOT NULL GROUP BY ALL",
    "failures": f"SELECT repo_id, {EMPTY_ERROR} AS error FROM sources WHERE coalesce(content, '') = ''",
    "repo_records": PARTS["repo_records"].replace(
        "'' AS collection_errors",
        "coalesce((SELECT string_agg(error, '|' ORDER BY error) FROM failures x WHERE x.repo_id = h.repo_id), '') AS collection_errors",
    ),
    "long_entries": """
SELECT repo_id, 'language_distribution' AS kind, 0 AS position, language AS value, count(*) AS n FROM kept GROUP BY ALL
UNION ALL SELECT repo_id, 'directory_structure', 0, directory, count(*) FROM prefixes GROUP BY ALL
UNION ALL SELECT repo_id, 'skip_reasons', 0, skip_reason, n FROM skips
UNION ALL SELECT repo_id, 'test_directories', 0, test_directory, 0 FROM test_dirs
UNION ALL SELECT repo_id, 'entry_point_candidates', 0, file_path, 0 FROM kept WHERE is_entry_point_candidate
UNION ALL SELECT repo_id, 'collection_errors', 0, error, 0 FROM failures
UNION ALL SELECT * FROM (SELECT repo_id, 'most_active_files', row_number() OVER (PARTITION BY repo_id ORDER BY commit_frequency_30d DESC, file_path) AS nth,
  file_path, 0 FROM kept) WHERE nth <= 5
UNION ALL SELECT * FROM (SELECT repo_id, 'largest_files', row_number() OVER (PARTITION BY repo_id ORDER BY line_count DESC, file_path) AS nth,
  file_path, 0 FROM kept) WHERE nth <= 5""",
}


def with_parts(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` preceded by the parts it needs, each behind those that it needs itself."""
    parts = {**PARTS, **(extra or {})}
    needed: dict[str, bool] = {}  # in order; true once all that a part needs stands before it

    def visit(text: str) -> None:
        for name in parts:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed[name] = False
                visit(parts[name])
                needed[name] = needed.pop(name) or True

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in needed) + "\n" + sql
