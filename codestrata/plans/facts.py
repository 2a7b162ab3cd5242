"""File records and repository records from narrow inputs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.functions import paths as P
from codestrata.functions.imports import classify, warnings
from codestrata.functions.text import empty_strings
from codestrata.operators import history as H
from codestrata.operators import resolve as R
from codestrata.operators import structure as S
from codestrata.operators import validate as V
from codestrata.operators.skew import PART_ROWS, collect_parts, first_rows, join_listed
from codestrata.schemas import FILE, KEY
from codestrata.session import materialize, unsent


def classified(fetched: DataFrame, tree: DataFrame, mode: str) -> DataFrame:
    """Adds ``internal`` and ``external``.  In ``local`` mode absolute imports of the
    repository's own package are internal; only Python rows need to know that package."""
    if mode == "local":
        # one short row a snapshot: files stay where they are while those are few
        packages = materialize(S.top_level_package(tree), "packages")
        fetched = join_listed(fetched, packages, KEY, "left")
    else:
        fetched = fetched.withColumn("package", F.lit(None).cast("string"))
    parts = classify(F.col("imports_raw"), F.col("language"), F.col("package"))
    return fetched.withColumn("_c", parts).select(
        *[c for c in fetched.columns if c != "package"],
        F.col("_c.internal").alias("internal"),
        F.col("_c.external").alias("external"),
    )


def fetch(selected: DataFrame, parsed: DataFrame) -> DataFrame:
    """Selected tree entries with their parse results; a file without content is an unreadable
    one and keeps the tree's id."""
    narrow = parsed.drop("language", "readme_headers")
    joined = selected.select(*FILE, "sha", "size").join(unsent(narrow), FILE, "left")
    zero = F.lit(0)
    return joined.select(
        *FILE,
        F.coalesce(F.nullif("blob_sha", F.lit("")), "sha").alias("blob_sha"),
        P.language(F.col("path")).alias("language"),
        F.coalesce("line_count", zero).alias("line_count"),
        F.coalesce("char_count", zero).alias("char_count"),
        F.coalesce("content_bytes", zero).alias("content_bytes"),
        F.coalesce("size", "content_bytes", zero).cast("bigint").alias("size_bytes"),
        F.coalesce("imports_raw", empty_strings()).alias("imports_raw"),
    )


def file_facts(
    fetched: DataFrame, edges: DataFrame, dependents: DataFrame, history: DataFrame, as_of: Column
) -> DataFrame:
    """The file record without its content (see :func:`with_content`), plus ``n_dependents``,
    ``content_bytes``, the source text of the latest commit time, and the first commit time that
    could not be read.

    ``fetched`` carries ``internal``/``external``; ``edges`` come from the resolution, ``dependents`` from
    :func:`codestrata.operators.resolve.dependent_lists`, ``history`` from
    :func:`codestrata.operators.history.file_history`.  All joins are on the file, so no repository is a hot key."""
    joined = (
        R.attach_resolution(fetched, edges)
        .join(unsent(history), FILE, "left")
        .join(unsent(dependents), FILE, "left")
    )
    path = F.col("path")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    n_dependents = F.coalesce(F.col("n_dependents"), F.lit(0))
    record = joined.select(
        *KEY,
        path.alias("file_path"),
        "blob_sha",
        P.path_hash(path).alias("file_path_hash"),
        F.lit(C.SCHEMA_VERSION).alias("schema_version"),
        as_of.alias("fetched_at"),
        "language",
        "line_count",
        "char_count",
        "content_bytes",
        "size_bytes",
        "imports_raw",
        "imports_internal",
        F.array_sort(F.array_distinct("external")).alias("imports_external"),
        "imports_unresolved",
        F.coalesce("dependents", empty_strings()).alias("dependents"),
        n_dependents.cast("bigint").alias("n_dependents"),
        text("most_recent_commit_sha"),
        "most_recent_commit_timestamp",
        "most_recent_commit_timestamp_raw",
        text("most_recent_commit_author"),
        text("most_recent_commit_message"),
        count("commit_frequency_30d"),
        count("commit_frequency_90d"),
        F.coalesce("days_since_last_change", F.lit(-1)).alias("days_since_last_change"),
        F.coalesce("top_contributors", empty_strings()).alias("top_contributors"),
        P.is_entry_point(path).alias("is_entry_point_candidate"),
        P.is_in_test_directory(path).alias("is_in_test_directory"),
        P.depth(path).alias("relative_depth"),
        warnings(F.col("char_count"), F.col("language")).alias("parse_warnings"),
        "unreadable_commit_time",
    )
    return record.withColumns(
        {"determined_by": V.file_determined_by(), "could_not_determine": V.could_not_determine()}
    )


def with_content(files: DataFrame, contents: DataFrame) -> DataFrame:
    """Records with ``raw_content``: the only join that moves content.  Keep ``contents`` bucketed
    by file (see ``codestrata.sources.artifacts.save_contents``) and it stays where it is."""
    texts = contents.select(
        *KEY, F.col("path").alias("file_path"), F.coalesce("content", F.lit("")).alias("raw_content")
    )
    return files.join(unsent(texts), [*KEY, "file_path"], "left")


def tree_facts(tree: DataFrame) -> DataFrame:
    """Size, first README and first manifest of each tree, in one pass."""
    path = F.col("path")
    order = S.tree_order(tree)
    first = lambda value, test: F.min_by(F.when(test, value), F.when(test, order))
    return tree.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("total_file_count"),
        first(path, P.is_readme(path)).alias("readme_path"),
        first(P.manifest_type(path), P.manifest_type(path).isNotNull()).alias("manifest_type"),
    )


def repo_entries(
    tree: DataFrame, files: DataFrame, skipped: DataFrame, errors: DataFrame
) -> DataFrame:
    """All lists and maps of the repository records as one long table
    ``(key, kind, entry)``, ``entry`` being ``(position, value, n)``.  Entries sort as they are listed."""

    def entry(rows: DataFrame, kind: str, value: str, n="0", position="0") -> DataFrame:
        parts = F.struct(
            F.expr(position).cast("bigint").alias("position"),
            F.col(value).alias("value"),
            F.expr(n).cast("bigint").alias("n"),
        )
        return rows.select(*KEY, F.lit(kind).alias("kind"), parts.alias("entry"))

    paths = files.select(*KEY, F.col("file_path").alias("path"), "language", "line_count",
                         "commit_frequency_30d")
    # both rankings in one window: each file stands once per measure
    measures = F.explode(
        F.array(
            F.struct(F.lit("most_active_files").alias("kind"),
                     F.col("commit_frequency_30d").alias("size")),
            F.struct(F.lit("largest_files").alias("kind"),
                     F.col("line_count").cast("bigint").alias("size")),
        )
    ).alias("m")
    measured = paths.select(*KEY, "path", measures).select(*KEY, "path", "m.kind", "m.size")
    order = [F.col("size").desc(), F.col("path").asc()]
    ranked = first_rows(measured, [*KEY, "kind"], order, C.TOP_FILES)
    places = F.struct(F.col("rank").cast("bigint").alias("position"), F.col("path").alias("value"),
                      F.lit(0).cast("bigint").alias("n"))
    tables = [
        entry(S.language_distribution(paths), "language_distribution", "language", "n_files"),
        entry(S.directory_structure(paths), "directory_structure", "directory", "n_files"),
        entry(skipped, "skip_reasons", "skip_reason", "n_files"),
        entry(S.test_directories(tree), "test_directories", "test_directory"),
        entry(S.entry_point_candidates(paths), "entry_point_candidates", "path"),
        entry(errors, "collection_errors", "error"),
    ]
    stacked = ranked.select(*KEY, "kind", places.alias("entry"))
    for table in tables:
        stacked = stacked.unionByName(table)
    return stacked


ENTRY_LISTS = [
    "test_directories", "entry_point_candidates", "collection_errors", "most_active_files",
    "largest_files",
]
ENTRY_MAPS = ["language_distribution", "directory_structure", "skip_reasons"]


PART_COLUMNS = [*KEY, "path", "kind", "part", "first", "last", "n", "items"]


def repo_lists(entries: DataFrame, size: int = PART_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Long entries -> one row per snapshot with the lengths of all lists and maps and their first ``size`` entries; and
    the further parts of longer ones, as :func:`more_entries`."""
    lists, more = collect_parts(entries, [*KEY, "kind"], "entry", "entries", size)
    pick = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    one_row = lists.groupBy(*KEY).agg(
        *[pick(k, "n_entries").alias(f"n_{k}") for k in ENTRY_LISTS + ENTRY_MAPS],
        *[F.max_by("entries", F.when(F.col("kind") == k, F.lit(1))).alias(k)
          for k in ENTRY_LISTS + ENTRY_MAPS],
    )
    values = lambda k: F.transform(k, lambda e: e["value"])
    pairs = lambda k: F.map_from_entries(
        F.transform(k, lambda e: F.struct(e["value"], e["n"]))
    )
    record = one_row.select(
        *KEY,
        *[f"n_{k}" for k in ENTRY_LISTS + ENTRY_MAPS],
        *[values(k).alias(k) for k in ENTRY_LISTS],
        *[pairs(k).alias(k) for k in ENTRY_MAPS],
    )
    return record, None if more is None else more_entries(more)


def more_entries(parts: DataFrame) -> DataFrame:
    """Parts of repository lists as rows of the table of parts."""
    items = F.transform("items", lambda e: F.struct(e["value"].alias("value"), e["n"].alias("n")))
    return parts.select(
        *KEY, F.lit(None).cast("string").alias("path"), "kind", "part", F.col("first.value").alias("first"),
        F.col("last.value").alias("last"), "n", items.alias("items"),
    )


def more_dependents(parts: DataFrame) -> DataFrame:
    """Parts of dependents' lists as rows of the table of parts."""
    items = F.transform("items", lambda v: F.struct(v.alias("value"), F.lit(0).cast("bigint").alias("n")))
    return parts.select(*KEY, "path", F.lit("dependents").alias("kind"), "part", "first", "last", "n", items.alias("items"))


def repo_facts(
    snapshots: DataFrame,
    tree: DataFrame,
    parsed: DataFrame,
    files: DataFrame,
    entries: DataFrame,
    lists: DataFrame,
    as_of: Column,
) -> DataFrame:
    """The repository record plus the true lengths ``n_*`` of its open-ended lists.

    ``files`` are valid file records, ``entries`` come from :func:`repo_entries`, ``lists`` from :func:`repo_lists`.  Each
    part is aggregated to one row per snapshot before it is joined."""
    file_totals = files.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("files_collected"),
        F.max("relative_depth").alias("max_directory_depth"),
        F.sum("commit_frequency_30d").alias("commit_frequency_30d"),
        F.count_if(F.col("commit_frequency_30d") > 0).alias("active_files"),
    )
    skip_rows = entries.where(F.col("kind") == "skip_reasons")
    skip_totals = skip_rows.groupBy(*KEY).agg(F.sum("entry.n").alias("files_skipped"))
    readmes = parsed.where(P.is_readme(F.col("path"))).select(
        *KEY,
        F.col("path").alias("readme_path"),
        F.col("char_count").alias("readme_length_chars"),
        "readme_headers",
    )
    joined = (
        snapshots.select(*KEY, "branch")
        .join(tree_facts(tree), KEY, "left")
        .join(unsent(readmes), [*KEY, "readme_path"], "left")
        .join(file_totals, KEY, "left")
        .join(skip_totals, KEY, "left")
        .join(lists, KEY, "left")
    )
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    listed = lambda c: F.coalesce(F.col(c), empty_strings()).alias(c)
    mapped = lambda c: F.coalesce(F.col(c), F.create_map().cast("map<string,bigint>")).alias(c)
    record = joined.select(
        *KEY,
        "branch",
        as_of.alias("fetched_at"),
        F.lit(C.SCHEMA_VERSION).alias("schema_version"),
        number("total_file_count"),
        F.coalesce("files_collected", F.lit(0)).alias("source_file_count"),
        mapped("language_distribution"),
        mapped("directory_structure"),
        number("max_directory_depth"),
        (F.coalesce("readme_length_chars", F.lit(0)) > 0).alias("has_readme"),
        number("readme_length_chars"),
        F.coalesce("readme_headers", empty_strings()).alias("readme_headers"),
        F.col("manifest_type").isNotNull().alias("has_package_manifest"),
        "manifest_type",
        F.col("n_test_directories").isNotNull().alias("has_test_directory"),
        listed("test_directories"),
        listed("entry_point_candidates"),
        listed("most_active_files"),
        listed("largest_files"),
        number("commit_frequency_30d"),
        number("files_collected"),
        number("files_skipped"),
        mapped("skip_reasons"),
        listed("collection_errors"),
        number("active_files"),
        F.coalesce("n_entry_point_candidates", F.lit(0)).alias("n_entry_points"),
        number("n_collection_errors"),
        F.coalesce("n_directory_structure", F.lit(0)).alias("n_directories"),
        number("n_test_directories"),
    )
    return record.withColumn("determined_by", V.repo_determined_by())
