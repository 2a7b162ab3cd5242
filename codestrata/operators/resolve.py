"""From import texts to files of the repository.

Input rows: one per file with its ``internal`` import array.  Equal targets are probed once: texts
are turned into a base path first, distinct bases get their candidates, candidates meet the
tree in one equi-join, and only then is the answer handed back to the importing files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.functions.paths import import_base, is_path_import
from codestrata.functions.text import contains_any
from codestrata.operators.skew import HOT_ROWS, PART_ROWS, collect_parts, join_hot, list_parts, row_counts
from codestrata.schemas import FILE, KEY
from codestrata.session import materialize, unsent

BASE = [*KEY, "base", "is_path"]


def import_requests(files: DataFrame) -> DataFrame:
    """Distinct, statically known internal imports per file, with the base path they point at."""
    one_each = files.select(*FILE, F.explode(F.array_distinct("internal")).alias("import"))
    return one_each.where(~contains_any(F.col("import"), C.DYNAMIC_MARKS)).select(
        *FILE,
        "import",
        import_base(F.col("path"), F.col("import")).alias("base"),
        is_path_import(F.col("import")).alias("is_path"),
    )


def probe(bases: DataFrame, tree: DataFrame) -> DataFrame:
    """First existing candidate of each base path.  Candidate order decides."""
    suffixes = lambda s: F.array(*[F.lit(x) for x in s])
    tries = F.when(F.col("is_path"), suffixes(["", *C.PATH_SUFFIXES])).otherwise(
        suffixes(C.MODULE_SUFFIXES)
    )
    candidates = bases.select(*BASE, F.posexplode(tries).alias("probe", "suffix")).select(
        *BASE, "probe", F.concat("base", "suffix").alias("path")
    )
    hits = candidates.join(unsent(tree.select(*FILE)), FILE, "inner")
    return hits.groupBy(*BASE).agg(F.min_by("path", "probe").alias("target"))


def resolve_imports(files: DataFrame, tree: DataFrame, floor: int = HOT_ROWS) -> DataFrame:
    """Edges ``(key, path, import, target)``.  ``tree`` holds the paths that count as
    existing: all of them, or the fetched ones only.  Requests and their distinct bases are each
    read several times and costly to derive, so both are written."""
    requests = materialize(import_requests(files), "requests")
    bases = materialize(row_counts(requests, BASE), "bases")
    targets = probe(bases, tree)
    joined = join_hot(requests, targets, BASE, "inner", counts=bases, floor=floor)
    return joined.select(*FILE, "import", "target")


def resolution_scope(tree: DataFrame, fetched: DataFrame, mode: str) -> DataFrame:
    """Paths an import may resolve to: the fetched files (``api``) or the whole tree (``local``)."""
    if mode == "local":
        return tree.select(*FILE)
    return tree.select(*FILE).join(unsent(fetched.select(*FILE)), FILE, "left_semi")


def dependents(edges: DataFrame) -> DataFrame:
    """Reverse edges, one row per importer and import text; no grouping, so no hot target."""
    return edges.select(*KEY, F.col("target").alias("path"), F.col("path").alias("dependent"))


def dependent_lists(edges: DataFrame, size: int = PART_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Per target the number of dependents and the sorted list of the first ``size``; and the further parts of longer lists."""
    return collect_parts(dependents(edges), FILE, "dependent", "dependents", size)


def dependent_parts(edges: DataFrame, size: int = PART_ROWS) -> DataFrame:
    """All dependents of every target as sorted lists of at most ``size``, each with its first and last name."""
    return list_parts(dependents(edges), FILE, "dependent", size)


def dependent_counts(edges: DataFrame) -> DataFrame:
    """How often each file is imported."""
    return dependents(edges).groupBy(*FILE).agg(F.count(F.lit(1)).alias("n_dependents"))


def resolved_by_file(edges: DataFrame) -> DataFrame:
    """Per importing file its ``import -> target`` pairs; bounded by the imports of one file."""
    return edges.groupBy(*FILE).agg(
        F.map_from_entries(F.collect_list(F.struct("import", "target"))).alias("resolved")
    )


def attach_resolution(files: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds ``imports_internal`` (sorted targets) and ``imports_unresolved`` (source order,
    duplicates kept) to each file row."""
    nothing = F.create_map().cast("map<string,string>")
    resolved = F.coalesce(F.col("resolved"), nothing)
    return (
        files.join(unsent(resolved_by_file(edges)), FILE, "left")
        .withColumn("imports_internal", F.array_sort(F.map_values(resolved)))
        .withColumn(
            "imports_unresolved",
            F.filter("internal", lambda i: ~F.map_contains_key(resolved, i)),
        )
        .drop("resolved")
    )


def unresolved_imports(files: DataFrame, edges: DataFrame) -> DataFrame:
    """Internal imports without a file, in source order, one row each."""
    texts = files.select(*FILE, F.posexplode("internal").alias("pos", "import"))
    return texts.join(unsent(edges.select(*FILE, "import")), [*FILE, "import"], "left_anti")
