"""Which files and which snapshots are worked on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.functions import constants as C
from codestrata.functions import paths as P
from codestrata.operators.skew import first_rows, join_hot, join_listed
from codestrata.operators.structure import tree_order
from codestrata.schemas import FILE, KEY
from codestrata.session import materialize, unsent


def with_skip_reason(tree: DataFrame) -> DataFrame:
    return tree.withColumn("skip_reason", P.skip_reason(F.col("path"), F.col("size")))


def source_files(tree: DataFrame) -> DataFrame:
    return tree.where(P.skip_reason(F.col("path"), F.col("size")).isNull())


def source_paths(tree: DataFrame) -> DataFrame:
    """Collectable paths, sorted within each snapshot."""
    return source_files(tree).select(*FILE).orderBy(*FILE)


def cap_files(sources: DataFrame, max_files: int | None) -> DataFrame:
    """The first ``max_files`` source rows per snapshot in listing order."""
    if max_files is None:
        return sources
    order = [tree_order(sources).asc()]
    return first_rows(sources, KEY, order, max_files, "_rank").drop("_rank")


def with_empty_file_reason(files: DataFrame) -> DataFrame:
    """Marks files with fewer than ten content bytes; unreadable files have none."""
    small = F.coalesce(F.octet_length("content"), F.lit(0)) < C.MIN_FILE_BYTES
    return files.withColumn("skip_reason", F.when(small, F.lit("empty_file")))


def target_files(changed: DataFrame, tree: DataFrame) -> DataFrame:
    """Changed names looked up in the tree: names without an entry are ``not_in_tree``, the
    rest still pass the source-file test."""
    entries = tree.select(*FILE, "sha", "size", F.lit(True).alias("_found"))
    joined = changed.select(*FILE).distinct().join(unsent(entries), FILE, "left")
    reason = F.when(F.col("_found").isNull(), F.lit("not_in_tree")).otherwise(
        P.skip_reason(F.col("path"), F.col("size"))
    )
    return joined.withColumn("skip_reason", reason).drop("_found")


def changed_files(parent: DataFrame, head: DataFrame, on: list[str]) -> DataFrame:
    """Names that differ between two trees, with the kind of change.  ``on`` identifies a file
    in both (repository and path, plus the head commit where there are several)."""
    old = parent.select(*on, F.col("sha").alias("old_sha"))
    new = head.select(*on, F.col("sha").alias("new_sha"))
    both = old.join(new, on, "full").where(~F.col("old_sha").eqNullSafe(F.col("new_sha")))
    kind = (
        F.when(F.col("old_sha").isNull(), F.lit("added"))
        .when(F.col("new_sha").isNull(), F.lit("deleted"))
        .otherwise(F.lit("modified"))
    )
    return both.select(*on, kind.alias("change"))


def directory_digests(tree: DataFrame, on: list[str]) -> DataFrame:
    """``level, directory, n, digest`` of every directory of every tree (``on`` without the path), the root being level 0: a sum over
    the files below it that does not depend on their order.  To be stored with the tree, once for each commit."""
    key = [c for c in on if c != "path"]
    levels = F.concat(F.array(F.lit("")), P.ancestor_prefixes(F.col("path")))
    file = lambda seed: F.xxhash64(F.lit(seed), "path", "sha")
    rows = tree.select(*key, F.posexplode(levels).alias("level", "directory"), file(1).alias("a"), file(2).alias("b"))
    digest = F.struct(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    return rows.groupBy(*key, "level", "directory").agg(F.count(F.lit(1)).alias("n"), digest.alias("digest"))


def changed_files_by_digest(
    parent: DataFrame, head: DataFrame, on: list[str], parent_digests: DataFrame, head_digests: DataFrame
) -> DataFrame:
    """:func:`changed_files`, comparing only what lies in directories that changed.  The digests are met level by level from the root, and
    where two are equal, nothing below is looked at: rows compared follow the change and not the tree."""
    key = [c for c in on if c != "path"]
    at = [*key, "directory"]
    deepest = max((d.agg(F.max("level")).first()[0] or 0 for d in (parent_digests, head_digests)), default=0)
    above, touched = None, None
    for level in range(deepest + 1):
        old, new = (
            d.where(F.col("level") == level).select(*at, F.struct("n", "digest").alias(name)) for d, name in ((parent_digests, "_old"), (head_digests, "_new"))
        )
        if above is not None:
            up = F.regexp_replace("directory", "[^/]+/$", "")
            old, new = (d.withColumn("_up", up).join(above, [*[F.col(c).eqNullSafe(F.col(f"_a_{c}")) for c in key], F.col("_up") == F.col("_a_directory")], "left_semi").drop("_up") for d in (old, new))
        differ = materialize(old.join(new, at, "full").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(*at), f"differ_{level}")
        touched = differ if touched is None else touched.unionByName(differ)
        above = differ.select(*[F.col(c).alias(f"_a_{c}") for c in at])
        if differ.isEmpty():
            break
    here = F.regexp_replace("path", "[^/]*$", "").alias("directory")
    inside = lambda tree: join_listed(tree.select(*on, "sha", here), touched, at, "left_semi").drop("directory")
    return changed_files(inside(parent), inside(head), on)


def collection_mode(heads: DataFrame, collected: DataFrame, forced: bool = False) -> DataFrame:
    """``incremental`` for repositories with an earlier artifact, else ``full``.  A head without
    a parent (``parent_sha`` null, where the column exists) is ``full`` as well."""
    known = collected.select("repo_id").distinct().withColumn("_known", F.lit(True))
    full = F.lit(forced)
    if "parent_sha" in heads.columns:
        full = full | F.col("parent_sha").isNull()
    joined = join_hot(heads, known, ["repo_id"], "left")
    mode = F.when(full | F.col("_known").isNull(), F.lit("full")).otherwise(F.lit("incremental"))
    return joined.withColumn("mode", mode).drop("_known")


def snapshot_head(commits: DataFrame) -> DataFrame:
    """Latest commit per repository and branch; ties by the larger id."""
    newest = F.max_by("commit_sha", F.struct("committed_at", "commit_sha"))
    return commits.groupBy("repo_id", "branch").agg(
        newest.alias("commit_sha"), F.max("committed_at").alias("committed_at")
    )


def split_heads(heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable heads, and those without a commit id (fatal for that snapshot only)."""
    missing = F.coalesce(F.col("commit_sha"), F.lit("")) == ""
    return heads.where(~missing), heads.where(missing)
