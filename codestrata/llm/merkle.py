"""Merkle manifest of a table, with octopus multiproofs (operator 13).

Every row is a leaf.  The leaves of one language form a binary tree in the order of their ids, and the languages' roots form one more tree
over them.  Trees are built in tiers: a task hashes a stretch of `SPAN` neighbouring nodes up to its top, and the tops
are the next tier's nodes.  All nodes are stored by ``tree, level, at``.

To prove leaves, each stretch of leaves (a leaf partition) works out the smallest set of nodes that its leaves lack together, that set is fetched
once in a join, and the proofs of the single leaves are expanded from it, shared interior nodes being hashed once."""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codestrata.llm.common import Scratch, small_batches
from codestrata.operators.skew import join_hot

#: Leaves of a stretch are 2 ** STEP.
STEP = 12
#: The tree over the languages' roots; a language's tree is named "=" and the language, the null language's "".
TOP = "*"
#: Rows that go to each stretch beside its missing nodes: marks above every level.
PLACE, SUBROOT, ROOT, UPPER = 61, 62, 63, 64
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def digest(nodes: Iterable[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the nodes of a tree's lowest one."""
    return (n - 1).bit_length()


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row: of each field its length in bytes, a colon and its text, or a dash for null."""

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*map(field, LEAF)), 256)


def leaves(docs: DataFrame, changed: Column | None = None, **fields: Column) -> DataFrame:
    """``tree, lang, doc_id, leaf, held``: ``held`` is the digest of the row with ``fields`` in the rows that are ``changed``, else null."""
    held = F.lit(None).cast("string") if changed is None else F.when(changed, leaf_digest(**fields))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree")
    return docs.select(tree, "lang", "doc_id", leaf_digest().alias("leaf"), held.alias("held"))


def placed(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``at``, their place in their tree from 0 on by ``order`` (nulls first), and ``n``, the rows of the tree.  Rows are sorted
    in ranges, so a large tree is spread over many tasks; only the number of rows of each tree in each range is summed."""
    by = [F.col("tree").asc(), *[F.col(c).asc_nulls_first() for c in order]]
    ranges = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id())
    ranges = scratch.keep(ranges, name).withColumn("range", F.shiftright("row", 33))
    sizes = ranges.groupBy("tree", "range").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumns({"before": F.coalesce(before, F.lit(0)), "n": F.sum("rows").over(tree)}).drop("rows")
    found = ranges.join(offsets, ["tree", "range"])
    return found.withColumn("at", F.col("row") - F.col("first") + F.col("before")).drop("row", "range", "first", "before")


def tree_nodes(lowest: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``tree, level, at, node`` of all nodes of the trees whose lowest nodes are ``lowest`` (tree, at, n, node), written."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        tree, n, level = (group[c][0].as_py() for c in ("tree", "n", "level"))
        at, nodes = group["at"][0].as_py(), group["node"].to_pylist()
        out = [(level, at + i, h) for i, h in enumerate(nodes)] if level == 0 else []
        for step in range(1, min(STEP, height(n)) + 1):
            nodes, at = [digest(nodes[i : i + 2]) for i in range(0, len(nodes), 2)], at >> 1
            out += [(level + step, at + i, h) for i, h in enumerate(nodes)]
        levels, places, hashes = zip(*out)
        return pa.table({"tree": pa.array([tree] * len(out), pa.string()), "level": pa.array(levels, pa.int32()), "at": pa.array(places, pa.int64()), "node": pa.array(hashes, pa.string())})

    tier, done, level = lowest.select("tree", "at", "n", "node").withColumn("level", F.lit(0)), None, 0
    most = lowest.agg(F.max("n")).first()[0] or 0  # one number: of tiers there are a few
    while True:
        stretch = F.shiftright("at", STEP).alias("stretch")
        nodes = tier.groupBy("tree", stretch).applyInArrow(build, "tree string, level int, at long, node string")
        nodes = scratch.keep(nodes, f"{name}-{level}")
        done = nodes if done is None else done.unionByName(nodes)
        if most <= 1 << STEP:
            return done
        most, level = (most - 1 >> STEP) + 1, level + STEP
        sizes = lowest.groupBy("tree").agg((F.shiftright(F.max("n") - 1, level) + 1).alias("n"))
        tier = join_hot(nodes.where(F.col("level") == level), sizes.where("n > 1"), ["tree"], "inner").select("tree", "at", "n", "node", "level")


def top_node(n: str = "n") -> Column:
    """Level of the top of a tree of ``n`` lowest nodes."""
    return F.when(F.col(n) > 1, F.length(F.bin(F.col(n) - 1))).otherwise(0)


def missing(known: set[int], n: int) -> list[tuple[int, int]]:
    """Coordinates that the leaves ``known`` of a tree of ``n`` leaves lack together: of each known node the sibling, unless
    it is known or there is none."""
    out = []
    for level in range(height(n)):
        width = ((n - 1) >> level) + 1
        out += [(level, at ^ 1) for at in sorted(known) if at ^ 1 < width and at ^ 1 not in known]
        known = {at >> 1 for at in known}
    return out


def multiproofs(wanted: DataFrame, nodes: DataFrame, upper: DataFrame | None = None) -> DataFrame:
    """``wanted`` (tree, at, n, node, and any others) with ``siblings``: of each level from the leaf to its tree's top the sibling, null
    where there is none.  Rows of ``upper`` (tree, level, node) go to every leaf of their tree, behind its own levels:
    those from `UPPER` on as further siblings, `PLACE` (a number), `SUBROOT` and `ROOT` as columns ``place``, ``subroot`` and ``root``."""
    wanted = wanted.withColumn("stretch", F.shiftright("at", STEP))
    lacks = "tree string, stretch long, level int, at long"

    def union(group: pa.Table) -> pa.Table:
        tree, n = group["tree"][0].as_py(), group["n"][0].as_py()
        first = group["at"][0].as_py() >> STEP
        levels, places = zip(*(missing(set(group["at"].to_pylist()), n) or [(-1, 0)]))
        return pa.table({"tree": pa.array([tree] * len(levels), pa.string()), "stretch": pa.array([first] * len(levels), pa.int64()), "level": pa.array(levels, pa.int32()), "at": pa.array(places, pa.int64())})

    # a node high up is asked for by all stretches below its sibling: they ask in parts of 2 ** STEP stretches, and
    # the node is handed out once for each part
    asked = wanted.select("tree", "at", "n", "stretch").groupBy("tree", "stretch").applyInArrow(union, lacks)
    asked = asked.withColumn("part", F.when(F.col("level") > 2 * STEP, F.shiftright("stretch", STEP)).otherwise(F.lit(0)))
    parts = "IF(level > {0}, sequence(shiftleft(at ^ 1, level - {0}), shiftleft((at ^ 1) + 1, level - {0}) - 1), array(0L))".format(2 * STEP)
    handed = nodes.withColumn("part", F.explode(F.expr(parts)))
    fetched = asked.join(handed, ["tree", "level", "at", "part"]).select("tree", "stretch", "level", "at", "node")
    if upper is not None:
        levels = upper.groupBy("tree").agg(F.collect_list(F.struct("level", "node")).alias("upper"))  # a tree's own path: at most 64 rows
        stretches = wanted.select("tree", "stretch").distinct()
        given = join_hot(stretches, levels, ["tree"], "inner").select("tree", "stretch", F.explode("upper").alias("u"))
        fetched = fetched.unionByName(given.select("tree", "stretch", "u.level", F.lit(0).cast("long").alias("at"), "u.node"))

    fields = [f for f in wanted.schema.fields if f.name != "stretch"]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    added = {"siblings": pa.list_(pa.string()), "place": pa.int64(), "subroot": pa.string(), "root": pa.string()}

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.select([f.name for f in fields])
        columns: dict[str, list] = {name: [] for name in added}
        if rows.num_rows:
            n = rows["n"][0].as_py()
            store = dict(zip(zip(right["level"].to_pylist(), right["at"].to_pylist()), right["node"].to_pylist()))
            above = [store[k] for k in sorted(k for k in store if k[0] >= UPPER)]
            place, *tops = [store.get((mark, 0)) for mark in (PLACE, SUBROOT, ROOT)]
            place = None if place is None else int(place)
            places = rows["at"].to_pylist()
            known = dict(zip(places, rows["node"].to_pylist()))
            for level in range(height(n)):
                store.update({(level, at): h for at, h in known.items()})
                known = {at >> 1: digest(store[level, k] for k in (at & ~1, at | 1) if (level, k) in store) for at in known}
            for at in places:
                columns["siblings"].append([store.get((level, at >> level ^ 1)) for level in range(height(n))] + above)
                columns["place"].append(place)
                columns["subroot"].append(tops[0])
                columns["root"].append(tops[1])
        for name, kind in added.items():
            rows = rows.append_column(name, pa.array(columns[name], kind))
        return rows

    pairs = wanted.groupBy("tree", "stretch").cogroup(fetched.groupBy("tree", "stretch"))
    return pairs.applyInArrow(expand, f"{out}, siblings array<string>, place long, subroot string, root string")


class Manifest:
    """The manifest of a table, stored as Parquet under ``path``: ``leaves`` (tree, lang, doc_id, leaf, held, at, n), ``nodes-*`` and ``tops-*``
    (tree, level, at, node)."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        small_batches(spark, 10_000)
        self.scratch = Scratch(spark, "manifest")
        if path is not None:
            self.scratch.path = path.rstrip("/")

    def write(self, docs: DataFrame, changed: Column | None = None, **fields: Column) -> Manifest:
        """Hashes all rows of ``docs`` and all trees above them."""
        keep = self.scratch.keep
        self.leaves = keep(placed(leaves(docs, changed, **fields), ["doc_id", "leaf"], self.scratch, "sorted"), "leaves")
        self.scratch.drop("sorted")
        self.nodes = tree_nodes(self.leaves.withColumnRenamed("leaf", "node"), self.scratch, "nodes")
        sizes = self.leaves.groupBy("tree").agg(F.max("n").alias("n"))
        foremost = self.nodes.where(F.col("at") == 0)  # one of each level
        subroots = foremost.join(sizes, "tree").where(F.col("level") == top_node())
        named = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "node")
        self.subroots = keep(placed(named, ["of"], self.scratch, "tops-sorted"), "tops")
        self.tops = tree_nodes(self.subroots, self.scratch, "tops-nodes")
        return self

    def root(self) -> str | None:
        """The root; None of an empty table."""
        n = self.subroots.agg(F.max("n")).first()[0]
        return self.tops.where(F.col("level") == height(n)).first().node if n else None

    def prove(self, wanted: DataFrame | None = None) -> DataFrame:
        """The ``wanted`` rows of ``leaves`` (all by default) with ``siblings`` (null at levels without), ``place`` (of their tree in the upper one), ``subroot`` and ``root``."""
        root = self.root()
        paths = multiproofs(self.subroots, self.tops)
        above = paths.select(F.col("of").alias("tree"), "at", F.posexplode("siblings").alias("level", "node"))
        above = above.select("tree", (F.col("level") + UPPER).alias("level"), "node")
        own = self.subroots.select(F.col("of").alias("tree"), F.lit(SUBROOT).alias("level"), "node")
        upper = above.unionByName(own).unionByName(own.select("tree", F.lit(ROOT).alias("level"), F.lit(root).alias("node")))
        upper = upper.unionByName(paths.select(F.col("of").alias("tree"), F.lit(PLACE).alias("level"), F.col("at").cast("string").alias("node")))
        rows = (self.leaves if wanted is None else wanted).withColumnRenamed("leaf", "node")
        return multiproofs(rows, self.nodes, self.scratch.keep(upper, "upper")).withColumnRenamed("node", "leaf")


def folded(proofs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of rows of `Manifest.prove`: ``folded_root`` is
    hashed from ``held`` (or the leaf where that is null) and the siblings."""

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            names = ("leaf", "held", "at", "place", "n", "siblings")
            proof, roots = [], []
            for leaf, held, at, above, n, siblings in zip(*(batch.column(c).to_pylist() for c in names)):
                node, levels = held or leaf, height(n)
                for level, other in enumerate(siblings):
                    here = at >> level if level < levels else above >> level - levels
                    node = digest([node] if other is None else [other, node] if here & 1 else [node, other])
                proof.append(digest(s for s in siblings if s is not None))
                roots.append(node)
            same = [a == b for a, b in zip(roots, batch.column("root").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "leaf", "subroot", "root")), pa.array(proof, pa.string()), pa.array(roots, pa.string()), pa.array(same, pa.bool_())],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    kind = proofs.schema["doc_id"].dataType.simpleString()
    return proofs.select("doc_id", "leaf", "held", "at", "place", "n", "siblings", "subroot", "root").mapInArrow(
        fold, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


def audit(docs: DataFrame, changed: Column, **fields: Column) -> DataFrame:
    """Writes the manifest of ``docs``, proves every row and folds the proofs with the rows as they are held now: ``fields`` in those that
    are ``changed``.  Columns as of `folded`.

    A null in any column, also in the id, is hashed as a dash; such rows come first in their language, the null language first of all.  Rows of
    one id are ordered by digest, equal rows are leaves each.  Other columns are not read.  An empty table gives no rows."""
    manifest = Manifest(docs.sparkSession).write(docs, changed, **fields)
    return folded(manifest.prove())
