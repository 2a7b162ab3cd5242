"""N-gram Jaccard join by a count-vector R-tree (operator 8).

A document's set are its distinct shingles of ``size`` words.  Documents of equal sets are one node.  A node's shingles are hashed into
``GROUPS`` groups; the group counts are its point.  Two nodes share at most the sum of the smaller counts, and boxes of points bound that by
the boxes' larger corners, so a search passes over boxes and points whose bound is below what a similarity of ``least`` percent needs.  What is left is verified on the sets.

The tree is rooted in regions: a region is a shingle, and holds the nodes that have it among their first ones in an order of all
shingles, rare ones first; linked nodes always share a region (they would else differ in too many shingles).  In a
region nodes are put into leaves, whose boxes are joined pairwise.  Links to a region's pivot are verified first, and the leaves are
searched for pairs of nodes that these have not joined yet: components need no more, so a family of copies costs one link a
node and not one a pair, and no link between different components is lost.  Links are then counted inside the components, where all of
them are: every pair of a component's nodes is compared by its sets, leaf by leaf, and only counts leave a pair of leaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codestrata.llm import spans
from codestrata.llm.common import Scratch, shuffle_partitions, small_batches
from codestrata.llm.components import labels

GROUPS = 64
CELLS = 1 << 20  # counters of the shingles' frequency, over all documents; four MB, whatever their number
SLICES = 64
LEAF = 512
LEAF_SHINGLES = 50_000  # in a leaf whose pairs are counted, but for its last set
COLUMNS = 4096  # shingles of two leaves that are compared at a time
TOGETHER = 100_000  # bytes of short texts that are hashed at a time
#: Links that are tried for a node before the search.
PIVOTS = 4
#: Nodes of a region that are looked at in one place; larger regions are dealt out to several.
REGION = 4096
#: Candidate nodes up to this number (eight bytes each) are broadcast to the scan that fetches their sets.
BROADCAST_NODES = 2_000_000

U8, I8 = np.dtype("<u8"), np.dtype("<i8")


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; of fewer words, the whole sequence is one shingle."""
    split = [(t or "").encode().lower().split() for t in texts]
    out = [np.zeros(0, np.uint64)] * len(split)
    at = 0
    while at < len(split):  # some texts at a time
        to, total = at, 0
        while to < len(split) and (to == at or total < TOGETHER):
            total += sum(map(len, split[to])) + len(split[to])
            to += 1
        some = [i for i in range(at, to) if split[i]]
        if some:
            raw = np.frombuffer(b"\n".join([b" ".join(split[i]) for i in some]) + b"\n", np.uint8)
            over = spans.Prefix(raw.astype(np.uint64))
            end = np.flatnonzero((raw == 32) | (raw == 10))
            start = np.concatenate([[0], end[:-1] + 1])
            word = 0
            for i in some:
                n = len(split[i])
                first = np.arange(word, word + max(1, n - size + 1))
                last = np.minimum(first + size, word + n) - 1
                out[i] = np.unique(over.of(start[first], end[last]))
                word += n
        at = to
    return out


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    seed = np.array([len(shingles)], np.uint64)
    return int(spans.mixed(seed + spans.mixed(shingles * np.uint64(spans.BASE)).sum(dtype=np.uint64)).view(np.int64)[0])


def point(fine: np.ndarray) -> np.ndarray:
    return fine.reshape(GROUPS, -1).sum(axis=1).astype(np.int32)


def finer(shingles: np.ndarray) -> np.ndarray:
    """The counts in one to two groups a shingle: what two texts do not share then seldom meets in a group."""
    bits = max(6, min(20, len(shingles).bit_length()))
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u4")


def unpacked(fine: list[bytes]) -> list[np.ndarray]:
    import zstandard

    restore = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(restore(f), "<u4") for f in fine]


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """The bound of two nodes' finer points; the finer one is folded to the other's groups."""
    if len(a) > len(b):
        a, b = b, a
    return int(np.minimum(a, b.reshape(len(a), -1).sum(axis=1)).sum())


def region_keys(shingles: np.ndarray, cells: np.ndarray, least: int) -> np.ndarray:
    """The first shingles, rarest first, of which linked sets share one."""
    n = len(shingles)
    first = n - -(-least * n // 100) + 1
    order = np.lexsort((shingles, cells[(shingles & np.uint64(CELLS - 1)).astype(np.int64)]))
    return shingles[order[:first]]


def scanned(docs: DataFrame, text: str, size: int) -> DataFrame:
    """One row a document (``doc_id, n, node, fine``), and slices of each task's shingle counts (``slice, counts``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32()}[kind]
    schema = pa.schema([("doc_id", id_type), ("n", pa.int64()), ("node", pa.int64()), ("fine", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary())])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), size)
            for s in sets:
                np.add.at(cells, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
            rows = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([squeeze(finer(s).tobytes()) for s in sets], pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                ],
                schema=schema,
            )
        if cells.any():
            parts = [squeeze(p.astype("<u4").tobytes()) for p in np.minimum(cells, 0xFFFFFFFF).reshape(SLICES, -1)]
            empty = [pa.nulls(SLICES, schema.field(i).type) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    return docs.select("doc_id", text).mapInArrow(scan, f"doc_id {kind}, n long, node long, fine binary, slice int, counts binary")


def summed_cells(rows: DataFrame) -> np.ndarray:
    """All tasks' counts added up, slice by slice; the driver gets ``CELLS`` numbers."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        restore = zstandard.ZstdDecompressor().decompress
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[at] = total.get(at, 0) + np.frombuffer(restore(counts), "<u4").astype(np.int64)
        for at, counts in total.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "counts": [np.minimum(counts, 0xFFFFFFFF).astype("<u4").tobytes()]})

    parts = rows.where("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary").collect()
    cells = np.zeros((SLICES, CELLS // SLICES), np.int64)
    for p in parts:
        cells[p.slice] += np.frombuffer(p.counts, "<u4")
    return np.minimum(cells.ravel(), 0xFFFFFFFF).astype("<u4")


ENTRIES = "bucket int, keys binary, nodes binary, sizes binary, salts binary"


def entries(docs: DataFrame, text: str, size: int, least: int, cells: np.ndarray, buckets: int) -> DataFrame:
    """Region keys and their nodes, packed by bucket; a region that is frequent is dealt to several buckets by node."""
    shared = docs.sparkSession.sparkContext.broadcast(cells.tobytes())  # four MB

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        counts = np.frombuffer(shared.value, "<u4")
        squeeze = zstandard.ZstdCompressor(level=3).compress
        held: dict[int, tuple[np.ndarray, int]] = {}
        size_held = 0

        def out() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            keys = np.concatenate([k for k, _ in held.values()])
            each = np.array([len(k) for k, _ in held.values()])
            nodes = np.repeat(np.array(list(held), np.int64), each)
            sizes = np.repeat(np.array([n for _, n in held.values()], np.int64), each)
            several = 1 + counts[(keys & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.int64) // REGION
            salts = np.where(several > 1, 1 + (nodes & 0x7FFFFFFF) % several, 0)
            bucket = (spans.mixed(keys + salts.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((keys, bucket))
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0]))
            for at, to in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                own = order[at:to]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([int(bucket[own[0]])], pa.int32()), "keys": [squeeze(keys[own].astype(U8).tobytes())],
                        "nodes": [squeeze(nodes[own].astype(I8).tobytes())], "sizes": [squeeze(sizes[own].astype("<u4").tobytes())],
                        "salts": [squeeze(salts[own].astype("<u4").tobytes())],
                    }
                )

        for batch in batches:
            for s in shingle_sets(batch.column(0).to_pylist(), size):
                if len(s) and (node := node_of(s)) not in held:
                    held[node] = (region_keys(s, counts, least), len(s))
                    size_held += len(held[node][0])
            if size_held >= 1_000_000:
                yield from out()
                held.clear()
                size_held = 0
        yield from out()

    return docs.select(text).mapInArrow(deal, ENTRIES)


def regions(packed: DataFrame, least: int) -> DataFrame:
    """``region, part, node``: nodes of every region with more than one node, in parts that sizes cannot link across.  Regions of
    the same nodes are given once a bucket."""

    def bucket(table: pa.Table) -> pa.Table:
        import zstandard

        restore = zstandard.ZstdDecompressor().decompress
        column = lambda c, t: np.concatenate([np.frombuffer(restore(v.as_py()), t) for v in table.column(c)])
        keys, nodes, sizes, salts = column("keys", U8), column("nodes", I8), column("sizes", "<u4").astype(np.int64), column("salts", "<u4")
        order = np.lexsort((nodes, sizes, salts, keys))
        keys, nodes, sizes, salts = keys[order], nodes[order], sizes[order], salts[order]
        same_key = (keys[1:] == keys[:-1]) & (salts[1:] == salts[:-1])
        new = np.concatenate([[True], ~same_key | (nodes[1:] != nodes[:-1])]) if len(keys) else np.zeros(0, bool)
        keys, nodes, sizes, salts = keys[new], nodes[new], sizes[new], salts[new]
        apart = (keys[1:] != keys[:-1]) | (salts[1:] != salts[:-1]) | ((100 * sizes[:-1] < least * sizes[1:]) & (salts[1:] == 0))
        at = np.flatnonzero(np.concatenate([[True], apart])) if len(keys) else np.zeros(0, np.int64)
        to = np.append(at[1:], len(keys))
        names = spans.mixed(nodes.view(np.uint64))
        seen: set[tuple[int, int]] = set()
        out = []
        for a, b in zip(at.tolist(), to.tolist()):
            if salts[a] == 0:
                mark = (b - a, int(names[a:b].sum(dtype=np.uint64)))
                if b - a < 2 or mark in seen:
                    continue
                seen.add(mark)
            out.append((a, b))
        rows = np.concatenate([np.arange(a, b) for a, b in out]) if out else np.zeros(0, np.int64)
        each = [b - a for a, b in out]
        part = np.repeat([int(a) if salts[a] == 0 else -1 for a, _ in out], each).astype(np.int64) if out else rows
        part = np.where(part >= 0, sizes[np.maximum(part, 0)], -1) if out else rows  # the smallest size names a part
        return pa.Table.from_pydict({"region": keys[rows].view(np.int64), "part": part, "node": nodes[rows]})

    return packed.groupBy("bucket").applyInArrow(bucket, "region long, part long, node long")


def bounded(low: np.ndarray, high: np.ndarray, low_n: np.ndarray, high_n: np.ndarray, least: int) -> np.ndarray:
    """``[i, j]``: whether points (or boxes, by their larger corners and smallest sizes) can be similar enough."""
    most = np.zeros((len(low), len(high)), np.int64)
    for g in range(low.shape[1]):
        most += np.minimum(low[:, g, None], high[None, :, g])
    return (100 + least) * most >= least * (low_n[:, None] + high_n[None, :])


def searched(a: dict, b: dict, least: int, fan: int = 32) -> Iterator[tuple[int, int]]:
    """Pairs of nodes with different labels in two leaves whose points' bound suffices; boxes of ``fan`` points first."""
    trees = []
    for leaf in (a, b):
        n = np.array(leaf["n"], np.int64)
        p = np.array(leaf["point"], np.int64).reshape(len(n), -1)
        order = np.lexsort((p[:, 0], n, np.array(leaf["label"], np.int64)))
        at = np.arange(0, len(n), fan)
        trees.append((np.array(leaf["node"], np.int64)[order], np.array(leaf["label"], np.int64)[order], n[order], p[order], at))
    fine: dict[int, np.ndarray] = {}
    for leaf in (a, b):
        fine.update(zip(leaf["node"], unpacked(leaf["fine"])))
    (na, la, sa, pa_, ata), (nb, lb, sb, pb, atb) = trees
    boxes = bounded(np.maximum.reduceat(pa_, ata), np.maximum.reduceat(pb, atb), np.minimum.reduceat(sa, ata), np.minimum.reduceat(sb, atb), least)
    for i, j in zip(*(x.tolist() for x in np.nonzero(boxes))):
        s, t = slice(ata[i], ata[i] + fan), slice(atb[j], atb[j] + fan)
        other = la[s][:, None] != lb[t][None, :]
        if other.any():
            for x, y in zip(*np.nonzero(other & bounded(pa_[s], pb[t], sa[s], sb[t], least))):
                one, two = int(na[s][x]), int(nb[t][y])
                if (100 + least) * in_common(fine[one], fine[two]) >= least * int(sa[s][x] + sb[t][y]):
                    yield one, two


def with_points(rows: DataFrame) -> DataFrame:
    """``rows`` and the coarse ``point`` of each, folded from its finer one."""
    columns = [c for c in rows.columns if c != "fine"]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("point", pa.array([point(f) for f in unpacked(batch.column("fine").to_pylist())], pa.list_(pa.int32())))

    rows = rows.select(*columns, "fine")
    return rows.mapInArrow(add, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", point array<int>")


def likely(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The ``pairs`` whose finer points' bound suffices."""
    side = lambda x, n, f: nodes.select(F.col("node").alias(x), F.col("n").alias(n), F.col("fine").alias(f))
    both = pairs.join(side("x", "n1", "f1"), "x").join(side("y", "n2", "f2"), "y").where(f"100 * least(n1, n2) >= {least} * greatest(n1, n2)")

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.add(batch.column(2).to_numpy(), batch.column(3).to_numpy()).tolist()
            most = [in_common(a, b) for a, b in zip(unpacked(batch.column(4).to_pylist()), unpacked(batch.column(5).to_pylist()))]
            yield batch.select([0, 1]).filter(pa.array([(100 + least) * m >= least * k for m, k in zip(most, n)], pa.bool_()))

    return both.select("x", "y", "n1", "n2", "f1", "f2").mapInArrow(bound, "x long, y long")


def unjoined_pairs(members: DataFrame, nodes: DataFrame, joined: DataFrame, least: int, scratch: Scratch, name: str) -> DataFrame:
    """``x, y``: pairs of nodes of one region in different components whose bound suffices."""
    named = members.select("region", "part", "node").join(joined, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = scratch.keep(named, f"{name}-named")
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"h{i}") for i in (0, 1)]
    mixed = named.groupBy("region", "part").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("rows"), *marks)
    once = mixed.where("a <> b").groupBy("rows", "h0", "h1").agg(F.min(F.struct("region", "part")).alias("r"))  # regions of the same nodes
    left = named.join(once.select("r.region", "r.part", "rows"), ["region", "part"])
    points = with_points(left.join(nodes.select("node", "n", "fine"), "node")).withColumn("leaf", F.expr(f"cast(pmod(xxhash64(node), div(rows, {LEAF}) + 1) as int)"))
    row = F.struct("node", "label", "n", "point", "fine")
    leaves = points.groupBy("region", "part", "leaf").agg(F.collect_list(row).alias("rows"))  # some LEAF rows each
    corner = F.expr(f"transform(sequence(0, {GROUPS - 1}), g -> array_max(transform(rows, r -> r.point[g])))")
    leaves = scratch.keep(
        leaves.select("region", "part", "leaf", "rows", corner.alias("top"), F.expr("array_min(rows.n)").alias("n"), F.expr("if(array_min(rows.label) = array_max(rows.label), rows[0].label, null)").alias("only")),
        f"{name}-leaves",
    )
    small = leaves.select("region", "part", "leaf", "top", "n", "only")
    other = small.select("region", "part", *(F.col(c).alias(f"{c}2") for c in ("leaf", "top", "n", "only")))
    bound = F.expr("aggregate(zip_with(top, top2, (p, q) -> cast(least(p, q) as long)), 0L, (s, x) -> s + x)")
    boxes = small.join(other, ["region", "part"]).where("leaf <= leaf2 AND NOT coalesce(only = only2, false)")
    boxes = boxes.where((100 + least) * bound >= least * (F.col("n") + F.col("n2"))).select("region", "part", "leaf", "leaf2")
    rows = leaves.select("region", "part", "leaf", "rows")
    pairs = boxes.join(rows, ["region", "part", "leaf"]).join(rows.select("region", "part", F.col("leaf").alias("leaf2"), F.col("rows").alias("rows2")), ["region", "part", "leaf2"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = lambda rows: {c: [r[c] for r in rows] for c in ("node", "label", "n", "point", "fine")}
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for r1, r2 in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update((min(p), max(p)) for p in searched(unzip(r1), unzip(r2), least) if p[0] != p[1])
            yield pa.RecordBatch.from_pydict({"x": pa.array([p[0] for p in found], pa.int64()), "y": pa.array([p[1] for p in found], pa.int64())})

    return scratch.keep(pairs.select("rows", "rows2").mapInArrow(search, "x long, y long").distinct(), f"{name}-pairs")


def fetched(docs: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of the ``wanted`` nodes (``node, root``), from the texts of the documents they are named after.  A row
    comes once a task; a document that is repeated in several tasks gives it several times."""
    few = wanted.count() <= BROADCAST_NODES
    if few:  # only these texts get to Python
        docs = docs.join(F.broadcast(wanted.select("root").distinct()), F.col("doc_id").eqNullSafe(F.col("root")), "left_semi")

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column(0).to_pylist(), size):
                if len(s) and (node := node_of(s)) not in seen:
                    rows.append((node, s.astype(U8).tobytes()))
                    if len(seen) < 1_000_000:  # only spares copies within a task
                        seen.add(node)
            yield pa.RecordBatch.from_pydict({"node": pa.array([r[0] for r in rows], pa.int64()), "shingles": pa.array([r[1] for r in rows], pa.binary())})

    found = docs.select(text).mapInArrow(fetch, "node long, shingles binary")
    names = wanted.select("node")
    return found.join(F.broadcast(names) if few else names, "node", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The ``pairs`` whose sets are similar enough."""
    sets = sets.dropDuplicates(["node"])  # both sides read this one exchange
    both = pairs.join(sets.select(F.col("node").alias("x"), F.col("shingles").alias("a")), "x").join(sets.select(F.col("node").alias("y"), F.col("shingles").alias("b")), "y")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, U8), np.frombuffer(b, U8)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= least * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("x", "y", "a", "b").mapInArrow(verify, "x long, y long")


def shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """``[i, j]``: how many shingles two sets share."""
    names = np.unique(np.concatenate([*a, *b]))
    sides = []
    for sets in (a, b):
        columns = np.searchsorted(names, np.concatenate(sets))
        order = np.argsort(columns, kind="stable")
        sides.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order], columns[order]))
    out = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, len(names), COLUMNS):
        has = []
        for sets, (rows, columns) in zip((a, b), sides):
            own = slice(*np.searchsorted(columns, [at, at + COLUMNS]))
            table = np.zeros((len(sets), min(COLUMNS, len(names) - at)), np.float32)
            table[rows[own], columns[own] - at] = 1
            has.append(table)
        out += (has[0] @ has[1].T).astype(np.int64)
    return out


def link_counts(members: DataFrame, sets: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """``node, links``: with how many documents of other sets each of ``members`` (``node, n, copies, label``) is linked.  All pairs
    of a component's nodes are compared; ``sets`` has every node of a component of several."""
    several = members.groupBy("label").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1")
    leaf = F.expr(f"cast(pmod(xxhash64(node), greatest(div(m, {LEAF}), div(total, {LEAF_SHINGLES})) + 1) as int)")
    rows = members.join(several, "label").join(sets.dropDuplicates(["node"]), "node").withColumn("leaf", leaf)
    leaves = scratch.keep(rows.groupBy("label", "leaf").agg(F.collect_list(F.struct("node", "copies", "shingles")).alias("rows")), "count-leaves")
    other = leaves.select("label", F.col("leaf").alias("leaf2"))
    pairs = leaves.select("label", "leaf").join(other, "label").where("leaf <= leaf2")
    pairs = pairs.join(leaves, ["label", "leaf"]).join(leaves.select("label", F.col("leaf").alias("leaf2"), F.col("rows").alias("rows2")), ["label", "leaf2"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: dict[int, int] = {}
            for one, r1, r2 in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                left = r1.as_py()
                right = left if one else r2.as_py()
                a, b = ([np.frombuffer(r["shingles"], U8) for r in side] for side in (left, right))
                both = shared(a, b)
                sizes = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :]
                similar = (100 * both >= least * (sizes - both)).astype(np.int64)
                if one:
                    np.fill_diagonal(similar, 0)
                found = [(left, similar @ np.array([r["copies"] for r in right], np.int64))]
                if not one:
                    found.append((right, similar.T @ np.array([r["copies"] for r in left], np.int64)))
                for side, n in found:
                    for r, k in zip(side, n.tolist()):
                        links[r["node"]] = links.get(r["node"], 0) + k
            yield pa.RecordBatch.from_pydict({"node": pa.array(list(links), pa.int64()), "links": pa.array(list(links.values()), pa.int64())})

    counted = pairs.select(F.expr("leaf = leaf2"), "rows", "rows2").mapInArrow(count, "node long, links long")
    return scratch.keep(counted.groupBy("node").agg(F.sum("links").alias("links")), "counts")


def groups(docs: DataFrame, text: str = "text", size: int = 5, least: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row, as :func:`linked` has them; links inside components are not counted."""
    return linked(docs, text, size, least, counts=False)


def linked(docs: DataFrame, text: str = "text", size: int = 5, least: int = 80, counts: bool = True) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row: with how many other rows it is linked, and the smallest doc_id reachable by links of a Jaccard similarity of ``least`` percent
    or more of sets of ``size``-word shingles (words split at ASCII white space, A-Z lower-cased).

    Null text and text without words: an empty set, linked with nothing, its own doc_id.  Fewer words than a shingle has: the whole sequence is one shingle.
    Repeated rows are linked as any equal sets.  Null ids are passed over for the smallest (null if there is no other).  An empty table gives
    none; other columns are not read.  Without ``counts`` there is no ``n_links``.  Sets are compared by 64-bit hashes of their shingles, and equal sets are told by 64 bits.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "jaccard")
    rows = scratch.keep(scanned(docs, text, size), "scanned")
    found = rows.where("slice IS NULL").select("doc_id", "n", "node", "fine")
    cells = summed_cells(rows)
    nodes = scratch.keep(found.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("root"), F.first("n").alias("n"), F.first("fine").alias("fine"), F.count("*").alias("copies")), "nodes")
    packed = entries(docs, text, size, least, cells, 4 * shuffle_partitions(spark))
    members = scratch.keep(regions(packed, least), "regions")
    # a region's pivot is its node with the most regions: copies are nearest to what they were copied from, which has fewest shingles of its own
    known = members.groupBy("node").agg(F.count("*").alias("degree"))
    pivots = members.join(known, "node").groupBy("region", "part").agg(F.max(F.struct("degree", "node")).alias("pivot"))
    star = members.join(pivots, ["region", "part"]).select(F.col("pivot.node").alias("x"), F.col("node").alias("y")).where("x <> y")
    # of a node's pivots those it shares most regions with: the likeliest links; the others are searched for below
    often = F.row_number().over(Window.partitionBy("y").orderBy(F.desc("count"), "x"))
    pairs = star.groupBy("x", "y").count().withColumn("often", often).where(F.col("often") <= PIVOTS).select("x", "y")
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    pairs = scratch.keep(likely(pairs, nodes, least), "star")

    names = nodes.select("node", "root")
    ends = lambda p: p.select(F.col("x").alias("node")).union(p.select(F.col("y").alias("node"))).distinct()
    wanted = scratch.keep(ends(pairs).join(names, "node"), "wanted")
    sets = scratch.keep(fetched(docs, text, size, wanted), "sets")
    links = scratch.keep(verified(pairs, sets, least), "links")
    joined = scratch.keep(labels(links, scratch, "first"), "joined")
    more = unjoined_pairs(members, nodes, joined, least, scratch, "rest")
    scratch.drop("regions")
    missing = scratch.keep(ends(more).join(wanted, "node", "left_anti").join(names, "node"), "missing")
    sets2 = scratch.keep(fetched(docs, text, size, missing), "sets2")
    links2 = scratch.keep(verified(more, sets.union(sets2), least), "links2")
    for name in ("rest-named", "rest-leaves") if counts else ("sets", "sets2", "rest-named", "rest-leaves"):
        scratch.drop(name)
    smallest = nodes.select("node", "root", "n", "copies").join(joined, "node", "left").withColumn("label", F.coalesce("label", "node"))
    if not links2.isEmpty():  # components joined by the second links: each is one node now
        at = lambda end: joined.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        between = links2.join(at("x"), "x", "left").join(at("y"), "y", "left").select(F.coalesce("x_label", "x").alias("x"), F.coalesce("y_label", "y").alias("y"))
        again = scratch.keep(labels(between, scratch, "second"), "again").select(F.col("node").alias("label"), F.col("label").alias("other"))
        smallest = smallest.join(again, "label", "left").withColumn("label", F.coalesce("other", "label"))
    roots = smallest.groupBy("label").agg(F.min("root").alias("component_id"))
    if counts:
        smallest = smallest.join(link_counts(smallest.select("node", "n", "copies", "label"), sets.union(sets2), least, scratch), "node", "left")
        smallest = smallest.withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        for name in ("sets", "sets2", "count-leaves"):
            scratch.drop(name)
    more = ["n_links"] if counts else []
    placed = smallest.select("node", "label", *more).join(roots, "label").select("node", "component_id", *more)
    full = found.where("n > 0").select("doc_id", "n", "node").join(placed, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id", *more)
    no_links = [F.lit(0).cast("long").alias(c) for c in more]
    none = found.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *no_links)
    return full.unionByName(none)
