"""Approximate nearest neighbours by randomly rotated one-bit codes (operator 10).

Each unit vector is padded with zeros to several times its length, rotated by one random orthogonal matrix and kept as the signs of its
coordinates (a packed bit each) with a correction scalar.  The signs, as a unit vector ``s``, give the estimate ``<s, q> / <s, o>`` of the
inner product of ``o`` and a query ``q``; its error is at most ``bound * sqrt((1 - <s, o>^2) (1 - <s, q>^2) / (D - 1)) / <s, o>`` but for a
probability that falls with ``bound`` as a normal tail (three: some 1 in 700), and padding makes ``D`` larger.  A vector is reranked by its
own cosine unless its upper limit is below the cosines of as many others as are asked for.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codestrata.llm.common import Scratch, shuffle_partitions, small_batches

CODES = "dim int, ids binary, codes binary, scale binary, vectors binary"
QUERIES = "dim int, qids binary, q binary, qvectors binary"
FOUND = "query long, candidate long, score double"
#: Query blocks whose results a task holds before it gives them out.
HELD_BLOCKS = 64


@functools.lru_cache(maxsize=4)
def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix of ``bits``, the same in every worker."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, bits]).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).T


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and ``<s, o>`` of each."""
    o = unit(x) @ turn
    return np.packbits(o >= 0, axis=1), (np.abs(o).sum(axis=1) / np.sqrt(o.shape[1])).astype("f4")


def estimate(codes: np.ndarray, scale: np.ndarray, queries: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the inner products and their upper limits, ``[query, code]``; ``queries`` are rotated."""
    bits = queries.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=bits).astype("f4") * 2 - 1) / np.float32(np.sqrt(bits))
    inner = queries @ signs.T
    spread = np.sqrt(np.maximum(1 - scale**2, 0) / max(1, bits - 1)) / scale
    middle = inner / scale
    return middle, middle + bound * np.sqrt(np.maximum(1 - inner**2, 0)) * spread + 1e-5


def best_of(query: np.ndarray, ids: np.ndarray, score: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest scores of each of ``n`` queries in falling order, ties to the smaller id, as ``[query, k]`` scores and
    ids; missing ones have the score minus infinity."""
    order = np.lexsort((ids, -score.round(12), query))
    query, ids, score = query[order], ids[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    top, names = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)
    few = rank < k
    top[query[few], rank[few]], names[query[few], rank[few]] = score[few], ids[few]
    return top, names


def reranked(row: dict, known: tuple[np.ndarray, np.ndarray], k: int, bound: float, strip: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """``known`` (the ``k`` best of each query so far) after one block of codes: those within the limits are compared by their vectors."""
    dim, ids = row["dim"], np.frombuffer(row["ids"], "<i8")
    codes, scale = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1), np.frombuffer(row["scale"], "<f4")
    vectors, asked = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim), np.frombuffer(row["qvectors"], "<f8").reshape(-1, dim)
    turned = np.frombuffer(row["q"], "<f4").reshape(len(asked), -1)
    top, names = (a.copy() for a in known)
    n = min(k, len(ids))
    for at in range(0, len(asked), strip):
        own = slice(at, at + strip)
        middle, high = estimate(codes, scale, turned[own], bound)
        likely = np.argpartition(middle, len(ids) - n, axis=1)[:, len(ids) - n :]
        sure = np.einsum("qcd,qd->qc", vectors[likely], asked[own])
        floor = np.maximum(top[own, -1], sure.min(axis=1) if n == k else -np.inf)
        near = high >= floor[:, None] - 1e-9
        np.put_along_axis(near, likely, True, axis=1)
        q, c = np.nonzero(near)
        score = np.concatenate([np.einsum("cd,cd->c", vectors[c[i : i + 65_536]], asked[own][q[i : i + 65_536]]) for i in range(0, len(q), 65_536)])
        old_q, old_c = np.nonzero(top[own] > -np.inf)
        found = np.concatenate([q, old_q]), np.concatenate([ids[c], names[own][old_q, old_c]]), np.concatenate([score, top[own][old_q, old_c]])
        top[own], names[own] = best_of(*found, len(middle), k)
    return top, names


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """Rows that take part, as ``vec_id, v``: those with an id, and a vector without null or non-finite
    components that is not zero."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & _whole(F.col("v")))


def _whole(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def scaled(name: str) -> Column:
    """A vector over its largest component, so that no square of very small or very large ones is lost.  The component stands in a
    struct beside the vector, as it would be searched again for every other one."""
    both = f"array(struct({name} AS x, array_max(transform({name}, c -> abs(c))) AS most))"
    return F.expr(f"transform({both}, s -> transform(s.x, c -> c / s.most))[0]")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    sizes = np.diff(batch.column(1).offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        part = batch.filter(pa.array(sizes == dim))
        yield dim, part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1), dim)


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, id_column: str = "vec_id", column: str = "embedding",
    bound: float = 3.0, padding: int = 4, query_block: int = 1024, code_block: int = 4096, seed: int = 7,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``queries`` holds (an expression on ``vec_id``) the ``k`` rows of
    the largest cosine but itself, nearest first, ties to the smaller id; all of them where there are fewer.

    Rows without an id, and vectors that are null, zero, or hold null or non-finite components take no part.  Vectors are only
    compared with those of their length.  Rows of one id and vector are one row.  Equal vectors are searched once, as one class with its ``k + 1``
    smallest ids, so a vector in a third of all rows costs what one does.  Every vector is indexed and every candidate above the limits is reranked.
    Queries meet codes in blocks: blocks of codes are dealt to strips, one or more for a task, and every block of queries goes to each strip.
    ``padding`` is the number of code bits for a component.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    same = ["h1", "h2"]
    rows = usable(vectors, id_column, column).withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(seed), "v")})
    distinct = rows.groupBy(*same, "vec_id").agg(F.first("v").alias("v"))
    first = F.row_number().over(Window.partitionBy(*same).orderBy("vec_id"))
    classes = scratch.keep(
        distinct.withColumn("n", first).where(F.col("n") <= k + 1).groupBy(*same)
        .agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v")),
        "classes",
    )
    asked = scratch.keep(rows.where(queries).select("vec_id", *same).distinct(), "asked")
    wanted = scratch.keep(classes.join(asked.select(*same).distinct(), same, "left_semi").select("id", "v"), "wanted")

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, x in _by_dim(batch):
                codes, scale = encode(x, rotation(dim, padding * dim, seed))
                yield pa.RecordBatch.from_pydict(
                    {"dim": pa.array([dim], pa.int32()), "ids": [ids.astype("<i8").tobytes()], "codes": [codes.tobytes()], "scale": [scale.tobytes()], "vectors": [unit(x).tobytes()]}
                )

    def turned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, x in _by_dim(batch):
                x = unit(x)
                q = (x @ rotation(dim, padding * dim, seed)).astype("<f4")
                yield pa.RecordBatch.from_pydict(
                    {"dim": pa.array([dim], pa.int32()), "qids": [ids.astype("<i8").tobytes()], "q": [q.tobytes()], "qvectors": [x.tobytes()]}
                )

    def packed(rows: DataFrame, block: int) -> tuple[DataFrame, int]:
        """``rows`` in full blocks, whatever tasks they came from."""
        parts = -(-rows.count() // block) or 1
        small_batches(spark, block, 256 << 20)
        return rows.select("id", "v").repartition(parts), parts

    rows, strips = packed(classes, code_block)
    strips = min(strips, shuffle_partitions(spark))
    codes = scratch.keep(rows.mapInArrow(coded, CODES).withColumn("strip", F.expr(f"pmod(spark_partition_id(), {strips})")), "codes")
    rows, _ = packed(wanted, query_block)
    blocks = scratch.keep(rows.mapInArrow(turned, QUERIES).withColumn("block", F.monotonically_increasing_id()), "blocks")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for qids, (top, names) in best.values():
                q, c = np.nonzero(top > -np.inf)
                yield pa.RecordBatch.from_pydict({"query": qids[q], "candidate": names[q, c], "score": top[q, c]})
            best.clear()

        for batch in batches:
            for row in batch.to_pylist():
                qids = np.frombuffer(row["qids"], "<i8")
                none = np.full((len(qids), k + 1), -np.inf), np.zeros((len(qids), k + 1), np.int64)
                known = best[row["block"]][1] if row["block"] in best else none
                best[row["block"]] = qids, reranked(row, known, k + 1, bound)
                if len(best) > HELD_BLOCKS:
                    yield from out()
        yield from out()

    small_batches(spark, 8, 256 << 20)  # rows are whole blocks now
    everywhere = blocks.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    pairs = codes.hint("merge").join(everywhere, ["dim", "strip"]).select("dim", "ids", "codes", "scale", "vectors", "block", "qids", "q", "qvectors")
    found = scratch.keep(pairs.mapInArrow(search, FOUND), "found")
    small_batches(spark)
    from_top = F.row_number().over(Window.partitionBy("query").orderBy(F.round("score", 12).desc(), "candidate"))
    kept = found.withColumn("n", from_top).where(F.col("n") <= k + 1).select("query", "candidate")

    pair = kept.join(classes.select(F.col("id").alias("candidate"), "ids", "v"), "candidate")
    pair = pair.join(wanted.select(F.col("id").alias("query"), F.col("v").alias("w")), "query")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    pair = pair.withColumns({"v": scaled("v"), "w": scaled("w")})
    score = dot(F.col("v"), F.col("w")) / (F.sqrt(dot(F.col("v"), F.col("v"))) * F.sqrt(dot(F.col("w"), F.col("w"))))
    scored = pair.select("query", F.explode("ids").alias("vec_id"), score.alias("score"))
    order = [F.desc("score"), F.asc("vec_id")]
    top = scored.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("n") <= k + 1)
    mine = asked.withColumnRenamed("vec_id", "query_id").join(classes.select(*same, F.col("id").alias("query")), same)
    answers = mine.join(top.drop("n"), "query").where(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
