"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 7).

Every source is cut into blocks by a hash of its rows.  A source's target decides how many passes over all its
blocks the mix makes, and which blocks, in a hashed order, it takes once more; one last draw takes the next block in part, and rows of
the following ones in place of those that do not fit. The block draws of all
sources are then split among output shards: at each node of a binary tree the left half's share of every source is one
multivariate-hypergeometric draw, so that the quotas stay exact down to the leaves.  Shards take consecutive draws of the permuted
blocks, hence disjoint ones, and shuffle their own rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from codestrata.llm.common import Scratch, free_name, small_batches, text_key

#: Columns beside those of the documents, which stay together in one column meanwhile and so cannot clash with these.
SOURCE, KEY, SIZE, DRAW, BLOCK, ROW = "__source", "__key", "__size", "__draw", "__block", "__row"
#: Bytes of text that one shard of the mix is meant to hold.
SHARD_BYTES = 64 << 20


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``cap`` times its size: what a source cannot take is shared
    among the others by weight."""
    order = sorted(range(len(sizes)), key=lambda i: cap * sizes[i] / weights[i])
    out, left, weight = [0.0] * len(sizes), float(total), float(sum(weights))
    for i in order:  # those that reach their cap first
        out[i] = min(cap * sizes[i], left * weights[i] / weight) if weight > 0 else 0.0
        left, weight = left - out[i], weight - weights[i]
    return out


def split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """``[source, shard]`` counts with the quotas as row sums, by halving the shards again and again."""
    if shards == 1:
        return quotas[:, None]
    half = shards // 2
    left = np.zeros_like(quotas)
    if quotas.sum():
        left = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * half // shards, method="marginals")
    return np.concatenate([split(left, half, rng), split(quotas - left, shards - half, rng)], axis=1)


class Mix:
    """One mix of ``docs``.

    ``weights`` repeat along the sources in code point order, the null source last; the mix has ``factor`` times all words,
    a source (and so a document) at most ``cap`` times its own.  A source has at most ``blocks`` blocks.

    Null text: no words; such rows follow their block.  Rows equal in id, source and text are drawn together.  Empty
    sources get nothing; an empty table gives an empty mix.  The same rows and ``seed`` give the same mix.  The driver
    holds one row a source and at most ``blocks`` block sums of each source stay in Spark.  Without ``shards`` there are as many
    as make `SHARD_BYTES` of text each, so shards grow in number and not in size.  Columns may have any names.
    """

    def __init__(
        self, docs: DataFrame, weights: Sequence[float] = (5, 2, 1), factor: float = 1.5, cap: float = 2.0,
        shards: int | None = None, blocks: int = 1024, block_words: int = 16_384, seed: int = 7,
    ):
        spark = docs.sparkSession
        small_batches(spark, 2_000)
        self.docs, self.seed = docs, seed
        self.scratch = Scratch(spark, "mix")
        #: names of the columns that :meth:`rows` adds
        self.shard, self.position = free_name("__shard", docs), free_name("__position", docs)
        length = F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")
        self.sized = self.scratch.keep(self.marked(docs, length).drop(ROW), "sized")
        sums = self.sized.groupBy(SOURCE).agg(F.first("source").alias("source"), F.sum(SIZE).alias("n"), F.sum("bytes").alias("bytes")).collect()
        sums.sort(key=lambda r: (r.source is None, r.source or ""))
        sizes = [r.n for r in sums]
        by_weight = [float(weights[i % len(weights)]) for i in range(len(sums))]
        goals = targets(sizes, by_weight, factor * sum(sizes), cap)
        rows = []
        for r, goal in zip(sums, goals):
            passes = min(int(cap), int(goal // r.n)) if r.n else 0
            n_blocks = max(1, min(blocks, math.ceil(r.n / block_words)))
            rows.append((r[SOURCE], r.n, goal, passes, goal - passes * r.n, n_blocks))
        schema = f"{SOURCE} string, source_size long, target double, __passes int, __need double, __blocks int"
        self.plan = spark.createDataFrame(rows, schema)  # one row a source
        self.most_blocks = sum(r[-1] for r in rows)
        self.blocks = self.scratch.keep(self._blocks(), "blocks")
        self.shards = shards or max(1, math.ceil(factor * sum(r.bytes for r in sums) / SHARD_BYTES))
        self.taken_in_part = self.scratch.keep(self._part(), "part")
        some = self.taken_in_part.select(SOURCE, BLOCK).distinct().withColumn("__some", F.lit(True))
        self.blocks = self.scratch.keep(self.blocks.join(some, [SOURCE, BLOCK], "left").na.fill(False, ["__some"]), "marked")

    def marked(self, docs: DataFrame, *more: Column) -> DataFrame:
        return docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), "doc_id", "source",
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias(SOURCE), text_key().alias(KEY), word_count().alias(SIZE),
            F.xxhash64(F.lit(self.seed), "doc_id", F.coalesce("text", F.lit(""))).alias(DRAW), *more,
        )

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(self.plan), SOURCE).withColumn(BLOCK, F.pmod(F.col(DRAW), F.col("__blocks")).cast("int"))

    def _blocks(self) -> DataFrame:
        """Blocks in their hashed order: ``__rank``, whether the mix takes them once more (``__whole``), and, of
        the one that is taken in part, how many words (``__rest``)."""
        order = Window.partitionBy(SOURCE).orderBy(F.xxhash64(F.lit(self.seed), SOURCE, BLOCK), BLOCK)
        sums = self.placed(self.sized).groupBy(SOURCE, BLOCK, "__need").agg(F.sum(SIZE).alias("__n"))
        after = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, 0))
        rows = sums.withColumns({"__rank": F.row_number().over(order) - 1, "__after": after})
        whole = F.col("__after") <= F.col("__need")
        rest = F.when(~whole & (F.col("__after") - F.col("__n") < F.col("__need")), F.col("__need") - F.col("__after") + F.col("__n"))
        return rows.select(SOURCE, BLOCK, "__rank", whole.alias("__whole"), rest.alias("__rest"))

    def _part(self) -> DataFrame:
        """The rows that a source's last draw takes: from the block taken in part on, in hashed order of the blocks and
        in them, each as long as it still fits.  What that block leaves open is carried on to the later blocks, until no
        row of theirs fits: a source then misses its need by less than its shortest row that is not taken.

        Each round passes over the whole blocks whose fitting rows fit together, and looks at the next ones row by row,
        twice as many as in the round before; rows longer than what is left never come back."""
        spark = self.docs.sparkSession
        units = (
            self.placed(self.sized).groupBy(SOURCE, BLOCK, "doc_id", KEY, DRAW).agg(F.sum(SIZE).alias("n"))
            .join(self.blocks.select(SOURCE, BLOCK, "__rank"), [SOURCE, BLOCK])
            .select(SOURCE, BLOCK, "__rank", "doc_id", KEY, "n", F.xxhash64(F.lit(self.seed + 1), DRAW).alias("__order"))
        )
        state = [(r[SOURCE], r["__rest"], r["__rank"]) for r in self.blocks.where(F.col("__rest").isNotNull()).collect()]
        schema = f"{SOURCE} string, __left double, __from int"
        picks, ahead = spark.createDataFrame([], units.select(SOURCE, BLOCK, "doc_id", KEY, "n").schema), 1
        while state:
            left = F.broadcast(spark.createDataFrame(state, schema))
            fit = units.join(left, SOURCE).where("n > 0 AND n <= __left + 0.5 AND __rank >= __from")
            if ahead == 1:  # the block itself; its rest is known
                taken = self._fitting(units.join(left, SOURCE).where("__rank = __from"))
                after = {name: at + 1 for name, _, at in state}
            else:
                units = self.scratch.keep(fit.drop("__left", "__from"), f"fitting-{ahead}")
                fit = units.join(left, SOURCE)
                upto = Window.partitionBy(SOURCE).orderBy("__rank").rowsBetween(Window.unboundedPreceding, 0)
                sums = fit.groupBy(SOURCE, "__rank", "__left").agg(F.sum("n").alias("__n")).withColumn("__after", F.sum("__n").over(upto))
                # the first block that does not fit, and how many words the ones before it have
                over = F.col("__after") > F.col("__left") + 0.5
                cross = sums.groupBy(SOURCE, "__left").agg(F.min(F.when(over, F.col("__rank"))).alias("at"), F.max(F.when(~over, F.col("__after"))).alias("whole"))
                found = {r[SOURCE]: r for r in cross.collect()}
                if not found:
                    break
                marks = spark.createDataFrame([(k, r["__left"] - (r.whole or 0), r.at) for k, r in found.items()], f"{SOURCE} string, __left double, __at int")
                near = units.join(F.broadcast(marks), SOURCE)
                whole = near.where("__at IS NULL OR __rank < __at").select(*picks.columns)
                taken = whole.unionByName(self._fitting(near.where(f"__rank >= __at AND __rank < __at + {ahead // 2}")))
                after = {k: r.at + ahead // 2 for k, r in found.items() if r.at is not None}
            taken = self.scratch.keep(taken, f"taken-{ahead}")
            picks = picks.unionByName(taken)
            used = {r[SOURCE]: r.n for r in taken.groupBy(SOURCE).agg(F.sum("n").alias("n")).collect()}
            state = [(name, rest - used.get(name, 0), after[name]) for name, rest, _ in state if name in after]
            state = [r for r in state if r[1] >= 0.5]
            ahead *= 2
        return picks.select(SOURCE, BLOCK, "doc_id", KEY)

    def _fitting(self, rows: DataFrame) -> DataFrame:
        """Of each source's ``rows`` in their order those that still fit in its ``__left`` words."""
        columns = [SOURCE, BLOCK, "doc_id", KEY, "n"]
        rows = rows.select(*columns, "__left", "__rank", "__order")

        def fitting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            source, left = None, 0.0
            for batch in batches:
                take = []
                for name, n, rest in zip(*(batch.column(c).to_pylist() for c in (SOURCE, "n", "__left"))):
                    if name != source:
                        source, left = name, rest
                    take.append(0 < n <= left + 0.5)
                    left -= n * take[-1]
                yield batch.filter(pa.array(take, pa.bool_())).select(columns)

        out = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
        return rows.repartition(SOURCE).sortWithinPartitions(SOURCE, "__rank", "__order", "doc_id", KEY).mapInArrow(fitting, out)

    def drawn(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``__passes``, ``__more`` (whether taken once more), their block's rank and the plan."""
        part = self.taken_in_part.select(SOURCE, F.col("doc_id").alias("__id"), F.col(KEY).alias("__k"), F.lit(True).alias("__picked"))
        # one row a block: broadcast while all sources' blocks together are few
        blocks = F.broadcast(self.blocks) if self.most_blocks <= 200_000 else self.blocks
        inner = self.placed(rows).join(blocks, [SOURCE, BLOCK])
        some = F.col("__some")
        picked = inner.where(some).join(part.withColumnRenamed(SOURCE, "__s"), (F.col(SOURCE) == F.col("__s")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(KEY) == F.col("__k")), "left")
        picked = picked.withColumn("__more", F.coalesce("__picked", F.lit(False))).drop("__s", "__id", "__k", "__picked")
        return inner.where(~some).withColumn("__more", F.col("__whole")).unionByName(picked)

    def report(self) -> DataFrame:
        """``doc_id, source, size, source_size, target, taken`` of every row."""
        taken = F.col(SIZE) * (F.col("__passes") + F.col("__more").cast("int"))
        return self.drawn(self.sized).select("doc_id", "source", F.col(SIZE).alias("size"), "source_size", "target", taken.alias("taken"))

    def quotas(self) -> tuple[list[str], np.ndarray]:
        """Block draws of each source, and how the tree splits them among the shards."""
        most = self.blocks.groupBy(SOURCE).agg(F.count("*").alias("n"), F.sum((F.col("__whole") | F.col("__rest").isNotNull()).cast("int")).alias("more"))
        rows = sorted(most.join(self.plan, SOURCE).select(SOURCE, "n", "more", "__passes").collect())
        # draw numbers run over passes times ranks: every rank of each pass is one draw
        counts = np.array([r.n * r["__passes"] + r.more for r in rows], np.int64)
        return [r[SOURCE] for r in rows], split(counts, self.shards, np.random.default_rng(self.seed))

    def rows(self) -> DataFrame:
        """The mix: every taken copy as a row of ``docs``' columns with its shard and its place there."""
        names, counts = self.quotas()
        bounds = [(n, [int(c) for c in np.cumsum(row)]) for n, row in zip(names, counts)]
        split_at = self.docs.sparkSession.createDataFrame(
            bounds, T.StructType([T.StructField(SOURCE, T.StringType()), T.StructField("__bounds", T.ArrayType(T.LongType()))])
        )
        copies = self.drawn(self.marked(self.docs)).join(F.broadcast(split_at), SOURCE)
        # the blocks taken once more come first, then the passes
        n_more = F.col("__bounds")[self.shards - 1] - F.col("__passes") * F.col("__n_blocks")
        per_source = self.blocks.groupBy(SOURCE).agg(F.count("*").alias("__n_blocks"))
        copies = copies.join(F.broadcast(per_source), SOURCE)
        numbers = F.expr("filter(sequence(0, __passes), c -> c > 0 OR __more)")
        copies = copies.withColumn("__copy", F.explode(numbers))
        # rows that the block taken in part was filled up with are in its draw, the last of those
        index = F.when(F.col("__copy") == 0, F.least("__rank", n_more - 1)).otherwise(n_more + (F.col("__copy") - 1) * F.col("__n_blocks") + F.col("__rank"))
        copies = copies.withColumn("__index", index)
        shard = F.expr("size(filter(__bounds, b -> b <= __index))")
        position = F.xxhash64(F.lit(self.seed + 2), DRAW, "__copy")
        return copies.select(f"{ROW}.*", shard.alias(self.shard), position.alias(self.position))

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` with every shard in a partition of its own and in its order.  By a hash of the shard's number several large shards
        would share a partition, and others stay empty."""
        return rows.repartitionById(self.shards, self.shard).sortWithinPartitions(self.position)

    def written(self) -> DataFrame:
        """The mix with every shard's rows together and in their order, written and read again; a column more tells rows of one id
        apart without their text."""
        rows = self.rows()
        self.key = free_name(KEY, rows)
        return self.scratch.keep(self.dealt(rows.withColumn(self.key, text_key())), "mix", "zstd")

    def counted(self) -> DataFrame:
        """The columns of :meth:`report`, ``taken`` being counted in the written mix: the copies there, and the words of each."""
        keys = [SOURCE, "source", "doc_id", KEY]
        mix = self.written()
        source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias(SOURCE)
        given = self.sized.select(*keys, SIZE, F.lit(1).alias("__rows"), F.lit(0).alias("__copies"))
        mix = mix.select(source, "source", "doc_id", F.col(self.key).alias(KEY), F.lit(0).cast("long").alias(SIZE), F.lit(0).alias("__rows"), F.lit(1).alias("__copies"))
        both = given.unionByName(mix)
        units = both.groupBy(*keys).agg(F.max(SIZE).alias("size"), F.sum("__rows").alias("__rows"), F.sum("__copies").alias("__copies"))
        # rows equal in id, source and text are one unit, and all taken equally often
        rows = units.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), "__rows")))
        taken = F.expr("size * (__copies div __rows)")
        return rows.join(F.broadcast(self.plan), SOURCE).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
