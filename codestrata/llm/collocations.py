"""Phrase collocations by top-order marginalisation (operator 12).

Words become ids.  Lead columns give every word the three that follow it in its piece, padded with 0 past the piece's end, and only
these longest windows are counted; ``ROLLUP`` then sums the windows' counts over successively shorter prefixes, which are
the counts of all shorter phrases.

Windows travel sorted and compressed, a bucket's together, and are counted by bucket.  A bucket has all windows of a prefix, so it knows which
longer phrases are too rare, and cuts those windows back to the prefix that may still matter before the rollup sees
them.  A prefix ends with a word that is not very frequent (but has two words at least), so no bucket holds the windows of a hot pair.

Ids are ranks of the frequent words.  That table of ranks is the only thing broadcast, and it is bounded (`LISTED`
words of at most `LONGEST` bytes).  While it holds every word that is frequent enough for a phrase, any other word
ends a window; beyond that, the other words go by hashes that are checked to be distinct.  Both give the same rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codestrata.llm.common import Scratch, small_batches
from codestrata.operators.skew import join_hot

#: Upper case, the ends of pieces and tabs as one translation of bytes.
ENDS = b".,;:!?\n\x0b\x0c\r"
SIMPLER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(ENDS))
#: Stands for the end of a piece among words, none of which holds a tab.
END = b"\t"
#: Words of the broadcast table, and bytes of its longest word: 32 MB at most.
LISTED, LONGEST = 500_000, 64
#: Ids of hashed words start here; ranks end below it.
HASHED = 1 << 62
#: Different words that one task counts before it hands them on.
HELD = 300_000
#: Windows that one task sorts at a time, and windows that a bucket is meant to hold.
SORTED, BUCKET = 2_000_000, 750_000
#: A word with more occurrences is very frequent.
FREQUENT = 500_000
WORDS = ["w1", "w2", "w3", "w4"]


def split_words(texts: list[bytes]) -> Iterator[bytes]:
    """All words of the texts in their order, with `END` after each piece."""
    return filter(None, b"\n".join(texts).translate(SIMPLER).replace(b"\n", b" \t ").split(b" "))


def by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    found: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        found.setdefault(lang, []).append(text)
    return found


def vocabulary(rows: DataFrame) -> DataFrame:
    """``lang, word, n`` of every word of ``rows`` (lang, text)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                words.pop(END, None)
                keys, counts = list(words), list(words.values())
                for i in range(0, len(keys), 50_000):
                    part = keys[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()), pa.array(counts[i : i + 50_000], pa.int64())],
                        names=["lang", "word", "n"],
                    )
            held.clear()

        for batch in batches:
            for lang, texts in by_lang(batch).items():
                held.setdefault(lang, Counter()).update(split_words(texts))
            if sum(map(len, held.values())) > HELD:
                yield from out()
        yield from out()

    found = rows.mapInArrow(count, "lang string, word binary, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def hashed_id(salt: int, lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(b"%d\0%s\0%s" % (salt, lang, word), 42) >> 2 | HASHED


def hashed_column(salt: int) -> Column:
    """`hashed_id` of the columns ``lang`` and ``word``."""
    key = F.concat(F.lit(f"{salt}\0").cast("binary"), F.col("lang").cast("binary"), F.lit("\0").cast("binary"), F.col("word"))
    return F.shiftrightunsigned(F.xxhash64(key), 2).bitwiseOR(F.lit(HASHED))


class Ids:
    """Ids of the words of one collection: ranks of listed words, hashes of the others (or 0 where no
    other word is frequent)."""

    def __init__(self, words: DataFrame, least: int, listed: int, scratch: Scratch):
        spark = words.sparkSession
        frequent = words.where(F.col("n") >= least)
        # counts in steps of a twelfth of a power of two: the highest steps that together have at most `listed` words
        step, short = F.floor(F.log2("n") * 12).cast("int"), F.length("word") <= LONGEST
        steps = frequent.groupBy(step.alias("step")).agg(F.count_if(short).alias("n"), F.count_if(~short).alias("long")).collect()
        lowest, room = 1 << 30, listed
        for s in sorted(steps, key=lambda r: -r.step):
            room -= s.n
            if room < 0:
                break
            lowest = s.step
        table = frequent.where(short & (step >= lowest)).toArrow()
        order = np.lexsort([table["word"].to_numpy(zero_copy_only=False), -table["n"].to_numpy()]) if len(table) else []
        table = table.take(pa.array(order, pa.int64()))
        #: ranks of the very frequent words, and buckets for all windows
        self.frequent = int((table["n"].to_numpy() > FREQUENT).sum())
        table = table.select(["lang", "word"])
        self.buckets = max(1, -(-(words.agg(F.sum("n")).first()[0] or 0) // BUCKET))
        #: no frequent word is without a rank
        self.whole = len(table) == sum(s.n + s.long for s in steps)
        self.salt = 0
        ranks = table.append_column("id", pa.array(range(1, len(table) + 1), pa.int64()))
        known = scratch.keep(spark.createDataFrame(ranks), "ranks") if len(table) else spark.createDataFrame([], "lang string, word binary, id long")
        if not self.whole:
            others = words.join(F.broadcast(known), ["lang", "word"], "left_anti")  # `listed` rows at most
            while others.groupBy(hashed_column(self.salt)).count().where("count > 1").limit(1).count():
                self.salt += 1
            rest = others.where(F.col("n") >= least).select("lang", "word", hashed_column(self.salt).alias("id"))
            known = scratch.keep(known.unionByName(rest), "ids")
        #: ``id, lang, word`` of every frequent word
        self.table = known.select("id", "lang", F.col("word").cast("string").alias("word"))
        self.shared = spark.sparkContext.broadcast({lang: table.filter(pc.equal(table["lang"], lang))["word"].to_pylist() for lang in table["lang"].unique().to_pylist()})
        self.ranks = spark.sparkContext.broadcast({lang: np.flatnonzero(pc.equal(table["lang"], lang).to_numpy(zero_copy_only=False)) + 1 for lang in self.shared.value})


class Known(dict):
    """Word -> id of one language; words without a rank get their hash, which is not kept."""

    def __init__(self, pairs: Iterable, lang: str, salt: int):
        super().__init__(pairs)
        self.lang, self.salt = lang.encode(), salt

    def __missing__(self, word: bytes) -> int:
        return hashed_id(self.salt, self.lang, word)


def lead(codes: np.ndarray) -> np.ndarray:
    """The four columns of the windows that begin with a word; ``codes`` ends with three that are 0."""
    columns = [codes[:-3]]
    for k in (1, 2, 3):
        columns.append(np.where(columns[-1] == 0, 0, codes[k : len(codes) - 3 + k]))
    return np.stack(columns)[:, columns[0] != 0]


def in_order(windows: np.ndarray) -> np.ndarray:
    if windows.shape[1] and windows.max() < 1 << 31:  # two words to a number
        return np.lexsort([windows[2] << 32 | windows[3], windows[0] << 32 | windows[1]])
    return np.lexsort(windows[::-1])


def summed(windows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring equal windows as one."""
    starts = np.flatnonzero(np.concatenate([[True], (windows[:, 1:] != windows[:, :-1]).any(axis=0)])) if windows.shape[1] else np.zeros(0, np.int64)
    return windows[:, starts], np.add.reduceat(counts, starts) if len(starts) else counts


def key_words(windows: np.ndarray, frequent: int) -> np.ndarray:
    """How many words of each window its bucket goes by: up to the first that is not very frequent (ranks from 1 to ``frequent``),
    but two at least."""
    hot = (windows > 0) & (windows <= frequent)
    return 2 + (hot[0] & hot[1]) + (hot[0] & hot[1] & hot[2])


def bucket_of(windows: np.ndarray, frequent: int, buckets: int) -> np.ndarray:
    words = key_words(windows, frequent)
    mixed = np.zeros(windows.shape[1], np.uint64)
    for k in range(4):
        part = np.where(words > k, windows[k], 0).astype(np.uint64) + np.uint64(k + 1)
        mixed = (mixed ^ part) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)


def packed(windows: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted windows and their counts, byte by byte of all numbers together; the foremost word as steps."""
    numbers = np.stack([np.diff(windows[0], prepend=0), *windows[1:], counts])
    return zstandard.ZstdCompressor(1).compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    numbers = np.ascontiguousarray(planes.T).view(np.int64).reshape(5, n)
    return np.stack([np.cumsum(numbers[0]), *numbers[1:4]]), numbers[4]


def cut_back(windows: np.ndarray, counts: np.ndarray, frequent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a bucket, each once and in order, without the words that make them too rare: a prefix of which the bucket
    has all windows is known to be so."""
    words, out = key_words(windows, frequent), windows.copy()
    for size in (4, 3, 2):
        starts = np.flatnonzero(np.concatenate([[True], (windows[:size, 1:] != windows[:size, :-1]).any(axis=0)]))
        lengths = np.diff(starts, append=windows.shape[1])
        rare = np.repeat(np.add.reduceat(counts, starts) < least, lengths) & (words <= size)
        out[size - 1 :, rare] = 0
    return summed(out, counts)


def longest_windows(rows: DataFrame, ids: Ids, least: int) -> DataFrame:
    """``w1..w4, a``: counts of the longest windows, cut back to the prefix that can reach ``least``; windows that are cut
    to the same prefix may come in several rows."""
    words, ranks, whole, salt, frequent, buckets = ids.shared, ids.ranks, ids.whole, ids.salt, ids.frequent, ids.buckets

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Known] = {}
        held: list[np.ndarray] = []

        def out() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            windows = np.concatenate(held, axis=1)
            held.clear()
            windows, counts = summed(windows := windows[:, in_order(windows)], np.ones(windows.shape[1], np.int64))
            bucket = bucket_of(windows, frequent, buckets)
            order = np.argsort(bucket, kind="stable")
            windows, counts, bucket = windows[:, order], counts[order], bucket[order].astype(np.int64)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(starts[1:], len(bucket))
            for i in range(0, len(starts), 256):  # rows of some MB together
                parts = list(zip(starts[i : i + 256], ends[i : i + 256]))
                blobs = [packed(windows[:, a:b], counts[a:b]) for a, b in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[starts[i : i + 256]]), pa.array([b - a for a, b in parts], pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "n", "windows"]
                )

        for batch in batches:
            for lang, texts in by_lang(batch).items():
                if lang not in known:
                    known[lang] = Known(zip(words.value.get(lang, []), ranks.value[lang].tolist() if lang in ranks.value else []), lang, salt)
                    known[lang][END] = 0
                mine, found = known[lang], split_words(texts)
                codes = np.fromiter(map(mine.get, found, repeat(0)) if whole else map(mine.__getitem__, found), np.int64)
                codes = np.concatenate([codes, np.zeros(3, np.int64)])
                for i in range(0, len(codes) - 3, SORTED):
                    held.append(lead(codes[i : i + SORTED + 3]))
                    if sum(h.shape[1] for h in held) >= SORTED:
                        yield from out()
        yield from out()

    def count(group: pa.Table) -> pa.Table:
        blobs = zip(group["windows"].to_pylist(), group["n"].to_pylist())
        windows, counts = (np.concatenate(x, axis=-1) for x in zip(*(unpacked(b, n) for b, n in blobs)))
        order = in_order(windows)
        windows, counts = cut_back(*summed(windows[:, order], counts[order]), frequent, least)
        return pa.table([pa.array(c) for c in (*windows, counts)], names=[*WORDS, "a"])

    dealt = rows.mapInArrow(deal, "bucket long, n long, windows binary")
    return dealt.groupBy("bucket").applyInArrow(count, "w1 long, w2 long, w3 long, w4 long, a long")


def phrase_counts(windows: DataFrame, least: int) -> DataFrame:
    """``w1..w4, size, a`` of every phrase of one to four words that occurs at least ``least`` times.  ``windows`` are counted
    longest windows (``a``): those of four words are phrases as they are, each in one row, and the rollup has the sums of their prefixes."""
    none = F.lit(0).cast("long")
    whole = windows.where((F.col("w4") != 0) & (F.col("a") >= least)).select(*WORDS, F.lit(4).alias("size"), "a")
    sums = windows.rollup("w1", "w2", "w3").agg(F.sum("a").alias("a"), F.grouping_id().alias("cut"))
    size = F.when(F.col("cut") == 0, 3).when(F.col("cut") == 1, 2).when(F.col("cut") == 3, 1)
    last = F.when(F.col("cut") == 0, F.col("w3")).when(F.col("cut") == 1, F.col("w2")).otherwise(F.col("w1"))
    kept = sums.where((F.col("a") >= least) & (F.col("cut") < 7) & (last != 0))
    shorter = kept.select("w1", *[F.coalesce(w, none).alias(w) for w in ("w2", "w3")], none.alias("w4"), size.alias("size"), "a")
    return whole.unionByName(shorter)


def part(first: Column, size: Column) -> list[Column]:
    """Words of a phrase from ``first`` (0 the foremost) on, ``size`` of them, as columns ``p1..p3``."""
    at = F.array(*WORDS)
    return [F.when(F.lit(i) < size, F.get(at, first + i)).otherwise(F.lit(0).cast("long")).alias(f"p{i + 1}") for i in range(3)]


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with ``l, r, score`` of their lowest-scoring cut."""
    parts = ["p1", "p2", "p3"]
    known = counts.where("size < 4").select(*[F.col(w).alias(p) for w, p in zip(WORDS, parts)], F.col("a").alias("f"))
    cuts = counts.where("size > 1").withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    left = cuts.select("*", *part(F.lit(0), F.col("k")))
    left = join_hot(left, known, parts, "inner").drop(*parts).withColumnRenamed("f", "l")
    both = left.select("*", *part(F.col("k"), F.col("size") - F.col("k")))
    both = join_hot(both, known, parts, "inner").drop(*parts).withColumnRenamed("f", "r")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    both = both.withColumns({"twice": F.lit(2_000_000).cast("decimal(7,0)") * wide("a"), "sum": wide("l") + wide("r")})
    both = both.withColumn("score", F.expr("twice div sum"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("b")
    return both.groupBy(*WORDS, "size", "a").agg(best).select(*WORDS, "size", "a", "b.l", "b.r", "b.score")


def not_covered(phrases: DataFrame, cover: int) -> DataFrame:
    """``phrases`` without those that lie inside a longer one with at least ``cover`` percent of their count."""
    spans = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(0, size - m), i -> struct(i, m))))")
    inside = phrases.where("size > 2").select(*WORDS, "a", F.explode(spans).alias("s"))
    inside = inside.select(*part(F.col("s.i"), F.col("s.m")), F.col("a").alias("most")).groupBy("p1", "p2", "p3").agg(F.max("most").alias("most"))
    inside = inside.select(F.col("p1").alias("w1"), F.col("p2").alias("w2"), F.col("p3").alias("w3"), F.lit(0).cast("long").alias("w4"), "most")
    joined = phrases.join(inside, WORDS, "left")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    return joined.where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * cover)).drop("most")


def ranked(phrases: DataFrame, ids: DataFrame, totals: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` phrases of each language.  Rows are cut to those that reach the ``keep``-th place, ties included, before
    their words are fetched: in parts of a language first, then over the parts' remains."""
    first = join_hot(phrases, ids.select(F.col("id").alias("w1"), "lang", F.col("word").alias("t1")), ["w1"], "inner")
    order = [F.col("score").desc(), F.col("a").desc()]
    rows = first.withColumn("salt", F.pmod(F.xxhash64(*WORDS), F.lit(64)))
    for keys in (["lang", "salt"], ["lang"]):
        rows = rows.withColumn("place", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= keep)
    for i in (2, 3, 4):
        word = ids.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"t{i}"))
        rows = rows.join(word, [f"w{i}"], "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3", "t4"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.col("phrase").asc()))
    rows = rows.withColumn("rank", place.cast("long")).where(F.col("rank") <= keep)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame, least: int = 30, keep: int = 2_000, cover: int = 80, listed: int = LISTED, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``keep`` best phrases of two to four words of each language.

    A text is cut at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into words; A-Z count as a-z.  ``a``
    occurrences (at least ``least``), ``l`` and ``r`` those of the two parts of the lowest-scoring cut, ``n`` words of the language,
    ``score = 2000000 a div (l + r)``.  Phrases inside a longer one with ``cover`` percent of their count are left out.

    Null and empty texts have no words, a null language is ``und``; repeated rows count each, ids and other columns are not read,
    an empty table gives no rows.  Ties go by ``a``, then by the phrase's bytes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "collocations")
    rows = docs.where(F.col(text).isNotNull()).select(F.coalesce(lang, F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words = scratch.keep(vocabulary(rows), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ids = Ids(words, least, listed, scratch)
    windows = scratch.keep(longest_windows(rows, ids, least), "windows")
    counts = scratch.keep(phrase_counts(windows, least), "counts")
    scratch.drop("windows")
    phrases = scratch.keep(not_covered(scored(counts), cover), "phrases")
    return ranked(phrases, ids.table, totals, keep)
