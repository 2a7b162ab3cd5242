"""Benchmark decontamination by winnowing, in DataFrame functions only (operator 4).

Both sides keep, of the hashes of ``k`` consecutive words, those that are the minimum of some ``w`` consecutive ones.  With ``k + w - 1``
words, a shared stretch holds a kept fingerprint on both sides; that length is the shortest window's of a class of window lengths, so no
window can be missed.  Documents' fingerprints meet the distinct ones of the benchmark; each hit is extended to all windows that
it stands for, and those are compared word for word with the benchmark's windows.

Lower case is A-Z only, as asked; fingerprints are of Spark's ``lower``, which makes equal all that is equal so, and more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codestrata.llm.common import Scratch, free_name, text_key

#: Of text in either case; A-Z are letters of a word, as they are to be lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fingerprints of the benchmark are broadcast up to this number (some 50 bytes each), and shuffled beyond it.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def classes(lengths: list[int]) -> list[list[int]]:
    """Window lengths that share fingerprints: 1, 2 to 3, 4 to 7, 8 to 15, ...  So a short item makes no fingerprints of
    longer windows shorter."""
    out: dict[int, list[int]] = {}
    for n in sorted(lengths):
        out.setdefault(n.bit_length(), []).append(n)
    return list(out.values())


def winnowed(rows: DataFrame, shortest: int) -> DataFrame:
    """``rows`` (with ``__words``) with ``__least``: the minimum fingerprint of every ``shortest`` consecutive words, by their first.  Every word is
    hashed once; steps are columns of their own, each used more than once, so that none is computed again for every word."""
    k = (shortest + 1) // 2
    w = shortest - k + 1
    steps = lambda array, n: f"if(size({array}) >= {n}, sequence(0, size({array}) - {n}), cast(array() as array<int>))"
    picks = lambda array, n: ", ".join(f"get({array}, i + {j})" for j in range(n))
    rows = rows.withColumn("__hashes", F.transform("__words", lambda x: F.xxhash64(F.lower(x))))
    rows = rows.withColumn("__grams", F.expr(f"transform({steps('__hashes', k)}, i -> xxhash64({picks('__hashes', k)}))")).drop("__hashes")
    if w == 1:
        return rows.withColumnRenamed("__grams", "__least")
    return rows.withColumn("__least", F.expr(f"transform({steps('__grams', w)}, i -> least({picks('__grams', w)}))")).drop("__grams")


def item_windows(benchmark: DataFrame, length: int) -> DataFrame:
    """``item, __n, __window``: the distinct windows of each item, as words joined by a space.  Items without id or words have none."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.translate("text", UPPER, LOWER)).alias("__words"))
    rows = rows.where(F.col("item").isNotNull() & (F.size("__words") > 0)).withColumn("__n", F.least(F.lit(length), F.size("__words")))
    window = F.expr("transform(sequence(1, size(__words) - __n + 1), i -> array_join(slice(__words, i, __n), ' '))")
    return rows.withColumn("__all", F.array_distinct(window)).select("item", "__n", F.explode("__all").alias("__window")).distinct()


def fingerprints(docs: DataFrame, shortest: int, text: str) -> DataFrame:
    """``doc_id, __key, __words, __least, __at, __hash``: a row for each kept fingerprint of each document, ``__at`` (from 0) being the
    first of the neighbouring windows that have it; and one row without a hash for each document."""
    source = docs.select("doc_id", text_key(text).alias("__key"), words(F.col(text)).alias("__words"))
    rows = winnowed(source, shortest)
    kept = F.expr("transform(__least, (h, i) -> if(i > 0 AND h = get(__least, i - 1), null, h))")
    # the document's own row comes as a last element
    rows = rows.withColumn("__kept", F.concat(kept, F.array(F.lit(None).cast("long"))))
    # an inner explode would put a filter on the array below these steps, and with it the array's whole computation, again
    rows = rows.select("doc_id", "__key", "__words", "__least", F.posexplode_outer("__kept").alias("__at", "__hash"))
    return rows.where(F.col("__hash").isNotNull() | (F.col("__at") == F.size("__least")))


def around(rows: DataFrame, longest: int) -> DataFrame:
    """``doc_id, __key, __hash, __at, __run, __around`` of rows of `fingerprints`: how many neighbouring windows have this one, and the
    words from the first of them on, as many as a window of ``longest`` words can take."""
    other = "array_position(transform(slice(__least, __at + 1, size(__least)), h -> h <> __hash), true)"
    rows = rows.withColumn("__run", F.expr(f"if(__hash is null, null, cast(if({other} = 0, size(__least) - __at, {other} - 1) as int))"))
    near = F.expr(f"if(__hash is null, null, slice(__words, __at + 1, __run + {longest} - 1))")
    return rows.withColumn("__around", near).drop("__words", "__least")


def candidates(found: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id, __key, start, n, window`` of all windows that begin where a found fingerprint is the least."""
    lower = F.split(F.translate(F.array_join("__around", " "), UPPER, LOWER), " ")
    tried = found.withColumn("__around", lower).withColumn("n", F.explode(F.array(*map(F.lit, lengths))))
    tried = tried.where(F.size("__around") >= F.col("n"))
    tried = tried.withColumn("i", F.explode(F.expr("sequence(0, least(__run, size(__around) - n + 1) - 1)")))
    window = F.expr("array_join(slice(__around, i + 1, n), ' ')")
    return tried.select("doc_id", "__key", (F.col("__at") + F.col("i") + 1).cast("int").alias("start"), "n", window.alias("window"))


def scan(docs: DataFrame, benchmark: DataFrame, length: int, text: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``doc_id, __key, start, n, window``: every occurrence of an item's window in a document, by word from 1; and
    ``doc_id, __key, n_words`` of every document.  A document is read once for each class of window lengths, mostly the only one."""
    windows = scratch.keep(item_windows(benchmark, length), "windows")
    found = base = None
    # at most `length` different window lengths
    for lengths in classes([r[0] for r in windows.select("__n").distinct().collect()]):
        own = windows.where(F.col("__n").isin(lengths))
        marks = winnowed(own.select(F.split("__window", " ").alias("__words")), lengths[0])
        marks = scratch.keep(marks.select(F.explode(F.array_distinct("__least")).alias("__hash")).distinct(), f"marks-{lengths[0]}")
        prints = fingerprints(docs, lengths[0], text)
        if marks.count() <= BROADCAST_ROWS:
            marked = prints.join(F.broadcast(marks.withColumn("__mark", F.lit(True))), "__hash", "left").where("__mark OR __hash IS NULL")
            marked = marked.withColumn("n_words", F.size("__words").cast("long"))
            marked = scratch.keep(around(marked, lengths[-1]), f"marked-{lengths[0]}")
            base = marked.where("__hash IS NULL").select("doc_id", "__key", "n_words")
            marked = marked.where("__hash IS NOT NULL")
        else:  # without the documents' own rows, which all lack a hash
            marked = around(prints.where("__hash IS NOT NULL"), lengths[-1]).join(marks, "__hash", "left_semi")
        real = own.select(F.col("__n").alias("n"), F.col("__window").alias("window")).distinct()
        seen = candidates(marked, lengths).join(real, ["n", "window"], "left_semi").select("doc_id", "__key", "start", "n", "window").distinct()
        found = seen if found is None else found.unionByName(seen)
    if base is None:
        n_words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
        base = docs.select("doc_id", text_key(text).alias("__key"), n_words.alias("n_words"))
    if found is None:
        kind = docs.schema["doc_id"].dataType
        found = docs.sparkSession.createDataFrame([], "doc_id long, __key long, start int, n int, window string").withColumn("doc_id", F.col("doc_id").cast(kind))
    return found, base


def hits(docs: DataFrame, benchmark: DataFrame, length: int = 10, text: str = "text") -> DataFrame:
    """``doc_id, __key, start, n, window``: every occurrence of an item's window in a document, by word from 1."""
    return scan(docs, benchmark, length, text, Scratch(docs.sparkSession, "decontamination"))[0]


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, items, contaminated`` of every row of ``docs``.

    A window is ``length`` consecutive words of an item, or a shorter item as a whole; a word inside any occurrence of a
    window is hit.  Null and empty texts have no words.  Items without id or words are none; items of one id are one.  Rows of one
    doc_id are told apart by their text, equal rows get equal results; a null doc_id stays.  Empty tables: no rows, or no hits.  Other
    columns are not read.  A document's hits are gathered in one row, at most one for each of its words and window lengths.
    """
    scratch = Scratch(docs.sparkSession, "contamination")
    found, base = scan(docs, benchmark, length, text, scratch)
    found = scratch.keep(found, "hits")
    stretches = F.sort_array(F.collect_list(F.struct(F.col("start"), (F.col("start") + F.col("n")).alias("end"))))
    step = (
        "aggregate(__s, struct(0 AS reach, 0 AS total), (a, x) -> struct(greatest(a.reach, x.end) AS reach, "
        "a.total + greatest(0, x.end - greatest(a.reach, x.start)) AS total), a -> a.total)"
    )
    hit = found.groupBy("doc_id", "__key").agg(stretches.alias("__s")).select("doc_id", "__key", F.expr(step).cast("long").alias("n_hit"))
    named = item_windows(benchmark, length).select("item", F.col("__n").alias("n"), F.col("__window").alias("window"))
    pairs = found.select("doc_id", "__key", "n", "window").distinct().join(named, ["n", "window"]).select("doc_id", "__key", "item").distinct()
    items = pairs.groupBy("doc_id", "__key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    per = hit.alias("h").join(items.alias("i"), F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("h.__key") == F.col("i.__key")))
    per = per.select(F.col("h.doc_id").alias("__id"), F.col("h.__key").alias("__k"), "n_hit", "items")
    out = base.join(per, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__k")), "left")
    none = F.array().cast("array<string>")
    out = out.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", none)})
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "items", (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """The rows of ``docs``, as they were, without a hit."""
    own, key = free_name("__id", docs), free_name("__k", docs)
    found = Scratch(docs.sparkSession, "decontaminated").keep(
        hits(docs, benchmark, length).select(F.col("doc_id").alias(own), F.col("__key").alias(key)).distinct(), "hits"
    )
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(own)) & (text_key() == F.col(key)), "left_anti")
