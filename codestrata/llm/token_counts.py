"""Token counts by a map-side two-tier lookup (operator 9).

The lengths (in tokens) of frequent pre-tokens are broadcast as one compact table of at most
``frequent`` entries; pre-tokens outside it are encoded once by the worker that meets them and kept
in its bounded cache.  There is no shuffle of pre-tokens: the counting pass is map-only.

A pre-token is cut where no merge can cross: no piece of the vocabulary has a word mark after
another character, and none holds a line feed, so a run of spaces with the word behind it, a line feed,
and a run of trailing spaces are encoded independently of their neighbours.  `PieceCounter` checks
those properties on the loaded model and falls back to encoding whole texts where they fail.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.llm.common import small_batches

SPACES = " ▁"
PIECE = re.compile(f"\n|[{SPACES}]*[^{SPACES}\n]+|[{SPACES}]+")

#: One counter for each model and worker process; its cache outlives a task.
_COUNTERS: dict[str, "PieceCounter"] = {}


class PieceCounter(dict):
    """Pre-token -> number of tokens.  A dict whose misses are encoded, kept up to ``limit`` entries."""

    def __init__(self, model: str, limit: int):
        import sentencepiece

        super().__init__()
        self.limit = limit
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        probe = "Ａ ﬁ  ①"
        self.separable = (
            not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
            and self.model.decode(self.model.encode(probe)) == probe
            and self.model.encode("\nx") == self.model.encode("\n") + self.model.encode("\nx")[len(self.model.encode("\n")) :]
            and len(self.model.encode("\n")) == 2
        )

    def __missing__(self, piece: str) -> int:
        # a leading line feed keeps the model from adding its word mark to the piece: two tokens, taken off
        n = len(self.model.encode("\n" + piece)) - 2
        if len(self) >= self.limit:
            self.clear()
            self.update(self.frequent)
        self[piece] = n
        return n

    frequent: dict[str, int] = {}

    def use(self, frequent: dict[str, int]) -> None:
        if self.frequent is not frequent:
            self.frequent = frequent
            self.update(frequent)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.separable:
            return len(self.model.encode(text))
        return sum(map(self.__getitem__, PIECE.findall(" " + text)))


def counter(model: str, limit: int) -> PieceCounter:
    if model not in _COUNTERS:
        _COUNTERS[model] = PieceCounter(model, limit)
    return _COUNTERS[model]


def frequent_pieces(docs: DataFrame, text: str, size: int, sample_rows: int) -> list[str]:
    """The ``size`` most frequent pre-tokens of about ``sample_rows`` texts, spread over the table by
    hash.  They only fill the first tier: the counts do not depend on them."""
    step = max(1, docs.count() // max(1, sample_rows))

    def top(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen.update(PIECE.findall(" " + value))
        best = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:size]
        yield pa.RecordBatch.from_pydict({"piece": pa.array([p for p, _ in best], pa.string()), "n": pa.array([n for _, n in best], pa.int64())})

    rows = (
        docs.select(text)
        .where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(F.col(text)), F.lit(step)) == 0))
        .mapInArrow(top, "piece string, n long")
        .toArrow()
    )
    total: Counter[str] = Counter()
    for piece, n in zip(rows.column("piece").to_pylist(), rows.column("n").to_pylist()):
        total[piece] += n
    return [p for p, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:size]]


def count_tokens(
    docs: DataFrame, model: str, id_column: str = "doc_id", text: str = "text",
    frequent: int = 32_768, sample_rows: int = 1_000, cache: int = 600_000,
) -> DataFrame:
    """``id, n_bytes, n_tokens`` of each whole text, as the model's library counts them (no begin
    or end mark, no limit).

    Null or empty text: 0 bytes, 0 tokens.  A null id stays; repeated rows are counted each; an empty
    table gives none; other columns are not read.  ``frequent`` bounds the broadcast table, ``sample_rows`` the
    sample it is chosen from, ``cache`` the entries of a worker; none of them changes a count.
    """
    spark = docs.sparkSession
    small_batches(spark)
    mine = counter(model, cache)
    table = {p: mine[p] for p in frequent_pieces(docs, text, frequent, sample_rows)} if mine.separable else {}
    # pre-tokens and lengths side by side: at most `frequent` short texts and small numbers
    shared = spark.sparkContext.broadcast(table)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = counter(model, cache)
        lengths.use(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64()),
                    pa.array(map(lengths.count, texts), pa.int64()),
                ],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    out = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_column)
