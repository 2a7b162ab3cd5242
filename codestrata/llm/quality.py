"""Quality: graded ratings by cumulative-link ordinal regression on hashed text features (operator 2).

Weights are shared by all thresholds and live in ``2 ** bits`` hash buckets, of which only screened ones are kept.
Ratings of the given labels: 0 poor, 1 good but toxic, 2 good."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.llm.common import small_batches
from codestrata.llm.ordinal import Ordinal, Rows, fit
from codestrata.llm.toxicity import labelled_sample

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")


def shapes(text: str, tokens: list[str]) -> list[str]:
    """What a text looks like, in coarse steps, as further tokens."""
    n = max(1, len(tokens))
    letters = [t for t in tokens if t[0].isalpha()]
    lines = [line for line in text.split("\n") if line.strip()]
    parts = {
        "capitals": sum(len(t) > 1 and t.isupper() for t in letters) / max(1, len(letters)),
        "marks": sum(not t[0].isalnum() for t in tokens) / n,
        "digits": sum(t[0].isdigit() for t in tokens) / n,
        "distinct": len(set(tokens)) / n,
        "lines": len(set(lines)) / max(1, len(lines)),
    }
    out = [f"\x00{name} {int(10 * share)}" for name, share in parts.items()]
    out.append(f"\x00length {len(tokens).bit_length()}")
    out.append(f"\x00word length {sum(map(len, letters)) // max(1, len(letters))}")
    return out


def hashed(text: str | None, bits: int) -> set[int]:
    """Hash buckets of a text's lower-cased words, marks and numbers, and of its shapes."""
    tokens = TOKEN.findall(text or "")
    distinct = {t.lower() for t in set(tokens)}
    mask = (1 << bits) - 1
    return {zlib.crc32(t.encode()) & mask for t in [*distinct, *shapes(text or "", tokens)]}


def train(docs: DataFrame, labels: DataFrame, bits: int = 22, rows: int = 6_000, longest: int = 20_000) -> Ordinal:
    """From at most ``rows`` rated texts of at most ``longest`` characters.  A ``rating`` column is taken as it is;
    else ``quality`` and ``toxic`` give it."""
    if "rating" in labels.columns:
        rated = labels.select("doc_id", "rating")
    else:
        rated = labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("rating"))
    sample = labelled_sample(docs, rated, ["rating"], rows, longest)
    return fit(Rows(hashed(r["text"], bits) for r in sample), [int(r["rating"]) for r in sample])


def score(docs: DataFrame, model: Ordinal, bits: int = 22, least: int = 1, keep_at: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, p_tail, grade, keep`` of every whole text; ``p_tail`` is ``P(grade >= least)``, and a
    row is kept where that is at least ``keep_at``.

    Null or empty text: the features of no text.  A null id stays, repeated rows are scored each, an empty table gives none,
    other columns are not read.  A model without two grades gives its only one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # screened weights: at most a few thousand

    def grade(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in batches:
            tails = [mine.tails(hashed(t, bits)) for t in batch.column(1).to_pylist()]
            tail = [(t[least - 1] if len(t) >= least else 0.0) if mine.thresholds else float(mine.constant >= least) for t in tails]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([mine.expected(t) for t in tails], pa.float64()), pa.array(tail, pa.float64()),
                    pa.array([mine.grade(t) for t in tails], pa.int32()), pa.array([p >= keep_at for p in tail], pa.bool_()),
                ],
                names=["doc_id", "expected_grade", "p_tail", "grade", "keep"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(grade, f"doc_id {kind}, expected_grade double, p_tail double, grade int, keep boolean")
