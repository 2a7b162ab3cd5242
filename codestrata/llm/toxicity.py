"""Toxicity: severity grades by cumulative-link ordinal regression on the words and word beginnings of a text (operator 1).

Ratings may be grades already (0: none).  Where they are only yes or no, `severities` grades the toxic rows of
the sample: 2 where it has more different words that go with the toxic label than the toxic rows' median, else 1."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.llm.common import give_back, small_batches
from codestrata.llm.ordinal import Ordinal, Rows, fit, number

WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def features(found: Iterable[str]) -> set[str]:
    """Distinct words and their beginnings of four to six letters, which inflected forms share."""
    out = set(found)
    out.update([f"{w[:n]}*" for w in out for n in (4, 5, 6) if len(w) > n])
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: Sequence[str], rows: int, longest: int) -> list:
    """At most ``rows`` labelled texts of at most ``longest`` characters, chosen by a hash of their id; rows
    with a null id, label or text are no examples.  ``rows * longest`` bounds what the driver gets."""
    chosen = (
        labels.select("doc_id", *columns).dropna().orderBy(F.xxhash64("doc_id", *columns), "doc_id", *columns).limit(rows)
    )
    texts = docs.select("doc_id", "text").where(F.length("text") <= longest)
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *columns)
    return one_of_each(sorted(found.toArrow().to_pylist(), key=lambda r: (r["doc_id"], r["text"], *(r[c] for c in columns))))


def one_of_each(sample: list[dict]) -> list[dict]:
    """The sample without further copies: a row goes if its smallest five-word hash, under one of three hashes, was
    seen.  Else the chance words of a text with many copies would look like signs of its grade."""
    seen: set[tuple[int, int]] = set()
    out = []
    for row in sample:
        found = words(row["text"])
        grams = [" ".join(found[i : i + 5]).encode() for i in range(max(1, len(found) - 4))]
        marks = {(k, min(zlib.crc32(g, k) for g in grams)) for k in range(3)}
        if seen.isdisjoint(marks):
            out.append(row)
        seen |= marks
    return out


def severities(texts: Sequence[str], rows: Rows, toxic: Sequence[int]) -> list[int]:
    """0 for rows not toxic, else 1 or 2.  A word is marked if it or a beginning of it goes with the toxic label."""
    if max(toxic, default=0) > 1:
        return list(toxic)
    is_toxic = np.asarray(toxic)[rows.owners()] > 0
    signs, n = np.unique(rows.values[is_toxic], return_counts=True)
    others = np.sort(rows.values[~is_toxic])
    among = np.searchsorted(others, signs, "right") - np.searchsorted(others, signs, "left")
    n_toxic = sum(t > 0 for t in toxic)
    marks = set(signs[(n >= 3) & (n / max(1, n_toxic) > 10 * (among + 0.5) / (len(toxic) - n_toxic + 1))].tolist())
    counts = [sum(not marks.isdisjoint(map(number, features([w]))) for w in set(words(text))) if t else 0 for text, t in zip(texts, toxic)]
    middle = float(np.median([c for c, t in zip(counts, toxic) if t] or [0]))
    return [0 if not t else 2 if c > middle else 1 for c, t in zip(counts, toxic)]


def train(docs: DataFrame, labels: DataFrame, rows: int = 6_000, longest: int = 20_000) -> Ordinal:
    """From at most ``rows`` labelled texts of at most ``longest`` characters.  Texts are taken apart one after another; what is held of
    all of them are numbers, and the names of the features that got a weight."""
    sample = labelled_sample(docs, labels, ["toxic"], rows, longest)
    texts, toxic = [r["text"] for r in sample], [r["toxic"] for r in sample]
    found = Rows(features(words(t)) for t in texts)
    model = fit(found, severities(texts, found, toxic))
    names = {number(f): f for t in texts for f in features(words(t)) if number(f) in model.weights}
    model.weights = {names[k]: w for k, w in model.weights.items()}
    return model


def score(docs: DataFrame, model: Ordinal, reject_at: float = 0.25) -> DataFrame:
    """``doc_id, expected_severity, p_toxic, severity, toxic`` of every whole text; toxic where
    ``P(severity > 0) >= reject_at``.

    Null or empty text: no words, so the grade of the bare thresholds.  A null id stays, repeated rows are scored each,
    an empty table gives none, other columns are not read.  A model without two grades gives its only one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # screened weights: at most a few thousand

    def grade(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in batches:
            tails = [mine.tails(features(words(t))) for t in batch.column(1).to_pylist()]
            first = [t[0] if t else float(mine.constant > 0) for t in tails]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([mine.expected(t) for t in tails], pa.float64()), pa.array(first, pa.float64()),
                    pa.array([mine.grade(t) for t in tails], pa.int32()), pa.array([p >= reject_at for p in first], pa.bool_()),
                ],
                names=["doc_id", "expected_severity", "p_toxic", "severity", "toxic"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(grade, f"doc_id {kind}, expected_severity double, p_toxic double, severity int, toxic boolean")


def without_toxic(docs: DataFrame, model: Ordinal, reject_at: float = 0.25) -> DataFrame:
    """The rows of ``docs``, all columns as they were, whose text `score` would not call toxic."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def passing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in batches:
            tails = [mine.tails(features(words(t))) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([(t[0] if t else float(mine.constant > 0)) < reject_at for t in tails], pa.bool_()))
        give_back()

    return docs.mapInArrow(passing, docs.schema)
