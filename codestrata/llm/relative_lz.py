"""Substring dedup by relative Lempel-Ziv parsing (operator 5).

The reference is the whole table, indexed in blocks: a block holds all pieces (see `spans`) of its share of anchors, and a text's pieces
are sent to the blocks that hold their anchors, so every window meets every place where it could occur.  Within a block
pieces come in the order of (id, key, start), and each is parsed greedily into factors against the pieces before it: a factor is the longest
stretch that goes on word by word in one earlier piece.  A factor of at least ``length`` words is a repeat. Where it
ends, the windows across its end are looked up one by one until the next factor begins, as another earlier piece may hold them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from codestrata.llm import spans
from codestrata.llm.common import Scratch


def factors(text: list[bytes], windows: int, length: int, index: dict, reference: list[list[bytes]]) -> list[tuple[int, int]]:
    """Runs ``(first, number)`` of windows of ``text`` that lie in factors against ``reference``; ``text`` joins it."""
    out, at, me = [], 0, len(reference)
    reference.append(text)
    while at < windows:
        key = b" ".join(text[at : at + length])
        found = index.get(key)
        if found is None:
            index[key] = (me, at)
            at += 1
            continue
        source, place = reference[found[0]], found[1]
        end, there = at + length, place + length
        while end < len(text) and there < len(source) and text[end] == source[there]:
            end, there = end + 1, there + 1
        out.append((at, end - length + 1 - at))
        at = end - length + 1
    return out


def repeats(p: dict[str, np.ndarray], length: int) -> Iterator[tuple[int, int, int]]:
    order = np.lexsort((p["start"], p["keys"], p["ids"], p["anchor"]))
    anchor = p["anchor"][order]
    cuts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]]))
    for at in np.flatnonzero(np.diff(cuts) > 1).tolist():
        whole: dict[bytes, int] = {}
        index: dict[bytes, tuple[int, int]] = {}
        reference: list[list[bytes]] = []
        place = None
        waiting = -1  # the first piece is parsed only when a different one comes
        for i in order[cuts[at] : cuts[at + 1]].tolist():
            here = (p["ids"][i], p["keys"][i], p["start"][i])
            if here == place:
                continue  # a repeated row
            place = here
            text = p["text"][i]
            if text in whole:
                yield i, 0, int(p["count"][i])
                continue
            whole[text] = i
            if len(whole) == 1:
                waiting = i
                continue
            for j in (waiting, i) if waiting >= 0 else (i,):
                for first, n in factors(p["text"][j].split(b" "), int(p["count"][j]), length, index, reference):
                    yield j, first, n
            waiting = -1


def repeated_runs(docs: DataFrame, text: str = "text", length: int = 20, gram: int = 4) -> DataFrame:
    """``__id, __key, start, n``: runs of windows of ``length`` words that also start earlier."""
    # a word is in 1 + 2 * length / (windows an anchor is the smallest of) pieces on average
    buckets = spans.buckets_for(docs, text, copied=1 + 2 * length / (length - gram + 2))
    pieces = spans.exchange(docs, text, True, length, gram, True, buckets)
    return spans.solved(pieces, lambda p: repeats(p, length), True, buckets)


def without_repeats(docs: DataFrame, text: str = "text", length: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256, removed`` of every row: words (split at ASCII white space) that lie in a
    window of ``length`` words whose sequence also starts earlier, by (doc_id, start), are removed; ``removed`` lists
    stretches of word positions, ``kept`` is the other words joined by a space.

    Null text: no words.  A null id comes before all others; rows that repeat an id are ordered by a hash of their text; rows equal in both
    are one document, given once for each row.  Empty and short texts lose nothing; an empty table gives none; other columns are not read.
    """
    runs = Scratch(docs.sparkSession, "relative-lz").keep(repeated_runs(docs, text, length), "runs")
    rows = spans.with_runs(docs.select("doc_id", text), text, runs).select("doc_id", text, "__runs")

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = [
        ("doc_id", {"bigint": pa.int64(), "int": pa.int32()}[kind]), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
        ("kept_sha256", pa.string()), ("removed", pa.list_(pa.list_(pa.int64()))),
    ]

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, value, mine in zip(*(c.to_pylist() for c in batch.columns)):
                words = (value or "").encode().split()
                gone = spans.covered(mine, length)
                kept = words
                if gone:
                    keep = np.ones(len(words), bool)
                    for a, b in gone:
                        keep[a:b] = False
                    kept = [words[i] for i in np.flatnonzero(keep).tolist()]
                body = b" ".join(kept)
                out.append((key, len(words), len(words) - len(kept), body.decode(), hashlib.sha256(body).hexdigest(), [list(g) for g in gone]))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

    return rows.mapInArrow(clean, f"doc_id {kind}, n_words long, n_removed long, kept string, kept_sha256 string, removed array<array<long>>")
