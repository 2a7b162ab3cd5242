"""Suffix-array dedup with a logarithmic index family (operator 6).

Texts come in batches.  A batch gets a sparse suffix array: the suffixes at its anchors (see `spans`), by anchor and then by the bytes that follow,
each in its piece, the stretch of bytes around the anchor whose windows it stands for.  The array is scanned by itself and merged
with each existing level of the index: neighbours' common prefixes tell how far two suffixes agree, the bytes before the anchors how far they agree to the
other side, and both together which windows of the two pieces are the same.  Then the batch becomes a level of its own, and levels that hold equally
many batches merge.  Anchors are dealt to buckets, each with its own index family, so levels are bounded and every bucket is a task of its own.

Where very many different pieces share an anchor (`CROWD`), the scan would meet all pairs of them; there the windows are looked up by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from heapq import merge

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from codestrata.llm import spans
from codestrata.llm.common import Scratch


#: Pieces of one anchor that are scanned pair by pair at most.
CROWD = 48


def agreeing(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high - 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def agreeing_end(a: bytes, b: bytes) -> int:
    """Length of the common end."""
    n = min(len(a), len(b))
    return agreeing(a[len(a) - n :][::-1], b[len(b) - n :][::-1])


class Level:
    """Suffixes of some batches in order, by anchor: the numbers of their pieces."""

    def __init__(self, groups: dict[int, list[int]], batches: int = 1):
        self.groups, self.batches = groups, batches

    @classmethod
    def of(cls, rows: np.ndarray, anchors: np.ndarray, suffix: Callable[[int], bytes]) -> Level:
        order = rows[np.argsort(anchors[rows], kind="stable")]
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(anchors[order]) != 0, [True]]))
        keys = anchors[order[cuts[:-1]]].tolist()
        order = order.tolist()
        return cls({key: sorted(order[a:b], key=suffix) if b - a > 1 else order[a:b] for key, a, b in zip(keys, cuts.tolist(), cuts[1:].tolist())})

    def merged(self, other: Level, suffix: Callable[[int], bytes]) -> Level:
        groups = self.groups | other.groups
        for key in self.groups.keys() & other.groups.keys():
            groups[key] = list(merge(self.groups[key], other.groups[key], key=suffix))
        return Level(groups, self.batches + other.batches)


class Family:
    """Levels of one bucket; `add` takes a batch and marks, in new and old pieces, windows that occur twice."""

    def __init__(self, pieces: dict[str, np.ndarray], length: int):
        self.p, self.length, self.levels = pieces, length, []
        self.whole = pieces["many"].astype(bool).copy()
        self.windows: dict[int, set[int]] = {}
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.text, self.offset, self.count = pieces["text"], pieces["offset"].tolist(), pieces["count"].tolist()

    def suffix(self, i: int) -> bytes:
        return self.text[i][self.offset[i] :]

    def add(self, rows: np.ndarray) -> None:
        new = Level.of(rows, self.p["anchor"], self.suffix)
        for group in new.groups.values():
            if len(group) > 1:
                self.scan(group, set(group))
        for old in self.levels:
            for key in new.groups.keys() & old.groups.keys():
                fresh = new.groups[key]
                self.scan(list(merge(old.groups[key], fresh, key=self.suffix)), set(fresh))
        self.levels.append(new)
        while len(self.levels) > 1 and self.levels[-1].batches == self.levels[-2].batches:
            last, before = self.levels.pop(), self.levels.pop()
            self.levels.append(before.merged(last, self.suffix))

    def scan(self, order: list[int], fresh: set[int]) -> None:
        """Marks what the suffixes of one anchor share, ``order`` being sorted; of two, one is ``fresh``."""
        if len(order) > CROWD:
            self.match([i for i in order if i in fresh], [i for i in order if i not in fresh])
            return
        common = [agreeing(self.suffix(a), self.suffix(b)) for a, b in zip(order, order[1:])]
        for at, i in enumerate(order):
            ahead, least = 1 << 62, self.length - self.offset[i]
            for to in range(at + 1, len(order)):
                ahead = min(ahead, common[to - 1])
                if ahead < least:
                    break
                j = order[to]
                if (i in fresh or j in fresh) and not (self.whole[i] and self.whole[j]) and self.place(i) != self.place(j):
                    back = agreeing_end(self.text[i][: self.offset[i]], self.text[j][: self.offset[j]])
                    for k in (i, j):
                        first, last = max(0, self.offset[k] - back), min(self.count[k] - 1, self.offset[k] + ahead - self.length)
                        if first <= last:
                            self.runs.setdefault(k, []).append((first, last))

    def place(self, i: int) -> tuple[int, int, int]:
        return int(self.p["ids"][i]), int(self.p["keys"][i]), int(self.p["start"][i])

    def match(self, new: list[int], old: list[int]) -> None:
        """Marks what pieces of one anchor share.  Pieces of the same place of the same text are one."""
        texts: dict[bytes, list[int]] = {}
        for i in [*old, *new]:
            texts.setdefault(self.p["text"][i], []).append(i)
        for same in texts.values():
            if len(same) > 1 and len({self.place(i) for i in same}) > 1:
                self.whole[same] = True
        if len(texts) == 1:
            return
        seen: dict[bytes, tuple[int, int] | None] = {}
        for text, same in texts.items():
            i, n, length = same[0], int(self.p["count"][same[0]]), self.length
            own = self.windows.setdefault(i, set())
            for at in range(n):
                window = text[at : at + length]
                if window not in seen:
                    seen[window] = (i, at)
                    continue
                own.add(at)
                first = seen[window]
                if first is not None:
                    self.windows.setdefault(first[0], set()).add(first[1])
                    seen[window] = None

    def marked(self) -> Iterator[tuple[int, int, int]]:
        for i in np.flatnonzero(self.whole).tolist():
            yield i, 0, self.count[i]
        for i in self.windows.keys() | self.runs.keys():
            if self.whole[i]:
                continue
            runs = [*self.runs.get(i, ()), *((at, at) for at in self.windows.get(i, ()))]
            end = first = -1
            for a, b in sorted(runs):
                if a > end + 1 or first < 0:
                    if first >= 0:
                        yield i, first, end - first + 1
                    first, end = a, b
                end = max(end, b)
            if first >= 0:
                yield i, first, end - first + 1


def shared(p: dict[str, np.ndarray], length: int, batches: int) -> Iterator[tuple[int, int, int]]:
    family = Family(p, length)
    batch = (p["ids"] ^ p["keys"]) % batches
    for b in range(batches):
        rows = np.flatnonzero(batch == b)
        if len(rows):
            family.add(rows)
    yield from family.marked()


def shared_runs(docs: DataFrame, text: str = "text", length: int = 200, gram: int = 24, batches: int = 4) -> DataFrame:
    """``__id, __key, start, n``: runs of windows of ``length`` bytes that also start elsewhere."""
    buckets = spans.buckets_for(docs, text, copied=1 + 2 * length / (length - gram + 2))
    pieces = spans.exchange(docs, text, False, length, gram, False, buckets)
    return spans.solved(pieces, lambda p: shared(p, length, batches), False, buckets)


def without_shared(docs: DataFrame, text: str = "text", length: int = 200, batches: int = 4) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256`` of every row: bytes under a string of ``length`` bytes that also starts
    anywhere else, in the same text too, are removed; ``kept`` is the rest (bytes, as a cut can fall inside a character).

    Null text: empty.  Rows equal in id and text are one document, given once for each row; rows that share only the id are two.
    Empty and short texts lose nothing; an empty table gives none; a null id stays; other columns are not read.  ``batches`` is into how many
    batches a text's hash deals the table; it does not change the result.
    """
    runs = Scratch(docs.sparkSession, "suffix-levels").keep(shared_runs(docs, text, length, batches=batches), "runs")
    rows = spans.with_runs(docs.select("doc_id", text), text, runs).select("doc_id", text, "__runs")
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = [
        ("doc_id", {"bigint": pa.int64(), "int": pa.int32()}[kind]), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept", pa.binary()), ("kept_sha256", pa.string()),
    ]

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, value, mine in zip(*(c.to_pylist() for c in batch.columns)):
                body, parts, at = (value or "").encode(), [], 0
                gone = spans.covered(mine, length)
                for a, b in gone:
                    parts.append(body[at:a])
                    at = b
                kept = b"".join([*parts, body[at:]])
                out.append((key, len(body), len(body) - len(kept), len(gone), kept, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

    return rows.mapInArrow(clean, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
