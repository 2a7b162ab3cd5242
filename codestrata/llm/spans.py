"""Pieces of texts that every shared long string meets in (for operators 5 and 6).

A text is a row of units (words or bytes); a window is ``length`` consecutive units.  Every window is assigned to its anchor: the
``gram`` units of the smallest hash in it, the leftmost of equals.  Equal windows have equal anchors, so they can only meet among the pieces
of one anchor.  A piece is all windows of a text with the same anchor *position*: one stretch of text.  Pieces are dealt out by anchor;
identical pieces are joined before that, so a passage in a third of all texts sends one piece for each chunk of input and not for each text.

A short line in many texts gives its anchor as many different pieces as there are texts around it.  Such hot anchors are found in a sample of the
texts; their pieces are not sent, but their windows, each by a hash of 128 bits and dealt out by that, so no group holds the pieces
of a hot anchor.  Which anchors count as hot changes where windows meet and not what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.llm.common import Scratch, shuffle_partitions, small_batches, text_key

NO_ID = -(1 << 63)
PLACE = 24  # bits for a position in a chunk
CHUNK = 2_000_000  # bytes worked on at a time; longer texts are cut, with an overlap
HELD = 12 << 20  # bytes of text whose pieces go out together
SAMPLE = 32 << 20  # bytes of text that hot anchors are looked for in
HOT = 1 / 1000  # share of the sample's pieces that makes an anchor hot, so there are fewer than 1000
HOT_LEAST = 64  # and at least so many pieces

BASE = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo two to the 64."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            _POWERS[name] = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, base, np.uint64))])
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Hashes of any stretch of a row of numbers, from one running sum."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


@dataclass
class Pieces:
    """Of a chunk: the anchor's hash, the text's id and key, the first window (unit in the text), the number of windows, where the
    piece's bytes are, and at which of its units the anchor is."""

    anchor: np.ndarray
    ids: np.ndarray
    keys: np.ndarray
    start: np.ndarray
    count: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    data: bytes
    at: np.ndarray
    numbers: np.ndarray
    length: int
    offset: np.ndarray

    def windows(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All windows of some pieces: the piece, the place in it, and two hashes of the window's units."""
        count = self.count[pieces]
        owner = np.repeat(pieces, count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = self.at[owner] + place
        hashes = [Prefix(mixed(self.numbers ^ np.uint64(seed))).of(start, start + self.length) for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
        return owner, place, *hashes


def cut(texts: list[tuple[int, int, int, bytes]], words: bool, length: int, gram: int) -> Pieces | None:
    """Pieces of ``(id, key, first unit, text)``; of words, texts are words joined by one space."""
    texts = [t for t in texts if t[3]]
    if not texts:
        return None
    data = b"\n".join([t[3] for t in texts]) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    over_bytes = Prefix(raw.astype(np.uint64))
    sizes = np.array([len(t[3]) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    if words:
        word_end = np.flatnonzero((raw == 32) | (raw == 10))
        word_start = np.concatenate([[0], word_end[:-1] + 1])
        last = np.searchsorted(word_end, ends) + 1
        first = np.concatenate([[0], last[:-1]])
        numbers = over_bytes.of(word_start, word_end)
        units = Prefix(numbers)
        n = len(word_end)
    else:
        first, last = ends - sizes, ends
        numbers = raw.astype(np.uint64)
        units, n = over_bytes, len(raw)
    if n < length:
        return None
    at = np.arange(n - gram + 1)
    grams = units.of(at, at + gram)
    low = np.uint64((1 << PLACE) - 1)
    anchors = (smallest((grams & ~low) | at.astype(np.uint64), length - gram + 1) & low).astype(np.int64)
    inside = np.zeros(n + 1, np.int8)
    full = last - first >= length
    np.add.at(inside, first[full], 1)
    np.add.at(inside, last[full] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:n]) > 0)
    if not len(windows):
        return None
    place = anchors[windows]
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    a, count = windows[new], np.diff(np.concatenate([new, [len(windows)]]))
    doc = np.searchsorted(last, a, side="right")
    stop = a + count + length - 1
    begin, end = (word_start[a], word_end[stop - 1]) if words else (a, stop)
    return Pieces(
        grams[place[new]], np.array([t[0] for t in texts], np.int64)[doc], np.array([t[1] for t in texts], np.int64)[doc],
        a - first[doc] + np.array([t[2] for t in texts], np.int64)[doc], count, begin, end, over_bytes.of(begin, end), data, a, numbers, length, place[new] - a,
    )


def segments(rows: Iterable[tuple[int, int, bytes]], words: bool, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Texts as ``(id, key, first unit, text)`` of at most about a chunk; those of one text overlap so that every window is whole
    in one.  A text without a window gives none."""
    for key_id, key, text in rows:
        if not words:
            for at in range(0, len(text) - length + 1, CHUNK):
                yield key_id, key, at, text[at : at + CHUNK + length - 1]
            continue
        found = text.split()
        step = CHUNK // 8
        for at in range(0, len(found) - length + 1, step):
            yield key_id, key, at, b" ".join(found[at : at + step + length - 1])


def chunks(rows: Iterable[tuple[int, int, bytes]], words: bool, length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    held, size = [], 0
    for piece in segments(rows, words, length):
        if held and size + len(piece[3]) > CHUNK:
            yield held
            held, size = [], 0
        held.append(piece)
        size += len(piece[3]) + 1
    if held:
        yield held


PACKED = (
    "bucket int, n int, anchor binary, ids binary, keys binary, start binary, count binary, offset binary, many binary, sizes binary, "
    "texts binary, settled binary"
)
SPANS = "__id long, __key long, start long, n long"


def packed(parts: list[tuple[Pieces, np.ndarray, np.ndarray]], buckets: int, settled: bytes) -> Iterator[pa.RecordBatch]:
    """One row a bucket of the pieces picked from each chunk, their texts compressed together; the first row takes the settled runs."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=7).compress
    texts = [np.array([p.data[b:e] for b, e in zip(p.begin[i].tolist(), p.end[i].tolist())], object) for p, i, _ in parts]
    columns = {c: np.concatenate([getattr(p, c)[i] for p, i, _ in parts]) for c in ("anchor", "ids", "keys", "start", "count", "offset")}
    columns["many"] = np.concatenate([m for _, _, m in parts])
    text = np.concatenate(texts)
    bucket = ((columns["anchor"] >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((columns["anchor"], bucket))
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0]))
    for at, to in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        own = order[at:to]
        mine = text[own].tolist()
        kinds = {"anchor": "<u8", "ids": "<i8", "keys": "<i8", "start": "<u4", "count": "<u4", "offset": "<u4", "many": "u1"}
        row = {"bucket": pa.array([int(bucket[own[0]])], pa.int32()), "n": pa.array([len(own)], pa.int32())}
        row |= {c: [squeeze(columns[c][own].astype(kind).tobytes())] for c, kind in kinds.items()}
        row["sizes"] = [squeeze(np.array([len(t) for t in mine], "<u4").tobytes())]
        row["texts"] = [squeeze(b"".join(mine))]
        row["settled"] = [settled]
        settled = b""
        yield pa.RecordBatch.from_pydict(row)


def packed_windows(parts: list[tuple[np.ndarray, ...]], buckets: int, settled: bytes) -> Iterator[pa.RecordBatch]:
    """One row a bucket of windows ``(hash, hash, id, key, start, many)``; these buckets come after those of the pieces."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    columns = [np.concatenate(x) for x in zip(*parts)]
    bucket = (columns[0] % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((columns[0], bucket))
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0]))
    names = {"anchor": "<u8", "texts": "<u8", "ids": "<i8", "keys": "<i8", "start": "<u4", "many": "u1"}
    for at, to in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        own = order[at:to]
        row = {c: [squeeze(x[own].astype(kind).tobytes())] for (c, kind), x in zip(names.items(), columns)}
        row |= {"bucket": pa.array([buckets + int(bucket[own[0]])], pa.int32()), "n": pa.array([len(own)], pa.int32()), "count": [b""], "offset": [b""], "sizes": [b""], "settled": [settled]}
        settled = b""
        yield pa.RecordBatch.from_pydict({name.split(" ")[0]: row[name.split(" ")[0]] for name in PACKED.split(", ")})


def first_of_each(columns: list[np.ndarray], first_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of windows ``(hash, hash, id, key, start, many)`` the first of each content, whether it stands more than once, and the windows
    that are to go: all others (``first_only``), or all of a content that stands more than once.  A window that comes
    twice, of a repeated row, is one."""
    h1, h2, ids, keys, start, many = columns
    order = np.lexsort((start, keys, ids, h2, h1))
    content = np.ones(len(order), bool)
    content[1:] = (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]])
    place = content.copy()
    place[1:] |= (ids[order[1:]] != ids[order[:-1]]) | (keys[order[1:]] != keys[order[:-1]]) | (start[order[1:]] != start[order[:-1]])
    group = np.cumsum(content) - 1
    n = np.bincount(group, place)
    again = (n > 1) | (np.bincount(group, many[order]) > 0)
    gone = order[place & ~content] if first_only else order[place & again[group]]
    return order[content], again, gone


def unpacked(table: pa.Table) -> dict[str, np.ndarray]:
    """The pieces of a bucket, of all its rows; ``text`` holds bytes."""
    import zstandard

    restore = zstandard.ZstdDecompressor().decompress
    kinds = {"anchor": "<u8", "ids": "<i8", "keys": "<i8", "start": "<u4", "count": "<u4", "offset": "<u4", "many": "u1", "sizes": "<u4"}
    out = {c: np.concatenate([np.frombuffer(restore(v.as_py()), kind) for v in table.column(c)]) for c, kind in kinds.items()}
    texts = b"".join([restore(v.as_py()) for v in table.column("texts")])
    ends = np.cumsum(out["sizes"].astype(np.int64))
    out["text"] = np.array([texts[e - s : e] for s, e in zip(out["sizes"].tolist(), ends.tolist())] + [b""], object)[:-1]
    return out


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``__id`` and ``__key``, which together name a row; a null id and a null text have a place of their own."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__key": text_key(text)})


def buckets_for(docs: DataFrame, text: str, copied: float, bucket_bytes: int = 16 << 20) -> int:
    """So many that a bucket's pieces, ``copied`` times the text, stay below ``bucket_bytes``; with some to spare for
    an even load."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(4 * shuffle_partitions(docs.sparkSession), int(total * copied / bucket_bytes) + 1)


def joined_runs(ids: np.ndarray, keys: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple:
    """Neighbouring runs of windows of one text as one run."""
    order = np.lexsort((start, keys, ids))
    ids, keys, start, count = (x[order].astype(np.int64) for x in (ids, keys, start, count))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (start[1:] != start[:-1] + count[:-1])
    at = np.flatnonzero(new)
    return (ids[at], keys[at], start[at], np.add.reduceat(count, at)) if len(at) else (ids, keys, start, count)


def hot_anchors(docs: DataFrame, text: str, words: bool, length: int, gram: int) -> np.ndarray:
    """Anchors that stand for a `HOT` share of the different pieces of a sample of the texts, ascending: fewer than ``1 / HOT``."""
    small_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    share = max(1, round(1_000_000 * min(1.0, SAMPLE / max(1, total))))
    some = keyed(docs, text).where(F.pmod(F.xxhash64("__id", "__key"), F.lit(1_000_000)) < share)
    source = some.select("__id", "__key", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(sorted(set(zip(*(c.to_pylist() for c in batch.columns)))), words, length):
                p = cut(chunk, words, length, gram)
                if p is not None:
                    _, first = np.unique(p.hashes, return_index=True)
                    anchors, n = np.unique(p.anchor[first], return_counts=True)
                    # those of one piece are only counted, under 0
                    anchors, n = np.append(anchors[n > 1], np.uint64(0)), np.append(n[n > 1], (n == 1).sum())
                    yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchors.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    sums = source.mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    sums = Scratch(docs.sparkSession, "hot-anchors").keep(sums, "sums")
    pieces = sums.agg(F.sum("n")).first()[0] or 0
    found = sums.where((F.col("n") > max(HOT_LEAST, int(pieces * HOT))) & (F.col("anchor") != 0)).collect()
    return np.sort(np.array([r.anchor for r in found], np.int64).view(np.uint64))


def exchange(docs: DataFrame, text: str, words: bool, length: int, gram: int, first_only: bool, buckets: int) -> DataFrame:
    """Rows of `PACKED`, to be grouped by ``bucket``: pieces, windows of hot anchors, and in ``settled`` runs of windows that
    their own chunk decides.

    ``first_only``: of identical pieces the first by (id, key, start) is sent and the others are settled; else
    all of them are settled, and one is sent with ``many`` set."""
    hot = hot_anchors(docs, text, words, length, gram)
    small_batches(docs.sparkSession)
    source = keyed(docs, text).select("__id", "__key", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
        held, size = {}, 0
        for batch in batches:
            for key_id, key, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (key_id, key) not in held:
                    held[key_id, key] = value
                    size += len(value)
                if size >= HELD:
                    yield [(*k, held[k]) for k in sorted(held)]
                    held, size = {}, 0
        if held:
            yield [(*k, held[k]) for k in sorted(held)]

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            parts, loose, settled = [], [], []
            for chunk in chunks(rows, words, length):
                p = cut(chunk, words, length, gram)
                if p is None:
                    continue
                _, first, inverse, n = np.unique(p.hashes, return_index=True, return_inverse=True, return_counts=True)
                of = first[inverse]
                same = np.flatnonzero((n[inverse] > 1) & (of != np.arange(len(of))))
                b, e, whole = p.begin.tolist(), p.end.tolist(), p.data
                same = np.array([i for i in same.tolist() if whole[b[i] : e[i]] == whole[b[of[i]] : e[of[i]]]], np.int64)
                many, sent = np.zeros(len(of), np.uint8), np.ones(len(of), bool)
                many[of[same]], sent[same] = 1, False
                done = same if first_only else np.concatenate([same, np.flatnonzero(many)])
                settled.append([x[done] for x in (p.ids, p.keys, p.start, p.count)])
                if len(hot):
                    split = sent & np.isin(p.anchor, hot)
                    sent &= ~split
                    if split.any():
                        owner, place, *hashes = p.windows(np.flatnonzero(split))
                        columns = [*hashes, p.ids[owner], p.keys[owner], p.start[owner] + place, many[owner]]
                        first, again, gone = first_of_each(columns, first_only)
                        settled.append([c[gone] for c in columns[2:5]] + [np.ones(len(gone), np.int64)])
                        kept = [c[first] for c in columns]
                        loose.append((*kept[:5], kept[5] if first_only else again.astype(np.uint8)))
                parts.append((p, np.flatnonzero(sent), many[sent]))
            if not parts:
                continue
            runs = joined_runs(*(np.concatenate(x) for x in zip(*settled)))
            runs = b"".join(x.astype("<i8").tobytes() for x in runs)
            if any(len(i) for _, i, _ in parts):
                yield from packed(parts, buckets, runs)
                runs = b""
            if loose:
                yield from packed_windows(loose, buckets, runs)

    return source.mapInArrow(deal, PACKED)


def solved(pieces: DataFrame, solve: Callable[[dict], Iterator[tuple[int, int, int]]], first_only: bool, buckets: int) -> DataFrame:
    """``__id, __key, start, n``: runs of windows that are to go, the settled ones and those that ``solve`` finds in
    a bucket, as (piece, first window of it, number).  Buckets from ``buckets`` on hold windows of hot anchors."""

    def windows(table: pa.Table) -> np.ndarray:
        import zstandard

        restore = zstandard.ZstdDecompressor().decompress
        kinds = {"anchor": "<u8", "texts": "<u8", "ids": "<i8", "keys": "<i8", "start": "<u4", "many": "u1"}
        columns = [np.concatenate([np.frombuffer(restore(v.as_py()), kind) for v in table.column(c)]) for c, kind in kinds.items()]
        gone = first_of_each(columns, first_only)[2]
        return np.stack([*(c[gone].astype(np.int64) for c in columns[2:5]), np.ones(len(gone), np.int64)])

    def bucket(table: pa.Table) -> pa.Table:
        out = [np.frombuffer(v.as_py(), "<i8").reshape(4, -1) for v in table.column("settled") if v.as_py()]
        if table.column("bucket")[0].as_py() >= buckets:
            rows = joined_runs(*np.concatenate([*out, windows(table)], axis=1))
            return pa.Table.from_arrays([pa.array(x) for x in rows], names=["__id", "__key", "start", "n"])
        p = unpacked(table)
        found = np.array(list(solve(p)), np.int64).reshape(-1, 3)
        i = found[:, 0]
        out.append(np.stack([p["ids"][i], p["keys"][i], p["start"][i] + found[:, 1], found[:, 2]]))
        rows = joined_runs(*np.concatenate(out, axis=1))
        return pa.Table.from_arrays([pa.array(x) for x in rows], names=["__id", "__key", "start", "n"])

    return pieces.groupBy("bucket").applyInArrow(bucket, SPANS)


def with_runs(docs: DataFrame, text: str, runs: DataFrame) -> DataFrame:
    """``docs`` with ``__runs``: its runs of windows (null: none).  A text has at most as many as it has windows."""
    mine = runs.groupBy("__id", "__key").agg(F.collect_list(F.struct("start", "n")).alias("__runs"))
    return keyed(docs, text).join(mine, ["__id", "__key"], "left")


def covered(runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal stretches of units under the windows of ``runs``, in order."""
    out: list[list[int]] = []
    for start, end in sorted((r["start"], r["start"] + r["n"] + length - 1) for r in runs or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]
