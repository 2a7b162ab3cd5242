"""Token ids in a binary format with a shared dictionary (operator 3).

Ids of a document are serialized as little-endian integers (two bytes each where the vocabulary allows,
else four) and compressed by themselves with one zstandard dictionary, trained on serialized id
arrays of a bounded sample.  The format, a folder:

``dictionary``  Parquet, one row: ``hash`` (sha-256 of the bytes), ``width`` (bytes an id), ``bytes``
``blocks``      Parquet, one row a block: ``part``, ``seq`` (documents are in ascending id order along them),
                ``before`` (ids of the part before this block), ``dictionary`` (its hash), ``doc_ids``, ``n_tokens``,
                ``offsets`` (one more than documents, into ``payload``), ``payload``

A short document is had by its block's offsets alone (`lookup`), without its neighbours.
Blocks are Parquet rows, so Spark's committer makes a rewritten task replace the lost one's files, on any store.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codestrata.llm.common import give_back, shuffle_partitions, small_batches

BLOCKS = (
    "part int, seq int, before long, dictionary string, doc_ids array<long>, n_tokens array<long>, "
    "offsets array<long>, payload binary"
)
ARROW_BLOCKS = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("dictionary", pa.string()),
        ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)

#: Texts of these characters only are cut into words here; their lower case, letters and digits
#: are the same under every Unicode version, and they are in composed form.
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: Fixed value: the tokenizer's own word pattern, on lower-cased plain text.
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^ \t\n\x0b\x0c\ra-z\xdf-\xf6\xf8-\xff0-9]+")
CHUNK = re.compile("[^ \t\n\r]+")

_ENCODERS: dict[str, "WordEncoder"] = {}


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves,
    the rest follow from 256 upwards."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}
    return [chr(b) if b not in rest else rest[b] for b in range(256)]


class WordEncoder(dict):
    """Word -> serialized ids; `encode` gives those of a text.  At most ``limit`` words are kept, in two halves: when the newer one is
    full it becomes the older one, from which words still in use come back at once."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.limit, self.older = limit, {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.letters = byte_letters()
        self.chunks: dict[str, bytes] = {}
        self.by_word = self._by_word()

    def _by_word(self) -> bool:
        """Whether this tokenizer works word by word as assumed; tried on a text with each kind of word."""
        probe = "It's an ÀÉß naïve_x 42 (we'll!) \x00\x1c ''s o'clock\tEnd.\n"
        mine = b"".join(map(self.__getitem__, WORD.findall(probe.lower())))
        self.clear()
        return mine == self.whole(probe)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            letters = self.letters
            spelt = "".join([letters[b] for b in word.encode()])
            ids = np.array([t.id for t in self.model.tokenize(spelt)], self.dtype).tobytes()
        if len(self) >= self.limit // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def chunk(self, text: str) -> bytes:
        """Ids of a run without white space.  Words, normal forms and marked texts never cross white space."""
        if PLAIN.fullmatch(text):
            return b"".join(map(self.__getitem__, WORD.findall(text.lower())))
        if text not in self.chunks:
            if len(self.chunks) >= self.limit // 4:
                self.chunks.clear()
            self.chunks[text] = self.whole(text)
        return self.chunks[text]

    def encode(self, text: str) -> bytes:
        if not self.by_word or any(s in text for s in self.special):
            return self.whole(text)
        if PLAIN.fullmatch(text):
            return b"".join(map(self.__getitem__, WORD.findall(text.lower())))
        return b"".join(map(self.chunk, CHUNK.findall(text)))


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
        give_back()  # what reading the vocabulary took
    return _ENCODERS[path]


def train_dictionary(docs: DataFrame, tokenizer: str, size: int, sample_rows: int, sample_ids: int) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes.  Trained on about ``sample_rows`` different texts (twice as many at
    most), spread by hash, and of each on one run of at most ``sample_ids`` ids: that bounds what the driver gets.
    Too small a corpus for training gives its ids as they are; an empty one an empty dictionary."""
    import zstandard

    step = max(1, docs.count() // max(1, sample_rows))

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = encoder(tokenizer)
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                ids = mine.encode(text)
                n = sample_ids * mine.dtype.itemsize
                at = zlib.crc32(ids) % max(1, len(ids) - n + 1) // mine.dtype.itemsize * mine.dtype.itemsize
                out.append(ids[at : at + n])
            yield pa.RecordBatch.from_pydict({"ids": pa.array(out, pa.binary())})

    # copies of a text are chosen together: one of them stays
    chosen = docs.select("text", F.xxhash64("text").alias("hash")).where((F.length("text") > 0) & (F.pmod("hash", F.lit(step)) == 0))
    found = (
        chosen.groupBy("hash").agg(F.first("text").alias("text")).orderBy("hash").limit(2 * sample_rows).select("text")
        .mapInArrow(runs, "ids binary").toArrow().column("ids").to_pylist()
    )
    samples = sorted(found)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def write_ids(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = 1, level: int = 3, block_bytes: int = 2 << 20,
    dictionary_size: int = 65_536, sample_rows: int = 1_000, sample_ids: int = 2_048, partitions: int | None = None,
) -> str:
    """Write the ids of every whole text into ``folder``, in ascending ``doc_id`` order; return the folder.

    Null or empty text: the end id alone.  Null ids come first; rows of one id follow in text order, each
    a document of its own; an empty table writes no block.  Only ``doc_id`` and ``text`` are read.
    """
    import zstandard

    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    trained = train_dictionary(docs, tokenizer, dictionary_size, sample_rows, sample_ids)
    name = hashlib.sha256(trained).hexdigest()
    width = encoder(tokenizer).dtype.itemsize
    spark.createDataFrame([(name, width, trained)], "hash string, width int, bytes binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(trained)  # at most dictionary_size bytes

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = encoder(tokenizer)
        squeeze = compressor(shared.value, level)
        end = b"" if end_id is None else np.array([end_id], mine.dtype).tobytes()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, offsets, pieces = [], [], [0], []

        def block() -> pa.RecordBatch:
            row = [part, seq, before, name, ids, counts, offsets, b"".join(pieces)]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, ARROW_BLOCKS)], schema=ARROW_BLOCKS)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = mine.encode(text) + end
                pieces.append(squeeze(raw))
                ids.append(key)
                counts.append(len(raw) // mine.dtype.itemsize)
                offsets.append(offsets[-1] + len(pieces[-1]))
                if offsets[-1] >= block_bytes:
                    yield block()
                    seq, before = seq + 1, before + sum(counts)
                    ids, counts, offsets, pieces = [], [], [0], []
        if ids:
            yield block()
        give_back()

    (
        docs.repartitionByRange(partitions or shuffle_partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(pack, BLOCKS)
        .write.parquet(f"{folder}/blocks")
    )
    return folder


def compressor(dictionary: bytes, level: int):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=False).compress


def decompressor(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=known).decompress


def _stored(spark: SparkSession, folder: str) -> tuple[DataFrame, str, int, bytes]:
    name, width, trained = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(trained).hexdigest() != name:
        raise ValueError(f"{folder}: the dictionary does not have the hash it is stored under")
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks"), name, width, bytes(trained)


def _documents(spark: SparkSession, folder: str, blocks: DataFrame, name: str, width: int, trained: bytes, make, schema: str, fields: list) -> DataFrame:
    shared = spark.sparkContext.broadcast(trained)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = decompressor(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError(f"{folder}: a block was written with another dictionary")
                payload, offsets = row["payload"], row["offsets"]
                docs = (np.frombuffer(restore(payload[a:b]), f"<u{width}") for a, b in zip(offsets, offsets[1:]))
                yield pa.RecordBatch.from_arrays(make(row, docs), schema=pa.schema(fields))

    return blocks.mapInArrow(unpack, schema)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, ids`` of every stored document."""
    stored = _stored(spark, folder)
    make = lambda row, docs: [pa.array(row["doc_ids"], pa.int64()), pa.array([d.astype("i4") for d in docs], pa.list_(pa.int32()))]
    return _documents(spark, folder, *stored, make, "doc_id long, ids array<int>", [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def lookup(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents of that id.  Only its compressed bytes are cut out and restored."""
    blocks, _, width, trained = _stored(spark, folder)
    at = F.posexplode("doc_ids").alias("i", "doc_id")
    piece = F.expr("substring(payload, cast(offsets[i] + 1 as int), cast(offsets[i + 1] - offsets[i] as int))")
    rows = blocks.where(F.array_contains("doc_ids", F.lit(doc_id).cast("long"))).select("part", "seq", "offsets", "payload", at)
    found = rows.where(F.col("doc_id") == doc_id).orderBy("part", "seq", "i").select(piece.alias("p")).collect()
    return [np.frombuffer(decompressor(trained)(bytes(r.p)), f"<u{width}").tolist() for r in found]


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, n_stored`` of every document, from the files: where it starts in
    the whole stream, its ids with the end id, their checksum as 32-bit integers, and its compressed bytes."""
    blocks, name, width, trained = _stored(spark, folder)
    # one number for each part that was written, at most as many as there were partitions
    totals = blocks.groupBy("part").agg(F.sum(F.expr("aggregate(n_tokens, 0L, (a, b) -> a + b)")).alias("n")).collect()
    base, at = {}, 0
    for row in sorted(totals, key=lambda r: r.part):
        base[row.part], at = at, at + row.n

    def make(row: dict, docs: Iterable[np.ndarray]) -> list[pa.Array]:
        counts = np.asarray(row["n_tokens"], np.int64)
        starts = base[row["part"]] + row["before"] + np.concatenate([[0], np.cumsum(counts)[:-1]])
        sums = [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]
        return [
            pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(counts),
            pa.array(sums, pa.int64()), pa.array(np.diff(row["offsets"]), pa.int64()),
        ]

    fields = [(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32", "n_stored")]
    return _documents(spark, folder, blocks, name, width, trained, make, "doc_id long, start long, n_tokens long, ids_crc32 long, n_stored long", fields)
