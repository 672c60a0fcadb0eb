"""Token id files: documents compressed one by one with a shared zstandard dictionary.

    header   magic, bytes an id, SHA-256 of the dictionary
    frames   one zstandard frame a document, back to back
    index    doc_id, whether it is null, offset, length, number of ids; 29 bytes a document
    tail     offset of the index, number of documents

A short document costs one read of the tail, one of its index entry and one of its
frame: the dictionary holds the patterns that a short id array alone is too small to
show. The dictionary is trained on a bounded sample (`SAMPLE_DOCS` documents, the first
`SAMPLE_IDS` ids of each); every document is written and indexed whole.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import bpe_trie, shared_files
from tallyhouse.llm.text import stored, text_of

MAGIC = b"TOKSHRD1"
HEADER, ENTRY, TAIL = "<8sB32s", "<q?QQI", "<QQ8s"
HEADER_BYTES, ENTRY_BYTES, TAIL_BYTES = map(struct.calcsize, (HEADER, ENTRY, TAIL))
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 512, 4096, 1 << 16
SHARD_BYTES = 128 << 20
ROWS = 512


def narrow(ids: bytes, width: int) -> bytes:
    """Packed 32-bit ids in `width` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def wide(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def trained(samples: list[bytes]) -> bytes:
    """A dictionary from id arrays; what they hold themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def sample(docs: DataFrame, tokenizer: str, end: bytes) -> list[bytes]:
    """Id arrays of the documents whose keys hash lowest."""
    lot = F.xxhash64("doc_id")
    lowest = [r[0] for r in docs.select(lot.alias("lot")).orderBy("lot").limit(SAMPLE_DOCS).collect()]
    if not lowest:
        return []
    chosen = docs.where(lot <= lowest[-1]).limit(SAMPLE_DOCS)
    ids = F.concat(bpe_trie.encoding(tokenizer, trie=False)(F.col("text")), F.lit(bytearray(end)))
    return [bytes(r[0]) for r in chosen.select(F.substring(ids, 1, 4 * SAMPLE_IDS)).collect()]


def _framed(arrays: Iterator[pa.Array], tokenizer: str, end: bytes, dictionary: bytes, width: int) -> Iterator[pa.Array]:
    pack = zstandard.ZstdCompressor(level=3, dict_data=_shared(dictionary))
    for texts in arrays:
        ids = bpe_trie.encoder(tokenizer, trie=False).batch([t or b"" for t in texts.to_pylist()])
        counts = pa.array([(len(v) + len(end)) // 4 for v in ids], pa.int64())
        frames = pa.array([pack.compress(narrow(v + end, width)) for v in ids], pa.binary())
        yield pa.StructArray.from_arrays([counts, frames], names=["n", "frame"])


def _shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def framing(tokenizer: str, end: bytes, dictionary: bytes, width: int):
    """Column of texts → number of ids, compressed ids. One function, so that a task keeps one vocabulary cache."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _framed(arrays, tokenizer, end, dictionary, width)

    return F.arrow_udf(run, "struct<n: bigint, frame: binary>")


def write(docs: DataFrame, tokenizer: str, end_id: int | None = 1) -> DataFrame:
    """Encode `docs` (doc_id, text) into shards in ascending doc_id order; the shards' list.

    Columns: shard (from 0, in order), path, docs, ids. Null texts are empty documents, null
    ids come last, rows that repeat an id stand in the order of their content. An empty
    table writes no shard. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    end = b"" if end_id is None else struct.pack("<I", end_id)
    width = 2 if bpe_trie.id_limit(tokenizer) <= 1 << 16 else 4
    dictionary = trained([narrow(s, width) for s in sample(docs, tokenizer, end)])
    folder = shared_files.new_folder(spark, "token-shards")
    name = hashlib.sha256(dictionary).hexdigest()
    with shared_files.writing(f"{folder}/{name}.dict") as out:
        out.write(dictionary)
    # Stored, because a range shuffle reads its input twice.
    framed = docs.select("doc_id", framing(tokenizer, end, dictionary, width)(text_of(F.col("text")).cast("binary")).alias("f"))
    frames = stored(framed.select("doc_id", "f.n", "f.frame"), "frames")
    size = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("frame").asc()]
    placed = frames.repartitionByRange(shards, *order).sortWithinPartitions(*order, "frame")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write_shard(batches, folder, dictionary, width)

    listed = stored(placed.mapInArrow(shard, "part int, path string, docs bigint, ids bigint"), "shard-list")
    # One row a shard.
    place = F.row_number().over(Window.orderBy("part")) - 1
    return listed.select(place.alias("shard"), "path", "docs", "ids")


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, dictionary: bytes, width: int) -> Iterator[pa.RecordBatch]:
    batches = (b for b in batches if b.num_rows)
    batch = next(batches, None)
    if batch is None:
        return
    path = shared_files.unique(folder, "shard", "tok")
    index, total, at = bytearray(), 0, HEADER_BYTES
    with shared_files.writing(path) as out:
        out.write(struct.pack(HEADER, MAGIC, width, hashlib.sha256(dictionary).digest()))
        while batch is not None:
            for doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.write(frame)
                index += struct.pack(ENTRY, doc_id or 0, doc_id is None, at, len(frame), n)
                at, total = at + len(frame), total + n
            batch = next(batches, None)
        out.write(bytes(index))
        out.write(struct.pack(TAIL, at, len(index) // ENTRY_BYTES, MAGIC))
    made = [TaskContext.get().partitionId()], [path], [len(index) // ENTRY_BYTES], [total]
    yield pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(made, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)],
        names=["part", "path", "docs", "ids"],
    )


class Shard:
    """Random access to one file."""

    def __init__(self, data, dictionary: bytes):
        self.data, size = data, data.size()
        data.seek(0)
        magic, self.width, digest = struct.unpack(HEADER, data.read(HEADER_BYTES))
        data.seek(size - TAIL_BYTES)
        self.index_at, self.docs, end = struct.unpack(TAIL, data.read(TAIL_BYTES))
        if MAGIC != magic or MAGIC != end:
            raise ValueError("not a token shard")
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError("the shard was written with another dictionary")
        self.unpack = zstandard.ZstdDecompressor(dict_data=_shared(dictionary))

    def entries(self, first: int, count: int) -> list[tuple]:
        self.data.seek(self.index_at + first * ENTRY_BYTES)
        return list(struct.iter_unpack(ENTRY, self.data.read(count * ENTRY_BYTES)))

    def ids(self, entry: tuple) -> bytes:
        """One document's ids, 32 bits each."""
        _, _, at, length, _ = entry
        self.data.seek(at)
        return wide(self.unpack.decompress(self.data.read(length)), self.width)


def dictionary_of(path: str, data) -> bytes:
    data.seek(0)
    digest = struct.unpack(HEADER, data.read(HEADER_BYTES))[2]
    with shared_files.reading(f"{path.rsplit('/', 1)[0]}/{digest.hex()}.dict") as found:
        return found.read()


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed) of every document in the files."""
    starts = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    listed = shards.select("path", F.coalesce(F.sum("ids").over(starts), F.lit(0)).alias("start"))

    spread = listed.repartition(max(1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(_read_shards, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with shared_files.reading(path) as data:
                yield from _documents(Shard(data, dictionary_of(path, data)), start)


def _documents(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
    for first in range(0, shard.docs, ROWS):
        keys, starts, counts, ids = [], [], [], []
        for entry in shard.entries(first, min(ROWS, shard.docs - first)):
            keys.append(None if entry[1] else entry[0])
            starts.append(start)
            counts.append(entry[4])
            ids.append(shard.ids(entry))
            start += entry[4]
        columns = [pa.array(v, pa.int64()) for v in (keys, starts, counts)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
