"""Web archives as seekable zstandard bundles.

Records are grouped into independent zstandard frames of about `FRAME_BYTES`; a footer in
the public seekable format (a skippable frame that lists every frame's sizes) makes each
frame reachable without reading those before it. A record's address is its file, its
frame, and its offset and length inside that frame once decompressed.

A payload that occurs again is written once: the record with the smallest id holds it
and the others are revisits that name it, with digest and length of the full payload.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import shared_files
from tallyhouse.llm.text import stored, text_of

LEAST_SHARED = 100  # shorter payloads are stored again
FRAME_BYTES = 1 << 20
BATCH_RECORDS = 512
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
TABLE_TAIL = "<IBI"  # number of frames, descriptor, magic
ADDRESS = "page_id bigint, path string, frame int, frame_at bigint, frame_length bigint, offset bigint, length bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def classed(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload. Rows that repeat a page's id and payload are alike;
    rows without an id come after all others and are responses only where no row with an
    id has their payload. An empty table gives no rows.
    """
    payload = text_of(F.col("html")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"),
    )
    shared = F.col("payload_bytes") >= LEAST_SHARED
    # min() is combined before the shuffle. One copy needs no partner: the join keeps
    # only payloads that occur under more than one id.
    first = (
        rows.where(shared).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.max(F.col("page_id").isNull()).alias("unnamed"))
        .where((F.col("first") < F.col("last")) | F.col("unnamed"))
        .select(F.col("payload_digest").alias("digest"), "first")
    )
    joined = rows.join(first, shared & (F.col("payload_digest") == F.col("digest")), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        *rows.columns,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write(pages: DataFrame) -> DataFrame:
    """Write archives, one a task; the address of every record."""
    folder = shared_files.new_folder(pages.sparkSession, "warc")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write_archive(batches, folder)

    return stored(classed(pages).mapInArrow(archive, ADDRESS), "warc-index")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def serialized(page: dict) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    block = page["payload"] if page["record_type"] == "response" else b""
    url = "".join(c for c in (page["url"] or "") if c not in "\r\n")
    fields = [
        ("WARC-Type", page["record_type"]), ("WARC-Record-ID", record_id(page["page_id"])), ("WARC-Target-URI", url),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{page['payload_digest']}"),
        ("X-Payload-Length", str(page["payload_bytes"])), ("Content-Type", "text/html;charset=utf-8"),
        ("Content-Length", str(len(block))),
    ]
    if page["refers_to"] is not None:
        fields.append(("WARC-Refers-To", record_id(page["refers_to"])))
    if page["url"] is None:
        fields = [f for f in fields if f[0] != "WARC-Target-URI"]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes | memoryview) -> dict:
    """What a record says, and of a response what its block is."""
    record = bytes(record)
    end = record.index(b"\r\n\r\n")
    lines = record[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block = record[end + 4 : end + 4 + length]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    response = fields["WARC-Type"] == "response"
    if response and (hashlib.sha256(block).hexdigest() != digest or length != size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": _page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        "payload_bytes": size, "payload_digest": digest, "payload": block if response else None,
    }


def _page(name: str) -> int | None:
    key = name.removeprefix("<urn:page:").removesuffix(">")
    return None if key == "none" else int(key)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer: compressed and decompressed size of each frame."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    tail = struct.pack(TABLE_TAIL, len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(tail)) + entries + tail


def frames_of(data) -> list[tuple[int, int, int]]:
    """Offset, compressed and decompressed size of each frame, from the footer alone."""
    tail = struct.calcsize(TABLE_TAIL)
    data.seek(data.size() - tail)
    count, descriptor, magic = struct.unpack(TABLE_TAIL, data.read(tail))
    if magic != SEEKABLE or descriptor:
        raise ValueError("no seek table")
    data.seek(data.size() - tail - 8 * count)
    found, at = [], 0
    for packed, plain in struct.iter_unpack("<II", data.read(8 * count)):
        found.append((at, packed, plain))
        at += packed
    return found


def _write_archive(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    batches = (b for b in batches if b.num_rows)
    batch = next(batches, None)
    if batch is None:
        return
    path = shared_files.unique(folder, "archive", "warc.zst")
    pack = zstandard.ZstdCompressor(level=3)
    frames, held, at, size = [], [], 0, 0
    with shared_files.writing(path) as out:

        def close() -> pa.RecordBatch:
            nonlocal held, at, size
            packed = pack.compress(b"".join(r for _, r in held))
            out.write(packed)
            rows, offset = [], 0
            for page_id, record in held:
                rows.append((page_id, path, len(frames), at, len(packed), offset, len(record)))
                offset += len(record)
            frames.append((len(packed), size))
            at, size, held = at + len(packed), 0, []
            return _batch(ADDRESS, rows)

        while batch is not None:
            for i in range(batch.num_rows):
                page = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                record = serialized(page)
                held.append((page["page_id"], record))
                size += len(record)
                # Sizes in the footer have 32 bits; a longer record has a frame to itself.
                if size >= FRAME_BYTES:
                    yield close()
            batch = next(batches, None)
        if held:
            yield close()
        out.write(seek_table(frames))


KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, KINDS[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names)
    )


def read(index: DataFrame) -> DataFrame:
    """All records of the archives that `index` names, frame by frame.

    Work is dealt by frame, so one large archive is read by many tasks.
    """
    frames = index.select("path", "frame").distinct()
    return frames.repartition(_tasks(index), "path", "frame").mapInArrow(_read_frames, RECORD)


def fetch(addresses: DataFrame) -> DataFrame:
    """Single records by address: one seek and one frame each."""
    return addresses.select("path", "frame_at", "frame_length", "offset", "length").mapInArrow(_read_records, RECORD)


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _read_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        wanted: dict[str, list[int]] = {}
        for path, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            wanted.setdefault(path, []).append(frame)
        for path, numbers in wanted.items():
            with shared_files.reading(path) as data:
                places = frames_of(data)
                for n in sorted(numbers):
                    at, packed, plain = places[n]
                    data.seek(at)
                    content = unpack.decompress(data.read(packed), max_output_size=plain)
                    yield _records(split(content))


def split(content: bytes) -> Iterator[bytes]:
    """The records of a frame: each says how long its block is."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at) + 4
        head = content[at:end]
        length = int(head.rpartition(b"Content-Length: ")[2].split(b"\r\n", 1)[0])
        stop = end + length + 4
        yield content[at:stop]
        at = stop


def _records(records: Iterator[bytes]) -> pa.RecordBatch:
    return _batch(RECORD, [tuple(parsed(r).values()) for r in records])


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for path, at, packed, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with shared_files.reading(path) as data:
                data.seek(at)
                content = unpack.decompress(data.read(packed))
                yield _records(iter([content[offset : offset + length]]))
