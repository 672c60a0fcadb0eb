"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by deterministic coin tossing: runs of one symbol become a
symbol, every symbol is labelled by the lowest bit in which it differs from the one
before, and again until six labels are left; a phrase starts at each local maximum.
Phrases are named by their content and are the symbols of the next level. A cut depends
on a few neighbours only, so equal substrings are cut and named alike inside, wherever
they stand. The smallest hashed names of levels `FIRST_LEVEL` and up, and of the whole
text, are the fingerprint; two fingerprints give an estimate of the names' Jaccard
similarity.

All levels of many texts are computed together as arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import text_of

NAMES = 64  # of a fingerprint
FIRST_LEVEL = 2
GROUP_CHARS = 1 << 17
BLOCK_DOCS = 1 << 14
MULTIPLY, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LAST_KEY = (1 << 63) - 1


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values, one to one."""
    x = (values ^ (values >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def _firsts(starts: np.ndarray, size: int) -> np.ndarray:
    first = np.zeros(size, bool)
    first[starts] = True
    return first


def _collapsed(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol as one symbol, named by symbol and length."""
    new = _firsts(starts, len(symbols))
    new[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(new)
    if len(at) == len(symbols):
        return symbols, starts
    length = np.diff(at, append=len(symbols)).astype(np.uint64)
    named = symbols[at]
    runs = length > 1
    named[runs] = mixed(named[runs] * MULTIPLY + length[runs])
    return named, np.searchsorted(at, starts)


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Six labels, never twice in a row inside a text."""
    labels = symbols
    for _ in range(4):  # 64 bits → below 128 → below 14 → below 8 → below 6
        differ = np.empty_like(labels)
        np.bitwise_xor(labels[1:], labels[:-1], out=differ[1:])
        differ[first] = 1  # as if the symbol before differed in its lowest bit
        low = np.bitwise_count((differ & (~differ + labels.dtype.type(1))) - labels.dtype.type(1))
        bit = (labels >> low.astype(labels.dtype)) & labels.dtype.type(1)
        labels = (low << np.uint8(1)) | bit.astype(np.uint8)
    return labels


def _parsed(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: names of phrases, and where each text starts among them."""
    symbols, starts = _collapsed(symbols, starts)
    first = _firsts(starts, len(symbols))
    label = _labels(symbols, first)
    begin = first.copy()
    peak = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    begin[1:-1] |= peak & ~first[1:-1] & ~first[2:]
    at = np.flatnonzero(begin)
    length = np.diff(at, append=len(symbols))
    place = np.arange(len(symbols)) - np.repeat(at, length)
    power = np.ones(int(length.max()) + 1, np.uint64)
    power[1:] = MULTIPLY
    power = np.multiply.accumulate(power)
    names = np.add.reduceat(mixed(symbols) * power[place], at) + length.astype(np.uint64)
    return mixed(names), np.searchsorted(at, starts)


def names_by_level(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, phrase names, text number of each) for non-empty texts, up to one name a text."""
    units = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    symbols = np.concatenate(units).astype(np.uint64)
    starts = np.cumsum([0, *(len(u) for u in units[:-1])])
    number, level = np.arange(len(texts)), 0
    while len(number):
        symbols, starts = _parsed(symbols, starts)
        level += 1
        length = np.diff(starts, append=len(symbols))
        yield level, symbols, np.repeat(number, length)
        # A text that has become one name is done.
        more = length > 1
        if not more.all():
            symbols = symbols[np.repeat(more, length)]
            number, length = number[more], length[more]
            starts = np.cumsum(length) - length


def fingerprints(texts: list[str]) -> list[str]:
    """Hexadecimal fingerprints; '' for the empty text."""
    done = [""] * len(texts)
    for group in _groups(texts):
        keys = []
        for level, names, number in names_by_level([texts[i] for i in group]):
            # The last name of a text stands for all of it and counts at any level.
            alone = np.bincount(number, minlength=len(group))[number] == 1
            keep = slice(None) if level >= FIRST_LEVEL else alone
            short = mixed(names[keep] + np.uint64(level)) >> np.uint64(32)
            keys.append(number[keep].astype(np.uint64) << np.uint64(32) | short)
        found = np.sort(np.concatenate(keys))
        found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        owner = (found >> np.uint64(32)).astype(np.int64)
        ends = np.searchsorted(owner, np.arange(len(group) + 1))
        values = found.astype(np.uint32).astype(">u4")
        for place, i in enumerate(group):
            done[i] = values[ends[place] : min(ends[place + 1], ends[place] + NAMES)].tobytes().hex()
    return done


def _groups(texts: list[str]) -> Iterator[list[int]]:
    group, size = [], 0
    for i, text in enumerate(texts):
        if text:
            group.append(i)
            size += len(text)
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def likeness(one: str, other: str) -> float:
    """Estimated Jaccard similarity of two texts' phrase names; 1.0 for equal fingerprints."""
    if one == other:
        return 1.0
    a, b = ({f[i : i + 8] for i in range(0, len(f), 8)} for f in (one, other))
    smallest = sorted(a | b)[:NAMES]
    return sum(x in a and x in b for x in smallest) / len(smallest)


def fingerprinting(text: Column) -> Column:
    """Column of texts → column of fingerprints. Null counts as empty."""
    run = F.arrow_udf(lambda texts: pa.array(fingerprints(texts.to_pylist()), pa.string()), "string")
    return run(text_of(text))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first ones of the next text."""
    gone = len(text) // 4
    return text[: len(text) - gone] + following[:gone] if gone else text


# doc_id order


def compared(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness.

    Documents follow each other in ascending doc_id, null ids last, rows that repeat an
    id in the order of their text; the first follows the last. A null text is empty. An
    empty table gives no rows, other columns are ignored.

    Blocks of ids are handled side by side. A block also gets the document that follows
    its last one, so no document looks beyond its block. The blocks' first ids are a
    list as long as the number of blocks, like the bounds of Spark's own range shuffle.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_KEY))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("key"), text_of(F.col("text")).alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(4 * tasks, -(-docs.count() // BLOCK_DOCS))
    cuts = [i / blocks for i in range(blocks)]
    bounds = rows.agg(F.percentile_approx("key", cuts, 20 * blocks), F.min("key")).first()
    first = sorted({*(bounds[0] or ()), *([bounds[1]] if bounds[1] is not None else ())})

    def places(keys: pa.Array) -> pa.Array:
        return _places(keys, first)

    place = F.arrow_udf(places, "array<struct<block: int, guest: int>>")(F.col("key"))
    dealt = rows.withColumn("at", F.explode(place)).select("at.block", "at.guest", "key", "doc_id", "text")
    # Guest 1 is the first document of the next block, 2 the very first after the last.
    order = ["block", F.col("guest") == 2, "key", F.col("doc_id").isNull(), F.xxhash64("text"), "text"]
    sorted_blocks = dealt.repartition(tasks, "block").sortWithinPartitions(*order)
    return sorted_blocks.mapInArrow(_compared, COMPARED)


COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _places(keys: pa.Array, first: list[int]) -> pa.Array:
    """The block of each key, and the block before of keys that start a block."""
    bounds, keys = np.array(first, np.int64), keys.to_numpy(zero_copy_only=False)
    block = np.searchsorted(bounds, keys, side="right") - 1
    found = []
    for b, starts, at_zero in zip(block.tolist(), (bounds[block] == keys).tolist(), (keys == bounds[0]).tolist(), strict=True):
        places = [{"block": b, "guest": 0}]
        if starts and b:
            places.append({"block": b - 1, "guest": 1})
        if at_zero:
            places.append({"block": len(first) - 1, "guest": 2})
        found.append(places)
    return pa.array(found, pa.list_(pa.struct([("block", pa.int32()), ("guest", pa.int32())])))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []  # rows whose successor may still come
    size = 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("block", "guest", "doc_id", "text")]
        for row in zip(*columns, strict=True):
            held.append(row)
            size += len(row[3])
            if size >= GROUP_CHARS:
                yield _pairs(held)
                held, size = held[-1:], len(row[3])
    if held:
        yield _pairs(held)


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
    after = [edited(a[3], b[3]) for a, b in pairs]
    prints = fingerprints([r[3] for r in rows])
    own = {id(r): p for r, p in zip(rows, prints, strict=True)}
    changed = fingerprints(after)
    columns = [
        pa.array([a[2] for a, _ in pairs], pa.int64()),
        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in after], pa.string()),
        pa.array([own[id(a)] for a, _ in pairs], pa.string()),
        pa.array(changed, pa.string()),
        pa.array([likeness(own[id(a)], c) for (a, _), c in zip(pairs, changed, strict=True)], pa.float64()),
        pa.array([likeness(own[id(a)], own[id(b)]) for a, b in pairs], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in COMPARED.split(", ")])
