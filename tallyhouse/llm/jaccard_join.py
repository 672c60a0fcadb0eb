"""N-gram Jaccard join: pivots, regions, windows, recursion.

Jaccard distance is a metric on shingle sets, and for sets of given sizes it grows with
their symmetric difference. A linked pair differs in at most `D` shingles, `D` following
from the sizes.

Regions. Texts that have nothing to do with each other are all at distance 1, so pivots
drawn from the documents alone would put every document into every region. Distances
are therefore first taken inside projections: the shingle space of a size class is cut
into more than `D` slices, and a pair that differs in at most `D` shingles is at
distance 0 in one of them at least. Documents with equal slices choose the one that
agrees with most others as pivot, and a pivot's region is all documents that chose it;
a document is replicated into each region it may have a partner in. Size windows
replicate documents at the border of a size class into the class below.

Windows. A slice is also shared by chance, by texts that quote the same passage, the more so
the larger the corpus. No text is therefore moved into a region at first, but a sketch of each
set: how many of its shingles fall into each of a row of buckets. Sketches differ by no more
than their sets do. A set is compared with those whose size and whose distance to a pivot's
sketch are near enough (triangle inequality); pairs whose sketches differ in more than `D`
are no links. What is left is a graph over the sets, and its components are the regions that
texts are moved to: a set is in one of them, and most sets are in none.

A small region is finished by one task, which measures every set's exact distance to the
region's pivot and compares the pairs that the windows leave: outer sets can only be linked
if their distances to the pivot are apart by no more than `D`.

Recursion. A region that is too large for one task, by sets or by bytes, is measured from its
pivot first. Those within reach are linked to it and thereby to each other. The others, the
outer ones, are divided into blocks, the linked ones as well, and any two blocks of which one
is outer are a region again, small enough to be finished. Nothing is capped: every link
between different sets is found, or joins two sets that are linked otherwise.

Copies have the same set, and a set is cut and compared once. A slice that many sets share
meets in one task, which then holds one row of each; as every set has many slices, that is a
small share of all. No large region is ever gathered: its sets are counted, and dealt by hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.phrases import MULTIPLY, mixed
from tallyhouse.llm.shingles import shingle_sets
from tallyhouse.llm.text import WORD, narrow, row_of, stored, text_of, whole

CLASS_RATIO = 1.75
BROADCAST_KEYS = 1_000_000  # 8 MB of keys
SMALL_SETS, SMALL_BYTES = 1024, 8 << 20  # of a region that one task compares
SCREEN_SETS, SCREEN_SHINGLES = 8192, 32 << 20  # of a region whose sketches one task compares
FEWEST, COARSE = 16, 32  # buckets of a sketch at least; of the sketches that are looked at first
COLUMNS = 1 << 15  # shingles of a small region laid out at once
SLICED, PAIRS = "sig bigint, key bigint", "a bigint, b bigint"


@dataclass(frozen=True)
class Rule:
    """Two sets link when 100 * intersection >= percent * union."""

    width: int = 5
    percent: int = 80

    def linked(self, common: int, union: int) -> bool:
        return 100 * common >= self.percent * union

    def most_differing(self, sizes: int) -> int:
        """The symmetric difference of a linked pair, given the sum of its sizes."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def largest_partner(self, size: int) -> int:
        return size * 100 // self.percent


@dataclass(frozen=True)
class SizeClass:
    """Pairs whose smaller set has between `low` and `high` shingles."""

    number: int
    low: int
    high: int
    reach: int  # size of the largest partner
    differing: int
    slices: int


def size_class(number: int, low: int, rule: Rule) -> SizeClass:
    high = max(low, int(low * CLASS_RATIO) - 1)
    reach = rule.largest_partner(high)
    differing = rule.most_differing(high + reach)
    slices = differing + 1
    # Enough slices that, but for rare documents, more than `differing` are not empty.
    while differing:
        empty = slices * math.exp(-low / slices)
        if slices - empty - 2 * math.sqrt(empty) >= differing + 1 or slices > 4 * (differing + 2):
            break
        slices += 1
    return SizeClass(number, low, high, reach, differing, slices)


def classes_of(size: int, rule: Rule) -> list[SizeClass]:
    """The size classes in which a set of this size may have a partner."""
    return [c for c in _ladder(size, rule) if c.low <= size <= c.reach]


_ladders: dict[Rule, list[SizeClass]] = {}


def _ladder(size: int, rule: Rule) -> list[SizeClass]:
    ladder = _ladders.setdefault(rule, [size_class(0, 1, rule)])
    while ladder[-1].high < size:
        ladder.append(size_class(len(ladder), ladder[-1].high + 1, rule))
    return ladder


# Sets


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name of each set. Two of a billion different sets share one with 3 % probability."""
    sizes = np.array([len(s) for s in sets])
    keys = np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.cumsum(sizes[full]) - sizes[full]
        together = np.concatenate([sets[i] for i in full])
        keys[full] = mixed(np.add.reduceat(mixed(together ^ MULTIPLY), starts) + sizes[full].astype(np.uint64))
    return keys.view(np.int64)


def _sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    return list(shingle_sets([t or b"" for t in texts.to_pylist()], width))


def sketch(values: np.ndarray) -> bytes:
    """How many shingles of a set fall into each bucket, up to 255; a quarter to half as many buckets as shingles.

    One shingle more or less changes one bucket by one at most, so sketches differ in sum by
    no more shingles than their sets.
    """
    buckets = max(FEWEST, 1 << (len(values) // 4).bit_length())
    counts = np.bincount((values & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def folded(sketches: np.ndarray, buckets: int) -> np.ndarray:
    """Sketches, one a row, as they are with fewer buckets."""
    while sketches.shape[-1] > buckets:
        half = sketches.shape[-1] // 2
        sketches = np.minimum(sketches[..., :half].astype(np.uint16) + sketches[..., half:], 255).astype(np.uint8)
    return sketches


def apart(sketches: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (np.maximum(sketches, other) - np.minimum(sketches, other)).sum(axis=1, dtype=np.int64)


def _measured(texts: pa.Array, width: int) -> pa.Array:
    sets = _sets(texts, width)
    sizes = pa.array([len(s) for s in sets], pa.int64())
    sketches = pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())
    return pa.StructArray.from_arrays([sizes, pa.array(set_keys(sets)), sketches], names=["n", "key", "sketch"])


def set_of(text: Column, width: int) -> Column:
    """n (distinct shingles), key and sketch of each text's set."""

    def run(texts: pa.Array) -> pa.Array:
        return _measured(texts, width)

    return F.arrow_udf(run, "struct<n: bigint, key: bigint, sketch: binary>")(text_of(text).cast("binary"))


# Projections


def slices_of(sets: list[np.ndarray], keys: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(signature of a slice, key of its set) for all classes of all sets."""
    wanted: dict[SizeClass, list[int]] = {}
    for i, s in enumerate(sets):
        for c in classes_of(len(s), rule) if len(s) else ():
            if c.differing:  # otherwise only equal sets link
                wanted.setdefault(c, []).append(i)
    signatures, owners = [], []
    for c, members in wanted.items():
        todo, scheme = members, 0
        # A pair is only missed where both sets have too many empty slices. Such sets
        # are cut once more in another way, until they have enough.
        while todo:
            signature, owner, filled = _cut([sets[i] for i in todo], c, scheme)
            signatures.append(signature)
            owners.append(keys[np.array(todo)][owner])
            todo, scheme = [i for i, n in zip(todo, filled, strict=True) if n <= c.differing], scheme + 1
    if not signatures:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(signatures).view(np.int64), np.concatenate(owners)


def _cut(sets: list[np.ndarray], c: SizeClass, scheme: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    drawn = mixed(values + np.uint64(scheme)) if scheme else values
    place = ((drawn >> np.uint64(32)) * np.uint64(c.slices)) >> np.uint64(32)
    if scheme:  # sets are sorted by value, so the first scheme's slices already are
        order = np.lexsort((place, owner))
        values, owner, place = values[order], owner[order], place[order]
    begin = np.ones(len(values), bool)
    begin[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    at = np.flatnonzero(begin)
    sums = np.add.reduceat(mixed(values ^ MULTIPLY), at)
    label = np.uint64((scheme << 48) + (c.number << 32)) + place[at]
    return mixed(sums + mixed(label)), owner[at], np.bincount(owner[at], minlength=len(sets))


def _sliced(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _sets(batch.column(0), rule.width)
        signature, owner = slices_of(sets, set_keys(sets), rule)
        yield pa.RecordBatch.from_arrays([pa.array(signature), pa.array(owner)], names=["sig", "key"])


def sliced(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sliced(batches, rule)

    return docs.select(text_of(F.col("text")).cast("binary").alias("text")).mapInArrow(run, SLICED)


# Regions

def _linked(texts: pa.Array, pivots: pa.Array, rule: Rule) -> pa.Array:
    """Whether a set is within reach of its pivot."""
    both = _sets(pa.concat_arrays([texts, pivots]), rule.width)
    common = [len(np.intersect1d(own, pivot, assume_unique=True)) for own, pivot in zip(both, both[len(texts) :])]
    unions = [len(own) + len(pivot) - c for own, pivot, c in zip(both, both[len(texts) :], common)]
    return pa.array([rule.linked(c, u) for c, u in zip(common, unions)], pa.bool_())


def windows(distances: np.ndarray, sizes: np.ndarray, rule: Rule) -> np.ndarray:
    """For each set, sorted by distance to the pivot, where the sets end that can be linked to it.

    Differences from the pivot are apart by no more than the two sets differ (triangle
    inequality), and a linked pair differs in at most as many shingles as its sizes allow.
    """
    most = np.array([rule.most_differing(int(n) + rule.largest_partner(int(n))) for n in sizes])
    return np.searchsorted(distances, distances + most, side="right")


def _compared(texts: list[bytes], keys: list[int], rule: Rule) -> list[tuple[int, int]]:
    """Links that join a small region's sets: pairs inside each other's window, as products of packed bits."""
    sets = list(shingle_sets(texts, rule.width))
    sizes, n = np.array([len(s) for s in sets]), len(sets)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    # What one set alone holds is in no intersection.
    held = count[column] > 1
    owner, place = owner[held], (np.cumsum(count > 1) - 1)[column[held]]
    # The set that shares most is the pivot.
    pivot = np.bincount(owner, minlength=n).argmax()
    of_pivot = np.zeros(int((count > 1).sum()), bool)
    of_pivot[place[owner == pivot]] = True
    distances = sizes + sizes[pivot] - 2 * np.bincount(owner, weights=of_pivot[place], minlength=n).astype(np.int64)
    order = np.argsort(distances, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    sizes, ends = sizes[order], windows(distances[order], sizes[order], rule)
    by_place = np.argsort(place, kind="stable")
    owner, place = rank[owner[by_place]], place[by_place]
    common = np.zeros((n, n), np.int32)
    for begin in range(0, len(of_pivot), COLUMNS):
        part = slice(*np.searchsorted(place, (begin, begin + COLUMNS)))
        bits = np.zeros((n, COLUMNS), bool)
        bits[owner[part], place[part] - begin] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for i in range(n - 1):
            if ends[i] > i + 1:
                common[i, i + 1 : ends[i]] += np.bitwise_count(packed[i + 1 : ends[i]] & packed[i]).sum(axis=1, dtype=np.int32)
    found, joined = [], np.arange(n)
    for i in range(n - 1):
        near = slice(i + 1, ends[i])
        union = sizes[near] + sizes[i] - common[i, near]
        for j in (np.flatnonzero(100 * common[i, near].astype(np.int64) >= rule.percent * union) + i + 1).tolist():
            if joined[i] != joined[j]:  # one link between what is joined already is enough
                joined[joined == joined[j]] = joined[i]
                found.append((keys[order[i]], keys[order[j]]))
    return found


def _screened(sizes: list[int], sketches: list[bytes], keys: list[int], sides: list[int], rule: Rule) -> list[tuple[int, int]]:
    """Pairs that join the sets whose sketches do not tell that they are no links.

    Of two blocks, which are told by their sides, only sets of different ones are compared.
    """
    order = np.argsort(sizes, kind="stable")
    sizes, sides = np.array(sizes)[order], np.array(sides)[order]
    buckets = np.array([len(sketches[i]) for i in order])
    ends = np.searchsorted(sizes, [rule.largest_partner(int(n)) for n in sizes], side="right")
    found, joined = [], np.arange(len(sizes))
    for width in np.unique(buckets):
        own = np.flatnonzero(buckets == width)  # in a row, as sizes are sorted
        first, last = int(own[0]), int(ends[own[-1]])
        fine = np.stack([folded(np.frombuffer(sketches[i], np.uint8), int(width)) for i in order[first:last]])
        coarse = folded(fine, COARSE)
        steps = [coarse, fine] if width > COARSE else [fine]
        from_pivot = apart(coarse, coarse[len(coarse) // 2])
        for i in own:
            near = np.arange(i + 1, ends[i])
            near = near[(joined[near] != joined[i]) & ((sides[i] < 0) | (sides[near] != sides[i]))]
            most = rule.most_differing(sizes[near] + sizes[i])
            kept = np.abs(from_pivot[near - first] - from_pivot[i - first]) <= most
            for step in steps:
                near, most = near[kept], most[kept]
                if not len(near):
                    break
                kept = apart(step[near - first], step[i - first]) <= most
            for j in near[kept] if len(near) else ():
                if joined[i] != joined[j]:
                    joined[joined == joined[j]] = joined[i]
                    found.append((keys[order[i]], keys[order[j]]))
    return found


def _by_region(batches: Iterator[pa.RecordBatch], finish: Callable[..., list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    """What `finish` finds in the columns of each region of two rows or more; rows are sorted by region, regions may span batches."""
    region, members = None, []

    def finished() -> list[tuple[int, int]]:
        return finish(*map(list, zip(*members, strict=True))) if len(members) > 1 else []

    for batch in batches:
        found = []
        for at, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != region:
                found += finished()
                region, members = at, []
            members.append(values)
        yield _pairs(found)
    yield _pairs(finished())


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(2)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def links(docs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): keys of linked sets, enough of them to tell who is linked to whom.

    `sets` has row, n, key and sketch of every row of `docs` with a set.
    """

    def run(texts: pa.Array, pivots: pa.Array) -> pa.Array:
        return _linked(texts, pivots, rule)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_region(batches, lambda keys, texts: _compared(texts, keys, rule))

    def compared(members: DataFrame) -> DataFrame:
        members = F.broadcast(members) if members.count() <= BROADCAST_KEYS else members
        direct = members.join(texts, F.col("key") == F.col("text_key")).select("region", "key", "text")
        return stored(direct.repartition("region").sortWithinPartitions("region").mapInArrow(compare, PAIRS), "links")

    # Each set is cut once, and its slices are moved once: only those that different sets share are kept.
    cut, same = sliced(_distinct(docs, sets), rule), Window.partitionBy("sig")
    met = cut.select("sig", "key", F.min("key").over(same).alias("low"), F.max("key").over(same).alias("high"), F.count("*").over(same).alias("n"))
    together = stored(met.where("low < high").select("sig", "key", "n"), "together")
    # A set agrees in a slice with as many sets as share it. Counted over all slices, an
    # original agrees with more than its edited copies do.
    agree = together.groupBy("key").agg(F.sum("n").alias("agree")).withColumnRenamed("key", "agree_key")
    scored = together.join(agree, F.col("key") == F.col("agree_key")).select(F.col("sig").alias("group"), "key", "agree")
    around = stored(narrow(_chosen(scored)), "regions")
    near = components(stored(narrow(_near(sets, around, rule)), "near")).select(F.col("root").alias("region"), "node")
    members = near.join(around.select("key", "agree").distinct(), F.col("node") == F.col("key")).select("region", "key", "agree")
    members = stored(narrow(members), "members")
    texts = _texts(docs, sets, members)
    members = members.join(texts.select("text_key", F.octet_length("text").alias("bytes")), F.col("key") == F.col("text_key"))
    size = members.groupBy(F.col("region").alias("of_region")).agg(
        F.count("*").alias("n"), F.sum("bytes").alias("all_bytes"), F.max(F.struct("agree", "key"))["key"].alias("pivot")
    )
    small = (F.col("n") <= SMALL_SETS) & (F.col("all_bytes") <= SMALL_BYTES)
    known = members.join(size, F.col("region") == F.col("of_region")).withColumn("small", small).drop("of_region", "text_key")
    known = stored(narrow(known), "known")
    found = [compared(known.where("small").select("region", "key"))]

    placed = known.where("not small and key <> pivot").select("region", "key", "bytes", "pivot")
    if not placed.isEmpty():
        own = placed.join(texts, F.col("key") == F.col("text_key")).select("region", "key", "bytes", "pivot", F.col("text").alias("own"))
        faced = own.join(texts, F.col("pivot") == F.col("text_key"))
        linked = F.arrow_udf(run, "boolean")("own", "text").alias("linked")
        measured = stored(faced.select("region", "key", "bytes", "pivot", linked), "measured")
        found += [measured.where("linked").select(F.col("key").alias("a"), F.col("pivot").alias("b")), compared(_parts(measured))]
    every = docs.sparkSession.createDataFrame([], PAIRS)
    for more in found:
        every = every.unionByName(more)
    return every


def _blocks(most: int, large: int, sets: str, amount: str) -> Column:
    """Blocks of a region of so many sets and bytes or shingles, so that two of them are within the limits."""
    return F.greatest(F.ceil(F.col(sets) / max(1, most // 2)), F.ceil(F.col(amount) / (large // 2)))


def _near(sets: DataFrame, around: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): pairs that join the sets of a region whose sketches are near each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_region(batches, lambda keys, sizes, sketches, sides: _screened(sizes, sketches, keys, sides, rule))

    shingles = sets.groupBy(F.col("key").alias("set_key")).agg(F.max("n").alias("shingles"))
    size = around.join(shingles, F.col("key") == F.col("set_key")).groupBy(F.col("region").alias("of_region")).agg(
        F.count("*").alias("all_sets"), F.sum("shingles").alias("all_shingles")
    ).where("all_sets > 1")
    one = (F.col("all_sets") <= SCREEN_SETS) & (F.col("all_shingles") <= SCREEN_SHINGLES)
    blocks = F.when(one, 1).otherwise(_blocks(SCREEN_SETS, SCREEN_SHINGLES, "all_sets", "all_shingles"))
    size = stored(narrow(size.select("of_region", blocks.alias("blocks"))), "sizes")
    placed = around.join(size, F.col("region") == F.col("of_region")).select("region", "key", "blocks", F.pmod(F.xxhash64("key"), "blocks").alias("block"))
    placed = placed.select("region", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "blocks")
    low, high = F.least("block", "other"), F.greatest("block", "other")
    placed = placed.select(
        F.when(F.col("blocks") == 1, F.col("region")).otherwise(F.xxhash64("region", low, high)).alias("region"),
        F.col("key").alias("of_key"), F.when(low < high, F.col("block")).otherwise(-1).alias("side"),
    )
    # Copies are dropped by each task before any meet.
    drawn = sets.select("key", "n", "sketch").dropDuplicates(["key"]).join(placed, F.col("key") == F.col("of_key")).select("region", "key", "n", "sketch", "side")
    return drawn.repartition("region").sortWithinPartitions("region").mapInArrow(run, PAIRS)


def _parts(measured: DataFrame) -> DataFrame:
    """(region, key): any two blocks of a large region, one of them of outer sets, as a region."""
    outer = ~F.col("linked")
    size = measured.groupBy(F.col("region").alias("of_region")).agg(
        *(f(F.when(which, value)).alias(name + kind)
          for kind, which in (("outer", outer), ("linked", F.col("linked")))
          for name, f, value in (("n_", F.count, F.lit(1)), ("bytes_", F.sum, F.col("bytes"))))
    ).where("n_outer > 0").na.fill(0)
    blocks = [_blocks(SMALL_SETS, SMALL_BYTES, f"n_{kind}", f"bytes_{kind}").alias(f"blocks_{kind}") for kind in ("outer", "linked")]
    size = size.select("of_region", *blocks)
    block = F.when(outer, F.pmod(F.xxhash64("key"), "blocks_outer")).otherwise(F.col("blocks_outer") + F.pmod(F.xxhash64("key"), "blocks_linked"))
    placed = measured.join(size, F.col("region") == F.col("of_region")).withColumn("block", block)
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks_outer") + F.col("blocks_linked") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    # Two outer blocks hold the pairs inside each as well, unless there is only one.
    parts = placed.where((low < F.col("blocks_outer")) & ((low < high) | (F.col("blocks_outer") + F.col("blocks_linked") == 1)))
    return stored(narrow(parts.select(F.xxhash64("region", low, high).alias("region"), "key")), "parts")


def _chosen(groups: DataFrame) -> DataFrame:
    """(group, key, agree) → (region, key, agree): groups with the same best member are one region."""
    best = groups.groupBy(F.col("group").alias("of_group")).agg(F.max(F.struct("agree", "key"))["key"].alias("best"))
    named = groups.join(best, F.col("group") == F.col("of_group"))
    return named.select(F.xxhash64("best").alias("region"), "key", "agree").distinct()


def _distinct(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """One row of every set; more where a whole row is repeated, or where neither rows nor copies are few.

    No text is moved for it: to cut a copy's set again costs less.
    """
    rows = stored(narrow(sets.groupBy("key").agg(F.min("row").alias("first_row"))), "first")
    row = row_of("doc_id", "text")
    if rows.count() <= BROADCAST_KEYS:
        return docs.join(F.broadcast(rows.select("first_row")), row == F.col("first_row"), "left_semi")
    copies = sets.join(rows.withColumnRenamed("key", "of_key"), F.col("key") == F.col("of_key")).where("row <> first_row")
    copies = stored(narrow(copies.select(F.col("row").alias("copy_row")).distinct()), "copies")
    if copies.count() <= BROADCAST_KEYS:
        return docs.join(F.broadcast(copies), row == F.col("copy_row"), "left_anti")
    return docs


def _texts(docs: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """One text of every set that has a region: text_key, text."""
    wanted = members.select(F.col("key").alias("wanted")).distinct()
    rows = sets.groupBy("key", "row").agg(F.count("*").alias("times"))
    first = rows.groupBy("key").agg(F.min(F.struct("row", "times")).alias("first"))
    first = first.join(wanted, F.col("key") == F.col("wanted"), "left_semi")
    first = stored(narrow(first.select("key", F.col("first.row").alias("first_row"), F.col("first.times").alias("times"))), "first")
    # A checked size decides; beyond it Spark shuffles both sides by row.
    few = first.count() <= BROADCAST_KEYS
    numbered = docs.select(row_of("doc_id", "text").alias("row"), text_of(F.col("text")).cast("binary").alias("text"))

    def found(rows: DataFrame) -> DataFrame:
        rows = F.broadcast(rows) if few else rows
        return numbered.join(rows, F.col("row") == F.col("first_row")).select(F.col("key").alias("text_key"), "text")

    # Only texts of rows that come more than once have to meet, so that one of them stays.
    again = first.where("times > 1")
    if again.isEmpty():
        return stored(found(first), "texts")
    return stored(found(first.where("times = 1")).unionByName(found(again).dropDuplicates(["text_key"])), "texts")


def grouped(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Sets of the rows (doc_id, row, n, key), and (key, component): linked sets share one.

    `docs` needs doc_id and text. Null texts and texts without words have no set: n = 0,
    key null, and are linked with nothing.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    measured = slim.select("doc_id", row_of("doc_id", "text").alias("row"), set_of(F.col("text"), rule.width).alias("s"))
    sets = stored(
        measured.select("doc_id", "row", "s.n", F.when(F.col("s.n") > 0, F.col("s.key")).alias("key"), "s.sketch"), "sets"
    )
    found = components(links(slim, sets.where("key is not null"), rule))
    return sets, found.select(F.col("node").alias("component_key"), F.col("root").alias("component"))


def classed(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    component_id is the least doc_id that links reach, the row's own included; rows
    without a doc_id count only where no other is reached. Copies are linked to each
    other. Repeated rows stay repeated, an empty table gives no rows.
    """
    sets, found = grouped(docs, rule)
    least = sets.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    least = least.join(found, F.col("key") == F.col("component_key"), "left").select(
        "key", "least", F.coalesce("component", "key").alias("component")
    )
    names = least.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    named = stored(narrow(least.join(names, F.col("component") == F.col("of")).select(F.col("key").alias("of_key"), "component_id")), "names")
    return sets.join(named, F.col("key") == F.col("of_key"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """`docs` without near copies: of each group the row with the least doc_id stays.

    Null ids come last. Among rows that repeat an id the text decides, and of rows that
    repeat both any one stays. Rows without words are no copies of anything and all stay.
    """
    sets, found = grouped(docs, rule)
    joined = sets.where("key is not null").join(found, F.col("key") == F.col("component_key"), "left")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    least = joined.groupBy(F.coalesce("component", "key").alias("group")).agg(F.min(order)["row"].alias("kept_row"))
    kept = stored(narrow(least.select("kept_row")), "kept")
    rows = whole(docs).withColumn("row", row_of("doc.doc_id", "doc.text"))
    wordless = ~F.coalesce(F.col("doc.text").rlike(WORD), F.lit(False))
    chosen = rows.where(~wordless).join(kept.hint("merge"), F.col("row") == F.col("kept_row"), "left_semi")
    chosen = chosen.dropDuplicates(["row"])
    return chosen.unionByName(rows.where(wordless)).select("doc.*")
