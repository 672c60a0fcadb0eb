"""k-means over a vector-approximation file.

Vectors of integers lie in files of fixed-width records. Beside them stands the approximation:
for each dimension the number of a cell in eight bits, a quarter of a record. Cells are equally
wide around the dimension's mean over all vectors, as far as the spread goes; the cuts decide
how much is saved, never what comes out. (With fewer bits the intervals of vectors that lie
almost as near to other centroids overlap nearly always: on the given tables six bits decide
3 % of the vectors, seven 25 %, eight 98 %.) For a set of centroids a lookup table gives, for each
dimension, cell and centroid, the least and the greatest squared difference that a vector of
that cell can have. Sums over the dimensions enclose each distance in an interval. Where one
centroid's interval ends before all others begin, the approximation decides; only where
intervals overlap the full vector is fetched from its place and compared exactly.

Centroids move by what changed: a vector that goes to another cluster is taken from one sum
and added to the other, so a settled vector is not fetched for that either. All arithmetic is
in integers. What tasks share is the centroids, a few numbers each; nothing is grouped by
cluster, so a cluster with most of the vectors is no hot key.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import shared_files
from tallyhouse.llm.text import stored

BITS = 8
CELLS = 1 << BITS
REACH = 4.5  # standard deviations on each side of the mean that the inner cells cover
BLOCK = 4096  # vectors worked on together
GAP = 64  # records read along rather than sought over
RECORD = np.dtype("<i4")

BLOCKS = "path string, first bigint, n int, ids array<bigint>"
SHAPE = f"{BLOCKS}, low array<bigint>, high array<bigint>, total array<double>, squares array<double>"
CODED = f"{BLOCKS}, cells binary, clusters binary, fetched int, sums array<bigint>"
ASSIGNED = "id bigint, cluster int, distance bigint, fetched int"


def largest(width: int) -> int:
    """Components up to this size keep every squared distance inside 63 bits and a record's field."""
    return min(math.isqrt(2**62 // width) // 2, 2**30)


def integers(vectors: DataFrame, vector_id: str, column: str, width: int, scale: int) -> DataFrame:
    """id and the components floor(scale * x) of the vectors that have `width` finite components."""
    values = F.col(f"`{column}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col(f"`{vector_id}`").cast("bigint").alias("id"), values.alias("x")).where((F.size("x") == width) & finite)
    return usable.select("id", F.transform("x", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the k smallest hashes of seed and id; of equal ones the smaller vector, null ids last."""
    draw = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    chosen = rows.orderBy(draw.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r.v for r in chosen], np.int64)


# The file


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def _tables(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches' rows in tables of `rows` rows; the last may be shorter."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        while n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            yield table.slice(0, rows)
            held, n = table.slice(rows).to_batches(), n - rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


_INTS, _FLOATS = pa.list_(pa.int64()), pa.list_(pa.float64())
_BLOCK_KINDS = [("path", pa.string()), ("first", pa.int64()), ("n", pa.int32()), ("ids", _INTS)]
_SHAPE_KINDS = [*_BLOCK_KINDS, ("low", _INTS), ("high", _INTS), ("total", _FLOATS), ("squares", _FLOATS)]
_CODED_KINDS = [*_BLOCK_KINDS, ("cells", pa.binary()), ("clusters", pa.binary()), ("fetched", pa.int32()), ("sums", _INTS)]


def written(rows: DataFrame, width: int) -> DataFrame:
    """Write the vectors into files of records, one a task, and list their blocks with the spread of each dimension."""
    folder, most = shared_files.new_folder(rows.sparkSession, "vectors"), largest(width)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _tables(batches, BLOCK)
        table, path, first = next(blocks, None), shared_files.unique(folder, "part", "vec"), 0
        if table is None:
            return
        with shared_files.writing(path) as out:
            while table is not None:
                v = _matrix(table.column("v").combine_chunks(), width)
                if abs(v).max() > most:
                    raise ValueError(f"a scaled component lies beyond {most}, distances would not fit 64 bits")
                out.write(v.astype(RECORD).tobytes())
                floats = v.astype(np.float64)
                spread = v.min(0), v.max(0), floats.sum(0), (floats * floats).sum(0)
                yield _batch(_SHAPE_KINDS, [(path, first, len(v), table.column("id").to_pylist(), *(s.tolist() for s in spread))])
                first, table = first + len(v), next(blocks, None)

    return stored(rows.mapInArrow(write, SHAPE), "vector-blocks")


@dataclass(frozen=True)
class Cells:
    """Least and greatest component of every cell, (width, CELLS) each, and the cuts between cells."""

    low: np.ndarray
    high: np.ndarray
    cuts: np.ndarray


def cells_of(blocks: DataFrame, width: int) -> Cells:
    """Cells from the spread of all vectors; one row a dimension comes to the driver."""
    place = F.posexplode(F.arrays_zip("low", "high", "total", "squares")).alias("d", "s")
    spread = blocks.select("n", place).groupBy("d").agg(
        F.min("s.low").alias("low"), F.max("s.high").alias("high"), F.sum("s.total").alias("total"),
        F.sum("s.squares").alias("squares"), F.sum("n").alias("n"),
    ).collect()
    low, high, mean, deviation = np.zeros(width), np.zeros(width), np.zeros(width), np.zeros(width)
    for r in spread:
        low[r.d], high[r.d], mean[r.d] = r.low, r.high, r.total / r.n
        deviation[r.d] = math.sqrt(max(0.0, r.squares / r.n - (r.total / r.n) ** 2))
    begin, end = np.maximum(low, mean - REACH * deviation), np.minimum(high, mean + REACH * deviation)
    # A component x is in the cell whose number is the count of cuts <= x; the outer cells reach to the ends.
    cuts = np.ceil(begin[:, None] + (end - begin)[:, None] * (np.arange(1, CELLS) / CELLS)).astype(np.int64)
    bounds = low.astype(np.int64)[:, None], high.astype(np.int64)[:, None]
    return Cells(np.concatenate([bounds[0], cuts], axis=1), np.concatenate([cuts - 1, bounds[1]], axis=1), cuts)


def approximated(v: np.ndarray, cells: Cells) -> np.ndarray:
    """Cell numbers, one row a vector."""
    return np.stack([np.searchsorted(cells.cuts[d], v[:, d], side="right") for d in range(v.shape[1])], axis=1).astype(np.uint8)


class Reader:
    """Full vectors of one block, fetched by their places when asked for."""

    def __init__(self, path: str, first: int, n: int, width: int):
        self.path, self.first, self.width = path, first, width
        self.held, self.vectors = np.zeros(n, bool), np.zeros((n, width), np.int64)

    def get(self, places: np.ndarray) -> np.ndarray:
        """The vectors at ascending places."""
        missing = places[~self.held[places]]
        if len(missing):
            size = self.width * RECORD.itemsize
            with shared_files.reading(self.path) as data:
                for part in np.split(missing, np.flatnonzero(np.diff(missing) > GAP) + 1):
                    begin, end = int(part[0]), int(part[-1]) + 1
                    data.seek((self.first + begin) * size)
                    self.vectors[begin:end] = np.frombuffer(data.read((end - begin) * size), RECORD).reshape(-1, self.width)
                    self.held[begin:end] = True
        return self.vectors[places]


def distance_tables(cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """(width, CELLS, 2k): the least squared difference of a cell and each centroid, then the greatest."""
    low, high, at = cells.low[:, :, None], cells.high[:, :, None], centroids.T[:, None, :]
    least = np.maximum(np.maximum(low - at, at - high), 0) ** 2
    most = np.maximum(np.abs(at - low), np.abs(high - at)) ** 2
    tables = np.concatenate([least, most], axis=2)
    return tables.astype(np.int32) if tables.max(axis=(1, 2)).sum() < 2**31 else tables


def nearest(cells: np.ndarray, tables: np.ndarray, centroids: np.ndarray, reader: Reader) -> tuple[np.ndarray, int]:
    """Number of the nearest centroid of every row (of equals the smaller), and how many vectors had to be fetched."""
    k = len(centroids)
    bounds = tables[0].take(cells[:, 0], axis=0)
    for table, column in zip(tables[1:], cells.T[1:], strict=True):
        bounds += table.take(column, axis=0)
    possible = bounds[:, :k] <= bounds[:, k:].min(axis=1)[:, None]
    chosen = possible.argmax(axis=1)
    unsure = np.flatnonzero(possible.sum(axis=1) > 1)
    for part in np.array_split(unsure, -(-len(unsure) // 512) or 1):
        if len(part):
            row, number = np.nonzero(possible[part])
            distances = np.full((len(part), k), np.iinfo(np.int64).max)
            distances[row, number] = ((reader.get(part)[row] - centroids[number]) ** 2).sum(axis=1)
            chosen[part] = distances.argmin(axis=1)
    return chosen, len(unsure)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _cells(row: dict) -> np.ndarray:
    return np.frombuffer(row["cells"], np.uint8).reshape(row["n"], -1)


def coded(blocks: DataFrame, cells: Cells, width: int) -> DataFrame:
    """The approximation file: cells of every block, no clusters yet."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _blocks(batches):
            v = Reader(row["path"], row["first"], row["n"], width).get(np.arange(row["n"]))
            none = np.full(row["n"], -1, np.int32).tobytes()
            yield _batch(_CODED_KINDS, [(row["path"], row["first"], row["n"], row["ids"], approximated(v, cells).tobytes(), none, 0, None)])

    return stored(blocks.select("path", "first", "n", "ids").mapInArrow(code, CODED), "approximation")


def reassigned(file: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """The file with new clusters, and one row a task (no path) with what the clusters' counts and sums gain."""
    k, width = centroids.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained, tables = np.zeros((k, width + 1), np.int64), distance_tables(cells, centroids)
        for row in _blocks(batches):
            reader = Reader(row["path"], row["first"], row["n"], width)
            new, fetched = nearest(_cells(row), tables, centroids, reader)
            old = np.frombuffer(row["clusters"], np.int32)
            moved = np.flatnonzero(new != old)
            if len(moved):
                counted = np.insert(reader.get(moved), width, 1, axis=1)
                np.add.at(gained, new[moved], counted)
                left = old[moved] >= 0
                np.subtract.at(gained, old[moved][left], counted[left])
            yield _batch(_CODED_KINDS, [(row["path"], row["first"], row["n"], row["ids"], row["cells"], new.astype(np.int32).tobytes(), fetched, None)])
        if gained.any():
            yield _batch(_CODED_KINDS, [(None, None, None, None, None, None, None, gained.ravel().tolist())])

    return stored(file.mapInArrow(assign, CODED), "approximation")


def gains(file: DataFrame, k: int, width: int) -> np.ndarray:
    """Sum of the tasks' gains: at most k * (width + 1) rows come to the driver."""
    parts = file.where("path IS NULL").select(F.posexplode("sums").alias("place", "gain"))
    total = np.zeros(k * (width + 1), np.int64)
    for r in parts.groupBy("place").agg(F.sum("gain").alias("gain")).collect():
        total[r.place] = r.gain
    return total.reshape(k, width + 1)


def distances(file: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """id, cluster and squared distance of every vector, and `fetched` 1 where the approximation did not decide."""
    width = centroids.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = distance_tables(cells, centroids)
        for row in _blocks(batches):
            reader = Reader(row["path"], row["first"], row["n"], width)
            new, fetched = nearest(_cells(row), tables, centroids, reader)
            away = ((reader.get(np.arange(row["n"])) - centroids[new]) ** 2).sum(axis=1)
            marks = np.arange(row["n"]) < fetched
            columns = [pa.array(row["ids"], pa.int64()), pa.array(new.astype(np.int32)), pa.array(away), pa.array(marks.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance", "fetched"])

    return stored(file.where("path IS NOT NULL").mapInArrow(measure, ASSIGNED), "assigned")


@dataclass(frozen=True)
class Clustering:
    """vectors: id, cluster, distance; centroids by number; share of vectors fetched in each assignment."""

    vectors: DataFrame
    centroids: np.ndarray
    fetched: list[float]


def clustered(rows: DataFrame, width: int, k: int, rounds: int, seed: str) -> Clustering:
    """k-means of `rows` (id, v: arrays of `width` integers) from k seeded vectors, with exact integer centroids.

    Each round assigns every vector to the nearest centroid and moves each centroid that has
    vectors to their componentwise floor of the mean; one without stays. With fewer vectors
    than k each is a centroid; without any there is no row. Repeated rows and ids count each.
    """
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return Clustering(rows.sparkSession.createDataFrame([], ASSIGNED).drop("fetched"), np.zeros((0, width), np.int64), [])
    blocks = written(rows, width)
    cells = cells_of(blocks, width)
    file, sums, shares = coded(blocks, cells, width), np.zeros((len(centroids), width + 1), np.int64), []
    for _ in range(rounds):
        file = reassigned(file, cells, centroids)
        sums += gains(file, len(centroids), width)
        file = file.where("path IS NOT NULL")
        filled = sums[:, width] > 0
        centroids = centroids.copy()
        centroids[filled] = sums[filled, :width] // sums[filled, width:]
        shares.append(file.agg(F.sum("fetched") / F.sum("n")).first()[0])
    result = distances(file, cells, centroids)
    shares.append(result.agg(F.avg("fetched")).first()[0])
    return Clustering(result.drop("fetched"), centroids, shares)


def with_totals(found: Clustering, name: Callable[[np.ndarray], str] | None = None) -> DataFrame:
    """The vectors with the distance summed over their cluster and over all, and the digest of their centroid."""
    vectors, name = found.vectors, name or digest
    # One row a cluster: k is a parameter, so the list is small.
    sums = {r.cluster: r.s for r in vectors.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    listed = [(i, s, total, name(found.centroids[i])) for i, s in sums.items()]
    totals = vectors.sparkSession.createDataFrame(listed, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return vectors.join(F.broadcast(totals), "cluster")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
