from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tallyhouse.llm import va_file

VECTORS = "vec_id bigint, embedding array<double>, cluster int"


def plain(rows: list[tuple], width: int, k: int, rounds: int, scale: int):
    """(vec_id, cluster, distance) of every usable vector, and the centroids."""
    kept = [
        (i, [math.floor(scale * x) for x in v]) for i, v, _ in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [
            [sum(column) // len(groups[i]) for column in zip(*groups[i])] if i in groups else c for i, c in enumerate(centroids)
        ]
    return sorted(((i, *reversed(nearest(v))) for i, v in kept), key=str), centroids


def vectors(n: int, width: int, seed: int = 1, spread: float = 0.1) -> list[tuple]:
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.5) for _ in range(width)] for _ in range(6)]
    return [(i, [m + rng.gauss(0, spread) for m in middles[i * i % 6]], 7) for i in range(n)]


def found(spark, rows, width=8, k=5, rounds=3, scale=256):
    table = va_file.integers(spark.createDataFrame(rows, VECTORS).repartition(3), "vec_id", "embedding", width, scale)
    return va_file.clustered(table, width, k, rounds, "2:")


def same(result, rows, width=8, k=5, rounds=3, scale=256):
    want, centroids = plain(rows, width, k, rounds, scale)
    got = sorted(((r.id, r.cluster, r.distance) for r in result.vectors.collect()), key=str)
    assert got == want and result.centroids.tolist() == centroids


@pytest.mark.parametrize(("block", "batch"), [(16, 1024), (16, 8), (10, 7), (7, 50), (4096, 1024)])
def test_equals_plain_k_means(spark, block, batch, monkeypatch):
    monkeypatch.setattr(va_file, "BLOCK", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rows = vectors(300, 8)
    same(found(spark, rows), rows)


def test_the_approximation_decides(spark):
    rows = vectors(600, 8, spread=0.02)
    result = found(spark, rows, k=6)
    assert max(result.fetched) < 0.2
    same(result, rows, k=6)
    # Noise without clusters: intervals overlap more, the result is as exact.
    rows = vectors(400, 8, seed=2, spread=3.0)
    result = found(spark, rows, k=12)
    assert max(result.fetched) > 0
    same(result, rows, k=12)


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(3)
    v, centroids = rng.integers(-900, 900, (200, 5)), rng.integers(-2000, 2000, (7, 5))
    v[:20] *= 50
    cuts = np.sort(rng.integers(-900, 900, (5, va_file.CELLS - 1)))
    low, high = v.min(0)[:, None], v.max(0)[:, None]
    cells = va_file.Cells(np.concatenate([low, cuts], 1), np.concatenate([cuts - 1, high], 1), cuts)
    tables = va_file.distance_tables(cells, centroids)
    for row, numbers in zip(v, va_file.approximated(v, cells)):
        bounds = sum(tables[d][numbers[d]].astype(np.int64) for d in range(5))
        exact = ((centroids - row) ** 2).sum(1)
        assert (bounds[:7] <= exact).all() and (exact <= bounds[7:]).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(30, 4) + [
        (None, None, None), (100, None, 1), (101, [], 1), (102, [1.0] * 3, 1), (103, [1.0] * 5, 1), (104, [1.0, None, 1.0, 1.0], 1),
        (105, [nan, 0.0, 0.0, 0.0], 1), (106, [inf, 0.0, 0.0, 0.0], 1), (107, [0.0, -inf, 0.0, 0.0], 1),
        (None, [0.5, 0.5, 0.5, 0.5], None), (7, [0.25, -0.001, 0.0, -0.0], 2), (7, [0.25, -0.001, 0.0, -0.0], 2), (200, [900.0, -900.0, 0.0, 1.0], 3),
    ]
    same(found(spark, rows, width=4), rows, width=4)
    same(found(spark, rows[-4:], width=4, k=40), rows[-4:], width=4, k=40)  # fewer vectors than centroids
    same(found(spark, [(i, [0.5] * 4, 1) for i in range(20)], width=4), [(i, [0.5] * 4, 1) for i in range(20)], width=4)  # all tie
    empty = found(spark, rows[30:39], width=4)
    assert empty.vectors.count() == 0 and va_file.with_totals(empty).count() == 0


def test_a_component_too_large_is_refused(spark):
    with pytest.raises(Exception, match="would not fit 64 bits"):
        found(spark, [(1, [1e12, 0.0], 1)], width=2)


def test_totals(spark):
    rows = vectors(60, 4)
    result = found(spark, rows, width=4)
    table = va_file.with_totals(result).collect()
    assert len(table) == 60 and {r.inertia for r in table} == {sum(r.distance for r in table)}
    for r in table:
        assert r.cluster_inertia == sum(x.distance for x in table if x.cluster == r.cluster)
        text = ",".join(str(x) for x in result.centroids[r.cluster])
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()
