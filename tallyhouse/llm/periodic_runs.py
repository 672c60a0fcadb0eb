"""Runs: stretches of words that repeat with a period, by dyadic square catching.

A square is a word sequence that stands twice in a row. The first half of a square with
period p, 2L <= p < 4L for a power of two L, wholly holds a block of L words that begins at a
multiple of L. Every such block, once complete, becomes a catcher: as words are appended, the
sequence's last L words are compared with the two blocks that stand 2L to 4L words back. An
equal block is extended as far as the words agree at distance p, to both sides; the stretch is
a square as soon as it is as long as p, and later words that go on agreeing merge into the
same run. Windows are compared by their hash, which prefix sums give for any window, so an
appended word costs two comparisons a level and nothing is kept but a few numbers a word.

All catchers of a level are compared at once, and short documents share one sequence, kept
apart by words that occur only once: no run crosses them. Hashes only propose; runs are
compared word by word before they are reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import text_of, whole

LEAST_WORDS = 12  # shorter runs are chance
GROUP_BYTES = 1 << 20  # texts worked on together; a longer text stands alone
PIECE_WORDS = 1 << 18  # words appended at once

# An odd base, its inverse modulo 2^64, and the mixing constants of splitmix64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
FOUND = f"struct<runs: {RUNS}, collapsed: binary>"


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) + np.uint64(BASE)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _powers(base: int, first: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = first
    return np.cumprod(steps, dtype=np.uint64)


class Catchers:
    """Squares of a growing sequence of integers (words)."""

    def __init__(self):
        self.words = np.empty(0, np.int64)
        self.sums = np.zeros(1, np.uint64)  # of word hash times base^place, before each place
        self.shifts = np.ones(1, np.uint64)  # base^-place, brings windows to a common place
        self.next_power = np.uint64(1)
        # Stretches that are squares or may still become one: first word, end of the run, period.
        self.begin = self.end = self.period = np.empty(0, np.int64)

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the windows of n words at a and at b have one hash."""
        sums, shifts = self.sums, self.shifts
        return (sums[a + n] - sums[a]) * shifts[a] == (sums[b + n] - sums[b]) * shifts[b]

    def agreeing(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words agree from a and b on (or before them), `most` at the utmost, by bisection."""
        low, high = np.zeros_like(a), most.copy()
        while len(low) and (low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(a, b, middle) if ahead else self.same(a - middle, b - middle, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        before = len(self.words)
        self.words = np.concatenate([self.words, words])
        now = len(self.words)
        powers = _powers(BASE, self.next_power, len(words) + 1)
        self.next_power = powers[-1]
        sums = np.cumsum(_mixed(words) * powers[:-1], dtype=np.uint64) + self.sums[-1]
        self.sums = np.concatenate([self.sums, sums])
        self.shifts = np.concatenate([self.shifts, _powers(UNBASE, self.shifts[-1], len(words) + 1)[1:]])

        live = np.flatnonzero(self.end == before)
        more = self.agreeing(self.end[live] - self.period[live], self.end[live], now - self.end[live], True)
        self.end[live] += more
        size = 1
        while size == 1 or 4 * size <= now:
            self._catch(size, before, now)
            size *= 2

    def _catch(self, size: int, before: int, now: int) -> None:
        """Compare the windows that the new words complete with the catchers of this level."""
        first = max(0, before - size + 1)
        origin = max(0, first - 4 * size)
        if now - size < first:
            return
        names = (self.sums[origin + size : now + 1] - self.sums[origin : now - size + 1]) * self.shifts[origin : now - size + 1]
        at = np.arange(first, now - size + 1)
        nearest = (at - 2 * size) // size * size
        found = []
        # Below two words' distance there is only the level of single words.
        for block in (nearest, nearest - size, *([at - 1] if size == 1 else [])):
            valid = np.flatnonzero(block >= 0)
            hit = valid[names[block[valid] - origin] == names[at[valid] - origin]]
            found.append((block[hit], at[hit]))
        block, at = (np.concatenate(side) for side in zip(*found, strict=True))
        if size > 1 and len(block):
            # Inside one run of at most half the block's words this only repeats the run.
            inner = (2 * self.period <= size) & (self.end - self.begin >= 2 * self.period)
            if inner.any():
                reach = np.zeros(now + 1, np.int64)
                np.maximum.at(reach, self.begin[inner], self.end[inner])
                outside = np.maximum.accumulate(reach)[block] < at + size
                block, at = block[outside], at[outside]
        if not len(block):
            return
        ahead = self.agreeing(block + size, at + size, now - at - size, True)
        back = self.agreeing(block, at, block, False)
        self._merge(block - back, at + size + ahead, at - block, now)

    def _merge(self, begin: np.ndarray, end: np.ndarray, period: np.ndarray, now: int) -> None:
        worth = (end - begin >= 2 * period) | (end == now)
        rows = np.stack([np.concatenate([old, new[worth]]) for old, new in ((self.period, period), (self.begin, begin), (self.end, end))])
        still = (rows[2] - rows[1] >= 2 * rows[0]) | (rows[2] == now)
        self.period, self.begin, self.end = np.unique(rows[:, still], axis=1)

    def runs(self, least: int) -> np.ndarray:
        """Rows (first word, end, smallest period) of the runs so far, at least `least` words and two periods long."""
        long = self.end - self.begin >= np.maximum(least, 2 * self.period)
        found = np.stack([self.begin[long], self.end[long], self.period[long]], axis=1)
        true = [np.array_equal(self.words[b : e - p], self.words[b + p : e]) for b, e, p in found]
        for p in {int(p) for (_, _, p), t in zip(found, true, strict=True) if not t}:  # hashes that met by chance
            found = np.concatenate([found[found[:, 2] != p], self._plain(p, least)])
            true = [True] * len(found)
        # A multiple of a period has the same ends; the smallest comes first.
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        again = np.zeros(len(found), bool)
        again[1:] = (found[1:, :2] == found[:-1, :2]).all(axis=1)
        return found[~again]

    def _plain(self, period: int, least: int) -> np.ndarray:
        agree = np.concatenate([[False], self.words[period:] == self.words[:-period], [False]])
        turns = np.flatnonzero(agree[1:] != agree[:-1]).reshape(-1, 2)
        rows = np.column_stack([turns[:, 0], turns[:, 1] + period, np.full(len(turns), period)])
        return rows[rows[:, 1] - rows[:, 0] >= max(least, 2 * period)]


def _grouped(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= GROUP_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _found(texts: list[bytes], least: int) -> tuple[list[list[dict]], list[bytes]]:
    """Runs and collapsed text of every text."""
    # Without arguments bytes are split at exactly the blanks and control characters meant here.
    words = [t.split() for t in texts]
    codes: dict[bytes, int] = {}
    parts, starts, at = [], [], 0
    for i, own in enumerate(words):
        parts.append(np.fromiter((codes.setdefault(w, len(codes)) for w in own), np.int64, len(own)))
        parts.append(np.array([-1 - i], np.int64))  # a word that stands only here
        starts.append(at)
        at += len(own) + 1
    sequence, catchers = np.concatenate(parts), Catchers()
    for begin in range(0, len(sequence), PIECE_WORDS):
        catchers.append(sequence[begin : begin + PIECE_WORDS])
    found = catchers.runs(least)
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    covered = np.zeros(at + 1, np.int64)
    np.add.at(covered, found[:, 0] + found[:, 2], 1)
    np.add.at(covered, found[:, 1], -1)
    keep = np.cumsum(covered) == 0
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    runs: list[list[dict]] = [[] for _ in texts]
    for i, (begin, end, period) in zip(owner.tolist(), found.tolist(), strict=True):
        runs[i].append({"start": begin - starts[i], "length": end - begin, "period": period})
    collapsed = [
        b" ".join(compress(own, keep[s : s + len(own)].tolist()) if has else own)
        for own, s, has in zip(words, starts, runs, strict=True)
    ]
    return runs, collapsed


def _column(texts: pa.Array, least: int) -> pa.Array:
    runs, collapsed = [], []
    for group in _grouped([t or b"" for t in texts.to_pylist()]):
        for all_of, one in zip((runs, collapsed), _found(group, least), strict=True):
            all_of += one
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    return pa.StructArray.from_arrays([pa.array(runs, kind), pa.array(collapsed, pa.binary())], names=["runs", "collapsed"])


def found(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Column `doc` with the given columns, `runs` of the text, and the `collapsed` text.

    Runs are at least `least` words and two periods long, sorted by start and period, with the
    smallest period, and no neighbouring word could be added; words are counted from 0. The
    collapsed text keeps the words that no run holds beyond its first period, joined by blanks.
    Null and empty texts have no runs and collapse to the empty text. Repeated rows stay
    repeated, an empty table gives no rows, other columns may have any name.
    """
    if least < 1:
        raise ValueError("a run has words")

    def run(texts: pa.Array) -> pa.Array:
        return _column(texts, least)

    rows = whole(docs)
    answer = F.arrow_udf(run, FOUND)(text_of(F.col("doc.text")).cast("binary"))
    return rows.select("doc", answer.alias("found")).select("doc", "found.runs", F.col("found.collapsed").cast("string").alias("collapsed"))
