"""Word shingles of many texts at once, as arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallyhouse.llm.phrases import MULTIPLY, mixed

GROUP_BYTES = 1 << 19
LOWER = bytes(range(256)).lower()  # bytes.lower() changes A-Z only
GAPS = b" \t\n\x0b\x0c\r"
BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)

_is_gap = np.zeros(256, bool)
_is_gap[list(GAPS)] = True
_letters = mixed(np.arange(1, 257, dtype=np.uint64))
_powers: list[np.ndarray] = []


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 … size-1, modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        grown = max(size, GROUP_BYTES + GROUP_BYTES // 2)
        _powers[:] = []
        for factor in (BASE, INVERSE):
            row = np.full(grown, factor, np.uint64)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
    return _powers[0][:size], _powers[1][:size]


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(text number, part) in groups of bounded size; parts are cut between words."""
    group, size = [], 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = at + GROUP_BYTES
            while stop < len(text) and text[stop] not in GAPS:
                stop += 1
            group.append((number, text[at:stop]))
            size += min(stop, len(text)) - at
            at = stop
            if size >= GROUP_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased (A-Z) word in order, and the number of its text."""
    hashes, numbers = [], []
    for group in _pieces(texts):
        raw = np.frombuffer(b"\n".join(part for _, part in group).translate(LOWER) + b"\n", np.uint8)
        gap = _is_gap[raw]
        begin = ~gap
        begin[1:] &= gap[:-1]
        start = np.flatnonzero(begin)
        if not len(start):
            continue
        finish = gap.copy()
        finish[0] = False
        finish[1:] &= ~gap[:-1]
        stop = np.flatnonzero(finish)
        power, back = _power(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_letters[raw] * power[:-1], out=sums[1:])
        length = (stop - start).astype(np.uint64)
        hashes.append(mixed((sums[stop] - sums[start]) * back[start] + length))
        ends = np.cumsum([len(part) + 1 for _, part in group])
        numbers.append(np.array([n for n, _ in group])[np.searchsorted(ends, start, side="right")])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(numbers)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text with fewer words than `width` has one shingle, its whole sequence; a text
    without words has none.
    """
    words, number = word_hashes(texts)
    count = np.bincount(number, minlength=len(texts))
    begin = np.cumsum(count) - count
    folded, short = words.copy(), {}
    for step in range(1, width + 1):
        for text in np.flatnonzero((count == step) & (count < width)):
            short[int(text)] = folded[begin[text]]
        if step < width:
            size = max(0, len(words) - step)
            folded[:size] = mixed(folded[:size] * MULTIPLY + words[step : step + size])
    for text in range(len(texts)):
        n = int(count[text])
        if not n:
            yield words[:0]
        elif n < width:
            yield np.array([short[text]], np.uint64)
        else:
            own = np.sort(folded[begin[text] : begin[text] + n - width + 1])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            yield own[fresh]
