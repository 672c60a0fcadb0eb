from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import periodic_runs, queries


def plain(words: list, least: int) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, by trying all periods at all places."""
    best: dict[tuple[int, int], int] = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                best.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((start, length, p) for (start, length), p in best.items())


def sequences(n: int) -> list[list[int]]:
    rng, made = random.Random(5), [[], [0], [0, 0], [0] * 40, [0, 1] * 30, ([0] * 9 + [1]) * 7, [0, 1, 1, 0] * 3 + [0]]
    for _ in range(n):
        length, letters = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(length)]
        for _ in range(rng.randint(0, 3)):
            if length > 4:
                start = rng.randrange(length)
                p = rng.randint(1, max(1, (length - start) // 2))
                for i in range(start + p, min(length, start + p * rng.randint(1, 6))):
                    words[i] = words[i - p]
        made.append(words)
    return made


def caught(catchers: periodic_runs.Catchers, least: int) -> list[tuple[int, int, int]]:
    return sorted((b, e - b, p) for b, e, p in catchers.runs(least).tolist())


@pytest.mark.parametrize("least", [1, 2, 12])
def test_appended_words_report_the_runs_so_far(least):
    rng = random.Random(9)
    for words in sequences(150):
        catchers, at = periodic_runs.Catchers(), 0
        while at < len(words):
            step = rng.choice([1, 1, 2, 3, 7, 20])
            catchers.append(np.array(words[at : at + step], np.int64))
            at += step
            assert caught(catchers, least) == plain(words[:at], least)


def test_hashes_that_meet_by_chance(monkeypatch):
    # All words look alike: only the comparison word by word tells them apart.
    monkeypatch.setattr(periodic_runs, "_mixed", lambda codes: np.ones(len(codes), np.uint64))
    for words in ([0, 1, 2, 0, 1, 2, 0, 1], [0, 0, 1, 1, 1, 2, 3]):
        catchers = periodic_runs.Catchers()
        catchers.append(np.array(words, np.int64))
        found = caught(catchers, 2)
        assert all(words[s : s + n - p] == words[s + p : s + n] for s, n, p in found)


def test_documents(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(periodic_runs, "GROUP_BYTES", 4000)
    monkeypatch.setattr(periodic_runs, "PIECE_WORDS", 700)
    texts = [" ".join(f"w{c}" for c in words) for words in sequences(60)]
    texts += [prose(s, 400, 5) for s in range(6)] * 2  # copies that stand next to each other are no run
    texts += ["a\tb\n" * 30 + "c", " ".join(["x"] * 5000), prose(3, 800).replace(" ", "\x0b")]
    for r in periodic_runs.found(docs(*texts)).collect():
        words = brute.WORD.findall(texts[r.doc.doc_id])
        runs = plain(words, 12)
        assert [tuple(x) for x in r.runs] == runs
        dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_odd_rows(odd):
    rows = periodic_runs.found(odd).collect()
    assert len(rows) == odd.count() and rows[0].doc.asDict().keys() == set(odd.columns)
    assert {r.collapsed for r in rows if r.doc.doc_id in (None, 1, 2)} == {""}
    assert all(r.runs == [] for r in rows)
    assert periodic_runs.found(odd.limit(0)).count() == 0


def changed(doc_id: int, words: list[str]) -> list[str]:
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def test_query(spark, prose, tmp_path):
    rows = [{"doc_id": i, "text": prose(i, 20 + i, 3), "lang": "en", "source": "s", "n_chars": 1} for i in range(120)]
    rows += [{"doc_id": 500 + i, "text": t, "lang": None, "source": None, "n_chars": None} for i, t in enumerate([None, "", " "] * 8)]
    pq.write_table(pa.Table.from_pylist(rows, schema=pa.schema(brute.DOCUMENT)), tmp_path / "documents.parquet")
    found = {r.doc_id: r.asDict() for r in queries.op12_square_catching(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows) and sum(r["n_runs"] > 0 for r in found.values()) > 5
    expected = {r["doc_id"]: r for r in brute.sql("op12_square_catching", rows)}
    for row in rows:
        words = changed(row["doc_id"], brute.WORD.findall(row["text"] or ""))
        runs = plain(words, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        want = dict(zip(("start", "length", "period"), best or (None,) * 3)) | {
            "doc_id": row["doc_id"], "n_runs": len(runs), "exponent_milli": best and 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(), "collapsed_sha256": hashlib.sha256(kept.encode()).hexdigest(),
        }
        assert found[row["doc_id"]] == want == expected[row["doc_id"]]
