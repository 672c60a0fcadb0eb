from __future__ import annotations

import random

import numpy as np
import pytest

from tallyhouse.llm import jaccard_join as jj
from tallyhouse.llm.components import components
from tallyhouse.llm.shingles import shingle_sets
from tallyhouse.llm.text import stored
import brute


def copies(prose, seed, words, count, edits):
    """A text and copies of it with some words replaced, also copies of copies."""
    rng, made = random.Random(seed), [prose(seed, words).split()]
    for _ in range(count):
        words_of = list(rng.choice(made))
        for _ in range(rng.randint(0, edits)):
            words_of[rng.randrange(len(words_of))] = f"e{rng.randint(0, 60)}"
        made.append(words_of)
    return [" ".join(m) for m in made]


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("small", [128, 4])
def test_components_equal_brute_force(docs, prose, monkeypatch, width, percent, small):
    monkeypatch.setattr(jj, "SMALL_SETS", small)  # 4: the recursion has to do the work
    texts = copies(prose, 1, 120, 70, 4) + copies(prose, 2, 40, 30, 2) + copies(prose, 3, 12, 20, 1)
    texts += [prose(s, 60) for s in range(10, 30)] + ["a b", "a b", "A  b", "c", ""]
    random.Random(5).shuffle(texts)
    rows = jj.classed(docs(*texts), jj.Rule(width, percent)).collect()
    expected = brute.components(texts, width, percent)
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(expected))
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(brute.shingles(t, width)) for i, t in enumerate(texts)}


def test_odd_rows(odd):
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jj.classed(odd, jj.Rule(3, 90)).collect())
    assert rows[:2] == [("1", 0, "1"), ("2", 0, "2")]
    assert rows[2:5] == [("3", 1, "3")] * 3
    assert rows[-1] == ("None", 0, "None") and rows[5][1] == 29_998


def test_one_of_each_group_stays(odd, docs, prose):
    kept = jj.representatives(odd, jj.Rule(5, 80))
    assert kept.columns == odd.columns
    # The two equal rows are one; different texts under one id are different documents.
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "3", "4", "5", "None"]
    texts = copies(prose, 4, 100, 30, 2) + [prose(9, 50)]
    found = {r.doc_id for r in jj.representatives(docs(*texts)).collect()}
    assert found == set(brute.components(texts, 5, 80))


def test_empty_table(docs):
    assert jj.classed(docs(), jj.Rule(3, 90)).count() == 0
    assert jj.representatives(docs()).count() == 0


def test_linked_sets_share_a_slice():
    rng = np.random.default_rng(3)
    for percent in (80, 90):
        rule = jj.Rule(3, percent)
        for size in (4, 9, 10, 19, 40, 200, 1500):
            for _ in range(40):
                a = rng.integers(0, 2**63, size).astype(np.uint64)
                # As different as a linked pair can be: some replaced, or some added.
                gone = rule.most_differing(2 * size) // 2
                more = rule.largest_partner(size) - size
                for b in (np.append(a[gone:], a[:gone] + np.uint64(1)), np.append(a, rng.integers(0, 2**63, more).astype(np.uint64))):
                    sets = [np.unique(a), np.unique(b)]
                    common = len(np.intersect1d(*sets))
                    if not rule.linked(common, len(sets[0]) + len(sets[1]) - common) or common == len(sets[0]) == len(sets[1]):
                        continue
                    signatures, owners = jj.slices_of(sets, np.array([1, 2]), rule)
                    assert set(signatures[owners == 1]) & set(signatures[owners == 2])


def test_shingles_are_those_of_the_words(prose):
    texts = [prose(1, 300), "A b\x0bC\x0cd", "", "x", " \n ", "é É é  z", "a" * 2_000_000 + " b c d"]
    for width in (1, 3, 5):
        sizes = [len(s) for s in shingle_sets([t.encode() for t in texts], width)]
        assert sizes == [len(brute.shingles(t, width)) for t in texts]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    nodes = {n for a, b in links if a != b for n in (a, b)}
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in found} == {n: root[n] for n in nodes} and len(found) == len(nodes)


@pytest.mark.parametrize("columns", [64, 1 << 15])
def test_windows_prune_pairs_and_lose_no_link(prose, columns, monkeypatch):
    monkeypatch.setattr(jj, "COLUMNS", columns)
    rng, texts, rule = random.Random(11), [], jj.Rule(width=2, percent=80)
    for s in range(12):
        words = prose(s, 60 + 15 * s).split()
        texts.append(" ".join(words))
        for _ in range(6):  # near copies with more and more changes
            words[rng.randrange(len(words))] = f"changed{rng.random()}"
            texts.append(" ".join(words))
    texts = list(dict.fromkeys(texts))
    found = jj._compared([t.encode() for t in texts], list(range(len(texts))), rule)
    group = list(range(len(texts)))
    for a, b in found:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    assert group == brute.components(texts, 2, 80)
    sets = list(shingle_sets([t.encode() for t in texts], 2))
    distances = np.array([len(np.setxor1d(s, sets[0])) for s in sets])
    order = np.argsort(distances)
    ends = jj.windows(distances[order], np.array([len(s) for s in sets])[order], rule)
    compared, pairs = sum(max(0, e - i - 1) for i, e in enumerate(ends)), len(texts) * (len(texts) - 1) // 2
    assert compared < 0.5 * pairs


def test_texts_meet_only_where_rows_repeat(docs, prose, monkeypatch):
    plans = []

    def recorded(rows, label):
        if label == "texts":
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stored(rows, label)

    monkeypatch.setattr(jj, "stored", recorded)
    texts = copies(prose, 6, 60, 12, 2)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    expected = dict(enumerate(brute.components(texts, 3, 90)))
    for more in ([], rows[:5] + rows[:3]):
        found = jj.classed(docs(*rows, *more), jj.Rule(3, 90)).collect()
        assert len(found) == len(rows) + len(more) and {r.doc_id: r.component_id for r in found} == expected
    assert "Exchange hashpartitioning(text_key" not in plans[0] and "Exchange hashpartitioning(text_key" in plans[-1]


def test_sketches_differ_by_no_more_than_their_sets():
    rng = np.random.default_rng(5)
    for size in (1, 7, 60, 900, 4000):
        for changed in (0, 1, size // 10, size // 2, size):
            a = rng.integers(0, 2**63, size).astype(np.uint64)
            b = np.append(a[changed:], rng.integers(0, 2**63, changed + size // 5).astype(np.uint64))
            drawn = [np.frombuffer(jj.sketch(np.unique(s)), np.uint8) for s in (a, b)]
            for buckets in {min(map(len, drawn)), 16}:
                own, other = (jj.folded(d[None], buckets) for d in drawn)
                assert jj.apart(own, other[0])[0] <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("sets", [8192, 6])
def test_texts_that_share_a_passage_by_chance_are_not_moved(docs, prose, monkeypatch, sets):
    monkeypatch.setattr(jj, "SCREEN_SETS", sets)  # 6: regions are compared in blocks
    moved = {}

    def recorded(rows, label):
        moved.setdefault(label, []).append(stored(rows, label))
        return moved[label][-1]

    monkeypatch.setattr(jj, "stored", recorded)
    quoted = " ".join(f"q{i}" for i in range(30))
    own = lambda s: " ".join(random.Random(s).choices([f"{s}w{i}" for i in range(90)], k=40))
    texts = [f"{quoted} {own(s)}" for s in range(40)]
    texts += [t + " more" for t in texts[:3]]
    found = {r.doc_id: r.component_id for r in jj.classed(docs(*texts), jj.Rule(3, 80)).collect()}
    assert found == dict(enumerate(brute.components(texts, 3, 80)))
    assert moved["regions"][0].select("key").distinct().count() > 20  # they do share slices
    assert moved["texts"][0].count() == 6


def test_a_large_group_of_near_copies_takes_one_round(docs, prose, monkeypatch):
    monkeypatch.setattr(jj, "SMALL_SETS", 16)
    kept = []

    def recorded(rows, label):
        kept.append((label, stored(rows, label)))
        return kept[-1][1]

    monkeypatch.setattr(jj, "stored", recorded)
    texts = copies(prose, 8, 200, 150, 4)
    found = {r.doc_id: r.component_id for r in jj.classed(docs(*texts), jj.Rule(3, 90)).collect()}
    assert found == dict(enumerate(brute.components(texts, 3, 90)))
    assert [label for label, _ in kept].count("known") == 1
    parts = next(rows for label, rows in kept if label == "parts")
    assert parts.groupBy("region").count().agg({"count": "max"}).first()[0] < len(set(texts)) / 2


@pytest.mark.parametrize("keys, joins", [(20, 1), (2, 0)])
def test_no_text_is_shuffled_to_drop_copies(docs, prose, monkeypatch, keys, joins):
    """Where first rows are many, copies are dropped if they are few; else they are cut as well."""
    monkeypatch.setattr(jj, "BROADCAST_KEYS", keys)
    plans = []

    def recorded(rows, label):
        if label == "together":
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stored(rows, label)

    monkeypatch.setattr(jj, "stored", recorded)
    texts = copies(prose, 7, 60, 30, 2) + [prose(s, 50) for s in range(20, 30)]
    texts += texts[-5:]
    found = {r.doc_id: r.component_id for r in jj.classed(docs(*texts), jj.Rule(3, 90)).collect()}
    assert found == dict(enumerate(brute.components(texts, 3, 90)))
    assert len(plans) == 1 and "SortMergeJoin" not in plans[0] and plans[0].count("BroadcastHashJoin") in (joins, 2 * joins)
