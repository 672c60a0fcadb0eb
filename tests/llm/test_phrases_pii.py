from __future__ import annotations

import hashlib
import re

import numpy as np

from tallyhouse.llm import phrases, pii


def test_fingerprints_follow_the_contract(docs, prose):
    texts = [prose(i, 5 + 11 * i, 2) for i in range(40)] + ["", "", "abc", "ééé" * 50, prose(3, 38, 2)]
    rows = {r.doc_id: r for r in phrases.compared(docs(*texts)).collect()}
    assert len(rows) == len(texts)
    prints = phrases.fingerprints(texts)
    for i, text in enumerate(texts):
        following = (texts[1:] + texts[:1])[i]
        gone = len(text) // 4
        changed = text[: len(text) - gone] + following[:gone]
        row = rows[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (prints[i], phrases.fingerprints([changed])[0])
        assert row.near_edited == phrases.likeness(prints[i], row.edited_fingerprint)
        assert row.near_next == phrases.likeness(prints[i], phrases.fingerprints([following])[0])
    assert rows[3].fingerprint == rows[44].fingerprint and rows[40].fingerprint == ""


def test_a_fingerprint_does_not_depend_on_its_neighbours(prose):
    texts = [prose(i, 10 + i) for i in range(60)] + ["a", "aa", "ab" * 500, "a" * 1000, "x" * 3 + "y" * 4]
    assert phrases.fingerprints(texts) == [phrases.fingerprints([t])[0] for t in texts]


def test_equal_substrings_share_interior_names(prose):
    shared = prose(1, 400)

    def names(text: str, level: int) -> set:
        return next(set(n.tolist()) for at, n, _ in phrases.names_by_level([text]) if at == level)

    for level in (1, 2, 3):
        a, b = names(prose(2, 37) + shared, level), names("zz" + shared + prose(3, 11), level)
        assert len(a & b) >= 0.9 * len(names(shared, level))


def test_labels_never_repeat_and_stay_small():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 2**63, 5000).astype(np.uint64)
    first = np.zeros(5000, bool)
    first[[0, 17, 900]] = True
    labels = phrases._labels(symbols, first)
    assert labels.max() < 6 and not ((labels[1:] == labels[:-1]) & ~first[1:]).any()


def test_likeness(prose):
    one, near, far = phrases.fingerprints([prose(1, 300), prose(1, 300)[:-200] + prose(5, 30), prose(9, 300)])
    assert phrases.likeness(one, one) == 1 and phrases.likeness("", "") == 1 and phrases.likeness("", one) == 0
    assert phrases.likeness(one, near) > 0.6 > 0.2 > phrases.likeness(one, far)


def test_fingerprints_of_odd_rows(odd):
    rows = phrases.compared(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "3", "3", "4", "5", "None"]
    assert next(r for r in rows if r.doc_id is None).fingerprint == ""
    assert phrases.compared(odd.limit(0)).count() == 0
    single = phrases.compared(odd.where("doc_id = 4")).first()
    assert single.near_next == 1.0


# Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text: str) -> list[tuple]:
    def fits(kind: str, match: str) -> bool:
        digits = re.sub("[^0-9]", "", match)
        double = sum(d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(map(int, reversed(digits))))
        return {
            "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
            "card": 14 <= len(digits) <= 19 and double % 10 == 0, "phone": 10 <= len(digits) <= 15,
        }[kind]

    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if fits(k, m[0])]
    return [(i, a, b) for a, i, b in sorted(found)]


def test_patterns_equal_the_plain_ones():
    import random

    rng = random.Random(4)
    parts = ["a.b@c.de", "x@@y.z", "@q", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "0007.0.0.1", "4111 1111 1111 1111", "4111111111111112",
             "+1 (743) 555-3824", "+12", "+1-2-3", "5500-0000-0000-0004", "é", " ", " ", "-", ".", "12", "a@b", "a@b.c.", "%@-.-", "\n", "+"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "@" * 300_000, "+" * 300_000, "x1" * 150_000):
        pii.tokens_of(text, pii.base_spans(text))


def model():
    texts = [f"call +1 (743) 555-{i:04} or mail me.{i}@mail{i}.example.com, host 10.1.{i % 200}.7, in version 2.{i % 9}, year {1990 + i % 30}" for i in range(150)]
    texts += [f"call +1 (743) 555-{i:04} now, again 743-555-{i:04}" for i in range(20)]
    return pii.trained(texts)


def test_a_second_mention_gets_the_label_of_the_first():
    text = "Reach us at 555-382499 today. Our number: +1 (743) 555-382499 is always open, as of 2019. Call 555382499, version 2.4!"
    base = pii.base_spans(text)
    more = pii.added_spans([text], [base], model())[0]
    assert [text[a:b] for k, a, b in more if k == 3] == ["555-382499", "555382499"]
    alone = "Released in 2019 as version 2.4."
    assert pii.added_spans([alone], [pii.base_spans(alone)], model()) == [[]]


def test_mentions_in_other_forms_are_linked():
    def linked(text: str) -> set[tuple[str, str]]:
        found = pii.tokens_of(text, [])
        words = [text[a:b] for a, b in found.spans]
        return {(words[m], words[i]) for i, same in enumerate(found.mentions) for m in same}

    assert ("jane@firm.com", "jane@firm") in linked("Write jane@firm.com today, later jane@firm is enough")
    assert ("+49-30-1234567", "030-1234567") in linked("Call +49-30-1234567 or locally 030-1234567")
    blocks = linked("Paid by 4716 2210 5188 5662 now, then 4716 2210 5188 5662 again, and 4716221051885662")
    assert {(g, g) for g in ("4716", "2210", "5188", "5662")} <= blocks
    assert {("5662", "4716221051885662"), ("4716", "4716221051885662")} <= blocks
    assert not linked("4716 2210 5188 5662") and not linked("jane@firm.com and jane@other.com, 555 1234 and 555 1235")


def test_a_label_reaches_other_forms():
    trained = pii.trained([
        f"call +1 (743) 555-{i:04}, again +1 (743) 555-{i:04}, mail me.{i}@mail{i}.example.com or me.{i}@mail{i}.example.com, "
        f"item {i * 7919 + 10**6} and item {i * 7919 + 10**6}" for i in range(300)
    ])

    def added(text: str) -> list[str]:
        return [text[a:b] for _, a, b in pii.added_spans([text], [pii.base_spans(text)], trained)[0]]

    assert added("Call +49 30 8834567 now, 8834567 later") == ["8834567"]
    assert added("Call +49 30 8834567 now, 030 8834567 later") == ["030 8834567"]
    assert added("Call 8834567 today. " * 3) == []


def test_messages_agree_with_exact_marginals_on_a_tree():
    rng = np.random.default_rng(2)
    nodes, edges = rng.normal(size=(3, pii.LABELS)), rng.normal(size=(2, pii.LABELS, pii.LABELS))
    joint = np.exp(
        nodes[0][:, None, None] + nodes[1][None, :, None] + nodes[2][None, None, :] + edges[0][:, :, None] + edges[1][None, :, :]
    )
    joint /= joint.sum()
    exact = np.stack([joint.sum(axis=(1, 2)), joint.sum(axis=(0, 2)), joint.sum(axis=(0, 1))])
    found = pii.marginals(nodes, np.array([0, 1]), np.array([1, 2]), edges)
    assert np.abs(found - exact).max() < 1e-3


def test_personal_data_of_documents(docs, odd):
    texts = ["mail a.b@c.de and +1 (743) 555-3824", "nothing here", "", "é 10.0.0.1 10.0.0.300"]
    rows = {r.doc_id: r for r in pii.found(docs(*texts)).collect()}
    for i, text in enumerate(texts):
        base = plain(text)
        written = ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for k, a, b in base)
        assert rows[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in PLAIN] == [sum(b[0] == n for b in base) for n in range(4)]
        assert set(filter(None, written.split(","))) <= set(rows[i].spans.split(","))
    found = pii.found(odd).collect()
    assert len(found) == odd.count() and next(r for r in found if r.doc_id is None).spans == ""
    assert pii.found(odd.limit(0)).count() == 0
