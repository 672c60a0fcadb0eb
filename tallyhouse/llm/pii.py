"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and phone numbers. What they miss is
often a second mention in another form: a phone number without its prefix, an address
that is broken off. A conditional random field labels all tokens that hold a digit or an
@. Neighbours share a potential, and so do distant tokens that are mentions of one thing
in any form: equal tokens, addresses that begin alike, numbers that share seven digits at
an end, however they are cut into groups. Each is linked to the last and the first mention
of the same key, a few links a token. Loopy message passing carries what the patterns have found along both kinds
of edges; tokens that come out as an entity with high probability are added.

The field is trained on the pattern's own labels in a bounded sample of documents
(`SAMPLE_DOCS` with the lowest key hash, their first `SAMPLE_CHARS` characters): softmax
regression for the tokens, smoothed label counts for the edges. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import text_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 20_000
LEAST_PROBABILITY = 0.9
ROUNDS, DAMPING = 30, 0.5
LEAST_DIGITS = 5  # numbers with fewer are not taken for one another
SHARED_DIGITS = 7  # of numbers that differ in prefix or grouping
LONGEST_NUMBER = 19  # digits of a run of groups that is one number
GROUP_DOCS = 256
MOST_DIGITS = {2: 19, 3: 15}  # of a card, of a phone number

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# As the plain pattern, without trying again inside a run of digits that has failed.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile("[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
BETWEEN = frozenset(" ().-/")  # what separates the groups of one number
CORE = re.compile(r"[0-9A-Za-z+(](?:.*[0-9A-Za-z)])?", re.S)
Span = tuple[int, int, int]  # kind, start, end


# Patterns


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @ outwards, so that long runs are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield 0, start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """All pattern matches by start, then kind; matches that fail a test are dropped."""
    found = list(emails(text)) if "@" in text else []
    if HINT.search(text):
        found += [(1, *m.span()) for m in IP.finditer(text) if all(map(small, m.group().split(".")))]
        for m in CARD.finditer(text):
            digits = digits_of(m.group()) if m.end() - m.start() >= 14 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(digits_of(m.group())) <= 15:
                found.append((3, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])))


# Tokens


@dataclass
class Tokens:
    """The labelled part of one text; label 0 is no entity, 1 + i is KINDS[i]."""

    spans: list[tuple[int, int]]
    labels: list[int]  # what the patterns say
    features: list[list[float]]
    follows: list[bool]  # stands next to the token before
    mentions: list[list[int]]  # the tokens before, last and first of each key, that are the same thing
    equal: list[list[int]]  # those of them that are written with the same letters or digits


def tokens_of(text: str, base: list[Span]) -> Tokens:
    found = Tokens([], [], [], [], [], [])
    cores: list[str] = []
    at = 0
    for m in TOKEN.finditer(text):
        core = CORE.search(m.group())
        if not core:
            continue
        start, end = m.start() + core.start(), m.start() + core.end()
        while at < len(base) and base[at][2] <= start:
            at += 1
        label = next((1 + k for k, a, b in base[at : at + 4] if a < end and b > start), 0)
        number = len(found.spans)
        found.follows.append(number > 0 and start - found.spans[-1][1] <= 2)
        found.spans.append((start, end))
        found.labels.append(label)
        found.features.append(features(core.group(), m.group()))
        cores.append(core.group())
    found.mentions, found.equal = mentions(text, found.spans, cores)
    return found


def runs(text: str, spans: list[tuple[int, int]], cores: list[str]) -> Iterator[tuple[int, int]]:
    """Neighbouring tokens that may be groups of one number, as (first, after the last)."""
    plain = [not any(c.isalpha() or c == "@" for c in core) for core in cores]
    first = 0
    for i in range(1, len(cores) + 1):
        if i < len(cores) and plain[i - 1] and plain[i]:
            a, b = spans[i - 1][1], spans[i][0]
            if b - a <= 3 and BETWEEN.issuperset(text[a:b]):
                continue
        yield first, i
        first = i


def number_keys(cores: list[str]) -> list[set[str]]:
    """For each group of a run: the digits that end and that start with it, and those that end the run."""
    groups = [digits_of(c) for c in cores]
    whole = "".join(groups) if sum(map(len, groups)) <= LONGEST_NUMBER else ""
    keys: list[set[str]] = [set() for _ in groups]
    for order, sign in ((range(len(groups)), "<"), (range(len(groups) - 1, -1, -1), ">")):
        near = ""
        for i in order:
            near = (near + groups[i])[-SHARED_DIGITS:] if sign == "<" else (groups[i] + near)[:SHARED_DIGITS]
            if len(near) == SHARED_DIGITS:
                keys[i].add(sign + near)
    if len(whole) >= SHARED_DIGITS:
        for each in keys:
            each.add("<" + whole[-SHARED_DIGITS:])
    return keys


def mentions(text: str, spans: list[tuple[int, int]], cores: list[str]) -> tuple[list[list[int]], list[list[int]]]:
    """Of each token the earlier ones that share a key: the last and the first of each key; and the equal ones.

    Groups of one number are no mentions of one another, unless they are equal.
    """
    seen: dict[str, tuple[int, int]] = {}
    found: list[list[int]] = []
    equal: list[list[int]] = []

    def met(keys: set[str]) -> set[int]:
        return {i for k in keys if k in seen for i in seen[k]}

    def keep(keys: set[str], i: int) -> None:
        for k in keys:
            seen[k] = (seen[k][0] if k in seen else i, i)

    for first, after in runs(text, spans, cores):
        numbers = number_keys(cores[first:after]) if "@" not in cores[first] else [set()]
        linked = [met(keys) for keys in numbers]
        for i, same in enumerate(linked, first):
            own, start = {content(cores[i])} - {""}, {begins(cores[i])} - {""}
            equal.append(sorted(met(own)))
            found.append(sorted(same | met(own | start)))
            keep(own | start, i)
        for i, keys in enumerate(numbers, first):
            keep(keys, i)
    return found, equal


def content(token: str) -> str:
    """What makes two tokens mentions of one thing; '' if it is too little to tell."""
    if "@" in token:
        return token.lower()
    digits = digits_of(token)
    return digits if len(digits) >= LEAST_DIGITS and 2 * len(digits) >= len(token) else ""


def begins(token: str) -> str:
    """An address up to the first dot after the @: all that is left where it is broken off."""
    local, at, domain = token.lower().partition("@")
    label = domain.partition(".")[0]
    return f"^{local}@{label}" if at and local and label else ""


def features(core: str, whole: str) -> list[float]:
    digits = digits_of(core)
    letters = sum(c.isalpha() for c in core)
    n, dots = len(digits), core.count(".")
    local, _, domain = core.partition("@")
    return [
        1.0, n == 0, n <= 3, 4 <= n <= 6, 7 <= n <= 9, 10 <= n <= 13, 14 <= n <= 19, n > 19,
        14 <= n <= 19 and luhn(digits), letters == 0, letters > n, "@" in core, bool(local and "." in domain),
        dots == 0, dots in (1, 2), dots == 3, dots > 3, dots == 3 and letters == 0 and all(map(small, re.findall("[0-9]+", core))),
        "+" in core, "(" in core or ")" in core, "-" in core, "=" in whole or '"' in whole or "/" in whole, len(core) > 24,
    ]


# The field


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # features × labels
    chain: np.ndarray  # labels × labels, symmetric use: left, right
    skip: np.ndarray


LABELS = 1 + len(KINDS)


def trained(texts: list[str], steps: int = 300) -> Field:
    """Softmax regression on the tokens, smoothed pointwise mutual information on the edges."""
    rows, labels = [], []
    chain, skip = np.ones((LABELS, LABELS)), np.ones((LABELS, LABELS))
    for text in texts:
        if not HINT.search(text):
            continue
        found = tokens_of(text, base_spans(text))
        rows += found.features
        labels += found.labels
        # The patterns miss other forms, so only equal mentions tell how labels go together.
        for i, (near, same) in enumerate(zip(found.follows, found.equal, strict=True)):
            if near:
                chain[found.labels[i - 1], found.labels[i]] += 1
            for mention in same:
                skip[found.labels[mention], found.labels[i]] += 1
    if not rows:
        return Field(np.zeros((0, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    x, y = np.array(rows, float), np.eye(LABELS)[labels]
    weights, pace = np.zeros((x.shape[1], LABELS)), np.zeros((x.shape[1], LABELS))
    for _ in range(steps):
        slope = x.T @ (softmax(x @ weights) - y) / len(x) + 1e-4 * weights
        pace = 0.9 * pace - slope
        weights = weights + pace
    return Field(weights, information(chain), information((skip + skip.T) / 2))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def information(counts: np.ndarray) -> np.ndarray:
    total = counts.sum()
    return np.log(counts * total / np.outer(counts.sum(axis=1), counts.sum(axis=0)))


def marginals(nodes: np.ndarray, left: np.ndarray, right: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Label probabilities by loopy message passing; all documents of a group at once.

    `nodes` are log potentials (tokens × labels), `edges` those of (left, right) pairs.
    """
    pairs = np.exp(edges - edges.max(axis=(1, 2), keepdims=True))
    to_right, to_left = np.zeros((len(left), LABELS)), np.zeros((len(left), LABELS))

    def beliefs() -> np.ndarray:
        total = nodes.copy()
        np.add.at(total, right, to_right)
        np.add.at(total, left, to_left)
        return total

    def message(source: np.ndarray, back: np.ndarray, table: np.ndarray) -> np.ndarray:
        held = source - back
        held = np.exp(held - held.max(axis=1, keepdims=True))
        sent = np.log(np.einsum("ea,eab->eb", held, table) + 1e-300)
        return sent - sent.max(axis=1, keepdims=True)

    for _ in range(ROUNDS if len(left) else 0):
        total = beliefs()
        new_right = message(total[left], to_left, pairs)
        new_left = message(total[right], to_right, pairs.transpose(0, 2, 1))
        change = max(np.abs(new_right - to_right).max(), np.abs(new_left - to_left).max())
        to_right = DAMPING * to_right + (1 - DAMPING) * new_right
        to_left = DAMPING * to_left + (1 - DAMPING) * new_left
        if change < 1e-4:
            break
    return softmax(beliefs())


def added_spans(texts: list[str], bases: list[list[Span]], model: Field) -> list[list[Span]]:
    """What the field finds beyond the patterns in each text."""
    found: list[list[Span]] = [[] for _ in texts]
    if not len(model.weights):
        return found
    parts = [(i, tokens_of(t, b)) for i, (t, b) in enumerate(zip(texts, bases, strict=True)) if b or HINT.search(t)]
    parts = [(i, p) for i, p in parts if p.spans]
    if not parts:
        return found
    nodes = np.array([f for _, p in parts for f in p.features], float) @ model.weights
    known = np.array([label for _, p in parts for label in p.labels])
    # What a pattern has found is evidence.
    sure = known > 0
    nodes[sure] = -50.0
    nodes[sure, known[sure]] = 0.0
    left, right, edges, offset = [], [], [], 0
    for _, p in parts:
        for i, (near, same) in enumerate(zip(p.follows, p.mentions, strict=True)):
            for before, table in ([(i - 1, model.chain)] if near else []) + [(m, model.skip) for m in same]:
                left.append(offset + before)
                right.append(offset + i)
                edges.append(table)
        offset += len(p.spans)
    tables = np.array(edges) if edges else np.zeros((0, LABELS, LABELS))
    chance = marginals(nodes, np.array(left, int), np.array(right, int), tables)
    best = np.where(chance.max(axis=1) >= LEAST_PROBABILITY, chance.argmax(axis=1), 0)
    best[sure] = 0
    offset = 0
    for i, p in parts:
        spans: list[Span] = []
        for (start, end), label in zip(p.spans, best[offset : offset + len(p.spans)].tolist(), strict=True):
            if not label:
                continue
            last = spans[-1] if spans else None
            # Numbers may go over several tokens.
            most = MOST_DIGITS.get(label - 1, 0)
            if last and last[0] == label - 1 and texts[i][last[2] : start] == " " and len(digits_of(texts[i][last[1] : end])) <= most:
                spans[-1] = (last[0], last[1], end)
            else:
                spans.append((label - 1, start, end))
        found[i] = spans
        offset += len(p.spans)
    return found


# Documents


def fitted(docs: DataFrame) -> Field:
    """The field, from the documents whose keys hash lowest."""
    lot = F.xxhash64("doc_id")
    lowest = [r[0] for r in docs.select(lot.alias("lot")).orderBy("lot").limit(SAMPLE_DOCS).collect()]
    if not lowest:
        return trained([])
    chosen = docs.where(lot <= lowest[-1]).limit(SAMPLE_DOCS).select(F.substring(text_of(F.col("text")), 1, SAMPLE_CHARS))
    return trained(sorted(r[0] for r in chosen.collect()))


FOUND = (
    "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, base_sha256: string, spans: string, n_added: bigint>"
)


def _found(texts: pa.Array, model: Field) -> pa.Array:
    names = [part.split(":")[0] for part in FOUND.removeprefix("struct<").removesuffix(">").split(", ")]
    columns: list[list] = [[] for _ in names]
    values = [t or "" for t in texts.to_pylist()]
    for at in range(0, len(values), GROUP_DOCS):
        group = values[at : at + GROUP_DOCS]
        bases = [base_spans(t) for t in group]
        for base, more in zip(bases, added_spans(group, bases, model), strict=True):
            counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            for column, value in zip(columns, (*counts, digest, written(base + more), len(more)), strict=True):
                column.append(value)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def found(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """doc_id, counts of pattern matches, their digest, all spans, and how many were added.

    Offsets are code points, ends exclusive. A null text counts as empty and has no spans.
    Repeated rows stay repeated, an empty table gives no rows, other columns are ignored.
    """
    fitted_model = model or fitted(docs)

    def run(texts: pa.Array) -> pa.Array:
        return _found(texts, fitted_model)

    read = F.arrow_udf(run, FOUND)
    return docs.select("doc_id", read(text_of(F.col("text"))).alias("found")).select("doc_id", "found.*")
