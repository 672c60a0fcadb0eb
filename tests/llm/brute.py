"""Plain versions of what the operators compute."""

from __future__ import annotations

import html
import re
from collections import defaultdict

import duckdb
import pyarrow as pa

from tallyhouse.llm.oracles import ORACLES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENT = [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(texts: list[str | None], width: int, percent: int) -> list[int]:
    """For each text the place of the first text that links reach."""
    sets = [shingles(t, width) for t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def sql(query: str, docs: list[dict]) -> list[dict]:
    """A registered query's SQL over given documents."""
    db = duckdb.connect()
    db.register("documents", pa.Table.from_pylist(docs, schema=pa.schema(DOCUMENT)))
    return db.execute(ORACLES[query]).to_arrow_table().to_pylist()


def article(page: str) -> str:
    """The text of well-formed pages with one article element and nothing else inside it."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    body = re.sub(r"</?(b|i|a|em|span)\b[^>]*>", "", body)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def grouped(rows: list[dict], key: str) -> dict:
    found = defaultdict(list)
    for r in rows:
        found[r[key]].append(r)
    return found
