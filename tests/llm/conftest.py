from __future__ import annotations

import random

import pytest

from tallyhouse.llm.queries import prepare

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture
def docs(spark):
    """docs(text, …) or docs((doc_id, text, lang, source), …) → DataFrame of documents"""

    def make(*values):
        rows = [v if isinstance(v, tuple) else (i, v, "en", "s0") for i, v in enumerate(values)]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)

    return make


@pytest.fixture
def odd(spark):
    """Null in every column, empty and long texts, repeated rows, an extra column whose name clashes."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    rows = [
        (None, None, None, None, None, "a"), (1, "", "en", "s", 0, None), (2, " \n\t", "en", "s", 3, "b"),
        (3, "one two three", "en", "s", 13, "b"), (3, "one two three", "en", "s", 13, "b"), (3, "one two four", None, "t", 12, "c"),
        (4, long, "en", "s", len(long), "d"), (5, "über Straße 日本 ½ ❤ á", "de", None, 9, "e"),
    ]
    return spark.createDataFrame(rows, DOCS + ", kept string").withColumnRenamed("kept", "size")


@pytest.fixture
def prose():
    """prose(seed, words) → sentences of an invented language"""

    def make(seed: int, words: int, lines: int = 1) -> str:
        rng = random.Random(seed)
        vocabulary = ["the", "of", "and", "to", "in"] * 8 + [
            "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(120)
        ]
        text = [rng.choice(vocabulary) for _ in range(words)]
        cut = max(1, words // lines)
        return "\n".join(" ".join(text[i : i + cut]) + "." for i in range(0, words, cut))

    return make
