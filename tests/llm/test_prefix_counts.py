from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_tokens import ODD

from tallyhouse.llm import prefix_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["recommendations", "addEventListener", "....", "    ", "\n\n", "<s>", "</s>", "<unk>", "<0x0A>", " the", "Illegal", "====", "▁▁", "12", "\x00"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(prose) -> list[str]:
    rng = random.Random(4)
    made = ["", " ", "a", "▁", "\n", "é", "日本", " \t "]
    made += ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    made += ["".join(rng.choice("aethinrosb ") for _ in range(rng.randint(1, 90))) for _ in range(150)]
    made += ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    return made + [c * n for c in "a .=" for n in (2, 3, 7, 50, 130)] + [prose(s, 60, 3).title() for s in range(4)]


@pytest.mark.parametrize("kept", [1 << 20, 3])
def test_every_prefix_counts_as_in_the_library(library, prose, kept, monkeypatch):
    monkeypatch.setattr(prefix_counts, "CACHED_SEGMENTS", kept)
    monkeypatch.setattr(prefix_counts, "CACHED_PAIRS", 50 * kept)
    counter = prefix_counts.PrefixCounter(PATH)
    for text in texts(prose):
        found = prefix_counts.counts(counter.steps(text)).tolist()
        assert found == [len(ids) for ids in library.encode([text[:i] for i in range(len(text) + 1)])], text


def test_budgets(spark, docs, library, prose):
    made = texts(prose)
    prefixes = prefix_counts.prefixed(docs(*made), PATH)
    for limit in (0, 1, 20):
        for r in prefix_counts.truncated(prefixes, limit).collect():
            text = made[r.doc.doc_id]
            counts = [len(ids) for ids in library.encode([text[:i] for i in range(len(text) + 1)])]
            longest = max(i for i, n in enumerate(counts) if n <= limit)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), counts[-1], counts[-1] > limit)
            assert (r.fit_chars, r.kept) == (longest, text[:longest])
    asked = prefixes.select("doc", prefix_counts.tokens_at(F.col("steps"), F.col("doc.doc_id") % 30).alias("n"))
    for r in asked.collect():
        assert r.n == len(library.encode(made[r.doc.doc_id][: r.doc.doc_id % 30]))


def test_long_text_without_blanks(library):
    rng, counter = random.Random(6), prefix_counts.PrefixCounter(PATH)
    for letters in ("aethinrosb", "ab", "日本語한"):
        text = "".join(rng.choice(letters) for _ in range(20_000))
        counts = prefix_counts.counts(counter.steps(text))
        for i in (1, 39, 40, 41, 777, 19_999, 20_000):
            assert counts[i] == len(library.encode(text[:i]))


def test_odd_rows(odd, library):
    rows = prefix_counts.budgeted(prefix_counts.prefixed(odd, PATH), 4096).collect()
    assert len(rows) == odd.count() and rows[0].doc.asDict().keys() == set(odd.columns)
    for r in rows:
        text = r.doc.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text)))
    assert prefix_counts.truncated(prefix_counts.prefixed(odd.limit(0), PATH), 5).count() == 0


def test_other_files_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="changes characters"):
        prefix_counts.PrefixCounter(str(tmp_path / "m.model"))
