from __future__ import annotations

import random
import struct
import tracemalloc
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import bpe_trie, shared_files, token_shards
from tallyhouse.llm.queries import tokenizer

ODD = "aAbBeEtThHİßǅéÉ́̀ 012³½٣'’stremd.,!?-_/\\<|>  \t\n\x0b\x1c\x85\xa0日本語한국어🙂👨‍👩‍👧中ΣςσﬁÅΩ\x01×÷"


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(tokenizer())
    found.no_truncation()
    found.no_padding()
    return found


def texts(prose):
    rng = random.Random(2)
    made = ["", " \n", "a", "<|endoftext|>", "x<|startoftext|>y Z", "<|ENDOFTEXT|>", "we'll don't I'M 'sx", "...!!! a.b,c", "1234567"]
    made += ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    made += ["".join(rng.choice("aethinrosb") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    return made + [c * n for c in "ae" for n in (2, 3, 7, 50)] + [prose(s, 300, 4).title() for s in range(5)]


@pytest.mark.parametrize("trie", [True, False])
def test_ids_equal_the_library(library, prose, trie, monkeypatch):
    monkeypatch.setattr(bpe_trie, "GROUP_BYTES", 300)
    encoder = bpe_trie.Encoder(tokenizer(), trie)
    encoder.most = 150  # generations change all the time
    for text, packed in zip(texts(prose), encoder.batch([t.encode() for t in texts(prose)]), strict=True):
        assert list(memoryview(packed).cast("I")) == library.encode(text, add_special_tokens=False).ids, text


def test_encoded_and_decoded(spark, docs, odd, library, prose):
    table = docs(*texts(prose))
    rows = {r.doc_id: r for r in bpe_trie.encoded(table, tokenizer()).collect()}
    for i, text in enumerate(texts(prose)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids) and rows[i].decoded == library.decode(ids, skip_special_tokens=False)
    again = bpe_trie.encoded(table, tokenizer()).select("doc_id", bpe_trie.decoding(tokenizer())("ids").alias("text")).collect()
    assert all(r.text == rows[r.doc_id].decoded for r in again)
    found = bpe_trie.encoded(odd, tokenizer()).collect()
    assert len(found) == odd.count() and next(r for r in found if r.doc_id is None).decoded == ""
    assert bpe_trie.encoded(odd.limit(0), tokenizer()).count() == 0


def test_shards_round_trip(docs, library, prose):
    made = texts(prose)
    table = docs(*[(3 * (len(made) - i), t, "en", "s") for i, t in enumerate(made)])
    shards = token_shards.write(table, tokenizer())
    rows = sorted(token_shards.read(shards).select("*", F.crc32("ids").alias("crc")).collect())
    start = 0
    for row, text in zip(rows, reversed(made), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert (row.start, row.n_tokens, bytes(row.ids), row.crc) == (start, len(ids), packed, zlib.crc32(packed))
        start += len(ids)
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_one_document_of_a_shard(docs, prose):
    shard = token_shards.write(docs(*[prose(s, 50) for s in range(40)]), tokenizer()).first()
    with shared_files.reading(shard.path) as data:
        dictionary = token_shards.dictionary_of(shard.path, data)
        found = token_shards.Shard(data, dictionary)
        entry = found.entries(found.docs - 1, 1)[0]
        assert len(found.ids(entry)) == 4 * entry[4]
        with pytest.raises(ValueError, match="another dictionary"):
            token_shards.Shard(data, dictionary + b"x")


def test_shards_of_odd_rows(odd):
    rows = token_shards.read(token_shards.write(odd, tokenizer())).collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [1, 2, 3, 3, 3, 4, 5, None]
    assert token_shards.read(token_shards.write(odd.limit(0), tokenizer())).count() == 0


def test_a_walk_does_not_hold_all_words_of_a_batch():
    rng = random.Random(3)
    vocabulary = bpe_trie.Vocabulary(tokenizer())
    words = {"".join(rng.choice("aethinrosb") for _ in range(9)).encode() for _ in range(40_000)}
    tracemalloc.start()
    found = vocabulary.encode(words)
    left, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found.keys() == words and most - left < 25e6


def test_a_worker_keeps_no_chunks_after_its_task(spark, docs, prose):
    def cached(numbers: pa.Array) -> pa.Array:
        found = [len(e.chunks) + len(e.older) for (_, trie), e in bpe_trie._loaded.items() if trie]
        return pa.array([max(found, default=-1)] * len(numbers), pa.int64())

    rows = bpe_trie.encoded(docs(*[prose(s, 300, 4) for s in range(8)]).repartition(4), tokenizer()).collect()
    assert len(rows) == 8
    seen = {r.n for r in spark.range(64).select(F.arrow_udf(cached, "bigint")("id").alias("n")).collect()}
    assert 0 in seen and max(seen) == 0
