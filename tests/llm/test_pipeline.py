from __future__ import annotations

import random
import re
import time
from pathlib import Path

import brute
import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from tallyhouse.llm.components import components
from tallyhouse.llm.queries import tokenizer
from tallyhouse.llm.text import CLEANUP, narrow, stored


def corpus(prose) -> list[dict]:
    rng, texts = random.Random(3), [prose(s, 70 + s % 90, 4) for s in range(50)]
    for i in range(0, 24, 3):  # copies and near copies
        words = texts[i].split(" ")
        texts.append(texts[i])
        words[rng.randrange(len(words))] = "altered"
        texts.append(" ".join(words))
    texts = [t + ("\nSubscribe to our letter number 7 today" if i % 2 else "") for i, t in enumerate(texts)]
    texts += ["too short", "word " * 100, re.sub(r"(\S+)", r"\1***", prose(99, 150))]
    return [{"doc_id": i, "text": t, "lang": "en", "source": f"s{i % 4}", "n_chars": len(t)} for i, t in enumerate(texts)]


def expected(docs: list[dict]) -> list[tuple]:
    kept = {r["doc_id"] for r in brute.sql("op10_quality_rules", docs) if r["kept"]}
    docs = [d for d in docs if d["doc_id"] in kept]
    cut = {r["doc_id"]: r for r in brute.sql("op2_line_templates", docs)}
    docs = [d | {"text": cut[d["doc_id"]]["text"]} for d in docs]
    docs = [d for d in docs if not cut[d["doc_id"]]["n_dropped"] or brute.WORD.search(d["text"])]
    group = brute.components([d["text"] for d in docs], 5, 80)
    docs = [d for i, d in enumerate(docs) if group[i] == i]
    taken = {r["doc_id"]: r for r in brute.sql("op9_source_mixing", docs)}
    library, rows = Tokenizer.from_file(tokenizer()), []
    for d in docs:
        repeats, part = divmod(taken[d["doc_id"]]["taken"], taken[d["doc_id"]]["size"])
        texts = [d["text"]] * repeats
        if part:
            texts.append(re.match(r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){%d}" % part, d["text"])[0])
        for text in texts:
            ids = library.encode(text, add_special_tokens=False).ids
            rows.append((d["doc_id"], d["source"], ids, library.decode(ids, skip_special_tokens=False)))
    return sorted(rows)


def test_pipeline_equals_brute_force(spark, prose, tmp_path):
    docs = corpus(prose)
    pq.write_table(pa.Table.from_pylist(docs, schema=pa.schema(brute.DOCUMENT)), tmp_path / "documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    rows = sorted((r.doc_id, r.source, list(memoryview(bytes(r.ids)).cast("I")), r.decoded) for r in found)
    assert rows == expected(docs) and len({r[0] for r in rows}) < len(docs)


def test_stages_of_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            result = stage(spark, docs, "")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert result.columns == docs.columns
            assert docs is odd or result.count() == 0
            result.count()


def test_registered(spark):
    import __spark_entry__ as contract

    names = [q for q in contract.queries() if re.match(r"op\d+_|pipeline$", q)]
    assert len(names) == 14 and set(contract.oracle_sql()) & set(names) == {f for f in names if f.split("_")[0] in ("op1", "op2", "op4", "op9", "op10", "op11", "op12")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    def files() -> set[str]:
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {str(p) for d in folders for p in Path(d.getPath()).rglob("shuffle_*.data")}

    before, setting = files(), spark.conf.get(CLEANUP, None)
    stored(spark.range(1000).repartition(4).groupBy("id").count(), "step")
    for _ in range(40):  # files are removed aside
        if not (left := files() - before):
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(CLEANUP, None) == setting


def test_narrow_rows_are_stored_in_few_files(spark):
    settings = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = stored(narrow(spark.range(5000).groupBy("id").count()), "narrow")
        pairs = components(spark.range(1, 2000).selectExpr("id as a", "id - id % 100 as b"))
        assert pairs.count() == 2000 and pairs.select("root").distinct().count() == 20
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    most = 4 * spark.sparkContext.defaultParallelism
    assert kept.count() == 5000
    assert len(kept.inputFiles()) <= most < 211 and len(pairs.inputFiles()) <= most
