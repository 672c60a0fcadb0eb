"""The registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    bpe_trie, jaccard_join, line_templates, mixing, periodic_runs, phrases, pii, prefix_counts, quality, shared_files, token_shards, va_file,
    warc, wrappers,
)
from tallyhouse.llm.oracles import ORACLES
from tallyhouse.llm.text import let, stored, text_of, words_of


# Rows sent to a Python worker at once: texts can be long.
BATCH_ROWS = "1024"


def prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    shared_files.ship_package(spark)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/pages.parquet")


def tokenizer() -> str:
    """The public vocabulary file; it is part of the installation, not of this repository."""
    return public_tokenizers.path("word_bpe_49k.json")


def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.classed(documents(spark, folder), jaccard_join.Rule(width=3, percent=90))


def op2_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    found = line_templates.cleaned(documents(spark, folder))
    return found.select("doc.doc_id", "n_lines", "n_dropped", "text")


def op3_skip_chain_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.found(documents(spark, folder))


def op4_seekable_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read(warc.write(pages(spark, folder)))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = token_shards.write(documents(spark, folder), tokenizer(), end_id=1)
    return token_shards.read(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe_trie.encoded(documents(spark, folder).select("doc_id", "text"), tokenizer())
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op7_host_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_texts(pages(spark, folder))


def op8_phrase_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.compared(documents(spark, folder))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.measured(documents(spark, folder)).withColumn("doc", F.struct("doc.doc_id"))
    mix = mixing.mixed(stored(rows, "sizes"))
    taken = F.col("repeats") * F.col("size") + F.col("part")
    return mix.select("doc.doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"), "source")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(documents(spark, folder))
    rounded = [F.round(c, 6).alias(c) for c in ("class_distance", "word_distance")]
    return found.select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *rounded
    )


def op11_va_file(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    rows = va_file.integers(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id", "embedding", width=64, scale=256)
    found = va_file.with_totals(va_file.clustered(rows, width=64, k=40, rounds=5, seed="2:"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents repeats its words from some word on with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i)
        moved = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i)))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    text = text_of(F.col("text"))
    return docs.select("doc_id", F.when(h % 10 == 0, let(words_of(text), repeated)).otherwise(text).alias("text"))


def op12_square_catching(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.found(with_periods(documents(spark, folder)), least=12)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    # The longest run; of equals the first, then that of the smallest period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))["run"]
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.select("doc.doc_id", "runs", "collapsed", longest.alias("run"), lines.alias("lines"))
    exponent = F.floor(F.col("run.length") * 1000 / F.col("run.period")).alias("exponent_milli")
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{n}_sha256") for c, n in (("lines", "runs"), ("collapsed", "collapsed"))]
    return rows.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "run.start", "run.length", "run.period", exponent, *digests)


def op13_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    prefixes = prefix_counts.prefixed(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))
    return prefix_counts.budgeted(prefixes, limit=4096).select("doc.doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_jaccard_join, op2_line_templates, op3_skip_chain_pii, op4_seekable_warc, op5_token_shards, op6_trie_bpe, op7_host_wrappers, op8_phrase_fingerprints, op9_source_mixing, op10_quality_rules, op11_va_file, op12_square_catching, op13_prefix_counts)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
