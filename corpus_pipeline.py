"""From raw documents to token ids: the stages of a training corpus, in order.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of the documents. A runner writes each result and reads it as the next
stage's documents, as `run` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import bpe_trie, jaccard_join, line_templates, mixing, quality
from tallyhouse.llm.queries import documents, prepare, tokenizer
from tallyhouse.llm.text import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first."""
    return line_templates.without_recurring(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    prepare(spark)
    return jaccard_join.representatives(docs, jaccard_join.Rule(width=5, percent=80))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, whole and in part, so that the sources reach their targets."""
    return mixing.repeated(mixing.mixed(mixing.measured(docs)))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, packed, and the text that they decode to."""
    prepare(spark)
    return bpe_trie.encoded(docs.select("doc_id", "lang", "source", "text"), tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

# Shingle joins and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, last = STAGES[-1]
    return last(spark, docs, sf_dir)
