"""Expressions and small helpers the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import scratch_root

# What separates words: the ASCII space and the control characters HT, LF, VT, FF, CR.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
FILES_A_CORE = 4
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share."""
    return f"{scratch_root(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """`rows` written once to the shared folder and read back.

    This cuts the lineage: a lost executor costs the tasks it ran, not the stages
    before, and what reads the result twice does not compute it twice. Nothing reads the
    shuffles again, so their files go as soon as the rows are written.
    """
    spark = rows.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(path)


def narrow(rows: DataFrame) -> DataFrame:
    """`rows` of a few numbers, to be stored in few files: a task writes several partitions into one.

    On a local disk a file costs two processes (`chmod` of the file and of its checksum),
    started out of the executor, which for a moment seems to take its memory twice.
    """
    return rows.coalesce(FILES_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def whole(docs: DataFrame) -> DataFrame:
    """`docs` as one struct column `doc`, so that no column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """`rows` with each column, in turn, worked out once a row, also where several read it or rows are filtered by it.

    Columns without a function of elements run as compiled code; inside `let`, or beside
    such a function, they would be interpreted.
    """
    for name, value in columns.items():
        rows = rows.withColumn(name, F.explode(F.array(value)))
    return rows


def text_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def row_of(doc_id: str, text: str) -> Column:
    """A name for a row: rows with the same id and text share it."""
    return F.xxhash64(F.col(doc_id), text_of(F.col(text)))


def with_text(columns: list[str], text: Column) -> list[Column]:
    """The columns of `doc` with another text, and its length where they hold that."""
    changed = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return [changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns]
