"""Staging rows: target columns as strings, load position, row counts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.text import blank_to_null
from tallyhouse.schemas import STAGING, STAGING_REQUIRED, staging_columns

GROUP = ("seq_source", "seq_part", "seq_block")
# What a refused row keeps besides its place: staging column and the reader's column.
REFUSED = {"reject_reason": "reject_reason", "raw_text": "raw_text", "source_file": "__path"}


def reject_reason(table: str) -> Column:
    """Why a staging row is refused: a required column is NULL or a text too long."""
    rules = [(F.col(c).isNull(), f"{c} is missing") for c in STAGING_REQUIRED[table]]
    rules += [
        (F.length(F.col(c).cast("string")) > width, f"{c} is longer than {width}")
        for c, width in STAGING[table].items()
        if width
    ]
    chain = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), rules, F)
    return chain.otherwise(F.lit(None).cast("string"))


def staged(rows: DataFrame, table: str, batch_id: int, now: datetime) -> DataFrame:
    """Rows in staging shape; '' becomes NULL and columns the source lacks are NULL.

    Records the reader has refused keep its reason and their text.
    """
    present = set(rows.columns)

    def value(column: str) -> Column:
        if column == "product_id":
            return F.col(column).try_cast("int") if column in present else F.lit(None).cast("int")
        return blank_to_null(column) if column in present else F.lit(None).cast("string")

    def given(column: str) -> Column:
        return F.col(column) if column in present else F.lit(None).cast("string")

    shaped = rows.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        *[value(c).alias(c) for c in staging_columns(table)],
        F.lit(now).cast("timestamp").alias("loaded_at"),
        *[c for c in (*GROUP, "seq_row") if c in present],
        *[given(c).alias(name) for name, c in REFUSED.items()],
    )
    for column in GROUP[:1]:
        if column not in present:
            shaped = shaped.withColumn(column, F.lit(0))
    return shaped.withColumn("reject_reason", F.coalesce("reject_reason", reject_reason(table)))


def with_load_seq(rows: DataFrame) -> DataFrame:
    """Replace the position columns by `load_seq`, a unique bigint in load order.

    Rows of one split already carry a growing counter, so only the start of each
    split has to be found: a running sum over one row per split. The rows
    themselves are neither shuffled nor sorted.
    """
    low, high = F.min("seq_row"), F.max("seq_row")
    spans = rows.groupBy(*GROUP).agg(low.alias("__low"), (high - low + 1).alias("__span"))
    earlier = Window.orderBy(*GROUP).rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(
        *GROUP, "__low", F.coalesce(F.sum("__span").over(earlier), F.lit(0)).alias("__start")
    )
    return (
        rows.join(starts, list(GROUP))
        .withColumn("load_seq", F.col("__start") + F.col("seq_row") - F.col("__low") + 1)
        .drop(*GROUP, "seq_row", "__low", "__start")
    )


def batch_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per staging table, 0 for an empty one, in the order given."""
    counts = [
        rows.agg(F.count("*").alias("rows_cnt")).select(
            F.lit(i).alias("place"), F.lit(name).alias("table_name"), "rows_cnt"
        )
        for i, (name, rows) in enumerate(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts)


def batch_note(counts: DataFrame) -> DataFrame:
    """The counts as one line: 'table=n, table=n'."""
    entry = F.concat(F.col("table_name"), F.lit("="), F.col("rows_cnt").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("place", entry.alias("entry"))))
    return counts.agg(
        F.array_join(F.transform(ordered, lambda e: e["entry"]), ", ").alias("note")
    )
