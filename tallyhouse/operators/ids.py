"""Surrogate ids in load order, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows whose order value shares everything above the low 20 bits form one block,
# so a block never holds more than 2**20 rows whatever the data looks like.
BLOCK_BITS = 20


def surrogate_ids(
    rows: DataFrame, id_column: str, order: str = "load_seq", after: int = 0
) -> DataFrame:
    """Number `rows` after+1, after+2, … by `order`, a unique non-negative bigint.

    The rank is (rows in earlier blocks) + (rank inside the block). Blocks follow
    from the stored order value and not from task placement, so a recomputed task
    numbers its rows the same way. The only global step is a running sum over one
    row per block: one row per million input rows.
    """
    tagged = rows.withColumn("__block", F.shiftright(F.col(order), BLOCK_BITS))
    earlier = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("__block")
        .agg(F.count("*").alias("__size"))
        .select("__block", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    )
    inside = Window.partitionBy("__block").orderBy(order)
    return (
        tagged.withColumn("__rank", F.row_number().over(inside))
        .join(offsets, "__block")
        .withColumn(id_column, F.lit(after) + F.col("__before") + F.col("__rank"))
        .drop("__block", "__before", "__rank")
    )


def highest_id(table: DataFrame | None, id_column: str) -> int:
    """The greatest id in use, 0 for an empty or missing table (one scalar)."""
    if table is None:
        return 0
    return table.agg(F.max(id_column)).first()[0] or 0
