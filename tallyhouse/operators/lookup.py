"""Row-preserving lookups that survive a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, key: Column, table: DataFrame, table_key: str) -> DataFrame:
    """Left join of `rows` to a table with one row per `table_key`; the key is dropped.

    One key may own a third of `rows`. AQE then cuts its partition into pieces, but
    only where both inputs of the join are shuffled for it. A table that arrives
    grouped by its key would be joined in place, so the key is rebuilt on both
    sides. Rows without a key could match nothing and get distinct keys instead,
    which keeps them from meeting in one task. A small table is broadcast by size.
    """
    targets = table.withColumn("__target", F.concat(F.lit("="), F.col(table_key))).drop(table_key)
    wanted = F.concat(F.lit("="), key)
    if "load_seq" in rows.columns:
        wanted = F.coalesce(wanted, F.concat(F.lit("~"), F.col("load_seq").cast("string")))
    return rows.join(targets, wanted == F.col("__target"), "left").drop("__target")
