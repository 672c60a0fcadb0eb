"""Row-by-row upserts expressed as one aggregation and two joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(
    incoming: DataFrame, key: Sequence[str], updates: Sequence[str], order: str = "load_seq"
) -> DataFrame:
    """One row per key: update columns from the last row, the others from the first.

    `min_by` / `max_by` over structs keep NULLs (the struct itself is never NULL)
    and aggregate map-side, so a key repeated in a third of the rows reaches the
    shuffle as one row per task.
    """
    frozen = [c for c in incoming.columns if c not in (*key, *updates, order)]
    picks = []
    if frozen:
        picks.append(F.min_by(F.struct(*frozen), order).alias("__first"))
    if updates:
        picks.append(F.max_by(F.struct(*updates), order).alias("__last"))
    folded = incoming.groupBy(*key).agg(*picks) if picks else incoming.select(*key).distinct()
    return folded.select(
        *key,
        *[F.col(f"__first.{c}") for c in frozen],
        *[F.col(f"__last.{c}") for c in updates],
    ).select(*[c for c in incoming.columns if c != order])


def apply_to(
    target: DataFrame, folded: DataFrame, key: Sequence[str], updates: Sequence[str]
) -> DataFrame:
    """Merge folded rows into a table that already has one row per key.

    Whether a key arrived decides, not whether its value is NULL, so an update to
    NULL is kept. The two joins have the batch on the broadcastable side: a small
    batch is merged without shuffling the table, a large one falls back to a
    shuffle join by size.
    """
    key = list(key)
    matched = target.select(*key).join(folded.select(*key), key, "left_semi")
    fresh = folded.join(matched, key, "left_anti")
    if updates:
        changes = folded.select(*key, F.struct(*updates).alias("__new"))
        kept = target.join(changes, key, "left").select(
            *[
                F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
                if c in updates
                else F.col(c)
                for c in target.columns
            ]
        )
    else:
        kept = target
    return kept.unionByName(fresh.select(*target.columns))


def fold_upsert(
    incoming: DataFrame,
    key: Sequence[str],
    updates: Sequence[str],
    target: DataFrame | None = None,
    order: str = "load_seq",
) -> DataFrame:
    folded = fold(incoming, key, updates, order)
    return folded if target is None else apply_to(target, folded, key, updates)
