"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight. A source whose share exceeds its size times
the allowed epochs is clamped there, and what it cannot take goes to the others by
weight, again and again until no share is too large. A source's target is then taken
as whole repetitions of all its documents plus one partial repetition: documents in a
seeded order until the rest is used up, the last one cut to fit.

Only sums leave the executors: two numbers a round. The partial repetition needs a
running sum over a source, which may hold a third of all rows; documents are put into
hash buckets, bucket totals are summed first, and only the bucket in which the budget
ends is ordered document by document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.text import GAP, narrow, stored, text_of, whole, with_text, words_of

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
EPOCHS = 2
BUCKET_DIGITS = 3  # hexadecimal digits: 4096 buckets a source


def size_of(text: Column) -> Column:
    return F.size(words_of(text_of(text))).cast("bigint")


def ranked(sources: DataFrame) -> DataFrame:
    """Sources numbered from 0 in code point order, null last.

    Sorted ranges are numbered side by side; one row a range gives the offsets.
    """
    parts = stored(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (
        parts.join(before, F.col("part") == F.col("of_part"))
        .withColumn("place", F.col("before") + F.row_number().over(inside) - 1)
        .drop("part", "of_part", "before")
    )


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, epochs: int = EPOCHS
) -> DataFrame:
    """source, source_size, target for a table (source, size), by water-filling.

    Sources without words have target 0. Weights repeat along the sources' order.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(
        narrow(ranked(summed).select(
            "source", "source_size", weight.cast("double").alias("weight"),
            (F.lit(epochs) * F.col("source_size")).alias("most"),
        )), "weights",
    )
    budget = (sources.agg(F.sum("source_size")).first()[0] or 0) * share_percent / 100
    # Shares only grow from round to round, so a clamped source stays clamped, and
    # "weight * level > most" finds all of them again without marking rows.
    level = 0.0
    clamped = F.lit(False)
    while True:
        free = sources.agg(
            F.sum(F.when(clamped, F.col("most")).otherwise(0)), F.sum(F.when(clamped, 0.0).otherwise(F.col("weight")))
        ).first()
        if not free[1]:
            break
        raised = (budget - free[0]) / free[1]
        if raised <= level:
            break
        level = raised
        clamped = F.col("weight") * level > F.col("most")
    return sources.select(
        "source", "source_size",
        F.when(clamped, F.col("most").cast("double")).otherwise(F.col("weight") * level).alias("target"),
    )


def measured(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """`doc` with its source, size, and its place in the source's seeded order."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc.doc_id").cast("string"), F.lit(""))))
    return whole(docs).select(
        "doc", F.col("doc.source").cast("string").alias("source"), size_of(F.col("doc.text")).alias("size"),
        draw.alias("draw"), F.md5(text_of(F.col("doc.text"))).alias("tie"),
    )


def mixed(
    rows: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, epochs: int = EPOCHS
) -> DataFrame:
    """Rows of `measured` with source_size, target, repeats (whole) and part (words beyond).

    A null text has no words; the null source comes last; rows that repeat an id are
    ordered by their text, and equal rows may stand for each other. The words taken
    from a source add up to its target, rounded down. Order and cut follow from ids,
    texts and the seed alone, so reruns agree. An empty table gives no rows.
    """
    bucket = F.substring("draw", 1, BUCKET_DIGITS)
    by_bucket = stored(narrow(rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))), "buckets")
    goal = targets(by_bucket, weights, share_percent, epochs)
    # An empty source repeats nothing, which is 0 words like everything it could repeat.
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goal.withColumn("repeats", repeats).withColumn(
        "rest", F.floor("target") - F.col("repeats") * F.col("source_size")
    ).withColumnRenamed("source", "goal_source")
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bucket.select("source", "bucket", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    reached = F.col("before") < F.col("rest")
    goal = stored(
        narrow(goal.join(starts, F.col("source").eqNullSafe(F.col("goal_source"))).groupBy(
            "goal_source", "source_size", "target", "repeats", "rest"
        ).agg(F.max(F.when(reached, F.col("bucket"))).alias("edge"), F.max(F.when(reached, F.col("before"))).alias("before"))),
        "goals",
    )
    placed = rows.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).withColumn("bucket", bucket)
    at_edge = F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    inside = Window.partitionBy("source").orderBy("draw", "tie").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    outside = F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0))
    both = placed.where(~at_edge).withColumn("part", outside).unionByName(placed.where(at_edge).withColumn("part", cut))
    return both.select("doc", "source", "size", "source_size", "target", "repeats", "part")


def repeated(rows: DataFrame) -> DataFrame:
    """The mix itself, in the columns of the documents: one row a repetition.

    A document's partial repetition holds its first `part` words, up to the gap that
    follows them; the rest of the text is not in it.
    """
    columns = [f.name for f in rows.schema["doc"].dataType.fields]
    times = F.when(F.col("repeats") > 0, F.array_repeat(F.lit(-1).cast("bigint"), F.col("repeats").cast("int"))).otherwise(
        F.array().cast("array<bigint>")
    )
    pieces = F.concat(times, F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")))
    # Cut where a word ends: every part is a word and the gap before it.
    parts = F.split("doc.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    head = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.col("words"), F.lit(0)).cast("int")), "")
    cut = (F.col("words") >= 0) & (F.col("words") < F.col("size"))
    text = F.when(cut, head).otherwise(F.col("doc.text"))
    return rows.withColumn("words", F.explode(pieces)).select(*with_text(columns, text))
