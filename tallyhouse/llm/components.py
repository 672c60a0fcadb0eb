"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import narrow, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the component's least node.

    Both steps only take minima, which combine before the shuffle, and join them back
    with links, where a node with very many links is split. A round at least halves the
    distances to the roots. Only a count and a checksum reach the driver.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, mark = stored(narrow(pairs), "links"), None
    while True:
        pairs = stored(narrow(_small_star(_large_star(pairs))), "links")
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its least neighbour or itself."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, F.col("u") == F.col("of"))
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    smaller = pairs.join(least.withColumnRenamed("u", "of"), F.col("u") == F.col("of")).where("v <> m")
    return smaller.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v")).distinct()
