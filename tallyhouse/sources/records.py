"""Records of delimited files whose quoted values span lines, without reading a file in one piece.

Whether a line begins inside a quoted value depends on all lines before it. But a line, and
likewise a whole block of them, can only do one of four things to that state: keep it, turn
it, end outside or end inside, however it began. Such steps compose associatively. So each
block of a file says how it ends for each way it may begin, one row a block is composed in
file order, and then every line knows how it begins. Lines of one record are put together,
also across blocks; all other lines stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
PLACE = ("__path", "__block", "__row")


def line_ends(line: Column, delimiter: str) -> Column:
    """Struct (outside, inside): whether a line that begins that way ends inside a quoted value.

    A quote opens a value at the start of a field only. Inside, two quotes in a row are one
    character, a single one closes. The line is taken quote by quote; `pending` is a quote
    seen inside a value, which closes unless another follows at once.
    """
    parts = F.split(line, QUOTE, -1)
    out, within, pending = F.lit(0), F.lit(1), F.lit(2)

    def after_quote(state: Column, tail: Column, opens: Column) -> Column:
        return (
            F.when(state == 0, F.when(opens, within).otherwise(out))
            .when(state == 1, pending)
            .otherwise(F.when((tail == "") | F.endswith(tail, F.lit(delimiter)), within).otherwise(out))
        )

    def step(acc: Column, part: Column) -> Column:
        tail = acc["tail"]
        new_field = F.endswith(tail, F.lit(delimiter))
        return F.struct(
            after_quote(acc["outside"], tail, new_field | (acc["first"] & (tail == ""))).alias("outside"),
            after_quote(acc["inside"], tail, new_field).alias("inside"),
            part.alias("tail"),
            F.lit(False).alias("first"),
        )

    start = F.struct(out.alias("outside"), within.alias("inside"), parts[0].alias("tail"), F.lit(True).alias("first"))
    end = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step)
    plain = F.struct(F.lit(False).alias("outside"), F.lit(True).alias("inside"))
    quoted = F.transform(
        F.array(end), lambda e: F.struct((e["outside"] == 1).alias("outside"), (e["inside"] == 1).alias("inside"))
    )[0]
    return F.when(F.contains(line, F.lit(QUOTE)), quoted).otherwise(plain)


def with_beginnings(rows: DataFrame, group: tuple[str, ...], order: str) -> DataFrame:
    """Add begins0 and begins1: whether a row begins inside if its group begins outside, or inside.

    Rows carry `ends` as `line_ends` gives it. The last row that ends one way however it begins
    decides, and how often the state was turned since.
    """
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    fixed, turns = F.col("ends.outside") == F.col("ends.inside"), F.col("ends.outside") & ~F.col("ends.inside")
    rows = rows.withColumn("__turned", F.coalesce(F.sum(turns.cast("int")).over(earlier), F.lit(0)))
    known = F.when(fixed, F.struct(F.col("ends.outside").alias("state"), F.col("__turned").alias("at")))
    rows = rows.withColumn("__known", F.last(known, ignorenulls=True).over(earlier))
    since = F.col("__turned") - F.coalesce(F.col("__known.at"), F.lit(0))
    odd = since % 2 == 1
    for column, begun in (("begins0", False), ("begins1", True)):
        rows = rows.withColumn(column, F.coalesce(F.col("__known.state"), F.lit(begun)) != odd)
    return rows.drop("__turned", "__known")


def _after(begins: str) -> Column:
    return F.when(F.col(begins), F.col("ends.inside")).otherwise(F.col("ends.outside"))


def blocks_of(lines: DataFrame) -> DataFrame:
    """One row a block: whether it begins inside, the last record begun before it, the file's first line of text."""
    text = F.trim(F.regexp_replace("line", "\r$", "")) != ""
    ended = lines.groupBy("__path", "__block").agg(
        F.max_by(F.struct(_after("begins0").alias("outside"), _after("begins1").alias("inside")), "__row").alias("ends"),
        F.max(F.when(~F.col("begins0"), F.col("__row"))).alias("last0"),
        F.max(F.when(~F.col("begins1"), F.col("__row"))).alias("last1"),
        F.min(F.when(text, F.col("__row"))).alias("first_text"),
    )
    # Files begin outside.
    placed = with_beginnings(ended, ("__path",), "__block").withColumn("begins", F.col("begins0"))
    last = F.when(F.col("begins"), F.col("last1")).otherwise(F.col("last0"))
    begun = F.when(last.isNotNull(), F.struct("__block", last.alias("__row")))
    in_order = Window.partitionBy("__path").orderBy("__block")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    first = F.when(F.col("first_text").isNotNull(), F.struct("__block", F.col("first_text").alias("__row")))
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return placed.select(
        "__path", "__block", "begins",
        F.last(begun, ignorenulls=True).over(earlier).alias("begun"),
        F.first(first, ignorenulls=True).over(whole).alias("header"),
    )


def read_records(spark: SparkSession, paths: list[str], delimiter: str, text: Column) -> DataFrame:
    """path, block and row of each record's first line, and `record`, headers and blank lines left out.

    `text` is the decoded `value` of a line. Line ends inside a record are kept as they are.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        text.alias("line"), F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__row"),
    )
    # A block is a split of the file, so no window holds more than one task reads.
    lines = with_beginnings(lines.withColumn("ends", line_ends(F.col("line"), delimiter)), ("__path", "__block"), "__row")
    blocks = blocks_of(lines).select(
        F.col("__path").alias("of_path"), F.col("__block").alias("of_block"), "begins", "begun", "header"
    )
    joined = lines.join(blocks, (F.col("__path") == F.col("of_path")) & (F.col("__block") == F.col("of_block")))
    begins = F.when(F.col("begins"), F.col("begins1")).otherwise(F.col("begins0"))
    here = F.struct("__block", "__row")
    so_far = Window.partitionBy("__path", "__block").orderBy("__row").rowsBetween(Window.unboundedPreceding, 0)
    placed = joined.withColumn("inside", begins).select(
        "line", *PLACE, "inside", "header",
        F.when(F.col("inside"), F.col("ends.inside")).otherwise(F.col("ends.outside")).alias("open"),
        F.coalesce(F.last(F.when(~F.col("inside"), here), ignorenulls=True).over(so_far), F.col("begun")).alias("of"),
    )
    single = placed.where("not inside and not open").select(*PLACE, "header", F.col("line").alias("record"))
    several = placed.where("inside or open").groupBy("__path", "of").agg(
        F.first("header").alias("header"), F.array_sort(F.collect_list(F.struct("__block", "__row", "line"))).alias("lines")
    )
    several = several.select(
        "__path", "of.__block", "of.__row", "header",
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"),
    )
    records = single.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return records.where((F.trim("record") != "") & ~F.struct("__block", "__row").eqNullSafe(F.col("header"))).drop("header")
