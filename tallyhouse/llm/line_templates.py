"""Line dedup by log templates: a tree of fixed depth generalises lines to templates.

The tree's levels are a line's number of tokens and its leading tokens; tokens with a
digit are a field from the start. In a leaf, a token is kept where most of the leaf's
lines have it at that place, and is a field `<*>` elsewhere. What is left is the line's
template; a line that is itself frequent is a template, too, whatever else its leaf holds.
Templates that recur across documents are dropped from all documents but the first, so
that nothing is lost altogether: single lines if they recur in many documents, passages
of more than 50 words if they recur at all.

A passage is a run of neighbouring lines. From each line on, and up to each line, the
shortest run of more than 50 words is named by its lines; equal runs of two documents are a
recurring passage. Every line of a longer recurring run lies in one of these.

All built-in expressions. Lines that are alone in their leaf, most of a text, never
leave it: only leaves that two documents reach are compared, and of those each distinct
line once, with its count. Texts themselves are shuffled once, to get their cuts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyhouse.llm.text import GAP, WORD, let, narrow, row_of, stored, text_of, whole, with_text

FIELD = "<*>"
BROADCAST_LEAVES = 1_000_000  # 8 MB of keys
# A token with a digit; possessive, so that no token is gone back over.
DIGIT_WORD = r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


@dataclass(frozen=True)
class Rules:
    leading: int = 3  # tokens on the path to a leaf
    least_tokens: int = 3  # shorter lines stay
    least_documents: int = 10
    long_tokens: int = 51  # of a passage: from here on, two documents are enough
    constant_percent: int = 50  # tokens of a template that are no fields


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def masked(line: Column) -> Column:
    """Tokens with a digit as fields, white space as single spaces."""
    digits = F.when(line.rlike("[0-9]"), F.regexp_replace(line, DIGIT_WORD, FIELD)).otherwise(line)
    # Most lines have single spaces only: looking for others costs less than replacing every gap.
    wide = reduce(Column.__or__, [F.contains(line, F.lit(gap)) for gap in ("  ", "\t", "\x0b", "\x0c", "\r")])
    return F.trim(F.when(wide, F.regexp_replace(digits, GAP, " ")).otherwise(digits))


def _lines(rows: DataFrame, rules: Rules, *fields: str) -> DataFrame:
    """row, doc_id and of each line: its number, masked, tokens (count), leaf, same (hash of masked).

    All of a line is worked out in one expression, so that nothing is done twice.
    """

    def described(text: Column, number: Column) -> Column:
        tokens = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "))) + 1
        lead = F.substring_index(text, " ", rules.leading)
        every = {
            "line": number, "tokens": tokens, "masked": text, "leaf": F.xxhash64(tokens, lead), "same": F.xxhash64(text),
        }
        return F.struct(*[every[f].alias(f) for f in fields])

    each = F.transform(lines_of(F.col("text")), lambda raw, i: let(masked(raw), lambda text: described(text, i)))
    found = F.filter(each, lambda x: x["tokens"] >= rules.least_tokens)
    # `at` numbers the lines that are looked at: blank and very short ones part no neighbours.
    return rows.select("row", "doc_id", F.posexplode(found).alias("at", "x")).select("row", "doc_id", "at", "x.*")


def _shared(slim: DataFrame) -> DataFrame:
    """Leaves that more than one row reaches."""
    leaves = slim.groupBy("leaf").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low <> high").select("leaf")
    leaves = stored(narrow(leaves.withColumnRenamed("leaf", "of_leaf")), "leaves")
    # A checked size decides; beyond it both sides are shuffled.
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def _passages(near: DataFrame, rules: Rules) -> DataFrame:
    """(row, line) of lines in recurring passages, but for each passage's first document.

    `near` holds the lines in shared leaves; a line between them parts a passage.
    """
    own = Window.partitionBy("row")
    order = own.orderBy("at")
    parted = F.coalesce(F.col("at") - F.lag("at").over(order), F.lit(1)) > 1
    # Words from the row's first line on, with a wide gap where lines are missing.
    ends = near.withColumn("end", F.col("tokens") + F.when(parted, rules.long_tokens).otherwise(0)).withColumn(
        "end", F.sum("end").over(order)
    )
    placed = ends.withColumn("begin", F.col("end") - F.col("tokens"))
    onward = own.orderBy("begin").rangeBetween(0, rules.long_tokens - 1)
    back = own.orderBy("end").rangeBetween(1 - rules.long_tokens, 0)

    def run(frame: WindowSpec) -> Column:
        long = F.sum("tokens").over(frame) >= rules.long_tokens
        return F.when(long, F.struct(F.collect_list("same").over(frame).alias("same"), F.collect_list("line").over(frame).alias("lines")))

    both = placed.select("row", "doc_id", run(onward).alias("onward"), run(back).alias("back"))
    runs = both.select("row", "doc_id", F.explode(F.array_distinct(F.array("onward", "back"))).alias("run")).where("run is not null")
    runs = stored(runs.select("row", "doc_id", F.xxhash64("run.same").alias("passage"), "run.lines"), "passages")
    first = runs.groupBy(F.col("passage").alias("of")).agg(
        F.min("row").alias("low"), F.max("row").alias("high"), F.min(_owner())["row"].alias("first_row")
    ).where("low <> high").select("of", "first_row")
    again = runs.join(stored(narrow(first), "recurring"), F.col("passage") == F.col("of")).where("row <> first_row")
    return again.select("row", F.explode("lines").alias("line"))


def _owner() -> Column:
    return F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "row")


def _templates(rows: DataFrame, chosen: DataFrame, rules: Rules) -> DataFrame:
    """(leaf, same, template) of lines in leaves that more than one row reaches."""
    lines = _lines(rows, rules, "tokens", "masked", "leaf", "same")
    distinct = stored(
        lines.join(chosen, F.col("leaf") == F.col("of_leaf"), "left_semi")
        .groupBy("leaf", "same", "masked", "tokens").agg(F.count("*").alias("n")), "distinct-lines",
    )
    size = stored(
        narrow(distinct.groupBy(F.col("leaf").alias("size_leaf")).agg(F.sum("n").alias("size"), F.count("*").alias("different"))), "sizes"
    )
    sized = distinct.join(size, F.col("leaf") == F.col("size_leaf"))
    # Where all lines are the same, all their tokens are kept.
    fixed = F.size(F.array_remove(F.split("masked", " "), FIELD))
    alone = sized.where("different = 1").select("leaf", "same", "tokens", F.lit(0).cast("bigint").alias("kept"), fixed.cast("bigint").alias("constant"))
    mixed = sized.where("different > 1").select("leaf", "same", "n", "size", "tokens", F.posexplode(F.split("masked", " ")).alias("place", "word"))
    tokens = mixed.where(F.col("word") != FIELD).select("leaf", "same", "n", "size", "tokens", F.xxhash64("place", "word").alias("token"))
    # A share of the leaf decides, so that a corpus twice as large gives the same templates.
    common = 2 * F.col("n") > F.col("size")
    kept = tokens.groupBy("leaf", "token").agg(F.sum("n").alias("n"), F.max("size").alias("size")).where(common).select(
        F.col("leaf").alias("kept_leaf"), F.col("token").alias("kept_token")
    )
    found = tokens.join(kept, (F.col("leaf") == F.col("kept_leaf")) & (F.col("token") == F.col("kept_token")))
    # The kept tokens and their places, as an order-free hash.
    named = found.groupBy("leaf", "same").agg(
        F.max("tokens").alias("tokens"), F.bit_xor("token").alias("kept"), F.count("*").alias("constant")
    )
    enough = 100 * F.col("constant") >= rules.constant_percent * F.col("tokens")
    general = alone.unionByName(named).where(enough).select("leaf", "same", F.xxhash64("leaf", "kept", "constant").alias("template"))
    frequent = sized.where((F.col("different") > 1) & (F.col("n") >= rules.least_documents) & (100 * fixed >= rules.constant_percent * F.col("tokens")))
    return general.unionByName(frequent.select("leaf", "same", F.xxhash64("leaf", "same").alias("template")))


def recurring(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(row, cut): the numbers of the lines to drop, for rows (row, doc_id, text) that lose any."""
    slim = stored(_lines(rows, rules, "line", "tokens", "leaf", "same"), "lines")
    chosen = _shared(slim)
    near = stored(slim.join(chosen, F.col("leaf") == F.col("of_leaf"), "left_semi"), "near")
    templates = _templates(rows, chosen, rules).withColumnsRenamed({"leaf": "t_leaf", "same": "t_same"})
    matched = stored(
        narrow(near.join(templates, (F.col("leaf") == F.col("t_leaf")) & (F.col("same") == F.col("t_same")))
        .select("row", "doc_id", "line", "template", "tokens")), "matched",
    )
    once = matched.groupBy("template", "row").agg(F.min(_owner()).alias("owner"), F.max("tokens").alias("tokens"))
    stats = once.groupBy(F.col("template").alias("of")).agg(
        F.count("*").alias("documents"), F.min("owner").alias("first"), F.max("tokens").alias("length")
    )
    often = F.when(F.col("length") >= rules.long_tokens, F.lit(2)).otherwise(rules.least_documents)
    dropped = stats.where(F.col("documents") >= often).select("of", F.col("first.row").alias("first_row"))
    cuts = matched.join(dropped, F.col("template") == F.col("of")).where("row <> first_row").select("row", "line")
    cuts = cuts.unionByName(_passages(near, rules))
    return cuts.groupBy(F.col("row").alias("cut_row")).agg(F.collect_set("line").alias("cut"))


def cleaned(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """`doc` (the whole input row) with text (without dropped lines), n_lines, n_dropped.

    Null texts stay null and have no lines; an empty text has one, empty line. Rows that
    repeat an id and a text are one document here and are cut alike. Among equal
    templates the least doc_id keeps its lines, null ids coming last. An empty table
    gives no rows, other columns stay inside `doc`.
    """
    rows = whole(docs).withColumn("row", row_of("doc.doc_id", "doc.text"))
    slim = rows.select("row", F.col("doc.doc_id").cast("bigint").alias("doc_id"), text_of(F.col("doc.text")).alias("text"))
    cuts = stored(narrow(recurring(slim, rules)), "cuts")
    # Cuts grow with the documents, so they are shuffled at every size; texts are not sorted for them.
    joined = rows.join(cuts.hint("shuffle_hash"), F.col("row") == F.col("cut_row"), "left")
    text = text_of(F.col("doc.text"))

    def shortened(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "cut")
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"))) + 1
    return joined.select(
        "doc", F.when(F.col("cut").isNull(), F.col("doc.text")).otherwise(let(lines_of(text), shortened)).alias("text"),
        F.when(F.col("doc.text").isNull(), 0).otherwise(n_lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("cut"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def without_recurring(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """`docs` with recurring lines cut from their texts; documents that had nothing else are gone."""
    found = cleaned(docs, rules)
    # As a list that is empty or has the text, so that Spark does not cut a text twice, for the filter and for the result.
    left = F.filter(F.array("text"), lambda text: (F.col("n_dropped") == 0) | text.rlike(WORD))
    return found.select("doc", F.explode(left).alias("text")).select(*with_text(docs.columns, F.col("text")))
