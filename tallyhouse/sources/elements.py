"""Elements of an array inside large JSON documents, cut out by many tasks.

A document is read in pieces that end at a closing brace, and a piece is all a task looks
at. Whether a piece begins inside a string and how deep it begins are sums over all pieces
before it: of quotes, and of brackets outside strings. So each block of a file says how many
quotes it has and how much deeper it ends, for each way it may begin; one row a block is
summed in file order, and then every piece knows its state and depth.

A group is the pieces from one return to the array's depth (or above) to the next; it holds
at most one object of the array. Put behind the brackets that are open where it begins, and
before those that close what it leaves open, a group is a small document of its own, which
the JSON reader takes apart. What the array holds is never in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

END = "}"
PLACE = ("__path", "__block", "__row")
# Positions inside a group follow the row's; a group has fewer elements than this.
WITHIN = 1 << 20
ROWS = (1 << 33) - 1  # of a row number, the part that counts inside a task

EVENT = "struct<kind: string, key: string>"


def _outside(piece: Column, inside: Column) -> Column:
    """The text outside strings, given whether it begins inside one; escapes are gone already."""
    return F.regexp_replace(F.when(inside, F.concat(F.lit('"'), piece)).otherwise(piece), r'"[^"]*+("|$)', "")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _deeper(piece: Column, inside: Column, quotes: Column) -> Column:
    """How much deeper a piece ends, its closing brace included where that is none of a string's."""
    text = _outside(piece, inside)
    ends_outside = (inside.cast("int") + quotes) % 2 == 0
    return _count(text, "{[") - _count(text, "}]") - ends_outside.cast("int")


def _openings(piece: Column, depth: Column, most: int) -> Column:
    """The last bracket opened to each depth from 1 to `most`, with the key it stands under; null where none."""
    tokens = F.regexp_extract_all(piece, F.lit(r'("[^"]*+"|[{}\[\]])'), 0)

    def step(acc: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        now = acc["depth"] + opens.cast("int") - closes.cast("int")
        event = F.struct(token.alias("kind"), acc["key"].alias("key"))
        found = F.transform(acc["found"], lambda old, i: F.when(opens & (i + 1 == now), event).otherwise(old))
        key = F.when(opens | closes, F.lit(None).cast("string")).otherwise(F.trim(token, F.lit('"')))
        return F.struct(now.alias("depth"), key.alias("key"), found.alias("found"))

    none = F.array(*[F.lit(None).cast(EVENT) for _ in range(most)])
    start = F.struct(depth.cast("int").alias("depth"), F.lit(None).cast("string").alias("key"), none.alias("found"))
    return F.aggregate(tokens, start, step, lambda acc: acc["found"])


def _before(column: Column, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def _joined(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    blocks = blocks.withColumnsRenamed({"__path": "of_path", "__block": "of_block"})
    same = (F.col("__path") == F.col("of_path")) & (F.col("__block") == F.col("of_block"))
    return rows.join(blocks, same).drop("of_path", "of_block")


FIRST, LAST = Window.unboundedPreceding, Window.unboundedFollowing


def _in_block() -> WindowSpec:
    return Window.partitionBy("__path", "__block").orderBy("__row")


def _blocks() -> WindowSpec:
    return Window.partitionBy("__path").orderBy("__block")


def placed_pieces(spark: SparkSession, files: Sequence[str], text: Column) -> DataFrame:
    """Pieces with `depth` and `inside` where they begin, `ends` and `ends_inside` where they end; the file's `whole`."""
    value = F.col("value")
    pieces = spark.read.option("lineSep", END).text(list(files)).select(
        text.alias("piece"), F.octet_length(value).alias("size"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )
    pieces = pieces.withColumn("clean", F.regexp_replace("piece", r"(?s)\\.", ""))
    pieces = pieces.withColumn("quotes", _count(F.col("clean"), '"'))
    pieces = pieces.withColumn("odd", _before(F.col("quotes"), _in_block().rowsBetween(FIRST, -1)) % 2 == 1)
    pieces = pieces.select(
        "*", *[_deeper(F.col("clean"), state, F.col("quotes")).alias(n) for n, state in (("deeper0", F.col("odd")), ("deeper1", ~F.col("odd")))]
    )
    pieces = pieces.select("*", *[_before(F.col(f"deeper{i}"), _in_block().rowsBetween(FIRST, -1)).alias(f"depth{i}") for i in (0, 1)])
    totals = pieces.groupBy("__path", "__block").agg(
        *[F.sum(c).alias(c) for c in ("quotes", "deeper0", "deeper1")], F.sum(F.col("size") + 1).alias("size"),
        F.max("file_size").alias("file_size"), F.max_by(F.trim(F.regexp_replace("piece", r"\s+", "")) == "", "__row").alias("blank"),
    )
    turned = totals.withColumn("turned", _before(F.col("quotes"), _blocks().rowsBetween(FIRST, -1)) % 2 == 1)
    turned = turned.withColumn("deeper", F.when(F.col("turned"), F.col("deeper1")).otherwise(F.col("deeper0")))
    last, all_deeper = F.last("blank").over(_blocks().rowsBetween(FIRST, LAST)), F.sum("deeper").over(_blocks().rowsBetween(FIRST, LAST))
    # The reader shows the end of a file like a closing brace; sizes tell them apart. It
    # leaves out a byte order mark, which has three bytes.
    unread = F.col("file_size") - F.sum("size").over(_blocks().rowsBetween(FIRST, LAST))
    closed = unread.isin(0, 3)
    whole = (F.sum("quotes").over(_blocks().rowsBetween(FIRST, LAST)) % 2 == 0) & F.when(closed, all_deeper == 0).otherwise(last & (all_deeper == -1))
    blocks = turned.select("__path", "__block", "turned", _before(F.col("deeper"), _blocks().rowsBetween(FIRST, -1)).alias("block_depth"), whole.alias("whole"))
    turn = lambda zero, one: F.when(F.col("turned"), one).otherwise(zero)
    depth = F.col("block_depth") + turn(F.col("depth0"), F.col("depth1"))
    inside = turn(F.col("odd"), ~F.col("odd"))
    return _joined(pieces, blocks).select(
        *PLACE, "piece", "clean", "whole", inside.alias("inside"), depth.alias("depth"),
        ((inside.cast("int") + F.col("quotes")) % 2 == 1).alias("ends_inside"),
        (depth + turn(F.col("deeper0"), F.col("deeper1"))).alias("ends"),
    )


def _opened(kinds: list[Column], keys: list[Column], depth: Column) -> Column:
    """Text that opens what is open at `depth`, with a value where the innermost already has some."""
    text = F.lit("")
    for d, (kind, key) in enumerate(zip(kinds, keys, strict=True), start=1):
        under = F.lit("") if d == 1 else F.when(kinds[d - 2] == "{", F.concat(F.lit('"'), key, F.lit('":'))).otherwise("")
        here = F.concat(under, kind, F.when(depth == d, F.when(kind == "{", '"":0').otherwise("0")).otherwise(""))
        text = F.concat(text, F.when(depth >= d, here).otherwise(""))
    return text


def _closed(kinds: list[Column], depth: Column) -> Column:
    text = F.lit("")
    for d, kind in reversed(list(enumerate(kinds, start=1))):
        text = F.concat(text, F.when(depth >= d, F.when(kind == "{", "}").otherwise("]")).otherwise(""))
    return text


def cut_elements(spark: SparkSession, files: Sequence[str], path: str, text: Column) -> DataFrame:
    """path, block, row, `__json` of every element of the array at `path` (names joined by dots) of the files.

    What cannot be read has its text in `__json` and a reason in `__refused`: a document whose
    brackets or strings do not close, as a whole, and a group that is no JSON.
    """
    names = path.split(".")
    most = len(names) + 1  # the depth inside the array
    pieces = placed_pieces(spark, files, text)
    first = (F.col("__block") == 0) & (F.row_number().over(_in_block()) == 1)
    starts = (F.col("depth") <= most) & ~F.col("inside")
    pieces = pieces.withColumn("first", first).withColumn("starts", starts)
    # Most pieces go on in the same array or stay inside its elements, and open nothing up to its depth.
    clean = F.col("clean")
    goes_on = (F.col("depth") == most) & clean.rlike(r"^\s*+,\s*+\{") & ~F.col("inside")
    shallow = (F.col("depth") - _count(clean, "]") <= most) & ~(goes_on & ~F.contains(clean, F.lit("]")))
    quoted = F.when(F.col("inside"), F.concat(F.lit('"'), clean)).otherwise(clean)
    pieces = pieces.withColumn("opened", F.when(shallow, _openings(quoted, F.col("depth"), most)))
    depths = range(most)
    opened = [F.get("opened", F.lit(d)) for d in depths]
    extra = (F.col("depth") <= 0) & ~F.col("first") & (F.trim(F.regexp_replace("piece", r"\s+", "")) != "")
    summary = pieces.groupBy("__path", "__block").agg(
        F.max(F.when(F.col("starts"), F.col("__row"))).alias("last_start"), F.bool_or(extra).alias("extra"),
        *[F.max_by(o, F.when(o.isNotNull(), F.col("__row"))).alias(f"last{d}") for d, o in enumerate(opened)],
    )
    begun = F.when(F.col("last_start").isNotNull(), F.struct("__block", F.col("last_start").alias("__row")))
    blocks = summary.select(
        "__path", "__block", F.last(begun, ignorenulls=True).over(_blocks().rowsBetween(FIRST, -1)).alias("begun"),
        F.max("extra").over(_blocks().rowsBetween(FIRST, LAST)).alias("any_extra"),
        *[F.last(f"last{d}", ignorenulls=True).over(_blocks().rowsBetween(FIRST, -1)).alias(f"carried{d}") for d in depths],
    )
    so_far = _in_block().rowsBetween(FIRST, 0)
    rows = _joined(pieces, blocks).withColumn("sound", F.col("whole") & ~F.col("any_extra"))
    here = F.when(F.col("starts"), F.struct("__block", "__row"))
    rows = rows.select(
        *PLACE, "piece", "depth", "ends", "ends_inside", "starts", "first", "sound", F.coalesce(F.last(here, ignorenulls=True).over(so_far), "begun").alias("of"),
        *[F.coalesce(F.last(o, ignorenulls=True).over(_in_block().rowsBetween(FIRST, -1)), f"carried{d}").alias(f"open{d}") for d, o in enumerate(opened)],
        *[F.coalesce(F.last(o, ignorenulls=True).over(so_far), f"carried{d}").alias(f"close{d}") for d, o in enumerate(opened)],
    )
    sound = rows.where(F.col("sound") & (F.col("first") | (F.col("depth") > 0) | ~F.col("starts")))
    start = F.when(F.col("starts"), F.struct("depth", *[f"open{d}" for d in depths]))
    end = F.struct("ends", "ends_inside", *[f"close{d}" for d in depths])
    # Inside a block nothing moves; only what crosses a block's end is put together once more.
    parts = sound.groupBy("__path", "__block", "of").agg(
        F.max(start).alias("start"), F.max_by(end, "__row").alias("end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__row", "piece"))), lambda x: x["piece"]), END).alias("part"),
    )
    at_home = (F.col("of.__block") == F.col("__block")) & (F.col("end.ends") <= most) & ~F.col("end.ends_inside")
    inner = parts.where(at_home).select("__path", "of", "start", "end", F.col("part").alias("group"))
    crossing = parts.where(~at_home).groupBy("__path", "of").agg(
        F.max("start").alias("start"), F.max_by("end", "__block").alias("end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__block", "part"))), lambda x: x["part"]), END).alias("group"),
    )
    groups = inner.unionByName(crossing)

    kinds = {w: [F.col(f"{at}.{w}{d}.kind") for d in depths] for at, w in (("start", "open"), ("end", "close"))}
    keys = [F.col(f"start.open{d}.key") for d in depths]
    depth = F.col("start.depth")
    small = F.concat(
        _opened(kinds["open"], keys, depth), F.regexp_replace("group", "^﻿", ""), F.lit(END), _closed(kinds["close"], F.col("end.ends"))
    )
    # The value put into the array itself is no element.
    wanted = depth == most
    for d, name in enumerate(names, start=1):
        wanted &= (kinds["open"][d] == ("[" if d == len(names) else "{")) & (keys[d] == name)
    *outer, inner_name = names
    schema = f"`{inner_name}`: array<string>"
    for name in reversed(outer):
        schema = f"`{name}`: struct<{schema}>"
    read = F.from_json(small, f"struct<{schema}, __broken: string>", {"columnNameOfCorruptRecord": "__broken"})
    parsed = groups.select("__path", "of.*", "group", F.coalesce(wanted, F.lit(False)).alias("wanted"), read.alias("read"))
    values = F.col("read." + ".".join(f"`{n}`" for n in names))
    values = F.when(F.col("wanted"), F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))).otherwise(values)
    broken = F.col("read.__broken").isNotNull()
    one = lambda value, reason: F.struct(value.cast("string").alias("__json"), reason.cast("string").alias("__refused"))
    fine = F.transform(values, lambda v: one(v, F.lit(None)))
    found = F.when(broken, F.array(one(F.col("group"), F.lit("no JSON")))).otherwise(fine)
    exploded = parsed.select(*PLACE, F.posexplode(found).alias("__at", "found"))
    row = F.col("__row").bitwiseAND(ROWS) * WITHIN
    elements = exploded.select("__path", F.col("__block").alias("seq_block"), (row + F.col("__at")).alias("seq_row"), "found.*")
    unsound = rows.where(F.col("first") & ~F.col("sound")).select(
        "__path", F.col("__block").alias("seq_block"), F.lit(0).cast("bigint").alias("seq_row"),
        F.col("piece").alias("__json"), F.lit("document does not close").alias("__refused"),
    )
    return elements.unionByName(unsound)
