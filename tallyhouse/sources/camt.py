"""ISO 20022 account statements (camt.053) and notifications (camt.054).

A file is read in pieces that end at an entry's tag, by as many tasks as it has blocks, so a
statement of any length is no unit of work. An entry belongs to the statement opened last
before it: each block says what it opened last, one row a block is taken in file order, and
an entry looks at the openings of its block and at what its block began with. Entries are read
before they are put in order, so that their text moves only where refused ones are kept.

Names and remarks count at any depth of an entry, in the order of the text. Inside a text
every `<` is written `&lt;`, so what a text says never passes for an element.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import number_text, parse_number
from tallyhouse.functions.text import cut, is_digits, or_default, strip, stripped
from tallyhouse.operators.lookup import lookup
from tallyhouse.sources.files import ranked
from tallyhouse.sources.rules import MIDDAY, accepted, carried, normalise_manifest_rows, nothing, tagged
from tallyhouse.sources.text import listed_files

# message kind -> (row element, operation type)
MESSAGES = {"053": ("Stmt", "CAMT_STMT"), "054": ("Ntfctn", "CAMT_NTF")}
DESCRIPTION_WIDTH = 2000
# What ends a piece: the tag of an entry, whatever its prefix.
END = "Ntry>"
PLACE = ("__path", "seq_part", "__block", "__row")
# Direct children of an entry; the same names further inside mean something else.
SAID = ("__broken", "__ref", "__amount", "__currency", "__side", "__day", "__remark", "__named")
ENTRY = (
    "Amt array<struct<_VALUE: string, _Ccy: string>>, CdtDbtInd array<string>, "
    "BookgDt array<struct<Dt: array<string>>>, AcctSvcrRef array<string>, __broken string"
)


def _open(tag: str) -> str:
    return rf"<(?:\w++:)?{tag}(?:\s[^<>]*+)?>"


def _close(tag: str) -> str:
    return rf"</(?:\w++:)?{tag}\s*+>"


def _texts(xml: Column, tag: str) -> Column:
    """What stands directly after each opening tag, as written."""
    return F.regexp_extract_all(xml, F.lit(_open(tag) + "([^<]*)"), F.lit(1))


def _filled(values: Column) -> Column:
    return F.filter(F.transform(values, strip), lambda v: v != "")


def _decoded(text: Column) -> Column:
    """Character references resolved, by the XML reader."""
    read = F.from_xml(F.concat(F.lit("<r><t>"), text, F.lit("</t></r>")), "t string", {"rowTag": "r", "ignoreSurroundingSpaces": "false"})
    return F.when(F.contains(text, F.lit("&")), read["t"]).otherwise(text)


def _without_sections(xml: Column) -> Column:
    """Comments dropped and CDATA written as plain text."""
    begin, end = "<![CDATA[", "]]>"

    def plain(part: Column, i: Column) -> Column:
        size = F.locate(end, part) - 1
        said = F.substring(part, F.lit(1), size)
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            said = F.replace(said, F.lit(sign), F.lit(name))
        after = F.substring(part, size + len(end) + 1, F.length(part))
        return F.when((i == 0) | (size < 0), part).otherwise(F.concat(said, after))

    joined = F.array_join(F.transform(F.split(xml, r"<!\[CDATA\["), plain), "")
    xml = F.when(F.contains(xml, F.lit(begin)), joined).otherwise(xml)
    return F.when(F.contains(xml, F.lit("<!--")), F.regexp_replace(xml, r"(?s)<!--.*?-->", "")).otherwise(xml)


def account_number(account: Column) -> Column:
    """First all-digit id inside an `Othr` at any depth, else the first all-digit id."""
    others = F.array_join(F.regexp_extract_all(account, F.lit(rf"(?s){_open('Othr')}(.*?){_close('Othr')}"), F.lit(1)), "")

    def digits(xml: Column) -> Column:
        return F.get(F.filter(_filled(_texts(xml, "Id")), is_digits), F.lit(0))

    return F.coalesce(digits(others), digits(account))


def _opening(header: Column, tag: str) -> Column:
    """What the text between two entries does to the open statement: its account, or that it is closed; null if nothing."""

    def state(parts: Column) -> Column:
        last = F.element_at(parts, -1)
        account = F.regexp_extract(last, rf"(?s){_open('Acct')}(.*?){_close('Acct')}", 1)
        opened = F.struct(F.lit(True).alias("open"), account.alias("account"))
        closed = F.struct(F.lit(False).alias("open"), F.lit("").alias("account"))
        ended = last.rlike(_close(tag))
        return F.when((F.size(parts) > 1) & ~ended, opened).when(ended, closed)

    # As a list of one, so that a header is split once; most have no such tag at all.
    return F.when(F.contains(header, F.lit(tag)), F.transform(F.array(F.split(header, _open(tag))), state)[0])


def read_statements(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """One row per booked entry inside a statement or notification: `__entry`, as XML, what it says, `__account` and position."""
    tag, _ = MESSAGES[kind]
    files = listed_files(spark, paths)
    pieces = spark.read.option("lineSep", END).text(files).select(
        _without_sections(F.col("value")).alias("xml"), F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__row"),
    )
    pieces = ranked(pieces, files)
    xml, begun = F.col("xml"), r"^/(?:\w++:)?$"
    tail = F.substring_index(xml, "<", -1)  # what is short is looked at, not the whole piece
    entry = F.contains(xml, F.lit("<")) & tail.rlike(begun)
    attributes = xml.rlike(r"Ntry[\s>]")
    parts = F.split(xml, _open("Ntry"))  # more than one where the tag has attributes
    header = F.when(~entry, xml).when(attributes & (F.size(parts) > 1), parts[0])
    text = F.when(attributes, F.element_at(parts, -1)).otherwise(xml)
    inside = F.concat(F.left(text, F.length(text) - F.length(tail) - 1), F.regexp_replace(tail, begun, ""))
    pieces = pieces.select(*PLACE, _opening(header, tag).alias("opening"), F.when(entry, inside).alias("__entry"))
    known = F.struct(F.col("opening.open").alias("open"), account_number(F.col("opening.account")).alias("account"))
    pieces = _said(pieces.withColumn("opening", F.when(F.col("opening").isNotNull(), known)))
    of_block = pieces.groupBy("seq_part", "__block").agg(
        F.max_by("opening", F.when(F.col("opening").isNotNull(), F.col("__row"))).alias("last")
    )
    earlier = Window.partitionBy("of_part").orderBy("of_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = of_block.withColumnsRenamed({"seq_part": "of_part", "__block": "of_block"}).select(
        "of_part", "of_block", F.last("last", ignorenulls=True).over(earlier).alias("carried")
    )
    so_far = Window.partitionBy("seq_part", "__block").orderBy("__row").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("own", F.last("opening", ignorenulls=True).over(so_far))
    # What is no entry has done its part, and is not joined.
    placed = placed.where(F.col("__piece") & (F.col("own").isNull() | F.col("own.open")))
    placed = placed.join(blocks, (F.col("seq_part") == F.col("of_part")) & (F.col("__block") == F.col("of_block")))
    state = F.coalesce("own", "carried")
    return placed.where(state["open"]).select(
        "__path", "seq_part", F.col("__block").alias("seq_block"), F.col("__row").alias("seq_row"),
        state["account"].alias("__account"), "__entry", *SAID,
    )


def _said(pieces: DataFrame) -> DataFrame:
    """`pieces` with what each `__entry` says, and whether there is one as `__piece`."""
    xml = F.col("__entry")
    whole = F.concat(F.lit("<Ntry>"), xml, F.lit("</Ntry>"))
    options = {"rowTag": "Ntry", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "__broken"}
    rows = pieces.withColumn("e", F.from_xml(whole, ENTRY, options))
    said = F.split(_decoded(F.array_join(_texts(xml, "Nm"), "\n")), "\n")
    customers = F.filter(F.transform(said, lambda n: F.regexp_extract(n, r"Customer ([0-9]+)", 1)), lambda c: c != "")
    days = F.filter(F.transform(F.col("e.BookgDt"), lambda b: F.get(b["Dt"], F.lit(0))), lambda d: d != "")
    amount = F.get("e.Amt", F.lit(0))
    first = lambda values: F.get(_filled(values), F.lit(0))
    read = {
        "__piece": xml.isNotNull(),
        "__broken": F.col("e.__broken").isNotNull(),
        "__ref": F.coalesce(first(F.col("e.AcctSvcrRef")), F.lit("")),
        "__amount": F.coalesce(stripped(amount["_VALUE"]), F.lit("0")),
        "__currency": cut(or_default(amount["_Ccy"], "INR"), 8),
        "__side": F.coalesce(first(F.col("e.CdtDbtInd")), F.lit("DBIT")),
        "__day": cut(strip(F.try_element_at(days, F.lit(-1))), 10),
        "__remark": strip(_decoded(first(_texts(xml, "Ustrd")))),
        "__named": F.try_element_at(customers, F.lit(-1)),
    }
    return rows.withColumns(read).drop("e")


def entries(statements: DataFrame, accounts: DataFrame | None, kind: str) -> DataFrame:
    """Booked entries as staging transactions.

    `accounts` maps account_id to source_client_id for entries that do not name
    their customer.
    """
    return accepted(read_entries(statements, accounts, kind))


def read_entries(statements: DataFrame, accounts: DataFrame | None, kind: str) -> DataFrame:
    """The same with refused entries, which lack an account, reference, customer or number."""
    _, operation = MESSAGES[kind]
    rows = statements
    if accounts is None:
        rows = rows.withColumn("__owner", nothing())
    else:
        owners = accounts.select("account_id", F.col("source_client_id").alias("__owner"))
        rows = lookup(rows, F.col("__account"), owners, "account_id")
    client = F.coalesce("__named", "__owner")
    value = parse_number("__amount")
    reason = (
        F.when(F.col("__broken"), F.lit("entry is no XML"))
        .when(F.col("__account").isNull(), F.lit("no account number"))
        .when(F.col("__ref") == "", F.lit("no reference"))
        .when(F.coalesce(client, F.lit("")).isin("", "0"), F.lit("no customer"))
        .when(value.isNull(), F.lit("amount is no number"))
    )
    staged = rows.select(
        cut(F.concat(F.lit(f"ISO{kind}-"), F.col("__ref")), 100).alias("source_transaction_id"),
        strip(client).alias("source_client_id"),
        F.col("__account").alias("source_account_id"),
        nothing().alias("source_product_id"),
        F.lit("ONLINE").alias("channel_code"),
        F.lit(operation).alias("operation_type_code"),
        F.concat(F.nullif(F.col("__day"), F.lit("")), F.lit(MIDDAY)).alias("operation_ts"),
        number_text(F.abs(value)).alias("amount"),
        F.col("__currency").alias("currency_code"),
        F.when(F.contains(F.upper("__side"), F.lit("DBIT")), "D").otherwise("C").alias("direction"),
        F.lit("POSTED").alias("status"),
        F.lit(f"camt{kind}").alias("merchant_name"),
        cut(or_default("__remark", f"camt {kind}"), DESCRIPTION_WIDTH).alias("description"),
        *tagged(reason, F.col("__entry")),
        *carried(rows),
    )
    return normalise_manifest_rows(staged, "abs_transactions_raw")
