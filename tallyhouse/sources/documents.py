"""JSON feeds: event lines, open banking documents, complaints.

Values are read through VARIANT because the feeds mix types in one field: an
amount may be an object or a plain value, a flag a boolean, a number or a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.text import (
    blank_to_null,
    cut,
    join_present,
    or_default,
    strip,
    stripped,
)
from tallyhouse.sources.files import positioned
from tallyhouse.sources.rules import accepted, carried, normalise_manifest_rows, nothing, tagged

# Keys kept of an event's payload, complaint channels.
PAYLOAD_KEYS = ("ip_country", "account_id", "source_system")
COMPLAINT_CHANNELS = {"web": "WEB", "phone": "TELEPHONE", "email": "EMAIL", "referral": "REFERRAL"}
NARRATIVE_WIDTH = 500


def text(document: str, path: str) -> Column:
    return F.try_variant_get(F.col(document), f"$.{path}", "string")


def part(document: str, path: str) -> Column:
    return F.try_variant_get(F.col(document), f"$.{path}", "variant")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _truthy(value: Column) -> Column:
    """Python-style truth of a JSON value; NULL when it is absent or null."""
    shown = F.try_variant_get(value, "$", "string")
    name = kind(value)
    empty = (
        F.when(name == "STRING", shown == "")
        .when(name == "BOOLEAN", shown == "false")
        .when(name.startswith("OBJECT"), F.to_json(value) == "{}")
        .when(name.startswith("ARRAY"), F.to_json(value) == "[]")
        .otherwise(F.coalesce(shown.try_cast("double") == 0, F.lit(False)))
    )
    return F.when(value.isNotNull() & (name != "VOID"), ~empty)


def event_lines(lines: DataFrame) -> DataFrame:
    """Event log: one JSON object per line; blank, broken and non-object lines are skipped."""
    return accepted(read_event_lines(lines))


def read_event_lines(lines: DataFrame) -> DataFrame:
    """The same with refused lines, which are no JSON object; blank ones are no records."""
    # Each line explodes into its one event: a filter on the parsed value would be
    # pushed below and parse every line a second time.
    line = strip("line")
    looks = F.startswith(line, F.lit("{"))
    parsed = F.array(F.struct(F.when(looks, F.try_parse_json(line)).alias("__event"), looks.alias("__looks")))
    events = lines.where(line != "").select(F.explode(parsed).alias("__read"), F.col("line").alias("__line"), *carried(lines))
    events = events.select("__read.*", "__line", *carried(lines))
    reason = F.when(~F.col("__looks"), F.lit("no JSON object")).when(F.col("__event").isNull(), F.lit("no JSON"))
    payload = F.to_json(F.struct(*[part("__event", k).alias(k) for k in PAYLOAD_KEYS]))
    return events.select(
        text("__event", "event_id").alias("source_event_id"),
        text("__event", "customer_id").alias("source_client_id"),
        F.coalesce(strip(text("__event", "channel")), F.lit("")).alias("channel_code"),
        F.coalesce(strip(text("__event", "event_type")), F.lit("")).alias("event_type_code"),
        text("__event", "event_time").alias("event_ts"),
        stripped(text("__event", "device_type")).alias("device_type"),
        nothing().alias("platform"),
        stripped(text("__event", "session_id")).alias("session_id"),
        _truthy(part("__event", "success")).cast("string").alias("success_flag"),
        F.when(payload != "{}", payload).alias("payload_json"),
        *tagged(reason, F.col("__line")),
        *carried(lines),
    )


def _items(documents: DataFrame, path: str) -> DataFrame:
    """Elements of an array inside each document, in order; broken documents give none.

    The rows are elements already cut (`__json`), or documents of one row each. Either way
    only an element has to fit into a VARIANT, not the document.
    """
    carry = carried(documents)
    if "__json" in documents.columns:
        parsed = F.array(F.struct(F.when(F.col("__refused").isNull(), F.try_parse_json("__json")).alias("__item")))
        items = documents.select(F.explode(parsed).alias("__read"), "__json", "__refused", *carry)
        unread = F.when(F.col("__read.__item").isNull() & F.col("__json").isNotNull(), F.lit("element is no JSON"))
        return items.select("__read.__item", "__json", F.coalesce("__refused", unread).alias("__refused"), *carry)
    *outer, last = path.split(".")
    schema = f"struct<`{last}`: array<string>>"
    for name in reversed(outer):
        schema = f"struct<`{name}`: {schema}>"
    parsed = documents.select(F.from_json("content", schema).alias("__doc"), *carry)
    elements = parsed.select(F.explode(f"__doc.{path}").alias("__json"), *carry)
    items = elements.select(F.try_parse_json("__json").alias("__item"), "__json", nothing().alias("__refused"), *carry)
    if "load_seq" in carry:
        return items
    rank = F.col("seq_part") if "seq_part" in carry else 0
    return positioned(items, rank)


# Where the elements of each feed are.
ACCOUNTS, TRANSACTIONS, COMPLAINTS = "Data.Account", "Data.Transaction", "complaints"


def open_banking_accounts(documents: DataFrame) -> DataFrame:
    return accepted(read_open_banking_accounts(documents))


def read_open_banking_accounts(documents: DataFrame) -> DataFrame:
    items = _items(documents, ACCOUNTS)
    status = or_default(text("__item", "Status"), "ACTIVE")
    number = F.coalesce(text("__item", "AccountId"), F.lit(""))
    sort = F.concat_ws(
        " / ",
        F.coalesce(text("__item", "AccountType"), F.lit("")),
        F.coalesce(text("__item", "AccountSubType"), F.lit("")),
    )
    return items.select(
        text("__item", "AccountId").alias("source_account_id"),
        text("__item", "CustomerId").alias("source_client_id"),
        cut(
            F.coalesce(blank_to_null(text("__item", "Nickname")), F.concat(F.lit("****"), number)), 64
        ).alias("account_number_masked"),
        cut(or_default(F.btrim(sort, F.lit(" /")), "ACCOUNT"), 50).alias("account_type"),
        cut(or_default(text("__item", "Currency"), "INR"), 8).alias("currency_code"),
        cut(text("__item", "StatusUpdateDateTime"), 10).alias("opened_at"),
        nothing().alias("closed_at"),
        cut(
            F.when(F.lower(status) == "enabled", F.lit("ACTIVE")).otherwise(F.upper(status)), 30
        ).alias("status"),
        *tagged(F.col("__refused"), F.col("__json")),
        *carried(items),
    )


def open_banking_transactions(documents: DataFrame) -> DataFrame:
    """`Amount`, `BankTransactionCode` and `MerchantDetails` count only when objects.

    A path into anything else finds nothing, which is what the rule asks for.
    """
    return accepted(read_open_banking_transactions(documents))


def read_open_banking_transactions(documents: DataFrame) -> DataFrame:
    items = _items(documents, TRANSACTIONS)
    indicator = F.lower(or_default(text("__item", "CreditDebitIndicator"), "Debit"))
    rows = items.select(
        text("__item", "TransactionId").alias("source_transaction_id"),
        text("__item", "CustomerId").alias("source_client_id"),
        text("__item", "AccountId").alias("source_account_id"),
        nothing().alias("source_product_id"),
        F.lit("ONLINE").alias("channel_code"),
        cut(or_default(text("__item", "BankTransactionCode.Code"), "PAYMENT"), 50).alias("operation_type_code"),
        text("__item", "BookingDateTime").alias("operation_ts"),
        F.replace(or_default(text("__item", "Amount.Amount"), "0"), F.lit(","), F.lit(".")).alias("amount"),
        cut(or_default(text("__item", "Amount.Currency"), "INR"), 8).alias("currency_code"),
        F.when(F.contains(indicator, F.lit("debit")), "D").otherwise("C").alias("direction"),
        cut(or_default(text("__item", "Status"), "POSTED"), 30).alias("status"),
        stripped(text("__item", "MerchantDetails.MerchantName")).alias("merchant_name"),
        stripped(text("__item", "TransactionInformation")).alias("description"),
        *tagged(F.col("__refused"), F.col("__json")),
        *carried(items),
    )
    return normalise_manifest_rows(rows, "abs_transactions_raw")


def complaint_channel(submitted_via: Column) -> Column:
    named = F.lower(strip(submitted_via))
    chain = F
    for word, code in COMPLAINT_CHANNELS.items():
        chain = chain.when(named == word, F.lit(code))
    return chain.otherwise(F.lit("WEB"))


def complaint_status(response: Column) -> Column:
    """Anything in progress is open even if it also says closed."""
    said = F.lower(response)
    return (
        F.when(F.contains(said, F.lit("progress")), F.lit("OPEN"))
        .when(F.contains(said, F.lit("closed")) | F.contains(said, F.lit("monetary")), F.lit("CLOSED"))
        .otherwise(F.lit("OPEN"))
    )


def complaints(documents: DataFrame) -> DataFrame:
    return accepted(read_complaints(documents))


def read_complaints(documents: DataFrame) -> DataFrame:
    """The same with refused records: unreadable ones, and those without a number."""
    items = _items(documents, COMPLAINTS)
    number = F.coalesce(strip(text("__item", "complaint_id")), F.lit(""))
    reason = F.coalesce("__refused", F.when(number == "", F.lit("complaint_id is missing")))
    day = blank_to_null(cut(text("__item", "date_received"), 10))
    told = join_present([
        text("__item", "product"),
        text("__item", "issue"),
        cut(text("__item", "narrative"), NARRATIVE_WIDTH),
    ])
    return items.select(
        number.alias("source_appeal_id"),
        F.coalesce(strip(text("__item", "customer_id")), F.lit("")).alias("source_client_id"),
        complaint_channel(text("__item", "submitted_via")).alias("channel_code"),
        F.lit("CONSUMER").alias("appeal_type_code"),
        F.concat(day, F.lit("T00:00:00Z")).alias("created_ts"),
        nothing().alias("resolved_ts"),
        complaint_status(text("__item", "company_response")).alias("status"),
        F.lit("2").alias("priority"),
        blank_to_null(told).alias("result_text"),
        *tagged(reason, F.col("__json")),
        *carried(items),
    )
