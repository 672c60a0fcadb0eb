"""Row rules per feed: raw columns in, staging columns out.

All rules are column expressions. Position columns and `load_seq`, when present,
pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalars import number_text, parse_number
from tallyhouse.functions.text import (
    blank_to_null,
    cut,
    is_digits,
    or_default,
    recode,
    strip,
    stripped,
)
from tallyhouse.schemas import STAGING, staging_columns
from tallyhouse.sources.files import POSITION

# Spellings and codes of the feeds.
BUSINESS_WORDS = ("BUSINESS", "B2B", "B")
CHANNEL_CODES = {"MOBILE": "MB", "MOBILE_APP": "MB"}
MIDDAY = "T12:00:00+00:00"


def carried(rows: DataFrame) -> list[str]:
    return [c for c in (*POSITION, "load_seq", "__path") if c in rows.columns]


def tagged(reason: Column, raw: Column) -> list[Column]:
    """Two columns that keep a refused record with its reason; both are NULL for an accepted one."""
    return [reason.alias("reject_reason"), F.when(reason.isNotNull(), raw).alias("raw_text")]


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where("reject_reason IS NULL").drop("reject_reason", "raw_text")


def as_read(rows: DataFrame) -> Column:
    """A record as text: what was read, by column."""
    return F.to_json(F.struct(*[c for c in rows.columns if not c.startswith("__") and c not in (*POSITION, "load_seq")]))


def nothing() -> Column:
    return F.lit(None).cast("string")


def normalise_manifest_rows(rows: DataFrame, table: str) -> DataFrame:
    """Defaults and spellings for rows that come through the manifest.

    An entry may list fewer columns than its table has; the others stay absent.
    """
    rules: dict[str, Column] = {}
    if table == "abs_clients_raw":
        rules["source_client_id"] = strip("source_client_id")
        rules["client_type"] = F.when(blank_to_null("client_type").isNull(), F.col("client_type")).otherwise(
            F.when(F.upper(strip("client_type")).isin(*BUSINESS_WORDS), "BUSINESS").otherwise("INDIVIDUAL")
        )
        rules["status"] = or_default("status", "ACTIVE")
    elif table == "abs_transactions_raw":
        for c in ("source_transaction_id", "source_client_id", "source_account_id"):
            rules[c] = F.coalesce(stripped(c), F.col(c))
        defaults = {"channel_code": "ONLINE", "currency_code": "INR", "direction": "D", "status": "POSTED"}
        rules |= {c: or_default(c, value) for c, value in defaults.items()}
    elif table == "abs_accounts_raw" and {"account_number_masked", "source_account_id"} <= set(rows.columns):
        mask = F.concat(F.lit("****"), F.right(strip("source_account_id"), F.lit(4)))
        unmasked = blank_to_null("account_number_masked").isNull() & blank_to_null("source_account_id").isNotNull()
        rules["account_number_masked"] = F.when(unmasked, mask).otherwise(F.col("account_number_masked"))
    return rows.withColumns({c: rule for c, rule in rules.items() if c in rows.columns})


TSV_TRANSACTION_COLUMNS = (
    "transaction_id", "client_id", "account_id", "amount", "transaction_date", "channel",
    "operation_type", "currency", "merchant_category", "counterparty",
)


def tsv_transactions(rows: DataFrame) -> DataFrame:
    """External transactions: the sign of the amount is the direction, zero is a credit."""
    return accepted(read_tsv_transactions(rows))


def read_tsv_transactions(rows: DataFrame) -> DataFrame:
    """The same with refused records: no id, or an amount that is no number."""
    value = parse_number("amount")
    day = strip(cut("transaction_date", 10))
    channel = F.when(blank_to_null("channel").isNull(), F.lit("ONLINE")).otherwise(
        recode(F.upper(strip("channel")), CHANNEL_CODES)
    )
    reason = F.when(F.coalesce(strip("transaction_id"), F.lit("")) == "", F.lit("transaction_id is missing")).when(
        value.isNull(), F.lit("amount is no number")
    )
    return rows.select(
        strip("transaction_id").alias("source_transaction_id"),
        F.coalesce(strip("client_id"), F.lit("")).alias("source_client_id"),
        stripped("account_id").alias("source_account_id"),
        nothing().alias("source_product_id"),
        channel.alias("channel_code"),
        F.coalesce(stripped("operation_type"), F.lit("PAYMENT")).alias("operation_type_code"),
        F.concat(blank_to_null(day), F.lit(MIDDAY)).alias("operation_ts"),
        number_text(F.abs(value)).alias("amount"),
        cut(strip(or_default("currency", "INR")), 8).alias("currency_code"),
        F.when(value < 0, "D").otherwise("C").alias("direction"),
        F.lit("POSTED").alias("status"),
        stripped("merchant_category").alias("merchant_name"),
        stripped("counterparty").alias("description"),
        *tagged(reason, as_read(rows)),
        *carried(rows),
    )


def tsv_catalog(rows: DataFrame) -> DataFrame:
    """Product catalog: an id that is not all digits becomes 0 (and is not loaded later)."""
    return accepted(read_tsv_catalog(rows))


def read_tsv_catalog(rows: DataFrame) -> DataFrame:
    """The same with refused records, which have no id."""
    number = F.coalesce(strip("product_id"), F.lit(""))
    texts = [c for c in staging_columns("product_catalog_raw") if c != "product_id"]
    reason = F.when(number == "", F.lit("product_id is missing"))
    return rows.select(
        F.when(is_digits(number), number.try_cast("int")).otherwise(0).alias("product_id"),
        *[stripped(c).alias(c) for c in texts],
        *tagged(reason, as_read(rows)),
        *carried(rows),
    )


def _cell(rows: DataFrame, column: str) -> Column:
    """A sheet cell as text; a numeric or boolean cell that is zero counts as empty."""
    value = F.col(column)
    kind = rows.schema[column].dataType
    if isinstance(kind, T.NumericType):
        value = F.when(value != 0, value)
    elif isinstance(kind, T.BooleanType):
        return F.when(value, F.lit("True"))
    return value.cast("string")


def _sheet(rows: DataFrame, table: str, uncut: tuple[str, ...], keep_zero: tuple[str, ...] = ()) -> DataFrame:
    widths = STAGING[table]
    first = next(iter(widths))
    reason = F.when(blank_to_null(F.col(first).cast("string")).isNull(), F.lit(f"{first} is missing"))
    return rows.select(
        *[
            (
                F.col(c).cast("string")
                if c in keep_zero
                else _cell(rows, c)
                if c in uncut
                else cut(_cell(rows, c), widths[c])
            ).alias(c)
            for c in widths
        ],
        *tagged(reason, as_read(rows)),
        *carried(rows),
    )


def crm_campaigns(rows: DataFrame) -> DataFrame:
    """Exported campaign sheet, one row per contacted customer."""
    return accepted(read_crm_campaigns(rows))


def read_crm_campaigns(rows: DataFrame) -> DataFrame:
    """The same with refused rows, whose first cell is empty."""
    return _sheet(rows, "crm_marketing_raw", uncut=(), keep_zero=("age",))


def credit_risk(rows: DataFrame) -> DataFrame:
    """Exported credit card risk sheet."""
    return accepted(read_credit_risk(rows))


def read_credit_risk(rows: DataFrame) -> DataFrame:
    """The same with refused rows, whose first cell is empty."""
    money = ("limit_balance", "bill_amt_m1", "bill_amt_m2", "pay_amt_m1", "pay_amt_m2")
    return _sheet(rows, "credit_risk_raw", uncut=money)
