"""Staging rows → typed core rows.

Every loader returns one DataFrame with the core columns, `load_seq` and
`reject_reason`. A row with a reason does not enter the core table; the caller
writes it to the reject table instead of failing the batch.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import (
    local_date,
    parse_bool,
    parse_date,
    parse_decimal,
    parse_signed,
    parse_timestamp,
    parse_unsigned,
    unreadable,
)
from tallyhouse.functions.text import blank_to_null, cut, or_default, strip, stripped
from tallyhouse.operators.ids import surrogate_ids
from tallyhouse.operators.lookup import lookup as find
from tallyhouse.operators.upsert import apply_to, fold
from tallyhouse.reference_data import ABS, DBO, DEFAULT_PRODUCT_TYPE, dictionary
from tallyhouse.schemas import CORE

UNRESOLVED_CLIENT = "unresolved client"


def _reason(rules: list[tuple[Column, str]]) -> Column:
    chain = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), rules, F)
    return chain.otherwise(F.lit(None).cast("string"))


def _now(now: datetime) -> Column:
    return F.lit(now).cast("timestamp")


def with_client(raw: DataFrame, lookup: DataFrame, source: Column | str = "source_client_id") -> DataFrame:
    """Add `client_id`, NULL where the source id resolves to nobody."""
    people = lookup.select(F.col("source_client_id").alias("__source_client"), "client_id")
    return find(raw, F.col(source) if isinstance(source, str) else source, people, "__source_client")


def dictionary_lookup(rows: DataFrame, code: Column, name: str, id_column: str, code_column: str) -> DataFrame:
    """Add `id_column` for an exact, case-sensitive code; NULL when unknown.

    The dictionary is at most 19 literal rows, hence the broadcast.
    """
    codes = dictionary(rows.sparkSession, name).select(
        F.col(id_column), F.col(code_column).alias("__code")
    )
    return rows.join(F.broadcast(codes), code == F.col("__code"), "left").drop("__code")


def with_reference(rows: DataFrame, key: str, table: DataFrame | None, id_column: str) -> DataFrame:
    """Add `id_column` of the row of `table` whose source key equals `key`, else NULL."""
    if table is None:
        return rows.withColumn(id_column, F.lit(None).cast("bigint"))
    targets = table.select(F.col(key).alias("__source_key"), id_column)
    return find(rows, blank_to_null(key), targets, "__source_key")


def referential_filter(facts: DataFrame, clients: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts whose client exists, and the others with the reason they were dropped."""
    kept = facts.join(clients.select("client_id"), "client_id", "left_semi")
    dropped = facts.join(clients.select("client_id"), "client_id", "left_anti")
    return kept, dropped.withColumn("reject_reason", F.lit(UNRESOLVED_CLIENT))


def accounts(raw: DataFrame, lookup: DataFrame, now: datetime) -> DataFrame:
    rows = with_client(raw, lookup)
    opened, closed = parse_date("opened_at"), parse_date("closed_at")
    return rows.select(
        "load_seq",
        F.lit(ABS).cast("smallint").alias("source_system_id"),
        "source_account_id",
        "client_id",
        "account_number_masked",
        "account_type",
        cut(or_default("currency_code", "RUB"), 3).alias("currency_code"),
        opened.alias("opened_at"),
        closed.alias("closed_at"),
        or_default("status", "ACTIVE").alias("status"),
        _now(now).alias("created_at"),
        _now(now).alias("updated_at"),
        _reason([
            (F.col("client_id").isNull(), UNRESOLVED_CLIENT),
            (unreadable("opened_at", opened), "unreadable opened_at"),
            (unreadable("closed_at", closed), "unreadable closed_at"),
        ]).alias("reject_reason"),
    )


def products(
    raw: DataFrame, lookup: DataFrame, now: datetime, accounts: DataFrame | None = None
) -> DataFrame:
    rows = with_reference(with_client(raw, lookup), "source_account_id", accounts, "account_id")
    rows = dictionary_lookup(
        rows, strip("product_type_code"), "product_types", "product_type_id", "product_type_code"
    )
    opened, closed = parse_date("opened_at"), parse_date("closed_at")
    limit, rate = parse_decimal("amount_limit", 18, 2), parse_decimal("interest_rate", 9, 4)
    return rows.select(
        "load_seq",
        F.lit(ABS).cast("smallint").alias("source_system_id"),
        "source_product_id",
        "client_id",
        "account_id",
        F.coalesce("product_type_id", F.lit(DEFAULT_PRODUCT_TYPE)).cast("smallint").alias("product_type_id"),
        "product_name",
        cut(blank_to_null("currency_code"), 3).alias("currency_code"),
        opened.alias("opened_at"),
        closed.alias("closed_at"),
        or_default("status", "ACTIVE").alias("status"),
        limit.alias("amount_limit"),
        rate.alias("interest_rate"),
        _now(now).alias("created_at"),
        _now(now).alias("updated_at"),
        _reason([
            (F.col("client_id").isNull(), UNRESOLVED_CLIENT),
            (unreadable("opened_at", opened), "unreadable opened_at"),
            (unreadable("closed_at", closed), "unreadable closed_at"),
            (unreadable("amount_limit", limit), "unreadable amount_limit"),
            (unreadable("interest_rate", rate), "unreadable interest_rate"),
        ]).alias("reject_reason"),
    )


def transactions(
    raw: DataFrame,
    lookup: DataFrame,
    now: datetime,
    accounts: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    rows = with_client(raw, lookup)
    rows = with_reference(rows, "source_account_id", accounts, "account_id")
    rows = with_reference(rows, "source_product_id", products, "product_id")
    rows = dictionary_lookup(rows, F.col("channel_code"), "channels", "channel_id", "channel_code")
    rows = dictionary_lookup(
        rows, F.col("operation_type_code"), "operation_types", "operation_type_id", "operation_type_code"
    )
    instant, amount = parse_timestamp("operation_ts"), parse_decimal("amount", 18, 2)
    return rows.select(
        "load_seq",
        F.lit(ABS).cast("smallint").alias("source_system_id"),
        "source_transaction_id",
        "client_id",
        "account_id",
        "product_id",
        "channel_id",
        "operation_type_id",
        instant.alias("operation_ts"),
        local_date("operation_ts").alias("operation_date"),
        F.coalesce(amount, F.lit(0).cast("decimal(18,2)")).alias("amount"),
        cut(or_default("currency_code", "RUB"), 3).alias("currency_code"),
        or_default("direction", "D").alias("direction"),
        "status",
        "merchant_name",
        "description",
        _now(now).alias("created_at"),
        _reason([
            (F.col("client_id").isNull(), UNRESOLVED_CLIENT),
            (stripped("operation_ts").isNull(), "blank operation_ts"),
            (instant.isNull(), "unreadable operation_ts"),
            (unreadable("amount", amount), "unreadable amount"),
        ]).alias("reject_reason"),
    )


def digital_events(raw: DataFrame, lookup: DataFrame, now: datetime) -> DataFrame:
    rows = with_client(raw, lookup)
    rows = dictionary_lookup(rows, strip("channel_code"), "channels", "channel_id", "channel_code")
    rows = dictionary_lookup(
        rows, strip("event_type_code"), "event_types", "event_type_id", "event_type_code"
    )
    instant = parse_timestamp("event_ts")
    payload = F.coalesce(F.to_json(F.try_parse_json("payload_json")), F.lit("{}"))
    return rows.select(
        "load_seq",
        F.lit(DBO).cast("smallint").alias("source_system_id"),
        "source_event_id",
        "client_id",
        "channel_id",
        "event_type_id",
        instant.alias("event_ts"),
        local_date("event_ts").alias("event_date"),
        "device_type",
        "platform",
        "session_id",
        parse_bool("success_flag").alias("success_flag"),
        payload.alias("payload"),
        _now(now).alias("created_at"),
        _reason([
            (F.col("client_id").isNull(), UNRESOLVED_CLIENT),
            (F.col("channel_id").isNull(), "unknown channel"),
            (F.col("event_type_id").isNull(), "unknown event type"),
            (stripped("event_ts").isNull(), "blank event_ts"),
            (instant.isNull(), "unreadable event_ts"),
        ]).alias("reject_reason"),
    )


def appeals(raw: DataFrame, lookup: DataFrame, now: datetime) -> DataFrame:
    rows = with_client(raw, lookup)
    rows = dictionary_lookup(rows, F.col("channel_code"), "channels", "channel_id", "channel_code")
    rows = dictionary_lookup(
        rows, F.col("appeal_type_code"), "appeal_types", "appeal_type_id", "appeal_type_code"
    )
    created, resolved = parse_timestamp("created_ts"), parse_timestamp("resolved_ts")
    return rows.select(
        "load_seq",
        F.lit(ABS).cast("smallint").alias("source_system_id"),
        "source_appeal_id",
        "client_id",
        "channel_id",
        "appeal_type_id",
        created.alias("created_ts"),
        resolved.alias("resolved_ts"),
        or_default("status", "OPEN").alias("status"),
        parse_unsigned("priority", "smallint").alias("priority"),
        "result_text",
        _now(now).alias("created_at"),
        _reason([
            (F.col("client_id").isNull(), UNRESOLVED_CLIENT),
            (stripped("created_ts").isNull(), "blank created_ts"),
            (created.isNull(), "unreadable created_ts"),
            (unreadable("resolved_ts", resolved), "unreadable resolved_ts"),
        ]).alias("reject_reason"),
    )


def product_catalog(raw: DataFrame, now: datetime) -> DataFrame:
    rate, limit = parse_decimal("interest_rate", 12, 4), parse_decimal("credit_limit", 18, 2)
    return raw.select(
        "load_seq",
        F.col("product_id").cast("int").alias("product_id"),
        "product_name",
        "product_group",
        "description",
        rate.alias("interest_rate"),
        limit.alias("credit_limit"),
        F.upper(cut(blank_to_null("active_flag"), 1)).alias("active_flag"),
        "source_system",
        _now(now).alias("created_at"),
        _reason([
            (F.coalesce(F.col("product_id").cast("int"), F.lit(0)) == 0, "no product id"),
            (unreadable("interest_rate", rate), "unreadable interest_rate"),
            (unreadable("credit_limit", limit), "unreadable credit_limit"),
        ]).alias("reject_reason"),
    )


def marketing_leads(raw: DataFrame, lookup: DataFrame, now: datetime) -> DataFrame:
    rows = with_client(raw, lookup, strip("customer_id"))
    contacted = parse_date("last_contact_date")
    return rows.select(
        "load_seq",
        "client_id",
        "campaign_id",
        parse_unsigned("age").alias("age"),
        "job",
        "marital",
        "education",
        "default_flag",
        "housing_loan",
        "personal_loan",
        "contact_channel",
        contacted.alias("last_contact_date"),
        parse_unsigned("campaign_contacts").alias("campaign_contacts"),
        "previous_outcome",
        "term_deposit_subscribed",
        _now(now).alias("created_at"),
        _reason([
            (blank_to_null("campaign_id").isNull(), "no campaign id"),
            (F.col("client_id").isNull(), UNRESOLVED_CLIENT),
            (unreadable("last_contact_date", contacted), "unreadable last_contact_date"),
        ]).alias("reject_reason"),
    )


def credit_risk(raw: DataFrame, lookup: DataFrame, now: datetime) -> DataFrame:
    rows = with_client(raw, lookup, strip("customer_id"))
    amounts = ("limit_balance", "bill_amt_m1", "bill_amt_m2", "pay_amt_m1", "pay_amt_m2")
    money = {c: parse_decimal(c, 18, 2) for c in amounts}
    return rows.select(
        "load_seq",
        "client_id",
        strip("customer_id").alias("source_customer_id"),
        money["limit_balance"].alias("limit_balance"),
        "sex",
        "education",
        "marriage",
        parse_unsigned("age").alias("age"),
        parse_signed("pay_status_m1").alias("pay_status_m1"),
        parse_signed("pay_status_m2").alias("pay_status_m2"),
        money["bill_amt_m1"].alias("bill_amt_m1"),
        money["bill_amt_m2"].alias("bill_amt_m2"),
        money["pay_amt_m1"].alias("pay_amt_m1"),
        money["pay_amt_m2"].alias("pay_amt_m2"),
        parse_unsigned("default_next_month", "smallint").alias("default_next_month"),
        _now(now).alias("created_at"),
        _reason([
            (F.col("client_id").isNull(), UNRESOLVED_CLIENT),
            *[(unreadable(c, money[c]), f"unreadable {c}") for c in amounts],
        ]).alias("reject_reason"),
    )


def folded(table: str, typed: DataFrame, after: int = 0) -> DataFrame:
    """Accepted rows numbered in load order, one per key, in the core table's shape."""
    spec = CORE[table]
    rows = typed.where("reject_reason IS NULL").drop("reject_reason")
    if spec.id and spec.id not in rows.columns:
        rows = surrogate_ids(rows, spec.id, after=after)
    return fold(rows.select("load_seq", *spec.columns), spec.key, spec.updates).select(*spec.columns)


def into_core(
    table: str, typed: DataFrame, after: int = 0, target: DataFrame | None = None
) -> DataFrame:
    """The core table after this batch."""
    batch, spec = folded(table, typed, after), CORE[table]
    return batch if target is None else apply_to(target, batch, spec.key, spec.updates)


def rejects(table: str, typed: DataFrame) -> DataFrame:
    """Refused rows: table, position, reason and the row itself as JSON."""
    body = [c for c in typed.columns if c not in ("load_seq", "reject_reason")]
    return typed.where("reject_reason IS NOT NULL").select(
        F.lit(table).alias("table_name"),
        "load_seq",
        "reject_reason",
        F.to_json(F.struct(*body)).alias("row_json"),
    )
