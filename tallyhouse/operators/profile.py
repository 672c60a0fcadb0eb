"""Client profile snapshot of one report date.

The counters over a window start 30 (90 for appeals) days before the report date
and, unlike the segment rules, have no upper bound.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import utc_date
from tallyhouse.operators.segments import WINDOW_DAYS, amount_of, days_before
from tallyhouse.schemas import CORE

APPEAL_DAYS = 90


def _active_count(table: DataFrame, name: str) -> DataFrame:
    return (
        table.where("status = 'ACTIVE'")
        .groupBy("client_id")
        .agg(F.count("*").cast("int").alias(name))
    )


def profile_accounts(accounts: DataFrame) -> DataFrame:
    return _active_count(accounts, "active_accounts_cnt")


def profile_products(products: DataFrame) -> DataFrame:
    return _active_count(products, "active_products_cnt")


def profile_transactions(transactions: DataFrame, report_date: date) -> DataFrame:
    return (
        transactions.where(F.col("operation_date") >= days_before(report_date, WINDOW_DAYS))
        .groupBy("client_id")
        .agg(
            amount_of("D").cast("decimal(18,2)").alias("debit_turnover_30d"),
            amount_of("C").cast("decimal(18,2)").alias("credit_turnover_30d"),
            F.count("*").cast("int").alias("operations_cnt_30d"),
            F.max("operation_ts").alias("last_transaction_ts"),
        )
    )


def profile_events(events: DataFrame, report_date: date) -> DataFrame:
    return (
        events.where(F.col("event_date") >= days_before(report_date, WINDOW_DAYS))
        .groupBy("client_id")
        .agg(
            F.count("*").cast("int").alias("digital_events_cnt_30d"),
            F.max("event_ts").alias("last_digital_event_ts"),
        )
    )


def profile_appeals(appeals: DataFrame, report_date: date) -> DataFrame:
    return (
        appeals.where(utc_date("created_ts") >= days_before(report_date, APPEAL_DAYS))
        .groupBy("client_id")
        .agg(F.count("*").cast("int").alias("appeals_cnt_90d"))
    )


def profile_current_segment(history: DataFrame) -> DataFrame:
    """The current row with the latest start per client; ties go to the later id."""
    return (
        history.where("is_current")
        .groupBy("client_id")
        .agg(
            F.max(F.struct("effective_from", "segment_history_id", "segment_type_id")).alias("__top")
        )
        .select("client_id", F.col("__top.segment_type_id").alias("current_segment_type_id"))
    )


def profile_export(
    clients: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    events: DataFrame,
    appeals: DataFrame,
    history: DataFrame,
    report_date: date,
) -> DataFrame:
    """One row per client.

    Every side is aggregated to one row per client and hash-partitioned by it, so
    the joins add no shuffle beyond the aggregations' own.
    """
    spec = CORE["client_profile_export"]
    joined = (
        clients.select(
            "client_id", "unified_client_key", "client_type", "status", "region_code"
        )
        .join(profile_accounts(accounts), "client_id", "left")
        .join(profile_products(products), "client_id", "left")
        .join(profile_transactions(transactions, report_date), "client_id", "left")
        .join(profile_events(events, report_date), "client_id", "left")
        .join(profile_appeals(appeals, report_date), "client_id", "left")
        .join(profile_current_segment(history), "client_id", "left")
    )
    counters = [c for c in spec.columns if c.endswith(("_cnt", "_30d", "_90d"))]
    filled = joined.fillna(0, subset=[c for c in counters if not c.endswith("turnover_30d")])
    for c in ("debit_turnover_30d", "credit_turnover_30d"):
        filled = filled.withColumn(c, F.coalesce(c, F.lit(0).cast("decimal(18,2)")))
    return filled.withColumn("report_date", F.lit(report_date)).select(*spec.columns)
