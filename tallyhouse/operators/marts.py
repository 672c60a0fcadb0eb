"""Mart queries over the core tables and the profile snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import utc_date
from tallyhouse.operators.segments import amount_of
from tallyhouse.reference_data import UNKNOWN_SEGMENT, dictionary
from tallyhouse.schemas import CORE

UNKNOWN = "UNKNOWN"
DAILY_KEY = ("activity_date", "client_id", "channel_code")
ACTIVITY_MEASURES = {
    "operations_cnt": "bigint",
    "debit_amount": "decimal(18,2)",
    "credit_amount": "decimal(18,2)",
    "digital_events_cnt": "bigint",
    "digital_success_cnt": "bigint",
    "digital_fail_cnt": "bigint",
    "appeals_opened_cnt": "bigint",
}


def _between(day: Column, d0: date, d1: date) -> Column:
    return (day >= F.lit(d0)) & (day <= F.lit(d1))


def _code(rows: DataFrame, name: str, id_column: str, code_column: str) -> DataFrame:
    """Dictionary code for an id, 'UNKNOWN' when the id is NULL or not listed."""
    codes = dictionary(rows.sparkSession, name).select(id_column, F.col(code_column).alias("__code"))
    return (
        rows.join(F.broadcast(codes), id_column, "left")
        .withColumn(code_column, F.coalesce("__code", F.lit(UNKNOWN)))
        .drop("__code")
    )


def _daily(rows: DataFrame, day: Column, d0: date, d1: date) -> DataFrame:
    """Rows of the range with their date and channel code."""
    in_range = rows.where(_between(day, d0, d1)).withColumn("activity_date", day)
    return _code(in_range, "channels", "channel_id", "channel_code")


def client_profile(export: DataFrame, report_date: date) -> DataFrame:
    """The slice of one report date; sub-millisecond digits do not reach the mart."""
    return export.where(F.col("report_date") == F.lit(report_date)).select(
        *[
            F.date_trunc("MILLISECOND", c).alias(c) if c.endswith("_ts") else F.col(c)
            for c in CORE["client_profile_export"].columns
        ]
    )


def segment_metrics(export: DataFrame, report_date: date) -> DataFrame:
    operations = F.sum(F.col("operations_cnt_30d").cast("bigint"))
    active = (F.col("operations_cnt_30d") > 0) | (F.col("digital_events_cnt_30d") > 0)

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(24,2)")

    return (
        export.where(F.col("report_date") == F.lit(report_date))
        .groupBy(F.coalesce("current_segment_type_id", F.lit(0)).cast("int").alias("segment_type_id"))
        .agg(
            F.count("*").alias("clients_cnt"),
            F.count_if(active).alias("active_clients_30d"),
            total("debit_turnover_30d").alias("total_debit_turnover_30d"),
            total("credit_turnover_30d").alias("total_credit_turnover_30d"),
            F.coalesce(operations, F.lit(0)).alias("total_operations_30d"),
            (operations.cast("double") / F.count("*")).cast("float").alias("avg_operations_per_client"),
        )
        .select(F.lit(report_date).alias("report_date"), "*")
    )


def _tx_measures() -> list[Column]:
    return [
        F.count("*").alias("operations_cnt"),
        amount_of("D").cast("decimal(18,2)").alias("debit_amount"),
        amount_of("C").cast("decimal(18,2)").alias("credit_amount"),
    ]


def _event_measures(total: str, success: str, fail: str) -> list[Column]:
    """NULL outcomes count as events but neither as success nor as failure."""
    return [
        F.count("*").alias(total),
        F.count_if(F.col("success_flag")).alias(success),
        F.count_if(~F.col("success_flag")).alias(fail),
    ]


def activity_tx_daily(transactions: DataFrame, d0: date, d1: date) -> DataFrame:
    daily = _daily(transactions, F.col("operation_date"), d0, d1)
    return daily.groupBy(*DAILY_KEY).agg(*_tx_measures())


def activity_events_daily(events: DataFrame, d0: date, d1: date) -> DataFrame:
    daily = _daily(events, F.col("event_date"), d0, d1)
    measures = _event_measures("digital_events_cnt", "digital_success_cnt", "digital_fail_cnt")
    return daily.groupBy(*DAILY_KEY).agg(*measures)


def activity_appeals_daily(appeals: DataFrame, d0: date, d1: date) -> DataFrame:
    daily = _daily(appeals, utc_date("created_ts"), d0, d1)
    return daily.groupBy(*DAILY_KEY).agg(F.count("*").alias("appeals_opened_cnt"))


def client_activity_daily(
    transactions: DataFrame, events: DataFrame, appeals: DataFrame, d0: date, d1: date
) -> DataFrame:
    """All three activities by date, client and channel.

    The feeds are stacked row by row with zeros in each other's measures and summed
    once: one shuffle, with map-side partial sums, in place of three aggregations, a
    distinct union of their keys and three joins back.
    """

    def stack(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
        return rows.select(
            *DAILY_KEY,
            *[
                measures.get(name, F.lit(0)).cast(kind).alias(name)
                for name, kind in ACTIVITY_MEASURES.items()
            ],
        )

    def one_if(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    def amount(direction: str) -> Column:
        return F.when(F.col("direction") == direction, F.col("amount")).otherwise(F.lit(0))

    tx = stack(
        _daily(transactions, F.col("operation_date"), d0, d1),
        {"operations_cnt": F.lit(1), "debit_amount": amount("D"), "credit_amount": amount("C")},
    )
    ev = stack(
        _daily(events, F.col("event_date"), d0, d1),
        {
            "digital_events_cnt": F.lit(1),
            "digital_success_cnt": one_if(F.col("success_flag")),
            "digital_fail_cnt": one_if(~F.col("success_flag")),
        },
    )
    ap = stack(
        _daily(appeals, utc_date("created_ts"), d0, d1), {"appeals_opened_cnt": F.lit(1)}
    )
    return (
        tx.unionByName(ev)
        .unionByName(ap)
        .groupBy(*DAILY_KEY)
        .agg(*[F.sum(name).cast(kind).alias(name) for name, kind in ACTIVITY_MEASURES.items()])
    )


def financial_activity_daily(transactions: DataFrame, d0: date, d1: date) -> DataFrame:
    daily = _code(
        _daily(transactions, F.col("operation_date"), d0, d1),
        "operation_types", "operation_type_id", "operation_type_code",
    )
    _, *amounts = _tx_measures()
    return daily.groupBy(*DAILY_KEY, "operation_type_code").agg(
        F.count("*").alias("operation_cnt"), *amounts
    )


def digital_activity_daily(events: DataFrame, d0: date, d1: date) -> DataFrame:
    daily = _code(
        _daily(events, F.col("event_date"), d0, d1),
        "event_types", "event_type_id", "event_type_code",
    )
    return daily.groupBy(*DAILY_KEY, "event_type_code").agg(
        *_event_measures("event_cnt", "success_cnt", "fail_cnt")
    )


def segmentation_view(profile: DataFrame) -> DataFrame:
    """Profile rows with the segment label; no or an unlisted segment reads as unknown."""
    code, name = UNKNOWN_SEGMENT
    labels = dictionary(profile.sparkSession, "segment_labels").select(
        F.col("segment_type_id").alias("__id"), "segment_type_code", "segment_type_name"
    )
    segment = F.coalesce(F.col("current_segment_type_id").cast("int"), F.lit(0))
    return (
        profile.join(F.broadcast(labels), segment == F.col("__id"), "left")
        .withColumn("segment_type_code", F.coalesce("segment_type_code", F.lit(code)))
        .withColumn("segment_type_name", F.coalesce("segment_type_name", F.lit(name)))
        .drop("__id")
    )
