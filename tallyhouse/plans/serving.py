"""Read queries over the marts, as DataFrames.

Paging is part of the query: a page is a top-k by the stated order.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.marts import segmentation_view

# Page and range limits.
DEFAULT_LIMIT, MAX_LIMIT = 200, 2000
MAX_RANGE_DAYS = 400


class NotFound(LookupError):
    """The asked client has no row."""


def page(rows: DataFrame, order: list[str], limit: int, offset: int) -> DataFrame:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return rows.orderBy(*order).offset(offset).limit(limit)


def at_date(mart: DataFrame, report_date: date | None) -> DataFrame:
    """Rows of one report date, by default the latest one in the mart."""
    wanted: Column = (
        F.lit(report_date)
        if report_date is not None
        else mart.select(F.max("report_date")).scalar()
    )
    return mart.where(F.col("report_date") == wanted)


def of_client(mart: DataFrame, client_id: int | None) -> DataFrame:
    return mart if client_id is None else mart.where(F.col("client_id") == client_id)


def client_profile(
    mart: DataFrame,
    report_date: date | None = None,
    client_id: int | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> DataFrame:
    return page(of_client(at_date(mart, report_date), client_id), ["client_id"], limit, offset)


def client_profile_one(
    mart: DataFrame, client_id: int, report_date: date | None = None
) -> DataFrame:
    """The client's row at a date, else at that client's own latest date."""
    rows = of_client(mart, client_id)
    if report_date is not None:
        rows = rows.where(F.col("report_date") == F.lit(report_date))
    return rows.orderBy(F.desc("report_date")).limit(1)


def require_one(rows: DataFrame) -> T.Row:
    row = rows.first()
    if row is None:
        raise NotFound("no such record")
    return row


def client_segmentation(
    mart: DataFrame,
    report_date: date | None = None,
    client_id: int | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> DataFrame:
    """A profile page with segment labels; only the page is labelled."""
    rows = client_profile(mart, report_date, client_id, limit, offset)
    return segmentation_view(rows).orderBy("client_id")


def segment_metrics(mart: DataFrame, report_date: date | None = None) -> DataFrame:
    return at_date(mart, report_date).orderBy("segment_type_id")


def _daily(
    mart: DataFrame,
    order: list[str],
    date_from: date,
    date_to: date,
    client_id: int | None,
    limit: int,
    offset: int,
) -> DataFrame:
    if (date_to - date_from).days > MAX_RANGE_DAYS:
        raise ValueError(f"the range may span at most {MAX_RANGE_DAYS} days")
    day = F.col("activity_date")
    rows = mart.where((day >= F.lit(date_from)) & (day <= F.lit(date_to)))
    return page(of_client(rows, client_id), order, limit, offset)


def client_activity_daily(
    mart: DataFrame,
    date_from: date,
    date_to: date,
    client_id: int | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> DataFrame:
    order = ["activity_date", "client_id", "channel_code"]
    return _daily(mart, order, date_from, date_to, client_id, limit, offset)


def financial_activity_daily(
    mart: DataFrame,
    date_from: date,
    date_to: date,
    client_id: int | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> DataFrame:
    order = ["activity_date", "client_id", "channel_code", "operation_type_code"]
    return _daily(mart, order, date_from, date_to, client_id, limit, offset)


def digital_activity_daily(
    mart: DataFrame,
    date_from: date,
    date_to: date,
    client_id: int | None = None,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
) -> DataFrame:
    order = ["activity_date", "client_id", "channel_code", "event_type_code"]
    return _daily(mart, order, date_from, date_to, client_id, limit, offset)


def as_json_numbers(rows: DataFrame) -> DataFrame:
    """Decimals leave the warehouse as floating point."""
    return rows.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in rows.schema.fields
        ]
    )
