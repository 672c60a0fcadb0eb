from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import marts, profile, segments
from tallyhouse.plans import serving
from tallyhouse.schemas import CORE

RD = date(2024, 1, 30)


def ago(days):
    return RD - timedelta(days=days)


METRICS = "client_id bigint, anchor_date date, op_30 int, turnover_30 decimal(18,2), last_tx_ts timestamp, last_ev_ts timestamp, ev_30 int, active_products int"


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({"anchor": ago(90)}, 3),
        ({"anchor": ago(91)}, 2),
        ({"anchor": ago(-5)}, 3),
        ({"tx": None, "ev": None}, 4),
        ({"tx": ago(180)}, 2),
        ({"tx": ago(181)}, 4),
        ({"tx": ago(181), "ev": ago(180)}, 2),
        ({"tx": ago(400), "turnover": 300000}, 4),
        ({"turnover": Decimal("249999.99")}, 1),
        ({"turnover": 250000}, 5),
        ({"op": 11}, 1),
        ({"op": 12}, 5),
        ({"products": 3}, 2),
        ({"products": 4}, 5),
        ({"op": 3}, 1),
        ({"ev": ago(1), "ev_30": 6}, 1),
        ({"ev_30": 5}, 2),
        ({"turnover": 15000}, 1),
        ({"turnover": Decimal("14999.99")}, 2),
        ({"anchor": None, "tx": None, "ev": None}, 2),
    ],
)
def test_segment_rules_at_their_limits(rows, changes, expected):
    base = {"anchor": ago(1000), "op": 0, "turnover": 0, "tx": ago(10), "ev": None, "ev_30": 0, "products": 0}
    v = {**base, **changes}

    def stamp(day):
        return None if day is None else datetime(day.year, day.month, day.day, 23, 59)

    frame = rows(METRICS, (1, v["anchor"], v["op"], Decimal(v["turnover"]), stamp(v["tx"]), stamp(v["ev"]), v["ev_30"], v["products"]))
    assert segments.classify(frame, RD).first().segment_type_id == expected


TX = "client_id bigint, operation_date date, operation_ts timestamp, direction string, amount decimal(18,2), channel_id smallint, operation_type_id smallint"


def test_windows_differ_between_segments_and_profile(rows):
    def t(day, direction="D", amount=1):
        return (1, day, datetime(day.year, day.month, day.day), direction, Decimal(amount), 1, 1)

    tx = rows(TX, t(ago(31)), t(ago(30)), t(RD, "C", 5), t(ago(-1), "D", 100), t(RD, "X", 9))
    w = segments.tx_window(tx, RD).first()
    assert (w.op_30, w.debit_30, w.credit_30) == (3, Decimal(1), Decimal(5))
    p = profile.profile_transactions(tx, RD).first()
    assert (p.operations_cnt_30d, p.debit_turnover_30d, p.credit_turnover_30d) == (4, Decimal(101), Decimal(5))
    assert p.last_transaction_ts == datetime(2024, 1, 31)
    assert segments.last_transaction(tx).first().last_tx_ts == datetime(2024, 1, 31)


def test_anchor_falls_back_to_the_utc_creation_day(rows):
    clients = rows("client_id bigint, registration_date date, created_at timestamp", (1, None, datetime(2023, 5, 1, 23, 30)), (2, RD, datetime(2020, 1, 1)))
    tx = rows(TX)
    ev = rows("client_id bigint, event_date date, event_ts timestamp")
    pr = rows("client_id bigint, status string", (2, "ACTIVE"), (2, "CLOSED"))
    got = {r.client_id: r for r in segments.client_metrics(clients, tx, ev, pr, RD).collect()}
    assert got[1].anchor_date == date(2023, 5, 1) and got[2].anchor_date == RD
    assert (got[1].op_30, got[1].turnover_30, got[1].active_products, got[2].active_products) == (0, 0, 0, 1)


def test_segment_history_replaces_only_its_own_rows(rows):
    history = rows(
        CORE["client_segments_history"].schema,
        (3, 1, 2, None, ago(5), None, True, "MANUAL"), (9, 1, 2, None, ago(5), None, True, "ETL_SEGMENTATION"),
        (4, 2, 1, None, ago(5), None, True, None),
    )
    classified = rows("client_id bigint, segment_type_id smallint", (2, 5), (1, 4))
    got = sorted((r.segment_history_id, r.client_id, r.segment_type_id, r.assigned_by) for r in
                 segments.segment_history(classified, RD, history).collect())
    assert got == [(3, 1, 2, "MANUAL"), (4, 2, 1, None), (5, 1, 4, "ETL_SEGMENTATION"), (6, 2, 5, "ETL_SEGMENTATION")]


def test_current_segment_is_the_latest_current_row(rows):
    history = rows(
        CORE["client_segments_history"].schema,
        (1, 1, 2, None, ago(5), None, True, "a"), (2, 1, 3, None, ago(1), None, False, "a"),
        (3, 1, 4, None, ago(3), None, True, "a"), (4, 1, 5, None, ago(3), None, True, "a"),
    )
    assert [(r.client_id, r.current_segment_type_id) for r in profile.profile_current_segment(history).collect()] == [(1, 5)]


def facts(spark, seed):
    rng = random.Random(seed)

    def day():
        return ago(rng.randrange(-2, 40))

    tx, ev, ap = [], [], []
    for _ in range(300):
        d = day()
        tx.append((rng.randrange(5), d, datetime(d.year, d.month, d.day), rng.choice("DCX"), Decimal(rng.randrange(100)),
                   rng.choice([1, 4, 99, None]), rng.choice([1, 77, None])))
        d = day()
        ev.append((rng.randrange(5), d, datetime(d.year, d.month, d.day), rng.choice([1, 4, 99]), rng.choice([1, 99]),
                   rng.choice([True, False, None])))
        d = day()
        ap.append((rng.randrange(5), datetime(d.year, d.month, d.day, 23), rng.choice([1, None])))
    return (
        spark.createDataFrame(tx, TX),
        spark.createDataFrame(ev, "client_id bigint, event_date date, event_ts timestamp, channel_id smallint, event_type_id smallint, success_flag boolean"),
        spark.createDataFrame(ap, "client_id bigint, created_ts timestamp, channel_id smallint"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_activity_mart_equals_union_and_three_joins(spark, seed):
    tx, ev, ap = facts(spark, seed)
    d0, d1 = ago(30), RD
    key = list(marts.DAILY_KEY)
    parts = [
        marts.activity_tx_daily(tx, d0, d1), marts.activity_events_daily(ev, d0, d1),
        marts.activity_appeals_daily(ap, d0, d1),
    ]
    keys = parts[0].select(key).union(parts[1].select(key)).union(parts[2].select(key)).distinct()
    for part in parts:
        keys = keys.join(part, key, "left")
    measures = [F.coalesce(c, F.lit(0)).cast(k).alias(c) for c, k in marts.ACTIVITY_MEASURES.items()]
    literal = keys.select(*key, *measures)
    got = marts.client_activity_daily(tx, ev, ap, d0, d1).select(literal.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, literal.collect()))
    assert got.where(~F.col("activity_date").between(d0, d1)).count() == 0
    assert {r[0] for r in got.select("channel_code").distinct().collect()} == {"BRANCH", "MB", "UNKNOWN"}


def test_daily_marts_add_up_to_the_facts(spark):
    tx, ev, _ = facts(spark, 3)
    d0, d1 = ago(1000), ago(-10)
    fin = marts.financial_activity_daily(tx, d0, d1)
    total = fin.agg(F.sum("operation_cnt"), F.sum("debit_amount"), F.sum("credit_amount")).first()
    debit = tx.where("direction = 'D'").agg(F.sum("amount")).first()[0]
    credit = tx.where("direction = 'C'").agg(F.sum("amount")).first()[0]
    assert tuple(total) == (300, debit, credit)
    dig = marts.digital_activity_daily(ev, d0, d1)
    total = dig.agg(F.sum("event_cnt"), F.sum("success_cnt"), F.sum("fail_cnt")).first()
    assert tuple(total) == (300, ev.where("success_flag").count(), ev.where("NOT success_flag").count())


PROFILE = CORE["client_profile_export"].schema


def profile_row(day, client, segment=None, ops=0, events=0, debit=0):
    return (day, client, f"k{client}", "INDIVIDUAL", "ACTIVE", None, 0, 0, Decimal(debit), Decimal(0), ops, events, 0,
            datetime(2024, 1, 1, 1, 2, 3, 456789), None, segment)


def test_segment_metrics_and_view(rows):
    export = rows(PROFILE, profile_row(RD, 1, 1, ops=1, debit=5), profile_row(RD, 2, 1, ops=2), profile_row(RD, 3, None, events=1),
                  profile_row(RD, 4, 77), profile_row(ago(1), 5, 1))
    got = {r.segment_type_id: r for r in marts.segment_metrics(export, RD).collect()}
    assert {k: (r.clients_cnt, r.active_clients_30d, r.total_operations_30d, r.total_debit_turnover_30d, r.avg_operations_per_client)
            for k, r in got.items()} == {0: (1, 1, 0, 0, 0.0), 1: (2, 2, 3, 5, 1.5), 77: (1, 0, 0, 0, 0.0)}
    mart = marts.client_profile(export, RD)
    assert mart.first().last_transaction_ts == datetime(2024, 1, 1, 1, 2, 3, 456000)
    labels = {r.client_id: (r.segment_type_code, r.segment_type_name) for r in marts.segmentation_view(mart).collect()}
    assert labels == {1: ("ACTIVE", labels[1][1]), 2: ("ACTIVE", labels[1][1]), 3: ("UNKNOWN", "Не задан"), 4: ("UNKNOWN", "Не задан")}


def test_serving(rows):
    mart = rows(PROFILE, *[profile_row(RD, i, 2) for i in range(1, 8)], profile_row(ago(1), 8, 3), profile_row(ago(1), 1, 5))
    assert [r.client_id for r in serving.client_profile(mart, limit=3, offset=2).collect()] == [3, 4, 5]
    assert [r.client_id for r in serving.client_profile(mart, ago(1)).collect()] == [1, 8]
    assert serving.client_profile(mart, client_id=8).collect() == []
    assert serving.require_one(serving.client_profile_one(mart, 8)).report_date == ago(1)
    assert serving.require_one(serving.client_profile_one(mart, 1)).report_date == RD
    assert serving.require_one(serving.client_profile_one(mart, 1, ago(1))).current_segment_type_id == 5
    with pytest.raises(serving.NotFound):
        serving.require_one(serving.client_profile_one(mart, 99))
    got = serving.client_segmentation(mart, limit=2).collect()
    assert [(r.client_id, r.segment_type_code) for r in got] == [(1, "LOW_ACTIVITY"), (2, "LOW_ACTIVITY")]
    shown = serving.as_json_numbers(mart)
    assert dict(shown.dtypes)["debit_turnover_30d"] == "double" and dict(shown.dtypes)["client_id"] == "bigint"
    for bad in (0, 2001):
        with pytest.raises(ValueError):
            serving.client_profile(mart, limit=bad)
    with pytest.raises(ValueError):
        serving.client_profile(mart, offset=-1)


def test_daily_serving(spark):
    tx, ev, ap = facts(spark, 4)
    mart = marts.client_activity_daily(tx, ev, ap, ago(30), RD)
    got = [(r.activity_date, r.client_id, r.channel_code) for r in serving.client_activity_daily(mart, ago(10), RD, limit=2000).collect()]
    assert got == sorted(got) and got[0][0] >= ago(10)
    assert serving.client_activity_daily(mart, RD, ago(10)).collect() == []
    paged = [r for o in (0, 7) for r in serving.client_activity_daily(mart, ago(10), RD, limit=7, offset=o).collect()]
    assert [(r.activity_date, r.client_id, r.channel_code) for r in paged] == got[:14]
    assert {r.client_id for r in serving.client_activity_daily(mart, ago(10), RD, client_id=2).collect()} == {2}
    serving.client_activity_daily(mart, ago(400), RD)
    with pytest.raises(ValueError):
        serving.client_activity_daily(mart, ago(401), RD)
