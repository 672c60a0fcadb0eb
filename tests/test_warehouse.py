from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from tallyhouse.plans import load, serving
from tallyhouse.plans.warehouse import Warehouse, read_dates, replace_dates
from tallyhouse.schemas import CORE, STAGING
from tallyhouse.session import scratch_root
from tallyhouse.sources.files import children

RD = date(2026, 4, 1)
NOW = datetime(2026, 4, 1, 12)
DAY = "day date, client_id bigint, n int"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def stored(spark, folder):
    frame = read_dates(spark, folder, DAY, "day")
    return sorted((r.day, r.client_id, r.n) for r in frame.collect())


def test_replace_drops_stale_days_and_keeps_the_rest(spark, rows, tmp_path):
    folder = str(tmp_path / "mart")
    days = [RD + timedelta(days=i) for i in range(6)]
    first = rows(DAY, *[(d, c, 1) for d in days for c in (1, 2)])
    assert replace_dates(first, folder, "day", days[0], days[-1], ("client_id",)) == 12
    # Only day 2 has new rows; a row outside the range is not written.
    second = rows(DAY, (days[2], 7, 2), (days[5], 9, 9))
    assert replace_dates(second, folder, "day", days[1], days[3], ("client_id",)) == 1
    kept = [(d, c, 1) for d in (days[0], days[4], days[5]) for c in (1, 2)]
    assert stored(spark, folder) == sorted([*kept, (days[2], 7, 2)])
    assert replace_dates(rows(DAY), folder, "day", days[0], days[5], ("client_id",)) == 0
    assert stored(spark, folder) == []


def test_replacing_twice_is_idempotent(spark, rows, tmp_path):
    folder = str(tmp_path / "mart")
    data = rows(DAY, (RD, 1, 1), (RD, 2, 1))
    for _ in range(2):
        replace_dates(data, folder, "day", RD, RD, ("client_id",))
    assert stored(spark, folder) == [(RD, 1, 1), (RD, 2, 1)]


def test_a_state_without_its_commit_mark_is_ignored(spark, rows, warehouse):
    schema = CORE["load_batch"].schema
    one = rows(schema, (1, "s", NOW, None, "RUNNING", None))
    warehouse.write_core("load_batch", one)
    warehouse.write_core("load_batch", one.unionByName(one))
    # A later version left behind by a job that died.
    half = warehouse.path("core", "load_batch", "v=3")
    one.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert warehouse.versions("load_batch") == [1, 2]
    assert warehouse.core("load_batch").count() == 2
    # The next state may be computed from the current one, and old ones go away.
    warehouse.write_core("load_batch", warehouse.core("load_batch").limit(1))
    warehouse.write_core("load_batch", warehouse.core("load_batch"))
    assert warehouse.versions("load_batch") == [3, 4]
    assert warehouse.core("load_batch").count() == 1


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


FILES = {
    "abs_clients.csv": """source_client_id,client_type,first_name,last_name,middle_name,birth_date,registration_date,tax_id,phone,email,region_code,status
B-1,INDIVIDUAL,Олег,Орлов,Ильич,1985-01-02,2020-02-03,500,+1,o@x,50,ACTIVE
B-2,,Anna,Berg,,1990-03-04,2021-04-05,600,+2,a@x,60,
B-3,INDIVIDUAL,Олег,Орлов,,1985-01-02,2020-02-03, 500 ,+9,,50,ACTIVE
""",
    "crm_clients.csv": "source_client_id,tax_id,phone,email,region_code,loyalty_tier\nR-1,600,+2,a@x,60,GOLD\nR-2,700,+7,,70,\n",
    "abs_accounts.csv": """source_account_id,source_client_id,account_number_masked,account_type,currency_code,opened_at,closed_at,status
K-1,B-1,****1,CURRENT,RUB,2020-02-03,,ACTIVE
K-2,B-3,****2,SAVINGS,,2020-02-03,,ACTIVE
K-3,B-2,****3,CURRENT,USD,2021-04-05,2025-01-01,CLOSED
""",
    "abs_products.csv": """source_product_id,source_client_id,source_account_id,product_type_code,product_name,currency_code,opened_at,closed_at,status,amount_limit,interest_rate
D-1,B-1,K-1,CARD,"Card, gold",RUB,2020-02-03,,ACTIVE,"1000,50",
D-2,B-2,K-3,LOAN,Loan,RUB,2021-04-05,,ACTIVE,,4.25
""",
    "abs_transactions.csv": """source_transaction_id,source_client_id,source_account_id,source_product_id,channel_code,operation_type_code,operation_ts,amount,currency_code,direction,status,merchant_name,description
T-1,B-1,K-1,D-1,MB,PAYMENT,2026-03-20T01:30:00+03:00,1200.25,RUB,D,POSTED,CAFE,
T-2,B-3,K-2,,IB,TRANSFER,2026-03-21T10:00:00+03:00,300,RUB,D,POSTED,,
T-3,B-2,K-3,D-2,BRANCH,CASH_IN,2026-03-05T12:00:00+03:00,20000,RUB,C,POSTED,,
T-4,nobody,,,MB,PAYMENT,2026-03-05T12:00:00+03:00,1,RUB,C,POSTED,,
T-5,B-2,,,MB,PAYMENT,someday,1,RUB,C,POSTED,,
""",
    "dbo_events.csv": """source_event_id,source_client_id,channel_code,event_type_code,event_ts,device_type,platform,session_id,success_flag,payload_json
E-1,B-1,MB,LOGIN,2026-03-20T01:00:00+03:00,PHONE,iOS,s1,true,"{""screen"":""main""}"
E-2,B-2,IB,SCREEN_VIEW,2026-03-06T09:00:00+03:00,DESKTOP,Web,s2,false,
""",
    "appeals.csv": """source_appeal_id,source_client_id,channel_code,appeal_type_code,created_ts,resolved_ts,status,priority,result_text
Q-1,B-1,CC,SUPPORT,2026-03-02T01:00:00+03:00,,OPEN,2,limit
""",
}


@pytest.fixture
def feeds(tmp_path):
    folder = tmp_path / "sample"
    folder.mkdir()
    for name, body in FILES.items():
        (folder / name).write_text(body)
    return str(folder)


def snapshot(warehouse, *tables):
    return {t: sorted(map(str, warehouse.core(t).collect())) for t in tables}



def test_from_files_to_marts(spark, warehouse, feeds):
    written = load.run_daily(warehouse, [feeds], RD, now=NOW)
    profile = {r.client_id: r for r in warehouse.mart("mart_client_profile").collect()}
    assert {
        k: (r.active_accounts_cnt, r.active_products_cnt, r.debit_turnover_30d, r.credit_turnover_30d, r.operations_cnt_30d,
            r.digital_events_cnt_30d, r.appeals_cnt_90d, r.last_transaction_ts, r.current_segment_type_id)
        for k, r in profile.items()
    } == {
        1: (2, 1, Decimal("1500.25"), 0, 2, 1, 1, datetime(2026, 3, 21, 7), 2),
        2: (0, 1, 0, Decimal("20000.00"), 1, 1, 0, datetime(2026, 3, 5, 9), 1),
        3: (0, 0, 0, 0, 0, 0, 0, None, 3),
    }
    got = sorted(tuple(r)[:10] for r in warehouse.mart("mart_client_activity_daily").select(
        "activity_date", "client_id", "channel_code", "operations_cnt", "debit_amount", "credit_amount",
        "digital_events_cnt", "digital_success_cnt", "digital_fail_cnt", "appeals_opened_cnt").collect())
    assert got == [
        (date(2026, 3, 1), 1, "CC", 0, 0, 0, 0, 0, 0, 1),
        (date(2026, 3, 5), 2, "BRANCH", 1, 0, 20000, 0, 0, 0, 0),
        (date(2026, 3, 6), 2, "IB", 0, 0, 0, 1, 0, 1, 0),
        (date(2026, 3, 20), 1, "MB", 1, Decimal("1200.25"), 0, 1, 1, 0, 0),
        (date(2026, 3, 21), 1, "IB", 1, 300, 0, 0, 0, 0, 0),
    ]
    assert written == {
        "mart_client_profile": 3, "mart_segment_metrics": 3, "mart_client_activity_daily": 5,
        "mart_financial_activity_daily": 3, "mart_digital_activity_daily": 2,
    }
    log = warehouse.core("load_batch").collect()
    assert [(r.batch_id, r.status) for r in log] == [(1, "DONE")]
    assert log[0].notes.startswith("abs_clients_raw=3, crm_clients_raw=2") and log[0].notes.endswith(" -> DWH")
    rejects = spark.read.parquet(warehouse.path("rejects", "transactions")).collect()
    assert sorted(r.reject_reason for r in rejects) == ["unreadable operation_ts", "unresolved client"]
    assert children(spark, warehouse.path("work")) == []
    page = serving.client_segmentation(warehouse.mart("mart_client_profile")).collect()
    assert [(r.client_id, r.segment_type_code) for r in page] == [(1, "LOW_ACTIVITY"), (2, "ACTIVE"), (3, "NEW")]
    check_second_load_and_reset(warehouse, feeds)


def check_second_load_and_reset(warehouse, feeds):
    """A second load of the same files changes nothing; a reset starts over."""
    before, marts = snapshot(warehouse, "clients", "transactions", "digital_events", "appeals"), {
        m: sorted(map(str, warehouse.mart(m).collect())) for m in ("mart_client_profile", "mart_client_activity_daily")
    }
    load.run_daily(warehouse, [feeds], RD, now=NOW)
    assert snapshot(warehouse, "clients", "transactions", "digital_events", "appeals") == before
    assert {m: sorted(map(str, warehouse.mart(m).collect())) for m in marts} == marts
    assert [r.batch_id for r in warehouse.core("load_batch").orderBy("batch_id").collect()] == [1, 2]
    assert [r.segment_history_id for r in warehouse.core("client_segments_history").orderBy("client_id").collect()] == [1, 2, 3]

    warehouse.reset()
    assert all(warehouse.core_or_empty(t).count() == 0 for t in CORE if t != "client_profile_export")
    assert all(warehouse.staging(t, 1).count() == 0 for t in STAGING)
    assert warehouse.core("channels").count() == 13 and warehouse.mart("mart_client_profile").count() == 3
    load.run_daily(warehouse, [feeds], RD, now=NOW, reset=True)
    # Client keys hash the batch and position, which start over as well.
    assert snapshot(warehouse, "clients", "transactions", "digital_events", "appeals") == before


def test_a_failed_load_continues(warehouse, feeds, monkeypatch):
    """Interrupted after the transactions, a load gives the same ids when called again."""
    batch = load.load_sources(warehouse, [feeds], now=NOW)

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patched:
        patched.setattr(load.loaders, "digital_events", lost)
        with pytest.raises(RuntimeError):
            load.conform(warehouse, batch, NOW)
    assert warehouse.core("transactions").count() == 3 and warehouse.core("digital_events") is None
    first = snapshot(warehouse, "clients", "client_history", "accounts", "transactions")
    load.conform(warehouse, batch, NOW)
    assert snapshot(warehouse, *first) == first
    assert warehouse.core("digital_events").count() == 2
    assert [r.status for r in warehouse.core("load_batch").collect()] == ["DONE"]


def test_without_reuse_every_load_creates_its_clients(warehouse, feeds):
    for _ in range(2):
        load.conform(warehouse, load.load_sources(warehouse, [feeds], now=NOW), NOW, reuse_clients=False)
    assert warehouse.core("clients").count() == 6
    # Accounts move to the new client, transactions stay with the old one.
    assert {r.source_account_id: r.client_id for r in warehouse.core("accounts").collect()} == {"K-1": 4, "K-2": 4, "K-3": 5}
    assert {r.source_transaction_id: r.client_id for r in warehouse.core("transactions").collect()} == {"T-1": 1, "T-2": 1, "T-3": 2}
    history = warehouse.core("client_history").collect()
    assert sorted((r.client_history_id, r.client_id) for r in history) == [(i, i) for i in range(1, 7)]


def test_all_feeds_of_a_datasets_folder(spark, warehouse, feeds, tmp_path):
    import json

    from tests_samples import DATASETS

    folder = tmp_path / "datasets"
    for name, body in DATASETS.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body if isinstance(body, str) else json.dumps(body))
    batch = load.load_sources(warehouse, [feeds, str(folder)], str(folder), NOW)
    note = warehouse.core("load_batch").first()["notes"]
    assert note == (
        "abs_clients_raw=5, crm_clients_raw=2, abs_accounts_raw=5, abs_products_raw=2, abs_transactions_raw=9, "
        "dbo_events_raw=3, appeals_raw=2, product_catalog_raw=3, crm_marketing_raw=1, credit_risk_raw=1"
    )
    # CSV rows come first, then manifest, TSV, JSON and XML.
    order = warehouse.staging("abs_transactions_raw", batch).orderBy("load_seq").collect()
    assert [r.source_transaction_id for r in order] == ["T-1", "T-2", "T-3", "T-4", "T-5", "X1", "OB1", "ISO053-r1", "ISO054-n1"]
    load.conform(warehouse, batch, NOW)
    tx = {r.source_transaction_id: r for r in warehouse.core("transactions").collect()}
    assert sorted(tx) == ["ISO053-r1", "ISO054-n1", "OB1", "T-1", "T-2", "T-3", "X1"]
    assert tx["ISO053-r1"].operation_type_id == 18 and tx["ISO053-r1"].channel_id is None
    assert {r.product_id for r in warehouse.core("ref_product_catalog").collect()} == {8811, 8824}
    assert [r.job for r in warehouse.core("crm_marketing_leads").collect()] == ["clerk"]
    assert warehouse.core("credit_risk_features").first().limit_balance == Decimal("1000.00")
    assert {r.source_appeal_id: r.appeal_type_id for r in warehouse.core("appeals").collect()} == {"Q-1": 1, "9": 4}
    assert {r.source_event_id for r in warehouse.core("digital_events").collect()} == {"E-1", "E-2", "L1"}
