"""Pieces, the list of live ones, and merges that leave the others alone."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import live as live_module
from tallyhouse.plans import warehouse as module
from tallyhouse.plans.live import Live, LiveTable
from tallyhouse.plans.warehouse import Warehouse, read_dates, replace_dates
from tallyhouse.schemas import CORE

NOW = datetime(2026, 4, 1, 12)
RD = date(2026, 4, 1)
DAY = "day date, client_id bigint, n int"
APPEAL = "appeal_id bigint, source_system_id smallint, source_appeal_id string, status string, result_text string"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def unmarked(spark):
    """Spark writes no _SUCCESS."""
    conf, name = spark._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(name, "false")
    yield
    conf.unset(name)


def appeals(spark, *rows):
    """Rows (id, key, status, text) in the layout of the appeals table."""
    given = spark.createDataFrame([(i, 1, k, s, t) for i, k, s, t in rows], APPEAL)
    names = {c.split(" ")[0]: c.split(" ")[1] for c in CORE["appeals"].schema.split(", ")}
    return given.select(*[F.col(c) if c in given.columns else F.lit(None).cast(kind).alias(c) for c, kind in names.items()])


def state(warehouse):
    return {r.source_appeal_id: (r.appeal_id, r.status, r.result_text) for r in warehouse.core("appeals").collect()}


def pieces(warehouse):
    return set(warehouse._table("appeals").live().rows)


def stored(spark, frame):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/batch-{random.getrandbits(60)}"
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def test_new_keys_leave_all_pieces_alone(spark, warehouse):
    warehouse.merge_core("appeals", appeals(spark, (1, "a", "OPEN", "x"), (2, "b", "OPEN", "y")))
    first = pieces(warehouse)
    now = warehouse.merge_core("appeals", appeals(spark, (3, "c", "OPEN", "z")))
    assert [r.source_appeal_id for r in now.collect()] == ["c"]
    assert first < pieces(warehouse) and len(pieces(warehouse)) == 2
    assert state(warehouse) == {"a": (1, "OPEN", "x"), "b": (2, "OPEN", "y"), "c": (3, "OPEN", "z")}


def test_a_merge_reads_and_writes_only_what_holds_its_keys(spark, warehouse, monkeypatch):
    monkeypatch.setattr(module, "BUCKET_ROWS", 100)
    warehouse.merge_core("appeals", stored(spark, appeals(spark, *[(i, f"k{i}", "OPEN", "t") for i in range(1, 801)])))
    home = warehouse._table("appeals")
    before = home.live()
    assert before.buckets == 8 and len(before.rows) == 8
    written = []
    write = LiveTable.write
    monkeypatch.setattr(LiveTable, "write", lambda self, rows: written.append(rows) or write(self, rows))
    batch = stored(spark, appeals(spark, (900, "k5", "DONE", "new"), (901, "n1", "OPEN", "u")))
    now = warehouse.merge_core("appeals", batch)
    after = home.live()
    # Of eight buckets the one with k5 is written anew; n1 may add a piece to another.
    gone = set(before.rows) - set(after.rows)
    assert len(gone) == 1 and len(set(before.rows) & set(after.rows)) == 7
    (old,) = gone
    assert sum(n for p, n in after.rows.items() if p not in before.rows) == before.rows[old] + 1
    # The frame really written reads the batch and that piece, nothing else.
    read = {f.split("/warehouse/")[1].split("/part-")[0] for f in written[0].inputFiles() if "/warehouse/" in f}
    assert read == {f"core/appeals/{old[0]}/{old[1]}"}
    assert {r.source_appeal_id for r in now.collect()} == {"k5", "n1"}
    found = state(warehouse)
    assert len(found) == 801 and found["k5"][:2] == (5, "DONE") and found["n1"][0] == 901


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_equal_row_by_row_upserts(spark, warehouse, monkeypatch, seed):
    monkeypatch.setattr(module, "BUCKET_ROWS", 40)
    monkeypatch.setattr(module, "FOLD_AT", 3)
    rng, want, ids = random.Random(seed), {}, 0
    folds = []
    fold = module._to_fold
    monkeypatch.setattr(module, "_to_fold", lambda live: folds.append(fold(live)) or folds[-1])
    for size in (60, 0, 5, 60, 30, *[1] * 6):
        rows = []
        for k in rng.sample(range(200), size) if size != 1 else [1000 + ids]:
            ids += 1
            rows.append((ids, f"k{k}", rng.choice(["OPEN", "DONE", None]), str(ids)))
        warehouse.merge_core("appeals", stored(spark, appeals(spark, *rows)))
        for i, key, status, text in rows:
            old = want.get(key)
            updates = CORE["appeals"].updates
            want[key] = (i, status, text) if old is None else (
                old[0], status if "status" in updates else old[1], text if "result_text" in updates else old[2]
            )
        assert state(warehouse) == want
        assert warehouse.highest("appeals") == ids
        assert sum(warehouse._table("appeals").live().rows.values()) == len(want)
    assert any(folds) and warehouse._table("appeals").live().buckets > 1


def test_a_table_without_updates_only_grows(spark, warehouse):
    schema = CORE["client_history"].schema
    one = spark.createDataFrame([(1, 1, "a", None, None, None, "ACTIVE", NOW, None, True)], schema)
    warehouse.merge_core("client_history", one)
    first = set(warehouse._table("client_history").live().rows)
    both = spark.createDataFrame([(1, 1, "b", None, None, None, "ACTIVE", NOW, None, True), (2, 2, "c", None, None, None, "ACTIVE", NOW, None, True)], schema)
    warehouse.merge_core("client_history", both)
    assert first < set(warehouse._table("client_history").live().rows)
    assert {r.client_history_id: r.full_name for r in warehouse.core("client_history").collect()} == {1: "a", 2: "c"}
    assert warehouse.highest("client_history") == 2


def test_a_range_is_replaced_in_one_step(spark, rows, tmp_path, monkeypatch):
    folder = str(tmp_path / "mart")
    days = [RD + timedelta(days=i) for i in range(4)]
    replace_dates(rows(DAY, *[(d, 1, 1) for d in days]), folder, "day", days[0], days[-1], ("client_id",))

    def seen():
        return sorted((r.day, r.n) for r in read_dates(spark, folder, DAY, "day").collect())

    old, between = seen(), []
    early = read_dates(spark, folder, DAY, "day")
    swap = LiveTable.swap

    def watched(self, before, after):
        between.append(seen())  # the new days are written, the list is not
        result = swap(self, before, after)
        between.append(seen())
        return result

    monkeypatch.setattr(LiveTable, "swap", watched)
    replace_dates(rows(DAY, (days[1], 7, 2)), folder, "day", days[0], days[2], ("client_id",))
    assert between == [old, [(days[1], 2), (days[3], 1)]]
    # A frame resolved before goes on reading what it resolved.
    assert sorted((r.day, r.n) for r in early.collect()) == old

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(LiveTable, "swap", lost)
        with pytest.raises(RuntimeError):
            replace_dates(rows(DAY, (days[3], 9, 9)), folder, "day", days[0], days[3], ("client_id",))
    assert seen() == between[-1]
    replace_dates(rows(DAY, (days[3], 9, 9)), folder, "day", days[3], days[3], ("client_id",))
    assert seen() == [(days[1], 2), (days[3], 9)]
    # What the lost job wrote is gone, as are pieces no kept list names.
    held = {p[0] for n in LiveTable(spark, folder, "day", "date").numbers() for p in LiveTable(spark, folder, "day", "date")._list(n).rows}
    assert {p.name for p in (tmp_path / "mart").iterdir() if p.name.startswith("w=")} == held


def test_states_count_without_sparks_marks(spark, warehouse, unmarked):
    warehouse.merge_core("appeals", appeals(spark, (1, "a", "OPEN", "x")))
    assert state(warehouse) == {"a": (1, "OPEN", "x")} and warehouse.highest("appeals") == 1
    step = warehouse.materialise(1, "step", appeals(spark, (5, "s", "OPEN", "x")))
    again = warehouse.materialise(1, "step", appeals(spark, (6, "s", "OPEN", "x")))
    assert step.first().appeal_id == again.first().appeal_id == 5
    one = spark.createDataFrame([(RD, 3, 1)], "report_date date, segment_type_id int, clients_cnt int")
    zero = [F.lit(0).alias(c) for c in ("active_clients_30d", "total_debit_turnover_30d", "total_credit_turnover_30d", "total_operations_30d", "avg_operations_per_client")]
    assert warehouse.write_mart("mart_segment_metrics", one.select("*", *zero), RD, RD, NOW) == 1
    assert warehouse.mart("mart_segment_metrics").first().segment_type_id == 3


def test_a_second_writer_stops(spark, warehouse):
    warehouse.merge_core("appeals", appeals(spark, (1, "a", "OPEN", "x")))
    home = warehouse._table("appeals")
    stale = home.live()
    warehouse.merge_core("appeals", appeals(spark, (2, "b", "OPEN", "y")))
    with pytest.raises(FileExistsError, match="another job"):
        home.swap(stale, Live())
    assert set(state(warehouse)) == {"a", "b"}


def test_lists_survive_writing(tmp_path):
    live = Live(3, {("w=a", "bucket=0"): 5, ("w=a", "bucket=1"): 2, ("w=b", "bucket=1"): 9}, {"w=a": 2, "w=b": 3}, 2, 77)
    assert Live.from_json(3, live.to_json()) == live
    assert live.folders(live.rows) == ["w=a", "w=b/bucket=1"]
    less = live.without([("w=a", "bucket=1")])
    assert less.folders(less.rows) == ["w=a/bucket=0", "w=b/bucket=1"] and less.total() == 14
    assert live_module.KEPT_LISTS == 2
