"""Shapes of physical plans that matter at scale."""

from __future__ import annotations

import contextlib
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import identity, loaders, marts, profile, segments
from tallyhouse.operators.ids import surrogate_ids
from tallyhouse.operators.upsert import fold
from tallyhouse.schemas import CORE

RD = date(2024, 1, 30)


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def executed(frame):
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def scans(plan):
    return len(re.findall(r"FileScan parquet|Scan parquet", plan))


def shuffles(plan):
    return len(re.findall(r"(?<![A-Za-z])Exchange ", plan))


@pytest.fixture
def hot_batch(spark):
    """30 000 rows; one tax id and one source id own a third of them."""
    hot = F.col("id") % 3 == 0
    return spark.range(1, 30_001, numPartitions=6).select(
        F.col("id").alias("load_seq"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("S"), F.col("id").cast("string"))).alias("source_client_id"),
        F.when(hot, "777").otherwise(F.col("id").cast("string")).alias("tax_id"),
        F.repeat(F.lit("x"), 50).alias("last_name"),
        F.lit(None).cast("string").alias("client_type"),
    )


SKEW = {
    **NO_BROADCAST,
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "10000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def test_a_hot_tax_id_is_split(spark, hot_batch):
    with settings(spark, **SKEW):
        resolved = identity.resolve_identities(hot_batch)
        plan = executed(resolved)
        assert "SortMergeJoin(skew=true)" in plan
        assert resolved.where("tax_id = '777'").select("client_id").distinct().count() == 1
        assert resolved.count() == 30_000


def test_a_hot_client_is_split(spark, hot_batch):
    with settings(spark, **SKEW):
        people = identity.source_client_lookup(identity.resolve_identities(hot_batch))
        found = loaders.with_client(hot_batch.drop("tax_id"), people)
        assert "SortMergeJoin(skew=true)" in executed(found)
        assert found.where("client_id IS NULL").count() == 0 and found.count() == 30_000


def test_rows_without_a_key_spread(spark, hot_batch):
    with settings(spark, **SKEW):
        rows = hot_batch.withColumn("source_account_id", F.lit(None).cast("string"))
        accounts = spark.createDataFrame([("a", 1)], "source_account_id string, account_id bigint")
        joined = loaders.with_reference(rows, "source_account_id", accounts, "account_id")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 30_000 / 4


def test_duplicates_are_folded_before_the_shuffle(spark, hot_batch):
    folded = fold(hot_batch.select("load_seq", "source_client_id", "tax_id"), ["source_client_id"], ["tax_id"])
    plan = executed(folded)
    assert "partial_max_by" in plan and shuffles(plan) == 1


def test_numbering_never_sorts_rows_in_one_task(spark, hot_batch):
    with settings(spark, **NO_BROADCAST):
        plan = executed(surrogate_ids(hot_batch, "id"))
    assert shuffles(plan) == 4 or shuffles(plan) == 3
    # The one single-task exchange carries block sizes, not rows.
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    below = plan[plan.index("SinglePartition"):]
    assert "HashAggregate" in below.splitlines()[1] + below.splitlines()[2]


def empty(spark, table):
    return spark.createDataFrame([], CORE[table].schema)


def test_snapshot_joins_reuse_the_partitioning_of_the_aggregates(spark, tmp_path):
    """One shuffle per input and none for the joins; filters and columns reach the scan."""
    tables = {}
    for name in ("clients", "accounts", "products", "transactions", "digital_events", "appeals", "client_segments_history"):
        folder = str(tmp_path / name)
        empty(spark, name).write.parquet(folder)
        tables[name] = spark.read.schema(CORE[name].schema).parquet(folder)
    t = tables
    with settings(spark, **NO_BROADCAST, spark__sql__adaptive__enabled="false"):
        metrics = segments.client_metrics(t["clients"], t["transactions"], t["digital_events"], t["products"], RD)
        plan = executed(segments.classify(metrics, RD))
        assert shuffles(plan) == 4 and scans(plan) == 4 and "SinglePartition" not in plan
        export = profile.profile_export(
            t["clients"], t["accounts"], t["products"], t["transactions"], t["digital_events"], t["appeals"],
            t["client_segments_history"], RD,
        )
        assert shuffles(executed(export)) == 7
        window = executed(segments.tx_window(t["transactions"], RD))
        assert "PushedFilters: [IsNotNull(operation_date), GreaterThanOrEqual(operation_date,2023-12-31)" in window
        assert "ReadSchema: struct<client_id:bigint,operation_date:date,amount:decimal(18,2),direction:string>" in window
        activity = marts.client_activity_daily(t["transactions"], t["digital_events"], t["appeals"], RD, RD)
        plan = executed(activity)
        assert shuffles(plan) == 1 and "SortMergeJoin" not in plan and "partial_sum" in plan


def test_small_batch_is_merged_without_shuffling_the_table(spark):
    from tallyhouse.operators.upsert import apply_to

    schema = "k bigint, a string"
    target = spark.range(100_000).select(F.col("id").alias("k"), F.lit("old").alias("a"))
    batch = spark.createDataFrame([(5, None), (100_001, "new")], schema)
    merged = apply_to(target, batch.hint("broadcast"), ["k"], ["a"])
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = executed(merged)
    assert "SortMergeJoin" not in plan
    assert merged.count() == 100_001 and merged.where("k = 5").first().a is None


def test_jobs_never_use_machine_local_checkpoints():
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "tallyhouse"
    source = "\n".join(p.read_text() for p in root.rglob("*.py"))
    for word in ("localCheckpoint", "toPandas", ".udf(", "pandas_udf", ".rdd"):
        assert word not in source


def test_now_is_a_parameter(spark, hot_batch):
    created = identity.new_clients(identity.resolve_identities(hot_batch), datetime(2024, 1, 1))
    assert created.select("created_at").distinct().count() == 1
