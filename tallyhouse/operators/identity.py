"""Customer identity across source systems.

Both feeds are resolved together. Core-banking rows come first, then CRM rows, in
load order; rows with the same non-blank tax id are one client and the earliest
row of the group describes it. A row without a tax id is its own group, so blanks
never meet in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import parse_date
from tallyhouse.functions.text import join_present, or_default, strip, stripped
from tallyhouse.operators.ids import surrogate_ids
from tallyhouse.operators.lookup import lookup
from tallyhouse.reference_data import ABS, CRM
from tallyhouse.schemas import CORE, STAGING

# CRM rows sort after every core-banking row; load_seq stays below this.
FEED_STRIDE = 1 << 56
ATTRIBUTES = [c for c in STAGING["abs_clients_raw"] if c != "source_client_id"]


def _feed(raw: DataFrame, system: int) -> DataFrame:
    present = set(raw.columns)
    return raw.select(
        F.lit(system).cast("smallint").alias("source_system_id"),
        F.col("source_client_id"),
        (F.col("load_seq") + F.lit((system - ABS) * FEED_STRIDE)).alias("load_seq"),
        *[
            (F.col(c) if c in present else F.lit(None)).cast("string").alias(c)
            for c in ATTRIBUTES
        ],
    )


def tax_key(tax_id: Column | str) -> Column:
    return stripped(tax_id)


def resolve_identities(
    abs_raw: DataFrame,
    crm_raw: DataFrame | None = None,
    known: DataFrame | None = None,
    after: int = 0,
) -> DataFrame:
    """Every source row with its `client_id`, `match_rule` and `is_primary`.

    `founder` marks the row a new client is created from. `known` holds clients of
    earlier loads (client_id, tax_id): a tax id found there joins that client.
    Without it each load numbers its clients anew.
    """
    rows = _feed(abs_raw, ABS)
    if crm_raw is not None:
        crm_columns = [c for c in crm_raw.columns if c not in ("client_type", "status")]
        rows = rows.unionByName(_feed(crm_raw.select(*crm_columns), CRM))
    tax = tax_key("tax_id")
    rows = rows.withColumn(
        "__person",
        F.when(tax.isNotNull(), F.concat(F.lit("T"), tax)).otherwise(
            F.concat(F.lit("R"), F.col("load_seq").cast("string"))
        ),
    )
    founders = rows.groupBy("__person").agg(F.min("load_seq").alias("__founder_seq"))
    if known is not None:
        earlier = (
            known.select(F.concat(F.lit("T"), tax_key("tax_id")).alias("__person"), "client_id")
            .where("__person IS NOT NULL")
            .groupBy("__person")
            .agg(F.min("client_id").alias("__known_id"))
        )
        founders = founders.join(earlier, "__person", "left")
    else:
        founders = founders.withColumn("__known_id", F.lit(None).cast("bigint"))

    fresh = founders.where("__known_id IS NULL").select("__person", "__founder_seq")
    numbered = surrogate_ids(fresh, "__new_id", order="__founder_seq", after=after)
    people = founders.join(numbered.select("__person", "__new_id"), "__person", "left")

    founder = (F.col("load_seq") == F.col("__founder_seq")) & F.col("__known_id").isNull()
    is_abs = F.col("source_system_id") == ABS
    return (
        lookup(rows, F.col("__person"), people.withColumnRenamed("__person", "__key"), "__key")
        .withColumn("client_id", F.coalesce("__known_id", "__new_id"))
        .withColumn("founder", founder)
        .withColumn(
            "match_rule",
            F.when(~is_abs, "CRM_TAX_MATCH").when(founder, "ABS_TAX_KEY").otherwise("ABS_DEDUP_TAX"),
        )
        .withColumn("is_primary", is_abs & founder)
        .drop("__person", "__founder_seq", "__known_id", "__new_id")
    )


def _uuid(text: Column) -> Column:
    digest = F.md5(text)
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in parts])


def full_name() -> Column:
    return stripped(
        join_present([F.col("last_name"), F.col("first_name"), F.col("middle_name")])
    )


def new_clients(resolved: DataFrame, now: datetime, batch_id: int = 0) -> DataFrame:
    """One client per founder row. The unified key hashes the source key, so runs repeat."""
    identity = F.concat_ws(
        "|", F.lit(str(batch_id)), F.col("source_system_id").cast("string"),
        F.col("source_client_id"), F.col("load_seq").cast("string"),
    )
    return resolved.where("founder").select(
        "client_id",
        _uuid(identity).alias("unified_client_key"),
        or_default("client_type", "INDIVIDUAL").alias("client_type"),
        "first_name",
        "last_name",
        "middle_name",
        full_name().alias("full_name"),
        parse_date("birth_date").alias("birth_date"),
        parse_date("registration_date").alias("registration_date"),
        "tax_id",
        "phone",
        "email",
        "region_code",
        or_default("status", "ACTIVE").alias("status"),
        F.lit(now).cast("timestamp").alias("created_at"),
        F.lit(now).cast("timestamp").alias("updated_at"),
    )


def client_history(clients: DataFrame, now: datetime, after_client: int = 0, after: int = 0) -> DataFrame:
    """One open version per new client.

    New clients are numbered without gaps after `after_client`, and a version is
    opened for each in the same order, so the version id is a shift of the client id.
    """
    return clients.select(
        (F.col("client_id") - F.lit(after_client) + F.lit(after)).alias("client_history_id"),
        "client_id",
        "full_name",
        "phone",
        "email",
        "region_code",
        "status",
        F.lit(now).cast("timestamp").alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def client_source_map(
    resolved: DataFrame, now: datetime, target: DataFrame | None = None
) -> DataFrame:
    """Source id → client: the last row decides, `is_primary` never goes back to false."""
    key = list(CORE["client_source_map"].key)
    folded = resolved.groupBy(*key).agg(
        F.max_by("client_id", "load_seq").alias("client_id"),
        F.bool_or("is_primary").alias("is_primary"),
        F.max_by("match_rule", "load_seq").alias("match_rule"),
        F.lit(now).cast("timestamp").alias("matched_at"),
    )
    return folded if target is None else merged_source_map(target, folded)


def merged_source_map(target: DataFrame | None, folded: DataFrame) -> DataFrame:
    """Folded rows over the rows of the map that have their keys; others may be among them."""
    if target is None:
        return folded
    return (
        target.withColumn("__new", F.lit(0))
        .unionByName(folded.withColumn("__new", F.lit(1)))
        .groupBy(*CORE["client_source_map"].key)
        .agg(
            F.max_by("client_id", "__new").alias("client_id"),
            F.bool_or("is_primary").alias("is_primary"),
            F.max_by("match_rule", "__new").alias("match_rule"),
            F.max("matched_at").alias("matched_at"),
        )
    )


def source_client_lookup(resolved: DataFrame) -> DataFrame:
    """What facts are matched against: core-banking ids as written, last row wins."""
    return (
        resolved.where(F.col("source_system_id") == ABS)
        .groupBy("source_client_id")
        .agg(F.max_by("client_id", "load_seq").alias("client_id"))
    )


def account_client_map(accounts: DataFrame) -> DataFrame:
    """External account id → external client id, later rows win, blanks ignored."""
    return (
        accounts.select(
            strip("account_id").alias("account_id"),
            strip("client_id").alias("source_client_id"),
            "load_seq",
        )
        .where("account_id <> '' AND source_client_id <> ''")
        .groupBy("account_id")
        .agg(F.max_by("source_client_id", "load_seq").alias("source_client_id"))
    )
