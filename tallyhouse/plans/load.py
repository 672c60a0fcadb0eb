"""Files → staging → core → profile snapshot → marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import identity, loaders, marts, profile, segments
from tallyhouse.operators.staging import batch_counts, batch_note, staged
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.schemas import CORE, STAGING, staging_columns
from tallyhouse.sources import camt, documents, manifest, rules
from tallyhouse.sources.files import exists, from_source
from tallyhouse.sources.text import UNKNOWN, Hints, read_delimited, read_elements, read_lines

# File names the feeds arrive under.
CSV_SET = {
    "abs_clients.csv": "abs_clients_raw",
    "crm_clients.csv": "crm_clients_raw",
    "abs_accounts.csv": "abs_accounts_raw",
    "abs_products.csv": "abs_products_raw",
    "abs_transactions.csv": "abs_transactions_raw",
    "dbo_events.csv": "dbo_events_raw",
    "appeals.csv": "appeals_raw",
}
TSV_TRANSACTIONS = "tsv_abs/abs_transactions_external.tsv"
TSV_PRODUCTS = "tsv_abs/abs_products_external.tsv"
TSV_ACCOUNTS = "tsv_abs/abs_accounts_external.tsv"
EVENT_LOG = "logs/dbo_events.jsonl"
JSON_ACCOUNTS = "json_api/open_banking_accounts.json"
JSON_TRANSACTIONS = "json_api/open_banking_transactions.json"
JSON_COMPLAINTS = "json_api/consumer_complaints_sample.json"
CAMT_FILES = {
    "053": "xml_iso20022/camt_053_statement_sample.xml",
    "054": "xml_iso20022/camt_054_credit_notification_sample.xml",
}
# The two sheets of the CRM workbook, exported.
SHEETS = {
    "xlsx_crm/crm_campaigns.csv": ("crm_marketing_raw", rules.read_crm_campaigns),
    "xlsx_crm/credit_card_risk.csv": ("credit_risk_raw", rules.read_credit_risk),
}
# Loaders run in this order, which fixes "first" and "last" between sources.
RANK_CSV, RANK_TSV, RANK_EVENTS, RANK_JSON, RANK_XML, RANK_SHEETS, RANK_MANIFEST = (
    0, 100_000, 200_000, 300_000, 400_000, 500_000, 1
)


def now_utc() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def read_csv_set(
    warehouse: Warehouse, roots: Sequence[str], hints: Hints = UNKNOWN
) -> dict[str, DataFrame]:
    """The fixed-name files of every root; rows of earlier roots come first."""
    spark, found = warehouse.spark, {}
    for name, table in CSV_SET.items():
        paths = [f"{root}/{name}" for root in roots if exists(spark, f"{root}/{name}")]
        rows = read_delimited(spark, paths, staging_columns(table), hints=hints) if paths else None
        if rows is not None:
            found[table] = rows
    return found


def gather(
    warehouse: Warehouse,
    roots: Sequence[str],
    datasets: str | None = None,
    hints: Hints = UNKNOWN,
) -> dict[str, list[DataFrame]]:
    """Staging rows of every source, by table, each with its rank."""
    spark = warehouse.spark
    roots = list(dict.fromkeys(r.rstrip("/") for r in roots))
    datasets = datasets.rstrip("/") if datasets and exists(spark, datasets) else None
    everywhere = list(dict.fromkeys([*roots, *([datasets] if datasets else [])]))
    found: dict[str, list[DataFrame]] = {table: [] for table in STAGING}

    def add(table: str, rows: DataFrame | None, rank: int) -> None:
        if rows is not None:
            found[table].append(from_source(rows, rank))

    def present(name: str, folders: Sequence[str]) -> list[str]:
        return [f"{f}/{name}" for f in folders if exists(spark, f"{f}/{name}")]

    for table, rows in read_csv_set(warehouse, roots, hints).items():
        add(table, rows, RANK_CSV)

    if datasets:
        for i, spec in enumerate(manifest.read_manifest(spark, datasets)):
            rows = manifest.load_entry(spark, datasets, spec, hints)
            if rows is not None and manifest.table_name(spec) in STAGING:
                add(manifest.table_name(spec), rows, RANK_MANIFEST + i)
        for path in present(TSV_TRANSACTIONS, [datasets]):
            rows = read_delimited(spark, [path], rules.TSV_TRANSACTION_COLUMNS, "\t", hints)
            if rows is not None:
                add("abs_transactions_raw", rules.read_tsv_transactions(rows), RANK_TSV)
        for path in present(TSV_PRODUCTS, [datasets]):
            rows = read_delimited(spark, [path], staging_columns("product_catalog_raw"), "\t", hints)
            if rows is not None:
                add("product_catalog_raw", rules.read_tsv_catalog(rows), RANK_TSV)

    logs = present(EVENT_LOG, everywhere)
    lines = read_lines(spark, logs, hints) if logs else None
    if lines is not None:
        add("dbo_events_raw", documents.read_event_lines(lines), RANK_EVENTS)

    for name, table, where, normalise in (
        (JSON_ACCOUNTS, "abs_accounts_raw", documents.ACCOUNTS, documents.read_open_banking_accounts),
        (JSON_TRANSACTIONS, "abs_transactions_raw", documents.TRANSACTIONS, documents.read_open_banking_transactions),
        (JSON_COMPLAINTS, "appeals_raw", documents.COMPLAINTS, documents.read_complaints),
    ):
        paths = present(name, everywhere)
        elements = read_elements(spark, paths, where) if paths else None
        if elements is not None:
            add(table, normalise(elements), RANK_JSON)

    owners = None
    tables = present(TSV_ACCOUNTS, everywhere)
    accounts = read_delimited(spark, tables, ("account_id", "client_id"), "\t", hints) if tables else None
    if accounts is not None:
        order = F.struct("seq_part", "seq_block", "seq_row")
        owners = identity.account_client_map(accounts.withColumn("load_seq", order))
    # Per folder statements precede notifications.
    for i, folder in enumerate(everywhere):
        for j, (kind, name) in enumerate(CAMT_FILES.items()):
            for path in present(name, [folder]):
                statements = camt.read_statements(spark, [path], kind)
                add(
                    "abs_transactions_raw",
                    camt.read_entries(statements, owners, kind),
                    RANK_XML + i * len(CAMT_FILES) + j,
                )

    for name, (table, normalise) in SHEETS.items():
        paths = present(name, everywhere)
        columns = staging_columns(table)
        rows = read_delimited(spark, paths, columns, hints=hints, by_position=True) if paths else None
        if rows is not None:
            add(table, normalise(rows), RANK_SHEETS)
    return found


def load_sources(
    warehouse: Warehouse,
    roots: Sequence[str],
    datasets: str | None = None,
    now: datetime | None = None,
    reset: bool = False,
    hints: Hints = UNKNOWN,
) -> int:
    """Stage every source as one batch and return its id.

    `hints` spare the pass that looks at the encoding and quoting of text files.
    """
    now = now or now_utc()
    if reset:
        warehouse.reset()
    batch_id = warehouse.highest("load_batch") + 1
    log_batch(warehouse, batch_id, status="RUNNING", started_at=now)
    for table, sources in gather(warehouse, roots, datasets, hints).items():
        if sources:
            parts = [staged(rows, table, batch_id, now) for rows in sources]
            warehouse.write_staging(table, batch_id, reduce(DataFrame.unionByName, parts))
    tables = {table: warehouse.staging(table, batch_id, numbered=False) for table in STAGING}
    note = batch_note(batch_counts(tables)).first()["note"]
    log_batch(warehouse, batch_id, status="LOADED", finished_at=now_utc(), notes=note)
    return batch_id


def log_batch(warehouse: Warehouse, batch_id: int, **changes: object) -> None:
    """Insert or change the one row of a batch in the batch log (one row per load)."""
    log = warehouse.core_or_empty("load_batch")
    spec = CORE["load_batch"]
    if "started_at" in changes:
        row = (batch_id, "STG_FILE_LOAD", changes["started_at"], None, changes["status"], None)
        rows = log.unionByName(warehouse.spark.createDataFrame([row], spec.schema))
    else:
        this = F.col("batch_id") == batch_id
        rows = log.select(
            *[
                F.when(this, F.lit(changes[c])).otherwise(F.col(c)).cast(log.schema[c].dataType).alias(c)
                if c in changes
                else F.col(c)
                for c in spec.columns
            ]
        )
    warehouse.write_core("load_batch", rows.coalesce(1))


def conform(
    warehouse: Warehouse,
    batch_id: int,
    now: datetime | None = None,
    reuse_clients: bool = True,
) -> None:
    """Staging batch → core tables.

    Each table is one plan over the batch. Typed rows are written once and read
    back for the reject table, the numbering and the upsert, so none of the joins
    run twice. After a failure the same call continues: completed steps are read
    back, and merging a batch again changes nothing. With `reuse_clients` a client known by tax id from an earlier load
    keeps its id; without it every load creates its clients anew.
    """
    now = now or now_utc()

    def raw(table: str) -> DataFrame:
        return warehouse.staging(table, batch_id)

    def materialise(name: str, rows: DataFrame) -> DataFrame:
        return warehouse.materialise(batch_id, name, rows)

    after_client, after_history = warehouse.highest("clients"), warehouse.highest("client_history")
    resolved = materialise(
        "resolved",
        identity.resolve_identities(
            raw("abs_clients_raw"),
            raw("crm_clients_raw"),
            known=warehouse.core("clients") if reuse_clients else None,
            after=after_client,
        ),
    )
    fresh = materialise("new_clients", identity.new_clients(resolved, now, batch_id))
    history = materialise(
        "client_history", identity.client_history(fresh, now, after_client, after_history)
    )
    # Rows a failed attempt has already added are left alone.
    warehouse.merge_core("clients", fresh)
    warehouse.merge_core("client_history", history)
    sources = materialise("source_map", identity.client_source_map(resolved, now))
    warehouse.merge_core("client_source_map", sources, identity.merged_source_map)
    lookup = materialise("source_clients", identity.source_client_lookup(resolved))

    def load(table: str, source: str, rule: Callable[..., DataFrame], *related: object) -> DataFrame | None:
        """The rows of this batch as stored, None when the batch has none."""
        if not warehouse.has_staging(source, batch_id):
            return None
        typed = materialise(table, rule(raw(source), *related))
        warehouse.write_rejects(table, batch_id, loaders.rejects(table, typed))
        # The merge looks at the batch several times, so it is folded once beforehand.
        batch = materialise(f"{table}_folded", loaders.folded(table, typed, warehouse.highest(table)))
        return warehouse.merge_core(table, batch)

    accounts = load("accounts", "abs_accounts_raw", loaders.accounts, lookup, now)
    products = load("products", "abs_products_raw", loaders.products, lookup, now, accounts)
    load("transactions", "abs_transactions_raw", loaders.transactions, lookup, now, accounts, products)
    load("digital_events", "dbo_events_raw", loaders.digital_events, lookup, now)
    load("appeals", "appeals_raw", loaders.appeals, lookup, now)
    load("ref_product_catalog", "product_catalog_raw", loaders.product_catalog, now)
    load("crm_marketing_leads", "crm_marketing_raw", loaders.marketing_leads, lookup, now)
    load("credit_risk_features", "credit_risk_raw", loaders.credit_risk, lookup, now)

    note = warehouse.core("load_batch").where(F.col("batch_id") == batch_id).first()["notes"]
    log_batch(warehouse, batch_id, status="DONE", notes=f"{note} -> DWH")
    warehouse.drop_work(batch_id)


def refresh_profile(warehouse: Warehouse, report_date: date) -> int:
    """Reassign the segments and replace the profile slice of the report date."""

    def core(name: str) -> DataFrame:
        return warehouse.core_or_empty(name)

    metrics = segments.client_metrics(
        core("clients"), core("transactions"), core("digital_events"), core("products"), report_date
    )
    history = warehouse.write_core(
        "client_segments_history",
        segments.segment_history(
            segments.classify(metrics, report_date),
            report_date,
            warehouse.core("client_segments_history"),
        ),
    )
    export = profile.profile_export(
        core("clients"), core("accounts"), core("products"), core("transactions"),
        core("digital_events"), core("appeals"), history, report_date,
    )
    return warehouse.write_profile_export(export, report_date)


def sync_marts(
    warehouse: Warehouse,
    report_date: date,
    first: date | None = None,
    last: date | None = None,
    now: datetime | None = None,
) -> dict[str, int]:
    """Rebuild the slices of all five marts and return the rows written to each."""
    last = last or report_date
    first = first or last - timedelta(days=400)
    export = warehouse.profile_export()
    tx, events, appeals = (
        warehouse.core_or_empty(t) for t in ("transactions", "digital_events", "appeals")
    )
    slices = {
        "mart_client_profile": (marts.client_profile(export, report_date), report_date, report_date),
        "mart_segment_metrics": (marts.segment_metrics(export, report_date), report_date, report_date),
        "mart_client_activity_daily": (
            marts.client_activity_daily(tx, events, appeals, first, last), first, last
        ),
        "mart_financial_activity_daily": (
            marts.financial_activity_daily(tx, first, last), first, last
        ),
        "mart_digital_activity_daily": (
            marts.digital_activity_daily(events, first, last), first, last
        ),
    }
    return {
        name: warehouse.write_mart(name, rows, d0, d1, now) for name, (rows, d0, d1) in slices.items()
    }


def run_daily(
    warehouse: Warehouse,
    roots: Sequence[str],
    report_date: date,
    datasets: str | None = None,
    now: datetime | None = None,
    reset: bool = False,
    first: date | None = None,
    last: date | None = None,
    hints: Hints = UNKNOWN,
) -> dict[str, int]:
    """The whole chain for one report date."""
    warehouse.seed_dictionaries()
    batch_id = load_sources(warehouse, roots, datasets, now, reset, hints)
    conform(warehouse, batch_id, now)
    refresh_profile(warehouse, report_date)
    return sync_marts(warehouse, report_date, first, last, now)
