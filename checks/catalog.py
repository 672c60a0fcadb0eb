"""The registered queries: every operator over whole tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.views import FIRST_DAY, REPORT_DATE, Views
from tallyhouse.functions import scalars
from tallyhouse.operators import identity, ids, loaders, marts, profile, segments, staging, upsert
from tallyhouse.plans import load, serving
from tallyhouse.plans.warehouse import Warehouse, laid_out
from tallyhouse.schemas import CORE, MART_SORT, STAGING
from tallyhouse.session import scratch_path
from tallyhouse.sources import camt, documents, manifest, rules
from tallyhouse.sources.files import children, from_source, ordered_by
from tallyhouse.sources.text import read_delimited

NOW = datetime(2024, 1, 31)
Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}


STATEMENTS_A_FILE = 200_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written inside does not keep its shuffle files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def present(rows: DataFrame, *columns: str) -> DataFrame:
    """Plain output types: bigint, double and string."""

    def plain(field: T.StructField) -> F.Column:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(kind, T.BooleanType):
            c = c.cast("string")
        return c.alias(field.name)

    picked = rows.select(*columns) if columns else rows
    return picked.select(*[plain(f) for f in picked.schema.fields])


# sources


@query
def src_delimited(v: Views) -> DataFrame:
    """Two folders whose headers differ in order and content, read by name."""
    folder = scratch_path(v.spark, "delimited")
    customer = v.table("customer")
    name = F.concat("c_name", F.lit(';"'), "c_mktsegment", F.lit('"'))
    even = customer.where("c_custkey % 2 = 0").select("c_custkey", name.alias("c_name"), "c_mktsegment")
    odd = customer.where("c_custkey % 2 = 1").select("c_mktsegment", "c_custkey")
    for rows, part in ((even, "a"), (odd, "b")):
        rows.write.option("header", True).option("sep", ";").option("escape", '"').csv(f"{folder}/{part}")
    columns = ("c_custkey", "c_name", "c_mktsegment")
    return present(read_delimited(v.spark, [f"{folder}/a", f"{folder}/b"], columns, ";"), *columns)


# The other five feeds: view, id column, a value column (events carry quotes, complaints newlines).
SINGLE_FEEDS = {
    "abs_accounts": ("v_accounts_raw", "source_account_id", "status"),
    "abs_products": ("v_products_raw", "source_product_id", "amount_limit"),
    "abs_transactions": ("v_transactions_raw", "source_transaction_id", "amount"),
    "dbo_events": ("v_events_raw", "source_event_id", "payload_json"),
    "appeals": ("v_appeals_raw", "source_appeal_id", "result_text"),
}


@query
def src_csv_set(v: Views) -> DataFrame:
    """All seven feeds, the clients from two roots."""
    folder = scratch_path(v.spark, "csv")
    clients = v("v_abs_clients_raw")
    feeds = {
        "0/abs_clients.csv": clients.where("load_seq % 2 = 1"),
        "1/abs_clients.csv": clients.where("load_seq % 2 = 0"),
        "0/crm_clients.csv": v("v_crm_clients_raw"),
    } | {f"0/{name}.csv": v(view) for name, (view, _, _) in SINGLE_FEEDS.items()}
    for name, rows in feeds.items():
        (
            rows.drop("load_seq").write.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")
        )
    found = load.read_csv_set(Warehouse(v.spark, folder), [f"{folder}/0", f"{folder}/1"])
    # Files are numbered in load order: the first root delivered one folder of files.
    first_root = len(children(v.spark, f"{folder}/0/abs_clients.csv", ".csv"))
    shown = {"abs_clients_raw": ("source_client_id", "tax_id"), "crm_clients_raw": ("source_client_id", "tax_id")}
    shown |= {f"{name}_raw": columns for name, (_, *columns) in SINGLE_FEEDS.items()}
    rows = [
        staged_rows(found[table], table).select(
            F.lit(table).alias("table_name"),
            F.col(shown[table][0]).alias("source_id"),
            F.col(shown[table][1]).alias("value"),
            (F.col("seq_part") >= (first_root if table == "abs_clients_raw" else 10**9)).cast("int").alias("root"),
        )
        for table in found
    ]
    return present(reduce(DataFrame.unionByName, rows))


def staged_rows(rows: DataFrame, table: str, batch_id: int = 7) -> DataFrame:
    return staging.staged(from_source(rows, 0), table, batch_id, NOW)


@query
def src_manifest(v: Views) -> DataFrame:
    raw = v.table("customer").select(
        F.col("c_custkey").cast("string").alias("Customer_ID"),
        F.when(F.col("c_mktsegment") == "MACHINERY", " b2b ").otherwise("retail").alias("Customer_Type"),
        F.col("c_nationkey").cast("string").alias("Region"),
        F.col("c_name").alias("Bank_Name"),
        F.lit("x").alias("Unmapped"),
    )
    spec = {
        "table": "stg.abs_clients_raw",
        "columns": ["source_client_id", "client_type", "last_name", "region_code", "status", "tax_id"],
        "column_map": {
            "Customer_ID": "source_client_id", "Customer_Type": "client_type", "Bank_Name": "last_name",
            "Region": "region_code", "Missing": "tax_id", "Unmapped": "no_such_column",
        },
    }
    return present(manifest.project(raw, spec))


@query
def norm_manifest_rows(v: Views) -> DataFrame:
    def shaped(table: str, view: str, kind: str, *columns: str) -> DataFrame:
        rows = rules.normalise_manifest_rows(v(view), table)
        values = [F.col(c) for c in columns] + [F.lit(None).cast("string")] * (5 - len(columns))
        names = ("id", "a", "b", "c", "d")
        return rows.select(F.lit(kind).alias("kind"), *[x.alias(n) for x, n in zip(values, names)])

    return present(reduce(DataFrame.unionByName, [
        shaped("abs_clients_raw", "v_abs_clients_raw", "client", "source_client_id", "client_type", "status"),
        shaped("abs_transactions_raw", "v_transactions_raw", "transaction",
               "source_transaction_id", "channel_code", "currency_code", "direction", "status"),
        shaped("abs_accounts_raw", "v_accounts_raw", "account", "source_account_id", "account_number_masked"),
    ]))


@query
def src_tsv_transactions(v: Views) -> DataFrame:
    return present(rules.tsv_transactions(v("v_tsv_transactions")).drop("load_seq", "source_product_id"))


@query
def src_tsv_catalog(v: Views) -> DataFrame:
    return present(rules.tsv_catalog(v("v_tsv_catalog")).drop("load_seq"))


@query
def src_event_jsonl(v: Views) -> DataFrame:
    return present(documents.event_lines(v("v_event_lines")).drop("load_seq", "platform", "session_id"))


def json_documents(rows: DataFrame, key: F.Column, item: F.Column, *path: str) -> DataFrame:
    """Documents of at most 500 items each, as the feeds deliver them."""
    grouped = rows.select(F.floor(key / 500).alias("number"), item.alias("item"))
    body = F.collect_list("item")
    for name in reversed(path):
        body = F.struct(body.alias(name))
    return grouped.groupBy("number").agg(F.to_json(body).alias("content"))


@query
def src_openbanking_accounts(v: Views) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    item = F.struct(
        F.concat(F.lit("A"), key.cast("string")).alias("AccountId"),
        F.col("o_custkey").alias("CustomerId"),
        F.when(status == "F", "Enabled").when(status == "O", "Disabled").otherwise("").alias("Status"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:00Z")).alias("StatusUpdateDateTime"),
        F.when(key % 4 != 0, "Personal").alias("AccountType"),
        F.when(key % 4 > 1, F.col("o_orderpriority")).alias("AccountSubType"),
        F.when(key % 3 == 0, "nick").alias("Nickname"),
        F.when(key % 5 != 0, "GBP").alias("Currency"),
    )
    rows = json_documents(v.table("orders"), key, item, "Data", "Account")
    return present(
        documents.open_banking_accounts(rows),
        "source_account_id", "source_client_id", "account_number_masked", "account_type",
        "currency_code", "opened_at", "status",
    )


@query
def src_openbanking_transactions(v: Views) -> DataFrame:
    """Amount and bank code are objects in some items and plain values in others."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    amount = F.when(key % 3 == 0, F.lit('"12"')).otherwise(
        F.concat(F.lit('{"Amount":"'), F.replace(price, F.lit("."), F.lit(",")), F.lit('","Currency":"GBP"}'))
    )
    fields = [
        F.concat(F.lit('"TransactionId":"T'), key.cast("string"), F.lit('"')),
        F.concat(F.lit('"CustomerId":'), F.col("o_custkey").cast("string")),
        F.concat(F.lit('"AccountId":"A'), key.cast("string"), F.lit('"')),
        F.concat(F.lit('"Amount":'), amount),
        F.when(F.col("o_orderstatus") == "F", '"CreditDebitIndicator":"Credit"')
        .when(F.col("o_orderstatus") == "O", '"CreditDebitIndicator":"DEBIT"'),
        F.when(key % 2 == 0, '"BankTransactionCode":{"Code":"PMNT"}').otherwise('"BankTransactionCode":"PMNT"'),
        F.concat(F.lit('"BookingDateTime":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('T09:00:00Z"')),
        F.when(key % 4 == 0, '"MerchantDetails":{"MerchantName":" shop "}').otherwise('"MerchantDetails":"shop"'),
        F.concat(F.lit('"TransactionInformation":" '), F.col("o_orderpriority"), F.lit('"')),
    ]
    item = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    content = F.concat(
        F.lit('{"Data":{"Transaction":['), F.concat_ws(",", F.collect_list("item")), F.lit("]}}")
    )
    rows = (
        v.table("orders").select(F.floor(key / 500).alias("number"), item.alias("item"))
        .groupBy("number").agg(content.alias("content"))
    )
    return present(documents.open_banking_transactions(rows).drop(
        "source_product_id", "seq_part", "seq_block", "seq_row"
    ))


@query
def src_complaints(v: Views) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    number = F.concat(F.lit("Q"), (conv * 100 + turn).cast("string"))
    item = F.struct(
        F.when(turn % 7 != 6, number).otherwise(F.lit(" ")).alias("complaint_id"),
        conv.cast("string").alias("customer_id"),
        F.date_format(F.date_sub(F.lit(REPORT_DATE), (conv % 200).cast("int")), "yyyy-MM-dd").alias("date_received"),
        F.col("role").alias("product"),
        F.lit("").alias("issue"),
        F.col("text").alias("narrative"),
        F.when(turn % 4 == 0, " Phone").when(turn % 4 == 1, "referral").when(turn % 4 == 2, "pigeon").alias("submitted_via"),
        F.when(conv % 3 == 0, "Closed with monetary relief").when(conv % 3 == 1, "closed? In progress").alias("company_response"),
    )
    rows = json_documents(v.table("conversations"), conv * 100 + turn, item, "complaints")
    return present(
        documents.complaints(rows),
        "source_appeal_id", "source_client_id", "channel_code", "appeal_type_code", "created_ts",
        "status", "priority", "result_text",
    )


@query
def src_camt(v: Views) -> DataFrame:
    """Statements and notifications written as XML files and read back, with the account owner looked up."""
    folder = scratch_path(v.spark, "camt")
    key = F.col("o_orderkey")

    def entry(order: F.Column) -> F.Column:
        key, status = order["o_orderkey"], order["o_orderstatus"]
        price = order["o_totalprice"].cast("decimal(18,2)").cast("string")
        named = F.when(key % 3 == 0, F.concat(F.lit("Customer "), key.cast("string"), F.lit(" & co"))).otherwise("Shop")
        details = F.struct(
            F.struct(
                F.struct(named.alias("Nm")).alias("Dbtr"),
            ).alias("RltdPties"),
            F.struct(F.when(key % 4 == 0, " pay & <go> ").alias("Ustrd")).alias("RmtInf"),
        )
        return F.struct(
            F.struct(
                F.replace(price, F.lit("."), F.lit(",")).alias("_VALUE"), F.when(key % 2 == 0, "EUR").alias("_Ccy")
            ).alias("Amt"),
            F.when(status == "F", "CRDT").when(status == "O", "dbit").alias("CdtDbtInd"),
            F.struct(F.date_format(order["o_orderdate"], "yyyy-MM-dd").alias("Dt")).alias("BookgDt"),
            F.when(key % 5 != 0, F.concat(F.lit("R"), key.cast("string"))).alias("AcctSvcrRef"),
            F.struct(details.alias("TxDtls")).alias("NtryDtls"),
        )

    orders = v.table("orders")
    used = ("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    # Entries are written out after the shuffle, which moves what they are made of.
    statements = (
        orders.groupBy("o_custkey", F.floor(key / 1000).alias("part"))
        .agg(F.collect_list(F.struct(*used)).alias("found"))
        .select(
            F.struct(
                F.struct(F.struct(F.col("o_custkey").cast("string").alias("Id")).alias("Othr")).alias("Id")
            ).alias("Acct"),
            F.transform("found", entry).alias("Ntry"),
        )
    )
    with shuffles_dropped(v.spark):
        for kind, (tag, _) in camt.MESSAGES.items():
            # A packed file is read by one task, so its size is bounded.
            (
                statements.write.format("xml").option("rowTag", tag).option("rootTag", "BkToCstmrStmt").option("indent", "")
                .option("compression", "gzip").option("maxRecordsPerFile", STATEMENTS_A_FILE).save(f"{folder}/{kind}")
            )
    owners = orders.select(
        F.col("o_custkey").cast("string").alias("account_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("client_id"),
        key.alias("load_seq"),
    )
    owner = identity.account_client_map(owners)
    read = [camt.entries(camt.read_statements(v.spark, [f"{folder}/{kind}"], kind), owner, kind) for kind in camt.MESSAGES]
    return present(
        reduce(DataFrame.unionByName, read),
        "source_transaction_id", "source_client_id", "source_account_id", "operation_type_code",
        "operation_ts", "amount", "currency_code", "direction", "description",
    )


@query
def account_client_map(v: Views) -> DataFrame:
    key = F.col("o_orderkey")
    accounts = v.table("orders").select(
        F.concat(F.lit(" A"), (key % 4000).cast("string")).alias("account_id"),
        F.when(key % 6 == 0, "  ").otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("\t"))).alias("client_id"),
        key.alias("load_seq"),
    )
    return present(identity.account_client_map(accounts))


def sheet_rows(v: Views) -> DataFrame:
    customer_id = F.concat(F.lit("ABS-"), F.col("c_custkey").cast("string"))
    return v.table("customer").withColumn(
        "key", F.when(F.col("c_custkey") % 8 != 0, customer_id)
    )


@query
def src_crm_campaigns(v: Views) -> DataFrame:
    text = F.lit("unknown")
    sheet = sheet_rows(v).select(
        F.when(F.col("key").isNotNull(), F.concat(F.lit("CMP"), (F.col("c_custkey") % 4).cast("string"))).alias("campaign_id"),
        F.col("key").alias("customer_id"),
        (F.col("c_custkey") % 60).alias("age"),
        F.repeat("c_mktsegment", 9).alias("job"),
        *[text.alias(c) for c in ("marital", "education", "default_flag", "housing_loan", "personal_loan",
                                  "contact_channel", "last_contact_date")],
        F.col("c_nationkey").alias("campaign_contacts"),
        text.alias("previous_outcome"),
        F.lit("subscribed").alias("term_deposit_subscribed"),
    )
    return present(
        rules.crm_campaigns(sheet),
        "campaign_id", "customer_id", "age", "job", "campaign_contacts", "term_deposit_subscribed",
    )


@query
def src_credit_risk(v: Views) -> DataFrame:
    number = F.col("c_custkey")
    sheet = sheet_rows(v).select(
        F.col("key").alias("customer_id"),
        F.col("c_acctbal").alias("limit_balance"),
        F.col("c_mktsegment").alias("sex"),
        F.lit("e").alias("education"), F.lit("m").alias("marriage"), F.lit(30).alias("age"),
        (number % 3).alias("pay_status_m1"), F.lit("").alias("pay_status_m2"),
        *[F.lit(1.5).alias(c) for c in ("bill_amt_m1", "bill_amt_m2", "pay_amt_m1", "pay_amt_m2")],
        (number % 2).cast("string").alias("default_next_month"),
    )
    return present(
        rules.credit_risk(sheet).withColumn("pay_status_m2", F.nullif("pay_status_m2", F.lit(""))),
        "customer_id", "limit_balance", "sex", "pay_status_m1", "pay_status_m2", "default_next_month",
    )


def stage(v: Views, feeds: dict[str, str], batch_id: int = 7) -> Warehouse:
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"))
    for table, view in feeds.items():
        rows = staged_rows(ordered_by(v(view), "load_seq"), table, batch_id)
        warehouse.write_staging(table, batch_id, rows)
    return warehouse


@query
def stg_append(v: Views) -> DataFrame:
    warehouse = stage(v, {"abs_clients_raw": "v_abs_clients_raw"})
    stored = v.spark.read.parquet(warehouse.path("stg", "abs_clients_raw"))
    return present(
        staging.with_load_seq(stored),
        F.col("load_seq").alias("id"), "batch_id", "source_client_id", "client_type", "tax_id", "status",
        "reject_reason",
    )


@query
def stg_batch_counts(v: Views) -> DataFrame:
    feeds = {
        "abs_clients_raw": "v_abs_clients_raw", "crm_clients_raw": "v_crm_clients_raw",
        "abs_accounts_raw": "v_accounts_raw", "abs_products_raw": "v_products_raw",
        "abs_transactions_raw": "v_transactions_raw", "dbo_events_raw": "v_events_raw",
        "appeals_raw": "v_appeals_raw",
    }
    warehouse = stage(v, feeds)
    tables = {table: warehouse.staging(table, 7, numbered=False) for table in STAGING}
    return present(staging.batch_counts(tables), "table_name", "rows_cnt")


@query
def stg_scan_batch(v: Views) -> DataFrame:
    """A batch staged as two feeds and read back in insertion order."""
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"))
    rows = v("v_transactions_raw")
    first, second = rows.where("description = 'first'"), rows.where("description = 'second'")
    parts = [
        staging.staged(from_source(ordered_by(part, "load_seq"), rank), "abs_transactions_raw", 3, NOW)
        for rank, part in enumerate((first, second))
    ]
    warehouse.write_staging("abs_transactions_raw", 3, parts[0].unionByName(parts[1]))
    scanned = warehouse.staging("abs_transactions_raw", 3)
    return present(ids.surrogate_ids(scanned, "place"), "source_transaction_id", "place", "description")


@query
def reset_tables(v: Views) -> DataFrame:
    warehouse = stage(v, {"abs_clients_raw": "v_abs_clients_raw"})
    warehouse.write_core("clients", v("v_clients"))
    warehouse.seed_dictionaries()

    def counts(name: str) -> DataFrame:
        tables = {
            "clients": warehouse.core("clients"),
            "abs_clients_raw": warehouse.staging("abs_clients_raw", 7),
            "channels": warehouse.core("channels"),
        }
        return staging.batch_counts(tables).select("table_name", F.col("rows_cnt").alias(name))

    before = counts("rows_before")
    seen = v.spark.createDataFrame(before.collect(), before.schema)
    warehouse.reset()
    return present(seen.join(counts("rows_after"), "table_name"))


# conforming


@query
def parse_scalars(v: Views) -> DataFrame:
    """Dates, instants, decimals and flags as text, with unreadable and blank values mixed in."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    rows = v.table("orders").select(
        key.alias("id"),
        F.when(key % 4 == 0, F.concat(F.lit(" "), day, F.lit("T01:30:00+03:00\n")))
        .when(key % 4 == 1, F.concat(day, F.lit(" 10:30")))
        .when(key % 4 == 2, F.lit("12:30")).otherwise(F.lit("  ")).alias("stamp"),
        F.when(key % 3 == 0, price)
        .when(key % 3 == 1, F.concat(F.lit(" "), F.replace(price, F.lit("."), F.lit(","))))
        .otherwise(F.lit("n/a")).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "YES").when(F.col("o_orderstatus") == "O", " true").otherwise("").alias("flag"),
    )
    amount = scalars.parse_decimal("amount", 18, 2)
    return present(rows.select(
        "id",
        scalars.parse_date("stamp").alias("parsed_date"),
        scalars.parse_timestamp("stamp").alias("parsed_ts"),
        scalars.local_date("stamp").alias("parsed_local_date"),
        amount.alias("parsed_decimal"),
        scalars.parse_bool("flag").alias("parsed_bool"),
        scalars.unreadable("amount", amount).alias("decimal_unreadable"),
    ))


@query
def surrogate_ids(v: Views) -> DataFrame:
    # Order values with gaps.
    rows = v.table("orders").select("o_orderkey", (F.col("o_orderkey") * 7).alias("place"))
    return present(ids.surrogate_ids(rows, "id", order="place", after=1000), "o_orderkey", "id")


def resolved(v: Views) -> DataFrame:
    return identity.resolve_identities(v("v_abs_clients_raw"), v("v_crm_clients_raw"))


def written(v: Views, rows: DataFrame) -> DataFrame:
    """A step written to the shared folder and read back, as the load job does it."""
    folder = scratch_path(v.spark, "step")
    rows.write.parquet(folder)
    return v.spark.read.schema(rows.schema).parquet(folder)


def lookup(v: Views) -> DataFrame:
    return identity.source_client_lookup(resolved(v))


@query
def resolve_abs_clients(v: Views) -> DataFrame:
    rows = identity.resolve_identities(v("v_abs_clients_raw"))
    return present(rows, "source_client_id", "client_id", "match_rule", "is_primary")


@query
def resolve_crm_clients(v: Views) -> DataFrame:
    rows = resolved(v).where("source_system_id = 2")
    return present(
        rows.withColumn("load_seq", F.col("load_seq") - F.lit(identity.FEED_STRIDE)).withColumnRenamed("founder", "created"),
        "load_seq", "source_client_id", "client_id", "match_rule", "is_primary", "created",
    )


@query
def new_clients(v: Views) -> DataFrame:
    return present(identity.new_clients(resolved(v), NOW).drop("unified_client_key", "created_at", "updated_at"))


@query
def client_source_map(v: Views) -> DataFrame:
    return present(identity.client_source_map(resolved(v), NOW).drop("matched_at"))


@query
def source_client_lookup(v: Views) -> DataFrame:
    return present(lookup(v))


@query
def client_history(v: Views) -> DataFrame:
    rows = identity.client_history(identity.new_clients(resolved(v), NOW), NOW, after=500)
    return present(rows.drop("email", "region_code"))


@query
def dictionary_lookup(v: Views) -> DataFrame:
    rows = loaders.dictionary_lookup(
        v("v_transactions_raw"), F.col("channel_code"), "channels", "channel_id", "channel_code"
    )
    rows = loaders.dictionary_lookup(
        rows, F.col("operation_type_code"), "operation_types", "operation_type_id", "operation_type_code"
    )
    return present(rows, "load_seq", "channel_id", "operation_type_id")


def core_accounts(v: Views, people: DataFrame) -> DataFrame:
    return loaders.into_core("accounts", written(v, loaders.accounts(v("v_accounts_raw"), people, NOW)))


def core_products(v: Views, people: DataFrame, accounts: DataFrame) -> DataFrame:
    return loaders.into_core("products", written(v, loaders.products(v("v_products_raw"), people, NOW, accounts)))


def without(rows: DataFrame, *more: str) -> DataFrame:
    return rows.drop("source_system_id", "created_at", "updated_at", *more)


@query
def load_accounts(v: Views) -> DataFrame:
    return present(without(core_accounts(v, written(v, lookup(v)))))


@query
def load_products(v: Views) -> DataFrame:
    people = written(v, lookup(v))
    accounts = written(v, core_accounts(v, people))
    return present(without(core_products(v, people, accounts), "closed_at"))


@query
def load_transactions(v: Views) -> DataFrame:
    people = written(v, lookup(v))
    accounts = written(v, core_accounts(v, people))
    products = written(v, core_products(v, people, accounts))
    typed = written(v, loaders.transactions(v("v_transactions_raw"), people, NOW, accounts, products))
    return present(without(loaders.into_core("transactions", typed)))


@query
def load_digital_events(v: Views) -> DataFrame:
    typed = written(v, loaders.digital_events(v("v_events_raw"), lookup(v), NOW))
    return present(without(loaders.into_core("digital_events", typed), "event_ts", "device_type", "platform"))


@query
def load_appeals(v: Views) -> DataFrame:
    typed = written(v, loaders.appeals(v("v_appeals_raw"), lookup(v), NOW))
    return present(without(loaders.into_core("appeals", typed)))


@query
def load_product_catalog(v: Views) -> DataFrame:
    typed = loaders.product_catalog(v("v_catalog_raw"), NOW)
    return present(without(loaders.into_core("ref_product_catalog", typed)))


@query
def load_marketing_leads(v: Views) -> DataFrame:
    typed = written(v, loaders.marketing_leads(v("v_marketing_raw"), lookup(v), NOW))
    return present(
        loaders.into_core("crm_marketing_leads", typed),
        "id", "client_id", "campaign_id", "age", "job", "education", "last_contact_date",
        "campaign_contacts", "term_deposit_subscribed",
    )


@query
def load_credit_risk(v: Views) -> DataFrame:
    typed = written(v, loaders.credit_risk(v("v_credit_raw"), lookup(v), NOW))
    return present(without(loaders.into_core("credit_risk_features", typed), "sex", "marriage"))


@query
def referential_filter(v: Views) -> DataFrame:
    active = v("v_clients").where("status = 'ACTIVE'")
    kept, dropped = loaders.referential_filter(v("v_transactions"), active)
    reason = F.lit(None).cast("string")
    rows = kept.withColumn("reject_reason", reason).unionByName(dropped)
    return present(rows, "transaction_id", "reject_reason")


@query
def load_rejects(v: Views) -> DataFrame:
    typed = loaders.transactions(v("v_transactions_raw"), lookup(v), NOW)
    return present(loaders.rejects("transactions", typed), "load_seq", "reject_reason")


@query
def fold_upsert(v: Views) -> DataFrame:
    """Raw transactions merged into a table that already holds a quarter of the keys."""
    key = F.concat(F.lit("T"), F.col("o_orderkey").cast("string"))
    target = v.table("orders").where("o_orderkey % 4 = 1").select(
        key.alias("source_transaction_id"), F.lit("target").alias("description"),
        F.lit(5).cast("decimal(18,2)").alias("amount"), F.lit("OLD").alias("status"),
    )
    incoming = v("v_transactions_raw").select(
        "source_transaction_id", "description",
        scalars.parse_decimal("amount", 18, 2).alias("amount"), "status", "load_seq",
    )
    return present(upsert.fold_upsert(incoming, ["source_transaction_id"], ["amount", "status"], target))


@query
def merge_batches(v: Views) -> DataFrame:
    """Three loads of transactions merged into a stored table: all but every ninth key, the ninth, corrections."""
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"))
    key = F.col("transaction_id")
    names = [c.strip().split(" ") for c in CORE["transactions"].schema.replace("(18,2)", "(18;2)").split(",")]
    columns = {n: kind.replace(";", ",") for n, kind in names}

    def batch(rows: DataFrame, status: str, bonus: int) -> DataFrame:
        given = rows.select(
            "transaction_id", F.lit(1).alias("source_system_id"), F.concat(F.lit("T"), key.cast("string")).alias("source_transaction_id"),
            "client_id", "operation_date", (F.col("amount") + bonus).alias("amount"), F.lit(status).alias("status"),
        )
        shaped = given.select(*[
            (F.col(c) if c in given.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()
        ])
        return written(v, shaped)

    rows = v("v_transactions")
    warehouse.merge_core("transactions", batch(rows.where(key % 9 != 0), "NEW", 0))
    warehouse.merge_core("transactions", batch(rows.where(key % 9 == 0), "LATE", 0))
    corrected = warehouse.merge_core("transactions", batch(rows.where(key % 50 == 7), "CORRECTED", 1))
    counts = corrected.groupBy("status").agg(F.count("*").alias("returned_cnt"))
    return present(
        warehouse.core("transactions").join(counts, "status", "left"),
        "transaction_id", "source_transaction_id", "operation_date", "amount", "status", "returned_cnt",
    )


@query
def seed_dictionaries(v: Views) -> DataFrame:
    """Seeded twice, the channel table still has one row per channel; counted over the facts."""
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"))
    warehouse.seed_dictionaries()
    warehouse.seed_dictionaries()
    channels = warehouse.core("channels")
    counts = v("v_transactions").groupBy("channel_id").agg(F.count("*").alias("transactions_cnt"))
    return present(
        channels.join(counts, "channel_id", "left").fillna(0, ["transactions_cnt"]),
        "channel_id", "channel_code", "transactions_cnt",
    )


# segments and profile


@query
def tx_window_30d(v: Views) -> DataFrame:
    return present(segments.tx_window(v("v_transactions"), REPORT_DATE))


@query
def last_transaction(v: Views) -> DataFrame:
    return present(segments.last_transaction(v("v_transactions")))


@query
def last_digital_event(v: Views) -> DataFrame:
    return present(segments.last_digital_event(v("v_digital_events")))


@query
def events_window_30d(v: Views) -> DataFrame:
    return present(segments.events_window(v("v_digital_events"), REPORT_DATE))


@query
def active_products(v: Views) -> DataFrame:
    return present(segments.active_products(v("v_products")))


def metrics(v: Views) -> DataFrame:
    return segments.client_metrics(
        v("v_clients"), v("v_transactions"), v("v_digital_events"), v("v_products"), REPORT_DATE
    )


@query
def client_metrics(v: Views) -> DataFrame:
    return present(metrics(v))


def classified(v: Views) -> DataFrame:
    return segments.classify(metrics(v), REPORT_DATE)


@query
def segment_classify(v: Views) -> DataFrame:
    return present(classified(v))


@query
def segment_history(v: Views) -> DataFrame:
    rows = segments.segment_history(classified(v), REPORT_DATE, v("v_segment_history"))
    return present(rows.drop("score", "effective_to"))


@query
def profile_accounts(v: Views) -> DataFrame:
    return present(profile.profile_accounts(v("v_accounts")))


@query
def profile_products(v: Views) -> DataFrame:
    return present(profile.profile_products(v("v_products")))


@query
def profile_transactions(v: Views) -> DataFrame:
    return present(profile.profile_transactions(v("v_transactions"), REPORT_DATE))


@query
def profile_events(v: Views) -> DataFrame:
    return present(profile.profile_events(v("v_digital_events"), REPORT_DATE))


@query
def profile_appeals(v: Views) -> DataFrame:
    return present(profile.profile_appeals(v("v_appeals"), REPORT_DATE))


@query
def profile_current_segment(v: Views) -> DataFrame:
    return present(profile.profile_current_segment(v("v_segment_history")))


def export(v: Views) -> DataFrame:
    return profile.profile_export(
        v("v_clients"), v("v_accounts"), v("v_products"), v("v_transactions"),
        v("v_digital_events"), v("v_appeals"), v("v_segment_history"), REPORT_DATE,
    )


@query
def profile_export(v: Views) -> DataFrame:
    return present(export(v))


# marts


def profile_mart(v: Views) -> DataFrame:
    return marts.client_profile(export(v), REPORT_DATE)


def metrics_mart(v: Views) -> DataFrame:
    return marts.segment_metrics(export(v), REPORT_DATE)


def activity(v: Views) -> DataFrame:
    return marts.client_activity_daily(
        v("v_transactions"), v("v_digital_events"), v("v_appeals"), FIRST_DAY, REPORT_DATE
    )


def financial(v: Views) -> DataFrame:
    return marts.financial_activity_daily(v("v_transactions"), FIRST_DAY, REPORT_DATE)


def digital(v: Views) -> DataFrame:
    return marts.digital_activity_daily(v("v_digital_events"), FIRST_DAY, REPORT_DATE)


@query
def mart_client_profile(v: Views) -> DataFrame:
    return present(profile_mart(v))


@query
def mart_segment_metrics(v: Views) -> DataFrame:
    return present(metrics_mart(v))


@query
def activity_tx_daily(v: Views) -> DataFrame:
    return present(marts.activity_tx_daily(v("v_transactions"), FIRST_DAY, REPORT_DATE))


@query
def activity_events_daily(v: Views) -> DataFrame:
    return present(marts.activity_events_daily(v("v_digital_events"), FIRST_DAY, REPORT_DATE))


@query
def activity_appeals_daily(v: Views) -> DataFrame:
    return present(marts.activity_appeals_daily(v("v_appeals"), FIRST_DAY, REPORT_DATE))


@query
def mart_client_activity_daily(v: Views) -> DataFrame:
    return present(activity(v))


@query
def mart_financial_activity_daily(v: Views) -> DataFrame:
    return present(financial(v))


@query
def mart_digital_activity_daily(v: Views) -> DataFrame:
    return present(digital(v))


@query
def replace_report_date(v: Views) -> DataFrame:
    """Two report dates written; the second is written again with other numbers."""
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"))
    name, earlier = "mart_segment_metrics", REPORT_DATE - timedelta(days=1)
    zero = F.lit(0)
    counts = classified(v).groupBy(F.col("segment_type_id").cast("int").alias("segment_type_id")).agg(
        F.count("*").alias("clients_cnt")
    )
    first = counts.select(
        F.lit(earlier).alias("report_date"), "segment_type_id", "clients_cnt",
        *[zero.alias(c) for c in ("active_clients_30d", "total_debit_turnover_30d", "total_credit_turnover_30d",
                                  "total_operations_30d", "avg_operations_per_client")],
    )
    warehouse.write_mart(name, first, earlier, earlier, NOW)
    warehouse.write_mart(name, first.withColumn("report_date", F.lit(REPORT_DATE)), REPORT_DATE, REPORT_DATE, NOW)
    warehouse.write_mart(name, metrics_mart(v), REPORT_DATE, REPORT_DATE, NOW)
    return present(warehouse.mart(name), "report_date", "segment_type_id", "clients_cnt")


@query
def replace_date_range(v: Views) -> DataFrame:
    """Part of the range is replaced by a mobile-only feed; days it leaves empty vanish."""
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"))
    name = "mart_financial_activity_daily"
    warehouse.write_mart(name, financial(v), FIRST_DAY, REPORT_DATE, NOW)
    first, last = REPORT_DATE - timedelta(days=300), REPORT_DATE - timedelta(days=200)
    mobile = financial(v).where("channel_code = 'MB'")
    warehouse.write_mart(name, mobile, first, last, NOW)
    return present(
        warehouse.mart(name), "activity_date", "client_id", "channel_code", "operation_type_code", "operation_cnt"
    )


@query
def mart_insert(v: Views) -> DataFrame:
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"))
    name = "mart_digital_activity_daily"
    reported = warehouse.write_mart(name, digital(v), FIRST_DAY, REPORT_DATE)
    return present(warehouse.mart(name).agg(
        F.lit(reported).alias("rows_reported"),
        F.count("*").alias("rows_stored"),
        F.bool_and(F.col("loaded_at").isNotNull()).alias("stamped"),
    ))


@query
def mart_layout(v: Views) -> DataFrame:
    """Rows per day of a written mart, and whether each file is sorted by client."""
    folder = scratch_path(v.spark, "mart")
    sort = MART_SORT["mart_financial_activity_daily"]
    laid_out(financial(v), "activity_date", sort).write.partitionBy("activity_date").parquet(folder)
    stored = v.spark.read.parquet(folder).select(
        "activity_date", "client_id", F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("place"),
    )
    before = F.lag("client_id").over(Window.partitionBy("activity_date", "file").orderBy("place"))
    checked = stored.withColumn("ordered", F.coalesce(before <= F.col("client_id"), F.lit(True)))
    return present(checked.groupBy("activity_date").agg(
        F.count("*").alias("rows_cnt"),
        F.countDistinct("client_id").alias("clients_cnt"),
        F.bool_and("ordered").alias("in_order"),
    ))


@query
def segmentation_view(v: Views) -> DataFrame:
    return present(
        marts.segmentation_view(profile_mart(v)),
        "client_id", "current_segment_type_id", "segment_type_code", "segment_type_name",
    )


# serving


@query
def q_client_profile(v: Views) -> DataFrame:
    return present(serving.client_profile(profile_mart(v), limit=200, offset=100))


@query
def q_client_profile_one(v: Views) -> DataFrame:
    return present(serving.client_profile_one(profile_mart(v), 42))


@query
def q_client_segmentation(v: Views) -> DataFrame:
    return present(
        serving.client_segmentation(profile_mart(v), limit=2000),
        "client_id", "current_segment_type_id", "segment_type_code", "segment_type_name",
    )


@query
def q_segment_metrics(v: Views) -> DataFrame:
    return present(serving.segment_metrics(metrics_mart(v)))


RANGE = (date(2023, 6, 1), REPORT_DATE)


@query
def q_client_activity_daily(v: Views) -> DataFrame:
    return present(serving.client_activity_daily(activity(v), *RANGE, limit=500, offset=50))


@query
def q_financial_activity_daily(v: Views) -> DataFrame:
    return present(serving.financial_activity_daily(financial(v), *RANGE, client_id=55))


@query
def q_digital_activity_daily(v: Views) -> DataFrame:
    return present(serving.digital_activity_daily(digital(v), *RANGE, limit=2000, offset=100))


@query
def as_json_numbers(v: Views) -> DataFrame:
    return present(
        serving.as_json_numbers(profile_mart(v)), "client_id", "debit_turnover_30d", "credit_turnover_30d"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: function(Views(spark, folder))

    return {name: bound(function) for name, function in QUERIES.items()}
