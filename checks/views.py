"""Bank-shaped views over the given tables.

The same text runs in Spark SQL (as the input of a query) and in DuckDB (as a CTE
of the query's SQL). Every view keeps all rows of the table it is made from.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.reference_data import DICTIONARIES
from tallyhouse.session import configure

REPORT_DATE = date(2024, 1, 30)
FIRST_DAY = date(2022, 12, 26)  # 400 days earlier
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _codes(name: str) -> str:
    rows, schema = DICTIONARIES[name]
    id_column, code_column = (f.split(" ")[0] for f in schema.split(", ")[:2])
    values = ", ".join(f"({row[0]}, '{row[1]}')" for row in rows)
    return f"SELECT * FROM (VALUES {values}) AS t({id_column}, {code_column})"


def _labels() -> str:
    rows, _ = DICTIONARIES["segment_labels"]
    values = ", ".join(f"({i}, '{code}', '{name}')" for i, code, name in rows)
    return f"SELECT * FROM (VALUES {values}) AS t(segment_type_id, segment_type_code, segment_type_name)"


def _stamp(day: str, key: str) -> str:
    hour = f"LPAD(CAST({key} % 24 AS STRING), 2, '0')"
    return f"CAST(CAST({day} AS STRING) || ' ' || {hour} || ':30:15.125' AS TIMESTAMP)"


_TX_DAY = "DATE '2024-01-30' - CAST(o_orderkey % 1200 AS INT) + CAST(o_orderkey % 3 AS INT)"
_APPEAL_DAY = "DATE '2024-01-30' - CAST(conv_id % 200 AS INT)"
_ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"

VIEWS: dict[str, str] = {
    "v_channels": _codes("channels"),
    "v_operation_types": _codes("operation_types"),
    "v_event_types": _codes("event_types"),
    "v_appeal_types": _codes("appeal_types"),
    "v_product_types": _codes("product_types"),
    "v_segment_labels": _labels(),
    # core shapes
    "v_clients": """
        SELECT c_custkey AS client_id, md5('client-' || CAST(c_custkey AS STRING)) AS unified_client_key,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'BUSINESS' ELSE 'INDIVIDUAL' END AS client_type,
               CASE WHEN c_acctbal < 0 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status,
               CAST(c_nationkey AS STRING) AS region_code,
               CASE WHEN c_custkey % 17 = 5 THEN NULL
                    ELSE DATE '2024-01-30' - CAST((c_custkey * 13) % 1500 AS INT) END AS registration_date,
               CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2023-12-01 23:30:00'
                    ELSE TIMESTAMP '2023-05-01 00:30:00' END AS created_at
        FROM customer""",
    "v_accounts": """
        SELECT o_orderkey AS account_id, o_custkey AS client_id,
               CASE WHEN o_orderstatus = 'O' THEN 'CLOSED' ELSE 'ACTIVE' END AS status
        FROM orders""",
    "v_products": """
        SELECT p_partkey AS product_id, (p_partkey * p_partkey) % 1500 AS client_id,
               CASE WHEN p_size <= 40 THEN 'ACTIVE' ELSE 'CLOSED' END AS status
        FROM part""",
    "v_transactions": f"""
        SELECT o_orderkey AS transaction_id, o_custkey AS client_id, {_TX_DAY} AS operation_date,
               {_stamp(_TX_DAY, 'o_orderkey')} AS operation_ts,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CASE WHEN o_orderstatus = 'F' THEN 'C' WHEN o_orderkey % 97 = 0 THEN 'X' ELSE 'D' END AS direction,
               CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 1
                                    WHEN '4-NOT SPECIFIED' THEN 99 END AS channel_id,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 7 AS INT) END AS operation_type_id
        FROM orders""",
    "v_digital_events": """
        SELECT event_id AS digital_event_id, user_id AS client_id, CAST(ts AS TIMESTAMP) AS event_ts,
               CAST(ts AS DATE) AS event_date,
               CASE event_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 7 ELSE 8 END AS channel_id,
               CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 8 WHEN 'purchase' THEN 11
                               WHEN 'signup' THEN 1 ELSE 6 END AS event_type_id,
               CASE event_type WHEN 'error' THEN FALSE WHEN 'signup' THEN NULL ELSE TRUE END AS success_flag
        FROM events""",
    "v_appeals": f"""
        SELECT conv_id * 100 + turn AS appeal_id, (conv_id * 7 + turn) % 1500 AS client_id,
               {_stamp(_APPEAL_DAY, 'conv_id')} AS created_ts, {_APPEAL_DAY} AS created_date,
               CASE conv_id % 3 WHEN 0 THEN 5 WHEN 1 THEN 3 END AS channel_id
        FROM conversations""",
    "v_segment_history": """
        SELECT c_custkey * 3 + k AS segment_history_id, c_custkey AS client_id,
               CAST((c_custkey + k) % 5 + 1 AS SMALLINT) AS segment_type_id,
               CAST(NULL AS DECIMAL(10,4)) AS score,
               DATE '2023-01-01' + CAST((c_custkey * 7 + k * 11) % 300 AS INT) AS effective_from,
               CAST(NULL AS DATE) AS effective_to,
               (c_custkey + k) % 4 <> 0 AS is_current,
               CASE WHEN (c_custkey + k) % 3 = 0 THEN 'MANUAL' ELSE 'ETL_SEGMENTATION' END AS assigned_by
        FROM (SELECT c_custkey, 0 AS k FROM customer UNION ALL SELECT c_custkey, 1 FROM customer
              UNION ALL SELECT c_custkey, 2 FROM customer) AS t""",
    # staging shapes
    "v_abs_clients_raw": """
        SELECT c_custkey + 1 AS load_seq, 'ABS-' || CAST(c_custkey AS STRING) AS source_client_id,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'b2b' WHEN c_mktsegment = 'BUILDING' THEN ''
                    ELSE 'retail' END AS client_type,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'First' || CAST(c_custkey % 50 AS STRING) END AS first_name,
               c_name AS last_name,
               CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Mid' END AS middle_name,
               CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '1980-02-1' || CAST(c_custkey % 10 AS STRING) END AS birth_date,
               CAST(DATE '2024-01-30' - CAST((c_custkey * 13) % 1500 AS INT) AS STRING) AS registration_date,
               CASE WHEN c_custkey % 10 = 0 THEN ''
                    WHEN c_custkey % 7 = 1 THEN ' ' || CAST((c_custkey * c_custkey) % 1201 AS STRING) || ' '
                    ELSE CAST((c_custkey * c_custkey) % 1201 AS STRING) END AS tax_id,
               '+7' || CAST(c_custkey AS STRING) AS phone, CAST(NULL AS STRING) AS email,
               CAST(c_nationkey AS STRING) AS region_code,
               CASE WHEN c_acctbal < 0 THEN 'BLOCKED' ELSE '' END AS status
        FROM customer""",
    "v_crm_clients_raw": """
        SELECT s_suppkey + 1 AS load_seq, 'CRM-' || CAST(s_suppkey % 70 AS STRING) AS source_client_id,
               CASE WHEN s_suppkey % 9 = 0 THEN NULL
                    WHEN s_suppkey % 5 = 0 THEN 'N' || CAST(s_suppkey % 20 AS STRING)
                    ELSE CAST((s_suppkey * 3) % 40 AS STRING) END AS tax_id,
               '+8' || CAST(s_suppkey AS STRING) AS phone, s_name AS email,
               CAST(s_nationkey AS STRING) AS region_code
        FROM supplier""",
    "v_accounts_raw": f"""
        SELECT o_orderkey + 1 AS load_seq, 'A' || CAST(o_orderkey AS STRING) AS source_account_id,
               CASE WHEN o_orderkey % 13 = 0 THEN 'ABS-X' ELSE 'ABS-' || CAST(o_custkey AS STRING) END AS source_client_id,
               CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE '****' || CAST(o_orderkey % 1000 AS STRING) END AS account_number_masked,
               o_orderpriority AS account_type,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'EURO' END AS currency_code,
               {_ORDER_DAY} AS opened_at, CASE WHEN o_orderstatus = 'F' THEN {_ORDER_DAY} ELSE '' END AS closed_at,
               CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'BLOCKED' END AS status
        FROM orders
        UNION ALL
        SELECT o_orderkey + 1000000001, 'A' || CAST(o_orderkey AS STRING), 'ABS-' || CAST(o_custkey AS STRING),
               'second', 'second', 'USD', '2020-01-01', '', 'CLOSED'
        FROM orders WHERE o_orderkey % 11 = 0""",
    "v_products_raw": """
        SELECT p_partkey + 1 AS load_seq, 'P' || CAST(p_partkey AS STRING) AS source_product_id,
               CASE WHEN p_partkey % 13 = 0 THEN 'ABS-X' ELSE 'ABS-' || CAST(p_partkey % 1000 AS STRING) END AS source_client_id,
               CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'A' || CAST(p_partkey * 2 AS STRING) END AS source_account_id,
               CASE p_partkey % 4 WHEN 0 THEN ' LOAN ' WHEN 1 THEN 'DEPOSIT' WHEN 2 THEN 'card' ELSE '' END AS product_type_code,
               p_name AS product_name,
               CASE WHEN p_size < 10 THEN '' ELSE 'EURO' END AS currency_code,
               '2021-03-0' || CAST(p_partkey % 9 + 1 AS STRING) AS opened_at, '' AS closed_at,
               CASE WHEN p_size <= 40 THEN '' ELSE 'CLOSED' END AS status,
               REPLACE(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING), '.', ',') AS amount_limit,
               CASE WHEN p_partkey % 2 = 0 THEN '4.5' ELSE '' END AS interest_rate
        FROM part
        UNION ALL
        SELECT p_partkey + 1000000001, 'P' || CAST(p_partkey AS STRING), 'ABS-' || CAST(p_partkey % 900 AS STRING),
               '', 'LOAN', 'second', 'USD', '2022-01-01', '', 'CLOSED', '7', '7'
        FROM part WHERE p_partkey % 11 = 0""",
    "v_transactions_raw": f"""
        SELECT o_orderkey + 1 AS load_seq, 'T' || CAST(o_orderkey AS STRING) AS source_transaction_id,
               CASE WHEN o_orderkey % 13 = 0 THEN 'ABS-X' ELSE 'ABS-' || CAST(o_custkey AS STRING) END AS source_client_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'A' || CAST(o_orderkey AS STRING) ELSE '' END AS source_account_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'P' || CAST(o_orderkey % 3000 AS STRING) END AS source_product_id,
               CASE o_orderkey % 4 WHEN 0 THEN 'MB' WHEN 1 THEN 'mb' WHEN 2 THEN 'ONLINE' ELSE 'BRANCH' END AS channel_code,
               CASE o_orderkey % 3 WHEN 0 THEN 'PAYMENT' WHEN 1 THEN 'CAMT_STMT' ELSE ' FEE' END AS operation_type_code,
               CASE WHEN o_orderkey % 31 = 0 THEN ' ' ELSE {_ORDER_DAY} || 'T01:30:00+03:00' END AS operation_ts,
               CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE REPLACE({_PRICE}, '.', ',') END AS amount,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'EURO' END AS currency_code,
               CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE '' END AS direction,
               'POSTED' AS status, o_orderpriority AS merchant_name, 'first' AS description
        FROM orders
        UNION ALL
        SELECT o_orderkey + 1000000001, 'T' || CAST(o_orderkey AS STRING), 'ABS-' || CAST(o_custkey AS STRING),
               '', '', 'IB', 'SALARY', {_ORDER_DAY} || 'T23:30:00-02:00', '1,50', 'USD', 'C',
               CASE WHEN o_orderkey % 2 = 0 THEN 'REVERSED' END, 'second', 'second'
        FROM orders WHERE o_orderkey % 11 = 0""",
    "v_events_raw": """
        SELECT event_id + 1 AS load_seq, 'E' || CAST(event_id AS STRING) AS source_event_id,
               CASE WHEN event_id % 13 = 0 THEN 'ABS-X' ELSE 'ABS-' || CAST(user_id AS STRING) END AS source_client_id,
               CASE event_id % 3 WHEN 0 THEN ' MB ' WHEN 1 THEN 'IB' ELSE 'nowhere' END AS channel_code,
               CASE event_type WHEN 'click' THEN 'SCREEN_VIEW' WHEN 'view' THEN ' balance_view' WHEN 'purchase' THEN 'payment_created'
                               WHEN 'signup' THEN 'LOGIN' ELSE 'login_failed' END AS event_type_code,
               CASE WHEN event_id % 37 = 0 THEN '' ELSE CAST(CAST(ts AS DATE) AS STRING) || 'T01:15:00+05:00' END AS event_ts,
               'PHONE' AS device_type, CAST(NULL AS STRING) AS platform, 'S' || CAST(event_id % 100 AS STRING) AS session_id,
               CASE event_type WHEN 'error' THEN 'False' WHEN 'signup' THEN '' WHEN 'view' THEN 'yes' ELSE 'true' END AS success_flag,
               CASE WHEN event_id % 5 = 0 THEN '{bad' WHEN event_id % 5 = 1 THEN ''
                    ELSE '{"k":' || CAST(event_id % 100 AS STRING) || '}' END AS payload_json
        FROM events
        UNION ALL
        SELECT event_id + 1000000001, 'E' || CAST(event_id AS STRING), 'ABS-' || CAST(user_id AS STRING), 'WEB', 'LOGOUT',
               CAST(CAST(ts AS DATE) AS STRING) || 'T12:00:00Z', 'DESKTOP', 'Web', '', 'no', '{}'
        FROM events WHERE event_id % 11 = 0""",
    "v_appeals_raw": f"""
        SELECT conv_id * 1000 + turn + 1 AS load_seq, 'Q' || CAST(conv_id * 100 + turn AS STRING) AS source_appeal_id,
               CASE WHEN conv_id % 13 = 0 THEN 'ABS-X' ELSE 'ABS-' || CAST((conv_id * 7 + turn) % 150 AS STRING) END AS source_client_id,
               CASE conv_id % 3 WHEN 0 THEN 'CC' WHEN 1 THEN 'IB' ELSE 'fax' END AS channel_code,
               CASE turn % 2 WHEN 0 THEN 'CLAIM' ELSE 'consumer' END AS appeal_type_code,
               CASE WHEN conv_id % 19 = 0 THEN '' ELSE CAST({_APPEAL_DAY} AS STRING) || 'T01:00:00+03:00' END AS created_ts,
               CASE WHEN turn = 1 THEN CAST({_APPEAL_DAY} AS STRING) || 'T20:00:00Z' ELSE '' END AS resolved_ts,
               CASE WHEN turn = 1 THEN 'CLOSED' ELSE '' END AS status,
               CASE conv_id % 3 WHEN 0 THEN '2' WHEN 1 THEN 'high' ELSE '' END AS priority, text AS result_text
        FROM conversations
        UNION ALL
        SELECT conv_id * 1000 + turn + 1000000001, 'Q' || CAST(conv_id * 100 + turn AS STRING),
               'ABS-' || CAST((conv_id * 7 + turn) % 150 AS STRING), 'MB', 'CLAIM',
               '2024-01-15T10:00:00Z', '', 'REOPENED', '1', 'second'
        FROM conversations WHERE conv_id % 4 = 0""",
    "v_catalog_raw": """
        SELECT p_partkey + 1 AS load_seq, CAST(p_partkey % 1500 AS INT) AS product_id, p_name AS product_name,
               p_brand AS product_group, p_type AS description,
               CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS STRING) || ',25' END AS interest_rate,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) AS credit_limit,
               CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN 'yes' ELSE 'N' END AS active_flag,
               'PART' AS source_system
        FROM part""",
    "v_marketing_raw": """
        SELECT o_orderkey + 1 AS load_seq,
               CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE 'CMP' || CAST(o_orderkey % 4 AS STRING) END AS campaign_id,
               CASE WHEN o_orderkey % 13 = 0 THEN 'nobody' ELSE ' ABS-' || CAST(o_custkey AS STRING) || ' ' END AS customer_id,
               CASE WHEN o_orderkey % 6 = 0 THEN '4x' ELSE CAST(20 + o_orderkey % 60 AS STRING) END AS age,
               o_orderpriority AS job, 'single' AS marital, o_orderstatus AS education, 'no' AS default_flag,
               'yes' AS housing_loan, 'no' AS personal_loan, 'cellular' AS contact_channel,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS last_contact_date,
               CAST(o_orderkey % 9 AS STRING) AS campaign_contacts, 'unknown' AS previous_outcome,
               CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END AS term_deposit_subscribed
        FROM orders""",
    "v_credit_raw": """
        SELECT o_orderkey + 1 AS load_seq,
               CASE WHEN o_orderkey % 13 = 0 THEN 'nobody' ELSE ' ABS-' || CAST(o_custkey AS STRING) END AS customer_id,
               REPLACE(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), '.', ',') AS limit_balance,
               'F' AS sex, o_orderstatus AS education, 'x' AS marriage, CAST(20 + o_orderkey % 60 AS STRING) AS age,
               CASE o_orderkey % 4 WHEN 0 THEN '-1' WHEN 1 THEN ' 2 ' WHEN 2 THEN 'late' ELSE '' END AS pay_status_m1,
               '0' AS pay_status_m2, '10' AS bill_amt_m1, '' AS bill_amt_m2, '1.005' AS pay_amt_m1, '2,5' AS pay_amt_m2,
               CAST(o_orderkey % 2 AS STRING) AS default_next_month
        FROM orders""",
    # feed shapes
    "v_tsv_transactions": f"""
        SELECT o_orderkey + 1 AS load_seq,
               CASE WHEN o_orderkey % 41 = 0 THEN '  ' ELSE ' X' || CAST(o_orderkey AS STRING) END AS transaction_id,
               CAST(o_custkey AS STRING) || ' ' AS client_id,
               CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'A' || CAST(o_orderkey AS STRING) END AS account_id,
               CASE o_orderkey % 7 WHEN 0 THEN 'NaN' WHEN 1 THEN 'abc' WHEN 2 THEN '0' WHEN 3 THEN ''
                    WHEN 4 THEN '-' || REPLACE({_PRICE}, '.', ',') ELSE {_PRICE} END AS amount,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE {_ORDER_DAY} || ' 10:00' END AS transaction_date,
               CASE o_orderkey % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN ' api ' WHEN 2 THEN '' ELSE 'Branch' END AS channel,
               CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'TRANSFER ' END AS operation_type,
               CASE WHEN o_orderkey % 2 = 0 THEN 'EUROPOUNDS' ELSE NULL END AS currency,
               o_orderpriority AS merchant_category, ' ' AS counterparty
        FROM orders""",
    "v_tsv_catalog": """
        SELECT p_partkey + 1 AS load_seq,
               CASE p_partkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'P' || CAST(p_partkey AS STRING)
                    ELSE ' ' || CAST(p_partkey AS STRING) END AS product_id,
               ' ' || p_name AS product_name, p_brand AS product_group, '' AS description,
               CAST(p_size AS STRING) AS interest_rate, ' ' AS credit_limit, 'Y' AS active_flag, p_type AS source_system
        FROM part""",
    "v_event_lines": """
        SELECT event_id + 1 AS load_seq,
               CASE WHEN event_id % 50 = 0 THEN '{bad' WHEN event_id % 50 = 1 THEN '  ' WHEN event_id % 50 = 2 THEN '[1]'
                    ELSE '{"event_id":"E' || CAST(event_id AS STRING) || '","customer_id":"ABS-' || CAST(user_id AS STRING)
                         || '","channel":" MB ","event_type":"' || event_type || '","event_time":"' || CAST(CAST(ts AS DATE) AS STRING)
                         || 'T10:00:00Z","success":' || CASE event_type WHEN 'error' THEN 'false' WHEN 'signup' THEN 'null'
                         WHEN 'view' THEN '"false"' WHEN 'click' THEN '0' ELSE 'true' END
                         || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"ip_country":"IN","other":1' END || '}' END AS line
        FROM events""",
}

_NAME = re.compile(r"\b[vo]_[a-z0-9_]+\b")


def with_views(sql: str, more: dict[str, str] | None = None) -> str:
    """`sql` with the views it mentions (directly or through others) as CTEs."""
    known = {**VIEWS, **(more or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in known and name not in ordered:
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    ctes = ",\n".join(f"{name} AS ({known[name]})" for name in ordered)
    return f"WITH {ctes}\n{sql}" if ctes else sql


class Views:
    """The given tables of one folder and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def __call__(self, name: str) -> DataFrame:
        text = VIEWS[name]
        for table in TABLES:
            if re.search(rf"\b{table}\b", text):
                self.table(table).createOrReplaceTempView(table)
        return self.spark.sql(text)
