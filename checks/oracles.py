"""The SQL each registered query is compared with, written in the set-at-a-time
form of the rules (window functions, unions and joins) rather than in the shape of
the Spark plan."""

from __future__ import annotations

from checks.views import with_views

RD = "DATE '2024-01-30'"
D0, D1 = "DATE '2022-12-26'", RD
NOW = "'2024-01-31 00:00:00.000'"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%g')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def num(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def strip(x: str) -> str:
    return f"TRIM({x}, ' ' || chr(9) || chr(10) || chr(13))"


def blank(x: str) -> str:
    return f"NULLIF({x}, '')"


def dec(x: str, scale: int = 2) -> str:
    return f"CAST(REPLACE(NULLIF(TRIM({x}), ''), ',', '.') AS DECIMAL(18,{scale}))"


def _direction(code: str) -> str:
    return f"SUM(CASE WHEN direction = '{code}' THEN amount ELSE 0 END)"


def _upsert(source: str, key: str, first: list[str], last: list[str]) -> str:
    """First row's and last row's columns of every key, by window functions."""
    picked = ", ".join([f"f.{c}" for c in first] + [f"l.{c}" for c in last])
    return f"""
        SELECT f.{key}, {picked} FROM
        (SELECT * FROM {source} QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY load_seq) = 1) f
        JOIN (SELECT * FROM {source} QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY load_seq DESC) = 1) l
        ON f.{key} = l.{key}"""


_PROFILE_COLUMNS = f"""
    {day('report_date')} AS report_date, client_id, unified_client_key, client_type, status, region_code,
    active_accounts_cnt, active_products_cnt, {num('debit_turnover_30d')} AS debit_turnover_30d,
    {num('credit_turnover_30d')} AS credit_turnover_30d, operations_cnt_30d, digital_events_cnt_30d,
    appeals_cnt_90d, {ts('last_transaction_ts')} AS last_transaction_ts,
    {ts('last_digital_event_ts')} AS last_digital_event_ts, current_segment_type_id"""

PARTS: dict[str, str] = {
    # identity
    "o_people": """
        SELECT 1 AS sys, source_client_id, load_seq AS seq, tax_id, TRIM(COALESCE(tax_id, '')) AS tax,
               client_type, first_name, last_name, middle_name, birth_date, registration_date, phone, email,
               region_code, status FROM v_abs_clients_raw
        UNION ALL
        SELECT 2, source_client_id, load_seq + 72057594037927936, tax_id, TRIM(COALESCE(tax_id, '')),
               NULL, NULL, NULL, NULL, NULL, NULL, phone, email, region_code, NULL FROM v_crm_clients_raw""",
    "o_founded": """
        SELECT *, MIN(seq) OVER (PARTITION BY CASE WHEN tax <> '' THEN 'T' || tax ELSE 'R' || CAST(seq AS VARCHAR) END)
               AS founder_seq FROM o_people""",
    "o_resolved": """
        SELECT *, DENSE_RANK() OVER (ORDER BY founder_seq) AS client_id, seq = founder_seq AS founder FROM o_founded""",
    "o_lookup": """
        SELECT source_client_id AS src, client_id FROM o_resolved WHERE sys = 1
        QUALIFY ROW_NUMBER() OVER (PARTITION BY source_client_id ORDER BY seq DESC) = 1""",
    "o_new_clients": """
        SELECT client_id, COALESCE(NULLIF(client_type, ''), 'INDIVIDUAL') AS client_type, first_name, last_name,
               middle_name, NULLIF(TRIM(concat_ws(' ', NULLIF(last_name, ''), NULLIF(first_name, ''), NULLIF(middle_name, ''))), '')
               AS full_name, NULLIF(birth_date, '') AS birth_date, registration_date, tax_id, phone, email,
               region_code, COALESCE(NULLIF(status, ''), 'ACTIVE') AS status
        FROM o_resolved WHERE founder""",
    # accepted fact rows, numbered in load order
    "o_accounts_in": f"""
        SELECT r.*, c.client_id, ROW_NUMBER() OVER (ORDER BY load_seq) AS account_id,
               LEFT(COALESCE(NULLIF(currency_code, ''), 'RUB'), 3) AS currency,
               COALESCE(NULLIF(status, ''), 'ACTIVE') AS state
        FROM v_accounts_raw r JOIN o_lookup c ON c.src = r.source_client_id""",
    "o_accounts": _upsert(
        "o_accounts_in", "source_account_id",
        ["account_id", "account_number_masked", "account_type", "currency", "opened_at", "closed_at"],
        ["client_id", "state"],
    ),
    "o_products_in": f"""
        SELECT r.*, c.client_id, a.account_id, ROW_NUMBER() OVER (ORDER BY r.load_seq) AS product_id,
               COALESCE(t.product_type_id, 1) AS product_type_id, LEFT(NULLIF(currency_code, ''), 3) AS currency,
               COALESCE(NULLIF(status, ''), 'ACTIVE') AS state, {dec('amount_limit')} AS limit_value,
               {dec('interest_rate', 4)} AS rate_value
        FROM v_products_raw r JOIN o_lookup c ON c.src = r.source_client_id
        LEFT JOIN o_accounts a ON a.source_account_id = r.source_account_id
        LEFT JOIN v_product_types t ON t.product_type_code = TRIM(r.product_type_code)""",
    "o_products": _upsert(
        "o_products_in", "source_product_id",
        ["product_id", "product_type_id", "product_name", "currency", "opened_at", "limit_value", "rate_value"],
        ["client_id", "account_id", "state"],
    ),
    "o_transactions_in": f"""
        SELECT r.*, c.client_id, a.account_id, p.product_id, ch.channel_id, o.operation_type_id,
               ROW_NUMBER() OVER (ORDER BY r.load_seq) AS transaction_id,
               CAST(LEFT(operation_ts, 10) AS DATE) AS operation_date,
               CAST(LEFT(operation_ts, 10) || ' ' || SUBSTRING(operation_ts, 12, 8) AS TIMESTAMP)
                 - CAST(SUBSTRING(operation_ts, 20, 3) AS INT) * INTERVAL 1 HOUR AS instant,
               COALESCE({dec('amount')}, 0) AS value,
               LEFT(COALESCE(NULLIF(currency_code, ''), 'RUB'), 3) AS currency,
               COALESCE(NULLIF(direction, ''), 'D') AS side
        FROM v_transactions_raw r JOIN o_lookup c ON c.src = r.source_client_id
        LEFT JOIN o_accounts a ON a.source_account_id = r.source_account_id
        LEFT JOIN o_products p ON p.source_product_id = r.source_product_id
        LEFT JOIN v_channels ch ON ch.channel_code = r.channel_code
        LEFT JOIN v_operation_types o ON o.operation_type_code = r.operation_type_code
        WHERE TRIM(r.operation_ts) <> ''""",
    "o_transactions": _upsert(
        "o_transactions_in", "source_transaction_id",
        ["transaction_id", "client_id", "account_id", "product_id", "channel_id", "operation_type_id",
         "operation_date", "instant", "currency", "side", "merchant_name", "description"],
        ["value", "status"],
    ),
    "o_events_in": """
        SELECT r.*, c.client_id, ch.channel_id, e.event_type_id, ROW_NUMBER() OVER (ORDER BY load_seq) AS digital_event_id,
               CAST(LEFT(event_ts, 10) AS DATE) AS event_date,
               CASE WHEN success_flag <> '' THEN CASE WHEN LOWER(success_flag) IN ('1', 'true', 'yes', 't')
                    THEN 'true' ELSE 'false' END END AS success,
               CASE WHEN payload_json IN ('', '{bad') THEN '{}' ELSE payload_json END AS payload
        FROM v_events_raw r JOIN o_lookup c ON c.src = r.source_client_id
        JOIN v_channels ch ON ch.channel_code = TRIM(r.channel_code)
        JOIN v_event_types e ON e.event_type_code = TRIM(r.event_type_code)
        WHERE event_ts <> ''""",
    "o_appeals_in": """
        SELECT r.*, c.client_id, ch.channel_id, t.appeal_type_id, ROW_NUMBER() OVER (ORDER BY load_seq) AS appeal_id,
               CASE WHEN regexp_full_match(priority, '[0-9]+') THEN CAST(priority AS BIGINT) END AS rank,
               COALESCE(NULLIF(status, ''), 'OPEN') AS state
        FROM v_appeals_raw r JOIN o_lookup c ON c.src = r.source_client_id
        LEFT JOIN v_channels ch ON ch.channel_code = r.channel_code
        LEFT JOIN v_appeal_types t ON t.appeal_type_code = r.appeal_type_code
        WHERE created_ts <> ''""",
    "o_catalog_in": f"""
        SELECT *, {dec('interest_rate', 4)} AS rate, {dec('credit_limit')} AS limit_value,
               UPPER(LEFT(NULLIF(active_flag, ''), 1)) AS flag FROM v_catalog_raw WHERE product_id <> 0""",
    "o_leads_in": """
        SELECT r.*, c.client_id, CAST(c.client_id AS VARCHAR) || '/' || campaign_id AS k,
               ROW_NUMBER() OVER (ORDER BY load_seq) AS id,
               CASE WHEN regexp_full_match(age, '[0-9]+') THEN CAST(age AS BIGINT) END AS years
        FROM v_marketing_raw r JOIN o_lookup c ON c.src = TRIM(r.customer_id) WHERE campaign_id <> ''""",
    "o_credit_in": f"""
        SELECT r.*, c.client_id, ROW_NUMBER() OVER (ORDER BY load_seq) AS id, TRIM(customer_id) AS customer,
               {dec('limit_balance')} AS balance, TRY_CAST(NULLIF(TRIM(pay_status_m1), '') AS BIGINT) AS late,
               CAST(default_next_month AS BIGINT) AS defaults
        FROM v_credit_raw r JOIN o_lookup c ON c.src = TRIM(r.customer_id)""",
    # segments and profile
    # Everything a client does as one list of dated rows.
    "o_moves": """
        SELECT 'T' AS kind, client_id, operation_date AS day, operation_ts AS moment, channel_id, NULL::BOOLEAN AS ok,
               CASE direction WHEN 'D' THEN amount ELSE 0 END AS paid, CASE direction WHEN 'C' THEN amount ELSE 0 END AS got
        FROM v_transactions
        UNION ALL SELECT 'E', client_id, event_date, event_ts, channel_id, success_flag, 0, 0 FROM v_digital_events
        UNION ALL SELECT 'A', client_id, created_date, NULL, channel_id, NULL, 0, 0 FROM v_appeals""",
    "o_tx30": f"""
        SELECT client_id, COUNT(*) AS op_30, SUM(paid) AS debit_30, SUM(got) AS credit_30
        FROM o_moves WHERE kind = 'T' AND {RD} - day BETWEEN 0 AND 30 GROUP BY client_id""",
    "o_metrics": f"""
        SELECT client_id, COALESCE(any_value(registration_date), CAST(any_value(created_at) AS DATE)) AS anchor_date,
               COUNT(*) FILTER (WHERE kind = 'T' AND {RD} - day BETWEEN 0 AND 30) AS op_30,
               COALESCE(SUM(paid + got) FILTER (WHERE {RD} - day BETWEEN 0 AND 30), 0) AS turnover_30,
               MAX(moment) FILTER (WHERE kind = 'T') AS last_tx_ts, MAX(moment) FILTER (WHERE kind = 'E') AS last_ev_ts,
               COUNT(*) FILTER (WHERE kind = 'E' AND {RD} - day BETWEEN 0 AND 30) AS ev_30,
               (SELECT COUNT(*) FROM v_products p WHERE p.client_id = v_clients.client_id AND p.status = 'ACTIVE') AS active_products
        FROM v_clients LEFT JOIN o_moves USING (client_id) GROUP BY client_id""",
    "o_segments": f"""
        SELECT client_id, arg_min(segment, place) AS segment_type_id FROM (
            SELECT client_id, 1 AS place, 3 AS segment FROM o_metrics WHERE {RD} - anchor_date <= 90
            UNION ALL SELECT client_id, 2, 4 FROM o_metrics
            WHERE COALESCE({RD} - GREATEST(CAST(last_tx_ts AS DATE), CAST(last_ev_ts AS DATE)) > 180, TRUE)
            UNION ALL SELECT client_id, 3, 5 FROM o_metrics WHERE turnover_30 >= 250000 OR op_30 >= 12 OR active_products >= 4
            UNION ALL SELECT client_id, 4, 1 FROM o_metrics WHERE op_30 >= 3 OR ev_30 >= 6 OR turnover_30 >= 15000
            UNION ALL SELECT client_id, 5, 2 FROM o_metrics) GROUP BY client_id""",
    "o_kept_history": "SELECT * FROM v_segment_history WHERE assigned_by <> 'ETL_SEGMENTATION'",
    "o_history": f"""
        SELECT segment_history_id, client_id, segment_type_id, effective_from, is_current, assigned_by FROM o_kept_history
        UNION ALL
        SELECT (SELECT COALESCE(MAX(segment_history_id), 0) FROM o_kept_history) + ROW_NUMBER() OVER (ORDER BY client_id),
               client_id, segment_type_id, {RD}, TRUE, 'ETL_SEGMENTATION' FROM o_segments""",
    "o_current": """
        SELECT client_id, segment_type_id FROM v_segment_history WHERE is_current
        QUALIFY ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY effective_from DESC, segment_history_id DESC) = 1""",
    "o_profile": f"""
        SELECT {RD} AS report_date, c.client_id, c.unified_client_key, c.client_type, c.status, c.region_code,
               COALESCE((SELECT COUNT(*) FROM v_accounts a WHERE a.client_id = c.client_id AND a.status = 'ACTIVE'), 0) AS active_accounts_cnt,
               COALESCE((SELECT COUNT(*) FROM v_products p WHERE p.client_id = c.client_id AND p.status = 'ACTIVE'), 0) AS active_products_cnt,
               COALESCE(t.debit, 0) AS debit_turnover_30d, COALESCE(t.credit, 0) AS credit_turnover_30d,
               COALESCE(t.n, 0) AS operations_cnt_30d, COALESCE(e.n, 0) AS digital_events_cnt_30d,
               COALESCE((SELECT COUNT(*) FROM v_appeals x WHERE x.client_id = c.client_id AND x.created_date >= {RD} - 90), 0) AS appeals_cnt_90d,
               t.last_ts AS last_transaction_ts, e.last_ts AS last_digital_event_ts, {big('s.segment_type_id')} AS current_segment_type_id
        FROM v_clients c
        LEFT JOIN (SELECT client_id, {_direction('D')} AS debit, {_direction('C')} AS credit, COUNT(*) AS n, MAX(operation_ts) AS last_ts
                   FROM v_transactions WHERE operation_date >= {RD} - 30 GROUP BY 1) t ON t.client_id = c.client_id
        LEFT JOIN (SELECT client_id, COUNT(*) AS n, MAX(event_ts) AS last_ts FROM v_digital_events
                   WHERE event_date >= {RD} - 30 GROUP BY 1) e ON e.client_id = c.client_id
        LEFT JOIN o_current s ON s.client_id = c.client_id""",
    # marts
    "o_day": f"""
        SELECT kind, day AS activity_date, client_id, paid, got, ok,
               COALESCE((SELECT channel_code FROM v_channels ch WHERE ch.channel_id = o_moves.channel_id), 'UNKNOWN') AS channel_code
        FROM o_moves WHERE day BETWEEN {D0} AND {D1}""",
    "o_activity": """
        SELECT activity_date, client_id, channel_code, COUNT(*) FILTER (WHERE kind = 'T') AS operations_cnt,
               SUM(paid) AS debit_amount, SUM(got) AS credit_amount, COUNT(*) FILTER (WHERE kind = 'E') AS digital_events_cnt,
               COUNT(*) FILTER (WHERE ok) AS digital_success_cnt, COUNT(*) FILTER (WHERE NOT ok) AS digital_fail_cnt,
               COUNT(*) FILTER (WHERE kind = 'A') AS appeals_opened_cnt
        FROM o_day GROUP BY ALL""",
    "o_tx_day": "SELECT * FROM o_activity WHERE operations_cnt > 0",
    "o_ev_day": "SELECT * FROM o_activity WHERE digital_events_cnt > 0",
    "o_ap_day": "SELECT * FROM o_activity WHERE appeals_opened_cnt > 0",
    "o_financial": f"""
        SELECT operation_date AS activity_date, client_id,
               COALESCE((SELECT channel_code FROM v_channels c WHERE c.channel_id = t.channel_id), 'UNKNOWN') AS channel_code,
               COALESCE((SELECT operation_type_code FROM v_operation_types o WHERE o.operation_type_id = t.operation_type_id), 'UNKNOWN')
                 AS operation_type_code,
               COUNT(*) AS operation_cnt, COALESCE(SUM(amount) FILTER (WHERE direction = 'D'), 0) AS debit_amount,
               COALESCE(SUM(amount) FILTER (WHERE direction = 'C'), 0) AS credit_amount
        FROM v_transactions t WHERE operation_date BETWEEN {D0} AND {D1} GROUP BY ALL""",
    "o_digital": f"""
        SELECT event_date AS activity_date, client_id,
               COALESCE((SELECT channel_code FROM v_channels c WHERE c.channel_id = t.channel_id), 'UNKNOWN') AS channel_code,
               COALESCE((SELECT event_type_code FROM v_event_types k WHERE k.event_type_id = t.event_type_id), 'UNKNOWN') AS event_type_code,
               COUNT(*) AS event_cnt, COUNT(*) FILTER (WHERE success_flag) AS success_cnt,
               COUNT(*) FILTER (WHERE NOT success_flag) AS fail_cnt
        FROM v_digital_events t WHERE event_date BETWEEN {D0} AND {D1} GROUP BY ALL""",
    "o_segment_metrics": f"""
        SELECT {RD} AS report_date, COALESCE(current_segment_type_id, 0) AS segment_type_id, COUNT(*) AS clients_cnt,
               COUNT(*) FILTER (WHERE operations_cnt_30d > 0 OR digital_events_cnt_30d > 0) AS active_clients_30d,
               SUM(debit_turnover_30d) AS total_debit_turnover_30d, SUM(credit_turnover_30d) AS total_credit_turnover_30d,
               SUM(operations_cnt_30d) AS total_operations_30d,
               CAST(CAST(SUM(operations_cnt_30d) AS DOUBLE) / COUNT(*) AS FLOAT) AS avg_operations_per_client
        FROM o_profile GROUP BY 2""",
}

_ACTIVITY = f"""{day('activity_date')} AS activity_date, client_id, channel_code, operations_cnt,
    {num('debit_amount')} AS debit_amount, {num('credit_amount')} AS credit_amount, {big('digital_events_cnt')} AS digital_events_cnt,
    {big('digital_success_cnt')} AS digital_success_cnt, {big('digital_fail_cnt')} AS digital_fail_cnt, appeals_opened_cnt"""
_FINANCIAL = f"""{day('activity_date')} AS activity_date, client_id, channel_code, operation_type_code, operation_cnt,
    {num('debit_amount')} AS debit_amount, {num('credit_amount')} AS credit_amount"""
_DIGITAL = f"""{day('activity_date')} AS activity_date, client_id, channel_code, event_type_code, event_cnt,
    {big('success_cnt')} AS success_cnt, {big('fail_cnt')} AS fail_cnt"""
_SEGMENT_METRICS = f"""{day('report_date')} AS report_date, segment_type_id, clients_cnt, active_clients_30d,
    {num('total_debit_turnover_30d')} AS total_debit_turnover_30d, {num('total_credit_turnover_30d')} AS total_credit_turnover_30d,
    {big('total_operations_30d')} AS total_operations_30d, {num('avg_operations_per_client')} AS avg_operations_per_client"""
_TX_STAGING = """source_transaction_id, source_client_id, source_account_id, source_product_id, channel_code,
    operation_type_code, operation_ts, amount, currency_code, direction, status, merchant_name, description"""
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_FLOAT_TEXT = "CAST(CAST({x} AS DOUBLE) AS VARCHAR)"
_RANGE = "activity_date BETWEEN DATE '2023-06-01' AND DATE '2024-01-30'"

ORACLES: dict[str, str] = {
    # sources
    "src_delimited": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
               CASE WHEN c_custkey % 2 = 0 THEN c_name || ';"' || c_mktsegment || '"' END AS c_name, c_mktsegment FROM customer""",
    "src_csv_set": """
        SELECT 'abs_clients_raw' AS table_name, source_client_id AS source_id, NULLIF(tax_id, '') AS value,
               CAST(CASE WHEN load_seq % 2 = 1 THEN 0 ELSE 1 END AS BIGINT) AS root FROM v_abs_clients_raw
        UNION ALL SELECT 'crm_clients_raw', source_client_id, tax_id, 0 FROM v_crm_clients_raw
        UNION ALL SELECT 'abs_accounts_raw', source_account_id, NULLIF(status, ''), 0 FROM v_accounts_raw
        UNION ALL SELECT 'abs_products_raw', source_product_id, NULLIF(amount_limit, ''), 0 FROM v_products_raw
        UNION ALL SELECT 'abs_transactions_raw', source_transaction_id, NULLIF(amount, ''), 0 FROM v_transactions_raw
        UNION ALL SELECT 'dbo_events_raw', source_event_id, NULLIF(payload_json, ''), 0 FROM v_events_raw
        UNION ALL SELECT 'appeals_raw', source_appeal_id, NULLIF(result_text, ''), 0 FROM v_appeals_raw""",
    "src_manifest": """
        SELECT CAST(c_custkey AS VARCHAR) AS source_client_id,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'BUSINESS' ELSE 'INDIVIDUAL' END AS client_type,
               c_name AS last_name, CAST(c_nationkey AS VARCHAR) AS region_code, 'ACTIVE' AS status,
               CAST(NULL AS VARCHAR) AS tax_id FROM customer""",
    "norm_manifest_rows": f"""
        SELECT 'client' AS kind, source_client_id AS id,
               CASE WHEN client_type = 'b2b' THEN 'BUSINESS' WHEN client_type = '' THEN '' ELSE 'INDIVIDUAL' END AS a,
               COALESCE(NULLIF(status, ''), 'ACTIVE') AS b, CAST(NULL AS VARCHAR) AS c, CAST(NULL AS VARCHAR) AS d FROM v_abs_clients_raw
        UNION ALL
        SELECT 'transaction', source_transaction_id, channel_code, COALESCE(NULLIF(currency_code, ''), 'INR'),
               COALESCE(NULLIF(direction, ''), 'D'), COALESCE(status, 'POSTED') FROM v_transactions_raw
        UNION ALL
        SELECT 'account', source_account_id,
               CASE WHEN account_number_masked = '' THEN '****' || RIGHT(source_account_id, 4) ELSE account_number_masked END,
               NULL, NULL, NULL FROM v_accounts_raw""",
    "src_tsv_transactions": f"""
        SELECT 'X' || CAST(o_orderkey AS VARCHAR) AS source_transaction_id, CAST(o_custkey AS VARCHAR) AS source_client_id,
               CASE WHEN o_orderkey % 3 <> 0 THEN 'A' || CAST(o_orderkey AS VARCHAR) END AS source_account_id,
               CASE o_orderkey % 4 WHEN 0 THEN 'MB' WHEN 1 THEN 'API' WHEN 2 THEN 'ONLINE' ELSE 'BRANCH' END AS channel_code,
               CASE WHEN o_orderkey % 2 = 0 THEN 'PAYMENT' ELSE 'TRANSFER' END AS operation_type_code,
               CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T12:00:00+00:00' END AS operation_ts,
               CASE WHEN o_orderkey % 7 = 2 THEN '0.0' ELSE {_FLOAT_TEXT.format(x=_PRICE)} END AS amount,
               CASE WHEN o_orderkey % 2 = 0 THEN 'EUROPOUN' ELSE 'INR' END AS currency_code,
               CASE WHEN o_orderkey % 7 = 4 AND o_totalprice > 0 THEN 'D' ELSE 'C' END AS direction, 'POSTED' AS status,
               o_orderpriority AS merchant_name, CAST(NULL AS VARCHAR) AS description
        FROM orders WHERE o_orderkey % 41 <> 0 AND o_orderkey % 7 NOT IN (0, 1, 3)""",
    "src_tsv_catalog": """
        SELECT CASE WHEN p_partkey % 5 = 1 THEN 0 ELSE p_partkey END AS product_id, p_name AS product_name, p_brand AS product_group,
               CAST(NULL AS VARCHAR) AS description, CAST(p_size AS VARCHAR) AS interest_rate, CAST(NULL AS VARCHAR) AS credit_limit,
               'Y' AS active_flag, p_type AS source_system FROM part WHERE p_partkey % 5 <> 0""",
    "src_event_jsonl": """
        SELECT 'E' || CAST(event_id AS VARCHAR) AS source_event_id, 'ABS-' || CAST(user_id AS VARCHAR) AS source_client_id,
               'MB' AS channel_code, event_type AS event_type_code, CAST(CAST(ts AS DATE) AS VARCHAR) || 'T10:00:00Z' AS event_ts,
               CAST(NULL AS VARCHAR) AS device_type,
               CASE event_type WHEN 'error' THEN 'false' WHEN 'signup' THEN NULL WHEN 'click' THEN 'false' ELSE 'true' END AS success_flag,
               CASE WHEN event_id % 3 <> 0 THEN '{"ip_country":"IN"}' END AS payload_json
        FROM events WHERE event_id % 50 > 2""",
    "src_openbanking_accounts": """
        SELECT 'A' || CAST(o_orderkey AS VARCHAR) AS source_account_id, CAST(o_custkey AS VARCHAR) AS source_client_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'nick' ELSE '****A' || CAST(o_orderkey AS VARCHAR) END AS account_number_masked,
               CASE WHEN o_orderkey % 4 = 0 THEN 'ACCOUNT' WHEN o_orderkey % 4 = 1 THEN 'Personal'
                    ELSE 'Personal / ' || o_orderpriority END AS account_type,
               CASE WHEN o_orderkey % 5 = 0 THEN 'INR' ELSE 'GBP' END AS currency_code,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS opened_at,
               CASE o_orderstatus WHEN 'F' THEN 'ACTIVE' WHEN 'O' THEN 'DISABLED' ELSE 'ACTIVE' END AS status
        FROM orders""",
    "src_openbanking_transactions": f"""
        SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS source_transaction_id, CAST(o_custkey AS VARCHAR) AS source_client_id,
               'A' || CAST(o_orderkey AS VARCHAR) AS source_account_id, 'ONLINE' AS channel_code,
               CASE WHEN o_orderkey % 2 = 0 THEN 'PMNT' ELSE 'PAYMENT' END AS operation_type_code,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T09:00:00Z' AS operation_ts,
               CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE {_PRICE} END AS amount,
               CASE WHEN o_orderkey % 3 = 0 THEN 'INR' ELSE 'GBP' END AS currency_code,
               CASE o_orderstatus WHEN 'F' THEN 'C' ELSE 'D' END AS direction, 'POSTED' AS status,
               CASE WHEN o_orderkey % 4 = 0 THEN 'shop' END AS merchant_name, o_orderpriority AS description
        FROM orders""",
    "src_complaints": """
        SELECT 'Q' || CAST(conv_id * 100 + turn AS VARCHAR) AS source_appeal_id, CAST(conv_id AS VARCHAR) AS source_client_id,
               CASE turn % 4 WHEN 0 THEN 'TELEPHONE' WHEN 1 THEN 'REFERRAL' WHEN 2 THEN 'WEB' ELSE 'WEB' END AS channel_code,
               'CONSUMER' AS appeal_type_code,
               CAST(DATE '2024-01-30' - CAST(conv_id % 200 AS INT) AS VARCHAR) || 'T00:00:00Z' AS created_ts,
               CASE conv_id % 3 WHEN 0 THEN 'CLOSED' ELSE 'OPEN' END AS status, '2' AS priority,
               concat_ws(' ', NULLIF(role, ''), NULLIF(LEFT(text, 500), '')) AS result_text
        FROM conversations WHERE turn % 7 <> 6""",
    "src_camt": f"""
        SELECT 'ISO' || kind || '-R' || CAST(o_orderkey AS VARCHAR) AS source_transaction_id,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS source_client_id,
               CAST(o_custkey AS VARCHAR) AS source_account_id, operation AS operation_type_code,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T12:00:00+00:00' AS operation_ts,
               {_FLOAT_TEXT.format(x=_PRICE)} AS amount, CASE WHEN o_orderkey % 2 = 0 THEN 'EUR' ELSE 'INR' END AS currency_code,
               CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'D' END AS direction,
               CASE WHEN o_orderkey % 4 = 0 THEN 'pay & <go>' ELSE 'camt ' || kind END AS description
        FROM orders, (VALUES ('053', 'CAMT_STMT'), ('054', 'CAMT_NTF')) AS m(kind, operation) WHERE o_orderkey % 5 <> 0 AND o_orderkey <> 0""",
    "account_client_map": """
        SELECT 'A' || CAST(o_orderkey % 4000 AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS source_client_id FROM orders
        WHERE o_orderkey % 6 <> 0
        QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey % 4000 ORDER BY o_orderkey DESC) = 1""",
    "src_crm_campaigns": """
        SELECT 'CMP' || CAST(c_custkey % 4 AS VARCHAR) AS campaign_id, 'ABS-' || CAST(c_custkey AS VARCHAR) AS customer_id,
               CAST(c_custkey % 60 AS VARCHAR) AS age, LEFT(repeat(c_mktsegment, 9), 64) AS job,
               CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS campaign_contacts,
               LEFT('subscribed', 8) AS term_deposit_subscribed
        FROM customer WHERE c_custkey % 8 <> 0""",
    "src_credit_risk": """
        SELECT 'ABS-' || CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_acctbal <> 0 THEN CAST(c_acctbal AS VARCHAR) END AS limit_balance,
               LEFT(c_mktsegment, 8) AS sex, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 3 AS VARCHAR) END AS pay_status_m1,
               CAST(NULL AS VARCHAR) AS pay_status_m2, CAST(c_custkey % 2 AS VARCHAR) AS default_next_month
        FROM customer WHERE c_custkey % 8 <> 0""",
    "stg_append": """
        SELECT load_seq AS id, 7::BIGINT AS batch_id, source_client_id, NULLIF(client_type, '') AS client_type,
               NULLIF(tax_id, '') AS tax_id, NULLIF(status, '') AS status, CAST(NULL AS VARCHAR) AS reject_reason FROM v_abs_clients_raw""",
    "stg_batch_counts": """
        SELECT 'abs_clients_raw' AS table_name, COUNT(*) AS rows_cnt FROM v_abs_clients_raw UNION ALL
        SELECT 'crm_clients_raw', COUNT(*) FROM v_crm_clients_raw UNION ALL
        SELECT 'abs_accounts_raw', COUNT(*) FROM v_accounts_raw UNION ALL
        SELECT 'abs_products_raw', COUNT(*) FROM v_products_raw UNION ALL
        SELECT 'abs_transactions_raw', COUNT(*) FROM v_transactions_raw UNION ALL
        SELECT 'dbo_events_raw', COUNT(*) FROM v_events_raw UNION ALL
        SELECT 'appeals_raw', COUNT(*) FROM v_appeals_raw UNION ALL
        SELECT name, 0 FROM (VALUES ('product_catalog_raw'), ('crm_marketing_raw'), ('credit_risk_raw')) AS t(name)""",
    "stg_scan_batch": """
        SELECT source_transaction_id, ROW_NUMBER() OVER (ORDER BY load_seq) AS place, description FROM v_transactions_raw""",
    "reset_tables": """
        SELECT 'clients' AS table_name, COUNT(*) AS rows_before, 0::BIGINT AS rows_after FROM v_clients UNION ALL
        SELECT 'abs_clients_raw', COUNT(*), 0 FROM v_abs_clients_raw UNION ALL SELECT 'channels', COUNT(*), COUNT(*) FROM v_channels""",
    # conforming
    "parse_scalars": f"""
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 4 < 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed_date,
               CASE o_orderkey % 4 WHEN 0 THEN {ts("CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL 90 MINUTE")}
                    WHEN 1 THEN {ts("CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 630 MINUTE")} END AS parsed_ts,
               CASE WHEN o_orderkey % 4 < 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed_local_date,
               CASE WHEN o_orderkey % 3 < 2 THEN {num('CAST(o_totalprice AS DECIMAL(18,2))')} END AS parsed_decimal,
               CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS parsed_bool,
               CASE WHEN o_orderkey % 3 = 2 THEN 'true' ELSE 'false' END AS decimal_unreadable
        FROM orders""",
    "surrogate_ids": """
        SELECT o_orderkey, 1000 + ROW_NUMBER() OVER (ORDER BY o_orderkey) AS id FROM orders""",
    "resolve_abs_clients": """
        SELECT source_client_id, client_id, CASE WHEN founder THEN 'ABS_TAX_KEY' ELSE 'ABS_DEDUP_TAX' END AS match_rule,
               CASE WHEN founder THEN 'true' ELSE 'false' END AS is_primary FROM o_resolved WHERE sys = 1""",
    "resolve_crm_clients": """
        SELECT seq - 72057594037927936 AS load_seq, source_client_id, client_id, 'CRM_TAX_MATCH' AS match_rule, 'false' AS is_primary,
               CASE WHEN founder THEN 'true' ELSE 'false' END AS created FROM o_resolved WHERE sys = 2""",
    "new_clients": """
        SELECT client_id, client_type, first_name, last_name, middle_name, full_name, birth_date, registration_date, tax_id,
               phone, email, region_code, status FROM o_new_clients""",
    "client_source_map": """
        SELECT sys::BIGINT AS source_system_id, source_client_id, client_id,
               CASE WHEN sys = 1 AND ever THEN 'true' ELSE 'false' END AS is_primary,
               CASE WHEN sys = 2 THEN 'CRM_TAX_MATCH' WHEN founder THEN 'ABS_TAX_KEY' ELSE 'ABS_DEDUP_TAX' END AS match_rule
        FROM (SELECT *, BOOL_OR(founder) OVER (PARTITION BY sys, source_client_id) AS ever FROM o_resolved)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY sys, source_client_id ORDER BY seq DESC) = 1""",
    "source_client_lookup": "SELECT src AS source_client_id, client_id FROM o_lookup",
    "client_history": f"""
        SELECT 500 + client_id AS client_history_id, client_id, full_name, phone, status, {NOW} AS effective_from,
               CAST(NULL AS VARCHAR) AS effective_to, 'true' AS is_current FROM o_new_clients""",
    "dictionary_lookup": f"""
        SELECT r.load_seq, {big('ch.channel_id')} AS channel_id, {big('o.operation_type_id')} AS operation_type_id FROM v_transactions_raw r
        LEFT JOIN v_channels ch ON ch.channel_code = r.channel_code
        LEFT JOIN v_operation_types o ON o.operation_type_code = r.operation_type_code""",
    "load_accounts": """
        SELECT account_id, source_account_id, client_id, account_number_masked, account_type, currency AS currency_code, opened_at,
               NULLIF(closed_at, '') AS closed_at, state AS status FROM o_accounts""",
    "load_products": f"""
        SELECT product_id, source_product_id, client_id, account_id, {big('product_type_id')} AS product_type_id, product_name,
               currency AS currency_code, opened_at, state AS status, {num('limit_value')} AS amount_limit,
               {num('rate_value')} AS interest_rate FROM o_products""",
    "load_transactions": f"""
        SELECT transaction_id, source_transaction_id, client_id, account_id, product_id, {big('channel_id')} AS channel_id,
               {big('operation_type_id')} AS operation_type_id, {ts('instant')} AS operation_ts, {day('operation_date')} AS operation_date,
               {num('value')} AS amount, currency AS currency_code, side AS direction, status, merchant_name, description
        FROM o_transactions""",
    "load_digital_events": f"""
        SELECT f.digital_event_id, f.source_event_id, f.client_id, {big('f.channel_id')} AS channel_id,
               {big('f.event_type_id')} AS event_type_id, {day('f.event_date')} AS event_date, f.session_id, l.success AS success_flag, f.payload
        FROM (SELECT * FROM o_events_in QUALIFY ROW_NUMBER() OVER (PARTITION BY source_event_id ORDER BY load_seq) = 1) f
        JOIN (SELECT * FROM o_events_in QUALIFY ROW_NUMBER() OVER (PARTITION BY source_event_id ORDER BY load_seq DESC) = 1) l
        ON f.source_event_id = l.source_event_id""",
    "load_appeals": f"""
        SELECT f.appeal_id, f.source_appeal_id, f.client_id, {big('f.channel_id')} AS channel_id, {big('f.appeal_type_id')} AS appeal_type_id,
               {ts("CASE WHEN f.created_ts LIKE '%Z' THEN CAST(REPLACE(REPLACE(f.created_ts, 'T', ' '), 'Z', '') AS TIMESTAMP) ELSE CAST(LEFT(f.created_ts, 10) AS TIMESTAMP) - INTERVAL 2 HOUR END")} AS created_ts,
               CASE WHEN l.resolved_ts <> '' THEN LEFT(l.resolved_ts, 10) || ' 20:00:00.000' END AS resolved_ts,
               l.state AS status, f.rank AS priority, f.result_text
        FROM (SELECT * FROM o_appeals_in QUALIFY ROW_NUMBER() OVER (PARTITION BY source_appeal_id ORDER BY load_seq) = 1) f
        JOIN (SELECT * FROM o_appeals_in QUALIFY ROW_NUMBER() OVER (PARTITION BY source_appeal_id ORDER BY load_seq DESC) = 1) l
        ON f.source_appeal_id = l.source_appeal_id""",
    "load_product_catalog": f"""
        SELECT {big('product_id')} AS product_id, product_name, product_group, description, {num('rate')} AS interest_rate,
               {num('limit_value')} AS credit_limit, flag AS active_flag, source_system FROM o_catalog_in
        QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY load_seq DESC) = 1""",
    "load_marketing_leads": """
        SELECT f.id, f.client_id, f.campaign_id, l.years AS age, l.job, f.education, f.last_contact_date,
               CAST(f.campaign_contacts AS BIGINT) AS campaign_contacts, l.term_deposit_subscribed
        FROM (SELECT * FROM o_leads_in QUALIFY ROW_NUMBER() OVER (PARTITION BY k ORDER BY load_seq) = 1) f
        JOIN (SELECT * FROM o_leads_in QUALIFY ROW_NUMBER() OVER (PARTITION BY k ORDER BY load_seq DESC) = 1) l ON f.k = l.k""",
    "load_credit_risk": f"""
        SELECT f.id, f.client_id, f.customer AS source_customer_id, {num('l.balance')} AS limit_balance, f.education,
               CAST(f.age AS BIGINT) AS age, f.late AS pay_status_m1, 0::BIGINT AS pay_status_m2, 10.0::DOUBLE AS bill_amt_m1,
               CAST(NULL AS DOUBLE) AS bill_amt_m2, 1.01::DOUBLE AS pay_amt_m1, 2.5::DOUBLE AS pay_amt_m2, l.defaults AS default_next_month
        FROM (SELECT * FROM o_credit_in QUALIFY ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY load_seq) = 1) f
        JOIN (SELECT * FROM o_credit_in QUALIFY ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY load_seq DESC) = 1) l
        ON f.client_id = l.client_id""",
    "referential_filter": """
        SELECT t.transaction_id, CASE WHEN c.client_id IS NULL THEN 'unresolved client' END AS reject_reason
        FROM v_transactions t LEFT JOIN v_clients c ON c.client_id = t.client_id AND c.status = 'ACTIVE'""",
    "load_rejects": """
        SELECT r.load_seq, CASE WHEN c.client_id IS NULL THEN 'unresolved client' ELSE 'blank operation_ts' END AS reject_reason
        FROM v_transactions_raw r LEFT JOIN o_lookup c ON c.src = r.source_client_id
        WHERE c.client_id IS NULL OR TRIM(r.operation_ts) = ''""",
    "fold_upsert": f"""
        SELECT COALESCE(t.k, f.k) AS source_transaction_id, COALESCE(t.description, f.description) AS description,
               {num("CASE WHEN l.k IS NULL THEN t.amount ELSE l.amount END")} AS amount,
               CASE WHEN l.k IS NULL THEN t.status ELSE l.status END AS status
        FROM (SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS k, 'target' AS description, CAST(5 AS DECIMAL(18,2)) AS amount, 'OLD' AS status
              FROM orders WHERE o_orderkey % 4 = 1) t
        FULL JOIN (SELECT source_transaction_id AS k, description FROM v_transactions_raw
                   QUALIFY ROW_NUMBER() OVER (PARTITION BY source_transaction_id ORDER BY load_seq) = 1) f ON f.k = t.k
        LEFT JOIN (SELECT source_transaction_id AS k, {dec('amount')} AS amount, status FROM v_transactions_raw
                   QUALIFY ROW_NUMBER() OVER (PARTITION BY source_transaction_id ORDER BY load_seq DESC) = 1) l ON l.k = f.k""",
    "merge_batches": f"""
        SELECT transaction_id, 'T' || CAST(transaction_id AS VARCHAR) AS source_transaction_id,
               strftime(operation_date, '%Y-%m-%d') AS operation_date,
               {num("amount + CASE WHEN transaction_id % 50 = 7 THEN 1 ELSE 0 END")} AS amount,
               CASE WHEN transaction_id % 50 = 7 THEN 'CORRECTED' WHEN transaction_id % 9 = 0 THEN 'LATE' ELSE 'NEW' END AS status,
               CASE WHEN transaction_id % 50 = 7 THEN COUNT(*) FILTER (WHERE transaction_id % 50 = 7) OVER () END AS returned_cnt
        FROM v_transactions""",
    "seed_dictionaries": f"""
        SELECT {big('ch.channel_id')} AS channel_id, ch.channel_code, COUNT(t.transaction_id) AS transactions_cnt
        FROM v_channels ch LEFT JOIN v_transactions t ON t.channel_id = ch.channel_id GROUP BY 1, 2""",
    # segments
    "tx_window_30d": f"""
        SELECT client_id, op_30, {num('debit_30')} AS debit_30, {num('credit_30')} AS credit_30 FROM o_tx30""",
    "last_transaction": f"SELECT client_id, {ts('MAX(operation_ts)')} AS last_tx_ts FROM v_transactions GROUP BY 1",
    "last_digital_event": f"SELECT client_id, {ts('MAX(event_ts)')} AS last_ev_ts FROM v_digital_events GROUP BY 1",
    "events_window_30d": f"""
        SELECT client_id, COUNT(*) AS ev_30 FROM v_digital_events WHERE event_date >= {RD} - 30 AND event_date <= {RD} GROUP BY 1""",
    "active_products": "SELECT client_id, COUNT(*) AS active_products FROM v_products WHERE status = 'ACTIVE' GROUP BY 1",
    "client_metrics": f"""
        SELECT client_id, {day('anchor_date')} AS anchor_date, op_30, {num('turnover_30')} AS turnover_30,
               {ts('last_tx_ts')} AS last_tx_ts, {ts('last_ev_ts')} AS last_ev_ts, ev_30, active_products FROM o_metrics""",
    "segment_classify": f"SELECT client_id, {big('segment_type_id')} AS segment_type_id FROM o_segments",
    "segment_history": f"""
        SELECT segment_history_id, client_id, {big('segment_type_id')} AS segment_type_id, {day('effective_from')} AS effective_from,
               CAST(is_current AS VARCHAR) AS is_current, assigned_by FROM o_history""",
    "profile_accounts": "SELECT client_id, COUNT(*) AS active_accounts_cnt FROM v_accounts WHERE status = 'ACTIVE' GROUP BY 1",
    "profile_products": "SELECT client_id, COUNT(*) AS active_products_cnt FROM v_products WHERE status = 'ACTIVE' GROUP BY 1",
    "profile_transactions": f"""
        SELECT client_id, {num(_direction('D'))} AS debit_turnover_30d, {num(_direction('C'))} AS credit_turnover_30d,
               COUNT(*) AS operations_cnt_30d, {ts('MAX(operation_ts)')} AS last_transaction_ts
        FROM v_transactions WHERE operation_date >= {RD} - 30 GROUP BY 1""",
    "profile_events": f"""
        SELECT client_id, COUNT(*) AS digital_events_cnt_30d, {ts('MAX(event_ts)')} AS last_digital_event_ts
        FROM v_digital_events WHERE event_date >= {RD} - 30 GROUP BY 1""",
    "profile_appeals": f"""
        SELECT client_id, COUNT(*) AS appeals_cnt_90d FROM v_appeals WHERE created_date >= {RD} - 90 GROUP BY 1""",
    "profile_current_segment": f"SELECT client_id, {big('segment_type_id')} AS current_segment_type_id FROM o_current",
    "profile_export": f"SELECT {_PROFILE_COLUMNS} FROM o_profile",
    # marts
    "mart_client_profile": f"SELECT {_PROFILE_COLUMNS} FROM o_profile",
    "mart_segment_metrics": f"SELECT {_SEGMENT_METRICS} FROM o_segment_metrics",
    "activity_tx_daily": f"""
        SELECT {day('activity_date')} AS activity_date, client_id, channel_code, operations_cnt,
               {num('debit_amount')} AS debit_amount, {num('credit_amount')} AS credit_amount FROM o_tx_day""",
    "activity_events_daily": f"""
        SELECT {day('activity_date')} AS activity_date, client_id, channel_code, digital_events_cnt,
               {big('digital_success_cnt')} AS digital_success_cnt, {big('digital_fail_cnt')} AS digital_fail_cnt FROM o_ev_day""",
    "activity_appeals_daily": f"""
        SELECT {day('activity_date')} AS activity_date, client_id, channel_code, appeals_opened_cnt FROM o_ap_day""",
    "mart_client_activity_daily": f"SELECT {_ACTIVITY} FROM o_activity",
    "mart_financial_activity_daily": f"SELECT {_FINANCIAL} FROM o_financial",
    "mart_digital_activity_daily": f"SELECT {_DIGITAL} FROM o_digital",
    "replace_report_date": f"""
        SELECT {day('report_date')} AS report_date, segment_type_id, SUM(clients_cnt)::BIGINT AS clients_cnt FROM (
            SELECT {RD} AS report_date, segment_type_id, clients_cnt FROM o_segment_metrics
            UNION ALL SELECT {RD} - 1, {big('segment_type_id')}, COUNT(*) FROM o_segments GROUP BY 2) GROUP BY 1, 2""",
    "replace_date_range": f"""
        SELECT {day('activity_date')} AS activity_date, client_id, channel_code, operation_type_code, operation_cnt
        FROM o_financial WHERE activity_date < {RD} - 300 OR activity_date > {RD} - 200 OR channel_code = 'MB'""",
    "mart_insert": f"""
        SELECT COUNT(*) AS rows_reported, COUNT(*) AS rows_stored, 'true' AS stamped FROM o_digital""",
    "mart_layout": f"""
        SELECT {day('activity_date')} AS activity_date, COUNT(*) AS rows_cnt, COUNT(DISTINCT client_id) AS clients_cnt,
               'true' AS in_order FROM o_financial GROUP BY 1""",
    "segmentation_view": f"""
        SELECT p.client_id, p.current_segment_type_id, COALESCE(l.segment_type_code, 'UNKNOWN') AS segment_type_code,
               COALESCE(l.segment_type_name, 'Не задан') AS segment_type_name FROM o_profile p
        LEFT JOIN v_segment_labels l ON l.segment_type_id = COALESCE(p.current_segment_type_id, 0)""",
    # serving
    "q_client_profile": f"SELECT {_PROFILE_COLUMNS} FROM (SELECT * FROM o_profile ORDER BY client_id LIMIT 200 OFFSET 100)",
    "q_client_profile_one": f"SELECT {_PROFILE_COLUMNS} FROM o_profile WHERE client_id = 42",
    "q_client_segmentation": """
        SELECT p.client_id, p.current_segment_type_id, COALESCE(l.segment_type_code, 'UNKNOWN') AS segment_type_code,
               COALESCE(l.segment_type_name, 'Не задан') AS segment_type_name
        FROM (SELECT * FROM o_profile ORDER BY client_id LIMIT 2000) p
        LEFT JOIN v_segment_labels l ON l.segment_type_id = COALESCE(p.current_segment_type_id, 0)""",
    "q_segment_metrics": f"SELECT {_SEGMENT_METRICS} FROM o_segment_metrics",
    "q_client_activity_daily": f"""
        SELECT {_ACTIVITY} FROM (SELECT * FROM o_activity WHERE {_RANGE}
                                 ORDER BY activity_date, client_id, channel_code LIMIT 500 OFFSET 50)""",
    "q_financial_activity_daily": f"""
        SELECT {_FINANCIAL} FROM (SELECT * FROM o_financial WHERE {_RANGE} AND client_id = 55
                                  ORDER BY activity_date, client_id, channel_code, operation_type_code LIMIT 200)""",
    "q_digital_activity_daily": f"""
        SELECT {_DIGITAL} FROM (SELECT * FROM o_digital WHERE {_RANGE}
                                ORDER BY activity_date, client_id, channel_code, event_type_code LIMIT 2000 OFFSET 100)""",
    "as_json_numbers": f"""
        SELECT client_id, {num('debit_turnover_30d')} AS debit_turnover_30d, {num('credit_turnover_30d')} AS credit_turnover_30d FROM o_profile""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, PARTS) for name, sql in ORACLES.items()}
