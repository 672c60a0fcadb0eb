"""Table layouts: staging widths, core types, conflict keys and update lists."""

from __future__ import annotations

from dataclasses import dataclass

# Staging columns with the width of each (None = unlimited text).
STAGING: dict[str, dict[str, int | None]] = {
    "abs_clients_raw": {
        "source_client_id": 100, "client_type": 20, "first_name": 100, "last_name": 100,
        "middle_name": 100, "birth_date": 32, "registration_date": 32, "tax_id": 20,
        "phone": 30, "email": 255, "region_code": 20, "status": 30,
    },
    "crm_clients_raw": {
        "source_client_id": 100, "tax_id": 20, "phone": 30, "email": 255,
        "region_code": 20, "loyalty_tier": 50,
    },
    "abs_accounts_raw": {
        "source_account_id": 100, "source_client_id": 100, "account_number_masked": 34,
        "account_type": 50, "currency_code": 8, "opened_at": 32, "closed_at": 32, "status": 30,
    },
    "abs_products_raw": {
        "source_product_id": 100, "source_client_id": 100, "source_account_id": 100,
        "product_type_code": 50, "product_name": 200, "currency_code": 8, "opened_at": 32,
        "closed_at": 32, "status": 30, "amount_limit": 32, "interest_rate": 32,
    },
    "abs_transactions_raw": {
        "source_transaction_id": 100, "source_client_id": 100, "source_account_id": 100,
        "source_product_id": 100, "channel_code": 50, "operation_type_code": 50,
        "operation_ts": 64, "amount": 32, "currency_code": 8, "direction": 1, "status": 30,
        "merchant_name": 255, "description": None,
    },
    "dbo_events_raw": {
        "source_event_id": 100, "source_client_id": 100, "channel_code": 50,
        "event_type_code": 50, "event_ts": 64, "device_type": 50, "platform": 50,
        "session_id": 100, "success_flag": 10, "payload_json": None,
    },
    "appeals_raw": {
        "source_appeal_id": 100, "source_client_id": 100, "channel_code": 50,
        "appeal_type_code": 50, "created_ts": 64, "resolved_ts": 64, "status": 30,
        "priority": 16, "result_text": None,
    },
    "product_catalog_raw": {
        "product_id": None, "product_name": 200, "product_group": 50, "description": None,
        "interest_rate": 32, "credit_limit": 32, "active_flag": 4, "source_system": 64,
    },
    "crm_marketing_raw": {
        "campaign_id": 32, "customer_id": 32, "age": 16, "job": 64, "marital": 32,
        "education": 32, "default_flag": 16, "housing_loan": 16, "personal_loan": 16,
        "contact_channel": 32, "last_contact_date": 32, "campaign_contacts": 16,
        "previous_outcome": 32, "term_deposit_subscribed": 8,
    },
    "credit_risk_raw": {
        "customer_id": 32, "limit_balance": 32, "sex": 8, "education": 32, "marriage": 32,
        "age": 16, "pay_status_m1": 8, "pay_status_m2": 8, "bill_amt_m1": 32,
        "bill_amt_m2": 32, "pay_amt_m1": 32, "pay_amt_m2": 32, "default_next_month": 4,
    },
}

# Staging columns that may not be NULL.
STAGING_REQUIRED: dict[str, tuple[str, ...]] = {
    "abs_clients_raw": ("source_client_id",),
    "crm_clients_raw": ("source_client_id",),
    "abs_accounts_raw": ("source_account_id", "source_client_id"),
    "abs_products_raw": ("source_product_id", "source_client_id"),
    "abs_transactions_raw": ("source_transaction_id", "source_client_id"),
    "dbo_events_raw": ("source_event_id", "source_client_id", "channel_code", "event_type_code"),
    "appeals_raw": ("source_appeal_id", "source_client_id"),
    "product_catalog_raw": ("product_id",),
    "crm_marketing_raw": (),
    "credit_risk_raw": ("customer_id",),
}


def staging_columns(table: str) -> tuple[str, ...]:
    return tuple(STAGING[table])


@dataclass(frozen=True)
class Table:
    """A core table: its schema, the upsert key and the columns an upsert changes."""

    schema: str
    key: tuple[str, ...]
    updates: tuple[str, ...] = ()
    id: str | None = None

    @property
    def columns(self) -> list[str]:
        return [field.strip().split(" ")[0] for field in _split_fields(self.schema)]


def _split_fields(schema: str) -> list[str]:
    fields, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            fields.append(schema[start:i])
            start = i + 1
    return [*fields, schema[start:]]


CORE: dict[str, Table] = {
    "clients": Table(
        "client_id bigint, unified_client_key string, client_type string, first_name string, "
        "last_name string, middle_name string, full_name string, birth_date date, "
        "registration_date date, tax_id string, phone string, email string, region_code string, "
        "status string, created_at timestamp, updated_at timestamp",
        key=("client_id",), id="client_id",
    ),
    "client_history": Table(
        "client_history_id bigint, client_id bigint, full_name string, phone string, email string, "
        "region_code string, status string, effective_from timestamp, effective_to timestamp, "
        "is_current boolean",
        key=("client_history_id",), id="client_history_id",
    ),
    "client_source_map": Table(
        "source_system_id smallint, source_client_id string, client_id bigint, is_primary boolean, "
        "match_rule string, matched_at timestamp",
        key=("source_system_id", "source_client_id"),
    ),
    "accounts": Table(
        "account_id bigint, source_system_id smallint, source_account_id string, client_id bigint, "
        "account_number_masked string, account_type string, currency_code string, opened_at date, "
        "closed_at date, status string, created_at timestamp, updated_at timestamp",
        key=("source_system_id", "source_account_id"),
        updates=("client_id", "status", "updated_at"), id="account_id",
    ),
    "products": Table(
        "product_id bigint, source_system_id smallint, source_product_id string, client_id bigint, "
        "account_id bigint, product_type_id smallint, product_name string, currency_code string, "
        "opened_at date, closed_at date, status string, amount_limit decimal(18,2), "
        "interest_rate decimal(9,4), created_at timestamp, updated_at timestamp",
        key=("source_system_id", "source_product_id"),
        updates=("client_id", "account_id", "status", "updated_at"), id="product_id",
    ),
    "transactions": Table(
        "transaction_id bigint, source_system_id smallint, source_transaction_id string, "
        "client_id bigint, account_id bigint, product_id bigint, channel_id smallint, "
        "operation_type_id smallint, operation_ts timestamp, operation_date date, "
        "amount decimal(18,2), currency_code string, direction string, status string, "
        "merchant_name string, description string, created_at timestamp",
        key=("source_system_id", "source_transaction_id"),
        updates=("amount", "status"), id="transaction_id",
    ),
    "digital_events": Table(
        "digital_event_id bigint, source_system_id smallint, source_event_id string, "
        "client_id bigint, channel_id smallint, event_type_id smallint, event_ts timestamp, "
        "event_date date, device_type string, platform string, session_id string, "
        "success_flag boolean, payload string, created_at timestamp",
        key=("source_system_id", "source_event_id"),
        updates=("success_flag",), id="digital_event_id",
    ),
    "appeals": Table(
        "appeal_id bigint, source_system_id smallint, source_appeal_id string, client_id bigint, "
        "channel_id smallint, appeal_type_id smallint, created_ts timestamp, resolved_ts timestamp, "
        "status string, priority smallint, result_text string, created_at timestamp",
        key=("source_system_id", "source_appeal_id"),
        updates=("status", "resolved_ts"), id="appeal_id",
    ),
    "ref_product_catalog": Table(
        "product_id int, product_name string, product_group string, description string, "
        "interest_rate decimal(12,4), credit_limit decimal(18,2), active_flag string, "
        "source_system string, created_at timestamp",
        key=("product_id",),
        updates=("product_name", "product_group", "description", "interest_rate",
                 "credit_limit", "active_flag", "source_system"),
    ),
    "crm_marketing_leads": Table(
        "id bigint, client_id bigint, campaign_id string, age int, job string, marital string, "
        "education string, default_flag string, housing_loan string, personal_loan string, "
        "contact_channel string, last_contact_date date, campaign_contacts int, "
        "previous_outcome string, term_deposit_subscribed string, created_at timestamp",
        key=("client_id", "campaign_id"),
        updates=("age", "job", "term_deposit_subscribed"), id="id",
    ),
    "credit_risk_features": Table(
        "id bigint, client_id bigint, source_customer_id string, limit_balance decimal(18,2), "
        "sex string, education string, marriage string, age int, pay_status_m1 int, "
        "pay_status_m2 int, bill_amt_m1 decimal(18,2), bill_amt_m2 decimal(18,2), "
        "pay_amt_m1 decimal(18,2), pay_amt_m2 decimal(18,2), default_next_month smallint, "
        "created_at timestamp",
        key=("client_id",),
        updates=("limit_balance", "default_next_month"), id="id",
    ),
    "client_segments_history": Table(
        "segment_history_id bigint, client_id bigint, segment_type_id smallint, "
        "score decimal(10,4), effective_from date, effective_to date, is_current boolean, "
        "assigned_by string",
        key=("segment_history_id",), id="segment_history_id",
    ),
    "client_profile_export": Table(
        "report_date date, client_id bigint, unified_client_key string, client_type string, "
        "status string, region_code string, active_accounts_cnt int, active_products_cnt int, "
        "debit_turnover_30d decimal(18,2), credit_turnover_30d decimal(18,2), "
        "operations_cnt_30d int, digital_events_cnt_30d int, appeals_cnt_90d int, "
        "last_transaction_ts timestamp, last_digital_event_ts timestamp, "
        "current_segment_type_id smallint",
        key=("report_date", "client_id"),
    ),
    "load_batch": Table(
        "batch_id bigint, source_system_code string, started_at timestamp, finished_at timestamp, "
        "status string, notes string",
        key=("batch_id",), id="batch_id",
    ),
}


MARTS: dict[str, str] = {
    "mart_client_profile": (
        "report_date date, client_id bigint, unified_client_key string, client_type string, "
        "status string, region_code string, active_accounts_cnt bigint, active_products_cnt bigint, "
        "debit_turnover_30d decimal(18,2), credit_turnover_30d decimal(18,2), "
        "operations_cnt_30d bigint, digital_events_cnt_30d bigint, appeals_cnt_90d bigint, "
        "last_transaction_ts timestamp, last_digital_event_ts timestamp, "
        "current_segment_type_id int, loaded_at timestamp"
    ),
    "mart_segment_metrics": (
        "report_date date, segment_type_id int, clients_cnt bigint, active_clients_30d bigint, "
        "total_debit_turnover_30d decimal(24,2), total_credit_turnover_30d decimal(24,2), "
        "total_operations_30d bigint, avg_operations_per_client float, loaded_at timestamp"
    ),
    "mart_client_activity_daily": (
        "activity_date date, client_id bigint, channel_code string, operations_cnt bigint, "
        "debit_amount decimal(18,2), credit_amount decimal(18,2), digital_events_cnt bigint, "
        "digital_success_cnt bigint, digital_fail_cnt bigint, appeals_opened_cnt bigint, "
        "loaded_at timestamp"
    ),
    "mart_financial_activity_daily": (
        "activity_date date, client_id bigint, channel_code string, operation_type_code string, "
        "operation_cnt bigint, debit_amount decimal(18,2), credit_amount decimal(18,2), "
        "loaded_at timestamp"
    ),
    "mart_digital_activity_daily": (
        "activity_date date, client_id bigint, channel_code string, event_type_code string, "
        "event_cnt bigint, success_cnt bigint, fail_cnt bigint, loaded_at timestamp"
    ),
}

# Order inside a mart file: readers filter by client or page by date.
MART_SORT: dict[str, tuple[str, ...]] = {
    "mart_client_profile": ("client_id",),
    "mart_segment_metrics": ("segment_type_id",),
    "mart_client_activity_daily": ("client_id", "channel_code"),
    "mart_financial_activity_daily": ("client_id", "channel_code", "operation_type_code"),
    "mart_digital_activity_daily": ("client_id", "channel_code", "event_type_code"),
}
MART_DATE: dict[str, str] = {
    name: "report_date" if name in ("mart_client_profile", "mart_segment_metrics") else "activity_date"
    for name in MARTS
}
