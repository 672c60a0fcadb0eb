"""Conforming operators against a row-by-row model of the same rules."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import identity, loaders
from tallyhouse.operators.ids import BLOCK_BITS, surrogate_ids
from tallyhouse.operators.upsert import fold_upsert
from tallyhouse.reference_data import DICTIONARIES, dictionary
from tallyhouse.schemas import CORE

NOW = datetime(2026, 4, 1, 12)


def test_ids_follow_the_order_across_blocks(rows):
    width = 1 << BLOCK_BITS
    order = [5, 0, width - 1, width, 3 * width + 7, 3 * width + 8, 9 * width]
    random.Random(1).shuffle(order)
    got = surrogate_ids(rows("load_seq bigint", *[(o,) for o in order]), "id", after=10).collect()
    assert {r.load_seq: r.id for r in got} == {o: 11 + i for i, o in enumerate(sorted(order))}


def test_ids_of_nothing(rows):
    assert surrogate_ids(rows("load_seq bigint"), "id").count() == 0


def upsert_model(target, incoming, updates):
    table = {r["k"]: dict(r) for r in target}
    for r in sorted(incoming, key=lambda r: r["load_seq"]):
        row = {c: v for c, v in r.items() if c != "load_seq"}
        if row["k"] in table:
            table[row["k"]].update({c: row[c] for c in updates})
        else:
            table[row["k"]] = row
    return table


@pytest.mark.parametrize("updates", [[], ["a"], ["a", "b"]])
@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("with_target", [True, False])
def test_upsert_equals_row_by_row(spark, seed, updates, with_target):
    rng = random.Random(seed)

    def value():
        return rng.choice([None, "x", "y", "z"])

    # One key owns a third of the batch.
    incoming = [
        {"k": "hot" if i % 3 == 0 else f"k{rng.randrange(30)}", "a": value(), "b": value(), "load_seq": i}
        for i in range(200)
    ]
    target = [{"k": f"k{i}", "a": value(), "b": value()} for i in range(0, 40, 3)] if with_target else []
    schema = "k string, a string, b string"
    shuffled = rng.sample(incoming, len(incoming))
    got = fold_upsert(
        spark.createDataFrame([tuple(r.values()) for r in shuffled], schema + ", load_seq bigint"),
        ["k"], updates,
        spark.createDataFrame([tuple(r.values()) for r in target], schema) if with_target else None,
    ).collect()
    assert {r.k: r.asDict() for r in got} == upsert_model(target, incoming, updates)
    assert len(got) == len({r.k for r in got})


ABS_SCHEMA = "load_seq bigint, source_client_id string, tax_id string, last_name string, first_name string, middle_name string, client_type string, status string, phone string"
CRM_SCHEMA = "load_seq bigint, source_client_id string, tax_id string, phone string, email string, region_code string"


def feeds(seed):
    rng = random.Random(seed)

    def tax():
        return rng.choice([None, "", "  ", "100", " 100 ", *[str(rng.randrange(20)) for _ in range(4)]])

    abs_rows = [
        (i, f"A{rng.randrange(60)}", tax(), rng.choice(["L", None]), rng.choice(["F", ""]), None,
         rng.choice(["", "BUSINESS"]), rng.choice(["", "BLOCKED"]), str(i))
        for i in range(1, 81)
    ]
    crm_rows = [(i, f"R{rng.randrange(25)}", rng.choice([tax(), f"N{rng.randrange(5)}"]), str(i), "e", "77")
                for i in range(1, 41)]
    return abs_rows, crm_rows


def identity_model(abs_rows, crm_rows):
    taxes, clients, links, lookup = {}, {}, {}, {}
    for seq, source, tax, last, first, middle, kind, status, phone in abs_rows:
        key = (tax or "").strip()
        if key and key in taxes:
            client = taxes[key]
            old = links.get((1, source))
            links[(1, source)] = (client, old[1] if old else False, "ABS_DEDUP_TAX")
        else:
            client = len(clients) + 1
            if key:
                taxes[key] = client
            name = " ".join(p for p in (last, first, middle) if p).strip() or None
            clients[client] = (kind or "INDIVIDUAL", name, tax, status or "ACTIVE", phone)
            links[(1, source)] = (client, True, "ABS_TAX_KEY")
        lookup[source] = client
    for seq, source, tax, phone, email, region in crm_rows:
        key = (tax or "").strip()
        client = taxes.get(key)
        if client is None:
            client = len(clients) + 1
            if key:
                taxes[key] = client
            clients[client] = ("INDIVIDUAL", None, tax, "ACTIVE", phone)
        links[(2, source)] = (client, False, "CRM_TAX_MATCH")
    return clients, links, lookup


@pytest.mark.parametrize("seed", range(4))
def test_identity_equals_row_by_row(spark, seed):
    abs_rows, crm_rows = feeds(seed)
    rng = random.Random(seed + 100)
    resolved = identity.resolve_identities(
        spark.createDataFrame(rng.sample(abs_rows, len(abs_rows)), ABS_SCHEMA),
        spark.createDataFrame(rng.sample(crm_rows, len(crm_rows)), CRM_SCHEMA),
    )
    clients, links, lookup = identity_model(abs_rows, crm_rows)
    created = identity.new_clients(resolved, NOW)
    got = created.select("client_id", "client_type", "full_name", "tax_id", "status", "phone").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == clients
    got = identity.client_source_map(resolved, NOW).collect()
    assert {(r.source_system_id, r.source_client_id): (r.client_id, r.is_primary, r.match_rule) for r in got} == links
    got = identity.source_client_lookup(resolved).collect()
    assert {r.source_client_id: r.client_id for r in got} == lookup
    keys = [r.unified_client_key for r in created.collect()]
    assert len(set(keys)) == len(clients) and all(len(k) == 36 for k in keys)


def test_known_clients_are_joined_by_tax_id(spark, rows):
    known = rows("client_id bigint, tax_id string", (5, " 100"), (9, "100"), (7, None), (8, "200"))
    abs_raw = rows(ABS_SCHEMA, (1, "A1", "100", *[None] * 6), (2, "A2", "300", *[None] * 6), (3, "A3", " 300", *[None] * 6),
                   (4, "A4", None, *[None] * 6))
    crm_raw = rows(CRM_SCHEMA, (1, "R1", "200", None, None, None), (2, "R2", "300", None, None, None))
    got = identity.resolve_identities(abs_raw, crm_raw, known=known, after=9).collect()
    assert {(r.source_client_id): (r.client_id, r.founder, r.match_rule) for r in got} == {
        "A1": (5, False, "ABS_DEDUP_TAX"), "A2": (10, True, "ABS_TAX_KEY"), "A3": (10, False, "ABS_DEDUP_TAX"),
        "A4": (11, True, "ABS_TAX_KEY"), "R1": (8, False, "CRM_TAX_MATCH"), "R2": (10, False, "CRM_TAX_MATCH"),
    }


def test_source_map_keeps_primary_over_loads(rows):
    schema = CORE["client_source_map"].schema
    target = rows(schema, (1, "A1", 1, True, "ABS_TAX_KEY", NOW), (1, "A2", 2, False, "ABS_DEDUP_TAX", NOW))
    resolved = rows(
        "source_system_id smallint, source_client_id string, client_id bigint, is_primary boolean, match_rule string, load_seq bigint",
        (1, "A1", 4, False, "ABS_DEDUP_TAX", 1), (2, "R1", 4, False, "CRM_TAX_MATCH", 2),
    )
    got = identity.client_source_map(resolved, datetime(2027, 1, 1), target).collect()
    assert {r.source_client_id: (r.client_id, r.is_primary, r.match_rule, r.matched_at.year) for r in got} == {
        "A1": (4, True, "ABS_DEDUP_TAX", 2027), "A2": (2, False, "ABS_DEDUP_TAX", 2026),
        "R1": (4, False, "CRM_TAX_MATCH", 2027),
    }


def test_history_opens_one_version_per_client(rows):
    clients = rows(CORE["clients"].schema, (11, "k", "INDIVIDUAL", *[None] * 4, None, None, None, "p", "e", "r", "ACTIVE", NOW, NOW))
    got = identity.client_history(clients, NOW, after_client=10, after=3).collect()
    assert [(r.client_history_id, r.client_id, r.is_current, r.effective_to) for r in got] == [(4, 11, True, None)]


@pytest.fixture
def lookup(rows):
    return rows("source_client_id string, client_id bigint", ("A1", 1), ("A2", 2))


TX = "load_seq bigint, source_transaction_id string, source_client_id string, source_account_id string, source_product_id string, channel_code string, operation_type_code string, operation_ts string, amount string, currency_code string, direction string, status string, merchant_name string, description string"


def tx(seq, key, client="A1", account=None, product=None, channel="MB", kind="PAYMENT",
       ts="2026-03-15T01:30:00+03:00", amount="1,50", currency="RUBLES", direction="C", status="POSTED", text="t"):
    return (seq, key, client, account, product, channel, kind, ts, amount, currency, direction, status, None, text)


def test_transactions(rows, lookup):
    accounts = rows("source_account_id string, account_id bigint", ("ACC", 70))
    raw = rows(
        TX,
        tx(1, "T1", account="ACC", product="none"),
        tx(2, "T2", client="nobody"),
        tx(3, "T3", ts=" "),
        tx(4, "T4", ts="soon"),
        tx(5, "T5", amount="lots"),
        tx(6, "T6", channel="mb", kind=None, amount=None, currency=None, direction=None, account=""),
        tx(7, "T1", client="A2", amount="9", status=None, text="later"),
    )
    typed = loaders.transactions(raw, lookup, NOW, accounts, None)
    refused = {r.load_seq: r.reject_reason for r in loaders.rejects("transactions", typed).collect()}
    assert refused == {
        2: "unresolved client", 3: "blank operation_ts", 4: "unreadable operation_ts", 5: "unreadable amount"
    }
    got = {r.source_transaction_id: r for r in loaders.into_core("transactions", typed, after=100).collect()}
    assert list(sorted(got)) == ["T1", "T6"]
    first, other = got["T1"], got["T6"]
    # Frozen columns of the first row, amount and status of the last one, also when NULL.
    assert (first.transaction_id, first.client_id, first.account_id, first.product_id) == (101, 1, 70, None)
    assert (first.amount, first.status, first.description) == (Decimal("9.00"), None, "t")
    assert (first.operation_date, first.operation_ts) == (date(2026, 3, 15), datetime(2026, 3, 14, 22, 30))
    assert (first.currency_code, first.channel_id, first.operation_type_id) == ("RUB", 4, 1)
    assert (other.transaction_id, other.amount, other.currency_code, other.direction) == (102, Decimal("0.00"), "RUB", "D")
    assert (other.channel_id, other.operation_type_id, other.account_id) == (None, None, None)


def test_transactions_into_an_existing_table(rows, lookup):
    old = loaders.into_core("transactions", loaders.transactions(rows(TX, tx(1, "T1"), tx(2, "T2")), lookup, NOW))
    later = loaders.transactions(rows(TX, tx(1, "T2", client="A2", amount="7", status=None), tx(2, "T3")), lookup, NOW)
    got = {r.source_transaction_id: r for r in loaders.into_core("transactions", later, after=2, target=old).collect()}
    assert {k: (r.transaction_id, r.client_id, r.amount, r.status) for k, r in got.items()} == {
        "T1": (1, 1, Decimal("1.50"), "POSTED"), "T2": (2, 1, Decimal("7.00"), None), "T3": (4, 1, Decimal("1.50"), "POSTED"),
    }


def test_events_need_channel_type_and_time(rows, lookup):
    schema = "load_seq bigint, source_event_id string, source_client_id string, channel_code string, event_type_code string, event_ts string, device_type string, platform string, session_id string, success_flag string, payload_json string"
    ok = ("A1", " MB ", "LOGIN", "2026-03-15T01:30:00+03:00")
    raw = rows(
        schema,
        (1, "E1", *ok, None, None, None, "True", '{"a": 1}'),
        (2, "E2", "A1", "fax", "LOGIN", ok[3], *[None] * 5),
        (3, "E3", "A1", "MB", "login", ok[3], *[None] * 5),
        (4, "E4", "A1", "MB", "LOGIN", None, *[None] * 5),
        (5, "E1", *ok, "PHONE", None, None, None, "{bad"),
        (6, "E6", *ok, None, None, None, "no", "{bad"),
    )
    typed = loaders.digital_events(raw, lookup, NOW)
    got = {r.source_event_id: r for r in loaders.into_core("digital_events", typed).collect()}
    assert {k: (r.digital_event_id, r.success_flag, r.payload, r.device_type, r.event_date) for k, r in got.items()} == {
        "E1": (1, None, '{"a":1}', None, date(2026, 3, 15)), "E6": (3, False, "{}", None, date(2026, 3, 15)),
    }
    assert {r.reject_reason for r in loaders.rejects("digital_events", typed).collect()} == {
        "unknown channel", "unknown event type", "blank event_ts"
    }


def test_products_fall_back_to_the_default_type(rows, lookup):
    schema = "load_seq bigint, source_product_id string, source_client_id string, source_account_id string, product_type_code string, product_name string, currency_code string, opened_at string, closed_at string, status string, amount_limit string, interest_rate string"
    raw = rows(
        schema,
        (1, "P1", "A1", "", " DEPOSIT ", "n", "EURO", "2021-01-01", None, None, "1,5", "4.5"),
        (2, "P2", "A1", None, "deposit", "n", None, None, None, "CLOSED", None, None),
        (3, "P3", "A1", None, None, "n", None, "01.01.2021", None, "CLOSED", None, None),
    )
    typed = loaders.products(raw, lookup, NOW)
    got = {r.source_product_id: (r.product_type_id, r.currency_code, r.status, r.amount_limit) for r in
           loaders.into_core("products", typed).collect()}
    assert got == {"P1": (3, "EUR", "ACTIVE", Decimal("1.50")), "P2": (1, None, "CLOSED", None)}
    assert [r.reject_reason for r in loaders.rejects("products", typed).collect()] == ["unreadable opened_at"]


def test_a_hot_or_blank_reference_matches_once(rows):
    raw = rows("load_seq bigint, source_account_id string", *[(i, "ACC" if i % 3 else None) for i in range(30)])
    accounts = rows("source_account_id string, account_id bigint", ("ACC", 1), ("~1", 2))
    got = loaders.with_reference(raw, "source_account_id", accounts, "account_id").collect()
    assert len(got) == 30
    assert {r.load_seq: r.account_id for r in got} == {i: 1 if i % 3 else None for i in range(30)}


def test_dictionaries_have_unique_ids_and_codes(spark):
    for name in DICTIONARIES:
        frame = dictionary(spark, name)
        found = frame.collect()
        assert len(found) == len({r[0] for r in found}) == len({r[1] for r in found}) == len(DICTIONARIES[name][0])


def test_referential_filter_partitions_the_facts(rows):
    facts = rows("id int, client_id bigint", (1, 1), (2, 5), (3, None))
    kept, dropped = loaders.referential_filter(facts, rows("client_id bigint", (1,)))
    assert [r.id for r in kept.collect()] == [1]
    assert sorted((r.id, r.reject_reason) for r in dropped.collect()) == [(2, "unresolved client"), (3, "unresolved client")]


def test_leads_and_credit_risk(rows, lookup):
    lead = "load_seq bigint, " + ", ".join(f"{c} string" for c in (
        "campaign_id", "customer_id", "age", "job", "marital", "education", "default_flag", "housing_loan",
        "personal_loan", "contact_channel", "last_contact_date", "campaign_contacts", "previous_outcome",
        "term_deposit_subscribed"))
    raw = rows(
        lead,
        (1, "C", " A1 ", "30", "j1", "m1", *[None] * 5, "2024-01-02", "3x", None, "no"),
        (2, "C", "A1", "x", "j2", "m2", *[None] * 5, None, "4", None, "yes"),
        (3, None, "A1", *[None] * 12),
        (4, "C", "zz", *[None] * 12),
    )
    typed = loaders.marketing_leads(raw, lookup, NOW)
    got = loaders.into_core("crm_marketing_leads", typed).collect()
    assert [(r.id, r.client_id, r.age, r.job, r.marital, r.last_contact_date, r.campaign_contacts, r.term_deposit_subscribed)
            for r in got] == [(1, 1, None, "j2", "m1", date(2024, 1, 2), None, "yes")]
    risk = "load_seq bigint, " + ", ".join(f"{c} string" for c in (
        "customer_id", "limit_balance", "sex", "education", "marriage", "age", "pay_status_m1", "pay_status_m2",
        "bill_amt_m1", "bill_amt_m2", "pay_amt_m1", "pay_amt_m2", "default_next_month"))
    raw = rows(
        risk,
        (1, " A2", "100", "F", *[None] * 3, "-1", "late", "1", None, None, "2,5", "1"),
        (2, "A2", "250,5", "M", *[None] * 3, "5", None, None, None, None, None, None),
    )
    got = loaders.into_core("credit_risk_features", loaders.credit_risk(raw, lookup, NOW)).collect()
    assert [(r.client_id, r.source_customer_id, r.limit_balance, r.sex, r.pay_status_m1, r.pay_status_m2, r.pay_amt_m2,
             r.default_next_month) for r in got] == [
        (2, "A2", Decimal("250.50"), "F", -1, None, Decimal("2.50"), None)
    ]


def test_catalog_takes_the_last_row_whole(rows):
    schema = "load_seq bigint, product_id int, product_name string, product_group string, description string, interest_rate string, credit_limit string, active_flag string, source_system string"
    raw = rows(
        schema,
        (1, 5, "a", "g", "d", "1", "2", "yes", "s"), (2, 0, "zero", *[None] * 6), (3, 5, None, "h", None, None, "3,5", None, None),
    )
    got = loaders.into_core("ref_product_catalog", loaders.product_catalog(raw, NOW)).collect()
    assert [(r.product_id, r.product_name, r.product_group, r.interest_rate, r.credit_limit, r.active_flag) for r in got] == [
        (5, None, "h", None, Decimal("3.50"), None)
    ]


def test_appeals(rows, lookup):
    schema = "load_seq bigint, source_appeal_id string, source_client_id string, channel_code string, appeal_type_code string, created_ts string, resolved_ts string, status string, priority string, result_text string"
    raw = rows(
        schema,
        (1, "Q1", "A1", "CC", "CLAIM", "2026-03-01T01:00:00+03:00", "2026-03-01T15:00:00Z", "CLOSED", " 2 ", "x"),
        (2, "Q1", "A1", "CC", "CLAIM", "2026-03-01T01:00:00+03:00", None, None, "3", "y"),
        (3, "Q3", "A1", " CC", "claim", "2026-03-01", "soon", None, "high", "x"),
        (4, "Q4", "A1", " CC", "claim", "2026-03-01", None, None, "high", "x"),
    )
    typed = loaders.appeals(raw, lookup, NOW)
    got = {r.source_appeal_id: r for r in loaders.into_core("appeals", typed).collect()}
    assert {k: (r.appeal_id, r.channel_id, r.appeal_type_id, r.resolved_ts, r.status, r.priority, r.source_system_id)
            for k, r in got.items()} == {
        "Q1": (1, 5, 2, None, "OPEN", 2, 1), "Q4": (3, None, None, None, "OPEN", None, 1),
    }
    assert got["Q1"].created_ts == datetime(2026, 2, 28, 22)
    assert [r.reject_reason for r in loaders.rejects("appeals", typed).collect()] == ["unreadable resolved_ts"]


def test_results_do_not_depend_on_input_order(rows, lookup):
    data = [tx(i, f"T{i % 7}", client="A1" if i % 2 else "A2", amount=str(i)) for i in range(1, 40)]
    shuffled = random.Random(3).sample(data, len(data))
    results = [
        sorted(map(str, loaders.into_core("transactions", loaders.transactions(rows(TX, *d), lookup, NOW)).collect()))
        for d in (data, shuffled)
    ]
    assert results[0] == results[1]


def test_seed_updates_only_segment_names(spark):
    from tallyhouse.operators.upsert import apply_to

    fresh = dictionary(spark, "segment_types")
    stored = fresh.withColumn("segment_type_name", F.lit("old")).withColumn("segment_type_code", F.lit("KEPT"))
    got = apply_to(stored, fresh, ["segment_type_id"], ["segment_type_name", "description"]).collect()
    assert {r.segment_type_code for r in got} == {"KEPT"} and "old" not in {r.segment_type_name for r in got}
