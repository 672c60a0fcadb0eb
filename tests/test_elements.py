"""JSON documents and statements cut by many tasks; refused records with their reasons."""

from __future__ import annotations

import json
import random
import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import catalog
from tallyhouse.operators.staging import staged, with_load_seq
from tallyhouse.plans import load
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources import camt, documents, rules
from tallyhouse.sources.elements import cut_elements
from tallyhouse.sources.files import from_source
from tallyhouse.sources.text import read_delimited, read_elements, read_lines

NOW = datetime(2026, 4, 1)
SCALARS = [1, -2.5, None, True, "a", "}{", ']"[', "\\", 'x\\"}', "Пётр }", '\n{"Data":[', "{" * 9]


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def value(rng: random.Random, depth: int):
    draw = rng.random()
    if depth > 3 or draw < 0.4:
        return rng.choice(SCALARS)
    if draw < 0.7:
        return {rng.choice(["Data", "Transaction", "k", "é}"]): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def document(rng: random.Random) -> tuple[dict, list]:
    """A document with an array at Data.Transaction, and arrays of that name at other places."""
    wanted = [value(rng, 2) if rng.random() < 0.3 else {"id": j, "v": value(rng, 2)} for j in range(rng.randint(0, 10))]
    data, made = {}, {}
    if rng.random() < 0.5:
        data["Other"] = [value(rng, 2) for _ in range(3)]
    data["Transaction"] = wanted
    if rng.random() < 0.5:
        data["After"] = value(rng, 2)
    if rng.random() < 0.3:
        data["Z"] = {"Transaction": [{"no": 1}]}
    if rng.random() < 0.5:
        made["Links"] = {"Self": "x", "Transaction": [{"q": 1}]}
    made["Data"] = data
    if rng.random() < 0.5:
        made["Meta"] = {"n": [{"Transaction": [{"z": 0}]}]}
    return made, wanted


def loaded(text: str | None, like):
    """An element as JSON text, except a string, which the reader gives as it is."""
    return text if text is None or isinstance(like, str) else json.loads(text)


@pytest.mark.parametrize("seed", [2, 5])
def test_elements_of_random_documents(spark, tmp_path, small_blocks, seed):
    rng, files, want = random.Random(seed), [], []
    for i in range(30):
        made, wanted = document(rng)
        path = tmp_path / f"{i:02}.json"
        text = json.dumps(made, ensure_ascii=i % 2 == 0, indent=rng.choice([None, None, 2])) + rng.choice(["", "\n", " \n"])
        path.write_text(text)
        files.append(str(path))
        want.append(wanted)
    found = read_elements(spark, files, "Data.Transaction")
    assert found.select("seq_part", "seq_block", "seq_row").distinct().count() == found.count()
    got = [[] for _ in files]
    for r in found.orderBy("seq_part", "seq_block", "seq_row").collect():
        assert r["__refused"] is None
        got[r.seq_part].append(r["__json"])
    for have, expected in zip(got, want, strict=True):
        assert [loaded(t, e) for t, e in zip(have, expected, strict=True)] == expected


def test_a_document_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    rows = [{"TransactionId": str(i), "Amount": {"Amount": "1", "Currency": "EUR"}} for i in range(200)]
    path = tmp_path / "doc.json"
    path.write_text(json.dumps({"Data": {"Transaction": rows}}))
    found = cut_elements(spark, [str(path)], "Data.Transaction", F.col("value"))
    assert [json.loads(r["__json"]) for r in found.orderBy("seq_block", "seq_row").collect()] == rows
    assert found.select("seq_block").distinct().count() > 20


def test_unreadable_documents_and_elements_are_refused(spark, tmp_path, small_blocks):
    bodies = {
        '{"Data":{"Transaction":[{"a":1},{"b":2}]}': "document does not close",
        '{"Data":{"Transaction":[{"a":1},{"b":"x}': "document does not close",
        '{"Data":{"Transaction":[{"a":1}]}} {"x":1}': "document does not close",
        "[1,2]": "document does not close",
        '{"Data":{"Transaction":[{"a":1},{"b" 2},{"c":3}]}}': "no JSON",
    }
    for i, (body, reason) in enumerate(bodies.items()):
        path = tmp_path / f"{i}.json"
        path.write_text(body)
        rows = read_elements(spark, [str(path)], "Data.Transaction").orderBy("seq_block", "seq_row").collect()
        assert [r["__refused"] for r in rows if r["__refused"]] == [reason], body
        assert [r["__json"] for r in rows if not r["__refused"]] == (['{"a":1}', '{"c":3}'] if reason == "no JSON" else [])


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp1251", "utf-16"])
def test_elements_in_every_encoding(spark, tmp_path, encoding):
    path = tmp_path / "doc.json"
    path.write_bytes(json.dumps({"complaints": [{"complaint_id": "Ж1"}, {"complaint_id": "2"}]}, ensure_ascii=False).encode(encoding))
    found = documents.complaints(read_elements(spark, [str(path)], "complaints"))
    assert sorted(r.source_appeal_id for r in found.collect()) == ["2", "Ж1"]


STATEMENT = "<Stmt><Acct><Id><Othr><Id>{}</Id></Othr></Id></Acct>{}</Stmt>"


def entry(number: object, name: str, more: str = "") -> str:
    return f"<Ntry><Amt Ccy='EUR'>{number}</Amt><AcctSvcrRef>r{number}</AcctSvcrRef><X><Deep><Nm>{name}</Nm></Deep></X>{more}</Ntry>"


def test_a_long_statement_is_spread(spark, tmp_path, small_blocks):
    body = "".join(STATEMENT.format(600 + s, "\n".join(entry(1000 * s + i, f"Customer {i + 1}") for i in range(n))) for s, n in enumerate((150, 0, 7)))
    path = tmp_path / "camt.xml"
    path.write_text(f"<?xml version='1.0'?><D xmlns='u'>{body}<Stmt>{entry(1, 'Customer 1')}</Stmt></D>")
    read = camt.read_statements(spark, [str(path)], "053")
    found = with_load_seq(from_source(camt.entries(read, None, "053"), 0)).orderBy("load_seq").collect()
    assert [(r.source_transaction_id, r.source_account_id, r.source_client_id) for r in found] == [
        (f"ISO053-r{1000 * s + i}", str(600 + s), str(i + 1)) for s, n in enumerate((150, 0, 7)) for i in range(n)
    ]
    assert read.select("seq_block").distinct().count() > 50


def test_entries_as_written_in_the_wild(spark, tmp_path):
    told = "<RmtInf><Ustrd><![CDATA[<Nm>Customer 9</Nm> & co]]></Ustrd></RmtInf><!-- <Nm>Customer 8</Nm> -->"
    bodies = [
        entry(1, "Customer 1", told),
        entry(2, "Customer 2").replace("<Ntry>", '<Ntry Id="7">'),
        entry(3, "a &amp; Customer 3").replace("Ntry>", "ns:Ntry>").replace("<Nm>", "<ns:Nm >").replace("</Nm>", "</ns:Nm>"),
        entry(4, "x", "<NtryDtls><TxDtls><Refs><AcctSvcrRef>inner</AcctSvcrRef></Refs><AmtDtls><Amt>99</Amt></AmtDtls></TxDtls></NtryDtls>"),
    ]
    path = tmp_path / "camt.xml"
    path.write_text("<D>" + STATEMENT.format(600, "".join(bodies)) + "<Ntfctn><Acct><Id>1</Id></Acct>" + entry(5, "Customer 5") + "</Ntfctn></D>")
    rows = camt.read_entries(camt.read_statements(spark, [str(path)], "053"), None, "053").collect()
    assert sorted((r.source_transaction_id, r.source_client_id, r.amount, r.description, r.reject_reason) for r in rows) == [
        ("ISO053-r1", "1", "1.0", "<Nm>Customer 9</Nm> & co", None), ("ISO053-r2", "2", "2.0", "camt 053", None),
        ("ISO053-r3", "3", "3.0", "camt 053", None), ("ISO053-r4", None, "4.0", "camt 053", "no customer"),
    ]


def test_nothing_read_is_lost(spark, rows, tmp_path):
    """Of every format accepted and refused records together are what was read."""
    def sides(tagged, plain):
        all_rows = tagged.collect()
        refused = sorted((r.reject_reason, r.raw_text is not None) for r in all_rows if r.reject_reason)
        assert plain.count() == len(all_rows) - len(refused) and all(has for _, has in refused)
        return len(all_rows), [reason for reason, _ in refused]

    (tmp_path / "log").write_text('{"event_id":"1"}\n\n{bad\n[1]\n  \n{"event_id":"2"}\nword\n')
    lines = read_lines(spark, [str(tmp_path / "log")])
    assert sides(documents.read_event_lines(lines), documents.event_lines(lines)) == (5, ["no JSON", "no JSON object", "no JSON object"])

    head = "\t".join(rules.TSV_TRANSACTION_COLUMNS)
    body = ["t1\tc\ta\t-5\t", "\tc\ta\t1\t", "t3\tc\ta\tNaN\t", "t4\tc\ta\t1,5\t", "t5\tc\ta\tx\t"]
    (tmp_path / "tx").write_text("\n".join([head, *body]) + "\n")
    table = read_delimited(spark, [str(tmp_path / "tx")], rules.TSV_TRANSACTION_COLUMNS, "\t")
    total, reasons = sides(rules.read_tsv_transactions(table), rules.tsv_transactions(table))
    assert total == 5 and reasons.count("transaction_id is missing") == 1 and set(reasons) <= {"transaction_id is missing", "amount is no number"}

    catalog = rows("product_id string, product_name string, product_group string, description string, interest_rate string, credit_limit string, active_flag string, source_system string", ("7", *"abcdefg"), (" ", *"abcdefg"), (None, *"abcdefg"))
    assert sides(rules.read_tsv_catalog(catalog), rules.tsv_catalog(catalog)) == (3, ["product_id is missing"] * 2)

    (tmp_path / "c.json").write_text(json.dumps({"complaints": [{"complaint_id": "1"}, {"complaint_id": " "}, {}]}))
    elements = read_elements(spark, [str(tmp_path / "c.json")], "complaints")
    assert sides(documents.read_complaints(elements), documents.complaints(elements)) == (3, ["complaint_id is missing"] * 2)

    (tmp_path / "x.xml").write_text("<D>" + STATEMENT.format(6, entry(1, "Customer 1") + entry("", "Customer 2") + entry("n", "Customer 3") + entry(4, "y")) + "<Stmt>" + entry(5, "Customer 5") + "</Stmt></D>")
    found = camt.read_statements(spark, [str(tmp_path / "x.xml")], "053")
    assert sides(camt.read_entries(found, None, "053"), camt.entries(found, None, "053")) == (
        5, ["amount is no number", "no account number", "no customer"]
    )


def test_staging_keeps_refused_records(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "dbo_events.jsonl").write_text('{"event_id":"1","customer_id":"c","channel":"MB","event_type":"x"}\n{bad\n')
    (tmp_path / "json_api").mkdir()
    (tmp_path / "json_api" / "open_banking_accounts.json").write_text('{"Data":{"Account":[{"AccountId":"A","CustomerId":"c"},{"AccountId" 5}]}}')
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    batch = load.load_sources(warehouse, [str(tmp_path)], now=NOW)
    events, accounts = (warehouse.staging(t, batch, refused=True).collect() for t in ("dbo_events_raw", "abs_accounts_raw"))
    assert [(r.reject_reason, r.raw_text, r.source_file.split("/")[-1]) for r in events] == [("no JSON", "{bad", "dbo_events.jsonl")]
    assert [(r.reject_reason, r.source_file.split("/")[-1]) for r in accounts] == [("no JSON", "open_banking_accounts.json")]
    assert '"AccountId" 5' in accounts[0].raw_text
    assert [r.source_event_id for r in warehouse.staging("dbo_events_raw", batch).collect()] == ["1"]
    assert "raw_text" not in warehouse.staging("dbo_events_raw", batch).columns
    assert staged(warehouse.staging("dbo_events_raw", batch), "dbo_events_raw", 2, NOW).columns.count("reject_reason") == 1


def test_a_header_is_split_once(spark):
    header = spark.createDataFrame([("x",)], "header string").select(camt._opening(F.col("header"), "Stmt").alias("o"))
    assert header._jdf.queryExecution().analyzed().toString().count("split(") == 1


def test_texts_of_accepted_entries_are_not_moved(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text("<D>" + STATEMENT.format(6, entry(name + "1", "Customer 1")) + "</D>")
    read = camt.read_statements(spark, [str(tmp_path / name) for name in "ba"], "053")
    kept = camt.read_entries(read, None, "053").where("raw_text IS NOT NULL")
    assert {(r.seq_part, r.raw_text.count("AcctSvcrRef"), r.reject_reason) for r in kept.collect()} == {(i, 2, "amount is no number") for i in (0, 1)}
    plan = camt.entries(read, None, "053")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line, above in zip(plan.split("\n")[1:], plan.split("\n")) if "Exchange hashpartitioning(seq_part" in above]
    assert moved and not any(re.search(r"[\[ ]__entry#\d+[,\]]", line) for line in moved)
    assert "hashpartitioning(__path" not in plan


def test_the_query_writes_packed_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "STATEMENTS_A_FILE", 2)
    orders = [(i, i // 2, "FOP"[i % 3], 10.5 + i, datetime(2024, 1, 1 + i % 9), "1") for i in range(1, 30)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, schema).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    folders = []

    def made(session, label):
        folders.append(f"{tmp_path}/{label}")
        return folders[-1]

    monkeypatch.setattr(catalog, "scratch_path", made)
    found = catalog.queries()["src_camt"](spark, str(tmp_path)).collect()
    wanted = [o for o in orders if o[0] % 5]
    assert sorted((r.source_transaction_id, r.source_account_id, r.direction) for r in found) == sorted(
        (f"ISO{kind}-R{o[0]}", str(o[1]), "C" if o[2] == "F" else "D") for o in wanted for kind in camt.MESSAGES
    )
    written = [p for kind in camt.MESSAGES for p in Path(folders[0], kind).glob("part-*")]
    assert len(written) >= 14 and all(p.name.endswith(".gz") for p in written)
