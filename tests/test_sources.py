from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.identity import account_client_map
from tallyhouse.operators.staging import staged, with_load_seq
from tallyhouse.plans.load import read_csv_set
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources import camt, documents, manifest, rules
from tallyhouse.sources.files import from_source
from tallyhouse.sources.text import Hints, read_delimited, read_documents, read_lines, sniff

TABLE = 'код,name,note\r\n1,Пётр,"a,b"\r\n2,"Анна ""А""",\r\n\r\n3,Олег\r\n'
EXPECTED = [("1", "Пётр", "a,b", None), ("2", 'Анна "А"', None, None), ("3", "Олег", None, None)]
ENCODED = {
    "utf-8": lambda t: t.encode("utf-8"),
    "utf-8 with mark": lambda t: b"\xef\xbb\xbf" + t.encode("utf-8"),
    "utf-16 little": lambda t: b"\xff\xfe" + t.encode("utf-16-le"),
    "utf-16 big": lambda t: b"\xfe\xff" + t.encode("utf-16-be"),
    "windows-1251": lambda t: t.encode("cp1251"),
}


def in_order(frame, *columns):
    numbered = with_load_seq(from_source(frame, 0)).orderBy("load_seq")
    return [tuple(r) for r in numbered.select(*columns).collect()]


@pytest.mark.parametrize("encoding", ENCODED)
def test_delimited_in_every_encoding(spark, tmp_path, encoding):
    path = tmp_path / "feed.csv"
    path.write_bytes(ENCODED[encoding](TABLE))
    found = read_delimited(spark, [str(path)], ["код", "name", "note", "absent"])
    assert in_order(found, "код", "name", "note", "absent") == EXPECTED


def test_files_with_different_headers_keep_their_order(spark, tmp_path):
    feeds = {"b.csv": "x,y\n1,a\n2,b\n", "a.csv": "y,z,x\nc,0,3\n", "c.csv": "y\nd\n", "empty.csv": ""}
    for name, body in feeds.items():
        (tmp_path / name).write_text(body)
    found = read_delimited(spark, [str(tmp_path / n) for n in feeds], ["x", "y"])
    assert in_order(found, "x", "y") == [("1", "a"), ("2", "b"), ("3", "c"), (None, "d")]


def test_a_quoted_newline_is_found_and_read(spark, tmp_path):
    path = tmp_path / "feed.tsv"
    path.write_text('x\ty\n1\t"two\nlines"\n2\t"say ""hi"""\n')
    assert sniff(spark, [str(path)], delimiter="\t")[0].quoted_newlines
    found = read_delimited(spark, [str(path)], ["x", "y"], "\t")
    assert in_order(found, "x", "y") == [("1", "two\nlines"), ("2", 'say "hi"')]


def test_splits_of_one_file_stay_in_order(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("n,pad\n" + "".join(f"{i},{'x' * 50}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = read_delimited(spark, [str(path)], ["n"])
        assert found.rdd.getNumPartitions() > 4
        assert in_order(found, "n") == [(str(i),) for i in range(4000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_hints_spare_the_look_at_the_content(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_bytes("x,y\nПётр,1\n".encode("cp1251"))
    (tmp_path / "other.csv").write_bytes("y,x\n2,Анна\n".encode("cp1251"))
    paths = [str(path), str(tmp_path / "other.csv")]
    found = read_delimited(spark, paths, ["x", "y"], hints=Hints("windows-1251", False))
    assert in_order(found, "x", "y") == [("Пётр", "1"), ("Анна", "2")]


def test_no_file_content_gives_nothing(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert read_delimited(spark, [str(tmp_path / "empty.csv")], ["x"]) is None


def test_csv_set_appends_roots_in_order(spark, tmp_path):
    for i, root in enumerate(("one", "two")):
        (tmp_path / root).mkdir()
        (tmp_path / root / "crm_clients.csv").write_text(f"source_client_id,tax_id\nC{i},\n")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    found = read_csv_set(warehouse, [str(tmp_path / "two"), str(tmp_path / "one")])
    assert list(found) == ["crm_clients_raw"]
    assert in_order(found["crm_clients_raw"], "source_client_id", "phone") == [("C1", None), ("C0", None)]


def test_manifest_entries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path.parent / "outside.csv").write_text("a\n1\n")
    (tmp_path / "in" / "people.csv").write_text("ID;Kind;City\n 7 ;B2B;Omsk\n8;;\n")
    (tmp_path / "in" / "acc.tsv").write_text("source_account_id\tstatus\n12345\tOPEN\n12\t\n")
    (tmp_path / "in" / "header_only.csv").write_text("a\n")
    clients = ["source_client_id", "client_type", "first_name", "status", "tax_id"]
    entries = [
        {"file": "in/people.csv", "format": "csv", "delimiter": ";", "table": "stg.abs_clients_raw",
         "columns": clients,
         "column_map": {"ID": "source_client_id", "Kind": "client_type", "City": "first_name",
                        "Nope": "tax_id", "ID2": "not_a_column"}},
        {"file": "in/acc.tsv", "format": "TSV", "table": "stg.abs_accounts_raw",
         "columns": ["source_account_id", "account_number_masked", "status"]},
        {"file": "../outside.csv", "table": "stg.abs_clients_raw", "columns": ["a"]},
        {"file": "in/missing.csv", "table": "stg.abs_clients_raw", "columns": ["a"]},
        {"file": "in/people.csv", "format": "xlsx", "table": "stg.abs_clients_raw", "columns": ["a"]},
        {"file": "in/people.csv", "columns": ["a"]},
    ]
    (tmp_path / "manifest.json").write_text(json.dumps({"additional_loaders": entries}))
    specs = manifest.read_manifest(spark, str(tmp_path))
    found = [manifest.load_entry(spark, str(tmp_path), s) for s in specs]
    assert [f is not None for f in found] == [True, True, False, False, False, False]
    assert in_order(found[0], *clients) == [
        ("7", "BUSINESS", "Omsk", "ACTIVE", None), ("8", None, None, "ACTIVE", None)
    ]
    assert in_order(found[1], "source_account_id", "account_number_masked", "status") == [
        ("12345", "****2345", "OPEN"), ("12", "****12", None)
    ]
    assert manifest.read_manifest(spark, str(tmp_path / "in")) == []


def test_manifest_paths_with_a_scheme():
    assert manifest.entry_path("hdfs://nn/data", "a/../b.csv") == "hdfs://nn/data/b.csv"
    assert manifest.entry_path("hdfs://nn/data", "../b.csv") is None
    assert manifest.entry_path("/data", "/etc/passwd") is None


def test_tsv_transactions(rows):
    columns = ", ".join(f"{c} string" for c in rules.TSV_TRANSACTION_COLUMNS)
    raw = rows(
        columns,
        (" 1 ", "c", "", "-10,50", "2024-01-02 09:00", "mobile", "", "", "shop", " "),
        ("2", None, "a", "0", "", "api", "FEE", " EUR ", None, "who"),
        ("3", "c", "a", "NaN", "", "", "", "", "", ""),
        (" ", "c", "a", "1", "", "", "", "", "", ""),
    )
    got = rules.tsv_transactions(raw).orderBy("source_transaction_id").collect()
    assert [(r.source_transaction_id, r.source_client_id, r.source_account_id, r.amount, r.direction,
             r.channel_code, r.operation_type_code, r.operation_ts, r.currency_code, r.merchant_name,
             r.description) for r in got] == [
        ("1", "c", None, "10.5", "D", "MB", "PAYMENT", "2024-01-02T12:00:00+00:00", "INR", "shop", None),
        ("2", "", "a", "0.0", "C", "API", "FEE", None, "EUR", None, "who"),
    ]


def test_event_lines(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    lines = [
        '{"event_id":"1","customer_id":"c","channel":" MB ","event_type":"LOGIN","event_time":"t","success":true,'
        '"ip_country":"IN","account_id":5,"x":1}',
        "", "  ", "{bad", "[1]",
        '{"event_id":"2","success":null,"device_type":" ","ip_country":null}',
        '{"event_id":"3","success":0}', '{"event_id":"4","success":"false"}', '{"event_id":"5","success":""}',
        '{"event_id":"6","success":false}',
    ]
    path.write_text("\n".join(lines))
    found = documents.event_lines(read_lines(spark, [str(path)]))
    assert in_order(found, "source_event_id", "channel_code", "success_flag", "payload_json") == [
        ("1", "MB", "true", '{"ip_country":"IN","account_id":5}'),
        ("2", "", None, '{"ip_country":null}'),
        ("3", "", "false", None),
        ("4", "", "true", None),
        ("5", "", "false", None),
        ("6", "", "false", None),
    ]


@pytest.mark.parametrize("encoding", ENCODED)
def test_lines_and_documents_in_every_encoding(spark, tmp_path, encoding):
    path = tmp_path / "log.jsonl"
    path.write_bytes(ENCODED[encoding]('{"event_id":"Ж"}\n{"event_id":"2"}\n'))
    assert in_order(documents.event_lines(read_lines(spark, [str(path)])), "source_event_id") == [("Ж",), ("2",)]
    content = read_documents(spark, [str(path)]).first()["content"]
    assert content == '{"event_id":"Ж"}\n{"event_id":"2"}\n'


def document(spark, tmp_path, body):
    path = tmp_path / "doc.json"
    path.write_text(body if isinstance(body, str) else json.dumps(body))
    return read_documents(spark, [str(path)])


def test_open_banking_accounts(spark, tmp_path):
    doc = {"Data": {"Account": [
        {"AccountId": "A1", "CustomerId": 7, "Status": "Enabled", "StatusUpdateDateTime": "2024-01-02T03:04:05Z",
         "AccountType": "Personal", "AccountSubType": "Savings", "Nickname": "", "Currency": None},
        {"AccountId": "A2", "Status": "Disabled", "AccountSubType": "Loan", "Nickname": "n" * 80, "Currency": "EUR"},
        {},
    ]}}
    found = documents.open_banking_accounts(document(spark, tmp_path, doc))
    assert in_order(found, "source_account_id", "source_client_id", "account_number_masked", "account_type",
                    "currency_code", "opened_at", "status") == [
        ("A1", "7", "****A1", "Personal / Savings", "INR", "2024-01-02", "ACTIVE"),
        ("A2", None, "n" * 64, "Loan", "EUR", None, "DISABLED"),
        (None, None, "****", "ACCOUNT", "INR", None, "ACTIVE"),
    ]


def test_open_banking_transactions_with_mixed_types(spark, tmp_path):
    doc = {"Data": {"Transaction": [
        {"TransactionId": "1", "Amount": {"Amount": "1,5", "Currency": "EUR"}, "CreditDebitIndicator": "Credit",
         "BankTransactionCode": {"Code": "PMNT"}, "MerchantDetails": {"MerchantName": " m "}, "Status": ""},
        {"TransactionId": "2", "Amount": "9", "BankTransactionCode": "PMNT", "MerchantDetails": "m",
         "TransactionInformation": " "},
    ]}}
    found = documents.open_banking_transactions(document(spark, tmp_path, doc))
    assert in_order(found, "source_transaction_id", "amount", "currency_code", "direction",
                    "operation_type_code", "merchant_name", "description", "status", "channel_code") == [
        ("1", "1.5", "EUR", "C", "PMNT", "m", None, "POSTED", "ONLINE"),
        ("2", "0", "INR", "D", "PAYMENT", None, None, "POSTED", "ONLINE"),
    ]


def test_complaints(spark, tmp_path):
    doc = {"complaints": [
        {"complaint_id": " 1 ", "customer_id": "c ", "date_received": "2024-01-02T10:00", "product": "Card",
         "issue": "", "narrative": "x" * 600, "submitted_via": "Phone", "company_response": "Closed, in progress"},
        {"complaint_id": " ", "product": "dropped"},
        {"complaint_id": "3", "submitted_via": "fax", "company_response": "Non-monetary relief"},
    ]}
    found = documents.complaints(document(spark, tmp_path, doc))
    assert in_order(found, "source_appeal_id", "source_client_id", "channel_code", "created_ts", "status",
                    "result_text", "priority") == [
        ("1", "c", "TELEPHONE", "2024-01-02T00:00:00Z", "OPEN", "Card " + "x" * 500, "2"),
        ("3", "", "WEB", None, "CLOSED", None, "2"),
    ]


@pytest.mark.parametrize("body", ["{broken", "[]", "{}", '{"Data": 1}'])
def test_broken_documents_give_no_rows(spark, tmp_path, body):
    for rule in (documents.open_banking_accounts, documents.open_banking_transactions, documents.complaints):
        assert rule(document(spark, tmp_path, body)).count() == 0


CAMT = """<?xml version="1.0" encoding="UTF-8"?>
<Document xmlns="urn:iso:std:iso:20022:tech:xsd:camt.053.001.02"><BkToCstmrStmt>
<Stmt><Id>S1</Id><Acct><Id><Othr><Id>ABC</Id></Othr><Othr><Id> 600 </Id></Othr></Id><Nm>Customer 9</Nm></Acct>
 <Bal><Amt Ccy="INR">1</Amt></Bal>
 <Ntry><Amt Ccy="EUROPOUNDS">47,50</Amt><CdtDbtInd>DBIT</CdtDbtInd><BookgDt><Dt>2024-12-08</Dt></BookgDt>
  <AcctSvcrRef>r1</AcctSvcrRef><NtryDtls><TxDtls><RltdPties><Dbtr><Nm>Customer 11 &amp; co</Nm></Dbtr>
  <Cdtr><Nm>Customer 22, Customer 33</Nm></Cdtr><UltmtCdtr><Nm>Shop</Nm></UltmtCdtr></RltdPties>
  <RmtInf><Ustrd> fee &lt;x&gt; </Ustrd><Ustrd>second</Ustrd></RmtInf></TxDtls></NtryDtls></Ntry>
 <Ntry><Amt>-3</Amt><CdtDbtInd>CRDT</CdtDbtInd><AcctSvcrRef>r2</AcctSvcrRef></Ntry>
 <Ntry><Amt>1</Amt><CdtDbtInd>CRDT</CdtDbtInd></Ntry>
 <Ntry><Amt>abc</Amt><AcctSvcrRef>r4</AcctSvcrRef></Ntry>
 <Ntry><AcctSvcrRef>r5</AcctSvcrRef><NtryDtls><TxDtls><RltdPties><Dbtr><Nm>Customer 0</Nm></Dbtr></RltdPties></TxDtls></NtryDtls></Ntry>
 <Ntry><AcctSvcrRef>r6</AcctSvcrRef></Ntry>
</Stmt>
<Stmt><Id>S2</Id><Acct><Id><IBAN>X1</IBAN></Id></Acct><Ntry><Amt>1</Amt><AcctSvcrRef>z</AcctSvcrRef></Ntry></Stmt>
<c:Stmt xmlns:c="urn:x"><c:Acct><c:Id><c:Id>77</c:Id></c:Id></c:Acct>
 <c:Ntry><c:Amt Ccy="USD">5</c:Amt><c:AcctSvcrRef>n1</c:AcctSvcrRef></c:Ntry></c:Stmt>
</BkToCstmrStmt></Document>"""


def test_camt(spark, rows, tmp_path):
    path = tmp_path / "camt.xml"
    path.write_text(CAMT)
    owners = account_client_map(rows(
        "account_id string, client_id string, load_seq int",
        ("600", "old", 1), (" 600", "c600 ", 2), ("600", " ", 3), ("77", "0", 4),
    ))
    found = camt.entries(camt.read_statements(spark, [str(path)], "053"), owners, "053")
    assert in_order(found, "source_transaction_id", "source_client_id", "source_account_id", "amount",
                    "currency_code", "direction", "operation_ts", "description") == [
        ("ISO053-r1", "22", "600", "47.5", "EUROPOUN", "D", "2024-12-08T12:00:00+00:00", "fee <x>"),
        ("ISO053-r2", "c600", "600", "3.0", "INR", "C", None, "camt 053"),
        ("ISO053-r6", "c600", "600", "0.0", "INR", "D", None, "camt 053"),
    ]


def test_camt_notifications_without_owner_are_dropped(spark, tmp_path):
    path = tmp_path / "camt.xml"
    path.write_text(CAMT.replace("<Stmt>", "<Ntfctn>").replace("</Stmt>", "</Ntfctn>"))
    found = camt.entries(camt.read_statements(spark, [str(path)], "054"), None, "054")
    assert [(r.source_transaction_id, r.operation_type_code, r.merchant_name) for r in found.collect()] == [
        ("ISO054-r1", "CAMT_NTF", "camt054")
    ]


def test_sheets(rows):
    sheet = rows(
        "customer_id string, limit_balance double, sex int, education string, marriage string, age int, "
        "pay_status_m1 int, pay_status_m2 int, bill_amt_m1 double, bill_amt_m2 double, pay_amt_m1 double, "
        "pay_amt_m2 double, default_next_month int",
        ("c1", 100.0, 2, "e" * 40, None, 30, 0, -1, 0.0, 2.5, None, 1.0, 1),
        (None, 1.0, 1, "", "", 1, 1, 1, 1.0, 1.0, 1.0, 1.0, 0),
    )
    got = rules.credit_risk(sheet).collect()
    assert len(got) == 1
    assert got[0].asDict() == {
        "customer_id": "c1", "limit_balance": "100.0", "sex": "2", "education": "e" * 32, "marriage": None,
        "age": "30", "pay_status_m1": None, "pay_status_m2": "-1", "bill_amt_m1": None, "bill_amt_m2": "2.5",
        "pay_amt_m1": None, "pay_amt_m2": "1.0", "default_next_month": "1",
    }


def test_staging_refuses_long_and_missing_values(rows):
    from datetime import datetime

    raw = rows("source_client_id string, tax_id string, phone string", ("a", "1", ""), ("", "2", "x"), ("b", "9" * 21, "x"))
    raw = raw.withColumn("seq_part", F.lit(0)).withColumn("seq_block", F.lit(0)).withColumn("seq_row", F.lit(0))
    got = staged(raw, "crm_clients_raw", 1, datetime(2024, 1, 1)).collect()
    assert [(r.source_client_id, r.phone, r.reject_reason) for r in got] == [
        ("a", None, None), (None, "x", "source_client_id is missing"), ("b", "x", "tax_id is longer than 20")
    ]


def test_a_quote_inside_a_field_does_not_stop_splitting(spark, tmp_path):
    path = tmp_path / "feed.tsv"
    path.write_text('x\ty\n1\t10" screen\n2\t"a ""b"""\n')
    assert not sniff(spark, [str(path)], delimiter="\t")[0].quoted_newlines


def test_of_a_repeated_key_the_last_value_counts(spark, tmp_path):
    (tmp_path / "events.jsonl").write_text('{"event_id": "1", "event_id": "2", "channel": "WEB"}\n')
    event = documents.event_lines(read_lines(spark, [str(tmp_path / "events.jsonl")])).first()
    assert event.source_event_id == "2" and event.channel_code == "WEB"
    body = '{"Data": {"Account": [{"AccountId": "1", "AccountId": "2"}, {"AccountId": "3"}]}}'
    (tmp_path / "accounts.json").write_text(body)
    found = documents.open_banking_accounts(read_documents(spark, [str(tmp_path / "accounts.json")])).collect()
    assert [r.source_account_id for r in found] == ["2", "3"]


def test_a_document_above_the_variant_limit_is_read_whole(spark, tmp_path):
    path, rows = tmp_path / "big.json", 70_000
    with path.open("w") as out:
        out.write('{"Data": {"Transaction": [')
        for i in range(rows):
            out.write("," * (i > 0) + f'{{"TransactionId": "{i}", "TransactionInformation": "{"x" * 1950}"}}')
        out.write("]}}")
    assert path.stat().st_size > 128 << 20
    found = documents.open_banking_transactions(read_documents(spark, [str(path)]))
    assert found.selectExpr("count(distinct source_transaction_id)").first()[0] == rows


def test_manifest_rows_may_lack_columns(rows):
    for table in ("abs_clients_raw", "abs_transactions_raw", "abs_accounts_raw"):
        found = rules.normalise_manifest_rows(rows("status string, city string", (None, "x")), table)
        assert found.columns == ["status", "city"]


def test_a_bad_product_id_is_refused_and_does_not_fail(rows):
    found = staged(rows("product_id string, product_name string", ("ABC", "x"), ("7", "y")), "product_catalog_raw", 1, datetime(2024, 1, 1))
    assert {r.product_id: bool(r.reject_reason) for r in found.collect()} == {None: True, 7: False}


def test_free_text_never_names_the_customer(spark, tmp_path):
    entry = "<Ntry><Amt>1</Amt><AcctSvcrRef>{}</AcctSvcrRef>{}</Ntry>"
    told = "<RmtInf><Ustrd>see &lt;Nm&gt;Customer 99&lt;/Nm&gt;</Ustrd></RmtInf>"
    party = "<RltdPties><Cdtr>{}</Cdtr></RltdPties>"
    inner = "<NtryDtls><TxDtls>" + party.format("<Nm>Customer 7</Nm>") + told + "</TxDtls></NtryDtls>"
    later = "<NtryDtls>" + party.format("<Pty><Nm>Customer 9</Nm></Pty>") + "</NtryDtls>"
    body = entry.format("a", inner) + entry.format("b", "<Nm>Customer 8</Nm><Ustrd>direct</Ustrd>") + entry.format("c", later)
    path = tmp_path / "camt.xml"
    path.write_text(f"<D><Stmt><Acct><Id><Othr><Id>600</Id></Othr></Id></Acct>{body}</Stmt></D>")
    found = camt.entries(camt.read_statements(spark, [str(path)], "053"), None, "053")
    assert in_order(found, "source_transaction_id", "source_client_id", "description") == [
        ("ISO053-a", "7", "see <Nm>Customer 99</Nm>"), ("ISO053-b", "8", "direct"), ("ISO053-c", "9", "camt 053"),
    ]


def test_camt_names_and_account_numbers_deep_inside(spark, tmp_path):
    def transaction(name: str, *path: str) -> str:
        inner = "".join(f"<{p}>" for p in path) + f"<Nm>{name}</Nm>" + "".join(f"</{p}>" for p in reversed(path))
        return f"<NtryDtls><TxDtls>{inner}</TxDtls></NtryDtls>"

    bodies = [
        transaction("Customer 1", "RltdAgts", "CdtrAgt", "FinInstnId"), transaction("Customer 2", "RltdPties", "DbtrAcct"),
        transaction("Customer 3", "RltdPties", "Dbtr", "Pty", "CtctDtls"), transaction("Customer 4", "RmtInf", "Strd", "Invcee"),
        "<NtryDtls><TxDtls><RltdPties><Dbtr><Nm>Customer 5</Nm></Dbtr><DbtrAcct><Nm>Customer 6</Nm></DbtrAcct></RltdPties>"
        "<RmtInf><Ustrd>00.50</Ustrd></RmtInf></TxDtls></NtryDtls>",
    ]
    bodies.append("<Ustrd>" + '"\\Nm":["Customer 9"],' * 20_000 + "</Ustrd><Nm/><Nm>Customer 7</Nm>")
    entries = "".join(f"<Ntry><Amt>1</Amt><AcctSvcrRef>00{i}</AcctSvcrRef>{body}</Ntry>" for i, body in enumerate(bodies))
    account = "<Acct><Id><IBAN>X1</IBAN></Id><Ownr><Id><OrgId><Othr><Id> 0600 </Id></Othr></OrgId></Id></Ownr></Acct>"
    path = tmp_path / "camt.xml"
    path.write_text(f"<D><Stmt>{account}{entries}</Stmt></D>")
    found = camt.entries(camt.read_statements(spark, [str(path)], "053"), None, "053")
    assert in_order(found, "source_transaction_id", "source_client_id", "source_account_id", "description") == [
        ("ISO053-000", "1", "0600", "camt 053"), ("ISO053-001", "2", "0600", "camt 053"), ("ISO053-002", "3", "0600", "camt 053"),
        ("ISO053-003", "4", "0600", "camt 053"), ("ISO053-004", "6", "0600", "00.50"),
        ("ISO053-005", "7", "0600", ('"\\Nm":["Customer 9"],' * 20_000)[:2000]),
    ]


def test_camt_account_with_its_own_text_and_others(spark, tmp_path):
    entry = "<Ntry><Amt>1</Amt><AcctSvcrRef>a</AcctSvcrRef><Nm>Customer 1</Nm></Ntry>"
    accounts = ["<Id>x<Id>77</Id></Id>", "<Id>88</Id>", "<Id><IBAN>X</IBAN></Id><Svcr><FinInstnId><Othr><Id>a</Id></Othr><Othr/><Othr><Id>99</Id></Othr></FinInstnId></Svcr>"]
    path = tmp_path / "camt.xml"
    path.write_text("<D>" + "".join(f"<Stmt><Acct>{a}</Acct>{entry}</Stmt>" for a in accounts) + "</D>")
    found = camt.entries(camt.read_statements(spark, [str(path)], "053"), None, "053")
    assert in_order(found, "source_account_id") == [("77",), ("88",), ("99",)]
