"""Files of one datasets folder, one per feed."""

DATASETS = {
    "manifest.json": {"additional_loaders": [
        {"file": "tsv_abs/abs_clients_external.tsv", "format": "tsv", "table": "stg.abs_clients_raw",
         "columns": ["source_client_id", "client_type", "first_name", "tax_id", "status"],
         "column_map": {"client_id": "source_client_id", "customer_type": "client_type", "given": "first_name",
                        "inn": "tax_id"}},
        {"file": "tsv_abs/abs_accounts_external.tsv", "format": "tsv", "table": "stg.abs_accounts_raw",
         "columns": ["source_account_id", "source_client_id", "account_number_masked", "status"],
         "column_map": {"account_id": "source_account_id", "client_id": "source_client_id", "status": "status"}},
    ]},
    "tsv_abs/abs_clients_external.tsv": "client_id\tcustomer_type\tgiven\tinn\n42\tretail\tOmsk\t900\n43\tB\tPerm\t\n",
    "tsv_abs/abs_accounts_external.tsv": "account_id\tclient_id\tstatus\n7340512\t42\tACTIVE\n",
    "tsv_abs/abs_transactions_external.tsv": (
        "transaction_id\tclient_id\taccount_id\tamount\ttransaction_date\tchannel\toperation_type\tcurrency\n"
        "X1\t42\t7340512\t-15,5\t2026-03-10\tMOBILE\tFEE\tEUR\nX2\t42\t7340512\tmany\t2026-03-10\t\t\t\n"
    ),
    "tsv_abs/abs_products_external.tsv": (
        "product_id\tproduct_name\tinterest_rate\tcredit_limit\tactive_flag\n8811\tCard\t0.0\t0.0\tY\n"
        "8824\tLoan\t13.5\t300000.0\tn\nABC\tOther\t\t\t\n"
    ),
    "logs/dbo_events.jsonl": (
        '{"event_id":"L1","customer_id":"42","channel":"API","event_type":"login_success",'
        '"event_time":"2026-03-11T10:00:00Z","success":true,"ip_country":"IN"}\n\n{oops\n'
    ),
    "json_api/open_banking_accounts.json": {"Data": {"Account": [
        {"AccountId": "OBA", "CustomerId": "43", "Status": "Enabled", "StatusUpdateDateTime": "2025-01-01T00:00:00Z"}]}},
    "json_api/open_banking_transactions.json": {"Data": {"Transaction": [
        {"TransactionId": "OB1", "CustomerId": "43", "AccountId": "OBA", "Amount": {"Amount": "3,5"},
         "BookingDateTime": "2026-03-12T00:00:00Z"}]}},
    "json_api/consumer_complaints_sample.json": {"complaints": [
        {"complaint_id": "9", "customer_id": "43", "date_received": "2026-03-13", "submitted_via": "web"}]},
    "xml_iso20022/camt_053_statement_sample.xml": (
        '<Document xmlns="urn:x"><BkToCstmrStmt><Stmt><Acct><Id><Othr><Id>7340512</Id></Othr></Id></Acct><Ntry>'
        '<Amt Ccy="INR">47.00</Amt><CdtDbtInd>DBIT</CdtDbtInd><BookgDt><Dt>2026-03-08</Dt></BookgDt>'
        "<AcctSvcrRef>r1</AcctSvcrRef></Ntry></Stmt></BkToCstmrStmt></Document>"
    ),
    "xml_iso20022/camt_054_credit_notification_sample.xml": (
        '<Document xmlns="urn:x"><BkToCstmrDbtCdtNtfctn><Ntfctn><Acct><Id><Othr><Id>7340512</Id></Othr></Id></Acct><Ntry>'
        '<Amt Ccy="INR">5</Amt><CdtDbtInd>CRDT</CdtDbtInd><BookgDt><Dt>2026-03-09</Dt></BookgDt>'
        "<AcctSvcrRef>n1</AcctSvcrRef></Ntry></Ntfctn></BkToCstmrDbtCdtNtfctn></Document>"
    ),
    "xlsx_crm/crm_campaigns.csv": (
        "a,b,c,d,e,f,g,h,i,j,k,l,m,n\nC1,42,30,clerk,single,basic,no,yes,no,cell,2026-01-02,2,unknown,no\n,42,,,,,,,,,,,,\n"
    ),
    "xlsx_crm/credit_card_risk.csv": "a,b,c,d,e,f,g,h,i,j,k,l,m\n42,1000,1,2,1,30,-1,2,10,20,1,2,1\n",
}
