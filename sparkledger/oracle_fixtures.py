"""The derived frames as SQL, for checking the jobs against another engine."""

from __future__ import annotations

import re

OFFSET = 1 << 60


def _id(first: str, second: str) -> str:
    high = f"((({first}) % 1073741789) * 1000003 + (({second}) % 1073741789) * 982451653) % 1073741789"
    low = f"((({first}) % 1073741783) * 15485863 + (({second}) % 1073741783) * 961748941) % 1073741783"
    return f"({high}) * 1073741824 + ({low})"


FIXTURES: dict[str, str] = {
    "fx_flow_base": f"""
        SELECT {_id('l_orderkey * 8 + l_linenumber', "l_partkey * 16384 + (CAST(l_shipdate AS DATE) - DATE '1970-01-01')")} AS flow_id,
               CAST(l_quantity AS INT) AS quantity, CAST(floor(l_discount * 100 + 0.5) AS INT) AS discount_pct,
               l_orderkey AS contract_id, l_partkey AS asset_hdr_id, l_suppkey AS party_account_id, l_linenumber AS link_no,
               CAST(l_shipdate AS DATE) AS calc_dt, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_tax AS DECIMAL(4,2)) AS rate,
               CASE l_returnflag WHEN 'R' THEN 4201 ELSE 4200 END AS reversal_status,
               CASE l_linestatus WHEN 'F' THEN 2101 ELSE 2100 END AS status,
               CASE l_linenumber WHEN 1 THEN 1010 WHEN 2 THEN 1014 WHEN 3 THEN 1034 ELSE 1001 END AS flow_type,
               CASE WHEN l_suppkey % 4 = 0 THEN 0 ELSE l_orderkey END AS invoice_id
        FROM lineitem""",
    "fx_flow_amounts": """
        SELECT *, CAST(amount + round(amount * rate, 2) AS DECIMAL(18,2)) AS amt_gross,
               CAST(amount * 0.8 AS DECIMAL(18,2)) AS amt_principal
        FROM fx_flow_base""",
    "fx_flow": """
        SELECT *, CAST(amount - amt_principal AS DECIMAL(18,2)) AS amt_interest, 1 AS image_no, calc_dt AS actual_dt,
               calc_dt + 30 AS expected_dt, CAST(party_account_id % 25 AS INT) AS currency_id,
               CASE WHEN link_no = 7 THEN 0 ELSE 1 END AS is_cash, 0 AS nett_no, 5100 + link_no AS flow_method_id,
               CAST(0 AS BIGINT) AS flow_link_id, CAST(amount * 0.1 AS DECIMAL(18,2)) AS amt_contingent_rental,
               CAST(party_account_id % 10 AS INT) AS bank_interface_run_id, CASE WHEN link_no = 1 THEN 1 ELSE 0 END AS custom_flow_hdr_id,
               CAST(asset_hdr_id % 3 AS INT) AS settlement_bank_info_id, amt_gross AS amt_gross_netted, 14801 AS collection_state,
               1 AS late_fee_upto, 1 AS is_overdue_interest_pending, calc_dt AS last_overdue_interest_dt, 0 AS statement_id,
               amount AS amt_rental, CASE WHEN status = 2101 THEN calc_dt ELSE DATE '1900-01-01' END AS settled_dt,
               CAST(CASE WHEN quantity BETWEEN 41 AND 48 THEN 0 ELSE amount END AS DECIMAL(18,2)) AS amt_matched,
               CAST(CASE WHEN quantity BETWEEN 41 AND 48 THEN 0 ELSE amt_principal END AS DECIMAL(18,2)) AS amt_matched_principal,
               CAST(CASE WHEN quantity BETWEEN 41 AND 48 THEN 0 ELSE amount - amt_principal END AS DECIMAL(18,2)) AS amt_matched_interest,
               CAST(0 AS DECIMAL(18,2)) AS amt_matched_tax,
               CAST(CASE WHEN quantity BETWEEN 41 AND 48 THEN 0 ELSE amount END AS DECIMAL(18,2)) AS amt_matched_netted,
               CASE WHEN discount_pct = 7 THEN 1 ELSE 0 END AS exclude_from_account_bal, 1 AS last_user_id,
               0 AS reserve_statement_id, amt_gross AS amt_invoice
        FROM fx_flow_amounts""",
    "fx_linked_flow": """
        SELECT f.* EXCLUDE (flow_link_id), CASE WHEN f.flow_id = o.first_id THEN 0 ELSE o.first_id END AS flow_link_id
        FROM fx_flow f JOIN (SELECT contract_id, min(flow_id) AS first_id FROM fx_flow GROUP BY contract_id) o
          ON o.contract_id = f.contract_id""",
    "fx_flow_image": f"SELECT flow_id + {OFFSET} AS flow_id FROM fx_flow WHERE discount_pct = 4 AND quantity <= 25",
    "fx_tax": """
        SELECT flow_id * 2 AS tax_calc_flow_id, flow_id, contract_id,
               CASE WHEN discount_pct = 9 THEN asset_hdr_id - asset_hdr_id % 10 + (asset_hdr_id + 1) % 10
                    WHEN discount_pct = 10 THEN asset_hdr_id * 10 + 1 ELSE asset_hdr_id END AS asset_hdr_id,
               CAST(contract_id % 3 + 1 AS INT) AS tax_authority_id, 1 AS tax_type_id, amount, rate,
               CAST(round(amount * rate, 2) AS DECIMAL(18,2)) AS amt_tax
        FROM fx_flow WHERE rate <> 0
        UNION ALL
        SELECT flow_id * 2 + 1, flow_id, contract_id, asset_hdr_id, CAST(contract_id % 3 + 1 AS INT), 2, amount, rate,
               CAST(1.50 AS DECIMAL(18,2))
        FROM fx_flow WHERE rate <> 0 AND quantity <= 10""",
    "fx_tax_flow": """
        SELECT tax_calc_flow_id AS tax_flow_id, flow_id, contract_id, tax_authority_id, tax_type_id AS tax_type_hdr_id, amt_tax AS amount,
               amt_tax AS amt_financed, amt_tax AS amt_invoice, CASE WHEN flow_id % 2 = 0 THEN amt_tax ELSE 0 END AS amt_matched,
               CAST(rate AS DECIMAL(18,4)) AS tax_rate, 1 AS image_no FROM fx_tax""",
    "fx_match": """
        SELECT flow_id AS bank_flow_match_id, contract_id AS bank_flow_id, flow_id,
               CASE WHEN discount_pct = 3 THEN flow_id ELSE 0 END AS recovery_flow_id,
               CAST(CASE WHEN discount_pct = 2 THEN amount - 1 ELSE amount END AS DECIMAL(18,2)) AS amt_matched,
               amt_principal AS amt_matched_principal, amt_interest AS amt_matched_interest,
               CAST(round(amount * rate, 2) AS DECIMAL(18,2)) AS amt_matched_tax,
               CASE WHEN discount_pct = 5 THEN 1 ELSE 0 END AS is_deleted,
               CASE WHEN discount_pct = 6 THEN 1 ELSE 0 END AS is_rejected,
               DATE '1900-01-01' AS unallocated_dt, 0 AS unallocated_user_id
        FROM fx_flow WHERE quantity > 16""",
    "fx_bank_flow": """
        SELECT o_orderkey AS bank_flow_id, o_orderkey AS contract_id, o_custkey AS party_account_id,
               CAST(o_custkey % 50 AS INT) AS batch_no, 'CHQ' || CAST(o_orderkey AS VARCHAR) AS cheque_no,
               CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS is_deleted FROM orders""",
    "fx_invoice": "SELECT o_orderkey AS invoice_id, 'INV' || CAST(CASE WHEN o_orderkey % 8 = 1 THEN o_orderkey + 1 ELSE o_orderkey END AS VARCHAR) AS invoice_no FROM orders WHERE o_orderkey <> 0",
    "fx_writeoff": f"""
        SELECT flow_id, contract_id, link_no AS flow_link_id, party_account_id, amount
        FROM fx_flow WHERE flow_type = 1034 AND reversal_status = 4200
        UNION ALL
        SELECT flow_id + {OFFSET}, contract_id, link_no, party_account_id, amount
        FROM fx_flow WHERE flow_type = 1034 AND reversal_status = 4200 AND quantity >= 45""",
    "fx_custom_flow": """
        SELECT flow_id AS contract_custom_flow_id, contract_id, link_no, asset_hdr_id AS destination_asset_hdr_id, 1 AS is_active,
               CASE WHEN discount_pct = 8 THEN 1 ELSE 0 END AS is_deleted, CASE WHEN quantity = 50 THEN 1 ELSE 0 END AS is_restructure,
               1 AS custom_flow_hdr_id
        FROM fx_flow WHERE flow_type = 1010
        UNION ALL
        SELECT flow_id, contract_id, link_no, asset_hdr_id + 1, 1, 0, CASE WHEN quantity = 50 THEN 1 ELSE 0 END, 2
        FROM fx_flow WHERE flow_type = 1010 AND discount_pct = 1""",
    "fx_po_row": """
        SELECT flow_id AS po_row_cf_id, contract_id,
               CASE WHEN quantity % 3 = 0 THEN CAST(asset_hdr_id AS VARCHAR) || ', ' || CAST(asset_hdr_id + 1 AS VARCHAR)
                    WHEN quantity % 10 = 1 THEN CAST(asset_hdr_id AS VARCHAR) || ',n/a' ELSE CAST(asset_hdr_id AS VARCHAR) END AS destination_csv,
               CASE WHEN quantity > 25 THEN 1 ELSE 0 END AS num_assets_received
        FROM fx_flow WHERE link_no = 5""",
    "fx_expected_row": """
        SELECT flow_id AS contract_custom_flow_id, contract_id, CASE WHEN discount_pct >= 8 THEN 'POxROWy' ELSE 'PO_ROW_' END AS ext_reference
        FROM fx_flow WHERE link_no = 5 AND discount_pct > 0""",
    "fx_contract": """
        SELECT o_orderkey AS contract_id, o_custkey AS cparty_id, CAST(o_orderdate AS DATE) AS calc_dt,
               DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT) AS activated_dt,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 60 MONTH AS DATE) AS mature_dt,
               o_custkey % 97 AS default_asset_address_id,
               CASE o_orderstatus WHEN 'F' THEN 11130 WHEN 'O' THEN 11140 ELSE 11150 END AS contract_state,
               CASE o_orderpriority WHEN '1-URGENT' THEN 2011 WHEN '2-HIGH' THEN 2014 ELSE 2000 END AS product_style,
               CASE WHEN o_orderkey % 4 = 2 THEN 12040 ELSE 12030 END AS credit_state,
               6510 AS approval_status1, 6520 AS approval_status2, o_custkey AS approver1_id, o_custkey % 7 AS approver2_id, 2200 AS save_status
        FROM orders""",
    "fx_product": """
        SELECT product_style, CASE product_style WHEN 2011 THEN 'Loan' WHEN 2014 THEN 'Operating Lease' ELSE 'Hire' END AS name,
               CASE WHEN product_style = 2014 THEN 1 ELSE 0 END AS is_tax_based_pricing
        FROM (SELECT DISTINCT product_style FROM fx_contract)""",
    "fx_event_queue": """
        SELECT o_orderkey AS event_queue_id, o_orderkey AS contract_id, 24903 AS event_type,
               CASE o_orderkey % 4 WHEN 0 THEN 11030 WHEN 1 THEN 12020 WHEN 2 THEN 12040 ELSE 11130 END AS event_state_before,
               CAST(o_orderdate AS DATE) AS input_dt
        FROM orders""",
    "fx_asset_hdr": """
        SELECT p_partkey AS asset_hdr_id, CAST(floor(p_partkey / 10) AS BIGINT) AS owner_id,
               CAST(floor(p_partkey / 100) AS BIGINT) AS parent_owner_id,
               CASE p_size % 3 WHEN 0 THEN 43030 WHEN 1 THEN 43040 ELSE 43050 END AS asset_status,
               coalesce(last_contract, 0) AS current_contract_id, coalesce(first_contract, 0) AS original_contract_id,
               p_partkey % 2 * 5 AS delivery_address_id, CAST(0 AS BIGINT) AS current_address_id, p_name AS name, p_type AS model,
               p_size % 25 AS asset_type_id, CAST(p_size AS BIGINT) AS manufacturer_id
        FROM part LEFT JOIN (SELECT asset_hdr_id, max(contract_id) AS last_contract, min(contract_id) AS first_contract
                             FROM fx_flow GROUP BY asset_hdr_id) l ON l.asset_hdr_id = p_partkey""",
    "fx_asset": f"""
        SELECT {_id('contract_id', 'asset_hdr_id')} AS asset_id, contract_id, asset_hdr_id,
               CASE WHEN (contract_id + asset_hdr_id) % 3 = 0 THEN 1 ELSE 0 END AS is_terminated
        FROM (SELECT contract_id, asset_hdr_id FROM fx_flow WHERE link_no <= 4 AND asset_hdr_id % 31 <> 0
              UNION SELECT contract_id, CAST(floor(asset_hdr_id / 10) AS BIGINT) FROM fx_flow WHERE link_no = 1)""",
    "fx_quote": f"""
        SELECT {_id('contract_id', 'asset_hdr_id')} AS asset_hdr_quote_id, contract_id, asset_hdr_id,
               CASE WHEN asset_hdr_id % 5 = 0 THEN 44030 WHEN (contract_id + asset_hdr_id) % 4 = 0 THEN 44000
                    WHEN (contract_id + asset_hdr_id) % 4 = 1 THEN 44020 WHEN (contract_id + asset_hdr_id) % 4 = 2 THEN 44030
                    ELSE 44040 END AS quote_status
        FROM (SELECT DISTINCT contract_id, asset_hdr_id FROM fx_flow)""",
    "fx_addr": """
        SELECT event_id AS asset_hdr_address_id, user_id AS asset_hdr_id,
               CASE event_type WHEN 'click' THEN 45100 WHEN 'view' THEN 45101 ELSE 45102 END AS asset_hdr_address_type,
               CAST(ts AS DATE) AS effective_dt, event_id % 97 AS address_id
        FROM events WHERE event_type IN ('click', 'view', 'purchase')""",
    "fx_address": "SELECT c_custkey AS address_id, c_name AS street, CAST(c_nationkey AS VARCHAR) AS zip_code, c_mktsegment AS city FROM customer",
    "fx_asset_type": "SELECT n_nationkey AS asset_type_id, n_name AS name FROM nation",
    "fx_vehicle": "SELECT p_partkey AS asset_hdr_id, p_brand AS registration_no FROM part WHERE p_size % 4 = 0",
    "fx_alteration": """
        SELECT event_id AS contract_alteration_id, user_id AS contract_id,
               CAST(floor(event_id / 1000) AS BIGINT) AS contract_restructure_id, CAST(545 + event_id % 9 AS INT) AS fld_id,
               event_id % 50 AS obj_id
        FROM events""",
    "fx_restructure": """
        SELECT DISTINCT contract_id, contract_restructure_id FROM fx_alteration
        UNION ALL
        SELECT contract_id, max(contract_restructure_id) + 1 FROM fx_alteration WHERE contract_id % 3 = 0 GROUP BY contract_id""",
    "fx_party": """
        SELECT c_custkey AS party_id, c_custkey AS party_no, c_name AS name, c_name || ' Ltd' AS ext_name, c_acctbal AS gross_income, c_nationkey AS program_id,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 4 WHEN 'BUILDING' THEN 16 WHEN 'FURNITURE' THEN 64 WHEN 'MACHINERY' THEN 256 ELSE 8 END AS party_type,
               CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS is_business_unit, 0 AS is_branch,
               'first' || CAST(c_custkey AS VARCHAR) AS first_names, 'middle' AS middle_name,
               DATE '1960-01-01' + CAST(c_custkey % 9000 AS INT) AS date_of_birth, '+1 555 ' || CAST(c_custkey AS VARCHAR) AS phone_business,
               c_name || '@example.com' AS email_business, 'TAX' || CAST(c_custkey AS VARCHAR) AS tax_no
        FROM customer""",
    "fx_party_account": """
        SELECT s_suppkey AS party_account_id, s_name AS name, s_suppkey AS party_id, 'ACC' || CAST(s_suppkey AS VARCHAR) AS account_no
        FROM supplier""",
    "fx_program": "SELECT n_nationkey AS program_id, n_name AS program_name FROM nation",
    "fx_user": """
        SELECT c_custkey AS user_id, c_name AS user_name, c_name || '@example.com' AS email, CAST(16800 + c_custkey % 4 AS INT) AS external_user_type
        FROM customer""",
    "fx_gl": f"""
        SELECT flow_id AS gl_entry_id, CASE WHEN discount_pct = 4 THEN flow_id + {OFFSET} ELSE flow_id END AS flow_id, contract_id,
               calc_dt AS post_dt, amount, flow_type, reversal_status, CAST(party_account_id % 25 AS INT) AS currency_id,
               CAST(party_account_id % 5 AS INT) AS ledger_id, CAST(contract_id % 25 AS INT) AS base_currency_id,
               CAST(asset_hdr_id % 25 AS INT) AS gl_account_id, CAST(asset_hdr_id % 5 AS INT) AS gl_tag_id,
               CASE WHEN quantity <= 16 THEN 1 ELSE 0 END AS gl_interface_id
        FROM fx_flow""",
    "fx_gl_journal": """
        SELECT g.*, CASE WHEN g.flow_type = 1034 THEN 6002 ELSE 6001 END AS gl_entry_type, f.calc_dt + 1 AS input_dt,
               'line ' || CAST(f.link_no AS VARCHAR) AS narration, f.asset_hdr_id, CAST(g.amount * 2 AS DECIMAL(18,2)) AS base_amount,
               CAST(2 AS DECIMAL(9,4)) AS fx_rate, f.calc_dt AS fx_rate_dt
        FROM fx_gl g JOIN fx_flow f ON f.flow_id = g.gl_entry_id""",
    "fx_currency": "SELECT n_nationkey AS currency_id, upper(substr(n_name, 1, 3)) AS code FROM nation",
    "fx_ledger": "SELECT r_regionkey AS ledger_id, r_name AS name FROM region",
    "fx_gl_tag": "SELECT r_regionkey AS gl_tag_id, lower(r_name) AS ext_name, r_regionkey % 2 AS account_class FROM region",
    "fx_gl_account": """
        SELECT n_nationkey AS gl_account_id, CASE WHEN n_nationkey % 5 = 0 THEN 'System Suspense' ELSE n_name END AS name,
               'A' || CAST(n_nationkey AS VARCHAR) AS code FROM nation""",
    "fx_lookup": """
        SELECT * FROM (VALUES (1001, 'FlowType', 'Rental'), (1010, 'FlowType', 'Custom'), (1014, 'FlowType', 'Security Deposit'),
            (1034, 'FlowType', 'Write Off'), (4200, 'ReversalStatus', 'Current'), (4201, 'ReversalStatus', 'Reversed'),
            (4202, 'ReversalStatus', 'Reversal'), (2100, 'FlowStatus', 'Pending'), (2101, 'FlowStatus', 'Settled'),
            (5101, 'FlowMethod', 'Direct Debit'), (5102, 'FlowMethod', 'Cheque'), (5103, 'FlowMethod', 'Bank Transfer'), (6001, 'GLEntryType', 'Booking'),
            (6002, 'GLEntryType', 'Adjustment')) AS t(lookupset_id, set_name, value)""",
    "fx_audit_hdr": """
        SELECT event_id AS audit_hdr_id, ts AS audit_dt, CAST(event_id % 6 AS INT) AS change_type, user_id,
               CASE event_type WHEN 'click' THEN 'party' WHEN 'view' THEN 'address' WHEN 'purchase' THEN 'party_account' ELSE event_type END AS tbl_name
        FROM events""",
    "fx_audit_key": """
        SELECT event_id AS audit_hdr_id, 'id' AS fld_name,
               CASE WHEN event_id % 6 = 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS old_fld_value, CAST(user_id AS VARCHAR) AS new_fld_value
        FROM events""",
    "fx_audit_fld": """
        SELECT event_id AS audit_hdr_id, 'props' AS fld_name, CAST(NULL AS VARCHAR) AS old_fld_value, props AS new_fld_value
        FROM events WHERE event_type <> 'signup'""",
    "fx_note": "SELECT doc_id AS note_id, source AS subject, text AS comments, lang FROM documents",
    # Tables with an age, for retention.
    "rt_event_log": "SELECT event_id AS event_log_id, CAST(CAST(ts AS DATE) - INTERVAL 312 MONTH AS DATE) AS input_dt FROM events",
    "rt_grid_queue": "SELECT o_orderkey AS grid_queue_id, CAST(o_orderdate AS DATE) AS input_dt FROM orders",
    "rt_aii_event_queue_history": "SELECT o_orderkey AS history_id, CAST(o_orderdate AS DATE) AS end_dt FROM orders",
    "rt_aii_event_queue_response": "SELECT flow_id AS response_id, contract_id AS history_id FROM fx_flow",
    "rt_contract_write_off": "SELECT flow_id AS write_off_id, contract_id AS note_id, calc_dt + 10 AS input_dt, calc_dt FROM fx_flow WHERE flow_type = 1034",
    "rt_event_queue": "SELECT event_queue_id, input_dt FROM fx_event_queue",
    "rt_workflow_task_todo": "SELECT o_orderkey AS todo_id, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS completion_date FROM orders",
    "rt_note": "SELECT o_orderkey AS note_id, o_custkey AS doc_id, CAST(o_orderdate AS DATE) AS activity_dt, CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 AS INT) AS last_updated_dt FROM orders",
    "rt_note_attachment": "SELECT flow_id AS attachment_id, contract_id AS note_id FROM fx_flow",
    "rt_bank_interface_run": "SELECT o_orderkey AS run_id, CAST(o_orderdate AS DATE) AS run_dt FROM orders",
    "rt_bank_interface_run_temp": "SELECT flow_id AS temp_id, contract_id AS run_id FROM fx_flow",
    "rt_calculation_log": "SELECT o_orderkey AS log_id, CAST(o_orderdate AS DATE) AS calc_end_dt FROM orders",
    "rt_asset_balance": "SELECT flow_id AS asset_balance_id, calc_dt AS input_dt, calc_dt + CAST(link_no * 100 AS INT) AS effective_dt FROM fx_flow",
    "rt_doc_list": "SELECT o_orderkey AS doc_list_id, o_custkey AS doc_id FROM orders",
    "rt_doc_link": "SELECT o_orderkey AS doc_link_id, o_custkey AS doc_id FROM orders",
    "rt_doc": """
        SELECT c_custkey AS doc_id, DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 AS INT) AS effect_dt,
               DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 + 1 AS INT) AS created_dt, DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 + 20 AS INT) AS released_dt,
               DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 + 40 AS INT) AS output_dt, DATE '1900-01-01' AS rejected_dt
        FROM customer""",
}


def with_fixtures(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the derived frames it uses, in definition order. `extra` adds query-local steps."""
    known = {**FIXTURES, **(extra or {})}
    used: set[str] = set()
    waiting = [query]
    while waiting:
        for name in set(re.findall(r"\b(?:fx|rt|st)_\w+", waiting.pop())) & known.keys():
            if name not in used:
                used.add(name)
                waiting.append(known[name])
    steps = ",\n".join(f"{name} AS ({known[name].strip()})" for name in known if name in used)
    if not steps:
        return query.strip()
    return f"WITH RECURSIVE {steps}\n{query.strip()}"
