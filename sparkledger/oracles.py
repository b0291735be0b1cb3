"""The result of every query as SQL, written independently of the jobs."""

from __future__ import annotations

from sparkledger.oracle_fixtures import with_fixtures


CUSTOMER = ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _pairs() -> str:
    """Customers of two versions side by side."""
    beside = ", ".join(f"o.{c} AS old_{c}, n.{c} AS new_{c}" for c in CUSTOMER)
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in CUSTOMER)
    return f"""
        SELECT coalesce(o.c_custkey, n.c_custkey) AS k, o.c_custkey AS key_old, n.c_custkey AS key_new, {beside},
               CASE WHEN o.c_custkey IS NULL THEN 1 WHEN n.c_custkey IS NULL THEN 3 WHEN {differs} THEN 2 END AS change_type
        FROM customer o FULL JOIN st_customer2 n ON n.c_custkey = o.c_custkey"""


def _changed_fields() -> str:
    return " UNION ALL ".join(
        f"""SELECT audit_hdr_id, change_type, CAST(key_old AS VARCHAR) AS key_old, CAST(key_new AS VARCHAR) AS key_new, '{c}' AS fld_name,
               CAST(old_{c} AS VARCHAR) AS old_fld_value, CAST(new_{c} AS VARCHAR) AS new_fld_value
        FROM st_customer_changed WHERE old_{c} IS DISTINCT FROM new_{c}"""
        for c in CUSTOMER
    )


# Steps that several queries share --------------------------------------------------------------------

STEPS = {
    "st_deposits": """
        SELECT * FROM fx_flow WHERE flow_type = 1014 AND reversal_status = 4200 AND invoice_id <> 0
          AND flow_id NOT IN (SELECT flow_id FROM fx_tax)""",
    "st_numbered": """
        SELECT *, row_number() OVER (ORDER BY flow_id) AS rn, (SELECT max(flow_id) FROM fx_flow) AS top,
               count(*) OVER () AS n
        FROM st_deposits""",
    "st_reversal_rows": """
        SELECT * EXCLUDE (rn, top, n) REPLACE (4201 AS reversal_status, amt_gross AS amt_matched, amt_principal AS amt_matched_principal,
                   amt_interest AS amt_matched_interest, amt_gross_netted AS amt_matched_netted, 3 AS last_user_id),
               'original' AS role
        FROM st_numbered
        UNION ALL BY NAME
        SELECT * EXCLUDE (rn, top, n) REPLACE (top + 1 + rn AS flow_id, DATE '2002-01-01' AS actual_dt, 4202 AS reversal_status, 2100 AS status,
                   flow_id AS flow_link_id, 14800 AS collection_state, 3 AS last_user_id,
                   -amount AS amount, -amt_principal AS amt_principal, -amt_interest AS amt_interest, -amt_gross AS amt_gross,
                   -amt_contingent_rental AS amt_contingent_rental, -amt_gross_netted AS amt_gross_netted,
                   -amt_gross AS amt_matched, -amt_principal AS amt_matched_principal, -amt_interest AS amt_matched_interest,
                   CAST(-(amt_gross - amount) AS DECIMAL(18,2)) AS amt_matched_tax, -amt_gross_netted AS amt_matched_netted, -amt_gross AS amt_invoice,
                   0 AS nett_no, 0 AS flow_method_id, 0 AS invoice_id, 0 AS bank_interface_run_id, 0 AS settlement_bank_info_id,
                   0 AS late_fee_upto, 0 AS is_overdue_interest_pending, 0 AS statement_id, 0 AS reserve_statement_id,
                   DATE '1900-01-01' AS settled_dt, DATE '1900-01-01' AS last_overdue_interest_dt),
               'reversal' AS role
        FROM st_numbered
        UNION ALL BY NAME
        SELECT * EXCLUDE (rn, top, n) REPLACE (top + 1 + n + 1 + rn AS flow_id, 2 AS image_no, 4200 AS reversal_status, 2100 AS status,
                   0 AS flow_link_id, 14800 AS collection_state, 3 AS last_user_id,
                   CAST(0 AS DECIMAL(18,2)) AS amt_matched, CAST(0 AS DECIMAL(18,2)) AS amt_matched_principal,
                   CAST(0 AS DECIMAL(18,2)) AS amt_matched_interest, CAST(0 AS DECIMAL(18,2)) AS amt_matched_tax,
                   CAST(0 AS DECIMAL(18,2)) AS amt_matched_netted, amt_gross AS amt_invoice,
                   0 AS nett_no, 0 AS flow_method_id, 0 AS invoice_id, 0 AS bank_interface_run_id, 0 AS settlement_bank_info_id,
                   0 AS late_fee_upto, 0 AS is_overdue_interest_pending, 0 AS statement_id, 0 AS reserve_statement_id,
                   DATE '1900-01-01' AS settled_dt, DATE '1900-01-01' AS last_overdue_interest_dt),
               'replacement' AS role
        FROM st_numbered""",
    "st_up": """
        SELECT asset_hdr_id AS descendant_id, owner_id AS root_id, 1 AS depth, [asset_hdr_id, owner_id] AS path
        FROM fx_asset_hdr WHERE owner_id <> asset_hdr_id AND owner_id <> 0
          AND owner_id IN (SELECT asset_hdr_id FROM fx_asset_hdr)
        UNION ALL
        SELECT u.descendant_id, h.owner_id, u.depth + 1, list_append(u.path, h.owner_id)
        FROM st_up u JOIN fx_asset_hdr h ON h.asset_hdr_id = u.root_id
        WHERE h.owner_id <> h.asset_hdr_id AND h.owner_id <> 0 AND NOT list_contains(u.path, h.owner_id)
          AND h.owner_id IN (SELECT asset_hdr_id FROM fx_asset_hdr)""",
    "st_closure": "SELECT root_id, descendant_id FROM st_up UNION SELECT asset_hdr_id, asset_hdr_id FROM fx_asset_hdr",
    "st_destination": """
        SELECT contract_id, link_no, custom_flow_hdr_id, destination_asset_hdr_id AS destination FROM fx_custom_flow c
        WHERE is_active = 1 AND is_deleted = 0 AND is_restructure = 0
          AND (SELECT count(*) FROM fx_custom_flow d WHERE d.contract_id = c.contract_id AND d.link_no = c.link_no
               AND d.custom_flow_hdr_id = c.custom_flow_hdr_id AND d.is_active = 1 AND d.is_deleted = 0) = 1""",
    "st_line": """
        SELECT t.*, f.contract_id AS flow_contract_id, d.destination,
               (t.asset_hdr_id = d.destination OR EXISTS (SELECT 1 FROM st_closure k WHERE k.root_id = d.destination AND k.descendant_id = t.asset_hdr_id)) AS is_correct
        FROM fx_flow f JOIN st_destination d ON d.contract_id = f.contract_id AND d.link_no = f.link_no AND d.custom_flow_hdr_id = f.custom_flow_hdr_id
        JOIN fx_tax t ON t.flow_id = f.flow_id
        WHERE f.flow_type = 1010 AND f.reversal_status = 4200 AND f.custom_flow_hdr_id <> 0""",
    "st_invalid": """
        SELECT l.tax_calc_flow_id, l.flow_id, l.contract_id, l.asset_hdr_id, l.tax_authority_id, l.tax_type_id, l.amount, l.rate, l.amt_tax
        FROM st_line l JOIN fx_asset_hdr h ON h.asset_hdr_id = l.asset_hdr_id
        WHERE NOT l.is_correct AND l.flow_id IN (SELECT flow_id FROM st_line WHERE is_correct)
          AND (l.asset_hdr_id = 0 OR EXISTS (SELECT 1 FROM fx_asset a WHERE a.contract_id = l.flow_contract_id
                                             AND a.asset_hdr_id IN (h.asset_hdr_id, h.owner_id, h.parent_owner_id)))""",
    "st_tax_numbered": """
        SELECT flow_id, row_number() OVER (ORDER BY flow_id) AS rn, count(*) OVER () AS n, (SELECT max(flow_id) FROM fx_flow) AS top
        FROM fx_flow WHERE flow_id IN (SELECT flow_id FROM st_invalid)
          AND (status = 2101 OR invoice_id <> 0 OR statement_id > 0 OR amt_matched <> 0)""",
    "st_new_tax_flow": """
        SELECT (SELECT max(tax_flow_id) FROM fx_tax_flow) + row_number() OVER (ORDER BY flow_id, tax_authority_id, tax_type_hdr_id) AS tax_flow_id, *
        FROM (
            SELECT f.top + 1 + f.rn AS flow_id, t.contract_id, t.tax_authority_id, t.tax_type_hdr_id, CAST(-t.amount AS DECIMAL(18,2)) AS amount,
                   CAST(-t.amt_matched AS DECIMAL(18,2)) AS amt_financed, CAST(-t.amt_invoice AS DECIMAL(18,2)) AS amt_invoice,
                   CAST(-t.amt_financed AS DECIMAL(18,2)) AS amt_matched, t.tax_rate, t.image_no
            FROM fx_tax_flow t JOIN st_tax_numbered f ON f.flow_id = t.flow_id
            UNION ALL
            SELECT flow_id, contract_id, tax_authority_id, tax_type_id, s, s, s, s,
                   CAST(CASE WHEN amount = 0 THEN NULL ELSE
                     ((2 * CAST(s * 100 AS HUGEINT) * 10000 + CAST(amount * 100 AS HUGEINT)) // (2 * CAST(amount * 100 AS HUGEINT))) / 10000.0 END AS DECIMAL(18,4)), 0
            FROM (SELECT f.top + 2 + f.n + f.rn AS flow_id, t.contract_id, t.tax_authority_id, t.tax_type_id, t.amount, CAST(sum(t.amt_tax) AS DECIMAL(18,2)) AS s
                  FROM fx_tax t JOIN st_tax_numbered f ON f.flow_id = t.flow_id
                  WHERE t.tax_calc_flow_id NOT IN (SELECT tax_calc_flow_id FROM st_invalid) GROUP BY ALL)
        )""",
    "st_repair_flow": """
        SELECT * REPLACE (CASE WHEN invoice_id = 0 AND status = 2100 THEN CAST(0 AS DECIMAL(18,2)) ELSE amt_matched END AS amt_matched) FROM fx_flow""",
    "st_repair_closed": """
        SELECT *, row_number() OVER (ORDER BY flow_id) AS rn, count(*) OVER () AS n, (SELECT max(flow_id) FROM fx_flow) AS top
        FROM st_repair_flow WHERE flow_id IN (SELECT flow_id FROM st_invalid)
          AND (status = 2101 OR invoice_id <> 0 OR statement_id > 0 OR amt_matched <> 0)""",
    "st_repair_gone": """
        SELECT * FROM st_invalid WHERE flow_id IN (
          SELECT flow_id FROM st_repair_flow WHERE status <> 2101 AND invoice_id = 0 AND statement_id <= 0 AND amt_matched = 0)""",
    "st_repair_tax": """
        SELECT flow_id, amt_tax FROM fx_tax WHERE tax_calc_flow_id NOT IN (SELECT tax_calc_flow_id FROM st_repair_gone)
        UNION ALL
        SELECT f.top + 1 + f.rn, -t.amt_tax FROM fx_tax t JOIN st_repair_closed f ON f.flow_id = t.flow_id
        UNION ALL
        SELECT f.top + 2 + f.n + f.rn, t.amt_tax FROM fx_tax t JOIN st_repair_closed f ON f.flow_id = t.flow_id
        WHERE t.tax_calc_flow_id NOT IN (SELECT tax_calc_flow_id FROM st_invalid)""",
    "st_repair_sum": "SELECT flow_id, count(*) AS n_rows, CAST(sum(amt_tax) AS DECIMAL(38,2)) AS amt_tax FROM st_repair_tax GROUP BY flow_id",
    "st_repair_rows": """
        SELECT flow_id, contract_id, flow_link_id, image_no, status, 4201 AS reversal_status, amount, amt_gross, amt_gross_netted, amt_gross AS amt_matched
        FROM st_repair_closed
        UNION ALL
        SELECT top + 1 + rn, contract_id, flow_id, image_no, 2100, 4202, -amount, -amt_gross, -amt_gross_netted, -amt_gross FROM st_repair_closed
        UNION ALL
        SELECT f.flow_id, f.contract_id, f.flow_link_id, f.image_no, f.status, f.reversal_status, f.amount, CAST(f.amount + coalesce(s.amt_tax, 0) AS DECIMAL(18,2)),
               CAST(f.amount + coalesce(s.amt_tax, 0) AS DECIMAL(18,2)), f.amt_matched
        FROM (SELECT top + 2 + n + rn AS flow_id, contract_id, 0 AS flow_link_id, image_no + 1 AS image_no, 2100 AS status, 4200 AS reversal_status, amount,
                     CAST(0 AS DECIMAL(18,2)) AS amt_matched FROM st_repair_closed
              UNION ALL
              SELECT flow_id, contract_id, flow_link_id, image_no, status, reversal_status, amount, amt_matched FROM st_repair_flow
              WHERE flow_id IN (SELECT flow_id FROM st_repair_gone)) f
        LEFT JOIN st_repair_sum s ON s.flow_id = f.flow_id""",
    "st_customer2": """
        SELECT * REPLACE (CASE WHEN c_custkey % 5 = 1 THEN NULL ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 5 = 1 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment)
        FROM customer WHERE c_custkey % 7 <> 3
        UNION ALL
        SELECT * REPLACE (c_custkey + 1000000000 AS c_custkey, NULL AS c_acctbal) FROM customer WHERE c_custkey % 11 = 0""",
    "st_customer_pair": _pairs(),
    "st_customer_changed": "SELECT row_number() OVER (ORDER BY k) AS audit_hdr_id, * FROM st_customer_pair WHERE change_type IS NOT NULL",
    "st_live": "SELECT * FROM fx_match WHERE is_deleted = 0 AND is_rejected = 0",
    "st_unmatched": """
        SELECT * FROM fx_flow f WHERE reversal_status = 4200 AND flow_type <> 1034 AND amt_matched <> 0 AND contract_id > 0
          AND is_cash = 1 AND nett_no = 0
          AND contract_id IN (SELECT contract_id FROM fx_contract WHERE product_style = 2011)
          AND NOT EXISTS (SELECT 1 FROM st_live m WHERE m.flow_id = f.flow_id)""",
    "st_reset": "SELECT * FROM fx_event_queue WHERE event_type = 24903 AND event_state_before IN (12020, 12040)",
    "st_term_quote": """
        SELECT q.*, h.asset_status FROM fx_quote q JOIN fx_asset_hdr h ON h.asset_hdr_id = q.asset_hdr_id
        WHERE q.quote_status <> 44040 AND EXISTS (SELECT 1 FROM fx_asset a WHERE a.contract_id = q.contract_id AND a.is_terminated = 1
              AND a.asset_hdr_id IN (h.asset_hdr_id, h.owner_id, h.parent_owner_id))""",
    "st_act_contract": """
        SELECT DISTINCT c.contract_id FROM fx_contract c JOIN fx_asset_hdr h ON h.current_contract_id = c.contract_id
        JOIN fx_quote q ON q.contract_id = c.contract_id AND q.asset_hdr_id = h.asset_hdr_id
        WHERE c.contract_state IN (11130, 11140) AND h.asset_status = 43040 AND q.quote_status = 44000 AND c.product_style = 2014
          AND EXISTS (SELECT 1 FROM fx_event_queue e WHERE e.contract_id = c.contract_id AND e.event_state_before = 11030)""",
    "st_act_quote": """
        SELECT q.asset_hdr_quote_id, q.quote_status, h.asset_hdr_id, h.asset_status FROM st_act_contract c
        JOIN fx_asset_hdr h ON h.current_contract_id = c.contract_id
        JOIN fx_quote q ON q.contract_id = c.contract_id AND q.asset_hdr_id = h.asset_hdr_id
        WHERE EXISTS (SELECT 1 FROM fx_asset a WHERE a.contract_id = c.contract_id AND a.is_terminated = 0
                      AND a.asset_hdr_id IN (h.asset_hdr_id, h.owner_id, h.parent_owner_id))""",
    "st_judged": """
        SELECT q.asset_hdr_quote_id, q.asset_hdr_id, q.quote_status, max(a.asset_hdr_id) IS NOT NULL AS has_asset,
               CASE WHEN max(a.asset_hdr_id) IS NULL THEN 44010
                    WHEN max(a.is_terminated) = 1 AND max(c.contract_state) = 11150 THEN 44040 ELSE q.quote_status END AS new_status
        FROM fx_quote q JOIN fx_asset_hdr h ON h.asset_hdr_id = q.asset_hdr_id JOIN fx_contract c ON c.contract_id = q.contract_id
        LEFT JOIN fx_asset a ON a.contract_id = q.contract_id AND a.asset_hdr_id IN (h.asset_hdr_id, h.owner_id, h.parent_owner_id)
        WHERE q.quote_status IN (44000, 44020)
        GROUP BY q.asset_hdr_quote_id, q.asset_hdr_id, q.quote_status""",
    "st_activated_asset": """
        SELECT h.asset_hdr_id, h.asset_status FROM fx_asset_hdr h JOIN fx_contract c ON c.contract_id = h.current_contract_id
        WHERE c.contract_state = 11130""",
    "st_candidate": """
        SELECT DISTINCT h.asset_hdr_id, CASE WHEN h.delivery_address_id > 0 THEN h.delivery_address_id ELSE c.default_asset_address_id END AS address_id,
               c.activated_dt AS effective_dt
        FROM fx_asset_hdr h JOIN fx_contract c ON c.contract_id = h.current_contract_id WHERE h.current_contract_id > 0""",
    "st_latest_address": """
        SELECT a.* FROM fx_addr a WHERE a.asset_hdr_address_type = 45101
          AND a.effective_dt = (SELECT max(b.effective_dt) FROM fx_addr b WHERE b.asset_hdr_address_type = 45101 AND b.asset_hdr_id = a.asset_hdr_id)""",
    "st_act_candidate": """
        SELECT DISTINCT q.asset_hdr_id, CASE WHEN h.delivery_address_id > 0 THEN h.delivery_address_id ELSE c.default_asset_address_id END AS address_id,
               c.calc_dt AS effective_dt
        FROM st_act_quote q JOIN fx_asset_hdr h ON h.asset_hdr_id = q.asset_hdr_id JOIN fx_contract c ON c.contract_id = h.current_contract_id""",
    "st_act_address": """
        SELECT h.asset_hdr_id, h.current_contract_id, h.current_address_id, c.address_id FROM st_act_candidate c JOIN fx_asset_hdr h ON h.asset_hdr_id = c.asset_hdr_id
        WHERE NOT EXISTS (SELECT 1 FROM st_latest_address l WHERE l.asset_hdr_id = c.asset_hdr_id AND (l.address_id = c.address_id OR l.effective_dt >= c.effective_dt))""",
    "st_address_change": """
        SELECT asset_hdr_id, address_id, effective_dt,
               CASE WHEN EXISTS (SELECT 1 FROM st_latest_address l WHERE l.asset_hdr_id = c.asset_hdr_id
                                 AND (l.address_id = c.address_id OR l.effective_dt >= c.effective_dt)) THEN 0 ELSE 1 END AS update_current_address,
               CASE WHEN EXISTS (SELECT 1 FROM st_latest_address l WHERE l.asset_hdr_id = c.asset_hdr_id AND l.effective_dt = c.effective_dt) THEN 0 ELSE 1 END AS insert_asset_hdr_address
        FROM st_candidate c""",
    "st_as_of": """
        SELECT asset_hdr_id, asset_hdr_address_type, address_id, effective_dt FROM fx_addr WHERE effective_dt <= DATE '2024-01-15'
        QUALIFY row_number() OVER (PARTITION BY asset_hdr_id, asset_hdr_address_type ORDER BY effective_dt DESC, asset_hdr_address_id DESC) = 1""",
    "st_asset_rows": """
        SELECT 'contract asset' AS row_type, a.contract_id, a.asset_id, a.asset_hdr_id, h.name, h.model, h.asset_type_id, h.manufacturer_id,
               h.asset_status, 0 AS asset_hdr_address_type, o.address_id
        FROM fx_asset a JOIN fx_asset_hdr h ON h.asset_hdr_id = a.asset_hdr_id
        JOIN st_as_of o ON o.asset_hdr_id = a.asset_hdr_id AND o.asset_hdr_address_type = 45101
        UNION ALL
        SELECT 'physical asset', CASE WHEN h.current_contract_id > 0 THEN h.current_contract_id ELSE h.original_contract_id END, 0,
               h.asset_hdr_id, h.name, h.model, h.asset_type_id, h.manufacturer_id, h.asset_status, o.asset_hdr_address_type, o.address_id
        FROM fx_asset_hdr h JOIN st_as_of o ON o.asset_hdr_id = h.asset_hdr_id WHERE h.asset_hdr_id > 0""",
    "st_latest_rows": """
        SELECT a.* FROM fx_alteration a WHERE a.fld_id IN (548, 549, 550, 552, 553)
          AND a.contract_restructure_id = (SELECT max(b.contract_restructure_id) FROM fx_restructure b WHERE b.contract_id = a.contract_id)""",
    "st_gl": """
        SELECT g.contract_id, g.gl_interface_id, g.gl_entry_id, g.post_dt, c.code AS currency_code, b.code AS base_currency_code,
               a.name AS account_name, a.code AS account_code, g.amount, g.flow_id, l1.value AS flow_type_name, l2.value AS reversal_status_name,
               d.name AS ledger_name, g.gl_tag_id, t.ext_name AS tag_name, t.account_class
        FROM fx_gl g, fx_currency c, fx_currency b, fx_gl_account a, fx_lookup l1, fx_lookup l2, fx_ledger d, fx_gl_tag t
        WHERE g.currency_id = c.currency_id AND g.base_currency_id = b.currency_id AND g.gl_account_id = a.gl_account_id
          AND g.flow_type = l1.lookupset_id AND g.reversal_status = l2.lookupset_id AND g.ledger_id = d.ledger_id AND g.gl_tag_id = t.gl_tag_id""",
    "st_gl_journal": """
        SELECT s.*, l.value AS entry_type_name, j.input_dt, j.narration, j.asset_hdr_id, j.base_amount, j.fx_rate, j.fx_rate_dt
        FROM st_gl s JOIN fx_gl_journal j ON j.gl_entry_id = s.gl_entry_id JOIN fx_lookup l ON l.lookupset_id = j.gl_entry_type""",
    "st_dup_writeoff": """
        SELECT contract_id, flow_link_id, amount, count(*) AS n_rows FROM fx_writeoff GROUP BY contract_id, flow_link_id, amount HAVING count(*) > 1""",
    "st_audit": """
        SELECT h.audit_hdr_id, h.audit_dt, CASE h.change_type WHEN 0 THEN 'None' WHEN 1 THEN 'Insert' WHEN 2 THEN 'Update' WHEN 3 THEN 'Delete' WHEN 4 THEN 'Queued' END AS change_name,
               u.user_name, h.tbl_name, k.fld_name AS key_name, k.old_fld_value AS key_old, k.new_fld_value AS key_new, f.fld_name, f.old_fld_value, f.new_fld_value
        FROM fx_audit_hdr h JOIN fx_audit_key k ON k.audit_hdr_id = h.audit_hdr_id JOIN fx_user u ON u.user_id = h.user_id
        LEFT JOIN fx_audit_fld f ON f.audit_hdr_id = h.audit_hdr_id""",
    "st_masked": """
        SELECT *, (party_id > 0 AND ((is_business_unit = 0 AND is_branch = 0) OR party_type = 32)) AS hit,
               CASE WHEN party_type = 4 THEN 'V_Customer' WHEN party_type = 16 THEN 'I_Customer' WHEN party_type = 64 THEN 'T_Customer'
                    WHEN party_type IN (256, 258, 262, 272) THEN 'BR_Customer' ELSE 'C_Customer' END AS prefix,
               CASE WHEN party_type = 4 THEN 'vendor' WHEN party_type = 16 THEN 'insurance' WHEN party_type = 64 THEN 'tax_authority'
                    WHEN party_type IN (256, 258, 262, 272) THEN 'broker' ELSE 'customer' END AS category
        FROM fx_party""",
    "st_personal": "SELECT audit_hdr_id FROM fx_audit_hdr WHERE tbl_name IN ('party', 'party_account', 'party_address', 'party_bankacc', 'address')",
    "rt_old_note": "SELECT note_id FROM rt_note WHERE activity_dt < DATE '1998-01-15' AND last_updated_dt < DATE '1998-01-15'",
    "rt_old_doc": """
        SELECT doc_id FROM rt_doc WHERE doc_id <> 0 AND effect_dt < DATE '1998-01-15' AND created_dt < DATE '1998-01-15'
          AND released_dt < DATE '1998-01-15' AND output_dt < DATE '1998-01-15' AND rejected_dt < DATE '1998-01-15'""",
    "rt_doc_note": "SELECT note_id FROM rt_note WHERE doc_id IN (SELECT doc_id FROM rt_old_doc)",
}


def _in_order(query: str) -> str:
    return with_fixtures(query, STEPS)


# Retention report ------------------------------------------------------------------------------------

CUT = "DATE '1998-01-15'"
RETENTION = {
    "event_log": {1: f"input_dt < {CUT}"},
    "grid_queue": {2: f"input_dt < {CUT}"},
    "aii_event_queue_response": {3: f"history_id IN (SELECT history_id FROM rt_aii_event_queue_history WHERE end_dt < {CUT})"},
    "contract_write_off": {
        4: f"input_dt < {CUT} AND calc_dt < {CUT}",
        7: "note_id IN (SELECT note_id FROM rt_old_note)",
        15: "note_id IN (SELECT note_id FROM rt_doc_note)",
    },
    "event_queue": {5: f"input_dt < {CUT}"},
    "workflow_task_todo": {6: f"coalesce(completion_date < {CUT}, false)"},
    "note_attachment": {8: "note_id IN (SELECT note_id FROM rt_old_note)", 16: "note_id IN (SELECT note_id FROM rt_doc_note)"},
    "note": {9: f"activity_dt < {CUT} AND last_updated_dt < {CUT}", 17: "doc_id IN (SELECT doc_id FROM rt_old_doc)"},
    "bank_interface_run_temp": {10: f"run_id IN (SELECT run_id FROM rt_bank_interface_run WHERE run_dt < {CUT})"},
    "calculation_log": {11: f"calc_end_dt < {CUT}"},
    "asset_balance": {12: f"input_dt < {CUT} AND effective_dt < {CUT}"},
    "doc_list": {13: "doc_id IN (SELECT doc_id FROM rt_old_doc)"},
    "doc_link": {14: "doc_link_id <> 0 AND doc_id IN (SELECT doc_id FROM rt_old_doc)"},
    "doc": {18: "doc_id IN (SELECT doc_id FROM rt_old_doc)"},
}


def _retention_report() -> str:
    lines = []
    for table, steps in RETENTION.items():
        anywhere = " OR ".join(f"({condition})" for condition in steps.values())
        for step, condition in {0: anywhere, **steps}.items():
            lines.append(
                f"SELECT '{table}' AS table_name, {step} AS step, count(*) AS n_total, "
                f"count(*) FILTER (WHERE {condition}) AS n_deleted, count(*) - count(*) FILTER (WHERE {condition}) AS n_kept FROM rt_{table}"
            )
    return "\nUNION ALL\n".join(lines)


KEY_COLUMNS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey"], "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
}


def _profile() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS n_distinct FROM {table}"
        for table, columns in KEY_COLUMNS.items()
        for c in columns
    )


def _counts() -> str:
    tables = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
    return "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in tables.split())



QUERIES = {
    "flow_reversal": "SELECT * FROM st_reversal_rows",
    "flow_reversal_keys": """
        SELECT top + 1 + rn AS flow_id, flow_id AS original_flow_id, contract_id, 'reversal' AS kind FROM st_numbered
        UNION ALL SELECT top + 2 + n + rn, flow_id, contract_id, 'replacement' FROM st_numbered""",
    "flow_reversal_tax": """
        SELECT f.top + 1 + f.rn AS flow_id, t.asset_hdr_id, t.contract_id, t.tax_authority_id, t.tax_type_id, -t.amount AS amount,
               -t.amt_tax AS amt_tax, t.rate, 'reversal' AS kind
        FROM fx_tax t JOIN st_tax_numbered f ON f.flow_id = t.flow_id
        UNION ALL
        SELECT f.top + 2 + f.n + f.rn, t.asset_hdr_id, t.contract_id, t.tax_authority_id, t.tax_type_id, t.amount, t.amt_tax, t.rate, 'replacement'
        FROM fx_tax t JOIN st_tax_numbered f ON f.flow_id = t.flow_id
        WHERE t.tax_calc_flow_id NOT IN (SELECT tax_calc_flow_id FROM st_invalid)""",
    "posting_tax_flows": "SELECT * FROM st_new_tax_flow",
    "posting_tables": """
        SELECT 'flow' AS table_name, (SELECT count(*) FROM fx_flow) + 2 * (SELECT count(*) FROM st_tax_numbered) AS n_rows,
               (SELECT CAST(sum(amount) AS DECIMAL(28,2)) FROM fx_flow) AS total
        UNION ALL SELECT 'tax_calc_flow', count(*), CAST(sum(amt_tax) AS DECIMAL(28,2)) FROM (
            SELECT amt_tax FROM fx_tax UNION ALL SELECT -amt_tax FROM fx_tax WHERE flow_id IN (SELECT flow_id FROM st_tax_numbered)
            UNION ALL SELECT amt_tax FROM fx_tax WHERE flow_id IN (SELECT flow_id FROM st_tax_numbered)
                AND tax_calc_flow_id NOT IN (SELECT tax_calc_flow_id FROM st_invalid))
        UNION ALL SELECT 'tax_flow', count(*), CAST(sum(amt_matched) AS DECIMAL(28,2)) FROM (
            SELECT amt_matched FROM fx_tax_flow UNION ALL SELECT amt_matched FROM st_new_tax_flow)
        UNION ALL SELECT 'bank_flow_match', count(*), CAST(sum(CASE WHEN flow_id IN (SELECT flow_id FROM st_tax_numbered) THEN 1 ELSE is_deleted END) AS DECIMAL(28,2))
        FROM fx_match""",
    "tax_repair_flows": "SELECT * FROM st_repair_rows",
    "tax_repair_sums": "SELECT * FROM st_repair_sum",
    "tax_repair_checks": """
        SELECT 'affected_invoices' AS check_name, count(DISTINCT v.invoice_no) AS n_rows
        FROM st_invalid i JOIN fx_flow f ON f.flow_id = i.flow_id JOIN fx_invoice v ON v.invoice_id = f.invoice_id WHERE f.invoice_id <> 0
        UNION ALL
        SELECT 'tax_mismatches', count(*) FROM st_repair_rows r JOIN st_repair_sum s ON s.flow_id = r.flow_id
        WHERE r.reversal_status = 4200 AND r.amt_gross - r.amount <> s.amt_tax
        UNION ALL
        SELECT 'flows_to_reallocate', count(DISTINCT (c.flow_id, b.bank_flow_id)) FROM st_repair_closed c
        JOIN fx_match m ON m.flow_id = c.flow_id JOIN fx_bank_flow b ON b.bank_flow_id = m.bank_flow_id
        UNION ALL
        SELECT 'unallocated_bank_flows', count(*) FROM fx_bank_flow b JOIN fx_party_account a ON a.party_account_id = b.party_account_id
        WHERE b.bank_flow_id IN (SELECT m.bank_flow_id FROM fx_match m JOIN st_repair_closed c ON c.flow_id = m.flow_id)""",
    "release_unmatched_tax": """
        SELECT *, 'update_before' AS op FROM fx_tax_flow WHERE flow_id IN (SELECT flow_id FROM st_unmatched)
        UNION ALL BY NAME
        SELECT * REPLACE (CAST(0 AS DECIMAL(18,2)) AS amt_matched), 'update_after' AS op FROM fx_tax_flow WHERE flow_id IN (SELECT flow_id FROM st_unmatched)""",
    "invalid_tax_lines": "SELECT * FROM st_invalid",
    "invalid_tax_lines_removed": """
        SELECT * FROM fx_tax WHERE tax_calc_flow_id NOT IN (
          SELECT i.tax_calc_flow_id FROM st_invalid i JOIN fx_flow f ON f.flow_id = i.flow_id
          WHERE f.status <> 2101 AND f.invoice_id = 0 AND f.statement_id <= 0 AND f.amt_matched = 0)""",
    "tax_rollup": """
        SELECT flow_id, contract_id, tax_authority_id, tax_type_id AS tax_type_hdr_id, s AS amount, s AS amt_financed, s AS amt_invoice,
               s AS amt_matched,
               CAST(CASE WHEN amount = 0 THEN NULL ELSE
                 ((2 * CAST(s * 100 AS HUGEINT) * 10000 + CAST(amount * 100 AS HUGEINT)) // (2 * CAST(amount * 100 AS HUGEINT))) / 10000.0 END AS DECIMAL(18,4)) AS tax_rate
        FROM (SELECT amount, contract_id, flow_id, tax_authority_id, tax_type_id, CAST(sum(amt_tax) AS DECIMAL(18,2)) AS s
              FROM fx_tax GROUP BY ALL)""",
    "tax_rollup_gross": """
        SELECT f.flow_id, f.contract_id, f.amount, CAST(f.amount + coalesce(t.s, 0) AS DECIMAL(18,2)) AS amt_gross,
               CAST(f.amount + coalesce(t.s, 0) AS DECIMAL(18,2)) AS amt_gross_netted
        FROM fx_flow f LEFT JOIN (SELECT flow_id, sum(amt_tax) AS s FROM fx_tax GROUP BY flow_id) t ON t.flow_id = f.flow_id""",
    "tax_reconcile": """
        SELECT f.flow_id, f.contract_id, f.amount, f.amt_gross, t.total_tax FROM fx_flow f
        JOIN (SELECT flow_id, CAST(sum(amt_tax) AS DECIMAL(38,2)) AS total_tax FROM fx_tax GROUP BY flow_id) t ON t.flow_id = f.flow_id
        WHERE f.reversal_status = 4200 AND round(f.amt_gross - f.amount, 2) <> t.total_tax""",
    "tax_missing": """
        SELECT flow_id, contract_id, amount, invoice_id FROM fx_flow f WHERE flow_type = 1014 AND reversal_status = 4200
          AND NOT EXISTS (SELECT 1 FROM fx_tax t WHERE t.flow_id = f.flow_id)""",
    "affected_invoice_tax": """
        SELECT v.invoice_no, CAST(sum(i.amt_tax) AS DECIMAL(38,2)) AS correct_total_tax
        FROM st_invalid i JOIN fx_flow f ON f.flow_id = i.flow_id JOIN fx_invoice v ON v.invoice_id = f.invoice_id
        WHERE f.invoice_id <> 0 GROUP BY v.invoice_no""",
    "release_unmatched": """
        SELECT *, 'update_before' AS op FROM st_unmatched
        UNION ALL BY NAME
        SELECT * REPLACE (CAST(0 AS DECIMAL(18,2)) AS amt_matched, CAST(0 AS DECIMAL(18,2)) AS amt_matched_principal,
                          CAST(0 AS DECIMAL(18,2)) AS amt_matched_interest, CAST(0 AS DECIMAL(18,2)) AS amt_matched_tax,
                          CAST(0 AS DECIMAL(18,2)) AS amt_matched_netted), 'update_after' AS op FROM st_unmatched""",
    "release_unmatched_list": """
        SELECT f.contract_id, f.flow_id, f.calc_dt, f.amount, f.amt_gross, l.value AS flow_type_name, a.account_no, p.party_no, i.invoice_no
        FROM st_unmatched f JOIN fx_lookup l ON l.lookupset_id = f.flow_type JOIN fx_party_account a ON a.party_account_id = f.party_account_id
        JOIN fx_party p ON p.party_id = a.party_id JOIN fx_invoice i ON i.invoice_id = f.invoice_id""",
    "match_reconcile": """
        SELECT f.flow_id, f.contract_id, f.amt_matched, m.amt_match_rows FROM fx_flow f
        JOIN (SELECT flow_id, CAST(sum(amt_matched) AS DECIMAL(38,2)) AS amt_match_rows FROM st_live
              WHERE bank_flow_id IN (SELECT bank_flow_id FROM fx_bank_flow WHERE is_deleted = 0) GROUP BY flow_id) m ON m.flow_id = f.flow_id
        WHERE f.reversal_status = 4200 AND f.amt_matched <> m.amt_match_rows""",
    "match_reconcile_recovery": """
        SELECT f.flow_id, f.contract_id, f.amt_matched, m.amt_match_rows FROM fx_flow f
        JOIN (SELECT flow_id, CAST(sum(amt_matched) AS DECIMAL(38,2)) AS amt_match_rows FROM st_live
              WHERE bank_flow_id IN (SELECT bank_flow_id FROM fx_bank_flow WHERE is_deleted = 0) AND flow_id <> recovery_flow_id
              GROUP BY flow_id) m ON m.flow_id = f.flow_id
        WHERE f.reversal_status <> 4200 AND f.amt_matched <> m.amt_match_rows""",
    "match_recompute": """
        SELECT f.flow_id, f.contract_id, f.amount, CAST(coalesce(m.a, 0) AS DECIMAL(18,2)) AS amt_matched,
               CAST(coalesce(m.p, 0) AS DECIMAL(18,2)) AS amt_matched_principal, CAST(coalesce(m.i, 0) AS DECIMAL(18,2)) AS amt_matched_interest,
               CAST(coalesce(m.t, 0) AS DECIMAL(18,2)) AS amt_matched_tax,
               CASE WHEN f.amount = coalesce(m.a, 0) THEN 2101 ELSE 2100 END AS status
        FROM fx_flow f LEFT JOIN (SELECT flow_id, sum(amt_matched) AS a, sum(amt_matched_principal) AS p, sum(amt_matched_interest) AS i,
                                         sum(amt_matched_tax) AS t FROM st_live GROUP BY flow_id) m ON m.flow_id = f.flow_id
        WHERE f.is_cash = 1 AND f.reversal_status = 4200""",
    "match_soft_delete": """
        SELECT m.* REPLACE (CASE WHEN m.is_deleted = 0 AND (f.exclude_from_account_bal <> 0 OR m.flow_id <> m.recovery_flow_id) THEN 1 ELSE m.is_deleted END AS is_deleted)
        FROM fx_match m JOIN fx_flow f ON f.flow_id = m.flow_id""",
    "match_unallocate": """
        SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN 1 ELSE is_deleted END AS is_deleted,
               CASE WHEN hit THEN DATE '2002-01-01' ELSE unallocated_dt END AS unallocated_dt, CASE WHEN hit THEN 3 ELSE unallocated_user_id END AS unallocated_user_id)
        FROM (SELECT *, flow_id IN (SELECT flow_id FROM st_deposits) AS hit FROM fx_match)""",
    "flows_to_reallocate": """
        SELECT DISTINCT f.top + 2 + f.n + f.rn AS flow_id, f.calc_dt, f.amount, f.contract_id, b.cheque_no, b.bank_flow_id, b.batch_no
        FROM st_numbered f JOIN fx_match m ON m.flow_id = f.flow_id JOIN fx_bank_flow b ON b.bank_flow_id = m.bank_flow_id""",
    "unallocated_bank_flows": """
        SELECT DISTINCT b.contract_id, b.bank_flow_id, b.batch_no, a.account_no, b.cheque_no
        FROM fx_bank_flow b JOIN fx_party_account a ON a.party_account_id = b.party_account_id JOIN fx_match m ON m.bank_flow_id = b.bank_flow_id
        WHERE m.flow_id IN (SELECT flow_id FROM st_deposits)""",
    "code_remap": """
        SELECT * REPLACE (CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END AS o_orderpriority) FROM orders""",
    "code_remap_back": "SELECT * FROM orders",
    "code_remap_table": "SELECT * REPLACE (split_part(o_orderpriority, '-', 2) AS o_orderpriority) FROM orders",
    "state_reset": """
        SELECT contract_id, CASE WHEN hit THEN 12020 ELSE credit_state END AS credit_state, CASE WHEN hit THEN 6500 ELSE approval_status1 END AS approval_status1,
               CASE WHEN hit THEN 6500 ELSE approval_status2 END AS approval_status2, CASE WHEN hit THEN 0 ELSE approver1_id END AS approver1_id,
               CASE WHEN hit THEN 0 ELSE approver2_id END AS approver2_id
        FROM (SELECT *, contract_id IN (SELECT contract_id FROM st_reset) AS hit FROM fx_contract)""",
    "state_reset_events": "SELECT * FROM fx_event_queue WHERE event_queue_id NOT IN (SELECT event_queue_id FROM st_reset)",
    "save_status_reset": """
        SELECT contract_id, CASE WHEN contract_id IN (SELECT contract_id FROM st_deposits) THEN 2201 ELSE save_status END AS save_status FROM fx_contract""",
    "terminated_status_repair": """
        SELECT 'quote' AS entity, asset_hdr_quote_id AS id, quote_status AS old_status, 44040 AS new_status FROM st_term_quote
        UNION ALL
        SELECT DISTINCT 'asset', asset_hdr_id, asset_status, 43030 FROM st_term_quote t
        WHERE NOT EXISTS (SELECT 1 FROM fx_quote q WHERE q.asset_hdr_id = t.asset_hdr_id AND q.quote_status IN (44000, 44020)
                          AND q.asset_hdr_quote_id NOT IN (SELECT asset_hdr_quote_id FROM st_term_quote))""",
    "terminated_address_insert": """
        SELECT t.asset_hdr_id, t.contract_id, c.default_asset_address_id AS address_id, c.activated_dt AS effective_dt, 45101 AS asset_hdr_address_type
        FROM st_term_quote t JOIN fx_contract c ON c.contract_id = t.contract_id
        WHERE NOT EXISTS (SELECT 1 FROM fx_addr a WHERE a.asset_hdr_address_type = 45101 AND a.effective_dt = c.activated_dt AND a.asset_hdr_id = t.asset_hdr_id)""",
    "activated_status_repair": """
        SELECT 'quote' AS entity, asset_hdr_quote_id AS id, quote_status AS old_status, 44030 AS new_status FROM st_act_quote
        UNION ALL SELECT DISTINCT 'asset', asset_hdr_id, asset_status, 43030 FROM st_act_quote""",
    "status_classify": """
        SELECT 'quote' AS entity, asset_hdr_quote_id AS id, quote_status AS old_status, new_status FROM st_judged WHERE new_status <> quote_status
        UNION ALL
        SELECT 'asset', asset_hdr_id, asset_status, 43030 FROM st_activated_asset h WHERE asset_status IN (43040, 43050)
          AND NOT EXISTS (SELECT 1 FROM st_judged j WHERE j.asset_hdr_id = h.asset_hdr_id AND j.new_status = j.quote_status)
        UNION ALL
        SELECT 'asset', asset_hdr_id, asset_status, 43050 FROM st_activated_asset h WHERE asset_status = 43030
          AND EXISTS (SELECT 1 FROM st_judged j WHERE j.asset_hdr_id = h.asset_hdr_id AND j.new_status = 44020 AND j.has_asset)
        UNION ALL
        SELECT 'asset', asset_hdr_id, asset_status, 43040 FROM st_activated_asset h WHERE asset_status = 43030
          AND EXISTS (SELECT 1 FROM st_judged j WHERE j.asset_hdr_id = h.asset_hdr_id AND j.new_status = 44000 AND j.has_asset)
          AND NOT EXISTS (SELECT 1 FROM st_judged j WHERE j.asset_hdr_id = h.asset_hdr_id AND j.new_status = 44020 AND j.has_asset)""",
    "effective_address_insert": "SELECT * FROM st_address_change",
    "effective_address_rows": """
        SELECT (SELECT max(asset_hdr_address_id) FROM fx_addr) + row_number() OVER (ORDER BY asset_hdr_id, effective_dt, address_id) AS asset_hdr_address_id,
               asset_hdr_id, 45101 AS asset_hdr_address_type, effective_dt, address_id
        FROM st_address_change WHERE insert_asset_hdr_address = 1""",
    "current_address_update": """
        SELECT asset_hdr_id, current_contract_id, current_address_id, 'update_before' AS op FROM st_act_address
        UNION ALL SELECT asset_hdr_id, current_contract_id, address_id, 'update_after' FROM st_act_address""",
    "as_of_address": "SELECT * FROM st_as_of",
    "flow_address": """
        SELECT f.flow_id, f.asset_hdr_id, f.delivery_dt, a.address_id, a.effective_dt
        FROM (SELECT flow_id, asset_hdr_id, DATE '2024-01-01' + CAST(date_diff('day', DATE '1970-01-01', calc_dt) % 31 AS INT) AS delivery_dt FROM fx_flow) f
        ASOF LEFT JOIN (
            SELECT asset_hdr_id, effective_dt, arg_max(address_id, asset_hdr_address_id) AS address_id
            FROM fx_addr WHERE asset_hdr_address_type = 45101 GROUP BY ALL
        ) a ON f.asset_hdr_id = a.asset_hdr_id AND f.delivery_dt >= a.effective_dt""",
    "asset_address_view": """
        SELECT r.row_type, r.address_id, r.contract_id, r.asset_id, r.asset_hdr_id, r.name, concat_ws(', ', d.street, d.zip_code, d.city) AS full_address,
               t.name AS asset_type_name, p.name AS manufacturer, r.model, r.asset_type_id, r.asset_status, v.registration_no, r.asset_hdr_address_type
        FROM st_asset_rows r JOIN fx_asset_type t ON t.asset_type_id = r.asset_type_id JOIN fx_party p ON p.party_id = r.manufacturer_id
        JOIN fx_address d ON d.address_id = r.address_id LEFT JOIN fx_vehicle v ON v.asset_hdr_id = r.asset_hdr_id""",
    "hierarchy_descendants": "SELECT root_id, descendant_id, depth FROM st_up",
    "contracts_missing_assets": """
        SELECT contract_id, cparty_id, mature_dt, contract_state FROM fx_contract WHERE mature_dt > DATE '2002-01-01' AND contract_state = 11130
          AND contract_id IN (SELECT current_contract_id FROM fx_asset_hdr h WHERE NOT EXISTS (SELECT 1 FROM fx_asset a WHERE a.asset_hdr_id = h.asset_hdr_id)
                              UNION SELECT original_contract_id FROM fx_asset_hdr h WHERE NOT EXISTS (SELECT 1 FROM fx_asset a WHERE a.asset_hdr_id = h.asset_hdr_id))""",
    "latest_revision_rows": "SELECT * FROM st_latest_rows",
    "latest_revision_of_objects": "SELECT * FROM st_latest_rows WHERE obj_id % 5 = 0",
    "latest_revision_deleted":"SELECT * FROM fx_alteration WHERE contract_alteration_id NOT IN (SELECT contract_alteration_id FROM st_latest_rows)",
    "gl_entries": "SELECT * FROM st_gl",
    "gl_suspense": "SELECT * FROM st_gl WHERE account_name = 'System Suspense'",
    "gl_orphans": """
        SELECT * FROM fx_gl WHERE gl_interface_id = 0 AND post_dt < DATE '1998-01-01'
          AND flow_id NOT IN (SELECT flow_id FROM fx_flow UNION ALL SELECT flow_id FROM fx_flow_image)""",
    "gl_journal": "SELECT * FROM st_gl_journal",
    "gl_orphans_decoded": """
        SELECT * FROM st_gl_journal WHERE gl_interface_id = 0 AND post_dt < DATE '1998-01-01'
          AND flow_id NOT IN (SELECT flow_id FROM fx_flow UNION ALL SELECT flow_id FROM fx_flow_image)""",
    "duplicate_keys": "SELECT contract_id, link_no, count(*) AS n_rows FROM fx_custom_flow WHERE is_deleted = 0 GROUP BY contract_id, link_no HAVING count(*) > 1",
    "duplicate_write_offs": "SELECT * FROM st_dup_writeoff",
    "writeoff_by_party": """
        SELECT p.party_no, p.name, CAST(sum(w.amount) AS DECIMAL(38,2)) AS total_amount, count(*) AS n_rows
        FROM fx_writeoff w JOIN fx_party_account a ON a.party_account_id = w.party_account_id JOIN fx_party p ON p.party_id = a.party_id
        GROUP BY p.party_no, p.name HAVING count(*) > 1""",
    "writeoff_duplicate_parties": """
        SELECT party_id, name FROM fx_party WHERE party_id IN (
          SELECT cparty_id FROM fx_contract WHERE contract_id IN (SELECT contract_id FROM st_dup_writeoff))""",
    "audit_decode": "SELECT * FROM st_audit",
    "audit_decode_filtered": "SELECT * FROM st_audit WHERE tbl_name = 'party' AND audit_dt >= TIMESTAMP '2024-01-05' AND audit_dt <= TIMESTAMP '2024-01-20'",
    "queue_by_state": "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type",
    "queue_backlog": """
        SELECT TIMESTAMP '2002-01-01' AS checked_at, count(*) AS backlog, min(ts) AS oldest, max(ts) AS newest FROM events WHERE event_type = 'error'""",
    "recent_activity": "SELECT event_id, user_id, event_type, ts FROM events WHERE event_type NOT ILIKE '%ERR%' ORDER BY event_id DESC LIMIT 20",
    "used_definitions": "SELECT * FROM fx_lookup WHERE lookupset_id IN (SELECT flow_type FROM fx_flow)",
    "invoice_lineage": """
        SELECT i.invoice_no, f.flow_id, f.contract_id, f.amount, t.tax_calc_flow_id, t.tax_type_id, t.amt_tax
        FROM fx_flow f JOIN fx_invoice i ON i.invoice_id = f.invoice_id LEFT JOIN fx_tax t ON t.flow_id = f.flow_id""",
    "invoice_origins": """
        SELECT DISTINCT f.flow_id, f.contract_id, f.calc_dt, f.invoice_id, i.invoice_no
        FROM fx_linked_flow f JOIN fx_invoice i ON i.invoice_id = f.invoice_id
        WHERE f.flow_id IN (SELECT flow_link_id FROM fx_linked_flow WHERE invoice_id IN (SELECT invoice_id FROM fx_invoice))""",
    "invoice_origins_reversed": """
        SELECT o.flow_id, o.contract_id, o.calc_dt, o.invoice_id, i.invoice_no FROM st_reversal_rows o JOIN fx_invoice i ON i.invoice_id = o.invoice_id
        WHERE o.role = 'original' AND o.flow_id IN (SELECT flow_link_id FROM st_reversal_rows WHERE role = 'reversal')""",
    "unreceived_custom_flows": """
        SELECT r.contract_id, r.po_row_cf_id, r.destination_csv, e.ext_reference FROM fx_po_row r
        JOIN fx_expected_row e ON e.contract_custom_flow_id = r.po_row_cf_id AND e.contract_id = r.contract_id
        JOIN fx_contract c ON c.contract_id = r.contract_id
        WHERE starts_with(e.ext_reference, 'PO_ROW_') AND r.num_assets_received = 0 AND c.product_style = 2000
          AND EXISTS (SELECT 1 FROM fx_asset_hdr h JOIN fx_contract k ON k.contract_id = h.current_contract_id
                      WHERE k.contract_state = 11140 AND ',' || replace(r.destination_csv, ' ', '') || ',' LIKE '%,' || CAST(h.asset_hdr_id AS VARCHAR) || ',%')""",
    "lookup_contracts_by_product": """
        SELECT c.contract_id, p.name AS product_name, c.contract_state FROM fx_contract c JOIN fx_product p ON p.product_style = c.product_style
        WHERE p.name = 'Operating Lease' AND c.contract_id > 0 AND c.contract_state = 11140""",
    "lookup_products_with_tax_pricing": "SELECT * FROM fx_product WHERE is_tax_based_pricing = 1 AND name = 'Operating Lease'",
    "lookup_flows_by_type": """
        SELECT f.contract_id, f.flow_id, f.expected_dt, f.amount, l.value AS flow_type_name FROM fx_lookup l JOIN fx_flow f ON f.flow_type = l.lookupset_id
        WHERE l.set_name = 'FlowType' AND l.value = 'Security Deposit'""",
    "lookup_flows_by_method": """
        SELECT f.contract_id, f.flow_id, f.expected_dt, f.amount, l.value AS flow_method_name FROM fx_lookup l JOIN fx_flow f ON f.flow_method_id = l.lookupset_id
        WHERE l.set_name = 'FlowMethod' AND l.value = 'Direct Debit'""",
    "lookup_suspense_accounts": "SELECT * FROM fx_gl_account WHERE name ILIKE '%suspense%'",
    "lookup_programs_and_units": """
        SELECT p.party_id, p.name AS unit_name, p.program_id, g.program_name FROM fx_party p JOIN fx_program g ON g.program_id = p.program_id
        WHERE p.is_business_unit = 1""",
    "lookup_bank_flow_pairs": """
        SELECT f.contract_id, f.flow_id, b.bank_flow_id, b.cheque_no, f.amount, m.amt_matched AS amt_paid
        FROM fx_flow f JOIN fx_match m ON m.flow_id = f.flow_id JOIN fx_bank_flow b ON b.bank_flow_id = m.bank_flow_id AND b.contract_id = f.contract_id""",
    "mask_parties": """
        SELECT party_id, party_no, CASE WHEN hit THEN prefix || CAST(party_no AS VARCHAR) ELSE name END AS name,
               CASE WHEN hit THEN replace(prefix, 'BR_', 'B_') || CAST(party_no AS VARCHAR) ELSE ext_name END AS ext_name, gross_income, program_id,
               party_type, is_business_unit, is_branch, CASE WHEN hit THEN 'John' ELSE first_names END AS first_names,
               CASE WHEN hit THEN 'Peter' ELSE middle_name END AS middle_name, CASE WHEN hit THEN DATE '1900-01-01' ELSE date_of_birth END AS date_of_birth,
               CASE WHEN hit THEN '+31(99)1234567' ELSE phone_business END AS phone_business,
               CASE WHEN hit THEN 'everyone@internet.com' ELSE email_business END AS email_business,
               CASE WHEN hit THEN 'XX000000000' || CAST(party_no AS VARCHAR) ELSE tax_no END AS tax_no
        FROM st_masked""",
    "mask_coverage": """
        SELECT category, count(*) AS n_parties, count(*) FILTER (WHERE hit) AS n_to_mask,
               CAST(coalesce(sum(CASE WHEN date_of_birth = DATE '1900-01-01' THEN 1 ELSE 0 END) FILTER (WHERE hit), 0) AS BIGINT) AS n_unmasked,
               CAST(8 * count(*) FILTER (WHERE NOT hit) AS BIGINT) AS n_exempt_values
        FROM st_masked WHERE party_id > 0 GROUP BY category""",
    "mask_accounts": "SELECT * REPLACE (CASE WHEN party_account_id > 0 THEN 'PartyAcc ' || CAST(party_account_id AS VARCHAR) ELSE name END AS name) FROM fx_party_account",
    "mask_addresses": "SELECT * REPLACE ('Sesame street ' || CAST(address_id AS VARCHAR) AS street, 'E14 5HQ' AS zip_code) FROM fx_address",
    "mask_users": "SELECT * REPLACE (CASE WHEN external_user_type IN (16801, 16803) THEN 'everyone@internet.com' ELSE email END AS email) FROM fx_user",
    "mask_employment": "SELECT c_custkey AS party_id, CAST(0 AS DOUBLE) AS gross_income, CAST(0 AS BIGINT) AS employee_id, 'Head Chef' AS job_title FROM customer",
    "mask_bank_flows": """
        SELECT bank_flow_id, cheque_no, 'Party' || CAST(bank_flow_id AS VARCHAR) AS party_name, 'Bank' || CAST(bank_flow_id AS VARCHAR) AS party_bank_name,
               'BankAccName' || CAST(bank_flow_id AS VARCHAR) AS party_bank_account_name, 'BankAccNo' || CAST(bank_flow_id AS VARCHAR) AS party_bank_account_no,
               'PartyAccName' || CAST(bank_flow_id AS VARCHAR) AS party_account_name FROM fx_bank_flow""",
    "mask_bank_accounts": """
        SELECT s_suppkey AS bankacc_id, CASE WHEN s_suppkey > 0 THEN 'Bank' ELSE s_name END AS name, CASE WHEN s_suppkey > 0 THEN 'Bank' ELSE s_name END AS ext_name,
               CASE WHEN s_suppkey > 0 THEN '0123456789' ELSE CAST(s_suppkey AS VARCHAR) END AS code, CASE WHEN s_suppkey > 0 THEN '123456' ELSE 'branch' END AS branch_code,
               CASE WHEN s_suppkey > 0 THEN 'Street1' ELSE 'street' END AS branch_address FROM supplier""",
    "mask_duplicate_buckets": """
        SELECT c_custkey AS bucket_id, c_mktsegment || CAST(c_nationkey AS VARCHAR) AS word, c_mktsegment AS soundex_value, CAST(c_nationkey AS VARCHAR) AS bucket_value FROM customer""",
    "mask_party_addresses": """
        SELECT c_custkey AS party_address_id, c_custkey AS party_id, CASE WHEN c_custkey > 0 THEN 'Sesame Street ' || CAST(c_custkey AS VARCHAR) ELSE c_name END AS street,
               CASE WHEN c_custkey > 0 THEN 'E14 5HQ' ELSE CAST(c_nationkey AS VARCHAR) END AS zip_code FROM customer""",
    "mask_mail_lists": """
        SELECT c_custkey AS doc_list_id, CAST(50700 + c_nationkey AS INT) AS list_type,
               CASE WHEN c_acctbal < 0 THEN '' WHEN c_nationkey IN (1, 2, 3, 4, 5, 6, 10) THEN 'everyone@internet.com' ELSE c_name END AS list_value FROM customer""",
    "scrub_history": """
        SELECT * REPLACE (CASE WHEN audit_hdr_id IN (SELECT audit_hdr_id FROM st_personal) THEN '' ELSE old_fld_value END AS old_fld_value,
                          CASE WHEN audit_hdr_id IN (SELECT audit_hdr_id FROM st_personal) THEN '' ELSE new_fld_value END AS new_fld_value), 'key' AS source FROM fx_audit_key
        UNION ALL
        SELECT * REPLACE (CASE WHEN audit_hdr_id IN (SELECT audit_hdr_id FROM st_personal) THEN '' ELSE old_fld_value END AS old_fld_value,
                          CASE WHEN audit_hdr_id IN (SELECT audit_hdr_id FROM st_personal) THEN '' ELSE new_fld_value END AS new_fld_value), 'field' FROM fx_audit_fld""",
    "scrub_notes": "SELECT * REPLACE (CASE WHEN subject ILIKE '%src1%' THEN '' ELSE comments END AS comments) FROM fx_note",
    "retention_purge": _retention_report(),
    "retention_by_month": f"""
        SELECT 'event_log' AS table_name, event_log_id AS id FROM rt_event_log WHERE NOT coalesce(input_dt < {CUT}, false)
        UNION ALL SELECT 'asset_balance', asset_balance_id FROM rt_asset_balance WHERE NOT coalesce(input_dt < {CUT} AND effective_dt < {CUT}, false)
        UNION ALL SELECT 'workflow_task_todo', todo_id FROM rt_workflow_task_todo WHERE NOT coalesce(completion_date < {CUT}, false)
        UNION ALL SELECT 'aii_event_queue_history', history_id FROM rt_aii_event_queue_history WHERE NOT coalesce(end_dt < {CUT}, false)
        UNION ALL SELECT 'aii_event_queue_response', response_id FROM rt_aii_event_queue_response
        WHERE history_id NOT IN (SELECT history_id FROM rt_aii_event_queue_history WHERE end_dt < {CUT})""",
    "audit_of_versions": _changed_fields(),
    "audit_rows_back": "SELECT *, 1 AS version FROM customer UNION ALL SELECT *, 2 FROM st_customer2",
    "retention_kept": f"SELECT * FROM rt_contract_write_off WHERE NOT ({' OR '.join(f'({c})' for c in RETENTION['contract_write_off'].values())})",
    "upsert_update_only": """
        SELECT c.* REPLACE (CASE WHEN s.s_suppkey IS NULL THEN c.c_name WHEN s.s_acctbal < 0 THEN NULL ELSE s.s_name END AS c_name,
                            CASE WHEN s.s_suppkey IS NULL THEN c.c_acctbal ELSE s.s_acctbal END AS c_acctbal)
        FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey""",
    "copy_distinct": """
        SELECT s_name AS login, s_name AS code, 1 AS company_id, s_nationkey AS person_id FROM supplier
        UNION ALL SELECT DISTINCT c_mktsegment, c_mktsegment, 4, c_nationkey FROM customer""",
    "changeset_apply": """
        SELECT flow_id, CASE WHEN hit THEN 0 ELSE amt_matched END AS amt_matched, CASE WHEN hit THEN 0 ELSE amt_matched_principal END AS amt_matched_principal,
               CASE WHEN hit THEN 0 ELSE amt_matched_interest END AS amt_matched_interest, CASE WHEN hit THEN 0 ELSE amt_matched_tax END AS amt_matched_tax,
               CASE WHEN hit THEN 0 ELSE amt_matched_netted END AS amt_matched_netted
        FROM (SELECT *, flow_id IN (SELECT flow_id FROM st_unmatched) AS hit FROM fx_flow)""",
    "changeset_apply_revert": "SELECT * FROM fx_flow",
    "changeset_revert_edited": """
        SELECT flow_id, CASE WHEN edited THEN 2101 ELSE status END AS status, CASE WHEN edited THEN 99 ELSE amt_matched END AS amt_matched,
               amt_matched_principal, amt_matched_interest, amt_matched_tax, amt_matched_netted
        FROM (SELECT *, flow_id % 3 = 0 AND zero AS edited FROM (
            SELECT *, amt_matched = 0 OR flow_id IN (SELECT flow_id FROM st_unmatched) AS zero FROM fx_flow))
        WHERE edited OR NOT (flow_id % 7 = 1 AND zero)""",
    "changeset_conflicts": """
        SELECT flow_id, CASE WHEN flow_id % 3 = 0 THEN 'amt_matched' ELSE '(row deleted)' END AS column_name,
               CASE WHEN flow_id % 3 = 0 THEN CAST(amt_matched AS VARCHAR) END AS before, CASE WHEN flow_id % 3 = 0 THEN '0.00' END AS after,
               CASE WHEN flow_id % 3 = 0 THEN '99.00' END AS now
        FROM st_unmatched WHERE flow_id % 3 = 0 OR flow_id % 7 = 1""",
    "backup_rotation": "SELECT contract_id, credit_state, approver1_id, TIMESTAMP '2002-01-02 10:00:00' AS save_dt FROM fx_contract",
    "allocate_keys": """
        SELECT (SELECT max(flow_id) FROM fx_flow) + 1 + row_number() OVER (ORDER BY flow_id) AS new_id, flow_id AS old_id, contract_id
        FROM fx_flow WHERE flow_type = 1014""",
    "next_numbers": """
        SELECT 'flow' AS table_name, max(flow_id) + 1 AS next_no FROM fx_flow UNION ALL SELECT 'contract', max(contract_id) + 1 FROM fx_contract
        UNION ALL SELECT 'party', max(party_id) + 1 FROM fx_party""",
    "insert_values": """
        SELECT event_queue_id, event_type, event_state_before FROM fx_event_queue UNION ALL SELECT 0, 24903, 12020""",
    "audit_truncated": """
        SELECT 'audit_hdr' AS table_name, 0::BIGINT AS n_rows UNION ALL SELECT 'audit_key', 0 UNION ALL SELECT 'audit_fld', 0
        UNION ALL SELECT 'note', count(*) FROM fx_note""",
    "parsed_dates": """
        SELECT o_orderkey, strftime(o_orderdate, '%d-%b-%Y') AS date_text, CAST(o_orderdate AS DATE) AS order_dt,
               strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.000' AS time_text FROM orders""",
    "export_inserts": """
        SELECT 'INSERT customer(c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment) VALUES(' ||
               concat_ws(',', coalesce('''' || CAST(c_custkey AS VARCHAR) || '''', 'NULL'), coalesce('''' || replace(c_name, '''', '''''') || '''', 'NULL'),
                         coalesce('''' || CAST(c_nationkey AS VARCHAR) || '''', 'NULL'), coalesce('''' || CAST(c_acctbal AS VARCHAR) || '''', 'NULL'),
                         coalesce('''' || replace(c_mktsegment, '''', '''''') || '''', 'NULL')) || ')' AS statement
        FROM customer""",
    "backfill_child_rows": """
        SELECT party_id, 74 AS party_cfd_id, CAST(party_id AS VARCHAR) AS field_value, 0 AS seq_no, 0 AS stamp FROM fx_party
        WHERE party_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
    "time_normalise": """
        SELECT event_id, CAST(ts AS DATE) AS date_only, date_trunc('day', ts) AS day_start, ts + INTERVAL 1 HOUR AS plus_hour, ts + INTERVAL 2 DAY AS plus_two_days,
               date_diff('hour', ts, ts + INTERVAL 95 MINUTE) AS hour_boundaries, date_diff('day', ts, ts + INTERVAL 95 MINUTE) AS day_boundaries,
               strftime(ts, '%Y%m%d') AS compact_date, strftime(ts, '%a %d-%b-%Y %H:%M:%S') AS long_text, zone,
               ts + to_hours(h) AS local_time, date_trunc('day', ts + to_hours(h)) - to_hours(h) AS local_day_start_utc
        FROM (SELECT *, CASE event_type WHEN 'click' THEN 'Australia/Sydney' WHEN 'view' THEN 'America/New_York' ELSE 'Europe/Berlin' END AS zone,
                     CASE event_type WHEN 'click' THEN 11 WHEN 'view' THEN -5 ELSE 1 END AS h FROM events)""",
    "utc_or_local": """
        SELECT column_name, offset_hours, n_rows, n_total, CASE WHEN offset_hours = 0 THEN 'UTC' ELSE 'local' END AS clock
        FROM (SELECT column_name, offset_hours, count(*) AS n_rows, CAST(sum(count(*)) OVER (PARTITION BY column_name) AS BIGINT) AS n_total
              FROM (SELECT 'received' AS column_name, date_diff('hour', ts, ts + INTERVAL 30 SECOND) AS offset_hours FROM events
                    UNION ALL SELECT 'sent', date_diff('hour', ts, ts + INTERVAL 11 HOUR) FROM events)
              GROUP BY column_name, offset_hours)
        QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, offset_hours) = 1""",
    "utc_or_local_latest": """
        SELECT TIMESTAMP '2024-01-31 23:00:00' AS local_clock, TIMESTAMP '2024-01-31 12:00:00' AS utc_clock, ts FROM events ORDER BY event_id DESC LIMIT 1""",
    "profile_columns": _profile(),
    "table_row_counts": _counts(),
    "find_references": "SELECT DISTINCT source FROM documents WHERE contains(lower(text), 'license')",
    "group_summary": """
        SELECT flow_type, reversal_status,
               CAST(((2 * CAST(sum(amount) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*))) / 1000000.0 AS DECIMAL(18,6)) AS avg_value,
               count(*) AS n_rows, arg_min(amount, flow_id) AS first_value, arg_max(amount, flow_id) AS last_value, max(amount) AS max_value,
               min(amount) AS min_value, CAST(sum(amount) AS DECIMAL(38,2)) AS sum_value
        FROM fx_flow GROUP BY flow_type, reversal_status""",
}

ORACLES = {name: _in_order(query) for name, query in QUERIES.items()}
