"""Every job bound to the derived frames, by query name."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger import codes
from sparkledger.functions.scalar import add_units, format_millis, parse_date, to_local
from sparkledger.operators import audit, deltas, export, keys, masking, partitions, retention, updates
from sparkledger.plans import clock, discovery, hygiene, ledger, listing, profiles, repair, status
from sparkledger.session import configure, new_folder, snapshot
from sparkledger.sources.fixtures import Fixtures
from sparkledger.sources.tables import TABLES, append_rows

# Business clock of the runs; no job reads the machine's clock.
RUN_DATE = "2002-01-01"
RETENTION_DATE, RETENTION_DAYS = "1999-01-15", 365
ADDRESS_DATE = "2024-01-15"
POSTED_BEFORE = "1998-01-01"
PRIORITY_CODES = {"1-URGENT": "URGENT", "2-HIGH": "HIGH"}
PASSPORT_FIELD = 74


# Ledger repair -----------------------------------------------------------------------------------

def _deposit_reversal(fx: Fixtures) -> ledger.Reversal:
    flow = fx.flow()
    return ledger.reverse_flows(flow, ledger.current_deposits_without_tax(flow, fx.tax(), only_invoiced=True), RUN_DATE)


def flow_reversal(fx):
    return _deposit_reversal(fx).rows()


def flow_reversal_keys(fx):
    return _deposit_reversal(fx).key_map


def _invalid_lines(fx: Fixtures) -> DataFrame:
    return ledger.invalid_tax_lines(fx.flow(), fx.tax(), fx.custom_flow(), fx.asset_tree(), fx.asset())


def invalid_tax_lines(fx):
    return _invalid_lines(fx)


def invalid_tax_lines_removed(fx):
    removable = ledger.deletable_tax_lines(_invalid_lines(fx), fx.flow())
    return updates.delete_for_keys(fx.tax(), removable, ["tax_calc_flow_id"])


def _tax_reversal(fx: Fixtures):
    flow, invalid = fx.flow(), _invalid_lines(fx)
    return ledger.reverse_flows(flow, ledger.invoiced(ledger.flows_of_lines(flow, invalid)), RUN_DATE), invalid


def flow_reversal_tax(fx):
    reversal, invalid = _tax_reversal(fx)
    return ledger.reversal_tax_lines(reversal.key_map, fx.tax(), invalid)


def _tax_posting(fx: Fixtures):
    flow, invalid = fx.flow(), _invalid_lines(fx)
    affected = ledger.invoiced(ledger.flows_of_lines(flow, invalid))
    return ledger.post_reversal(flow, fx.tax(), fx.tax_flow(), fx.match(), affected, RUN_DATE, invalid)


def posting_tax_flows(fx):
    """Tax summary rows of the reversals and replacements, with their keys."""
    return _tax_posting(fx).changes["tax_flow"].inserts


def posting_tables(fx):
    """Rows and amounts of the four tables after a reversal was posted to all of them."""
    tables = {"flow": fx.flow(), "tax_calc_flow": fx.tax(), "tax_flow": fx.tax_flow(), "bank_flow_match": fx.match()}
    posted = _tax_posting(fx).apply(tables)
    amounts = {"flow": "amount", "tax_calc_flow": "amt_tax", "tax_flow": "amt_matched", "bank_flow_match": "is_deleted"}
    sums = [
        posted[name].agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(column).cast("decimal(18,2)")).alias("total")).select(F.lit(name).alias("table_name"), "n_rows", "total")
        for name, column in amounts.items()
    ]
    return functools.reduce(DataFrame.unionByName, sums)


def _repair(fx: Fixtures):
    """The repair over tables in which pending flows without invoice have no match, so that some lines can just be deleted."""
    flow = updates.set_where(fx.flow(), F.expr("invoice_id = 0 AND status = 2100"), dict.fromkeys(ledger.MATCHED, 0))
    tables = {
        "flow": flow, "tax_calc_flow": fx.tax(), "tax_flow": fx.tax_flow(), "bank_flow_match": fx.match(), "contract": fx.contract(),
        "flow_tax_sum": deltas.sums(fx.tax(), repair.SUM_KEYS, repair.SUM_MEASURES),
    }
    return repair.repair_tax(tables, _invalid_lines(fx), RUN_DATE), tables


def tax_repair_flows(fx):
    """Flow rows of the whole repair: reversed, reversals, replacements, and open flows that lost tax lines."""
    run, _ = _repair(fx)
    columns = ["flow_id", "contract_id", "flow_link_id", "image_no", "status", "reversal_status", "amount", *repair.GROSS, "amt_matched"]
    return run.posting.changes["flow"].rows().where("op <> 'update_before'").select(*columns)


def tax_repair_sums(fx):
    """Stored tax per flow, moved by the lines that the repair deletes and adds."""
    run, tables = _repair(fx)
    return run.posting.changes["flow_tax_sum"].apply(tables["flow_tax_sum"])


def tax_repair_checks(fx):
    """Rows of the repair's own checks; no flow of its contracts may be left with another gross than amount plus tax."""
    run, tables = _repair(fx)
    return run.checks(tables, fx.invoice(), fx.bank_flow(), fx.party_account())


def release_unmatched_tax(fx):
    return ledger.post_release(_unmatched(fx), fx.tax_flow()).changes["tax_flow"].rows()


def tax_rollup(fx):
    return ledger.tax_rollup(fx.tax())


def tax_rollup_gross(fx):
    return ledger.correct_gross(fx.flow(), fx.tax()).select("flow_id", "contract_id", "amount", "amt_gross", "amt_gross_netted")


def tax_reconcile(fx):
    return ledger.tax_mismatches(fx.flow(), fx.tax()).select("flow_id", "contract_id", "amount", "amt_gross", "total_tax")


def tax_missing(fx):
    return ledger.current_deposits_without_tax(fx.flow(), fx.tax()).select("flow_id", "contract_id", "amount", "invoice_id")


def affected_invoice_tax(fx):
    return ledger.affected_invoice_tax(_invalid_lines(fx), fx.flow(), fx.invoice())


def _unmatched(fx: Fixtures) -> DataFrame:
    return ledger.unmatched_flows(fx.flow(), fx.match(), fx.contract())


def release_unmatched(fx):
    return ledger.release_flows(_unmatched(fx)).rows()


def release_unmatched_list(fx):
    return ledger.released_flow_list(_unmatched(fx), fx.lookup(), fx.party_account(), fx.party(), fx.invoice())


def match_reconcile(fx):
    return ledger.match_differences(fx.flow(), fx.match(), fx.bank_flow())


def match_reconcile_recovery(fx):
    return ledger.match_differences(fx.flow(), fx.match(), fx.bank_flow(), recovery=True)


def match_recompute(fx):
    return ledger.recompute_matched(fx.flow(), fx.match()).select(
        "flow_id", "contract_id", "amount", "amt_matched", "amt_matched_principal", "amt_matched_interest", "amt_matched_tax", "status"
    )


def match_soft_delete(fx):
    return ledger.delete_recovery_matches(fx.flow(), fx.match(), fx.bank_flow())


def match_unallocate(fx):
    flow = fx.flow()
    reversed_flows = ledger.current_deposits_without_tax(flow, fx.tax(), only_invoiced=True)
    return ledger.unallocate_matches(fx.match(), reversed_flows, RUN_DATE)


def flows_to_reallocate(fx):
    return ledger.flows_to_reallocate(_deposit_reversal(fx), fx.match(), fx.bank_flow())


def unallocated_bank_flows(fx):
    reversed_flows = ledger.current_deposits_without_tax(fx.flow(), fx.tax(), only_invoiced=True)
    return ledger.unallocated_bank_flows(reversed_flows, fx.match(), fx.bank_flow(), fx.party_account())


def code_remap(fx):
    return ledger.remap_codes(fx.table("orders"), "o_orderpriority", PRIORITY_CODES)


def code_remap_back(fx):
    orders = fx.table("orders")
    mapping = ledger.code_mapping(orders, ["o_orderkey"], "o_orderpriority", PRIORITY_CODES)
    changed = ledger.remap_codes(orders, "o_orderpriority", PRIORITY_CODES)
    return ledger.restore_codes(changed, mapping, ["o_orderkey"], "o_orderpriority")


def code_remap_table(fx):
    """Codes changed by a mapping that is a table itself."""
    orders = fx.table("orders")
    mapping = orders.select(F.col("o_orderpriority").alias("old_code"), F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("new_code")).distinct()
    rows = ledger.mapped_codes(orders, ["o_orderkey"], "o_orderpriority", mapping)
    return ledger.apply_codes(orders, rows, ["o_orderkey"], "o_orderpriority")


def state_reset(fx):
    return ledger.reset_credit_state(fx.contract(), fx.event_queue())[0].select(
        "contract_id", "credit_state", "approval_status1", "approval_status2", "approver1_id", "approver2_id"
    )


def state_reset_events(fx):
    return ledger.reset_credit_state(fx.contract(), fx.event_queue())[1]


def save_status_reset(fx):
    affected = ledger.current_deposits_without_tax(fx.flow(), fx.tax(), only_invoiced=True)
    return ledger.reset_save_status(fx.contract(), affected).select("contract_id", "save_status")


# Status repair and effective dating --------------------------------------------------------------

def terminated_status_repair(fx):
    quote = fx.quote()
    return status.repair_terminated(status.quotes_on_terminated_assets(quote, fx.asset_hdr(), fx.asset()), quote)


def terminated_address_insert(fx):
    affected = status.quotes_on_terminated_assets(fx.quote(), fx.asset_hdr(), fx.asset())
    return status.terminated_addresses(affected, fx.contract(), fx.asset_address())


def activated_status_repair(fx):
    affected = status.quotes_on_activated_contracts(fx.contract(), fx.asset_hdr(), fx.quote(), fx.asset(), fx.event_queue())
    return status.repair_activated(affected)


def status_classify(fx):
    return status.classify_status(fx.quote(), fx.asset_hdr(), fx.asset(), fx.contract())


def effective_address_insert(fx):
    return status.address_changes(status.candidate_addresses(fx.asset_hdr(), fx.contract()), fx.asset_address())


def effective_address_rows(fx):
    changes = status.address_changes(status.candidate_addresses(fx.asset_hdr(), fx.contract()), fx.asset_address())
    return status.insert_addresses(fx.asset_address(), changes).inserts


def current_address_update(fx):
    """Assets of repaired quotes whose current address is written: the row before and after."""
    affected = status.quotes_on_activated_contracts(fx.contract(), fx.asset_hdr(), fx.quote(), fx.asset(), fx.event_queue())
    changes = status.address_changes(status.affected_addresses(affected, fx.contract()), fx.asset_address())
    return status.write_current_addresses(fx.asset_hdr(), changes).rows().select("asset_hdr_id", "current_contract_id", "current_address_id", "op")


def as_of_address(fx):
    return status.address_as_of(fx.asset_address(), ADDRESS_DATE)


def flow_address(fx):
    """Flows with the address of their asset on a day of their own, in the month of the addresses."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.unix_date("calc_dt"), F.lit(31)).cast("int"))
    flows = fx.flow().select("flow_id", "asset_hdr_id", day.alias("delivery_dt"))
    return status.addresses_at(flows, fx.asset_address(), "delivery_dt", range_days=7)


def asset_address_view(fx):
    return status.asset_address_view(
        fx.asset(), fx.asset_hdr(), fx.asset_address(), fx.asset_type(), fx.party(), fx.address(), fx.vehicle(), ADDRESS_DATE
    )


def hierarchy_descendants(fx):
    return status.hierarchy_descendants(fx.asset_tree())


def contracts_missing_assets(fx):
    return status.contracts_missing_assets(fx.contract(), fx.asset_hdr(), fx.asset(), RUN_DATE).select(
        "contract_id", "cparty_id", "mature_dt", "contract_state"
    )


def latest_revision_rows(fx):
    return status.latest_revision_rows(fx.alteration(), fx.restructure(), codes.BLOCKING_ALTERATIONS)


def latest_revision_deleted(fx):
    alteration = fx.alteration()
    blocking = status.latest_revision_rows(alteration, fx.restructure(), codes.BLOCKING_ALTERATIONS)
    return updates.delete_for_keys(alteration, blocking, ["contract_alteration_id"])


def latest_revision_of_objects(fx):
    """Only the alterations of one kind of object: those of the first type of event."""
    objects = fx.alteration().where("obj_id % 5 = 0").select("obj_id").distinct()
    return status.latest_revision_rows(fx.alteration(), fx.restructure(), codes.BLOCKING_ALTERATIONS, objects)


# Listings ----------------------------------------------------------------------------------------

def _gl_dimensions(fx: Fixtures):
    return fx.lookup(), fx.currency(), fx.ledger(), fx.gl_tag(), fx.gl_account()


def gl_entries(fx):
    return listing.gl_entries(fx.gl_entry(), *_gl_dimensions(fx))


def gl_suspense(fx):
    return listing.gl_entries(fx.gl_entry(), *_gl_dimensions(fx), account_name="system suspense").transform(keys.sorted_rows, ["amount", "gl_entry_id"])


def gl_orphans(fx):
    return listing.gl_orphans(fx.gl_entry(), fx.flow(), fx.flow_image(), POSTED_BEFORE)


def gl_journal(fx):
    return listing.gl_journal(fx.gl_journal(), *_gl_dimensions(fx))


def gl_orphans_decoded(fx):
    orphans = listing.gl_orphans(fx.gl_journal(), fx.flow(), fx.flow_image(), POSTED_BEFORE)
    return listing.gl_journal(orphans, *_gl_dimensions(fx))


def duplicate_keys(fx):
    return listing.duplicate_links(fx.custom_flow())


def duplicate_write_offs(fx):
    return listing.duplicate_write_offs(fx.write_off())


def writeoff_by_party(fx):
    return listing.write_offs_by_party(fx.write_off(), fx.party_account(), fx.party())


def writeoff_duplicate_parties(fx):
    return listing.parties_with_duplicates(fx.write_off(), fx.contract(), fx.party()).select("party_id", "name")


def audit_decode(fx):
    return listing.audit_decode(fx.audit_hdr(), fx.audit_key(), fx.audit_fld(), fx.user())


def audit_decode_filtered(fx):
    return listing.audit_decode(
        fx.audit_hdr(), fx.audit_key(), fx.audit_fld(), fx.user(), table="party", start="2024-01-05", end="2024-01-20"
    ).orderBy("audit_dt", "audit_hdr_id")


def queue_by_state(fx):
    return listing.queue_by_state(fx.table("events"), "event_type")


def queue_backlog(fx):
    return listing.queue_backlog(fx.table("events"), F.col("event_type") == "error", "ts", RUN_DATE)


def recent_activity(fx):
    return listing.recent_rows(fx.table("events"), "event_id", "event_type", "%ERR%", 20).select("event_id", "user_id", "event_type", "ts")


def used_definitions(fx):
    return listing.used_definitions(fx.lookup(), "lookupset_id", fx.flow(), "flow_type")


def invoice_lineage(fx):
    return listing.invoice_flows(fx.flow(), fx.tax(), fx.invoice())


def invoice_origins(fx):
    return listing.invoice_origins(fx.linked_flow(), fx.invoice())


def invoice_origins_reversed(fx):
    """Reversed flows that the credit notes of a reversal run link back to: lineage over the run's own rows."""
    posted = _deposit_reversal(fx).change_set().apply(fx.flow())
    credited = updates.set_where(posted, F.expr(f"reversal_status = {codes.REVERSAL}"), {"invoice_id": F.col("contract_id")})
    return listing.invoice_origins(credited, fx.invoice())


def unreceived_custom_flows(fx):
    return listing.unreceived_custom_flows(fx.po_row(), fx.expected_row(), fx.contract(), fx.asset_hdr())


def lookup_contracts_by_product(fx):
    return listing.contracts_by_product(fx.contract(), fx.product(), "Operating Lease", codes.CONTRACT_PART_TERMINATED)


def lookup_products_with_tax_pricing(fx):
    return listing.products_with_tax_pricing(fx.product(), "Operating Lease")


def lookup_flows_by_type(fx):
    return listing.flows_by_type(fx.flow(), fx.lookup(), "FlowType", "Security Deposit")


def lookup_flows_by_method(fx):
    return listing.flows_by_method(fx.flow(), fx.lookup(), "FlowMethod", "Direct Debit")


def lookup_suspense_accounts(fx):
    return listing.accounts_like(fx.gl_account(), "%suspense%")


def lookup_programs_and_units(fx):
    return listing.programs_and_units(fx.party(), fx.program())


def lookup_bank_flow_pairs(fx):
    return listing.bank_flow_pairs(fx.flow(), fx.match(), fx.bank_flow())


# Hygiene -----------------------------------------------------------------------------------------

def mask_parties(fx):
    return masking.mask_parties(fx.party())


def mask_coverage(fx):
    return masking.mask_coverage(fx.party())


def mask_accounts(fx):
    return masking.mask_party_accounts(fx.party_account())


def mask_addresses(fx):
    return masking.mask_addresses(fx.address())


def mask_users(fx):
    return masking.mask_users(fx.user())


def mask_employment(fx):
    info = fx.table("customer").selectExpr(
        "c_custkey AS party_id", "c_acctbal AS gross_income", "c_custkey AS employee_id", "c_mktsegment AS job_title"
    )
    return masking.mask_employment(info)


def mask_bank_flows(fx):
    rows = fx.bank_flow().selectExpr(
        "bank_flow_id", "cheque_no", "'p' AS party_name", "'b' AS party_bank_name", "'a' AS party_bank_account_name",
        "'n' AS party_bank_account_no", "'c' AS party_account_name",
    )
    return masking.mask_bank_flows(rows)


def mask_bank_accounts(fx):
    rows = fx.table("supplier").selectExpr(
        "s_suppkey AS bankacc_id", "s_name AS name", "s_name AS ext_name", "CAST(s_suppkey AS STRING) AS code",
        "'branch' AS branch_code", "'street' AS branch_address",
    )
    return masking.mask_bank_accounts(rows)


def mask_duplicate_buckets(fx):
    rows = fx.table("customer").selectExpr(
        "c_custkey AS bucket_id", "c_name AS word", "c_mktsegment AS soundex_value", "CAST(c_nationkey AS STRING) AS bucket_value"
    )
    return masking.mask_duplicate_buckets(rows)


def mask_party_addresses(fx):
    rows = fx.table("customer").selectExpr(
        "c_custkey AS party_address_id", "c_custkey AS party_id", "c_name AS street", "CAST(c_nationkey AS STRING) AS zip_code"
    )
    return masking.mask_party_addresses(rows)


def mask_mail_lists(fx):
    rows = fx.table("customer").selectExpr(
        "c_custkey AS doc_list_id", "CAST(50700 + c_nationkey AS INT) AS list_type",
        "CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS list_value",
    )
    return masking.mask_mail_lists(rows)


def scrub_history(fx):
    header = fx.audit_hdr()
    keys_ = masking.scrub_audit(fx.audit_key(), header).withColumn("source", F.lit("key"))
    return keys_.unionByName(masking.scrub_audit(fx.audit_fld(), header).withColumn("source", F.lit("field")))


def scrub_notes(fx):
    return masking.scrub_notes(fx.note(), "%src1%")


def retention_purge(fx):
    return retention.purge_report(fx.retention_tables(), hygiene.RETENTION_STEPS, RETENTION_DATE, RETENTION_DAYS)


def retention_kept(fx):
    """The write-offs that stay: reached by age, by note and by document."""
    return retention.purge(fx.retention_tables(), hygiene.RETENTION_STEPS, RETENTION_DATE, RETENTION_DAYS)["contract_write_off"]


# Tables that retention finds by their own dates alone, or by those of one parent.
DATED = {"event_log": ("input_dt",), "asset_balance": ("input_dt", "effective_dt"), "workflow_task_todo": ("completion_date",), "aii_event_queue_history": ("end_dt",)}


def retention_by_month(fx):
    """Rows that stay after tables stored by month lost their expired months, and children of one of them."""
    spark, tables = fx.spark, fx.retention_tables()
    folder, kept = new_folder(spark, "dated"), {}
    stores = {name: f"{folder}/{name}" for name in DATED}
    for name, dates in DATED.items():
        partitions.write_dated(tables[name], stores[name], dates)
    # Children first: they go by the parents that are still there.
    history = partitions.read_dated(spark, stores["aii_event_queue_history"], tables["aii_event_queue_history"].schema)
    gone = partitions.expired(history, DATED["aii_event_queue_history"], RETENTION_DATE, RETENTION_DAYS)
    kept["aii_event_queue_response"] = snapshot(updates.delete_for_keys(tables["aii_event_queue_response"], gone, ["history_id"]))
    for name, dates in DATED.items():
        partitions.drop_expired(spark, stores[name], tables[name].schema, dates, RETENTION_DATE, RETENTION_DAYS)
        kept[name] = partitions.read_dated(spark, stores[name], tables[name].schema)
    ids = {name: tables[name].columns[0] for name in kept}
    rows = [kept[name].select(F.lit(name).alias("table_name"), F.col(ids[name]).alias("id")) for name in sorted(kept)]
    return functools.reduce(DataFrame.unionByName, rows)


def _customer_versions(fx: Fixtures):
    """Three versions of the customers: rows leave, change and come in, and some that left come back under another name."""
    first = fx.table("customer")
    moved = F.expr("c_custkey % 5 = 1")
    second = updates.set_where(first.where("c_custkey % 7 <> 3"), moved, {"c_acctbal": None, "c_mktsegment": "MOVED"})
    second = second.unionByName(
        first.where("c_custkey % 11 = 0").withColumns({"c_custkey": F.expr("c_custkey + 1000000000L"), "c_acctbal": F.lit(None).cast(first.schema["c_acctbal"].dataType)})
    )
    third = updates.set_where(second.where("NOT (c_custkey > 1000000000 AND c_custkey % 2 = 0)"), F.expr("c_custkey % 2 = 0"), {"c_mktsegment": None})
    return first, second, third.unionByName(first.where("c_custkey % 14 = 3").withColumn("c_name", F.lit("back")))


def audit_of_versions(fx):
    """Audit rows from two versions of a table: header, key and each changed field."""
    first, second, _ = _customer_versions(fx)
    told = audit.audit_rows(first, second, ["c_custkey"], "customer", "2002-01-01 10:00:00", codes.SYSTEM_USER)
    keys_ = told.key.selectExpr("audit_hdr_id", "old_fld_value AS key_old", "new_fld_value AS key_new")
    return told.header.select("audit_hdr_id", "change_type").join(keys_, "audit_hdr_id").join(told.field, "audit_hdr_id")


def audit_rows_back(fx):
    """The first and second version of a table, taken back from the third by the audit rows of two runs."""
    first, second, third = _customer_versions(fx)
    pk = ["c_custkey"]
    one = audit.audit_rows(first, second, pk, "customer", "2002-01-01 10:00:00", codes.SYSTEM_USER)
    two = audit.audit_rows(second, third, pk, "customer", "2002-01-01 12:00:00", codes.SYSTEM_USER, keys.max_key(one.header, "audit_hdr_id"))
    both = one.union(two)
    times = {1: "2002-01-01 09:00:00", 2: "2002-01-01 11:00:00"}
    return functools.reduce(DataFrame.unionByName, [audit.rows_at(third, both, pk, "customer", at).withColumn("version", F.lit(n)) for n, at in times.items()])


def upsert_update_only(fx):
    source = fx.table("supplier").selectExpr(
        "s_suppkey AS c_custkey", "CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS c_name", "s_acctbal AS c_acctbal"
    )
    return hygiene.merge_matched(fx.table("customer"), source, ["c_custkey"], ["c_name", "c_acctbal"])


def copy_distinct(fx):
    target = fx.table("supplier").selectExpr("s_name AS login", "s_name AS code", "1 AS company_id", "s_nationkey AS person_id")
    columns = {"login": F.col("c_mktsegment"), "code": F.col("c_mktsegment"), "company_id": F.lit(4), "person_id": F.col("c_nationkey")}
    return hygiene.copy_distinct(fx.table("customer"), columns, target)


def changeset_apply(fx):
    return ledger.release_flows(_unmatched(fx)).apply(fx.flow(), read_twice=True).select("flow_id", *ledger.MATCHED)


def changeset_apply_revert(fx):
    """A reversal run applied to the flow table and taken back: the table as it was."""
    flow = fx.flow()
    change = _deposit_reversal(fx).change_set()
    return change.revert(change.apply(flow))


def _edited_release(fx):
    """A release of matched amounts, and the flow table after it and after later edits to some of the released flows."""
    change = ledger.release_flows(_unmatched(fx))
    changed = change.apply(fx.flow())
    later = F.expr("flow_id % 3 = 0 AND amt_matched = 0")
    edited = updates.set_where(changed, later, {"amt_matched": F.lit(99).cast("decimal(18,2)"), "status": 2101})
    return change, edited.where("NOT (flow_id % 7 = 1 AND amt_matched = 0)")


def changeset_revert_edited(fx):
    """A change taken back after later edits: untouched columns go back, later edits and deletes stay."""
    change, edited = _edited_release(fx)
    return change.revert(edited).select("flow_id", "status", *ledger.MATCHED)


def changeset_conflicts(fx):
    change, edited = _edited_release(fx)
    return change.conflicts(edited)


def backup_rotation(fx):
    folder = new_folder(fx.spark, "backup")
    contract = fx.contract().select("contract_id", "credit_state", "approver1_id")
    hygiene.rotate_backup(contract, folder, "contract_bk", "1", None, "2002-01-01 10:00:00")
    changed = updates.set_where(contract, F.col("credit_state") == codes.CREDIT_DECLINED, {"approver1_id": 0})
    archive = hygiene.rotate_backup(changed, folder, "contract_bk", "2", "1", "2002-01-02 10:00:00")
    hygiene.drop_archived(fx.spark, folder, "contract_bk", "1")
    return archive


def allocate_keys(fx):
    flow = fx.flow()
    deposits = snapshot(flow.where(f"flow_type = {codes.FLOW_DEPOSIT}").select("flow_id", "contract_id"))
    numbered, _ = keys.number_rows(deposits, ["flow_id"])
    first = keys.max_key(flow, "flow_id") + 1
    return numbered.select((F.lit(first) + F.col("row_no")).alias("new_id"), F.col("flow_id").alias("old_id"), "contract_id")


def next_numbers(fx):
    return keys.next_numbers({"flow": (fx.flow(), "flow_id"), "contract": (fx.contract(), "contract_id"), "party": (fx.party(), "party_id")})


def insert_values(fx):
    """The stored event queue after one row of values was inserted."""
    folder = new_folder(fx.spark, "event-queue")
    queue = fx.event_queue().select("event_queue_id", "event_type", "event_state_before")
    append_rows(queue, folder)
    row = fx.spark.range(1).select(*[F.lit(v).cast(queue.schema[c].dataType).alias(c) for c, v in (("event_queue_id", 0), ("event_type", 24903), ("event_state_before", 12020))])
    append_rows(row, folder)
    return fx.spark.read.schema(queue.schema).parquet(folder)


def audit_truncated(fx):
    """Rows of the audit tables after the history was emptied, next to those of a table that stays."""
    tables = {"audit_hdr": fx.audit_hdr(), "audit_key": fx.audit_key(), "audit_fld": fx.audit_fld(), "note": fx.note()}
    return discovery.table_row_counts(retention.empty_tables(tables, ["audit_hdr", "audit_key", "audit_fld"]))


def parsed_dates(fx):
    """Dates read back from their text, and as text with milliseconds."""
    rows = fx.table("orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MMM-yyyy").alias("date_text"))
    parsed = rows.withColumn("order_dt", parse_date("date_text"))
    return parsed.withColumn("time_text", format_millis(F.col("order_dt").cast("timestamp")))


def export_inserts(fx):
    return export.insert_statements(fx.table("customer"), "customer")


def backfill_child_rows(fx):
    child = fx.table("orders").selectExpr("o_custkey AS party_id", "CASE WHEN o_orderstatus = 'P' THEN 74 ELSE 73 END AS party_cfd_id")
    defaults = {"field_value": F.col("party_id").cast("string"), "seq_no": F.lit(0), "stamp": F.lit(0)}
    return hygiene.backfill_children(fx.party(), child, "party_id", "party_cfd_id", PASSPORT_FIELD, defaults)


# Time, discovery, profiling ----------------------------------------------------------------------

def time_normalise(fx):
    zone = F.expr(
        "CASE event_type WHEN 'click' THEN 'Australia/Sydney' WHEN 'view' THEN 'America/New_York' ELSE 'Europe/Berlin' END"
    )
    return clock.normalise_times(fx.table("events"), "event_id", F.col("ts"), zone)


def utc_or_local(fx):
    created = F.col("ts").cast("timestamp")
    rows = fx.table("events").select(
        created.alias("created"),
        add_units("SECOND", 30, created).alias("received"),
        to_local(created, F.lit("Australia/Sydney")).alias("sent"),
    )
    return clock.classify_time_columns(rows, "created", ["received", "sent"])


def utc_or_local_latest(fx):
    return clock.latest_times(fx.table("events"), "event_id", ["ts"], "2024-01-31 12:00:00", "Australia/Sydney")


def _all_tables(fx: Fixtures) -> dict[str, DataFrame]:
    return {name: fx.table(name) for name in TABLES}


def profile_columns(fx):
    return discovery.profile_columns(_all_tables(fx), "*key*")


def profile_sketches(fx):
    """Profiles of the key columns: that of the older half of each table is stored, the newer half is profiled alone, and both are merged.

    Distinct counts are estimates, so that no SQL gives them.
    """
    parts = []
    for name, df in _all_tables(fx).items():
        columns = [c for c in df.columns if "key" in c]
        if columns:
            newer = F.pmod(F.hash(*columns), F.lit(2)) == 1
            stored = snapshot(profiles.profile(df.where(~newer), columns))
            parts.append(profiles.report(name, profiles.merge(stored.unionByName(profiles.profile(df.where(newer), columns)))))
    return functools.reduce(DataFrame.unionByName, parts)


def table_row_counts(fx):
    return discovery.table_row_counts(_all_tables(fx))


def find_references(fx):
    return discovery.find_references(fx.table("documents"), "source", "text", "license")


def group_summary(fx):
    return listing.group_summary(fx.flow(), ["flow_type", "reversal_status"], "amount", "flow_id")


JOBS = (
    flow_reversal, flow_reversal_keys, flow_reversal_tax, posting_tax_flows, posting_tables, tax_repair_flows, tax_repair_sums, tax_repair_checks, release_unmatched_tax, invalid_tax_lines, invalid_tax_lines_removed, tax_rollup, tax_rollup_gross,
    tax_reconcile, tax_missing, affected_invoice_tax, release_unmatched, release_unmatched_list, match_reconcile,
    match_reconcile_recovery, match_recompute, match_soft_delete, match_unallocate, flows_to_reallocate,
    unallocated_bank_flows, code_remap, code_remap_back, code_remap_table, state_reset,
    state_reset_events, save_status_reset, terminated_status_repair, terminated_address_insert, activated_status_repair,
    status_classify, effective_address_insert, effective_address_rows, current_address_update, as_of_address, flow_address, asset_address_view, hierarchy_descendants, contracts_missing_assets,
    latest_revision_rows, latest_revision_deleted, latest_revision_of_objects, gl_entries, gl_suspense, gl_orphans, gl_journal, gl_orphans_decoded, duplicate_keys, duplicate_write_offs,
    writeoff_by_party, writeoff_duplicate_parties, audit_decode, audit_decode_filtered, queue_by_state, queue_backlog,
    recent_activity, used_definitions, invoice_lineage, invoice_origins, invoice_origins_reversed, unreceived_custom_flows, lookup_contracts_by_product,
    lookup_products_with_tax_pricing, lookup_flows_by_type, lookup_flows_by_method, lookup_suspense_accounts, lookup_programs_and_units, lookup_bank_flow_pairs, mask_parties,
    mask_coverage, mask_accounts, mask_addresses, mask_users, mask_employment, mask_bank_flows, mask_bank_accounts,
    mask_duplicate_buckets, mask_party_addresses, mask_mail_lists, scrub_history, scrub_notes, retention_purge, retention_kept, retention_by_month,
    audit_of_versions, audit_rows_back,
    upsert_update_only, copy_distinct, changeset_apply, changeset_apply_revert, changeset_revert_edited, changeset_conflicts, backup_rotation, allocate_keys, next_numbers,
    insert_values, audit_truncated, parsed_dates, export_inserts, backfill_child_rows, time_normalise, utc_or_local, utc_or_local_latest, profile_columns, table_row_counts, find_references,
    group_summary,
)


def _bind(job: Callable[[Fixtures], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(Fixtures(configure(spark), sf_dir))

    run.__name__ = job.__name__
    run.__doc__ = job.__doc__
    return run


QUERIES = {job.__name__: _bind(job) for job in JOBS}
# Queries whose results SQL cannot give exactly; tests hold them against exact counts.
ESTIMATES = {job.__name__: _bind(job) for job in (profile_sketches,)}
