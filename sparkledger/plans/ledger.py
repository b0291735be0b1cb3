"""Cash-flow repair: reversal and re-issue, tax lines, bank matches, code and state changes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sparkledger import codes
from sparkledger.functions.scalar import money, safe_ratio, total
from sparkledger.operators.changeset import ChangeSet
from sparkledger.operators.hierarchy import ancestor_pairs
from sparkledger.operators.joins import anti, flag_any, possible, semi, semi_few
from sparkledger.operators.keys import max_key, number_rows
from sparkledger.operators.posting import Posting
from sparkledger.operators.updates import delete_for_keys, set_for_keys, set_where, update_from
from sparkledger.session import snapshot

# Reversal and replacement rules, by column. They define the booking. Columns that a flow
# table does not have are skipped; columns without a rule are copied.
NEGATED = ("amount", "amt_principal", "amt_interest", "amt_gross", "amt_contingent_rental", "amt_gross_netted")
RESET_TO_ZERO = (
    "nett_no", "flow_method_id", "invoice_id", "bank_interface_run_id", "settlement_bank_info_id", "late_fee_upto",
    "is_overdue_interest_pending", "statement_id", "reserve_statement_id",
)
NO_DATE_COLUMNS = ("settled_dt", "last_overdue_interest_dt")
CHANGED_BY_REVERSAL = (
    "reversal_status", "amt_matched", "amt_matched_principal", "amt_matched_interest", "amt_matched_netted", "last_user_id",
)
MATCHED = ("amt_matched", "amt_matched_principal", "amt_matched_interest", "amt_matched_tax", "amt_matched_netted")


def live_matches(match: DataFrame) -> DataFrame:
    """Matches that count: neither deleted nor rejected."""
    return match.where("is_deleted = 0 AND is_rejected = 0")


# Reversal ----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Reversal:
    """The rows of a reversal run."""

    before: DataFrame  # affected flows as they were
    original: DataFrame  # affected flows, now reversed
    reversal: DataFrame  # negated flows
    replacement: DataFrame  # new current flows
    key_map: DataFrame  # flow_id, original_flow_id, contract_id, kind

    def rows(self) -> DataFrame:
        """All flow rows of the run with their role."""
        return (
            self.original.withColumn("role", F.lit("original"))
            .unionByName(self.reversal.withColumn("role", F.lit("reversal")))
            .unionByName(self.replacement.withColumn("role", F.lit("replacement")))
        )

    def change_set(self) -> ChangeSet:
        """The run as a change to the flow table."""
        changed = [c for c in CHANGED_BY_REVERSAL if c in self.original.columns]
        return ChangeSet(
            ["flow_id"],
            self.before,
            updates=self.original.select("flow_id", *changed),
            inserts=self.reversal.unionByName(self.replacement),
        )


def _project(rows: DataFrame, columns: list[str], rules: dict) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(*[(rules[c].cast(kinds[c]) if c in rules else F.col(c)).alias(c) for c in columns])


def reverse_flows(flow: DataFrame, affected: DataFrame, as_of: str) -> Reversal:
    """Reverse the affected flows and issue a current copy of each.

    New ids are (max + 1) + row number in the order of the old id; replacements number on after the
    reversals. The affected rows are written out and numbered once, and everything else derives from that
    without a further shuffle.
    """
    columns = flow.columns
    highest = max_key(flow, "flow_id")
    # Written once: numbering reads its input twice, to sample it and to sort it.
    before = snapshot(affected.select(*columns))
    numbered, n_affected = number_rows(before, ["flow_id"])
    today, no_date = F.lit(as_of).cast("date"), F.lit(codes.NO_DATE).cast("date")
    zero = F.lit(0)

    reversed_rules = {
        "reversal_status": F.lit(codes.REVERSED),
        "amt_matched": F.col("amt_gross"),
        "amt_matched_principal": F.col("amt_principal"),
        "amt_matched_interest": F.col("amt_interest"),
        "amt_matched_netted": F.col("amt_gross_netted"),
        "last_user_id": F.lit(codes.SYSTEM_USER),
    }
    common = {
        **{c: zero for c in RESET_TO_ZERO},
        **{c: no_date for c in NO_DATE_COLUMNS},
        "input_dt": F.lit(as_of).cast("timestamp"),
        "status": F.lit(codes.PENDING),
        "collection_state": F.lit(codes.COLLECTION_NONE),
        "last_user_id": F.lit(codes.SYSTEM_USER),
    }
    reversal_id = F.lit(highest + 1) + F.col("row_no")
    reversal_rules = {
        **common,
        **{c: -F.col(c) for c in NEGATED},
        "flow_id": reversal_id,
        "actual_dt": today,
        "reversal_status": F.lit(codes.REVERSAL),
        "flow_link_id": F.col("flow_id"),
        "amt_matched": -F.col("amt_gross"),
        "amt_matched_principal": -F.col("amt_principal"),
        "amt_matched_interest": -F.col("amt_interest"),
        "amt_matched_tax": -(F.col("amt_gross") - F.col("amount")),
        "amt_matched_netted": -F.col("amt_gross_netted"),
        "amt_invoice": -F.col("amt_gross"),
    }
    replacement_id = F.lit(highest + n_affected + 2) + F.col("row_no")
    replacement_rules = {
        **common,
        **{c: zero for c in MATCHED},
        "flow_id": replacement_id,
        "image_no": F.col("image_no") + 1,
        "reversal_status": F.lit(codes.CURRENT),
        "flow_link_id": zero,
        "amt_invoice": F.col("amt_gross"),
    }
    maps = [
        numbered.select(
            new_id.cast("bigint").alias("flow_id"), F.col("flow_id").alias("original_flow_id"), "contract_id", F.lit(kind).alias("kind")
        )
        for kind, new_id in (("reversal", reversal_id), ("replacement", replacement_id))
    ]
    return Reversal(
        before=before,
        original=_project(numbered, columns, reversed_rules),
        reversal=_project(numbered, columns, reversal_rules),
        replacement=_project(numbered, columns, replacement_rules),
        key_map=maps[0].unionByName(maps[1]),
    )


def reversal_tax_lines(key_map: DataFrame, tax: DataFrame, invalid: DataFrame | None = None) -> DataFrame:
    """Tax lines of the new flows: negated for reversals, copied for replacements.

    `invalid` lists tax lines that replacements must not take over.
    """
    new_ids = key_map.select(F.col("flow_id").alias("new_id"), F.col("original_flow_id").alias("flow_id"), "kind")
    lines = possible(tax, new_ids, ["flow_id"]).join(new_ids, "flow_id")
    if invalid is not None:
        marks = invalid.select("tax_calc_flow_id", F.lit(True).alias("_invalid"))
        lines = lines.join(marks, "tax_calc_flow_id", "left").where("kind = 'reversal' OR _invalid IS NULL")
    sign = lambda c: F.when(F.col("kind") == "reversal", -F.col(c)).otherwise(F.col(c)).cast(tax.schema[c].dataType).alias(c)
    return lines.select(
        F.col("new_id").alias("flow_id"), "asset_hdr_id", "contract_id", "tax_authority_id", "tax_type_id",
        sign("amount"), sign("amt_tax"), "rate", "kind",
    )


def reversal_tax_flows(reversal: Reversal, tax_flow: DataFrame, lines: DataFrame) -> DataFrame:
    """Tax summary rows of the new flows, with keys: negated for reversals, summed from the new tax lines for replacements.

    Of a reversal the financed amount is the negated matched one, and the other way round. `lines` are the tax lines of
    `reversal_tax_lines`. New keys continue after the greatest, in the order of flow, authority and type.
    """
    new_ids = reversal.key_map.where("kind = 'reversal'").select(F.col("flow_id").alias("_new"), F.col("original_flow_id").alias("flow_id"))
    negated = possible(tax_flow, new_ids, ["flow_id"]).join(new_ids, "flow_id").select(
        F.col("_new").alias("flow_id"), "contract_id", "tax_authority_id", "tax_type_hdr_id", (-F.col("amount")).alias("amount"),
        (-F.col("amt_matched")).alias("amt_financed"), (-F.col("amt_invoice")).alias("amt_invoice"), (-F.col("amt_financed")).alias("amt_matched"),
        "tax_rate", "image_no",
    )
    summed = tax_rollup(lines.where("kind = 'replacement'")).withColumn("image_no", F.lit(0))
    rows = negated.unionByName(summed.select(negated.columns))
    kinds = {f.name: f.dataType for f in tax_flow.schema.fields}
    rows = snapshot(rows.select(*[F.col(c).cast(kinds[c]).alias(c) for c in rows.columns]))
    numbered, _ = number_rows(rows, ["flow_id", "tax_authority_id", "tax_type_hdr_id"])
    return numbered.withColumn("tax_flow_id", F.lit(max_key(tax_flow, "tax_flow_id")) + F.col("row_no")).select(*tax_flow.columns)


def post_reversal(
    flow: DataFrame, tax: DataFrame, tax_flow: DataFrame, match: DataFrame, affected: DataFrame, as_of: str, invalid: DataFrame | None = None
) -> Posting:
    """A reversal of the affected flows over all four tables: flows, their tax lines and tax summaries, and their bank matches.

    Flow keys are allocated once and reach the children by the key map; new tax lines and summaries get keys of their
    own. Matches of reversed flows are flagged deleted. Nothing is written but snapshots.
    """
    return post_rows(reverse_flows(flow, affected, as_of), tax, tax_flow, match, as_of, invalid)


def post_rows(reversal: Reversal, tax: DataFrame, tax_flow: DataFrame, match: DataFrame, as_of: str, invalid: DataFrame | None = None) -> Posting:
    """A reversal whose flows are at hand as a posting over flows, tax lines, tax summaries and bank matches."""
    lines = snapshot(reversal_tax_lines(reversal.key_map, tax, invalid))
    numbered, _ = number_rows(lines, ["flow_id", "tax_authority_id", "tax_type_id", "asset_hdr_id"])
    new_lines = numbered.withColumn("tax_calc_flow_id", F.lit(max_key(tax, "tax_calc_flow_id")) + F.col("row_no")).select(*tax.columns)
    before = snapshot(semi_few(match, reversal.before, ["flow_id"]))
    after = before.select(
        "bank_flow_match_id", *[F.lit(v).cast(match.schema[c].dataType).alias(c) for c, v in (("is_deleted", 1), ("unallocated_user_id", codes.SYSTEM_USER))],
        F.lit(as_of).cast(match.schema["unallocated_dt"].dataType).alias("unallocated_dt"),
    )
    return Posting({
        "flow": reversal.change_set(),
        "tax_calc_flow": ChangeSet(["tax_calc_flow_id"], tax.where("1 = 0"), inserts=new_lines),
        "tax_flow": ChangeSet(["tax_flow_id"], tax_flow.where("1 = 0"), inserts=reversal_tax_flows(reversal, tax_flow, lines)),
        "bank_flow_match": ChangeSet(["bank_flow_match_id"], before, updates=after),
    })


def flows_of_lines(flow: DataFrame, lines: DataFrame) -> DataFrame:
    """The few flows that the tax lines are of, with all their columns, read once. A snapshot."""
    return snapshot(semi_few(flow, lines, ["flow_id"]))


def invoiced(flow: DataFrame) -> DataFrame:
    """Flows that can only be corrected by a reversal: settled, invoiced, on a statement or matched."""
    return flow.where(f"status = {codes.SETTLED} OR invoice_id <> 0 OR statement_id > 0 OR amt_matched <> 0")


# Tax lines ---------------------------------------------------------------------------------------

def current_deposits_without_tax(flow: DataFrame, tax: DataFrame, only_invoiced: bool = False) -> DataFrame:
    """Current security deposits that have no tax line."""
    deposits = flow.where(f"flow_type = {codes.FLOW_DEPOSIT} AND reversal_status = {codes.CURRENT}")
    if only_invoiced:
        deposits = deposits.where("invoice_id <> 0")
    return anti(deposits, tax, ["flow_id"])


def invalid_tax_lines(
    flow: DataFrame,
    tax: DataFrame,
    custom_flow: DataFrame,
    asset_hdr: DataFrame,
    asset: DataFrame,
    exempt_flows: DataFrame | None = None,
) -> DataFrame:
    """Tax lines on an asset that is neither the custom flow's destination nor below it.

    Only for current custom flows whose link number is unique in the contract and that also have a correct
    line, and only where the wrong asset belongs to the contract (itself, its owner or its owner's owner) or
    is asset 0. The result is a snapshot: it is what gets deleted, and what the later steps refer to.
    """
    # One aggregate both proves the link number unique and carries the only row's values along.
    keys = ["contract_id", "link_no", "custom_flow_hdr_id"]
    destinations = (
        custom_flow.where("is_active = 1 AND is_deleted = 0")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("destination_asset_hdr_id").alias("destination"),
            F.max("is_restructure").alias("is_restructure"),
        )
        .where("n = 1 AND is_restructure = 0")
        .select(*keys, "destination")
    )
    flows = flow.where(
        f"flow_type = {codes.FLOW_CUSTOM} AND reversal_status = {codes.CURRENT} AND custom_flow_hdr_id <> 0"
    ).select("flow_id", *keys)
    if exempt_flows is not None:
        flows = anti(flows, exempt_flows, ["flow_id"])
    # Stored, to drop the other flows' lines before the shuffle.
    targets = snapshot(flows.join(destinations, keys).select(
        "flow_id", F.col("contract_id").alias("flow_contract_id"), "destination"
    ))
    lines = possible(tax, targets, ["flow_id"]).join(targets, "flow_id")
    # The suspects are few: a snapshot keeps the joins above from running once per use.
    elsewhere = snapshot(lines.where("asset_hdr_id <> destination"))
    # Only the assets that occur on them have to be walked up.
    above = ancestor_pairs(asset_hdr, "asset_hdr_id", "owner_id", seeds=elsewhere.select("asset_hdr_id")).select(
        F.col("root_id").alias("destination"), F.col("descendant_id").alias("asset_hdr_id"), F.lit(True).alias("is_below")
    )
    judged = elsewhere.join(above, ["destination", "asset_hdr_id"], "left")
    wrong = snapshot(judged.where("is_below IS NULL").drop("is_below"))
    # A flow has a correct line either on the destination itself or below it.
    wrong_flows = wrong.select("flow_id", F.col("destination").alias("asset_hdr_id"))
    direct = semi(tax.select("flow_id", "asset_hdr_id"), wrong_flows, ["flow_id", "asset_hdr_id"])
    correct = direct.select("flow_id").unionByName(judged.where("is_below").select("flow_id"))

    owners = asset_hdr.select("asset_hdr_id", "owner_id", "parent_owner_id")
    placed = semi(wrong, correct, ["flow_id"]).join(owners, "asset_hdr_id").withColumn("_own", F.col("asset_hdr_id"))
    held = asset.select(F.col("contract_id").alias("flow_contract_id"), F.col("asset_hdr_id").alias("_asset"), F.lit(1).alias("one"))
    on_contract = flag_any(
        placed,
        ["tax_calc_flow_id"],
        ["_own", "owner_id", "parent_owner_id"],
        semi(held, wrong, ["flow_contract_id"]),
        "_asset",
        ["flow_contract_id"],
        "one",
        "found",
    )
    return snapshot(on_contract.where("found = 1 OR asset_hdr_id = 0").select(*tax.columns))


def deletable_tax_lines(invalid: DataFrame, flow: DataFrame) -> DataFrame:
    """Invalid lines that can simply be deleted, because their flow is not invoiced, settled or matched."""
    open_flows = flow.where(
        f"status <> {codes.SETTLED} AND invoice_id = 0 AND statement_id <= 0 AND amt_matched = 0"
    )
    return invalid.join(open_flows.select("flow_id"), "flow_id", "left_semi")


def tax_rollup(tax: DataFrame) -> DataFrame:
    """Tax per flow, authority and type, with the effective rate (NULL for amount 0)."""
    keys = ["amount", "contract_id", "flow_id", "tax_authority_id", "tax_type_id"]
    # A line to be stored, so it has the precision of stored amounts.
    summed = tax.groupBy(*keys).agg(money(total("amt_tax")).alias("amt_tax"))
    return summed.select(
        "flow_id", "contract_id", "tax_authority_id", F.col("tax_type_id").alias("tax_type_hdr_id"),
        F.col("amt_tax").alias("amount"), F.col("amt_tax").alias("amt_financed"), F.col("amt_tax").alias("amt_invoice"),
        F.col("amt_tax").alias("amt_matched"),
        safe_ratio(F.col("amt_tax"), F.col("amount"), 4).cast("decimal(18,4)").alias("tax_rate"),
    )


def tax_per_flow(tax: DataFrame) -> DataFrame:
    return tax.groupBy("flow_id").agg(total("amt_tax").alias("total_tax"))


def correct_gross(flow: DataFrame, tax: DataFrame) -> DataFrame:
    """Gross = amount + tax; a flow without tax lines has gross = amount."""
    gross = (F.col("amount") + F.coalesce("total_tax", F.lit(0))).cast("decimal(18,2)")
    joined = flow.join(tax_per_flow(tax), "flow_id", "left")
    return joined.withColumns({"amt_gross": gross, "amt_gross_netted": gross}).select(*flow.columns)


def tax_mismatches(flow: DataFrame, tax: DataFrame, exempt_flows: DataFrame | None = None) -> DataFrame:
    """Current flows whose gross minus amount is not the sum of their tax lines. Flows without lines do not show.

    `exempt_flows` lists flows that are known to differ and are left out.
    """
    current = flow.where(f"reversal_status = {codes.CURRENT}")
    if exempt_flows is not None:
        current = anti(current, exempt_flows, ["flow_id"])
    return current.join(tax_per_flow(tax), "flow_id").where(F.round(F.col("amt_gross") - F.col("amount"), 2) != F.col("total_tax"))


def affected_invoice_tax(invalid: DataFrame, flow: DataFrame, invoice: DataFrame) -> DataFrame:
    """Tax total of the affected lines per invoice number; several invoices may share a number."""
    per_invoice = (
        invalid.select("flow_id", "amt_tax")
        .join(flow.where("invoice_id <> 0").select("flow_id", "invoice_id"), "flow_id")
        .groupBy("invoice_id")
        .agg(total("amt_tax").alias("_tax"))
    )
    return per_invoice.join(invoice, "invoice_id").groupBy("invoice_no").agg(total("_tax").alias("correct_total_tax"))


# Bank matches ------------------------------------------------------------------------------------

def unmatched_flows(flow: DataFrame, match: DataFrame, contract: DataFrame, style: int = codes.STYLE_LOAN) -> DataFrame:
    """Current cash flows of one product style that claim a matched amount but have no live match.

    Flows are told by their keys first, so that only the rows that are left are shuffled with all their columns.
    """
    candidates = flow.where(
        f"reversal_status = {codes.CURRENT} AND flow_type <> {codes.FLOW_WRITE_OFF} AND amt_matched <> 0 "
        "AND contract_id > 0 AND is_cash = 1 AND nett_no = 0"
    )
    contracts = contract.where(F.col("product_style") == style).select("contract_id")
    # Whether a flow counts beyond its own row follows from these two columns; a flow without id has no match.
    keys = ["flow_id", "contract_id"]
    told = snapshot(semi_few(candidates.select(*keys), contracts, ["contract_id"]))
    unmatched = snapshot(anti(told, possible(live_matches(match), told, ["flow_id"]), ["flow_id"]))
    return semi_few(candidates, unmatched, keys, nulls_match=True)


def release_flows(affected: DataFrame) -> ChangeSet:
    """Set all matched amounts of the affected flows to zero. The affected rows are the snapshot."""
    before = snapshot(affected)
    zero = [F.lit(0).cast(before.schema[c].dataType).alias(c) for c in MATCHED]
    return ChangeSet(["flow_id"], before, updates=before.select("flow_id", *zero))


def release_tax(tax_flow: DataFrame, affected: DataFrame) -> ChangeSet:
    """Set the matched amount of the affected flows' tax summaries to zero."""
    before = snapshot(semi_few(tax_flow, affected, ["flow_id"]))
    return ChangeSet(["tax_flow_id"], before, updates=before.select("tax_flow_id", F.lit(0).cast(before.schema["amt_matched"].dataType).alias("amt_matched")))


def post_release(affected: DataFrame, tax_flow: DataFrame) -> Posting:
    """The release of flows with that of their tax summaries. The affected flows are found once."""
    flows = release_flows(affected)
    return Posting({"flow": flows, "tax_flow": release_tax(tax_flow, flows.before)})


def released_flow_list(affected: DataFrame, lookup: DataFrame, account: DataFrame, party: DataFrame, invoice: DataFrame) -> DataFrame:
    """The affected flows with decoded type, account, party and invoice."""
    kinds = lookup.select(F.col("lookupset_id").alias("flow_type"), F.col("value").alias("flow_type_name"))
    return (
        affected.join(kinds, "flow_type")
        .join(account.select("party_account_id", "account_no", "party_id"), "party_account_id")
        .join(party.select("party_id", "party_no"), "party_id")
        .join(invoice, "invoice_id")
        .select("contract_id", "flow_id", "calc_dt", "amount", "amt_gross", "flow_type_name", "account_no", "party_no", "invoice_no")
    )


def match_differences(flow: DataFrame, match: DataFrame, bank_flow: DataFrame, recovery: bool = False) -> DataFrame:
    """Flows whose stored matched amount differs from the sum of their live matches.

    The default looks at current flows; `recovery` at all others, leaving out recovery matches.
    """
    matches = live_matches(match).join(bank_flow.where("is_deleted = 0").select("bank_flow_id"), "bank_flow_id", "left_semi")
    state = F.col("reversal_status") == codes.CURRENT
    if recovery:
        matches = matches.where("flow_id <> recovery_flow_id")
        state = ~state
    sums = matches.groupBy("flow_id").agg(total("amt_matched").alias("amt_match_rows"))
    return (
        flow.where(state)
        .select("flow_id", "contract_id", "amt_matched")
        .join(sums, "flow_id")
        .where("amt_matched <> amt_match_rows")
    )


def recompute_matched(flow: DataFrame, match: DataFrame) -> DataFrame:
    """Current cash flows with matched amounts taken from their live matches, and the status that follows."""
    parts = ("amt_matched", "amt_matched_principal", "amt_matched_interest", "amt_matched_tax")
    sums = live_matches(match).groupBy("flow_id").agg(*[total(c).alias(f"_{c}") for c in parts])
    flows = flow.where(f"is_cash = 1 AND reversal_status = {codes.CURRENT}")
    updated = flows.join(sums, "flow_id", "left").withColumns(
        {c: F.coalesce(F.col(f"_{c}"), F.lit(0)).cast("decimal(18,2)") for c in parts}
    )
    # The status looks at the new matched amount.
    status = F.when(F.col("amount") == F.col("amt_matched"), codes.SETTLED).otherwise(codes.PENDING)
    return updated.withColumn("status", status).select(*flow.columns)


def delete_recovery_matches(flow: DataFrame, match: DataFrame, bank_flow: DataFrame) -> DataFrame:
    """All matches; those of flows in recovery and of promise-to-pay flows are flagged deleted.

    Flow and bank flow have one row per key, so they are joined to the matches directly.
    """
    joined = match.join(flow.select("flow_id", "exclude_from_account_bal"), "flow_id", "left").join(
        bank_flow.select("bank_flow_id", F.lit(True).alias("_paid")), "bank_flow_id", "left"
    )
    in_recovery = (F.col("exclude_from_account_bal") != 0) | (
        (F.col("exclude_from_account_bal") == 0) & (F.col("flow_id") != F.col("recovery_flow_id"))
    )
    return set_where(joined, F.col("_paid") & in_recovery, {"is_deleted": 1}).select(*match.columns)


def unallocate_matches(match: DataFrame, reversed_flows: DataFrame, as_of: str) -> DataFrame:
    """All matches; those of reversed flows are flagged deleted, with the day and the system user."""
    assignments = {
        "is_deleted": 1, "unallocated_dt": F.lit(as_of).cast("date"), "unallocated_user_id": codes.SYSTEM_USER
    }
    return set_for_keys(match, reversed_flows, ["flow_id"], assignments)


def flows_to_reallocate(reversal: Reversal, match: DataFrame, bank_flow: DataFrame) -> DataFrame:
    """New current flows whose originals had bank matches, with the bank flows to allocate to them again."""
    new_ids = reversal.key_map.where("kind = 'replacement'").select("flow_id", "original_flow_id")
    paid = match.select(F.col("flow_id").alias("original_flow_id"), "bank_flow_id").distinct()
    return (
        reversal.replacement.select("flow_id", "calc_dt", "amount", "contract_id")
        .join(new_ids, "flow_id")
        .join(paid, "original_flow_id")
        .join(bank_flow.select("bank_flow_id", "cheque_no", "batch_no"), "bank_flow_id")
        .select("flow_id", "calc_dt", "amount", "contract_id", "cheque_no", "bank_flow_id", "batch_no")
    )


def unallocated_bank_flows(reversed_flows: DataFrame, match: DataFrame, bank_flow: DataFrame, account: DataFrame) -> DataFrame:
    """Bank flows that lost a match to a reversal."""
    lost = semi(match.select("flow_id", "bank_flow_id"), reversed_flows, ["flow_id"])
    return (
        semi(bank_flow, lost, ["bank_flow_id"])
        .join(account.select("party_account_id", "account_no"), "party_account_id")
        .select("contract_id", "bank_flow_id", "batch_no", "account_no", "cheque_no")
    )


# Codes and states --------------------------------------------------------------------------------

def code_mapping(table: DataFrame, pk: list[str], code: str, mapping: dict[str, str]) -> DataFrame:
    """Rows to change as (pk, old_code, new_code): both the work list and the way back."""
    rule = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return table.where(F.col(code).isin(*mapping)).select(*pk, F.col(code).alias("old_code"), rule[F.col(code)].alias("new_code"))


def remap_codes(table: DataFrame, code: str, mapping: dict[str, str]) -> DataFrame:
    """The table with new codes: a projection, since the new code follows from the old one."""
    rule = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return table.withColumn(code, F.coalesce(F.try_element_at(rule, F.col(code)), F.col(code)))


def mapped_codes(table: DataFrame, pk: list[str], code: str, mapping: DataFrame) -> DataFrame:
    """Rows to change as (pk, old_code, new_code), by a mapping that is a table of old_code and new_code."""
    return table.select(*pk, F.col(code).alias("old_code")).join(mapping.select("old_code", "new_code"), "old_code").select(*pk, "old_code", "new_code")


def apply_codes(table: DataFrame, mapping_rows: DataFrame, pk: list[str], code: str) -> DataFrame:
    """The table with the new codes of the mapping's rows; `restore_codes` takes them back. Two new codes for a row fail the job."""
    return update_from(table, mapping_rows.select(*pk, F.col("new_code").alias(code)), pk)


def restore_codes(table: DataFrame, mapping_rows: DataFrame, pk: list[str], code: str) -> DataFrame:
    """Take a mapping back row by row: a row that had the new code all along keeps it."""
    return update_from(table, mapping_rows.select(*pk, F.col("old_code").alias(code)), pk)


def reset_credit_state(
    contract: DataFrame, event_queue: DataFrame, chosen: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Contracts that were pending or declined go back to pending; those transitions are dropped.

    Both approvers are cleared. `chosen` limits the run to some contracts.
    """
    events = event_queue.where(
        f"event_type = {codes.EVENT_CREDIT_STATE} AND event_state_before IN ({codes.CREDIT_PENDING}, {codes.CREDIT_DECLINED})"
    )
    if chosen is not None:
        events = semi(events, chosen, ["contract_id"])
    contracts = set_for_keys(
        contract,
        events,
        ["contract_id"],
        {
            "credit_state": codes.CREDIT_PENDING,
            "approval_status1": codes.APPROVAL_PENDING,
            "approval_status2": codes.APPROVAL_PENDING,
            "approver1_id": 0,
            "approver2_id": 0,
        },
    )
    return contracts, delete_for_keys(event_queue, events, ["event_queue_id"])


def reset_save_status(contract: DataFrame, affected: DataFrame) -> DataFrame:
    """Contracts of the affected rows wait for their ledger entries again."""
    return set_for_keys(contract, affected, ["contract_id"], {"save_status": codes.SAVE_PENDING_GL})

