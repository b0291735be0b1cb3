"""The repair of invalid tax lines as one run over all its tables, with checks of its own."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sparkledger import codes
from sparkledger.functions.scalar import money, row_count
from sparkledger.operators.changeset import ChangeSet
from sparkledger.operators.deltas import move_sums
from sparkledger.operators.joins import anti, semi, semi_few
from sparkledger.operators.keys import next_numbers
from sparkledger.operators.posting import Posting
from sparkledger.plans import ledger
from sparkledger.session import snapshot

# Stored tax per flow: (flow_id, n_rows, amt_tax), see `operators.deltas.sums`.
SUM_KEYS, SUM_MEASURES = ["flow_id"], ["amt_tax"]
GROSS = ("amt_gross", "amt_gross_netted")


@dataclass(frozen=True)
class TaxRepair:
    """A run: what it found, and its change to flows, tax lines, tax summaries, matches, contracts and stored tax sums."""

    invalid: DataFrame  # tax lines on a wrong asset
    reversal: ledger.Reversal
    posting: Posting
    known: DataFrame  # flow_id of flows of the same contracts that did not add up before, and are not touched

    def counters(self, tables: dict[str, DataFrame]) -> DataFrame:
        """The next flow number once the run is posted."""
        return next_numbers({"flow": (self.posting.changes["flow"].apply(tables["flow"]), "flow_id")})

    def mismatches(self, tables: dict[str, DataFrame]) -> DataFrame:
        """Current flows of the affected contracts whose gross is not amount plus tax after the run; there should be none.

        Tax is summed from the lines again, not taken from the stored sums, so that those are checked as well.
        """
        after = self.posting.apply({name: tables[name] for name in ("flow", "tax_calc_flow")})
        flows = semi(after["flow"], self.invalid, ["contract_id"])
        return ledger.tax_mismatches(flows, after["tax_calc_flow"], self.known)

    def checks(self, tables: dict[str, DataFrame], invoice: DataFrame, bank_flow: DataFrame, account: DataFrame) -> DataFrame:
        """(check_name, n_rows): invoices affected, mismatches left, flows to allocate again, bank flows that lost a match."""
        listed = {
            "affected_invoices": ledger.affected_invoice_tax(self.invalid, tables["flow"], invoice),
            "tax_mismatches": self.mismatches(tables),
            "flows_to_reallocate": ledger.flows_to_reallocate(self.reversal, tables["bank_flow_match"], bank_flow).distinct(),
            "unallocated_bank_flows": ledger.unallocated_bank_flows(self.reversal.before, tables["bank_flow_match"], bank_flow, account),
        }
        counted = [rows.agg(row_count().alias("n_rows")).select(F.lit(name).alias("check_name"), "n_rows") for name, rows in listed.items()]
        return reduce(DataFrame.unionByName, counted)

    def publish(self, tables: dict[str, DataFrame], folder: str, version: str, log: str, as_of: str, user_id: int) -> None:
        """Make the run current in all tables at once, unless its own check finds a flow that does not add up."""
        if not self.mismatches(tables).isEmpty():
            raise RuntimeError("taxes and gross amounts differ after the repair; nothing was published")
        self.posting.publish(tables, folder, version, log, as_of, user_id)


def repair_tax(tables: dict[str, DataFrame], invalid: DataFrame, as_of: str) -> TaxRepair:
    """Repair invalid tax lines: `tables` are flow, tax_calc_flow, tax_flow, bank_flow_match, contract and flow_tax_sum.

    Lines of open flows are deleted. Flows that are invoiced, settled or matched are reversed and issued again without the
    lines, with tax summaries; their matches are taken off. The stored tax per flow moves by the changed lines alone, and
    the gross amount of each current flow that lost lines or is new follows from it (amount, if no line is left). The
    contracts wait for their ledger entries. `invalid` is a stored frame, as `ledger.invalid_tax_lines` gives it.
    """
    flow, tax = tables["flow"], tables["tax_calc_flow"]
    held = ledger.flows_of_lines(flow, invalid)
    reversal = ledger.reverse_flows(flow, ledger.invoiced(held), as_of)
    posted = ledger.post_rows(reversal, tax, tables["tax_flow"], tables["bank_flow_match"], as_of, invalid).changes

    removed = snapshot(ledger.deletable_tax_lines(invalid, held).select(*tax.columns))
    lines = ChangeSet(["tax_calc_flow_id"], removed, inserts=snapshot(posted["tax_calc_flow"].inserts), deletes=removed.select("tax_calc_flow_id"))
    moved = move_sums(tables["flow_tax_sum"], lines, SUM_KEYS, SUM_MEASURES)
    opened = snapshot(semi(held, removed, ["flow_id"]))

    contracts = snapshot(semi(tables["contract"], invalid, ["contract_id"]))
    waiting = F.lit(codes.SAVE_PENDING_GL).cast(contracts.schema["save_status"].dataType).alias("save_status")
    touched = reversal.before.select("flow_id").unionByName(opened.select("flow_id"))
    # Their taxes are summed from their own lines alone.
    current = flow.where(f"reversal_status = {codes.CURRENT}").select("flow_id", "contract_id", "reversal_status", "amount", "amt_gross")
    before = snapshot(semi_few(current, invalid, ["contract_id"]))
    return TaxRepair(
        invalid=invalid,
        reversal=reversal,
        posting=Posting({
            **posted,
            "flow": _flow_change(reversal, opened, _new_sums(moved)),
            "tax_calc_flow": lines,
            "contract": ChangeSet(["contract_id"], contracts, updates=contracts.select("contract_id", waiting)),
            "flow_tax_sum": moved,
        }),
        known=snapshot(anti(ledger.tax_mismatches(before, semi_few(tax.select("flow_id", "amt_tax"), before, ["flow_id"])), touched, ["flow_id"]).select("flow_id")),
    )


def _new_sums(moved: ChangeSet) -> DataFrame:
    """The sums that a change to them leaves: (flow_id, total_tax)."""
    kept = moved.updates.select("flow_id", "amt_tax").unionByName(moved.inserts.select("flow_id", "amt_tax"))
    return kept.withColumnRenamed("amt_tax", "total_tax")


def _flow_change(reversal: ledger.Reversal, opened: DataFrame, total: DataFrame) -> ChangeSet:
    """The reversal with gross amounts that follow from the new tax: of the replacements and of the open flows that lost lines."""

    def with_gross(rows: DataFrame) -> DataFrame:
        gross = money(F.col("amount") + F.coalesce("total_tax", F.lit(0)))
        return rows.join(total, "flow_id", "left").withColumns({c: gross for c in GROSS if c in rows.columns}).select(*rows.columns)

    change = reversal.change_set()
    changed = list(dict.fromkeys((*change.updates.columns, *GROSS)))
    updates = reversal.original.select(*changed).unionByName(with_gross(opened).select(*changed))
    return ChangeSet(
        ["flow_id"], reversal.before.unionByName(opened), updates=updates, inserts=snapshot(reversal.reversal.unionByName(with_gross(reversal.replacement)))
    )
