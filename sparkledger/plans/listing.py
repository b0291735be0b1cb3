"""Decoded listings, duplicates, orphans and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkledger import codes
from sparkledger.functions.scalar import equals_ignore_case, has_prefix, like_ignore_case, row_count, total
from sparkledger.operators.joins import not_in, repeated_keys, semi


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    """The columns given as old=new."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def gl_entries(
    gl: DataFrame,
    lookup: DataFrame,
    currency: DataFrame,
    ledger: DataFrame,
    gl_tag: DataFrame,
    gl_account: DataFrame,
    contract_ids: list[int] | None = None,
    account_name: str | None = None,
) -> DataFrame:
    """Ledger entries decoded through their dimensions; lookup and currency are used in two roles each.

    The dimensions are joined without hints, so Spark broadcasts those that measure small. Optional filters
    by contract and by account name.
    """
    decoded = _decoded_gl(gl, lookup, currency, ledger, gl_tag, gl_account, contract_ids, account_name)
    return decoded.select(*GL_COLUMNS)


# Columns of a listing of ledger entries, and those that the whole journal adds.
GL_COLUMNS = (
    "contract_id", "gl_interface_id", "gl_entry_id", "post_dt", "currency_code", "base_currency_code", "account_name", "account_code", "amount",
    "flow_id", "flow_type_name", "reversal_status_name", "ledger_name", "gl_tag_id", "tag_name", "account_class",
)
JOURNAL_COLUMNS = ("entry_type_name", "input_dt", "narration", "asset_hdr_id", "base_amount", "fx_rate", "fx_rate_dt")


def _decoded_gl(gl, lookup, currency, ledger, gl_tag, gl_account, contract_ids=None, account_name=None) -> DataFrame:
    rows = gl if contract_ids is None else gl.where(F.col("contract_id").isin(*contract_ids))
    accounts = _renamed(gl_account, gl_account_id="gl_account_id", name="account_name", code="account_code")
    if account_name is not None:
        accounts = accounts.where(equals_ignore_case(F.col("account_name"), account_name))
    return (
        rows.join(accounts, "gl_account_id")
        .join(_renamed(currency, currency_id="currency_id", code="currency_code"), "currency_id")
        .join(_renamed(currency, currency_id="base_currency_id", code="base_currency_code"), "base_currency_id")
        .join(_renamed(lookup, lookupset_id="flow_type", value="flow_type_name"), "flow_type")
        .join(_renamed(lookup, lookupset_id="reversal_status", value="reversal_status_name"), "reversal_status")
        .join(_renamed(ledger, ledger_id="ledger_id", name="ledger_name"), "ledger_id")
        .join(_renamed(gl_tag, gl_tag_id="gl_tag_id", ext_name="tag_name", account_class="account_class"), "gl_tag_id")
    )


def gl_journal(
    gl: DataFrame, lookup: DataFrame, currency: DataFrame, ledger: DataFrame, gl_tag: DataFrame, gl_account: DataFrame, contract_ids: list[int] | None = None
) -> DataFrame:
    """Ledger entries with entry type, narration, input date, asset and base amount, decoded through their dimensions.

    Lookup is used in three roles: type of the entry, type of its flow and reversal state.
    """
    kinds = _renamed(lookup, lookupset_id="gl_entry_type", value="entry_type_name")
    return _decoded_gl(gl, lookup, currency, ledger, gl_tag, gl_account, contract_ids).join(kinds, "gl_entry_type").select(*GL_COLUMNS, *JOURNAL_COLUMNS)


def gl_orphans(gl: DataFrame, flow: DataFrame, flow_image: DataFrame, before: str) -> DataFrame:
    """Entries not yet interfaced, posted before a date, whose flow is in neither flow table."""
    rows = gl.where((F.col("gl_interface_id") == 0) & (F.col("post_dt") < F.lit(before).cast("date")))
    return not_in(rows, flow.select("flow_id").unionByName(flow_image.select("flow_id")), "flow_id")


def duplicate_links(custom_flow: DataFrame) -> DataFrame:
    """Link numbers that several live custom flows of a contract share."""
    return repeated_keys(custom_flow.where("is_deleted = 0"), ["contract_id", "link_no"])


def duplicate_write_offs(write_off: DataFrame) -> DataFrame:
    """Write-offs of the same contract, link and amount that occur more than once."""
    return repeated_keys(write_off, ["contract_id", "flow_link_id", "amount"])


def parties_with_duplicates(write_off: DataFrame, contract: DataFrame, party: DataFrame) -> DataFrame:
    """Parties of contracts that hold duplicate write-offs."""
    owners = semi(contract, duplicate_write_offs(write_off), ["contract_id"]).select(F.col("cparty_id").alias("party_id"))
    return semi(party, owners, ["party_id"])


def write_offs_by_party(write_off: DataFrame, account: DataFrame, party: DataFrame) -> DataFrame:
    """Written-off total of the parties with more than one write-off."""
    owner = account.select("party_account_id", "party_id").join(party.select("party_id", "party_no", "name"), "party_id")
    # Summed per account before the join, so that a hot account arrives there as a single row.
    per_account = write_off.groupBy("party_account_id").agg(F.sum("amount").alias("s"), F.count(F.lit(1)).alias("n"))
    return (
        per_account.join(owner, "party_account_id")
        .groupBy("party_no", "name")
        .agg(total("s").alias("total_amount"), F.sum("n").cast("bigint").alias("n_rows"))
        .where("n_rows > 1")
    )


def audit_decode(
    header: DataFrame,
    key: DataFrame,
    field: DataFrame,
    user: DataFrame,
    table: str = "",
    start: str | None = None,
    end: str | None = None,
    key_value: str = "",
) -> DataFrame:
    """Audit headers with their key rows, user and changed fields; each filter applies only when given."""
    rows, keys = header, key
    if table:
        rows = rows.where(F.col("tbl_name") == table)
    if start is not None:
        rows = rows.where(F.col("audit_dt") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.where(F.col("audit_dt") <= F.lit(end).cast("timestamp_ntz"))
    if key_value:
        keys = keys.where((F.col("old_fld_value") == key_value) | (F.col("new_fld_value") == key_value))
    change = None
    for code, name in codes.AUDIT_CHANGES.items():
        hit = F.col("change_type") == code
        change = F.when(hit, name) if change is None else change.when(hit, name)
    keys = _renamed(keys, audit_hdr_id="audit_hdr_id", fld_name="key_name", old_fld_value="key_old", new_fld_value="key_new")
    headers = rows.join(user.select("user_id", "user_name"), "user_id").join(keys, "audit_hdr_id")
    # A header has a row for each column of its table at most, so that a plain join does.
    return headers.join(field, "audit_hdr_id", "left").select(
        "audit_hdr_id", "audit_dt", change.alias("change_name"), "user_name", "tbl_name", "key_name", "key_old", "key_new",
        "fld_name", "old_fld_value", "new_fld_value",
    )


def queue_by_state(queue: DataFrame, state: str) -> DataFrame:
    return queue.groupBy(state).agg(row_count().alias("n_rows"))


def queue_backlog(queue: DataFrame, waiting, ts: str, as_of: str) -> DataFrame:
    """Number of waiting rows with the oldest and newest, next to the clock."""
    return queue.where(waiting).agg(
        F.lit(as_of).cast("timestamp_ntz").alias("checked_at"), row_count().alias("backlog"), F.min(ts).alias("oldest"), F.max(ts).alias("newest")
    )


def recent_rows(table: DataFrame, key: str, text: str, exclude: str, n: int) -> DataFrame:
    """The n latest rows by id whose text does not match a pattern (case ignored)."""
    return table.where(~like_ignore_case(F.col(text), exclude)).orderBy(F.col(key).desc()).limit(n)


def used_definitions(definition: DataFrame, key: str, instance: DataFrame, reference: str) -> DataFrame:
    """Definitions that at least one instance refers to."""
    return semi(definition, instance.select(F.col(reference).alias(key)), [key])


def invoice_flows(flow: DataFrame, tax: DataFrame, invoice: DataFrame, invoice_no: str = "") -> DataFrame:
    """Flows of each invoice, or of one number, with their tax lines, also flows without one. Invoice 0 means none."""
    if invoice_no:
        invoice = invoice.where(F.col("invoice_no") == invoice_no)
    lines = tax.select("flow_id", "tax_calc_flow_id", "tax_type_id", "amt_tax")
    flows = (
        flow.where("invoice_id <> 0")
        .select("flow_id", "contract_id", "invoice_id", "amount")
        .join(invoice, "invoice_id")
    )
    # A flow has a handful of tax lines, so that a plain join does.
    return flows.join(lines, "flow_id", "left").select(
        "invoice_no", "flow_id", "contract_id", "amount", "tax_calc_flow_id", "tax_type_id", "amt_tax"
    )


def invoice_origins(flow: DataFrame, invoice: DataFrame) -> DataFrame:
    """Flows that other invoiced flows link back to, with their own invoice."""
    linked = flow.where("invoice_id <> 0 AND flow_link_id <> 0")
    origins = linked.join(invoice.select("invoice_id"), "invoice_id", "left_semi").select(F.col("flow_link_id").alias("flow_id"))
    candidates = flow.where("invoice_id <> 0").select("flow_id", "contract_id", "calc_dt", "invoice_id")
    return semi(candidates, origins, ["flow_id"]).join(invoice, "invoice_id")


def unreceived_custom_flows(
    po_row: DataFrame, custom_flow: DataFrame, contract: DataFrame, asset_hdr: DataFrame, style: int = 2000
) -> DataFrame:
    """Purchase-order rows not received of which an asset sits on a partially terminated contract.

    `destination_csv` lists asset ids; pieces that are no id match nothing. The prefix is that of the custom flow
    which the row belongs to.
    """
    expected = custom_flow.where(has_prefix("ext_reference", "PO_ROW_")).select(
        F.col("contract_custom_flow_id").alias("po_row_cf_id"), "contract_id", "ext_reference"
    )
    rows = po_row.where(F.col("num_assets_received") == 0).join(expected, ["po_row_cf_id", "contract_id"])
    own = contract.where(F.col("product_style") == style).select("contract_id")
    target = contract.where(F.col("contract_state") == codes.CONTRACT_PART_TERMINATED).select(
        F.col("contract_id").alias("current_contract_id")
    )
    assets = asset_hdr.select("asset_hdr_id", "current_contract_id").join(target, "current_contract_id", "left_semi")
    ids = F.transform(F.split("destination_csv", ","), lambda piece: F.trim(piece).try_cast("bigint"))
    found = ["contract_id", "po_row_cf_id", "destination_csv", "ext_reference"]
    probes = rows.join(own, "contract_id", "left_semi").select(*found, F.explode(F.array_distinct(ids)).alias("asset_hdr_id"))
    return probes.join(assets.select("asset_hdr_id"), "asset_hdr_id", "left_semi").select(*found).distinct()


# Small decode lists ------------------------------------------------------------------------------

def contracts_by_product(contract: DataFrame, product: DataFrame, name: str, state: int) -> DataFrame:
    return (
        contract.where((F.col("contract_id") > 0) & (F.col("contract_state") == state))
        .join(product.where(F.col("name") == name).select("product_style", F.col("name").alias("product_name")), "product_style")
        .select("contract_id", "product_name", "contract_state")
    )


def products_with_tax_pricing(product: DataFrame, name: str) -> DataFrame:
    return product.where((F.col("is_tax_based_pricing") == 1) & (F.col("name") == name))


def flows_by_type(flow: DataFrame, lookup: DataFrame, set_name: str, value: str) -> DataFrame:
    """Flows whose type decodes to a value, by contract and expected date."""
    kinds = lookup.where((F.col("set_name") == set_name) & (F.col("value") == value)).select(
        F.col("lookupset_id").alias("flow_type"), F.col("value").alias("flow_type_name")
    )
    return flow.join(kinds, "flow_type").select("contract_id", "flow_id", "expected_dt", "amount", "flow_type_name")


def flows_by_method(flow: DataFrame, lookup: DataFrame, set_name: str, value: str) -> DataFrame:
    """Flows whose payment method decodes to a value."""
    methods = lookup.where((F.col("set_name") == set_name) & (F.col("value") == value)).select(
        F.col("lookupset_id").alias("flow_method_id"), F.col("value").alias("flow_method_name")
    )
    return flow.join(methods, "flow_method_id").select("contract_id", "flow_id", "expected_dt", "amount", "flow_method_name")


def accounts_like(gl_account: DataFrame, pattern: str) -> DataFrame:
    """Accounts whose name matches a pattern, case ignored."""
    return gl_account.where(like_ignore_case(F.col("name"), pattern))


def programs_and_units(unit: DataFrame, program: DataFrame) -> DataFrame:
    """Business units with the program they belong to."""
    return unit.where("is_business_unit = 1").select("party_id", F.col("name").alias("unit_name"), "program_id").join(program, "program_id")


def bank_flow_pairs(flow: DataFrame, match: DataFrame, bank_flow: DataFrame) -> DataFrame:
    """Flows and the bank flows of the same contract that pay them, one row per match."""
    pays = match.select("flow_id", "bank_flow_id", F.col("amt_matched").alias("amt_paid"))
    return (
        flow.select("flow_id", "contract_id", "amount")
        .join(pays, "flow_id")
        .join(bank_flow.select("bank_flow_id", "contract_id", "cheque_no"), ["bank_flow_id", "contract_id"])
        .select("contract_id", "flow_id", "bank_flow_id", "cheque_no", "amount", "amt_paid")
    )


def group_summary(table: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Average, count, first, last, greatest, least and sum per group; first and last by a unique order key."""
    return table.groupBy(*keys).agg(
        F.avg(value).cast("decimal(18,6)").alias("avg_value"),
        row_count().alias("n_rows"),
        F.min_by(value, order).alias("first_value"),
        F.max_by(value, order).alias("last_value"),
        F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
        total(value).alias("sum_value"),
    )
