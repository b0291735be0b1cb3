"""Ledger-shaped frames derived from the TPC-H-like tables.

A deployment brings its own flow, tax, match, contract and asset tables. For tests and benchmarks these
methods give the same shapes computed from the given tables, with deliberate defects (missing tax lines,
wrong assets, deleted matches, ledger entries without a flow) so that every repair job has work to do.
All rows of the base tables are used. Ids come from the row's own values (`row_id`), so deriving a
frame needs no global sort; the defects follow the quantity, discount and tax rate of the line item. `FIXTURES.md` states each frame as SQL.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkledger.functions.scalar import MONEY
from sparkledger.sources.tables import read_table

# Above every row id (those have 60 bits); marks ids made up to be missing or doubled.
OFFSET = 1 << 60

# Two primes just below 2^30, and the multipliers of the two id parts for each.
ID_PRIMES = (1073741789, 1073741783)
ID_FACTORS = ((1000003, 982451653), (15485863, 961748941))


def row_id(first: Column, second: Column) -> Column:
    """A 60-bit id hashed from two non-negative integers, in plain 64-bit arithmetic."""
    halves = [
        ((first % prime) * a + (second % prime) * b) % prime for prime, (a, b) in zip(ID_PRIMES, ID_FACTORS)
    ]
    return halves[0] * F.lit(1 << 30) + halves[1]


def _once(build):
    """Build a frame once per `Fixtures`: frames are lazy, but reading a schema and analysing a plan take time."""
    name = build.__name__

    @functools.wraps(build)
    def cached(self):
        if name not in self._frames:
            self._frames[name] = build(self)
        return self._frames[name]

    return cached


class Fixtures:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if f"table {name}" not in self._frames:
            self._frames[f"table {name}"] = read_table(self.spark, self.folder, name)
        return self._frames[f"table {name}"]

    # Cash flows, tax, matches ------------------------------------------------------------------

    @_once
    def flow(self) -> DataFrame:
        """Cash flows, one per line item; the stored matched amount is 0 for quantities 41 to 48."""
        base = self.table("lineitem").select(
            row_id(
                F.col("l_orderkey") * 8 + F.col("l_linenumber"),
                F.col("l_partkey") * 16384 + F.unix_date(F.col("l_shipdate").cast("date")),
            ).alias("flow_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.floor(F.col("l_discount") * 100 + 0.5).cast("int").alias("discount_pct"),
            F.col("l_orderkey").alias("contract_id"),
            F.col("l_partkey").alias("asset_hdr_id"),
            F.col("l_suppkey").alias("party_account_id"),
            F.col("l_linenumber").alias("link_no"),
            F.col("l_shipdate").cast("date").alias("calc_dt"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.col("l_tax").cast("decimal(4,2)").alias("rate"),
            F.when(F.col("l_returnflag") == "R", 4201).otherwise(4200).alias("reversal_status"),
            F.when(F.col("l_linestatus") == "F", 2101).otherwise(2100).alias("status"),
        )
        base = base.selectExpr(
            "*",
            "CASE link_no WHEN 1 THEN 1010 WHEN 2 THEN 1014 WHEN 3 THEN 1034 ELSE 1001 END AS flow_type",
            "CASE WHEN party_account_id % 4 = 0 THEN 0 ELSE contract_id END AS invoice_id",
            "CAST(amount + round(amount * rate, 2) AS DECIMAL(18,2)) AS amt_gross",
            "CAST(amount * 0.8 AS DECIMAL(18,2)) AS amt_principal",
            "quantity BETWEEN 41 AND 48 AS _unmatched",
        )
        return base.selectExpr(
            "flow_id", "quantity", "discount_pct", "contract_id", "asset_hdr_id", "party_account_id", "link_no", "calc_dt", "amount", "rate",
            "reversal_status", "status", "flow_type", "invoice_id", "amt_gross", "amt_principal",
            "CAST(amount - amt_principal AS DECIMAL(18,2)) AS amt_interest",
            "1 AS image_no",
            "calc_dt AS actual_dt",
            "date_add(calc_dt, 30) AS expected_dt",
            "CAST(party_account_id % 25 AS INT) AS currency_id",
            "CASE WHEN link_no = 7 THEN 0 ELSE 1 END AS is_cash",
            "0 AS nett_no",
            "5100 + link_no AS flow_method_id",
            "CAST(0 AS BIGINT) AS flow_link_id",
            "CAST(amount * 0.1 AS DECIMAL(18,2)) AS amt_contingent_rental",
            "CAST(party_account_id % 10 AS INT) AS bank_interface_run_id",
            "CASE WHEN link_no = 1 THEN 1 ELSE 0 END AS custom_flow_hdr_id",
            "CAST(asset_hdr_id % 3 AS INT) AS settlement_bank_info_id",
            "amt_gross AS amt_gross_netted",
            "14801 AS collection_state",
            "1 AS late_fee_upto",
            "1 AS is_overdue_interest_pending",
            "calc_dt AS last_overdue_interest_dt",
            "0 AS statement_id",
            "amount AS amt_rental",
            "CASE WHEN status = 2101 THEN calc_dt ELSE DATE '1900-01-01' END AS settled_dt",
            "CAST(CASE WHEN _unmatched THEN 0 ELSE amount END AS DECIMAL(18,2)) AS amt_matched",
            "CAST(CASE WHEN _unmatched THEN 0 ELSE amt_principal END AS DECIMAL(18,2)) AS amt_matched_principal",
            "CAST(CASE WHEN _unmatched THEN 0 ELSE amount - amt_principal END AS DECIMAL(18,2)) AS amt_matched_interest",
            "CAST(0 AS DECIMAL(18,2)) AS amt_matched_tax",
            "CAST(CASE WHEN _unmatched THEN 0 ELSE amount END AS DECIMAL(18,2)) AS amt_matched_netted",
            "CASE WHEN discount_pct = 7 THEN 1 ELSE 0 END AS exclude_from_account_bal",
            "1 AS last_user_id",
            "0 AS reserve_statement_id",
            "amt_gross AS amt_invoice",
        )

    @_once
    def linked_flow(self) -> DataFrame:
        """Cash flows that carry a link to the first flow of their contract (0 on that flow itself)."""
        flow = self.flow()
        first = flow.groupBy("contract_id").agg(F.min("flow_id").alias("first_id"))
        return flow.drop("flow_link_id").join(first, "contract_id").selectExpr(
            "* EXCEPT (first_id)", "CASE WHEN flow_id = first_id THEN 0 ELSE first_id END AS flow_link_id"
        )

    @_once
    def flow_image(self) -> DataFrame:
        """History twin of the flow table: half of the ids that the ledger knows and `flow` does not."""
        return self.flow().where("discount_pct = 4 AND quantity <= 25").select((F.col("flow_id") + OFFSET).alias("flow_id"))

    @_once
    def tax(self) -> DataFrame:
        """Tax lines: none for rate 0, two for small quantities. With 9 % discount the line is on the next asset of
        the same owner, with 10 % on one owned by the flow's asset."""
        lines = self.flow().where("rate <> 0").selectExpr(
            "flow_id", "discount_pct", "contract_id", "asset_hdr_id", "amount", "rate",
            "explode(CASE WHEN quantity <= 10 THEN array(1, 2) ELSE array(1) END) AS tax_type_id",
        )
        return lines.selectExpr(
            "flow_id * 2 + tax_type_id - 1 AS tax_calc_flow_id", "flow_id", "contract_id",
            "CASE WHEN tax_type_id = 2 THEN asset_hdr_id "
            "WHEN discount_pct = 9 THEN asset_hdr_id - asset_hdr_id % 10 + (asset_hdr_id + 1) % 10 "
            "WHEN discount_pct = 10 THEN asset_hdr_id * 10 + 1 ELSE asset_hdr_id END AS asset_hdr_id",
            "CAST(contract_id % 3 + 1 AS INT) AS tax_authority_id", "tax_type_id", "amount", "rate",
            "CASE WHEN tax_type_id = 2 THEN CAST(1.50 AS DECIMAL(18,2)) "
            "ELSE CAST(round(amount * rate, 2) AS DECIMAL(18,2)) END AS amt_tax",
        )

    @_once
    def tax_flow(self) -> DataFrame:
        """Tax summaries, one per flow, authority and type; those of even flows are matched."""
        return self.tax().selectExpr(
            "tax_calc_flow_id AS tax_flow_id", "flow_id", "contract_id", "tax_authority_id", "tax_type_id AS tax_type_hdr_id",
            "amt_tax AS amount", "amt_tax AS amt_financed", "amt_tax AS amt_invoice",
            "CASE WHEN flow_id % 2 = 0 THEN amt_tax ELSE CAST(0 AS DECIMAL(18,2)) END AS amt_matched",
            "CAST(rate AS DECIMAL(18,4)) AS tax_rate", "1 AS image_no",
        )

    @_once
    def match(self) -> DataFrame:
        """Bank matches: none for quantities up to 16; by discount some are short, deleted, rejected or recovery."""
        return self.flow().where("quantity > 16").selectExpr(
            "flow_id AS bank_flow_match_id", "contract_id AS bank_flow_id", "flow_id",
            "CASE WHEN discount_pct = 3 THEN flow_id ELSE 0 END AS recovery_flow_id",
            "CAST(CASE WHEN discount_pct = 2 THEN amount - 1 ELSE amount END AS DECIMAL(18,2)) AS amt_matched",
            "amt_principal AS amt_matched_principal", "amt_interest AS amt_matched_interest",
            "CAST(round(amount * rate, 2) AS DECIMAL(18,2)) AS amt_matched_tax",
            "CASE WHEN discount_pct = 5 THEN 1 ELSE 0 END AS is_deleted",
            "CASE WHEN discount_pct = 6 THEN 1 ELSE 0 END AS is_rejected",
            "DATE '1900-01-01' AS unallocated_dt", "0 AS unallocated_user_id",
        )

    @_once
    def bank_flow(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS bank_flow_id", "o_orderkey AS contract_id", "o_custkey AS party_account_id",
            "CAST(o_custkey % 50 AS INT) AS batch_no", "concat('CHQ', CAST(o_orderkey AS STRING)) AS cheque_no",
            "CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS is_deleted",
        )

    @_once
    def invoice(self) -> DataFrame:
        return self.table("orders").where("o_orderkey <> 0").selectExpr(
            "o_orderkey AS invoice_id",
            # Neighbouring orders share a number now and then.
            "concat('INV', CAST(CASE WHEN o_orderkey % 8 = 1 THEN o_orderkey + 1 ELSE o_orderkey END AS STRING)) AS invoice_no",
        )

    @_once
    def write_off(self) -> DataFrame:
        """Current write-off flows; those of large quantities are booked twice."""
        copies = self.flow().where("flow_type = 1034 AND reversal_status = 4200").selectExpr(
            "flow_id", "contract_id", "link_no AS flow_link_id", "party_account_id", "amount",
            f"explode(CASE WHEN quantity >= 45 THEN array(0L, {OFFSET}L) ELSE array(0L) END) AS shift",
        )
        return copies.withColumn("flow_id", F.col("flow_id") + F.col("shift")).drop("shift")

    @_once
    def custom_flow(self) -> DataFrame:
        """Expected asset per custom flow; link numbers repeat inside some contracts."""
        return self.flow().where("flow_type = 1010").selectExpr(
            "flow_id AS contract_custom_flow_id", "contract_id", "link_no", "asset_hdr_id AS destination_asset_hdr_id",
            "1 AS is_active", "CASE WHEN discount_pct = 8 THEN 1 ELSE 0 END AS is_deleted",
            "CASE WHEN quantity = 50 THEN 1 ELSE 0 END AS is_restructure",
            # With 1 % discount a second header uses the link number for another asset.
            "explode(CASE WHEN discount_pct = 1 THEN array(1, 2) ELSE array(1) END) AS custom_flow_hdr_id",
        ).withColumn(
            "destination_asset_hdr_id", F.expr("CASE WHEN custom_flow_hdr_id = 2 THEN destination_asset_hdr_id + 1 ELSE destination_asset_hdr_id END")
        )

    @_once
    def po_row(self) -> DataFrame:
        """Purchase-order rows that carry asset ids as text: one or two, and for large quantities something else."""
        return self.flow().where("link_no = 5").selectExpr(
            "flow_id AS po_row_cf_id", "contract_id",
            "CASE WHEN quantity % 3 = 0 THEN concat(asset_hdr_id, ', ', asset_hdr_id + 1) WHEN quantity % 10 = 1 THEN concat(asset_hdr_id, ',n/a') "
            "ELSE CAST(asset_hdr_id AS STRING) END AS destination_csv",
            "CASE WHEN quantity > 25 THEN 1 ELSE 0 END AS num_assets_received",
        )

    @_once
    def expected_row(self) -> DataFrame:
        """The custom flows of the purchase-order rows, with the prefix as text; none without discount."""
        return self.flow().where("link_no = 5 AND discount_pct > 0").selectExpr(
            "flow_id AS contract_custom_flow_id", "contract_id",
            "CASE WHEN discount_pct >= 8 THEN 'POxROWy' ELSE 'PO_ROW_' END AS ext_reference",
        )

    # Contracts, assets, quotes, addresses ------------------------------------------------------

    @_once
    def contract(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS contract_id", "o_custkey AS cparty_id", "CAST(o_orderdate AS DATE) AS calc_dt",
            "date_add(DATE '2024-01-01', CAST(o_orderkey % 30 AS INT)) AS activated_dt",
            "CAST(add_months(CAST(o_orderdate AS DATE), 60) AS DATE) AS mature_dt",
            "o_custkey % 97 AS default_asset_address_id",
            "CASE o_orderstatus WHEN 'F' THEN 11130 WHEN 'O' THEN 11140 ELSE 11150 END AS contract_state",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 2011 WHEN '2-HIGH' THEN 2014 ELSE 2000 END AS product_style",
            "CASE WHEN o_orderkey % 4 = 2 THEN 12040 ELSE 12030 END AS credit_state",
            "6510 AS approval_status1", "6520 AS approval_status2", "o_custkey AS approver1_id", "o_custkey % 7 AS approver2_id",
            "2200 AS save_status",
        )

    @_once
    def product(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "CASE o_orderpriority WHEN '1-URGENT' THEN 2011 WHEN '2-HIGH' THEN 2014 ELSE 2000 END AS product_style"
        ).distinct().selectExpr(
            "product_style",
            "CASE product_style WHEN 2011 THEN 'Loan' WHEN 2014 THEN 'Operating Lease' ELSE 'Hire' END AS name",
            "CASE WHEN product_style = 2014 THEN 1 ELSE 0 END AS is_tax_based_pricing",
        )

    @_once
    def event_queue(self) -> DataFrame:
        """Past credit-state transitions, one per contract."""
        return self.table("orders").selectExpr(
            "o_orderkey AS event_queue_id", "o_orderkey AS contract_id", "24903 AS event_type",
            "CASE o_orderkey % 4 WHEN 0 THEN 11030 WHEN 1 THEN 12020 WHEN 2 THEN 12040 ELSE 11130 END AS event_state_before",
            "CAST(o_orderdate AS DATE) AS input_dt",
        )

    @_once
    def asset_tree(self) -> DataFrame:
        """The hierarchy of the physical assets, ten per owner; asset 0 is its own owner."""
        return self.table("part").selectExpr(
            "p_partkey AS asset_hdr_id", "CAST(floor(p_partkey / 10) AS BIGINT) AS owner_id",
            "CAST(floor(p_partkey / 100) AS BIGINT) AS parent_owner_id",
        )

    @_once
    def asset_hdr(self) -> DataFrame:
        """Physical assets with their place in the hierarchy and their contracts."""
        contracts = self.flow().groupBy("asset_hdr_id").agg(
            F.max("contract_id").alias("last_contract"), F.min("contract_id").alias("first_contract")
        )
        part = self.table("part").withColumnRenamed("p_partkey", "asset_hdr_id")
        return part.join(contracts, "asset_hdr_id", "left").selectExpr(
            "asset_hdr_id", "CAST(floor(asset_hdr_id / 10) AS BIGINT) AS owner_id",
            "CAST(floor(asset_hdr_id / 100) AS BIGINT) AS parent_owner_id",
            "CASE p_size % 3 WHEN 0 THEN 43030 WHEN 1 THEN 43040 ELSE 43050 END AS asset_status",
            "coalesce(last_contract, 0) AS current_contract_id", "coalesce(first_contract, 0) AS original_contract_id",
            "asset_hdr_id % 2 * 5 AS delivery_address_id", "CAST(0 AS BIGINT) AS current_address_id",
            "p_name AS name", "p_type AS model", "p_size % 25 AS asset_type_id",
            "CAST(p_size AS BIGINT) AS manufacturer_id",
        )

    @_once
    def asset(self) -> DataFrame:
        """Assets on contracts, some of the flows' assets absent; for custom flows also the owner of the asset."""
        held = self.flow().where("link_no <= 4").selectExpr(
            "contract_id",
            "explode(array_compact(array(CASE WHEN asset_hdr_id % 31 <> 0 THEN asset_hdr_id END, "
            "CASE WHEN link_no = 1 THEN CAST(floor(asset_hdr_id / 10) AS BIGINT) END))) AS asset_hdr_id",
        )
        return held.distinct().select(
            row_id(F.col("contract_id"), F.col("asset_hdr_id")).alias("asset_id"), "contract_id", "asset_hdr_id",
            F.expr("CASE WHEN (contract_id + asset_hdr_id) % 3 = 0 THEN 1 ELSE 0 END AS is_terminated"),
        )

    @_once
    def quote(self) -> DataFrame:
        return self.flow().select("contract_id", "asset_hdr_id").distinct().select(
            row_id(F.col("contract_id"), F.col("asset_hdr_id")).alias("asset_hdr_quote_id"), "contract_id", "asset_hdr_id",
            F.expr(
                "CASE WHEN asset_hdr_id % 5 = 0 THEN 44030 WHEN (contract_id + asset_hdr_id) % 4 = 0 THEN 44000 "
                "WHEN (contract_id + asset_hdr_id) % 4 = 1 THEN 44020 WHEN (contract_id + asset_hdr_id) % 4 = 2 THEN 44030 "
                "ELSE 44040 END AS quote_status"
            ),
        )

    @_once
    def asset_address(self) -> DataFrame:
        """Effective-dated addresses; day resolution makes ties."""
        return self.table("events").where("event_type IN ('click', 'view', 'purchase')").selectExpr(
            "event_id AS asset_hdr_address_id", "user_id AS asset_hdr_id",
            "CASE event_type WHEN 'click' THEN 45100 WHEN 'view' THEN 45101 ELSE 45102 END AS asset_hdr_address_type",
            "CAST(ts AS DATE) AS effective_dt", "event_id % 97 AS address_id",
        )

    @_once
    def address(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS address_id", "c_name AS street", "CAST(c_nationkey AS STRING) AS zip_code", "c_mktsegment AS city"
        )

    @_once
    def asset_type(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey AS asset_type_id", "n_name AS name")

    @_once
    def vehicle(self) -> DataFrame:
        return self.table("part").where("p_size % 4 = 0").selectExpr(
            "p_partkey AS asset_hdr_id", "p_brand AS registration_no"
        )

    @_once
    def alteration(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS contract_alteration_id", "user_id AS contract_id",
            "CAST(floor(event_id / 1000) AS BIGINT) AS contract_restructure_id", "CAST(545 + event_id % 9 AS INT) AS fld_id",
            "event_id % 50 AS obj_id",
        )

    @_once
    def restructure(self) -> DataFrame:
        """The restructures of the contracts; every third contract has had one more, without any alteration."""
        altered = self.alteration().select("contract_id", "contract_restructure_id").distinct()
        empty = altered.where("contract_id % 3 = 0").groupBy("contract_id").agg(F.max("contract_restructure_id").alias("m"))
        return altered.unionByName(empty.selectExpr("contract_id", "m + 1 AS contract_restructure_id"))

    # Parties, ledger, audit, notes -------------------------------------------------------------

    @_once
    def party(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS party_id", "c_custkey AS party_no", "c_name AS name", "concat(c_name, ' Ltd') AS ext_name",
            "c_acctbal AS gross_income", "c_nationkey AS program_id",
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 4 WHEN 'BUILDING' THEN 16 WHEN 'FURNITURE' THEN 64 "
            "WHEN 'MACHINERY' THEN 256 ELSE 8 END AS party_type",
            "CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS is_business_unit", "0 AS is_branch",
            "concat('first', CAST(c_custkey AS STRING)) AS first_names", "'middle' AS middle_name",
            "date_add(DATE '1960-01-01', CAST(c_custkey % 9000 AS INT)) AS date_of_birth",
            "concat('+1 555 ', CAST(c_custkey AS STRING)) AS phone_business",
            "concat(c_name, '@example.com') AS email_business", "concat('TAX', CAST(c_custkey AS STRING)) AS tax_no",
        )

    @_once
    def party_account(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS party_account_id", "s_name AS name", "s_suppkey AS party_id",
            "concat('ACC', CAST(s_suppkey AS STRING)) AS account_no",
        )

    @_once
    def program(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey AS program_id", "n_name AS program_name")

    @_once
    def user(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS user_id", "c_name AS user_name", "concat(c_name, '@example.com') AS email",
            "CAST(16800 + c_custkey % 4 AS INT) AS external_user_type",
        )

    @_once
    def gl_journal(self) -> DataFrame:
        """Ledger entries with all their columns; those with 4 % discount point at a flow that does not exist."""
        return self.flow().selectExpr(
            "flow_id AS gl_entry_id", f"CASE WHEN discount_pct = 4 THEN flow_id + {OFFSET} ELSE flow_id END AS flow_id",
            "contract_id", "calc_dt AS post_dt", "amount", "flow_type", "reversal_status",
            "CAST(party_account_id % 25 AS INT) AS currency_id", "CAST(party_account_id % 5 AS INT) AS ledger_id",
            "CAST(contract_id % 25 AS INT) AS base_currency_id", "CAST(asset_hdr_id % 25 AS INT) AS gl_account_id",
            "CAST(asset_hdr_id % 5 AS INT) AS gl_tag_id",
            "CASE WHEN quantity <= 16 THEN 1 ELSE 0 END AS gl_interface_id",
            "CASE WHEN flow_type = 1034 THEN 6002 ELSE 6001 END AS gl_entry_type", "date_add(calc_dt, 1) AS input_dt",
            "concat('line ', CAST(link_no AS STRING)) AS narration", "asset_hdr_id",
            "CAST(amount * 2 AS DECIMAL(18,2)) AS base_amount", "CAST(2 AS DECIMAL(9,4)) AS fx_rate", "calc_dt AS fx_rate_dt",
        )

    @_once
    def gl_entry(self) -> DataFrame:
        return self.gl_journal().drop("gl_entry_type", "input_dt", "narration", "asset_hdr_id", "base_amount", "fx_rate", "fx_rate_dt")

    @_once
    def currency(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey AS currency_id", "upper(substring(n_name, 1, 3)) AS code")

    @_once
    def ledger(self) -> DataFrame:
        return self.table("region").selectExpr("r_regionkey AS ledger_id", "r_name AS name")

    @_once
    def gl_tag(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey AS gl_tag_id", "lower(r_name) AS ext_name", "r_regionkey % 2 AS account_class"
        )

    @_once
    def gl_account(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "n_nationkey AS gl_account_id",
            "CASE WHEN n_nationkey % 5 = 0 THEN 'System Suspense' ELSE n_name END AS name",
            "concat('A', CAST(n_nationkey AS STRING)) AS code",
        )

    @_once
    def lookup(self) -> DataFrame:
        """Decode table of the code sets: a few fixed rows."""
        rows = [
            (1001, "FlowType", "Rental"), (1010, "FlowType", "Custom"), (1014, "FlowType", "Security Deposit"),
            (1034, "FlowType", "Write Off"), (4200, "ReversalStatus", "Current"), (4201, "ReversalStatus", "Reversed"),
            (4202, "ReversalStatus", "Reversal"), (2100, "FlowStatus", "Pending"), (2101, "FlowStatus", "Settled"),
            (5101, "FlowMethod", "Direct Debit"), (5102, "FlowMethod", "Cheque"), (5103, "FlowMethod", "Bank Transfer"),
            (6001, "GLEntryType", "Booking"), (6002, "GLEntryType", "Adjustment"),
        ]
        # An inline table: Spark knows its size, so that no join with it shuffles a large table by its few codes.
        return self.spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, rows))} AS t(lookupset_id, set_name, value)")

    @_once
    def audit_hdr(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS audit_hdr_id", "ts AS audit_dt", "CAST(event_id % 6 AS INT) AS change_type", "user_id",
            "CASE event_type WHEN 'click' THEN 'party' WHEN 'view' THEN 'address' WHEN 'purchase' THEN 'party_account' "
            "ELSE event_type END AS tbl_name",
        )

    @_once
    def audit_key(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS audit_hdr_id", "'id' AS fld_name",
            "CASE WHEN event_id % 6 = 1 THEN NULL ELSE CAST(user_id AS STRING) END AS old_fld_value",
            "CAST(user_id AS STRING) AS new_fld_value",
        )

    @_once
    def audit_fld(self) -> DataFrame:
        """Changed fields; signups have none."""
        return self.table("events").where("event_type <> 'signup'").selectExpr(
            "event_id AS audit_hdr_id", "'props' AS fld_name", "CAST(NULL AS STRING) AS old_fld_value",
            "props AS new_fld_value",
        )

    @_once
    def note(self) -> DataFrame:
        return self.table("documents").selectExpr("doc_id AS note_id", "source AS subject", "text AS comments", "lang")

    # Tables with an age, for retention ---------------------------------------------------------

    @_once
    def retention_tables(self) -> dict[str, DataFrame]:
        events, orders, customer = self.table("events"), self.table("orders"), self.table("customer")
        flow = self.flow()
        day = "CAST(o_orderdate AS DATE)"
        return {
            # Events are moved back 26 years, so that they share the calendar of the ledger.
            "event_log": events.selectExpr("event_id AS event_log_id", "CAST(add_months(CAST(ts AS DATE), -312) AS DATE) AS input_dt"),
            "grid_queue": orders.selectExpr("o_orderkey AS grid_queue_id", f"{day} AS input_dt"),
            "aii_event_queue_history": orders.selectExpr("o_orderkey AS history_id", f"{day} AS end_dt"),
            "aii_event_queue_response": flow.selectExpr("flow_id AS response_id", "contract_id AS history_id"),
            "contract_write_off": flow.where("flow_type = 1034").selectExpr(
                "flow_id AS write_off_id", "contract_id AS note_id", "date_add(calc_dt, 10) AS input_dt", "calc_dt"
            ),
            "event_queue": self.event_queue().select("event_queue_id", "input_dt"),
            "workflow_task_todo": orders.selectExpr(
                "o_orderkey AS todo_id", f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {day} END AS completion_date"
            ),
            "note": orders.selectExpr(
                "o_orderkey AS note_id", "o_custkey AS doc_id", f"{day} AS activity_dt",
                f"date_add({day}, CAST(o_custkey % 400 AS INT)) AS last_updated_dt",
            ),
            "note_attachment": flow.selectExpr("flow_id AS attachment_id", "contract_id AS note_id"),
            "bank_interface_run": orders.selectExpr("o_orderkey AS run_id", f"{day} AS run_dt"),
            "bank_interface_run_temp": flow.selectExpr("flow_id AS temp_id", "contract_id AS run_id"),
            "calculation_log": orders.selectExpr("o_orderkey AS log_id", f"{day} AS calc_end_dt"),
            "asset_balance": flow.selectExpr(
                "flow_id AS asset_balance_id", "calc_dt AS input_dt", "date_add(calc_dt, CAST(link_no * 100 AS INT)) AS effective_dt"
            ),
            "doc_list": orders.selectExpr("o_orderkey AS doc_list_id", "o_custkey AS doc_id"),
            "doc_link": orders.selectExpr("o_orderkey AS doc_link_id", "o_custkey AS doc_id"),
            "doc": customer.selectExpr(
                "c_custkey AS doc_id",
                *[
                    f"date_add(DATE '1995-01-01', CAST(c_custkey * 7 % 2400 + {days} AS INT)) AS {name}"
                    for name, days in (("effect_dt", 0), ("created_dt", 1), ("released_dt", 20), ("output_dt", 40))
                ],
                "DATE '1900-01-01' AS rejected_dt",
            ),
        }
