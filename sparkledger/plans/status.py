"""Status repair of quotes and assets, effective-dated addresses, hierarchy, revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkledger import codes
from sparkledger.operators.changeset import ChangeSet
from sparkledger.operators.hierarchy import ancestor_pairs
from sparkledger.operators.joins import as_of, anti, flag_any, latest_as_of, semi, semi_any
from sparkledger.operators.keys import max_key, number_rows
from sparkledger.session import snapshot

OWNERS = ["_own", "owner_id", "parent_owner_id"]


def _with_owners(rows: DataFrame, asset_hdr: DataFrame, *more: str) -> DataFrame:
    """Rows with the three assets that may stand for theirs: itself, its owner, its owner's owner."""
    return rows.join(asset_hdr.select("asset_hdr_id", "owner_id", "parent_owner_id", *more), "asset_hdr_id").withColumn(
        "_own", F.col("asset_hdr_id")
    )


def _changes(rows: DataFrame, entity: str, key: str, old: str, new) -> DataFrame:
    return rows.select(
        F.lit(entity).alias("entity"), F.col(key).alias("id"), F.col(old).alias("old_status"), F.lit(new).alias("new_status")
        if isinstance(new, int) else new.alias("new_status")
    )


# Terminated contracts ----------------------------------------------------------------------------

def quotes_on_terminated_assets(quote: DataFrame, asset_hdr: DataFrame, asset: DataFrame) -> DataFrame:
    """Quotes not yet terminated whose asset, or an owner of it, is terminated on the quote's contract. A snapshot."""
    open_quotes = _with_owners(quote.where(F.col("quote_status") != codes.QUOTE_TERMINATED), asset_hdr, "asset_status")
    terminated = asset.where("is_terminated = 1").select("contract_id", F.col("asset_hdr_id").alias("_asset"))
    hits = semi_any(open_quotes, ["asset_hdr_quote_id"], OWNERS, terminated, "_asset", same=["contract_id"])
    return snapshot(hits.select("asset_hdr_quote_id", "asset_hdr_id", "contract_id", "quote_status", "asset_status"))


def repair_terminated(affected: DataFrame, quote: DataFrame) -> DataFrame:
    """Affected quotes become terminated; then assets without another open quote become active.

    The second step looks at the quotes as the first one leaves them.
    """
    still_open = anti(quote.where(F.col("quote_status").isin(*codes.OPEN_QUOTES)), affected, ["asset_hdr_quote_id"])
    assets = anti(affected.select("asset_hdr_id", "asset_status").distinct(), still_open, ["asset_hdr_id"])
    return _changes(affected, "quote", "asset_hdr_quote_id", "quote_status", codes.QUOTE_TERMINATED).unionByName(
        _changes(assets, "asset", "asset_hdr_id", "asset_status", codes.ASSET_ACTIVE)
    )


def terminated_addresses(affected: DataFrame, contract: DataFrame, address: DataFrame, date: str = "activated_dt") -> DataFrame:
    """Address rows to insert: the contract's default address from its start date, unless one starts that day."""
    start = contract.select("contract_id", F.col("default_asset_address_id").alias("address_id"), F.col(date).alias("effective_dt"))
    current = address.where(F.col("asset_hdr_address_type") == codes.ADDRESS_CURRENT)
    return anti(affected.join(start, "contract_id"), current, ["asset_hdr_id", "effective_dt"]).select(
        "asset_hdr_id", "contract_id", "address_id", "effective_dt", F.lit(codes.ADDRESS_CURRENT).alias("asset_hdr_address_type")
    )


# Activated contracts -----------------------------------------------------------------------------

def quotes_on_activated_contracts(
    contract: DataFrame,
    asset_hdr: DataFrame,
    quote: DataFrame,
    asset: DataFrame,
    event_queue: DataFrame,
    styles: tuple[int, ...] = (codes.STYLE_RENTAL,),
) -> DataFrame:
    """Quotes and assets of activated contracts that have a quoting asset and once left the expired state. A snapshot."""
    candidates = contract.where(
        F.col("contract_state").isin(codes.CONTRACT_ACTIVATED, codes.CONTRACT_PART_TERMINATED) & F.col("product_style").isin(*styles)
    ).select("contract_id", "calc_dt")
    expired = event_queue.where(F.col("event_state_before") == codes.CREDIT_EXPIRED)
    candidates = semi(candidates, expired, ["contract_id"])
    held = asset_hdr.withColumnRenamed("current_contract_id", "contract_id")
    quoting = semi(
        held.where(F.col("asset_status") == codes.ASSET_QUOTING).select("contract_id", "asset_hdr_id"),
        quote.where(F.col("quote_status") == codes.QUOTE_QUOTING),
        ["contract_id", "asset_hdr_id"],
    )
    candidates = semi(candidates, quoting, ["contract_id"])
    rows = (
        candidates.join(
            held.select(
                "contract_id", "asset_hdr_id", "owner_id", "parent_owner_id", "asset_status", "delivery_address_id", "current_address_id"
            ),
            "contract_id",
        )
        .join(quote, ["contract_id", "asset_hdr_id"])
        .withColumn("_own", F.col("asset_hdr_id"))
    )
    live = asset.where("is_terminated = 0").select("contract_id", F.col("asset_hdr_id").alias("_asset"))
    hits = semi_any(rows, ["asset_hdr_quote_id"], OWNERS, live, "_asset", same=["contract_id"])
    # Quotes and assets are both changed from these rows.
    return snapshot(hits.drop("_own", "owner_id", "parent_owner_id"))


def repair_activated(affected: DataFrame) -> DataFrame:
    """Assets become active and quotes active on contract."""
    assets = affected.select("asset_hdr_id", "asset_status").distinct()
    return _changes(affected, "quote", "asset_hdr_quote_id", "quote_status", codes.QUOTE_ACTIVE).unionByName(
        _changes(assets, "asset", "asset_hdr_id", "asset_status", codes.ASSET_ACTIVE)
    )


# Classification ----------------------------------------------------------------------------------

def classify_status(quote: DataFrame, asset_hdr: DataFrame, asset: DataFrame, contract: DataFrame) -> DataFrame:
    """Changes to open quotes, and to assets given the quotes after those changes.

    Quotes: no asset on the contract -> expired; terminated asset on a terminated contract -> terminated.
    Assets on an activated contract: quoting or reserved without an open quote -> active; active with a
    reserved quote -> reserved; active with a quoting quote -> quoting. Reserved wins over quoting.
    """
    open_quotes = quote.where(F.col("quote_status").isin(*codes.OPEN_QUOTES)).join(
        contract.select("contract_id", "contract_state"), "contract_id"
    )
    flagged = flag_any(
        _with_owners(open_quotes, asset_hdr),
        ["asset_hdr_quote_id"],
        OWNERS,
        asset.select("contract_id", F.col("asset_hdr_id").alias("_asset"), "is_terminated"),
        "_asset",
        ["contract_id"],
        "is_terminated",
        "terminated",
    )
    terminated = (F.col("terminated") == 1) & (F.col("contract_state") == codes.CONTRACT_TERMINATED)
    judged = snapshot(
        flagged.select(
            "asset_hdr_quote_id", "asset_hdr_id", "quote_status", F.col("terminated").isNotNull().alias("has_asset"),
            F.when(F.col("terminated").isNull(), codes.QUOTE_EXPIRED)
            .when(terminated, codes.QUOTE_TERMINATED)
            .otherwise(F.col("quote_status"))
            .alias("new_status"),
        )
    )
    remaining = judged.where("new_status = quote_status")
    per_asset = remaining.groupBy("asset_hdr_id").agg(
        F.bool_or(F.col("has_asset") & (F.col("quote_status") == codes.QUOTE_RESERVED)).alias("reserved"),
        F.bool_or(F.col("has_asset") & (F.col("quote_status") == codes.QUOTE_QUOTING)).alias("quoting"),
        F.lit(True).alias("has_open"),
    )
    activated = contract.where(F.col("contract_state") == codes.CONTRACT_ACTIVATED).select(
        F.col("contract_id").alias("current_contract_id")
    )
    assets = (
        asset_hdr.select("asset_hdr_id", "asset_status", "current_contract_id")
        .join(activated, "current_contract_id", "left_semi")
        .join(per_asset, "asset_hdr_id", "left")
    )
    busy = F.col("asset_status").isin(codes.ASSET_QUOTING, codes.ASSET_RESERVED)
    active = F.col("asset_status") == codes.ASSET_ACTIVE
    new_status = (
        F.when(busy & F.col("has_open").isNull(), codes.ASSET_ACTIVE)
        .when(active & F.col("reserved"), codes.ASSET_RESERVED)
        .when(active & F.col("quoting"), codes.ASSET_QUOTING)
    )
    assets = assets.withColumn("new_status", new_status).where("new_status IS NOT NULL")
    return _changes(
        judged.where("new_status <> quote_status"), "quote", "asset_hdr_quote_id", "quote_status", F.col("new_status")
    ).unionByName(_changes(assets, "asset", "asset_hdr_id", "asset_status", F.col("new_status")))


# Addresses ---------------------------------------------------------------------------------------

def candidate_addresses(asset_hdr: DataFrame, contract: DataFrame, date: str = "activated_dt") -> DataFrame:
    """The address each asset on a contract should have: its delivery address, else the contract's default."""
    on_contract = asset_hdr.where("current_contract_id > 0").select(
        "asset_hdr_id", "delivery_address_id", F.col("current_contract_id").alias("contract_id")
    )
    details = contract.select("contract_id", "default_asset_address_id", F.col(date).alias("effective_dt"))
    rows = on_contract.join(details, "contract_id")
    chosen = F.when(F.col("delivery_address_id") > 0, F.col("delivery_address_id")).otherwise(F.col("default_asset_address_id"))
    return rows.select("asset_hdr_id", chosen.alias("address_id"), "effective_dt").distinct()


def address_changes(candidates: DataFrame, address: DataFrame) -> DataFrame:
    """Per candidate: whether to update the asset's current address, and whether to insert a dated address row.

    Compared with the latest dated current address. The addresses are reduced to one row per asset and
    address, and then per asset, before they meet the candidates.
    """
    current = address.where(F.col("asset_hdr_address_type") == codes.ADDRESS_CURRENT)
    per_address = current.groupBy("asset_hdr_id", "address_id").agg(F.max("effective_dt").alias("_address_dt"))
    per_asset = per_address.groupBy("asset_hdr_id").agg(F.max("_address_dt").alias("_latest_dt"))
    joined = candidates.join(per_asset, "asset_hdr_id", "left").join(per_address, ["asset_hdr_id", "address_id"], "left")
    keep = (F.col("_address_dt") == F.col("_latest_dt")) | (F.col("_latest_dt") >= F.col("effective_dt"))
    dated = F.col("_latest_dt") == F.col("effective_dt")
    return joined.select(
        "asset_hdr_id", "address_id", "effective_dt",
        F.when(keep, 0).otherwise(1).alias("update_current_address"),
        F.when(dated, 0).otherwise(1).alias("insert_asset_hdr_address"),
    )


def insert_addresses(address: DataFrame, changes: DataFrame) -> ChangeSet:
    """The missing address rows as a change to the address table; their new ids continue after the greatest."""
    wanted = snapshot(changes.where("insert_asset_hdr_address = 1").select("asset_hdr_id", "address_id", "effective_dt"))
    numbered, _ = number_rows(wanted, ["asset_hdr_id", "effective_dt", "address_id"])
    highest = max_key(address, "asset_hdr_address_id")
    rows = numbered.withColumns(
        {
            "asset_hdr_address_id": F.lit(highest) + F.col("row_no"),
            "asset_hdr_address_type": F.lit(codes.ADDRESS_CURRENT),
        }
    ).select(*address.columns)
    return ChangeSet(["asset_hdr_address_id"], address.where("1 = 0"), inserts=rows)


def affected_addresses(affected: DataFrame, contract: DataFrame) -> DataFrame:
    """The address each affected asset should have from its contract's calculation date: its delivery address, else the contract's default.

    `affected` are the rows of `quotes_on_activated_contracts`.
    """
    defaults = contract.select("contract_id", "default_asset_address_id")
    chosen = F.when(F.col("delivery_address_id") > 0, F.col("delivery_address_id")).otherwise(F.col("default_asset_address_id"))
    rows = affected.select("contract_id", "asset_hdr_id", "delivery_address_id", "calc_dt").join(defaults, "contract_id")
    return rows.select("asset_hdr_id", chosen.alias("address_id"), F.col("calc_dt").alias("effective_dt")).distinct()


def write_current_addresses(asset_hdr: DataFrame, changes: DataFrame) -> ChangeSet:
    """The current address of the assets that `address_changes` marks, as a change to the asset table.

    An asset with two addresses to take fails the job.
    """
    wanted = snapshot(changes.where("update_current_address = 1").select("asset_hdr_id", F.col("address_id").alias("current_address_id")))
    return ChangeSet(["asset_hdr_id"], snapshot(semi(asset_hdr, wanted, ["asset_hdr_id"])), updates=wanted)


def address_as_of(address: DataFrame, as_of: str) -> DataFrame:
    """Per asset and address type the address in effect on a date; types without one are absent."""
    known = address.where(F.col("asset_hdr_address_type").isin(*codes.ADDRESS_TYPES))
    return latest_as_of(
        known, ["asset_hdr_id", "asset_hdr_address_type"], "effective_dt", "asset_hdr_address_id", as_of, ["address_id"]
    ).select("asset_hdr_id", "asset_hdr_address_type", "address_id", "effective_dt")


def addresses_at(rows: DataFrame, address: DataFrame, date: str, **options) -> DataFrame:
    """The rows of assets with the current address in effect on each row's date, and since when; NULLs where there is none."""
    current = address.where(F.col("asset_hdr_address_type") == codes.ADDRESS_CURRENT)
    return as_of(rows, current, ["asset_hdr_id"], date, "effective_dt", "asset_hdr_address_id", ["address_id", "effective_dt"], **options)


def asset_address_view(
    asset: DataFrame,
    asset_hdr: DataFrame,
    dated_address: DataFrame,
    asset_type: DataFrame,
    party: DataFrame,
    address: DataFrame,
    vehicle: DataFrame,
    as_of: str,
) -> DataFrame:
    """Contract assets with their current address, and physical assets with each of their addresses, decoded.

    The full address is street, zip code and city joined by commas.
    """
    # Aggregated once, as two branches read it with different filters.
    in_effect = snapshot(address_as_of(dated_address, as_of).select("asset_hdr_id", "asset_hdr_address_type", "address_id"))
    current = in_effect.where(F.col("asset_hdr_address_type") == codes.ADDRESS_CURRENT).select("asset_hdr_id", "address_id")
    details = asset_hdr.select("asset_hdr_id", "name", "model", "asset_type_id", "manufacturer_id", "asset_status")
    on_contract = (
        asset.join(details, "asset_hdr_id")
        .join(current, "asset_hdr_id")
        .select(
            F.lit("contract asset").alias("row_type"), "contract_id", "asset_id", "asset_hdr_id", "name", "model", "asset_type_id",
            "manufacturer_id", "asset_status", F.lit(0).alias("asset_hdr_address_type"), "address_id",
        )
    )
    contract_id = F.when(F.col("current_contract_id") > 0, F.col("current_contract_id")).otherwise(F.col("original_contract_id"))
    physical = (
        asset_hdr.where("asset_hdr_id > 0")
        .join(in_effect, "asset_hdr_id")
        .select(
            F.lit("physical asset").alias("row_type"), contract_id.alias("contract_id"), F.lit(0).cast("bigint").alias("asset_id"),
            "asset_hdr_id", "name", "model", "asset_type_id", "manufacturer_id", "asset_status", "asset_hdr_address_type", "address_id",
        )
    )
    rows = on_contract.unionByName(physical)
    places = address.select("address_id", F.concat_ws(", ", "street", "zip_code", "city").alias("full_address"))
    return (
        rows.join(asset_type.select("asset_type_id", F.col("name").alias("asset_type_name")), "asset_type_id")
        .join(party.select(F.col("party_id").alias("manufacturer_id"), F.col("name").alias("manufacturer")), "manufacturer_id")
        .join(places, "address_id")
        .join(vehicle.select("asset_hdr_id", "registration_no"), "asset_hdr_id", "left")
        .select(
            "row_type", "address_id", "contract_id", "asset_id", "asset_hdr_id", "name", "full_address", "asset_type_name",
            "manufacturer", "model", "asset_type_id", "asset_status", "registration_no", "asset_hdr_address_type",
        )
    )


# Hierarchy, gaps, revisions ----------------------------------------------------------------------

def hierarchy_descendants(asset_hdr: DataFrame) -> DataFrame:
    """All (root, descendant) pairs of the asset hierarchy."""
    return ancestor_pairs(asset_hdr, "asset_hdr_id", "owner_id")


def contracts_missing_assets(contract: DataFrame, asset_hdr: DataFrame, asset: DataFrame, as_of: str) -> DataFrame:
    """Activated, unmatured contracts of a physical asset that has no asset row."""
    missing = anti(asset_hdr, asset, ["asset_hdr_id"])
    ids = (
        missing.select(F.col("current_contract_id").alias("contract_id"))
        .union(missing.select("original_contract_id"))
        .distinct()
    )
    wanted = contract.where((F.col("mature_dt") > F.lit(as_of).cast("date")) & (F.col("contract_state") == codes.CONTRACT_ACTIVATED))
    return wanted.join(ids, "contract_id", "left_semi")


def latest_revision_rows(
    alteration: DataFrame, restructure: DataFrame, fields: tuple[int, ...], objects: DataFrame | None = None
) -> DataFrame:
    """Alteration rows of the latest restructure of their contract, for the given fields and, if given, objects.

    The latest restructure is that of the restructure table: one without alterations has no rows, and those of the
    restructures before it stay out.
    """
    latest = restructure.groupBy("contract_id").agg(F.max("contract_restructure_id").alias("contract_restructure_id"))
    rows = alteration.where(F.col("fld_id").isin(*fields))
    if objects is not None:
        rows = semi(rows, objects, ["obj_id"])
    return rows.join(latest, ["contract_id", "contract_restructure_id"], "left_semi")
