"""Audit rows from two versions of a table, and the rows of an earlier time from audit rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkledger import codes
from sparkledger.functions.scalar import required
from sparkledger.operators.keys import number_rows
from sparkledger.session import snapshot

# Change codes by name.
CHANGE = {name: code for code, name in codes.AUDIT_CHANGES.items()}
INSERT, UPDATE, DELETE = CHANGE["Insert"], CHANGE["Update"], CHANGE["Delete"]
# Types whose text cannot be read back.
NO_TEXT = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


@dataclass(frozen=True)
class Audit:
    """Audit rows: a header per changed row, its key columns, and its changed fields, with values as text."""

    header: DataFrame  # audit_hdr_id, audit_dt, change_type, user_id, tbl_name
    key: DataFrame  # audit_hdr_id, fld_name, old_fld_value, new_fld_value
    field: DataFrame  # the same columns

    def union(self, other: "Audit") -> "Audit":
        """The rows of both; their header ids must differ."""
        return Audit(self.header.unionByName(other.header), self.key.unionByName(other.key), self.field.unionByName(other.field))


def _readable(table: DataFrame) -> None:
    refused = [f.name for f in table.schema.fields if isinstance(f.dataType, NO_TEXT)]
    if refused:
        raise ValueError(f"no text that can be read back: {', '.join(refused)}")


def _told(name: str, old: Column, new: Column) -> Column:
    return F.struct(F.lit(name).alias("fld_name"), old.cast("string").alias("old_fld_value"), new.cast("string").alias("new_fld_value"))


def audit_rows(before: DataFrame, after: DataFrame, pk: list[str], table: str, as_of: str, user_id: int, highest: int = 0) -> Audit:
    """The difference between two versions of a table as audit rows, numbered after `highest` in the order of the key.

    Updates list the columns that differ (NULL is a value like others), inserts and deletes all columns that are not NULL.
    Both versions have the same columns and one row per key; a NULL in the key fails the job. The versions are joined once
    and only changed rows are stored.
    """
    _readable(after)
    values = [c for c in after.columns if c not in pk]

    def side(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.select(*[required(k, f"key {k}").alias(k) for k in pk], F.lit(True).alias(f"{prefix}here"), *[F.col(c).alias(f"{prefix}{c}") for c in values])

    differs = F.lit(False)
    for c in values:
        differs = differs | ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    kind = F.when(F.col("_old_here").isNull(), INSERT).when(F.col("_new_here").isNull(), DELETE).when(differs, UPDATE)
    pairs = side(before, "_old_").join(side(after, "_new_"), pk, "full").withColumn("change_type", kind)
    changed = snapshot(pairs.where("change_type IS NOT NULL"))
    numbered, _ = number_rows(changed, pk)
    rows = numbered.withColumn("audit_hdr_id", F.lit(highest) + F.col("row_no"))

    header = rows.select(
        "audit_hdr_id", F.lit(as_of).cast("timestamp_ntz").alias("audit_dt"), "change_type", F.lit(user_id).cast("bigint").alias("user_id"), F.lit(table).alias("tbl_name")
    )
    was, is_now = F.col("change_type") != INSERT, F.col("change_type") != DELETE
    keys = F.array(*[_told(k, F.when(was, F.col(k)), F.when(is_now, F.col(k))) for k in pk])
    fields = F.array(*[F.when(~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}")), _told(c, F.col(f"_old_{c}"), F.col(f"_new_{c}"))) for c in values])
    told = rows.select("audit_hdr_id", F.explode(F.array_compact(fields)).alias("_told")) if values else rows.where("1 = 0").select("audit_hdr_id", F.explode(keys).alias("_told"))
    return Audit(
        header=header,
        key=rows.select("audit_hdr_id", F.explode(keys).alias("_told")).select("audit_hdr_id", "_told.*"),
        field=told.select("audit_hdr_id", "_told.*"),
    )


def rows_at(current: DataFrame, audit: Audit, pk: list[str], table: str, at: str) -> DataFrame:
    """The table as it was at a time: every change after it is taken back.

    A row's columns are the old values of the first later change that names them, else the present ones; a row whose
    first later change is its insert did not exist yet, and one whose first later change is an update or its delete did.
    The first change of each row and column is a minimum, so that tasks reduce the history of a row that changes often
    before it is shuffled. Only changes of kind insert, update and delete count.
    """
    _readable(current)
    kinds = {f.name: f.dataType for f in current.schema.fields}
    values = [c for c in current.columns if c not in pk]
    later = audit.header.where((F.col("tbl_name") == table) & F.col("change_type").isin(INSERT, UPDATE, DELETE) & (F.col("audit_dt") > F.lit(at).cast("timestamp_ntz")))
    later = later.select("audit_hdr_id", "audit_dt", "change_type")
    # A header has one key row per key column.
    named = audit.key.join(later, "audit_hdr_id").groupBy("audit_hdr_id").agg(
        F.any_value("audit_dt").alias("audit_dt"), F.any_value("change_type").alias("change_type"),
        *[F.max(F.when(F.col("fld_name") == k, F.coalesce("old_fld_value", "new_fld_value"))).cast(kinds[k]).alias(k) for k in pk],
    )
    named = snapshot(named.withColumn("_order", F.struct("audit_dt", "audit_hdr_id")))
    first = named.groupBy(*pk).agg(F.min_by("change_type", "_order").alias("_first"))
    fields = audit.field.join(named.select("audit_hdr_id", "_order", *pk), "audit_hdr_id")
    oldest = fields.groupBy(*pk, "fld_name").agg(F.min_by("old_fld_value", "_order").alias("_value"))
    # As many entries as the table has columns.
    per_row = oldest.groupBy(*pk).agg(F.map_from_entries(F.collect_list(F.struct("fld_name", "_value"))).alias("_was"))
    undo = first.join(per_row, pk, "left")

    beside = current.withColumn("_here", F.lit(True)).join(undo, pk, "full")
    existed = F.when(F.col("_first").isNull(), F.col("_here")).otherwise(F.col("_first") != INSERT)
    named_in = lambda c: F.coalesce(F.map_contains_key("_was", F.lit(c)), F.lit(False))
    return beside.where(existed).select(
        *[F.when(named_in(c), F.try_element_at("_was", F.lit(c)).cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in current.columns]
    )
