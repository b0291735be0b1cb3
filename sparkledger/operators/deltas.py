"""Stored sums per key that move by the rows of a change, instead of being computed again from the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkledger.functions.scalar import MONEY_TOTAL, row_count
from sparkledger.operators.changeset import ChangeSet
from sparkledger.operators.joins import semi
from sparkledger.session import snapshot


def _known(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a whole key; others belong to no sum."""
    return rows.dropna(subset=keys)


def sums(table: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """(keys, `n_rows`, measures): rows and sums per key of a whole table. NULL counts as 0, rows without a key are left out."""
    totals = [F.sum(F.coalesce(F.col(m), F.lit(0))).cast(MONEY_TOTAL).alias(m) for m in measures]
    return _known(table, keys).groupBy(*keys).agg(row_count().alias("n_rows"), *totals)


def deltas(change: ChangeSet, keys: list[str], measures: list[str]) -> DataFrame:
    """What a change adds to the rows and sums of each key; keys on which nothing moves are absent.

    Only the change's own rows are read: old rows count minus, new rows plus. A row whose key changes leaves one sum and
    joins another. Tasks reduce their share of a key before the shuffle, so that a key may hold any number of the rows.
    """
    rows = _known(change.rows(), keys)
    sign = F.when(F.col("op").isin("delete", "update_before"), F.lit(-1)).otherwise(F.lit(1))
    moved = rows.groupBy(*keys).agg(
        F.sum(sign).cast("bigint").alias("n_rows"),
        *[F.sum(F.coalesce(F.col(m), F.lit(0)) * sign).cast(MONEY_TOTAL).alias(m) for m in measures],
    )
    return moved.where(" OR ".join(f"`{c}` <> 0" for c in ("n_rows", *measures)))


def sum_change(stored: DataFrame, moved: DataFrame, keys: list[str], measures: list[str]) -> ChangeSet:
    """The deltas as a change to the stored sums: keys that are new come in, keys without rows go.

    A key that would have fewer than no rows fails the job: then the sums are not those of the table before the change.
    """
    moved = snapshot(moved)
    before = snapshot(semi(stored, moved, keys))
    values = ["n_rows", *measures]
    old = before.select(*keys, F.lit(True).alias("_old"), *[F.col(c).alias(f"_{c}") for c in values])
    summed = moved.join(old, keys, "left").select(
        *keys, F.coalesce("_old", F.lit(False)).alias("_old"),
        *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).cast(stored.schema[c].dataType).alias(c) for c in values],
    )
    checked = F.when(F.col("n_rows") < 0, F.raise_error(F.lit(f"stored sums of {', '.join(keys)} do not belong to the table"))).otherwise(F.col("n_rows"))
    after = snapshot(summed.withColumn("n_rows", checked.cast("bigint")))
    return ChangeSet(
        keys,
        before,
        updates=after.where("_old AND n_rows > 0").drop("_old"),
        inserts=after.where("NOT _old AND n_rows > 0").select(*stored.columns),
        deletes=after.where("_old AND n_rows = 0").select(*keys),
    )


def move_sums(stored: DataFrame, change: ChangeSet, keys: list[str], measures: list[str]) -> ChangeSet:
    """The change to stored sums that follows from a change to their table."""
    return sum_change(stored, deltas(change, keys, measures), keys, measures)
