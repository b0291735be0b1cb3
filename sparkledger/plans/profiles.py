"""Column profiles that merge: a new part of a table is profiled by its own rows, and united with what is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkledger.functions.scalar import row_count

# Sketches have 2^14 registers: the relative standard error of a distinct count is about 0.8 %, at 16 KB a column.
SKETCH_BITS = 14
# What a sketch takes as it is; other types go in as text.
SKETCHED = (T.IntegerType, T.LongType, T.StringType)


def _sketchable(column: str, kind: T.DataType) -> Column:
    return F.col(column) if isinstance(kind, SKETCHED) else F.col(column).cast("string")


def profile(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: `n_rows`, and for each column a struct of present values, least, greatest and a sketch of the distinct ones.

    One pass without a distinct aggregate, so that rows are not multiplied. Of no rows the values are NULL and counts 0.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    measured = [
        F.struct(
            F.count(c).alias("n_values"), F.min(c).alias("least"), F.max(c).alias("greatest"),
            F.hll_sketch_agg(_sketchable(c, kinds[c]), SKETCH_BITS).alias("sketch"),
        ).alias(c)
        for c in columns
    ]
    return rows.agg(row_count().alias("n_rows"), *measured)


def merge(profiles: DataFrame) -> DataFrame:
    """Profiles of parts of a table, one row each, as the profile of the whole table. Parts must not share rows."""
    columns = [c for c in profiles.columns if c != "n_rows"]
    merged = [
        F.struct(
            F.coalesce(F.sum(f"{c}.n_values"), F.lit(0)).cast("bigint").alias("n_values"), F.min(f"{c}.least").alias("least"),
            F.max(f"{c}.greatest").alias("greatest"), F.hll_union_agg(f"{c}.sketch").alias("sketch"),
        ).alias(c)
        for c in columns
    ]
    return profiles.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"), *merged)


def report(table: str, profiled: DataFrame) -> DataFrame:
    """A profile as rows: table, column, row and null counts, value range as text, and the estimated number of distinct values."""
    columns = [c for c in profiled.columns if c != "n_rows"]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"), F.col("n_rows"), (F.col("n_rows") - F.col(f"{c}.n_values")).alias("n_nulls"),
            F.col(f"{c}.least").cast("string").alias("min_value"), F.col(f"{c}.greatest").cast("string").alias("max_value"),
            F.hll_sketch_estimate(f"{c}.sketch").alias("n_distinct_estimate"),
        )
        for c in columns
    ]
    return profiled.select(F.lit(table).alias("table_name"), F.inline(F.array(*lines)))
