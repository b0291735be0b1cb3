"""Time columns: normalisation, and telling UTC from local time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkledger.functions import scalar as S


def normalise_times(table: DataFrame, key: str, ts: Column, zone: Column) -> DataFrame:
    """Date-only forms, added units, boundary differences and zone conversions of a UTC time, side by side."""
    rows = table.select(key, ts.cast("timestamp").alias("ts"), zone.alias("zone"))
    later = S.add_units("MINUTE", 95, F.col("ts"))
    return rows.select(
        key,
        S.date_only("ts").alias("date_only"),
        S.day_start("ts").cast("timestamp_ntz").alias("day_start"),
        S.add_units("HOUR", 1, F.col("ts")).cast("timestamp_ntz").alias("plus_hour"),
        S.add_units("DAY", 2, F.col("ts")).cast("timestamp_ntz").alias("plus_two_days"),
        S.boundary_diff("HOUR", F.col("ts"), later).alias("hour_boundaries"),
        S.boundary_diff("DAY", F.col("ts"), later).alias("day_boundaries"),
        S.format_compact("ts").alias("compact_date"),
        S.format_long("ts").alias("long_text"),
        "zone",
        S.to_local(F.col("ts"), F.col("zone")).cast("timestamp_ntz").alias("local_time"),
        S.local_day_start_utc(F.col("ts"), F.col("zone")).cast("timestamp_ntz").alias("local_day_start_utc"),
    )


def classify_time_columns(table: DataFrame, reference: str, columns: list[str]) -> DataFrame:
    """Most frequent offset in hours of each time column from a reference column known to be UTC.

    Offset 0 means UTC, any other a local time. Ties go to the smaller offset. Rows are counted per
    (column, offset) first, so that the final choice sees only the few distinct offsets.
    """
    offsets = [
        F.struct(F.lit(c).alias("column_name"), S.boundary_diff("HOUR", F.col(reference), F.col(c)).alias("offset_hours"))
        for c in columns
    ]
    counted = (
        table.select(F.inline(F.array(*offsets)))
        .where("offset_hours IS NOT NULL")
        .groupBy("column_name", "offset_hours")
        .agg(S.row_count().alias("n_rows"))
    )
    best = counted.groupBy("column_name").agg(
        F.max(F.struct("n_rows", (-F.col("offset_hours")).alias("negated"))).alias("best"), F.sum("n_rows").cast("bigint").alias("n_total")
    )
    offset = -F.col("best.negated")
    return best.select(
        "column_name", offset.alias("offset_hours"), F.col("best.n_rows").alias("n_rows"), "n_total",
        F.when(offset == 0, "UTC").otherwise("local").alias("clock"),
    )


def latest_times(table: DataFrame, key: str, columns: list[str], as_of: str, zone: str) -> DataFrame:
    """Time columns of the row with the greatest key, next to the clock in UTC and in the local zone."""
    now = F.lit(as_of).cast("timestamp")
    return (
        table.orderBy(F.col(key).desc())
        .limit(1)
        .select(
            S.to_local(now, F.lit(zone)).cast("timestamp_ntz").alias("local_clock"),
            now.cast("timestamp_ntz").alias("utc_clock"),
            *[F.col(c).cast("timestamp_ntz").alias(c) for c in columns],
        )
    )
