"""Finding and counting: columns by name, rows per table, texts that mention a name."""

from __future__ import annotations

import fnmatch
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sparkledger.functions.scalar import contains_ignore_case, row_count


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def profile_columns(tables: dict[str, DataFrame], pattern: str) -> DataFrame:
    """Columns whose name matches a pattern (with * and ?), with row, null and distinct counts and the value range.

    One aggregate per table covers all its matching columns.
    """
    parts = []
    for table, df in tables.items():
        names = [c for c in df.columns if fnmatch.fnmatch(c.lower(), pattern.lower())]
        if not names:
            continue
        measured = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(c).alias(f"count_{c}") for c in names],
            *[F.min(c).cast("string").alias(f"min_{c}") for c in names],
            *[F.max(c).cast("string").alias(f"max_{c}") for c in names],
            *[F.count_distinct(c).alias(f"distinct_{c}") for c in names],
        )
        lines = [
            F.struct(
                F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), (F.col("n") - F.col(f"count_{c}")).alias("n_nulls"),
                F.col(f"min_{c}").alias("min_value"), F.col(f"max_{c}").alias("max_value"), F.col(f"distinct_{c}").alias("n_distinct"),
            )
            for c in names
        ]
        parts.append(measured.select(F.lit(table).alias("table_name"), F.inline(F.array(*lines))))
    if not parts:
        raise ValueError(f"no column matches {pattern}")
    return _union(parts)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact number of rows per table."""
    return _union([df.agg(row_count().alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()])


def find_references(texts: DataFrame, name: str, text: str, needle: str) -> DataFrame:
    """Distinct names of the objects whose whole text contains the needle, in either case."""
    return texts.where(contains_ignore_case(text, needle)).select(name).distinct()
