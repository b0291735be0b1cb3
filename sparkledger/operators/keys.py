"""Dense surrogate keys in the order of an existing unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkledger.session import snapshot

# Position inside a partition, in the low bits of a monotonically increasing id.
POSITION_BITS = 33


def number_rows(rows: DataFrame, order: list[str], number: str = "row_no") -> tuple[DataFrame, int]:
    """Number the rows 1..n by a unique sort key; returns the numbered snapshot and n.

    `row_number()` over the whole table would move it through one task. Instead the rows are range
    partitioned and sorted, which gives each its position inside its partition, and written out, which
    fixes the positions for good (also when executors are lost). The partition sizes then give the
    offset of each partition. Only those sizes, one per partition, come to the driver. The input is read
    twice, so pass a stored frame rather than a long computation.
    """
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    placed = snapshot(placed)
    part = F.shiftright("_position", POSITION_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {size["part"]: size["n"] for size in sizes}
    starts, total = [], 0
    for index in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(index, 0)
    # One number per partition, as a literal array: no join, so Spark still knows the size of the result.
    offsets = F.expr(f"array({', '.join(f'{start}L' for start in starts)})")
    inside = F.col("_position").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    row_no = F.element_at(offsets, (part + 1).cast("int")) + inside + 1
    return placed.select(*rows.columns, row_no.alias(number)), total


def sorted_rows(rows: DataFrame, order: list[str], part_rows: int = 250_000) -> DataFrame:
    """The rows in ascending order, in as many ranges as they need at `part_rows` each.

    A task sorts one range, so that its memory does not grow with the table, whatever number of shuffle partitions the
    session has. The rows are read for their number and again for the ranges' borders; only the number comes to the driver.
    """
    parts = max(1, -(-rows.count() // part_rows))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def max_key(table: DataFrame, key: str) -> int:
    """Greatest key in use, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]


def next_numbers(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Counter rows (table_name, next_no): greatest key of each table plus 1."""
    counters = [
        table.agg((F.coalesce(F.max(key), F.lit(0)) + 1).cast("bigint").alias("next_no")).select(
            F.lit(name).alias("table_name"), "next_no"
        )
        for name, (table, key) in tables.items()
    ]
    result = counters[0]
    for counter in counters[1:]:
        result = result.unionByName(counter)
    return result
