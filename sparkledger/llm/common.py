"""What the text operators share: session settings, document keys, stored intermediates, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkledger.session import configure, new_folder

# Rows of an Arrow batch. Texts are long, so that batches of the default 10,000 rows would take much memory.
BATCH_ROWS = 256

TEXT_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    # A join of all texts with a list of chosen ids first drops most other texts by a Bloom filter of at most 8 MB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


# How this worker process lets go of what it keeps from task to task, by the operator that it is kept for.
_KEPT: dict[str, Callable[[], None]] = {}


def serve(operator: str, let_go: Callable[[], None] | None = None) -> None:
    """Note that this worker process serves `operator`, and let go of what it keeps for others.

    Workers outlive the stages that they serve; what they keep would stay in an executor's memory beside the work of the
    next operators. `let_go` drops what is kept for this one.
    """
    for other in _KEPT.keys() - {operator}:
        _KEPT.pop(other)()
    if let_go:
        _KEPT[operator] = let_go


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that the text operators rely on."""
    configure(spark)
    for key, value in TEXT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back, so that it is neither computed twice nor lost with an executor."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the operators read, under fixed names; all others are ignored, whatever they are called."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def bodies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`documents` with the text as UTF-8 bytes, null as empty."""
    return documents(docs, id_col, text_col).select(
        "doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body")
    )


def key_of(id_column: str = "doc_id") -> Column:
    """A join key that is never null; joins on it also compare the ids themselves, with null equal to null."""
    return F.xxhash64(F.col(id_column))


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z only. Spark's `lower` does that for ASCII texts; others go letter by letter."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length(column) == F.char_length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, upper, upper.lower()))


def in_batches(columns: Iterator[tuple], schema: pa.Schema, rows: int = BATCH_ROWS, size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most `rows` tuples, cut earlier once their binary values exceed `size` bytes."""
    held, weight = [], 0
    for row in columns:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= rows or weight >= size:
            yield record_batch(held, schema)
            held, weight = [], 0
    if held:
        yield record_batch(held, schema)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows), schema)], schema=schema)


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
