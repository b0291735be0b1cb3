"""Parquet tables in a folder, and new versions of them.

Data files are immutable: a job never overwrites the folder it reads. It writes its result to a new
folder, and the caller switches over once the checks on the new version pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def empty_like(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """An empty frame with the schema of `df`, plus optional extra columns."""
    schema = T.StructType(list(df.schema.fields))
    for name, kind in (extra or {}).items():
        schema = schema.add(name, kind)
    return df.sparkSession.createDataFrame([], schema)


def write_version(df: DataFrame, folder: str, name: str, version: str) -> str:
    """Write a new version of a table; fails if that version exists."""
    path = f"{folder}/{name}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Save as a catalog table bucketed and sorted by a key.

    Tables that are joined again and again on the same key, such as flows, tax lines and matches on the flow,
    then join and aggregate on it without a shuffle, provided they have the same number of buckets.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a dataset."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def log_event(spark: SparkSession, path: str, as_of: str, kind: str, description: str, user_id: int) -> None:
    """Append one row to the event log dataset."""
    row = spark.range(1).select(
        F.lit(kind).alias("event_type"),
        F.to_timestamp(F.lit(as_of)).alias("input_dt"),
        F.lit(description).alias("description"),
        F.lit(0).alias("process_category"),
        F.lit("Script").alias("src_app_name"),
        F.lit(user_id).alias("src_user_id"),
        F.lit(" ").alias("src_machine_name"),
        F.lit(0).alias("stamp"),
    )
    append_rows(row, path)


def write_text(statements: DataFrame, path: str) -> None:
    """Write a one-column frame as text lines."""
    statements.write.mode("errorifexists").text(path)
