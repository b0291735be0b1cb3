"""Retention on tables that are stored by month: whole months leave, and only the month of the cutoff is read."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from sparkledger.session import snapshot

PERIOD = "period"
# The folder of rows that never expire by age.
KEPT = "__HIVE_DEFAULT_PARTITION__"


def last_date(dates: tuple[str, ...]) -> Column:
    """The latest of a row's dates; NULL if one is missing, as such rows stay."""
    missing = F.lit(False)
    for date in dates:
        missing = missing | F.col(date).isNull()
    latest = F.greatest(*dates) if len(dates) > 1 else F.col(dates[0])
    return F.when(~missing, latest.cast("date"))


def write_dated(rows: DataFrame, path: str, dates: tuple[str, ...], nonzero: tuple[str, ...] = ()) -> None:
    """Store rows by the month of their latest date (YYYYMM). Rows without one, and those whose id in `nonzero` is 0, never expire."""
    system = F.lit(False)
    for key in nonzero:
        system = system | F.coalesce(F.col(key) == 0, F.lit(True))
    month = F.when(~system, F.date_format(last_date(dates), "yyyyMM").cast("int"))
    # Adaptive execution splits a month that holds much of the table by its size, and puts small months together.
    rows.withColumn(PERIOD, month).hint("rebalance", F.col(PERIOD)).write.mode("errorifexists").partitionBy(PERIOD).parquet(path)


def _cutoff(as_of: str, days: int) -> datetime.date:
    return datetime.date.fromisoformat(as_of) - datetime.timedelta(days=days)


def _month(day: datetime.date) -> int:
    return day.year * 100 + day.month


def read_dated(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored rows with their month. With the schema of the rows, a table whose months have all left is read as well."""
    fields = [f for f in schema.fields if f.name != PERIOD]
    return spark.read.schema(StructType(fields).add(PERIOD, IntegerType())).parquet(path)


def expired(stored: DataFrame, dates: tuple[str, ...], as_of: str, days: int) -> DataFrame:
    """Rows all of whose dates are before the cutoff; months after it are not read (a partition filter)."""
    cutoff = _cutoff(as_of, days)
    border = _month(cutoff)
    return stored.where((F.col(PERIOD) <= border) & ((F.col(PERIOD) < border) | (last_date(dates) < F.lit(cutoff))))


def drop_expired(spark: SparkSession, path: str, schema: StructType, dates: tuple[str, ...], as_of: str, days: int) -> list[int]:
    """Remove the expired rows of a stored table; returns the months that left as a whole.

    Months before that of the cutoff leave without being read. The month of the cutoff is written anew by dynamic
    partition overwrite, from a snapshot of what stays. All other months keep their files. Only the names of months come
    to the driver. A run that fails half-way is repeated: what has left stays away, and what stays is the same.
    """
    cutoff = _cutoff(as_of, days)
    border = _month(cutoff)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    months = {}
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{PERIOD}=") and not name.endswith(KEPT):
            months[int(name.split("=")[1])] = status.getPath()
    if border in months:
        stays = snapshot(read_dated(spark, path, schema).where((F.col(PERIOD) == border) & (last_date(dates) >= F.lit(cutoff))))
        if stays.isEmpty():
            files.delete(months[border], True)
        else:
            stays.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(path)
    gone = sorted(month for month in months if month < border)
    for month in gone:
        files.delete(months[month], True)
    return gone
