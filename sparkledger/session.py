"""Session settings the jobs rely on, and snapshots in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Temporary folders of local-mode sessions by application id; they go when the process ends.
_LOCAL_FOLDERS: dict[str, tempfile.TemporaryDirectory] = {}

# Runtime SQL settings. Joins carry no broadcast hints: Spark broadcasts a side only when its measured
# size is under the threshold, and adaptive execution splits the partitions of hot keys.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where that costs the next operator a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for snapshots: `spark.checkpoint.dir` of the session.

    A local-mode session without that setting gets a temporary folder. On a cluster the setting is
    required, because a machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    # Not `local-cluster`: its executors are processes of their own.
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.conf.get("spark.app.id")
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.TemporaryDirectory(prefix="sparkledger-", ignore_cleanup_errors=True)
    return _LOCAL_FOLDERS[application].name


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def snapshot(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, keeps what it has read even if the source changes, and gives
    Spark the true size, so that small snapshots are broadcast in later joins and large ones are not.
    """
    path = new_folder(df.sparkSession, "snapshot")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
