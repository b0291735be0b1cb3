"""Retention steps, update-only merge, distinct copy, backups, backfill of child rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger.operators.joins import anti
from sparkledger.operators.retention import Parent, PurgeStep
from sparkledger.operators.updates import update_from
from sparkledger.sources.tables import append_rows, empty_like

_NOTE = Parent("note", "note_id", "note_id")
_DOC_OF_NOTE = Parent("doc", "doc_id", "doc_id")
_NOTE_DATES = ("activity_dt", "last_updated_dt")
_DOC_DATES = ("effect_dt", "created_dt", "released_dt", "output_dt", "rejected_dt")

# The purge steps of the core tables, children before parents.
RETENTION_STEPS = [
    PurgeStep("event_log", ("input_dt",)),
    PurgeStep("grid_queue", ("input_dt",)),
    PurgeStep("aii_event_queue_response", ("end_dt",), (Parent("aii_event_queue_history", "history_id", "history_id"),)),
    PurgeStep("contract_write_off", ("input_dt", "calc_dt")),
    PurgeStep("event_queue", ("input_dt",)),
    PurgeStep("workflow_task_todo", ("completion_date",)),
    PurgeStep("contract_write_off", _NOTE_DATES, (_NOTE,)),
    PurgeStep("note_attachment", _NOTE_DATES, (_NOTE,)),
    PurgeStep("note", _NOTE_DATES),
    PurgeStep("bank_interface_run_temp", ("run_dt",), (Parent("bank_interface_run", "run_id", "run_id"),)),
    PurgeStep("calculation_log", ("calc_end_dt",)),
    PurgeStep("asset_balance", ("input_dt", "effective_dt")),
    PurgeStep("doc_list", _DOC_DATES, (_DOC_OF_NOTE,), dated_nonzero=("doc_id",)),
    PurgeStep("doc_link", _DOC_DATES, (_DOC_OF_NOTE,), nonzero=("doc_link_id",), dated_nonzero=("doc_id",)),
    PurgeStep("contract_write_off", _DOC_DATES, (_NOTE, _DOC_OF_NOTE), dated_nonzero=("doc_id",)),
    PurgeStep("note_attachment", _DOC_DATES, (_NOTE, _DOC_OF_NOTE), dated_nonzero=("doc_id",)),
    PurgeStep("note", _DOC_DATES, (_DOC_OF_NOTE,), dated_nonzero=("doc_id",)),
    PurgeStep("doc", _DOC_DATES, nonzero=("doc_id",)),
]


def merge_matched(target: DataFrame, source: DataFrame, pk: list[str], columns: list[str]) -> DataFrame:
    """MERGE with only WHEN MATCHED: matched rows take the source's columns, NULLs included."""
    return update_from(target, source.select(*pk, *columns), pk)


def copy_distinct(source: DataFrame, columns: dict, target: DataFrame) -> DataFrame:
    """The target with the distinct projection of the source appended; columns are name -> expression."""
    rows = source.select(*[expression.cast(target.schema[name].dataType).alias(name) for name, expression in columns.items()])
    return target.unionByName(rows.distinct())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset is there, on whatever file system the path names."""
    try:
        spark.read.parquet(path)
        return True
    except Exception as error:  # AnalysisException of the classic and the remote client
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise


def rotate_backup(rows: DataFrame, folder: str, name: str, version: str, previous: str | None, as_of: str) -> DataFrame:
    """Write `rows` as the new backup version; the previous one moves to the archive first.

    The archive keeps each archived row with the time of the rotation, each version in a folder of its own: a run
    that failed half-way can be repeated, and archives nothing twice. The previous version stays on disk until
    `drop_archived` removes it; readers use the newest version only. Returns the archive.
    """
    spark = rows.sparkSession
    archive = f"{folder}/{name}_archive"
    stamp = F.lit(as_of).cast("timestamp_ntz").alias("save_dt")
    if not path_exists(spark, f"{archive}/start"):
        append_rows(empty_like(rows, {"save_dt": "timestamp_ntz"}), f"{archive}/start")
    if previous is not None and path_exists(spark, f"{folder}/{name}/version={previous}"):
        old = spark.read.parquet(f"{folder}/{name}/version={previous}").select("*", stamp)
        old.write.mode("overwrite").parquet(f"{archive}/of-{previous}")
    rows.write.mode("errorifexists").parquet(f"{folder}/{name}/version={version}")
    return spark.read.option("recursiveFileLookup", "true").parquet(archive)


def drop_archived(spark: SparkSession, folder: str, name: str, version: str) -> None:
    """Remove a backup version from disk, once the archive holds all of its rows. A version that is gone already is no error."""
    path = f"{folder}/{name}/version={version}"
    if not path_exists(spark, path):
        return
    copy = f"{folder}/{name}_archive/of-{version}"
    if not path_exists(spark, copy) or spark.read.parquet(copy).count() != spark.read.parquet(path).count():
        raise RuntimeError(f"version {version} of {name} is not in the archive")
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(location, True)


def backfill_children(parents: DataFrame, child: DataFrame, key: str, kind_column: str, kind: int, defaults: dict) -> DataFrame:
    """Default child rows for the parents that have none of the given kind."""
    missing = anti(parents.select(key).distinct(), child.where(F.col(kind_column) == kind), [key])
    return missing.select(key, F.lit(kind).alias(kind_column), *[value.alias(name) for name, value in defaults.items()])
