"""One change over several tables, which switch together or not at all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger.operators.changeset import ChangeSet
from sparkledger.sources.tables import log_event, write_version

MANIFEST = "manifest"


@dataclass(frozen=True)
class Posting:
    """Change sets by table name."""

    changes: dict[str, ChangeSet]

    def apply(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """All tables after the posting; those without a change as they are."""
        return {name: self.changes[name].apply(table) if name in self.changes else table for name, table in tables.items()}

    def revert(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """All tables without the posting, by the change sets' three-way merge."""
        return {name: self.changes[name].revert(table) if name in self.changes else table for name, table in tables.items()}

    def conflicts(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """For each changed table what a revert would leave as it is."""
        return {name: change.conflicts(tables[name]) for name, change in self.changes.items()}

    def save(self, folder: str) -> "Posting":
        """Write all change sets below a folder and return the posting that reads them from there."""
        return Posting({name: change.save(f"{folder}/{name}") for name, change in self.changes.items()})

    def publish(self, tables: dict[str, DataFrame], folder: str, version: str, log: str, as_of: str, user_id: int, back: bool = False) -> None:
        """Write a new version of every changed table, then the manifest that makes all of them current.

        Until the manifest is written readers see the tables of before, so that a run that fails half-way changes
        nothing; it is repeated under another version name. `tables` has all tables of the folder.
        """
        spark = next(iter(tables.values())).sparkSession
        results = (self.revert if back else self.apply)(tables)
        for name in sorted(self.changes):
            write_version(results[name], folder, name, version)
        switch(spark, folder, dict.fromkeys(self.changes, version))
        # The event kinds of script runs.
        kind, verb = ("Script Revert", "Reverted") if back else ("Script Run", "Ran")
        log_event(spark, log, as_of, kind, f"{verb}: {', '.join(sorted(self.changes))} to version {version}", user_id)


def switch(spark: SparkSession, folder: str, versions: dict[str, str]) -> None:
    """Write the next manifest: the given tables at new versions, all others as they were. One file, so it is there whole or not."""
    number, known = current_versions(spark, folder)
    rows = [(number + 1, name, version) for name, version in sorted({**known, **versions}.items())]
    frame = spark.createDataFrame(rows, "number long, table_name string, version string")
    frame.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/{MANIFEST}/number={number + 1}")


def current_versions(spark: SparkSession, folder: str) -> tuple[int, dict[str, str]]:
    """Number of the latest manifest (0 if there is none) and its versions by table name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFEST}")
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return 0, {}
    # The rows carry the number; the folder's own would be read as a column of the same name.
    found = spark.read.option("recursiveFileLookup", "true").schema("number long, table_name string, version string").parquet(f"{folder}/{MANIFEST}")
    latest = found.agg(F.max("number").alias("n")).first()["n"] or 0
    return latest, {r["table_name"]: r["version"] for r in found.where(F.col("number") == latest).collect()}


def current_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a folder at the versions of its latest manifest."""
    return {name: spark.read.parquet(f"{folder}/{name}/version={version}") for name, version in current_versions(spark, folder)[1].items()}
