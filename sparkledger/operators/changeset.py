"""A change to a table that owns the snapshot needed to undo it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkledger.operators.joins import split_possible
from sparkledger.operators.updates import update_from
from sparkledger.session import new_folder
from sparkledger.sources.tables import log_event, write_version

PARTS = ("before", "updates", "inserts", "deletes")


@dataclass(frozen=True)
class ChangeSet:
    """Updates, inserts and deletes of one table, with the affected rows as they were before.

    `before` holds the whole old rows of every updated or deleted key, `updates` the key and the changed
    columns, `inserts` whole rows, `deletes` keys.
    """

    pk: list[str]
    before: DataFrame
    updates: DataFrame | None = None
    inserts: DataFrame | None = None
    deletes: DataFrame | None = None

    @staticmethod
    def capture(
        target: DataFrame,
        pk: list[str],
        updates: DataFrame | None = None,
        inserts: DataFrame | None = None,
        deletes: DataFrame | None = None,
        folder: str | None = None,
    ) -> "ChangeSet":
        """Write the change and the rows it will touch to a folder, before anything is changed."""
        spark = target.sparkSession
        folder = folder or new_folder(spark, "change")
        written = ChangeSet(pk, target, updates, inserts, deletes).save(folder, parts=PARTS[1:])
        touched = target.where("1 = 0").select(*pk)
        for part in (written.updates, written.deletes):
            if part is not None:
                touched = touched.unionByName(part.select(*pk))
        target.join(touched, pk, "left_semi").write.mode("errorifexists").parquet(f"{folder}/before")
        return ChangeSet(
            pk, spark.read.schema(target.schema).parquet(f"{folder}/before"), written.updates, written.inserts, written.deletes
        )

    def apply(self, target: DataFrame, read_twice: bool = False) -> DataFrame:
        """The table after the change.

        `read_twice` is for a target that is cheap to read, of which the change touches a small part: rows that no update
        can meet go past the join, so that a large table is not shuffled for a few rows. The updates are read once more, too.
        """
        if self.deletes is not None:
            target = target.join(self.deletes, self.pk, "left_anti")
        if self.updates is not None:
            touched, rest = split_possible(target, self.updates, self.pk) if read_twice else (target, None)
            target = update_from(touched, self.updates, self.pk)
            if rest is not None:
                target = target.unionByName(rest)
        if self.inserts is not None:
            target = target.unionByName(self.inserts)
        return target

    def revert(self, changed: DataFrame) -> DataFrame:
        """The table without the change: a three-way merge of the rows before it, after it and now.

        A column that still has the value the change gave it goes back; one that was edited later stays, and so do
        columns the change did not touch. Deleted rows come back, unless their key exists again; inserted rows go, unless
        they were edited; rows deleted later stay away. `conflicts` lists what stays.
        """
        columns = changed.columns
        merged = self._beside(changed).select(
            *[
                F.col(c) if c in self.pk
                else F.when((F.col("_kind") == "update") & F.col(c).eqNullSafe(F.col(f"_after.{c}")), F.col(f"_before.{c}")).otherwise(F.col(c)).alias(c)
                for c in columns
            ],
            ((F.col("_kind") == "insert") & self._as_left(columns)).alias("_gone"),
        )
        merged = merged.where("NOT coalesce(_gone, false)").drop("_gone")
        if self.deletes is None:
            return merged
        lost = self.before.join(self.deletes.select(*self.pk), self.pk, "left_semi")
        return merged.unionByName(lost.join(changed.select(*self.pk), self.pk, "left_anti").select(*columns))

    def conflicts(self, changed: DataFrame) -> DataFrame:
        """What a revert leaves as it is: key, `column_name`, and the values before, after and now as text.

        Edited columns of updated and inserted rows by name; `(row deleted)` for updated rows that are gone, `(row inserted)`
        for deleted rows whose key exists again. Inserted rows that are gone are no conflict.
        """
        columns = [c for c in changed.columns if c not in self.pk]
        beside = self._beside(changed)

        def told(name, before, after, now):
            return F.struct(F.lit(name).alias("column_name"), before.cast("string").alias("before"), after.cast("string").alias("after"), now.cast("string").alias("now"))

        edited = [
            F.when(
                (F.col("_kind") == "insert") & ~F.col(c).eqNullSafe(F.col(f"_after.{c}"))
                | (F.col("_kind") == "update") & ~F.col(f"_before.{c}").eqNullSafe(F.col(f"_after.{c}"))
                & ~F.col(c).eqNullSafe(F.col(f"_after.{c}")) & ~F.col(c).eqNullSafe(F.col(f"_before.{c}")),
                told(c, F.col(f"_before.{c}"), F.col(f"_after.{c}"), F.col(c)),
            )
            for c in columns
        ]
        none = F.lit(None)
        again = F.when(F.col("_kind") == "delete", told("(row inserted)", none, none, none))
        found = beside.where("_kind IS NOT NULL").select(*self.pk, F.explode(F.array_compact(F.array(*edited, again))).alias("_told"))
        gone = self._changes(changed).where("_kind = 'update'").join(changed.select(*self.pk), self.pk, "left_anti")
        found = found.unionByName(gone.select(*self.pk, told("(row deleted)", none, none, none).alias("_told")))
        return found.select(*self.pk, "_told.*")

    def _changes(self, like: DataFrame) -> DataFrame:
        """The change as (pk, `_kind`, `_before` and `_after` structs of the other columns)."""
        columns = [c for c in like.columns if c not in self.pk]
        kind = "struct<" + ",".join(f"`{c}`:{like.schema[c].dataType.simpleString()}" for c in columns) + ">"

        def packed(rows, name):
            return rows.select(*self.pk, F.struct(*columns).cast(kind).alias(name))

        parts, old, none = [], self.before, F.lit(None).cast(kind)
        if self.deletes is not None:
            deleted = old.join(self.deletes.select(*self.pk), self.pk, "left_semi")
            parts.append(packed(deleted, "_before").select(*self.pk, F.lit("delete").alias("_kind"), "_before", none.alias("_after")))
            old = old.join(self.deletes.select(*self.pk), self.pk, "left_anti")
        if self.updates is not None:
            both = packed(old, "_before").join(packed(update_from(old, self.updates, self.pk), "_after"), self.pk)
            parts.append(both.select(*self.pk, F.lit("update").alias("_kind"), "_before", "_after"))
        if self.inserts is not None:
            parts.append(packed(self.inserts, "_after").select(*self.pk, F.lit("insert").alias("_kind"), none.alias("_before"), "_after"))
        result = parts[0] if parts else packed(old, "_before").select(*self.pk, F.lit("update").alias("_kind"), "_before", F.col("_before").alias("_after"))
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    def _beside(self, changed: DataFrame) -> DataFrame:
        """The table's rows with the change to their key beside them, NULL where there is none."""
        return changed.join(self._changes(changed), self.pk, "left")

    def _as_left(self, columns: list[str]):
        """Whether a row is as the change left it."""
        same = F.lit(True)
        for c in columns:
            if c not in self.pk:
                same = same & F.col(c).eqNullSafe(F.col(f"_after.{c}"))
        return same

    def publish(
        self, table: DataFrame, folder: str, name: str, version: str, log: str, as_of: str, user_id: int, back: bool = False
    ) -> str:
        """Write the table after the change (or after taking it back) as a new version, and log the run."""
        result = self.revert(table) if back else self.apply(table)
        path = write_version(result, folder, name, version)
        # The event kinds of script runs.
        kind, verb = ("Script Revert", "Reverted") if back else ("Script Run", "Ran")
        log_event(table.sparkSession, log, as_of, kind, f"{verb}: {name} to version {version}", user_id)
        return path

    def rows(self) -> DataFrame:
        """The change as rows with an `op`: old and new row of each update, deleted rows, inserted rows."""
        old, parts = self.before, []
        if self.deletes is not None:
            parts.append(old.join(self.deletes, self.pk, "left_semi").withColumn("op", F.lit("delete")))
            old = old.join(self.deletes, self.pk, "left_anti")
        if self.updates is not None:
            parts.append(old.withColumn("op", F.lit("update_before")))
            parts.append(update_from(old, self.updates, self.pk).withColumn("op", F.lit("update_after")))
        if self.inserts is not None:
            parts.append(self.inserts.withColumn("op", F.lit("insert")))
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    def save(self, folder: str, parts: tuple[str, ...] = PARTS) -> "ChangeSet":
        """Write the given parts below a folder and return the change set that reads them from there."""
        stored = {}
        for name in PARTS:
            part = getattr(self, name)
            if part is not None and name in parts:
                part.write.mode("errorifexists").parquet(f"{folder}/{name}")
                part = part.sparkSession.read.schema(part.schema).parquet(f"{folder}/{name}")
            stored[name] = part
        # Written last: which parts there are. `before` follows in a folder of its own when a change is captured.
        spark = self.before.sparkSession
        kept = [(name,) for name in PARTS if stored[name] is not None]
        spark.createDataFrame(kept, "part string").coalesce(1).write.mode("errorifexists").parquet(f"{folder}/parts")
        return ChangeSet(self.pk, **stored)

    @staticmethod
    def load(spark: SparkSession, folder: str, pk: list[str]) -> "ChangeSet":
        """Read a saved change set: the parts that it has."""
        kept = [row["part"] for row in spark.read.parquet(f"{folder}/parts").collect()]
        return ChangeSet(pk, **{name: spark.read.parquet(f"{folder}/{name}") for name in kept})
