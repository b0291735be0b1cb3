"""Age-based purge over a family of tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Parent:
    """A link from a child table to its parent."""

    table: str
    child_key: str
    parent_key: str


@dataclass(frozen=True)
class PurgeStep:
    """Rows of `table` go when every date of the dated table is before the cutoff.

    Without `path` the dated table is the table itself; with it, the dates are those of the last parent on the
    path. `nonzero` names id columns whose value 0 marks a system row that always stays: of the table itself
    and of the dated table.
    """

    table: str
    dates: tuple[str, ...]
    path: tuple[Parent, ...] = ()
    nonzero: tuple[str, ...] = ()
    dated_nonzero: tuple[str, ...] = field(default=())


def _cutoff(as_of: str, days: int):
    return F.date_sub(F.lit(as_of).cast("date"), days)


def _expired(dates: tuple[str, ...], nonzero: tuple[str, ...], cutoff):
    """True when all dates are before the cutoff; a NULL date keeps the row."""
    condition = F.lit(True)
    for date in dates:
        condition = condition & (F.col(date) < cutoff)
    for key in nonzero:
        condition = condition & (F.col(key) != 0)
    return F.coalesce(condition, F.lit(False))


def _check(steps: list[PurgeStep]) -> None:
    """Refuse parent links that form a cycle."""
    parents: dict[str, set[str]] = {}
    for step in steps:
        table = step.table
        for link in step.path:
            parents.setdefault(table, set()).add(link.table)
            table = link.table
    done: set[str] = set()

    def visit(table: str, trail: tuple[str, ...]) -> None:
        if table in trail:
            raise ValueError("cyclic parent links: " + " > ".join((*trail, table)))
        if table not in done:
            for parent in parents.get(table, ()):
                visit(parent, (*trail, table))
            done.add(table)

    for table in list(parents):
        visit(table, ())


def mark_expired(tables: dict[str, DataFrame], steps: list[PurgeStep], as_of: str, days: int) -> dict[str, DataFrame]:
    """Each purged table with one flag per step, `_step<i>`, computed from the tables as they are.

    Steps are judged on the original tables, so their order does not matter and a row reached on several
    paths is removed once. `days = -1` keeps everything.
    """
    _check(steps)
    cutoff = _cutoff(as_of, days)
    marked: dict[str, DataFrame] = {}
    for index, step in enumerate(steps, start=1):
        flag = f"_step{index}"
        rows = marked.get(step.table, tables[step.table])
        if days < 0:
            marked[step.table] = rows.withColumn(flag, F.lit(False))
            continue
        if not step.path:
            marked[step.table] = rows.withColumn(flag, _expired(step.dates, (*step.nonzero, *step.dated_nonzero), cutoff))
            continue
        dated = step.path[-1]
        expired = tables[dated.table].where(_expired(step.dates, step.dated_nonzero, cutoff)).select(
            F.col(dated.parent_key).alias("_key")
        )
        child_key = dated.child_key
        for link in reversed(step.path[:-1]):
            middle = tables[link.table].select(F.col(link.parent_key).alias("_next"), F.col(child_key).alias("_key"))
            expired = middle.join(expired, "_key", "left_semi").select(F.col("_next").alias("_key"))
            child_key = link.child_key
        # One row per key: a parent key that repeats must not repeat its child rows.
        expired = expired.distinct().withColumn(flag, F.lit(True)).withColumnRenamed("_key", child_key)
        hit = F.coalesce(F.col(flag), F.lit(False))
        for key in step.nonzero:
            hit = hit & (F.col(key) != 0)
        marked[step.table] = rows.join(expired, child_key, "left").withColumn(flag, hit)
    return marked


def _flags(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_step")]


def purge(tables: dict[str, DataFrame], steps: list[PurgeStep], as_of: str, days: int) -> dict[str, DataFrame]:
    """The rows that stay, per table."""
    kept = {}
    for name, rows in mark_expired(tables, steps, as_of, days).items():
        gone = F.greatest(*[F.col(c) for c in _flags(rows)], F.lit(False))
        kept[name] = rows.where(~gone).select(*tables[name].columns)
    return kept


def purge_report(tables: dict[str, DataFrame], steps: list[PurgeStep], as_of: str, days: int) -> DataFrame:
    """Per table and step the rows the step reaches, and per table (step 0) the total, deleted and kept rows."""
    parts = []
    for name, rows in mark_expired(tables, steps, as_of, days).items():
        flags = _flags(rows)
        gone = F.greatest(*[F.col(c) for c in flags], F.lit(False))
        counts = rows.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(gone).alias("deleted"),
            *[F.count_if(F.col(c)).alias(c) for c in flags],
        )
        lines = [F.struct(F.lit(0).alias("step"), F.col("total").alias("n_total"), F.col("deleted").alias("n_deleted"))]
        lines += [
            F.struct(F.lit(int(c[5:])).alias("step"), F.col("total").alias("n_total"), F.col(c).alias("n_deleted"))
            for c in flags
        ]
        parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*lines))))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.withColumn("n_kept", F.col("n_total") - F.col("n_deleted"))


def empty_tables(tables: dict[str, DataFrame], names: list[str]) -> dict[str, DataFrame]:
    """Empty a family of history tables, keeping their schemas."""
    return {name: (df.limit(0) if name in names else df) for name, df in tables.items()}
