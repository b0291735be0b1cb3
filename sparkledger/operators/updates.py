"""UPDATE and MERGE as functions from frame to frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkledger.operators.joins import anti


def one_per_key(source: DataFrame, pk: list[str]) -> DataFrame:
    """The source as (pk, `_new` struct); the job fails if a key has several rows.

    An update with several source rows for one target row has no defined result, so it is refused.
    """
    values = [c for c in source.columns if c not in pk]
    single = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"several update rows for one {', '.join(pk)}"))).otherwise(
        F.any_value(F.struct(*values))
    )
    return source.groupBy(*pk).agg(single.alias("_new"))


def update_from(target: DataFrame, source: DataFrame, pk: list[str], flag: str | None = None) -> DataFrame:
    """Rows of the target take the source's values where the key matches; nothing is inserted.

    A matched NULL overwrites the target's value. `flag` names an optional column that tells the updated rows.
    """
    values = [c for c in source.columns if c not in pk]
    if not values:
        raise ValueError("the update changes no column")
    joined = target.join(one_per_key(source, pk), pk, "left")
    matched = F.col("_new").isNotNull()
    columns = [
        F.when(matched, F.col(f"_new.{c}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in target.columns
    ]
    if flag:
        columns.append(matched.alias(flag))
    return joined.select(*columns)


def set_where(target: DataFrame, condition, assignments: dict) -> DataFrame:
    """UPDATE ... SET ... WHERE: expressions see the old values; a NULL condition leaves the row alone."""
    return target.select(
        *[
            F.when(condition, F.lit(assignments[c]).cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in assignments
            else F.col(c)
            for c in target.columns
        ]
    )


def set_for_keys(target: DataFrame, keys: DataFrame, pk: list[str], assignments: dict) -> DataFrame:
    """UPDATE ... WHERE pk IN (keys)."""
    marks = keys.select(*pk).distinct().withColumn("_hit", F.lit(True))
    joined = target.join(marks, pk, "left").select(*target.columns, "_hit")
    return set_where(joined, F.col("_hit"), assignments).drop("_hit")


def delete_for_keys(target: DataFrame, keys: DataFrame, pk: list[str]) -> DataFrame:
    """DELETE ... WHERE pk IN (keys)."""
    return anti(target, keys, pk)


def insert_missing(target: DataFrame, rows: DataFrame, pk: list[str]) -> DataFrame:
    """Append the rows whose key the target does not have; columns are matched by name."""
    return target.unionByName(rows.join(target.select(*pk), pk, "left_anti"))
