"""Join shapes that need more care than one `join` call.

All of them shuffle on equality keys, so adaptive execution can split the partitions of a hot key, and
none of them emits the pairs of a group. Adaptive execution can split the left side of a semi, anti or left
join, and both sides of an inner join; what it cannot split is reduced before the shuffle here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sparkledger.functions.scalar import required
from sparkledger.session import snapshot


# Bits of a key filter, as a power of two: 8 MB, in rows of 64 words, which Spark broadcasts by their measured size.
FILTER_BITS = 26


def key_filter(others: DataFrame, keys: list[str]) -> DataFrame:
    """A bitmap of the hashes of the others' keys, of bounded size however many keys there are. A snapshot (`_part`, `_words`)."""
    words = others.select(*_filter_place(keys)).selectExpr("_part", "_word", "shiftleft(1L, _bit) AS _bits")
    parts = words.groupBy("_part", "_word").agg(F.bit_or("_bits").alias("_bits"))
    parts = parts.groupBy("_part").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_found"))
    return snapshot(parts.selectExpr("_part", "transform(sequence(0, 63), w -> coalesce(try_element_at(_found, w), 0L)) AS _words"))


def _filter_place(keys: list[str]) -> list[Column]:
    place = F.xxhash64(*keys).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).cast("int")
    return [
        F.shiftright(place, 12).alias("_part"), F.shiftright(place, 6).bitwiseAND(F.lit(63)).alias("_word"), place.bitwiseAND(F.lit(63)).alias("_bit")
    ]


def _filterable(rows: DataFrame, others: DataFrame, keys: list[str]) -> bool:
    """Whether equal keys have equal hashes: whole numbers of the same type on both sides."""
    return all(isinstance(rows.schema[k].dataType, T.IntegralType) and rows.schema[k].dataType == others.schema[k].dataType for k in keys)


def possible(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key may occur among the others: all that do, and the few whose hash meets another key's.

    A large table that joins few others goes through this first, so that most of it is not shuffled. The others are read
    once more, so pass a stored frame or a cheap one.
    """
    if not _filterable(rows, others, keys):
        return rows
    return _marked(rows, key_filter(others, keys), keys).where("_possible").select(*rows.columns)


def _marked(rows: DataFrame, bits: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with `_possible`: true, or false or NULL for keys that the filter does not have."""
    part, word, bit = _filter_place(keys)
    placed = rows.select("*", part, word, bit).join(bits, "_part", "left")
    return placed.withColumn("_possible", F.expr("getbit(_words[_word], _bit) = 1"))


def semi_few(rows: DataFrame, others: DataFrame, keys: list[str], nulls_match: bool = False) -> DataFrame:
    """`semi` for a large table of which few rows stay: most others go before the shuffle. `nulls_match`: a NULL is a key like any other.

    The others are read twice. The join is an inner one with distinct keys, as Spark moves a semi join below the filter.
    """
    marks = others.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) if nulls_match else F.col(k) == F.col(f"_key_{k}") for k in keys]
    return possible(rows, others, keys).join(marks, same).select(*rows.columns)


def split_possible(rows: DataFrame, others: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows as those whose key may occur among the others, and the rest; no rest if the keys cannot be told."""
    if not _filterable(rows, others, keys):
        return rows, None
    marked = _marked(rows, key_filter(others, keys), keys)
    return marked.where("_possible").select(*rows.columns), marked.where("NOT coalesce(_possible, false)").select(*rows.columns)


def semi(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs among the others; a key that fills the other side is reduced to one row per task."""
    return rows.join(others.select(*keys).distinct(), keys, "left_semi")


def anti(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur among the others, with the same reduction."""
    return rows.join(others.select(*keys).distinct(), keys, "left_anti")


def left_join_many(rows: DataFrame, many: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a side in which a key may have any number of rows.

    The matches come from an inner join, whose hot partitions can be split on either side; rows without a
    match follow with NULLs.
    """
    unmatched = anti(rows, many, keys)
    extra = [F.lit(None).cast(many.schema[c].dataType).alias(c) for c in many.columns if c not in keys]
    return rows.join(many, keys).unionByName(unmatched.select("*", *extra))


def not_in(rows: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the excluded ones.

    SQL's NOT IN yields nothing once the excluded side holds a NULL, and Spark can only run that form by
    broadcasting. Here keys are required to be present (checked while running), which makes it an ordinary
    anti join.
    """
    return anti(rows, excluded.select(required(key, f"excluded {key}").alias(key)), [key])


def semi_any(
    rows: DataFrame, row_key: list[str], candidates: list[str], lookup: DataFrame, lookup_key: str, same: list[str] | None = None
) -> DataFrame:
    """Rows for which `lookup` holds a row whose key is any of the row's candidate columns.

    `same` lists further columns that must be equal on both sides. The candidates of a row are exploded, so
    that the join has the full key to shuffle on; `x IN (c1, c2, c3)` as a condition would compare all rows
    of a contract with each other.
    """
    return _probe_any(rows, candidates, lookup, lookup_key, same, "left_semi").dropDuplicates(row_key)


def flag_any(
    rows: DataFrame,
    row_key: list[str],
    candidates: list[str],
    lookup: DataFrame,
    lookup_key: str,
    same: list[str] | None,
    value: str,
    flag: str,
) -> DataFrame:
    """All rows, with the greatest `value` among the lookup rows that `semi_any` would match; NULL if there is none."""
    keys = [*(same or []), lookup_key]
    unique = lookup.groupBy(*keys).agg(F.max(value).alias(flag))
    probed = _probe_any(rows, candidates, unique, lookup_key, same, "left")
    others = [c for c in rows.columns if c not in row_key]
    return probed.groupBy(*row_key).agg(*[F.any_value(c).alias(c) for c in others], F.max(flag).alias(flag))


def _probe_any(rows, candidates, lookup, lookup_key, same, how):
    keys = [*(same or []), "_candidate"]
    probes = rows.withColumn("_candidate", F.explode(F.array_distinct(F.array(*candidates))))
    side = lookup.withColumnRenamed(lookup_key, "_candidate")
    if how == "left_semi":
        side = side.select(*keys).distinct()
    return probes.join(side, keys, how).drop("_candidate")


def latest_as_of(rows: DataFrame, keys: list[str], date: str, tie: str, as_of, values: list[str]) -> DataFrame:
    """Per key the row with the greatest date not after `as_of`, ties broken by the greatest `tie`.

    The greatest row is an aggregate, not a sorted window: each task reduces its share of a hot key first.
    Keys without a row up to `as_of` are absent.
    """
    valid = rows.where(F.col(date) <= (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")))
    best = F.max(F.struct(date, tie, *values)).alias("_best")
    return valid.groupBy(*keys).agg(best).select(
        *keys, f"_best.{date}", f"_best.{tie}", *[f"_best.{value}" for value in values]
    )


def as_of(
    rows: DataFrame, versions: DataFrame, keys: list[str], date: str, valid_from: str, tie: str, values: list[str],
    range_days: int = 32, part_rows: int = 1_000_000,
) -> DataFrame:
    """All rows, each with the values of the version of its key in effect on its own date; NULLs where there is none.

    That is the greatest `valid_from` not after the row's date, ties broken by the greatest `tie`. Both sides go through
    one window, sorted by date, in which the last version is carried forward. A key is cut into ranges of `range_days`, which
    begin with the version carried over from earlier ranges, and the rows of a range of more than `part_rows` are dealt to
    several parts, each of which gets the range's versions: no key, however many rows it has, is one task. Rows with a
    NULL key or date have no version.
    """
    taken = {c.lower() for c in [*rows.columns, *values]}
    name = lambda n: next(x for x in (f"{'_' * i}{n}" for i in range(1, 99)) if x not in taken)
    bucket, part, salt, at, side, version, row = map(name, ("bucket", "part", "salt", "at", "side", "version", "row"))
    number = lambda c: F.floor(F.unix_date(F.col(c).cast("date")) / range_days)
    valued = F.struct(F.col(valid_from).cast("date").alias("valid_from"), F.col(tie).alias("tie"), *values)
    known = versions.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, valid_from]))
    known = known.groupBy(*keys, F.col(valid_from).cast("date").alias(at)).agg(F.max(valued).alias(version)).withColumn(bucket, number(at))

    given = rows.select(*keys, F.struct(*rows.columns).alias(row), F.col(date).cast("date").alias(at)).withColumn(bucket, number(at))
    # Only ranges that are cut have a row here.
    cut = given.groupBy(*keys, bucket).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias(part)).where(F.col(part) > 1)
    cut = snapshot(cut)
    given = given.join(cut, [*keys, bucket], "left")
    given = given.withColumn(salt, F.coalesce(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(part)).cast("int"), F.lit(0))).drop(part)

    # The last version of each range, carried over to the ranges after it: a row for each range of a key.
    ranges = known.groupBy(*keys, bucket).agg(F.max(version).alias(version))
    ranges = ranges.unionByName(given.select(*keys, bucket).distinct(), allowMissingColumns=True).groupBy(*keys, bucket).agg(F.max(version).alias(version))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(*keys, bucket, F.last(version, ignorenulls=True).over(before).alias(version), F.lit(None).cast("date").alias(at))
    starts = known.unionByName(carried.where(F.col(version).isNotNull())).join(cut, [*keys, bucket], "left")
    starts = starts.withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(part), F.lit(1)) - 1))).drop(part)

    # Carried versions have no date and come first; of a day, versions come before rows.
    stream = starts.withColumn(side, F.lit(0)).unionByName(given.withColumn(side, F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(*keys, bucket, salt).orderBy(F.asc_nulls_first(at), side).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = stream.withColumn(version, F.last(version, ignorenulls=True).over(order)).where(F.col(side) == 1)
    return found.select(*[F.col(f"{row}.{c}").alias(c) for c in rows.columns], *[F.col(f"{version}.{c}").alias(c) for c in values])


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).where("n_rows > 1")
