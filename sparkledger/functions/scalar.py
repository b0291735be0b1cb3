"""Column expressions: date arithmetic, NULL rules of string concatenation, money, text matching.

Every function returns a built-in Spark expression, so it stays inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"


def money(col) -> Column:
    """Fixed-point amount. Casting first also removes the negative zero of doubles."""
    return F.col(col).cast(MONEY) if isinstance(col, str) else col.cast(MONEY)


def total(col) -> Column:
    """Sum of a money column, as wide as decimals go: totals of many rows outgrow the precision of one."""
    return F.sum(col).cast(MONEY_TOTAL)


def safe_ratio(numerator, denominator, digits: int) -> Column:
    """Rounded quotient; NULL where the denominator is zero."""
    return F.round(F.try_divide(numerator, denominator), digits)


def row_count() -> Column:
    return F.count(F.lit(1)).cast("bigint")


# Dates -------------------------------------------------------------------------------------------

def date_only(ts) -> Column:
    return F.to_date(ts)


def day_start(ts) -> Column:
    """Midnight of the day, still a timestamp."""
    return F.date_trunc("DAY", ts)


def add_units(unit: str, amount: int, ts) -> Column:
    """`amount` units after the timestamp; unit is HOUR, MINUTE, DAY, ..."""
    return F.timestamp_add(unit, F.lit(amount), ts)


def boundary_diff(unit: str, start, end) -> Column:
    """Number of unit boundaries between two timestamps: 00:59 to 01:01 is one hour boundary."""
    return F.timestamp_diff(unit, F.date_trunc(unit, start), F.date_trunc(unit, end)).cast("bigint")


def to_local(ts, zone) -> Column:
    """UTC timestamp shown in a zone; the zone may be a column."""
    return F.from_utc_timestamp(ts, zone)


def local_day_start_utc(ts, zone) -> Column:
    """Start of the local day that contains a UTC timestamp, expressed in UTC."""
    return F.to_utc_timestamp(F.date_trunc("DAY", F.from_utc_timestamp(ts, zone)), zone)


def parse_date(text, pattern: str = "dd-MMM-yyyy") -> Column:
    return F.to_date(text, pattern)


def format_compact(ts) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def format_millis(ts) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def format_long(ts) -> Column:
    return F.date_format(ts, "EEE dd-MMM-yyyy HH:mm:ss")


# Text --------------------------------------------------------------------------------------------

def concat_strict(*parts) -> Column:
    """Concatenation that is NULL when any part is NULL."""
    return F.concat(*parts)


def concat_lenient(*parts) -> Column:
    """Concatenation in which NULL counts as the empty string."""
    return F.concat_ws("", *parts)


def contains_text(text, needle: str) -> Column:
    """Plain substring test: wildcard characters have no meaning."""
    return F.contains(text, F.lit(needle))


def contains_ignore_case(text, needle: str) -> Column:
    """The same without regard to case, as servers with a case-insensitive collation search."""
    return F.contains(F.lower(text), F.lit(needle.lower()))


def has_prefix(text, prefix: str) -> Column:
    """Literal prefix test; an underscore is an underscore."""
    return F.startswith(text, F.lit(prefix))


def like_ignore_case(text: Column, pattern: str) -> Column:
    return text.ilike(pattern)


def equals_ignore_case(text, value: str) -> Column:
    """Equality that ignores case and trailing blanks."""
    return F.lower(F.rtrim(text)) == value.rstrip().lower()


def last_token(text) -> Column:
    """Last piece of a text split at blanks and commas."""
    return F.element_at(F.split(text, "[ ,]"), -1)


# Keys --------------------------------------------------------------------------------------------

def required(col, what: str) -> Column:
    """The column itself; the job fails on a NULL, instead of a silently empty or wrong result."""
    column = F.col(col) if isinstance(col, str) else col
    return F.coalesce(column, F.raise_error(F.lit(f"{what} must not be NULL")))
