"""Rows as INSERT statement text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def sql_literal(name: str, kind: T.DataType) -> Column:
    """A column as literal text of its type; NULL for NULL, quotes inside strings doubled."""
    column = F.col(name)
    if isinstance(kind, T.StringType):
        text = F.concat(F.lit("'"), F.replace(column, F.lit("'"), F.lit("''")), F.lit("'"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.concat(F.lit("convert(datetime,'"), F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("',121)"))
    elif isinstance(kind, T.DateType):
        text = F.concat(F.lit("'"), F.date_format(column, "yyyy-MM-dd"), F.lit("'"))
    elif isinstance(kind, T.DecimalType):
        text = F.concat(F.lit("convert(money,'"), column.cast("string"), F.lit("')"))
    elif isinstance(kind, T.BinaryType):
        text = F.concat(F.lit("0x"), F.hex(column))
    elif isinstance(kind, T.BooleanType):
        text = column.cast("int").cast("string")
    elif isinstance(kind, T.NumericType):
        text = F.concat(F.lit("'"), column.cast("string"), F.lit("'"))
    else:
        raise TypeError(f"no literal form for column {name} of type {kind.simpleString()}")
    return F.coalesce(text, F.lit("NULL"))


def insert_statements(df: DataFrame, table: str) -> DataFrame:
    """One INSERT statement per row, in a column `statement`."""
    fields = df.schema.fields
    head = f"INSERT {table}({','.join(f.name for f in fields)}) VALUES("
    values = F.concat_ws(",", *[sql_literal(f.name, f.dataType) for f in fields])
    return df.select(F.concat(F.lit(head), values, F.lit(")")).alias("statement"))
