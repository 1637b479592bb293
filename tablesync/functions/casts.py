"""Casts that cannot change a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    IntegralType,
    NullType,
    NumericType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tablesync.functions.decimals import exact_decimal, exact_or_fail
from tablesync.operators.columns import quoted


def lossless(df: DataFrame, col: str, target: DataType) -> Column:
    """The column as ``target``: the same value, or an error.

    Numbers that may not fit are checked row by row (a decimal with too many
    digits, an integer out of range). Types whose cast would round or cut in
    silence are refused here; the caller has to cast them on purpose.
    """
    source, value = df.schema[col].dataType, quoted(col)
    if source == target:
        return value
    if isinstance(target, DecimalType) and isinstance(source, (NumericType, StringType)):
        return exact_decimal(df, col, target.precision, target.scale)
    if isinstance(source, IntegralType) and isinstance(target, IntegralType):
        # in ANSI mode the cast itself fails; otherwise it wraps around and differs
        return exact_or_fail(value, value.cast(target), col, target.simpleString())
    safe = [
        (NullType, DataType),
        ((ByteType, ShortType, IntegerType, FloatType), DoubleType),
        ((ByteType, ShortType), FloatType),
        (DateType, (TimestampType, TimestampNTZType)),
        ((IntegralType, DateType), StringType),
    ]
    if any(isinstance(source, a) and isinstance(target, b) for a, b in safe):
        return value.cast(target)
    raise ValueError(
        f"column {col!r}: {source.simpleString()} may not fit {target.simpleString()}, cast it first"
    )
