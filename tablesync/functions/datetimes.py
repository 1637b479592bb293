"""Dates and timestamps to and from epoch milliseconds and text.

Wall-clock values are read in the session time zone; pin it (UTC) for stable
results.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from tablesync.operators.columns import quoted, resolve

MILLIS_PER_DAY = 24 * 60 * 60 * 1000


def datetime_to_millis(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Date and timestamp columns as epoch milliseconds; microseconds are cut off."""
    kinds = (DateType, TimestampType, TimestampNTZType)
    if columns is None:
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    else:
        names = [resolve(df, c) for c in columns]
        for name in names:
            if not isinstance(df.schema[name].dataType, kinds):
                raise ValueError(f"column {name!r} is no date or timestamp")
    return df.withColumns({c: F.unix_millis(quoted(c).cast("timestamp")) for c in names})


def _from_millis(value: Column, kind: str) -> Column:
    if kind == "time":
        # there is no time-of-day column type here: milliseconds since midnight
        return F.pmod(value, F.lit(MILLIS_PER_DAY).cast("bigint"))
    return F.timestamp_millis(value).cast(kind)


def millis_to_datetime(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Epoch milliseconds as ``date``, ``timestamp``, ``timestamp_ntz`` or ``time``."""
    return _convert(df, types, ("date", "timestamp", "timestamp_ntz", "time"), _from_millis)


def string_to_datetime(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """ISO text as ``date``, ``timestamp`` or ``timestamp_ntz``; bad text fails the job."""
    for name in types:
        if not isinstance(df.schema[resolve(df, name)].dataType, StringType):
            raise ValueError(f"column {name!r} is not text")
    return _convert(df, types, ("date", "timestamp", "timestamp_ntz"), _from_text)


#: A date, with or without a time of day, and no zone.
PLAIN_TEXT = (
    "^[+-]?\\d{4,7}(-\\d{1,2}(-\\d{1,2}([ T]\\d{1,2}:\\d{1,2}(:\\d{1,2}(\\.\\d{1,9})?)?)?)?)?$"
)


def _from_text(value: Column, kind: str) -> Column:
    parsed = value.try_cast(kind)
    if kind != "timestamp":  # the cast overlooks what follows a date, and a zone offset
        parsed = F.when(F.trim(value).rlike(PLAIN_TEXT), parsed)
    bad = F.raise_error(F.concat(F.lit(f"not a {kind}: "), value))
    return F.when(value.isNotNull() & parsed.isNull(), bad).otherwise(parsed)


def _convert(df, types, allowed, convert) -> DataFrame:
    out = {}
    for name, kind in types.items():
        if kind not in allowed:
            raise ValueError(f"column {name!r} cannot become {kind!r}: use one of {list(allowed)}")
        col = resolve(df, name)
        out[col] = convert(quoted(col), kind)
    return df.withColumns(out)
