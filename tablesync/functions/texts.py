"""Delimiter stripping and large values."""

from __future__ import annotations

from collections.abc import Iterable
from re import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tablesync.operators.columns import quoted, resolve

# Row and field delimiters of text tables (newline, return, Ctrl-A).
DELIMITERS = "\n\r\x01"


def drop_delims(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    chars: str = DELIMITERS,
    replacement: str = "",
) -> DataFrame:
    """Strip (or replace) delimiter characters in text columns; all of them by default."""
    if columns is None:
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    else:
        names = [resolve(df, c) for c in columns]
    pattern = F.lit("[" + "".join(escape(c) for c in chars) + "]")
    literal = F.lit(replacement.replace("\\", "\\\\").replace("$", "\\$"))
    return df.withColumns({c: F.regexp_replace(quoted(c), pattern, literal) for c in names})


def reference(key: str, col: str, label: str) -> Column:
    """What stands in the row for a value moved out of it."""
    missing = F.raise_error(F.lit(f"column {col}: a value moved out of its row needs a value of {key}"))
    return F.concat(F.lit(f"lob:{label}/{col}/"), F.coalesce(quoted(key).cast("string"), missing))


def lob_inline(
    df: DataFrame, key: str, col: str, limit: int, label: str = "table"
) -> tuple[DataFrame, DataFrame]:
    """Keep values of at most ``limit`` bytes in the row, move larger ones out.

    Returns the main table, in which a larger value is replaced by its reference
    string (as bytes in a binary column), and the side table ``(reference,
    payload)``. ``key`` must identify the row, as it names the payload. Nothing is
    shuffled; only the side table's scan carries payloads on.
    """
    key, col = resolve(df, key), resolve(df, col)
    kind = df.schema[col].dataType
    if not isinstance(kind, (StringType, BinaryType)):
        raise ValueError(f"column {col!r} holds no large values: {kind.simpleString()}")
    if limit < 0:
        raise ValueError("limit must not be negative")
    value, moved = quoted(col), reference(key, col, label)
    large = F.octet_length(value) > limit
    main = df.withColumn(col, F.when(large, moved.cast(kind)).otherwise(value))
    side = df.where(large).select(moved.alias("reference"), value.alias("payload"))
    return main, side
