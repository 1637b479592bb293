"""Column lists, row filters, names and per-column types."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    IntegralType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# The type names an override may use, and what they store.
OVERRIDE_TYPES = {
    "INTEGER": "int",
    "LONG": "bigint",
    "BOOLEAN": "boolean",
    "FLOAT": "float",
    "DOUBLE": "double",
    "STRING": "string",
    "BYTES": "binary",
}
# Fixed value: put before a name that does not start with a letter or underscore.
NAME_PREFIX = "AVRO_"


def resolve(df: DataFrame, name: str) -> str:
    """The column's real name: exact spelling first, else without regard to case."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        problem = "no column" if not found else "more than one column"
        raise ValueError(f"{problem} named {name!r} in {df.columns}")
    return found[0]


def refuse_column(df: DataFrame, name: str) -> None:
    """A column about to be added must not replace one of the data's own."""
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the data already has a column named {name!r}")


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_columns(columns: str | Sequence[str]) -> list[str]:
    names = [c.strip() for c in columns.split(",")] if isinstance(columns, str) else list(columns)
    names = [c[1:-1] if len(c) > 2 and c[0] == c[-1] == '"' else c for c in names]
    if not all(names):
        raise ValueError(f"empty name in column list {columns!r}")
    return names


def select_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Columns from a comma string or list, under the caller's spelling."""
    return df.select([quoted(resolve(df, c)).alias(c) for c in parse_columns(columns)])


def where_filter(df: DataFrame, where: str | None, bounds: Column | None = None) -> DataFrame:
    """Rows within ``bounds`` that also satisfy the free text ``where``.

    The text is parsed as one expression, so an OR in it cannot escape the AND.
    """
    condition = bounds
    if where is not None:
        text = F.expr(where)
        condition = text if bounds is None else bounds & text
    return df if condition is None else df.where(condition)


def _is_kept(char: str) -> bool:
    kind = unicodedata.category(char)
    return char == "_" or kind == "Nd" or kind.startswith("L")


def safe_name(name: str) -> str:
    """A name of letters, digits and underscores that does not start with a digit."""
    if not name:
        raise ValueError("a column name must not be empty")
    runs = groupby(name, _is_kept)
    text = "".join("".join(run) if kept else "_" for kept, run in runs)
    starts_well = text[0] == "_" or unicodedata.category(text[0]).startswith("L")
    return text if starts_well else NAME_PREFIX + text


def sanitize_columns(df: DataFrame) -> DataFrame:
    """All names made safe for storage; the old name is kept in the column's metadata."""
    names = [safe_name(c) for c in df.columns]
    folded = [n.lower() for n in names]
    clashes = sorted({n for n in names if folded.count(n.lower()) > 1})
    if clashes:
        raise ValueError(f"columns collide after cleaning their names: {clashes}")
    return df.select(
        [
            quoted(old).alias(new, metadata={**df.schema[old].metadata, "columnName": old})
            for old, new in zip(df.columns, names)
        ]
    )


def cast_overrides(df: DataFrame, overrides: Mapping[str, str]) -> DataFrame:
    """Store columns as the named types. Decimal columns keep their exact type."""
    casts = {}
    for name, type_name in overrides.items():
        target = OVERRIDE_TYPES.get(type_name.upper())
        if target is None:
            raise ValueError(f"cannot store {name!r} as {type_name!r}: use one of {list(OVERRIDE_TYPES)}")
        col = resolve(df, name)
        if not isinstance(df.schema[col].dataType, DecimalType):
            casts[col] = _cast(quoted(col), df.schema[col].dataType, target, col)
    return df.withColumns(casts)


def _cast(value: Column, source: DataType, target: str, name: str) -> Column:
    """The cast, or an error for a number it would change or a text that is none, whatever the ANSI mode.

    Between float and double the nearest value is meant: that is what a float column asks for.
    """
    whole = target in ("smallint", "int", "bigint")
    number = whole or target in ("float", "double")
    out = value.try_cast(target)
    if isinstance(source, StringType) and (number or target == "boolean"):
        bad = value.isNotNull() & out.isNull()
    elif isinstance(source, NumericType) and number and (whole or isinstance(source, IntegralType)):
        bad = ~value.eqNullSafe(out.try_cast(source))
    else:
        return value.cast(target)
    message = F.concat(F.lit(f"column {name}: "), value.cast("string"), F.lit(f" is not exact as {target}"))
    return F.when(bad, F.raise_error(message)).otherwise(out)


def year_as_smallint(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """YEAR columns, which drivers deliver as dates or numbers, as small integers."""
    years = {}
    for name in columns:
        col = resolve(df, name)
        kind = df.schema[col].dataType
        is_date = isinstance(kind, (DateType, TimestampType, TimestampNTZType))
        year = F.year(quoted(col)) if is_date else quoted(col)
        years[col] = _cast(year, IntegerType() if is_date else kind, "smallint", col)
    return df.withColumns(years)
