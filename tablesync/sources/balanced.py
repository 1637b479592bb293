"""Splits of about equal rows, and equal-width splits of dates, times, numbers and text.

Equal-width ranges follow the values, so a skewed column gives one range most rows.
Balanced ranges follow the rows: their bounds are quantiles, and a value that alone
holds more than its share is a range of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from os.path import commonprefix
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tablesync.operators.checks import single_row
from tablesync.operators.columns import quoted, refuse_column, resolve
from tablesync.sources.jdbc import JdbcSource

# --- balanced ranges -------------------------------------------------------------------------


@dataclass(frozen=True)
class Piece:
    """Rows between two cuts, or those equal to one (``point``)."""

    point: bool
    low: Any
    high: Any
    rows: int


def merged_pieces(pieces: Sequence[Piece], most: float) -> list[tuple[int, int]]:
    """Runs of pieces as (first, last): a stretch and the cut that ends it, unless both hold more than ``most`` rows."""
    runs: list[tuple[int, int]] = []
    i = 0
    while i < len(pieces):
        pair = not pieces[i].point and i + 1 < len(pieces) and pieces[i + 1].point
        together = pair and pieces[i].rows + pieces[i + 1].rows <= most
        runs.append((i, i + 1 if together else i))
        i += 2 if together else 1
    return runs


def _cuts(df: DataFrame, col: str, n: int, accuracy: int) -> list:
    """The distinct values at the ranks ceil(i * rows / n) of the column's rows in order, as values of its type.

    A sketch names values at and on both sides of each rank. The counts of the pieces between them tell where the rank
    lies: at a named value, or in a stretch of about rows / accuracy, whose values are counted one by one and added up in order.
    """
    if n == 1:
        return []
    kind, slack = df.schema[col].dataType, 2 / accuracy
    shares = sorted({min(max(i / n + by, 0.0), 1.0) for i in range(1, n) for by in (-slack, 0.0, slack)})
    named = sorted(set(df.agg(F.percentile_approx(quoted(col), shares, accuracy).alias("named")).first()["named"] or []))
    placed = df.where(quoted(col).isNotNull()).select(quoted(col).alias("value"), _piece_of(quoted(col), named, kind).alias("piece"))
    sizes = dict(placed.groupBy("piece").agg(F.count("*").alias("rows")).collect())
    total = sum(sizes.values())
    cuts, within, before = set(), [], 0
    ranks = [-(-i * total // n) for i in range(1, n)]
    for piece in sorted(sizes):
        inside = [rank - before for rank in ranks if before < rank <= before + sizes[piece]]
        if inside and piece % 2 == 1:
            cuts.add(named[piece // 2])
        elif inside:
            within += [(piece, rank) for rank in inside]
        before += sizes[piece]
    return sorted(cuts | set(_at_ranks(placed, within))) if within else sorted(cuts)


def _at_ranks(placed: DataFrame, within: list[tuple[int, int]]) -> list:
    """The values at (piece, rank within the piece). Repeats are added up map-side; a task orders the values of a piece."""
    few = placed.where(F.col("piece").isin(sorted({piece for piece, _ in within})))
    counted = few.groupBy("piece", "value").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("piece").orderBy("value"))
    wanted = F.array(*[F.struct(F.lit(piece).alias("piece"), F.lit(rank).cast("bigint").alias("rank")) for piece, rank in within])

    def here(want: Column) -> Column:
        return (want["piece"] == F.col("piece")) & (want["rank"] <= F.col("upto")) & (want["rank"] > F.col("upto") - F.col("rows"))

    return [r["value"] for r in counted.withColumn("upto", upto).where(F.exists(wanted, here)).select("value").collect()]


def _piece_of(col: Column, cuts: list, kind: DataType) -> Column:
    """``2 * cuts below the value``, plus one if it is the next cut: by halving steps, log2(n) per row."""
    if not cuts:
        return F.lit(0)
    array = F.array(*[F.lit(c).cast(kind) for c in cuts])
    steps, step = [], 1
    while step <= len(cuts):
        steps.insert(0, step)
        step *= 2

    def forward(below: Column, by: Column) -> Column:
        return F.when((below + by <= len(cuts)) & (F.get(array, below + by - 1) < col), below + by).otherwise(below)

    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), forward)
    return F.transform(F.array(below), lambda b: b * 2 + (F.coalesce(F.get(array, b) == col, F.lit(False))).cast("int"))[0]


def balanced_split_plan(df: DataFrame, col: str, n: int, accuracy: int | None = None) -> DataFrame:
    """One row per range: ``split_id, low, high`` (both values that occur) and ``rows``.

    No range holds more than twice the mean unless it is a single value. Rows without
    a value are a range of their own, the first, with null bounds. Numbers, dates and times can be split; text needs ``typed_split_plan``.

    The cuts are exact at any size. Four passes over the column at most, none with a shuffle of all rows: one sketch of quantiles per task, one
    count per piece and task, the values next to a cut that the sketch has missed, and the rows of the ranges. ``accuracy`` is that of the
    sketch (1,000 n by default) and leaves the result as it is: about the table's rows over it lie next to a cut. The driver holds 6 n pieces.
    """
    rows = _balanced_ranges(df, resolve(df, col), n, accuracy or 1000 * n)
    kind = df.schema[resolve(df, col)].dataType
    schema = f"split_id bigint, low {kind.simpleString()}, high {kind.simpleString()}, rows bigint"
    return df.sparkSession.createDataFrame([(i, p.low, p.high, p.rows) for i, p in enumerate(rows)], schema)


def _balanced_ranges(df: DataFrame, col: str, n: int, accuracy: int) -> list[Piece]:
    if n < 1:
        raise ValueError("the number of splits must be at least 1")
    kind = df.schema[col].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"column {col!r} has no quantiles: {kind.simpleString()}")
    value = F.col("value")
    slim = df.select(quoted(col).alias("value"))
    if isinstance(kind, (FloatType, DoubleType)):
        slim = slim.select(F.when(F.isnan(value), None).otherwise(value).alias("value"))  # as a value it is in no range
    cuts = _cuts(slim, "value", n, accuracy)
    counted = (
        slim.groupBy(F.when(value.isNotNull(), _piece_of(value, cuts, kind)).alias("piece"))
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("rows"))
        .orderBy("piece")
        .collect()
    )
    without = [Piece(True, None, None, r["rows"]) for r in counted if r["piece"] is None]
    pieces = [Piece(r["piece"] % 2 == 1, r["low"], r["high"], r["rows"]) for r in counted if r["piece"] is not None]
    total = sum(p.rows for p in pieces)
    runs = merged_pieces(pieces, 2 * total / n)
    merged = [Piece(a == b and pieces[a].point, pieces[a].low, pieces[b].high, sum(p.rows for p in pieces[a : b + 1])) for a, b in runs]
    return without + merged


def balanced_predicates(src: JdbcSource, col: str, bounds: Sequence) -> list[str]:
    """Conditions that cut a table at ascending bounds: each row satisfies one; the first takes rows without a value.

    The bounds have to ascend in the database's own order, as those it has computed itself do.
    """
    name = src.quote(col)
    if not bounds:
        return [f"({name} IS NULL OR {name} IS NOT NULL)"]
    texts = [src.literal(b) for b in bounds]
    middle = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(texts, texts[1:], strict=False)]
    return [f"({name} < {texts[0]} OR {name} IS NULL)", *middle, f"{name} >= {texts[-1]}"]


def bounds_by_rank(src: JdbcSource, col: str, n: int, query: str | None = None, where: str | None = None) -> str:
    """The query by which the database finds the first value of each of n equal shares of its rows, in its own order."""
    name = src.quote(col)
    ranked = f"SELECT {name} AS v, NTILE({n}) OVER (ORDER BY {name}) AS share FROM {src.relation(query, where)} WHERE {name} IS NOT NULL"
    return f"SELECT share, MIN(v) AS low FROM ({ranked}) ranked GROUP BY share ORDER BY share"


def balanced_scan(
    spark: SparkSession, src: JdbcSource, col: str, n: int, query: str | None = None, where: str | None = None
) -> DataFrame:
    """Read a database table in at most n ranges of about equal rows, one task each; the column may be text.

    The database ranks its own rows, so its collation places the bounds and cuts the rows alike. A value that spans several
    shares starts a range of its own. It costs the database one sort of the column.
    """
    if n < 1:
        raise ValueError("the number of splits must be at least 1")
    found = spark.read.format("jdbc").options(**src.options(query=bounds_by_rank(src, col, n, query, where))).load().collect()
    predicates = balanced_predicates(src, col, distinct_bounds([r["low"] for r in sorted(found, key=lambda r: r["share"])]))
    options = src.options()
    url = options.pop("url")
    return spark.read.jdbc(url, src.relation(query, where), predicates=predicates, properties=options)


def distinct_bounds(lows: Sequence) -> list:
    """The first values of shares but the first one, repeats of a value that fills several shares left out."""
    bounds: list = []
    for low, before in zip(lows[1:], lows, strict=False):
        if low != before:
            bounds.append(low)
    return bounds


# --- equal-width ranges of other types ---------------------------------------------------------

#: Characters of text that place it between two others, after what all of them begin with.
TEXT_CHARS = 6
#: A character counts as its code point plus one, an absent one as zero; so many counts there are.
TEXT_BASE = 0x110001
_EPOCH = date(1970, 1, 1)
_SURROGATES = range(0xD800, 0xE000)


def text_number(text: str) -> int:
    """The first characters as a whole number that ascends as the text does.

    Code points ascend as UTF-8 bytes do. Texts that agree in ``TEXT_CHARS`` characters get the same number.
    """
    digits = [ord(c) + 1 for c in text[:TEXT_CHARS]]
    number = 0
    for digit in digits + [0] * (TEXT_CHARS - len(digits)):
        number = number * TEXT_BASE + digit
    return number


def number_text(number: int, prefix: str = "") -> str:
    """``prefix`` and a text of that number, or of the next one that a text can have."""
    digits = []
    for _ in range(TEXT_CHARS):
        number, digit = divmod(number, TEXT_BASE)
        digits.insert(0, digit)
    out = prefix
    for digit in digits:
        if digit == 0:
            break  # nothing can follow an absent character
        out += chr(0xE000 if digit - 1 in _SURROGATES else digit - 1)
    return out


def _to_number(value, kind: DataType, prefix: int) -> int:
    if isinstance(kind, StringType):
        return text_number(value[prefix:])
    if isinstance(kind, DateType):
        return (value - _EPOCH).days
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return (value - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    if isinstance(kind, DecimalType):
        sign, digits, exponent = value.as_tuple()
        whole = int("".join(map(str, digits))) * 10 ** (kind.scale + exponent)
        return -whole if sign else whole
    return int(value)


def _from_number(number: int, kind: DataType, prefix: str):
    if isinstance(kind, StringType):
        return number_text(number, prefix)
    if isinstance(kind, DateType):
        return _EPOCH + timedelta(days=number)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return datetime(1970, 1, 1) + timedelta(microseconds=number)
    if isinstance(kind, DecimalType):
        sign, digits = int(number < 0), tuple(map(int, str(abs(number))))
        return Decimal((sign, digits, -kind.scale))
    return number


def typed_bounds(lo, hi, kind: DataType, n: int) -> list:
    """The first value of every range but the first: at most ``n - 1`` values that ascend from ``lo`` to ``hi``.

    The ranges are equally wide in whole units: days, microseconds, units of the last place, or the numbers of
    texts after the beginning that ``lo`` and ``hi`` share. Doubles are cut in double arithmetic.
    """
    if n < 1:
        raise ValueError("the number of splits must be at least 1")
    if lo is None or hi is None:
        return []
    if isinstance(kind, (FloatType, DoubleType)):
        cuts = [lo + (hi / n - lo / n) * i for i in range(1, n)]
        return sorted({c for c in cuts if lo < c <= hi})
    prefix = commonprefix([lo, hi]) if isinstance(kind, StringType) else ""
    first, last = (_to_number(v, kind, len(prefix)) for v in (lo, hi))
    width = -(-(last - first + 1) // n)
    cuts = [_from_number(first + i * width, kind, prefix) for i in range(1, n) if first + i * width <= last]
    ascending: list = []
    for cut in cuts:  # two numbers of texts can stand for one text
        if cut > (ascending[-1] if ascending else lo) and cut <= hi:
            ascending.append(cut)
    return ascending


def typed_split_plan(df: DataFrame, col: str, n: int) -> DataFrame:
    """One row per equal-width range of a date, time, decimal, double, text or whole-number column.

    ``split_id, low, high, rows``: a range holds the values from ``low`` on and before the next range's ``low``;
    ``high`` is the largest value that may occur (the next ``low`` for types without a next smaller value: text and doubles). Empty ranges
    are listed. Rows without a value, and doubles that are no numbers, go to the first range. An empty column has no ranges.

    Text is compared by code points, as Spark does; databases with another collation are split by
    ``balanced_scan``. MIN and MAX come in one pass, the counts in another, one row per range and task.
    """
    col = resolve(df, col)
    kind = df.schema[col].dataType
    if not isinstance(kind, (IntegralType, DateType, TimestampType, TimestampNTZType, DecimalType, DoubleType, FloatType, StringType)):
        raise ValueError(f"column {col!r} cannot be split: {kind.simpleString()}")
    value = _finite(quoted(col), kind)
    lo, hi = single_row(df.select(value.alias("v")).agg(F.min("v").alias("lo"), F.max("v").alias("hi")))
    if lo is None:
        lows: list = []
    else:
        lows = [lo, *typed_bounds(lo, hi, kind, n)]
    highs = [_before(low, kind) for low in lows[1:]] + ([hi] if lows else [])
    counts = df.select(_range_of(value, lows, kind).alias("split_id")).groupBy("split_id").agg(F.count("*").alias("rows"))
    name = kind.simpleString()
    stored = [(i, _literal(a), _literal(b)) for i, (a, b) in enumerate(zip(lows, highs, strict=True))]
    ranges = df.sparkSession.createDataFrame(stored, "split_id bigint, low string, high string")
    ranges = ranges.select("split_id", F.col("low").cast(name).alias("low"), F.col("high").cast(name).alias("high"))
    joined = ranges.join(counts.withColumn("split_id", F.col("split_id").cast("bigint")), "split_id", "left")
    return joined.withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))


def with_typed_split(df: DataFrame, col: str, n: int) -> DataFrame:
    """Every row with the ``split_id`` that ``typed_split_plan`` counts it in; nothing is shuffled."""
    col = resolve(df, col)
    refuse_column(df, "split_id")
    kind = df.schema[col].dataType
    value = _finite(quoted(col), kind)
    lo, hi = single_row(df.select(value.alias("v")).agg(F.min("v").alias("lo"), F.max("v").alias("hi")))
    lows = [] if lo is None else [lo, *typed_bounds(lo, hi, kind, n)]
    return df.withColumn("split_id", _range_of(value, lows, kind).cast("bigint"))


def _finite(value: Column, kind: DataType) -> Column:
    if not isinstance(kind, (FloatType, DoubleType)):
        return value
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def _range_of(value: Column, lows: list, kind: DataType) -> Column:
    """How many ranges begin at or before the value, less one; halving steps as in ``_piece_of``."""
    cuts = lows[1:]
    if not cuts:
        return F.lit(0)
    array = F.array(*[F.lit(_literal(c)).cast(kind) for c in cuts])
    steps, step = [], 1
    while step <= len(cuts):
        steps.insert(0, step)
        step *= 2

    def forward(found: Column, by: Column) -> Column:
        return F.when((found + by <= len(cuts)) & (F.get(array, found + by - 1) <= value), found + by).otherwise(found)

    return F.coalesce(F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), forward), F.lit(0))


def _before(low, kind: DataType):
    """The value before, where the type has one."""
    if isinstance(kind, (StringType, FloatType, DoubleType)):
        return low
    return _from_number(_to_number(low, kind, 0) - 1, kind, "")


def _literal(value) -> str:
    return format(value, "f") if isinstance(value, Decimal) else repr(value) if isinstance(value, float) else str(value)
