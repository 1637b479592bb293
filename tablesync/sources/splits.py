"""Range splits of a table by one column.

A split is an equal-width range. The width is ``ceil(span / n)`` where ``n`` is
raised until no range is wider than ``split_limit``; every row belongs to exactly
one split, rows without a split value to the first.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, IntegralType, MapType, StringType, StructType, VariantType

from tablesync.operators.checks import single_row
from tablesync.operators.columns import quoted, refuse_column, resolve
from tablesync.sources.jdbc import JdbcSource
from tablesync.sources.scan import Source, parquet_scan, scan_table

#: Bytes of rows in a range that is laid out for one task, as Spark's own file splits.
RANGE_BYTES = 128 * 2**20


def split_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row ``(lo, hi)``: smallest and largest value of the split column."""
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))


def _width(lo: Column, hi: Column, n: int, split_limit: int | None) -> Column:
    width = F.call_function("div", hi - lo + n, F.lit(n))
    return width if split_limit is None else F.least(width, F.lit(split_limit).cast("bigint"))


def _layout(df: DataFrame, col: str, n: int, split_limit: int | None) -> Column:
    """``struct(lo, hi, width)`` as a scalar subquery over the split column alone.

    However often a plan uses it, Spark runs it once.
    """
    if n < 1:
        raise ValueError("the number of splits must be at least 1")
    if split_limit is not None and split_limit < 1:
        raise ValueError("split_limit must be at least 1")
    if not isinstance(df.schema[col].dataType, IntegralType):
        raise ValueError(f"split column {col!r} must be an integer column")
    bounds = split_bounds(df.select(quoted(col).cast("bigint").alias("key")), "key")
    # decimal(20,0) keeps the division exact over the whole bigint range
    lo, hi = F.col("lo").cast("decimal(20,0)"), F.col("hi").cast("decimal(20,0)")
    width = _width(lo, hi, n, split_limit).cast("bigint").alias("width")
    return bounds.select(F.struct("lo", "hi", width)).scalar()


def with_split_id(df: DataFrame, col: str, n: int, split_limit: int | None = None) -> DataFrame:
    """Add ``split_id`` to every row: arithmetic on the bounds, nothing is shuffled."""
    col = resolve(df, col)
    refuse_column(df, "split_id")
    layout = _layout(df, col, n, split_limit)
    return df.withColumn("split_id", _split_id(col, layout["lo"], layout["width"]))


def _split_id(col: str, lo: Column, width: Column) -> Column:
    return F.coalesce(F.call_function("div", quoted(col).cast("bigint") - lo, width), F.lit(0)).cast("bigint")


def split_plan(df: DataFrame, col: str, n: int, split_limit: int | None = None) -> DataFrame:
    """One row per split: ``split_id, low, high`` (both inclusive) and ``rows``.

    Rows are counted map-side per split, so one range holding most rows costs no
    more than the others. Empty splits are listed with 0 rows. The bounds are read
    at once; the splits are then listed by as many tasks as Spark's own ranges.
    """
    col = resolve(df, col)
    spark = df.sparkSession
    lo, hi, width = single_row(spark.range(1).select(_layout(df, col, n, split_limit).alias("layout")).select("layout.*"))
    splits = 0 if width is None else (hi - lo) // width + 1
    low = F.lit(lo).cast("bigint") + F.col("id") * F.lit(width).cast("bigint")
    # the last split may be shorter; ending it from below cannot overflow
    left = F.lit(hi).cast("bigint") - low
    ranges = spark.range(splits).select(
        F.col("id").alias("split_id"), low.alias("low"), (low + F.least(F.lit(width).cast("bigint") - 1, left)).alias("high")
    )
    keys = df.select(_split_id(col, F.lit(lo).cast("bigint"), F.lit(width).cast("bigint")).alias("split_id"))
    counts = keys.groupBy("split_id").agg(F.count("*").alias("rows"))
    return ranges.join(counts, "split_id", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))


def split_count(lo, hi, n: int, split_limit: int | None = None) -> int:
    """Number of splits for known bounds: ``max(n, ceil((hi - lo + 1) / split_limit))``."""
    if n < 1:
        raise ValueError("the number of splits must be at least 1")
    if split_limit is None or lo is None or hi is None:
        return n
    if split_limit < 1:
        raise ValueError("split_limit must be at least 1")
    span = (hi - lo).days + 1 if isinstance(lo, (date, datetime)) else int(hi - lo) + 1
    return max(n, -(-span // split_limit))


def split_scan(
    spark: SparkSession,
    src: Source,
    split_by: str | None,
    n: int,
    bounds: tuple | None = None,
    split_limit: int | None = None,
    where: str | None = None,
    query: str | None = None,
    boundary_query: str | None = None,
    auto_reset: bool = False,
    clustered: bool = False,
) -> DataFrame:
    """Read in ``n`` parallel ranges of ``split_by``.

    Database: one JDBC range per task; bounds come from ``bounds``, from
    ``boundary_query``, or from MIN/MAX run in the database. They only place the
    ranges: rows outside them land in the first or last range, none is lost.

    Files are already read in parallel by their own byte splits, so ``split_by``
    costs nothing there unless ``clustered=True`` asks for the rows to be laid
    out by range. That is one shuffle; rows of one heavy value are spread over
    neighbouring partitions by a hash of the whole row. There are ``n`` ranges, or
    more where one would hold over ``RANGE_BYTES``.
    """
    if n > 1 and split_by is None:
        if not auto_reset:
            raise ValueError("a parallel read needs a split column (or auto_reset=True)")
        n = 1
    if not isinstance(src, JdbcSource):
        df = scan_table(spark, src if isinstance(src, DataFrame) else parquet_scan(spark, src), where=where)
        if not clustered or n == 1:
            return df
        return cluster_by_range(df, [split_by], n)

    read = {"dbtable": src.relation(query, where)}
    if n > 1 or (split_by is not None and split_limit is not None):
        if bounds is None:
            text = boundary_query or src.bounds_query(split_by, query, where)
            bounds = single_row(spark.read.format("jdbc").options(**src.options(query=text)).load())
        read.update(range_options(split_by, bounds, n, split_limit))
    return spark.read.format("jdbc").options(**src.options(**read)).load()


def range_options(split_by: str, bounds: Sequence, n: int, split_limit: int | None = None) -> dict[str, str]:
    """Spark's JDBC range options; none for an empty table."""
    lo, hi = bounds
    count = split_count(lo, hi, n, split_limit)
    if lo is None or hi is None or count == 1:
        return {}
    if isinstance(lo, (float, Decimal)) or isinstance(hi, (float, Decimal)):
        lo, hi = floor(lo), ceil(hi)  # bounds of number columns are read as whole numbers
    return {
        "partitionColumn": split_by,
        "lowerBound": str(lo),
        "upperBound": str(hi),
        "numPartitions": str(count),
    }


def ranges_for(df: DataFrame, n: int) -> int:
    """``n``, or as many ranges as keep each under about ``RANGE_BYTES``, so that a task's share does not grow with the table.

    Counts the rows and the bytes of their texts; every other value counts as its type's size. One pass over the columns of varying
    length, and a count alone (of files, from their footers) where there are none.
    """
    fixed, varying = 0, F.lit(0).cast("bigint")
    for field in df.schema.fields:
        kind, value = field.dataType, quoted(field.name)
        fixed += 8
        if isinstance(kind, (StringType, BinaryType)):
            varying += F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            varying += F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        elif isinstance(kind, DecimalType):
            fixed += 16
    rows, size = df.agg(F.count("*"), F.sum(varying)).first()
    return max(n, -(-(rows * fixed + (size or 0)) // RANGE_BYTES))


def cluster_by_range(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """Range layout by ``cols`` in at least ``n`` partitions (see ``ranges_for``); the row hash is deterministic, so a retried task repeats it."""
    keys = [quoted(resolve(df, c)) for c in cols]
    return df.repartitionByRange(ranges_for(df, n), *keys, F.xxhash64(*map(quoted, df.columns)))
