"""Counts, key fitness, guards and schema compatibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

from tablesync.functions.decimals import number_order
from tablesync.operators.columns import quoted, resolve, where_filter
from tablesync.sources.jdbc import JdbcSource

NULL_KEY = "cannot merge on a null key: does the key column hold a value in every row?"


def key_columns(df: DataFrame, key: str | Sequence[str]) -> list[str]:
    names = [key] if isinstance(key, str) else list(key)
    if not names:
        raise ValueError("a merge key is required")
    return [resolve(df, k) for k in names]


def require_check_column(df: DataFrame, col: str) -> str:
    """The check column's name; text columns cannot tell which rows are new."""
    name = resolve(df, col)
    if isinstance(df.schema[name].dataType, StringType):
        raise ValueError(f"character column {name!r} cannot be used to find new rows")
    return name


def max_check_value(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """One row ``max_value``: the upper bound of an append import."""
    name = require_check_column(df, col)
    return where_filter(df, where).agg(F.max(quoted(name)).alias("max_value"))


def max_wide_value(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """One row ``max_value``: the greatest of numbers in text, of any number of digits, as it is written."""
    name = resolve(df, col)
    if not isinstance(df.schema[name].dataType, StringType):
        raise ValueError(f"column {name!r} is not text")
    order = F.struct(number_order(quoted(name), name).alias("order"), quoted(name).alias("value"))
    return where_filter(df, where).agg(F.max(order)["value"].alias("max_value"))


def jdbc_max_check_value(
    spark: SparkSession, src: JdbcSource, col: str, query: str | None = None, where: str | None = None
) -> DataFrame:
    """The same, computed by the database."""
    df = spark.read.format("jdbc").options(**src.options(query=src.max_query(col, query, where))).load()
    require_check_column(df, "max_value")
    return df


def single_row(df: DataFrame) -> tuple:
    """The one row of an aggregate, with timestamps as wall-clock times of the session's zone.

    Collected as they are, they would come in the zone of the Python process.
    """
    wall = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, TimestampType)}
    return tuple(df.withColumns(wall).first())


def validate_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row ``source_rows, target_rows, ok``."""
    counts = source.agg(F.count("*").alias("source_rows")).select(
        "source_rows", target.agg(F.count("*")).scalar().alias("target_rows")
    )
    return counts.withColumn("ok", F.col("source_rows") == F.col("target_rows"))


def key_profile(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Is this key fit for merging?

    One row ``rows, distinct_keys, null_keys, duplicate_keys``: null keys are
    counted in rows, duplicate keys are keys with more than one row. Rows are
    counted per key map-side, so a heavy key sends one row per task.
    """
    keys = key_columns(df, key)
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("key_rows"))
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | quoted(k).isNull()
    zero = F.lit(0).cast("bigint")
    return counts.select("key_rows", has_null.alias("has_null")).agg(
        F.coalesce(F.sum("key_rows"), zero).alias("rows"),
        F.count_if(~F.col("has_null")).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("has_null"), F.col("key_rows"))), zero).alias("null_keys"),
        F.count_if(~F.col("has_null") & (F.col("key_rows") > 1)).alias("duplicate_keys"),
    )


def guard_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The same rows, but a row without a key value fails the job.

    A filter rather than a rewritten key column: it also runs when the key is not
    read later, and leaves a bucketed table's partitioning by the key intact.
    """
    for k in key_columns(df, key):
        missing = F.raise_error(F.lit(f"{NULL_KEY} (column {k})")).cast("boolean")
        df = df.where(F.when(quoted(k).isNull(), missing).otherwise(F.lit(True)))
    return df


def merge_schema_check(old: StructType, new: StructType | None, strict: bool = False) -> None:
    """Raise unless rows of either schema can be read as the other.

    Shared columns (matched without regard to case) must have the same type,
    precision and scale included. A column on one side only must be nullable, as
    it reads as null on the other. ``strict`` wants equal schemas, the rule for
    Avro files. ``new=None`` stands for a batch without files: nothing to check.
    """
    if old is None or not old.fields:
        raise ValueError("the existing data has no schema to merge into")
    if new is None:
        return
    if strict:
        if [(f.name, f.dataType) for f in old.fields] != [(f.name, f.dataType) for f in new.fields]:
            raise ValueError(f"schemas differ: {old.simpleString()} and {new.simpleString()}")
        return
    mine = {f.name.lower(): f for f in old.fields}
    theirs = {f.name.lower(): f for f in new.fields}
    problems = []
    for name in mine.keys() | theirs.keys():
        a, b = mine.get(name), theirs.get(name)
        if a is not None and b is not None:
            if a.dataType != b.dataType:
                problems.append(f"{name} is {a.dataType.simpleString()} and {b.dataType.simpleString()}")
        elif not (a or b).nullable:
            problems.append(f"{name} is on one side only and not nullable")
    if problems:
        raise ValueError("cannot merge, schemas are not compatible: " + "; ".join(sorted(problems)))
