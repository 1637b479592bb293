"""Rows and their large values, written by one job and published together."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tablesync.functions.texts import reference
from tablesync.operators.columns import quoted, resolve
from tablesync.operators.merge import free_name
from tablesync.sinks.files import write_parquet
from tablesync.sinks.journal import commit, recover_files
from tablesync.sources.scan import parquet_scan
from tablesync.storage import data_files, delete

#: Beside the rows' folder: a folder of large values per column.
SIDE = "__lobs"


def lob_path(target: str, col: str) -> str:
    return f"{target.rstrip('/')}{SIDE}/{col}"


def split_lobs(df: DataFrame, key: str, limits: Mapping[str, int], label: str, kind: str) -> DataFrame:
    """Every row with its large values replaced by references, and a row more for each of these values.

    ``kind`` is empty for the former; for the latter it is the column, which holds the value beside the key, and the other columns are null.
    Rows are read once, nothing is shuffled, and only rows of large values carry them.
    """
    key = resolve(df, key)
    columns = {resolve(df, c): limit for c, limit in limits.items()}
    for c, limit in columns.items():
        if not isinstance(df.schema[c].dataType, (StringType, BinaryType)):
            raise ValueError(f"column {c!r} holds no large values: {df.schema[c].dataType.simpleString()}")
        if limit < 0:
            raise ValueError("limit must not be negative")
        if c == key:
            raise ValueError(f"column {c!r} names the values and cannot be one")
    large = {c: F.octet_length(quoted(c)) > limit for c, limit in columns.items()}
    main = [
        F.when(large[f.name], reference(key, f.name, label).cast(f.dataType)).otherwise(quoted(f.name)).alias(f.name)
        if f.name in columns
        else quoted(f.name).alias(f.name)
        for f in df.schema.fields
    ]
    versions = [F.struct(F.lit("").alias(kind), *main)]
    for c in columns:
        own = [
            (quoted(f.name) if f.name in (c, key) else F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema.fields
        ]
        versions.append(F.when(large[c], F.struct(F.lit(c).alias(kind), *own)))
    return df.select(F.inline(F.filter(F.array(*versions), lambda row: row.isNotNull())))


def write_with_lobs(
    df: DataFrame,
    target: str,
    key: str,
    limits: Mapping[str, int],
    label: str = "table",
    codec: str = "snappy",
    overwrite: bool = False,
) -> None:
    """Write ``df`` to ``target`` and its values of more than ``limits[column]`` bytes beside it (see ``lob_path``).

    One job reads the rows once and writes both kinds, in a folder each. A journal then moves all files in, or none: what is
    cut off before it has changed nothing, what is cut off later is finished by the next import. ``key`` must identify the rows. A
    large value in a row without a key is an error. With ``overwrite`` the files that were there go last.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    recover_files(spark, target)
    folders = {"": target, **{resolve(df, c): lob_path(target, resolve(df, c)) for c in limits}}
    before = {folder: list(data_files(spark, folder)) for folder in folders.values()}
    if any(before.values()) and not overwrite:
        raise FileExistsError(f"{target} exists: overwrite?")
    kind, staging = free_name("__kind", df), f"{target}__lobs-{uuid4().hex}"
    try:
        write_parquet(split_lobs(df, key, limits, label, kind), staging, codec, partition_by=[kind])
        written = data_files(spark, staging)
    except Exception:
        delete(spark, staging)
        raise
    moves = []
    for column, folder in folders.items():
        # Spark's name for an empty text in a folder name
        own = f"{kind}={column or '__HIVE_DEFAULT_PARTITION__'}/"
        moves += [(f"{staging}/{name}", f"{folder}/{name.removeprefix(own)}") for name in written if name.startswith(own)]
    old = [f"{folder}/{name}" for folder, names in before.items() for name in names]
    commit(spark, target, staging, moves, old)


def read_lobs(spark: SparkSession, target: str, key: str, col: str, label: str = "table") -> DataFrame:
    """The side table ``(reference, payload)`` of a column; no rows if it had no large value."""
    rows = parquet_scan(spark, target)
    folder = lob_path(target, col)
    side = parquet_scan(spark, folder, rows.schema) if data_files(spark, folder) else rows.limit(0)
    return side.select(reference(key, col, label).alias("reference"), quoted(col).alias("payload"))
