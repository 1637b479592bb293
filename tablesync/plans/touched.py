"""Merging a batch into a Parquet dataset by rewriting only the files it touches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, NumericType, StringType, StructType, TimestampNTZType

from tablesync.operators.checks import guard_keys, key_columns, single_row
from tablesync.operators.columns import quoted
from tablesync.operators.merge import free_name, latest_per_key, matching, merge_to_old_schema, without_keys
from tablesync.sinks.files import write_parquet
from tablesync.sinks.journal import recover_files, replace_files
from tablesync.sinks.swap import recover_swap
from tablesync.sources.scan import parquet_scan
from tablesync.storage import data_files, delete, qualified, shared_dir


@dataclass(frozen=True)
class TouchedMerge:
    """What a merge did: files kept as they were, files replaced, files written."""

    kept: int
    replaced: int
    written: int


def partition_columns(files: Sequence[str]) -> list[str]:
    """The partition columns in the folder names of a dataset's files, outermost first."""
    found = {tuple(unquote(p.split("=", 1)[0]) for p in f.split("/")[:-1]) for f in files}
    if len(found) > 1:
        raise ValueError(f"files lie in folders of different kinds: {sorted(found)[:3]}")
    return list(found.pop()) if found else []


def merge_touched(
    spark: SparkSession,
    target: str,
    batch: DataFrame,
    key: str | Sequence[str],
    tie_break: str | Sequence[str] = (),
    codec: str = "snappy",
    key_as_text: bool = False,
    wide_decimals: Sequence[str] = (),
    rows_per_file: int | None = None,
) -> TouchedMerge:
    """Merge ``batch`` into the dataset at ``target``; files without a key of the batch stay as they are.

    The rule is that of ``merge_latest`` for existing rows with unique keys, as an
    earlier merge leaves them: new rows win, one row per key, the existing schema holds.

    * The files to rewrite are found by a semi-join of the key columns alone with
      the batch's keys. The batch's key range, and its partition values where the
      partition columns belong to the key, go to the scan as filters first, so
      files and row groups that cannot match are not opened.
    * Only these files are read whole, joined and written again; new keys are written
      beside them. Rows go out in ranges of the key, as many as files were
      replaced, so that a dataset laid out by key stays laid out by key.
    * Partition folders stay. A row whose partition value changes leaves its old
      file, as files are found by key wherever they lie.
    * Publishing replaces files by name (see ``replace_files``). What is cut off
      before has changed nothing; what is cut off within is finished by the next merge.

    The driver holds the names of the dataset's files, as Spark does for any scan. An
    empty batch changes nothing. A null key on either side of the touched files, or in the batch, is an error.
    ``rows_per_file`` caps the rows of a written file.
    """
    target = target.rstrip("/")
    recover_swap(spark, target)
    recover_files(spark, target)
    files = data_files(spark, target)
    if not files:
        raise ValueError(f"no existing data at {target} to merge into")
    old = parquet_scan(spark, target, merge_schema=True)
    parts = [c for c in old.columns if c in partition_columns(list(files))]
    keys = key_columns(old, key)
    reduced = latest_per_key(merge_to_old_schema(batch, old.schema), keys, tie_break, key_as_text, wide_decimals)
    scratch = shared_dir(spark, "touched-batch")
    try:
        write_parquet(reduced, scratch)
        new = parquet_scan(spark, scratch, old.schema)
        if new.isEmpty():
            return TouchedMerge(len(files), 0, 0)
        touched = _touched_files(spark, target, old, new, keys, parts, key_as_text)
        staging = f"{target}__merge-{uuid4().hex}"
        rows = new
        if touched:
            reader = spark.read.schema(_ordered(old.schema, parts)).option("basePath", target)
            stored = reader.parquet(*[f"{qualified(spark, target)}/{name}" for name in touched])
            stored = guard_keys(stored.select(*map(quoted, old.columns)), keys)
            rows = without_keys(stored, new, keys, key_as_text).unionByName(new)
        try:
            laid_out = _by_key(rows, keys, parts, max(len(touched), len(data_files(spark, scratch))))
            options = {} if rows_per_file is None else {"maxRecordsPerFile": rows_per_file}
            write_parquet(laid_out, staging, codec, partition_by=parts, **options)
            added = [name for name, size in data_files(spark, staging).items() if size]
        except Exception:
            delete(spark, staging)
            raise
        replace_files(spark, target, staging, added, sorted(touched))
        return TouchedMerge(len(files) - len(touched), len(touched), len(added))
    finally:
        delete(spark, scratch)


def _ordered(schema: StructType, parts: list[str]) -> StructType:
    """The schema as Spark reads it: partition columns last."""
    fields = {f.name: f for f in schema.fields}
    return StructType([f for f in schema.fields if f.name not in parts] + [fields[c] for c in parts])


def _touched_files(
    spark: SparkSession, target: str, old: DataFrame, new: DataFrame, keys: list[str], parts: list[str], as_text: bool
) -> set[str]:
    path = free_name("__file", old)
    # read before anything renames columns: _metadata belongs to the scan
    slim = old.select(*map(quoted, keys), F.col("_metadata.file_path").alias(path))
    if not as_text:
        slim = slim.where(_key_range(new, keys))
        own = [c for c in parts if c in keys]
        if own:
            # at most one row per partition folder that the batch writes to
            values = new.select(*map(quoted, own)).distinct().collect()
            slim = slim.where(reduce(Column.__or__, [_equal(own, v, new) for v in values]))
    hit = matching(slim, new, keys, as_text).select(path).distinct()
    base = qualified(spark, target) + "/"
    known = data_files(spark, target)
    found = (_one_slash(row[0]).removeprefix(_one_slash(base)) for row in hit.collect())
    names = {name if name in known else unquote(name) for name in found}
    if stray := names - known.keys():
        raise RuntimeError(f"the dataset changed during the merge: {sorted(stray)[:3]}")
    return names


def _one_slash(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else path


def _equal(names: list[str], values, df: DataFrame) -> Column:
    return reduce(
        Column.__and__,
        [quoted(c).eqNullSafe(F.lit(None if v is None else str(v)).cast(df.schema[c].dataType)) for c, v in zip(names, values, strict=True)],
    )


def _key_range(new: DataFrame, keys: list[str]) -> Column:
    """A filter on what every key of the batch lies within, for the scan's statistics."""
    kinds = (NumericType, StringType, DateType, TimestampNTZType)
    usable = [c for c in keys if isinstance(new.schema[c].dataType, kinds)]
    if not usable:
        return F.lit(True)
    bounds = [f(quoted(c)).alias(f"{side}_{i}") for i, c in enumerate(usable) for side, f in (("lo", F.min), ("hi", F.max))]
    found = single_row(new.agg(*bounds))
    condition = F.lit(True)
    for i, c in enumerate(usable):
        kind = new.schema[c].dataType
        low, high = (F.lit(_literal(v, kind)).cast(kind) for v in found[2 * i : 2 * i + 2])
        condition = condition & (quoted(c) >= low) & (quoted(c) <= high)
    return condition


def _literal(value, kind):
    return value if isinstance(kind, (NumericType, StringType)) and not isinstance(kind, DecimalType) else str(value)


def _by_key(rows: DataFrame, keys: list[str], parts: list[str], ranges: int) -> DataFrame:
    """The rows in that many ranges of partition and key."""
    order = [*parts, *[k for k in keys if k not in parts]]
    return rows.repartitionByRange(ranges, *map(quoted, order)).sortWithinPartitions(*map(quoted, order))
