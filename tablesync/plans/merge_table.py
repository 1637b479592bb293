"""Merging a batch into a catalog table, published by a switch of the table's location."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tablesync.operators.checks import guard_keys, key_columns
from tablesync.operators.columns import quoted
from tablesync.operators.merge import latest_per_key, merge_to_old_schema, without_keys
from tablesync.sinks.files import write_parquet
from tablesync.sources.scan import parquet_scan
from tablesync.storage import delete, shared_dir


@dataclass(frozen=True)
class StoredTable:
    """How a catalog table is stored."""

    location: str
    provider: str
    buckets: int
    bucket_columns: tuple[str, ...]
    sort_columns: tuple[str, ...]
    partition_columns: tuple[str, ...]


def stored_table(spark: SparkSession, name: str) -> StoredTable:
    rows = {}
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        rows.setdefault(row["col_name"], row["data_type"])

    def columns(label: str) -> tuple[str, ...]:
        text = (rows.get(label) or "[]").strip()[1:-1]
        return tuple(c.strip().strip("`") for c in text.split(",") if c.strip())

    return StoredTable(
        location=rows["Location"],
        provider=(rows.get("Provider") or "").lower(),
        buckets=int(rows.get("Num Buckets") or 0),
        bucket_columns=columns("Bucket Columns"),
        sort_columns=columns("Sort Columns"),
        partition_columns=tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition),
    )


def merged_rows(spark: SparkSession, name: str, new: DataFrame, key: str | Sequence[str], key_as_text: bool = False) -> DataFrame:
    """The table's rows without the keys of ``new``, and ``new``, whose keys are unique.

    A table bucketed by the key is joined where its buckets lie: only the batch's keys are
    shuffled to them, at any size of the batch.
    """
    old = spark.table(name)
    keys = key_columns(old, key)
    old, new = guard_keys(old, keys), guard_keys(new, keys)
    kept = without_keys(old, new, keys, key_as_text)
    return kept.unionByName(new.select(*map(quoted, old.columns)))


def merge_table(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    key: str | Sequence[str],
    tie_break: str | Sequence[str] = (),
    codec: str = "snappy",
    key_as_text: bool = False,
    wide_decimals: Sequence[str] = (),
    keep_previous: bool = False,
) -> str:
    """Merge ``batch`` into a Parquet table of the catalog; gives the table's new location.

    New rows win, one row per key; the table's keys must be unique, as a merge leaves them, and its schema holds.

    The merged rows are written to a new folder beside the old one, in the same buckets, and the table is then
    pointed there by one change in the catalog. Nothing is renamed, so this is the way to publish on
    an object store; a reader sees the old files or the new ones. Until the switch nothing has changed; a failure removes the new folder.
    The table's side is neither shuffled for the join nor for its buckets: tasks that read a bucket write it again.
    A bucket gets at most two files, one of old and one of new rows. ``keep_previous``
    leaves the old folder, for readers that are still at it.

    Partitioned tables are refused, as each of their partitions has a location of its own: merge their files instead.
    """
    table = stored_table(spark, name)
    if table.partition_columns:
        raise ValueError(f"{name} is partitioned by {list(table.partition_columns)}: merge its files instead")
    if table.provider != "parquet":
        raise ValueError(f"{name} is stored as {table.provider}, not as Parquet")
    old = spark.table(name)
    keys = key_columns(old, key)
    reduced = latest_per_key(merge_to_old_schema(batch, old.schema), keys, tie_break, key_as_text, wide_decimals)
    scratch = shared_dir(spark, "table-batch")
    location = f"{_parent(table.location)}/{name.rpartition('.')[2].strip('`')}__version-{uuid4().hex}"
    staging = f"merge_{uuid4().hex}"
    try:
        write_parquet(reduced, scratch)
        new = parquet_scan(spark, scratch, old.schema)
        if new.isEmpty():
            return table.location
        if table.buckets:
            # in the buckets' partitioning, so that the write makes a file per bucket of it
            new = new.repartition(table.buckets, *map(quoted, table.bucket_columns))
        writer = merged_rows(spark, name, new, keys, key_as_text).write.format("parquet")
        writer = writer.option("compression", codec).option("path", location)
        if table.buckets:
            writer = writer.bucketBy(table.buckets, *table.bucket_columns)
            if table.sort_columns:
                writer = writer.sortBy(*table.sort_columns)
        try:
            writer.saveAsTable(staging)
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location.replace(chr(39), chr(92) + chr(39))}'")
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {staging}")
            delete(spark, location)
            raise
        spark.sql(f"DROP TABLE IF EXISTS {staging}")  # external: its files stay
        spark.catalog.refreshTable(name)
        if not keep_previous:
            delete(spark, table.location)
        return location
    finally:
        delete(spark, scratch)


def _parent(location: str) -> str:
    return location.rstrip("/").rpartition("/")[0]
