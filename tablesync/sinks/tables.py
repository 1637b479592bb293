"""Catalog tables and exports through a staging table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesync.functions.casts import lossless
from tablesync.operators.columns import select_columns
from tablesync.operators.merge import merge_to_old_schema
from tablesync.sources.jdbc import JdbcSource


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "error",
    path: str | None = None,
    codec: str = "snappy",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """A Parquet table in the session's catalog.

    ``bucket_by=(n, [key])`` lays it out for later merges: the table's side of a
    merge by that key then needs no shuffle.
    """
    if bucket_by is not None and not partition_by:
        # one task per bucket: at most as many files as buckets, instead of tasks times buckets
        df = df.repartition(bucket_by[0], *bucket_by[1])
    writer = df.write.format("parquet").mode(mode).option("compression", codec)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        count, keys = bucket_by
        writer = writer.bucketBy(count, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Add rows to an existing table, columns matched by name; a value its type cannot hold exactly is an error."""
    target = df.sparkSession.table(name)
    missing = {c.lower() for c in target.columns} - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"the rows lack columns {sorted(missing)}")
    merge_to_old_schema(df, target.schema).write.insertInto(name)


def export_table(
    df: DataFrame, target: str, staging: str, columns: Sequence[str] | None = None
) -> None:
    """Insert ``df`` into an existing catalog table through a staging table.

    A failure while rows are computed leaves the target as it was: only the
    complete staging table is copied over, in one statement.
    """
    spark = df.sparkSession
    names = list(columns or df.columns)
    listed = ", ".join("`" + c.replace("`", "``") + "`" for c in names)
    wanted = select_columns(df, names)
    spelled = {f.name.lower(): f for f in spark.table(target).schema.fields}
    unknown = [c for c in names if c.lower() not in spelled]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    exact = [lossless(wanted, c, spelled[c.lower()].dataType).alias(c) for c in names]
    write_table(wanted.select(exact), staging)
    try:
        spark.sql(f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")


def move_statement(
    dest: JdbcSource, staging: str, columns: Sequence[str], update: bool = False
) -> str:
    """Copy the staging table into the target; ``update`` also changes rows by its unique key."""
    listed = ", ".join(dest.quote(c) for c in columns)
    text = f"INSERT INTO {dest.quote(dest.table)} ({listed}) SELECT {listed} FROM {dest.quote(staging)}"
    if not update:
        return text
    if not dest.is_mysql:
        raise ValueError("updating by the target's unique key is only supported for MySQL")
    changes = ", ".join(f"{dest.quote(c)} = VALUES({dest.quote(c)})" for c in columns)
    return f"{text} ON DUPLICATE KEY UPDATE {changes}"


def _target_schema(spark: SparkSession, dest: JdbcSource) -> StructType:
    return spark.read.format("jdbc").options(**dest.options(dbtable=dest.quote(dest.table))).load().schema


def export_jdbc(
    df: DataFrame,
    dest: JdbcSource,
    staging: str,
    execute: Callable[[str], None],
    columns: Sequence[str] | None = None,
    update: bool = False,
    num_connections: int = 8,
) -> None:
    """Insert ``df`` into a database table through a staging table there.

    Tasks write the staging table in parallel over at most ``num_connections``
    connections. A task retried after its executor was lost may have committed
    before, so the staging rows are counted and a surplus or loss fails the
    export. They are counted while they are written, and take the target's types exactly or fail. Then ``execute`` (for example a cursor of the caller's own connection,
    so that the caller owns the transaction) runs the one statement that moves
    them into ``dest.table``.
    """
    spark = df.sparkSession
    names = list(columns or df.columns)
    rows = select_columns(df, names)
    known = {f.name.lower(): f.dataType for f in _target_schema(spark, dest).fields}
    unknown = [c for c in names if c.lower() not in known]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    rows = rows.select([lossless(rows, c, known[c.lower()]).alias(c) for c in names])
    options = dest.options(dbtable=dest.quote(staging), numPartitions=str(num_connections))
    options.pop("fetchsize", None)
    counted = Observation()
    written = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    written.write.format("jdbc").options(**options).mode("overwrite").save()
    expected = counted.get["rows"]
    counted = dest.options(query=f"SELECT COUNT(*) AS row_count FROM {dest.quote(staging)}")
    found = spark.read.format("jdbc").options(**counted).load().select(F.col("row_count").cast("bigint")).first()[0]
    if found != expected:
        raise RuntimeError(f"staging table {staging} holds {found} rows, expected {expected}")
    execute(move_statement(dest, staging, names, update))
    execute(f"DROP TABLE {dest.quote(staging)}")
