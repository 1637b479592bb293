"""Reading tables, free-form queries and Parquet datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablesync.operators.columns import select_columns, where_filter
from tablesync.sources.jdbc import JdbcSource, fill_conditions

Source = JdbcSource | DataFrame | str


def scan_table(
    spark: SparkSession,
    src: Source,
    columns: str | Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """A table, optionally only some columns and rows.

    ``src`` is a database table, a Parquet path or a DataFrame. For a database,
    ``where`` is in the database's own SQL and runs there; otherwise it is Spark
    SQL and reaches the Parquet scan as pushed filters. Either way only the
    selected columns are read.
    """
    if isinstance(src, JdbcSource):
        df = spark.read.format("jdbc").options(**src.options(dbtable=src.relation(where=where))).load()
    else:
        df = where_filter(src if isinstance(src, DataFrame) else parquet_scan(spark, src), where)
    return df if columns is None else select_columns(df, columns)


def scan_query(
    spark: SparkSession,
    src: JdbcSource | None,
    sql: str,
    conditions: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """A free-form SELECT, run by the database or, with ``src=None``, by Spark.

    ``$CONDITIONS`` in the text takes ``conditions``. For Spark, ``tables`` binds
    DataFrames to ``{name}`` placeholders, so that no view is left in the session.
    """
    if src is not None:
        return spark.read.format("jdbc").options(**src.options(dbtable=src.relation(sql, conditions))).load()
    return spark.sql(fill_conditions(sql, conditions), **(tables or {}))


def parquet_scan(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """A Parquet dataset, optionally under a given read schema.

    With ``schema`` no footer is opened for inference, columns missing from a
    file read as null and columns not asked for are not read. ``merge_schema``
    looks at every footer (a distributed job) rather than at one file.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("mergeSchema", str(merge_schema).lower()).parquet(path)
