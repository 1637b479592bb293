"""A whole import: read, convert, write, merge, remember."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tablesync.functions.datetimes import datetime_to_millis
from tablesync.functions.decimals import MAX_PRECISION, decimal_to_java_string, decimal_to_plain_string, decimal_typed
from tablesync.functions.texts import drop_delims
from tablesync.operators import incremental as inc
from tablesync.operators.checks import (
    jdbc_max_check_value,
    max_check_value,
    merge_schema_check,
    require_check_column,
    single_row,
)
from tablesync.operators.columns import (
    cast_overrides,
    resolve,
    safe_name,
    sanitize_columns,
    select_columns,
    year_as_smallint,
)
from tablesync.operators.merge import latest_per_key, merge_latest
from tablesync.plans.merge_table import merge_table
from tablesync.plans.touched import merge_touched, partition_columns
from tablesync.sinks.files import LAYOUTS, append_files, read_files, write_files, write_overwrite
from tablesync.sinks.journal import recover_files
from tablesync.sinks.lobs import write_with_lobs
from tablesync.sinks.swap import recover_swap, write_and_swap
from tablesync.sinks.tables import append_table, write_table
from tablesync.sources.jdbc import CONDITIONS, JdbcSource
from tablesync.sources.scan import Source, scan_query, scan_table
from tablesync.sources.splits import split_scan
from tablesync.storage import data_files, delete, exists, has_data, shared_dir


#: Which files of existing data a merge writes again.
REWRITES = ("all", "touched")


@dataclass(frozen=True)
class ImportJob:
    """What to import and where to.

    A table comes from ``source`` (a database table, a Parquet path or a
    DataFrame), a query from ``query``, run by the database in ``source`` or by
    Spark over ``tables``. ``now`` overrides the source's clock. ``layout_options``
    are those of the layout's writer: ``fixed_layout`` for Parquet, ``sep`` and
    ``null_text`` for text.
    """

    source: Source | None = None
    query: str | None = None
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    name: str | None = None
    columns: str | Sequence[str] | None = None
    where: str | None = None
    split_by: str | None = None
    num_splits: int = 1
    split_limit: int | None = None
    boundary_query: str | None = None
    auto_reset: bool = False

    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    overrides: Mapping[str, str] = field(default_factory=dict)
    years: Sequence[str] = ()
    drop_delims: bool = False
    decimals_as_text: str | None = None
    dates_as_millis: bool = False
    wide_as_text: bool = False
    lobs: Mapping[str, int] = field(default_factory=dict)
    lob_key: str | None = None

    target_dir: str | None = None
    warehouse_dir: str | None = None
    catalog_table: str | None = None
    layout: str = "text"
    codec: str | None = None
    layout_options: Mapping[str, Any] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    bucket_by: tuple[int, Sequence[str]] | None = None
    append: bool = False
    overwrite: bool = False
    validate: bool = False

    incremental: str | None = None
    check_column: str | None = None
    last_value: Any = None
    now: datetime | None = None
    merge_key: str | Sequence[str] | None = None
    tie_break: str | Sequence[str] = ()
    merge_key_as_text: bool = False
    old_is_unique: bool = False
    rewrite: str = "all"

    job: str | None = None
    state_path: str | None = None

    @property
    def has_table(self) -> bool:
        if isinstance(self.source, JdbcSource):
            return self.source.table is not None
        return self.source is not None

    @property
    def lob_label(self) -> str:
        """What references to large values begin with."""
        return self.name or (self.target or "").rstrip("/").rpartition("/")[2] or "table"

    @property
    def target(self) -> str | None:
        """The target directory, else the table's folder in the warehouse, else its name."""
        if self.target_dir is not None:
            return self.target_dir
        if self.name is None:
            return None
        return self.name if self.warehouse_dir is None else f"{self.warehouse_dir.rstrip('/')}/{self.name}"


@dataclass(frozen=True)
class ImportResult:
    """``imported`` is False if there was nothing new; ``last_value`` starts the next run."""

    imported: bool
    target: str | None
    last_value: Any = None
    source_rows: int | None = None
    target_rows: int | None = None


def check_job(job: ImportJob) -> None:
    """Raise ``ValueError`` for options that do not go together."""
    lastmodified = job.incremental == inc.LAST_MODIFIED
    rules = [
        (not job.has_table and job.query is None, "a table or a query is required"),
        (job.has_table and job.query is not None, "a table and a query exclude each other"),
        (job.target_dir is not None and job.warehouse_dir is not None, "target_dir and warehouse_dir exclude each other"),
        (
            job.query is not None and job.target_dir is None and job.catalog_table is None,
            "a query needs a target_dir",
        ),
        (
            job.query is not None and job.num_splits > 1 and job.split_by is None and not job.auto_reset,
            "a parallel query import needs split_by",
        ),
        (job.validate and job.query is not None, "counts cannot be validated for a query"),
        (
            job.where is not None and job.query is not None,
            "a row filter belongs into the query: where and query exclude each other",
        ),
        (job.validate and job.merge_key is not None, "counts cannot be validated for a merge"),
        (job.validate and job.where is not None, "counts cannot be validated with a row filter"),
        (job.validate and job.incremental is not None, "counts cannot be validated for an incremental import"),
        (job.overwrite and job.append, "append and overwrite exclude each other"),
        (job.overwrite and job.incremental is not None, "overwrite excludes an incremental import"),
        (job.auto_reset and job.split_by is not None, "auto_reset and split_by exclude each other"),
        (
            job.incremental not in (None, inc.APPEND, inc.LAST_MODIFIED),
            f"incremental is {inc.APPEND!r} or {inc.LAST_MODIFIED!r}, not {job.incremental!r}",
        ),
        (job.incremental is not None and job.check_column is None, "an incremental import needs a check_column"),
        (job.incremental is None and job.check_column is not None, "check_column needs an incremental mode"),
        (lastmodified and job.layout == "avro", f"{inc.LAST_MODIFIED} cannot be used with Avro files"),
        (job.append and job.merge_key is not None, "rows are appended or merged: append and merge_key exclude each other"),
        (job.rewrite not in REWRITES, f"rewrite is one of {list(REWRITES)}, not {job.rewrite!r}"),
        (job.rewrite == "touched" and job.layout != "parquet", "only Parquet files can be rewritten file by file"),
        (job.decimals_as_text not in (None, "plain", "java"), "decimals_as_text is 'plain' or 'java'"),
        (bool(job.lobs) != (job.lob_key is not None), "lobs and lob_key go together"),
        (
            bool(job.lobs) and (job.layout != "parquet" or job.catalog_table is not None or bool(job.partition_by)),
            "large values are moved out of plain Parquet files only",
        ),
        (
            bool(job.lobs) and (job.append or job.incremental is not None or job.merge_key is not None),
            "large values are named by their row's key: they need a whole import",
        ),
        (job.partition_by and job.layout != "parquet", "only Parquet files can be partitioned"),
        (job.bucket_by is not None and job.catalog_table is None, "bucket_by needs a catalog_table"),
        (
            job.split_by is not None and isinstance(job.source, (str, DataFrame)) and job.split_limit is not None,
            "files are split by their bytes: split_limit needs a database",
        ),
        (job.layout not in LAYOUTS, f"layout is one of {list(LAYOUTS)}, not {job.layout!r}"),
        (job.target is None and job.catalog_table is None, "a target_dir, a name or a catalog_table is required"),
        ((job.job is None) != (job.state_path is None), "job and state_path go together"),
    ]
    for broken, message in rules:
        if broken:
            raise ValueError(message)


def run_import(spark: SparkSession, job: ImportJob) -> ImportResult:
    """Run the import. The state is saved only after the data is in place."""
    check_job(job)
    version = 0
    if job.state_path is not None:
        state = inc.load_state(spark, job.state_path, job.job)
        if state is not None:
            version = state["version"]
            if job.last_value is None:
                job = replace(job, last_value=state["last_value"])
    if job.target is not None:
        recover_swap(spark, job.target)
        recover_files(spark, job.target)
    if (
        job.incremental == inc.LAST_MODIFIED
        and job.merge_key is None
        and not job.append
        and job.catalog_table is None
        and exists(spark, job.target)
    ):
        raise ValueError(f"{inc.LAST_MODIFIED} onto existing data needs a merge_key or append")

    rows, upper = _read(spark, job)
    if rows is None:
        return ImportResult(False, job.target, job.last_value)
    rows = _convert(rows, job)
    result = ImportResult(True, job.target, upper if job.incremental else None)
    before = _stored_rows(spark, rows, job) if job.validate and job.append else 0
    if job.validate:
        # counted on their way to the files: the source is read once
        counted = Observation()
        _store(spark, rows.observe(counted, F.count(F.lit(1)).alias("rows")), job)
        result = _validated(counted.get["rows"], _stored_rows(spark, rows, job) - before, result)
    else:
        _store(spark, rows, job)
    if job.state_path is not None and job.incremental is not None:
        inc.save_state(spark, job.state_path, job.job, job.incremental, job.check_column, upper, expected=version)
    return result


def _read(spark: SparkSession, job: ImportJob) -> tuple[DataFrame | None, Any]:
    """The rows to import (None if nothing can be new) and the new upper bound."""
    if job.incremental is None:
        return _scan(spark, job, None), None
    probe = _scan(spark, replace(job, num_splits=1, split_by=None, split_limit=None, columns=None), None)
    check = require_check_column(probe, job.check_column)
    if isinstance(job.last_value, str) and isinstance(probe.schema[check].dataType, NumericType):
        # saved state is text; a number must not reach a database in quotes
        job = replace(job, last_value=inc.typed_value(job.last_value, probe.schema[check].dataType))
    if job.incremental == inc.APPEND:
        upper = _max_value(spark, job, probe, check)
    else:
        upper = job.now if job.now is not None else _clock(spark, job)
    if inc.is_noop(probe, check, job.last_value, upper, job.incremental):
        return None, upper
    in_slot = isinstance(job.source, JdbcSource) and job.query is not None and CONDITIONS in job.query
    if in_slot:
        return _scan(spark, job, inc.bounds_sql(job.source, check, job.incremental, job.last_value, upper)), upper
    rows = _scan(spark, replace(job, columns=None), None)
    if job.incremental == inc.APPEND:
        rows = inc.incremental_append(rows, check, job.last_value, upper)
    else:
        rows = inc.incremental_lastmodified(rows, check, job.last_value, upper)
    return rows if job.columns is None else select_columns(rows, job.columns), upper


def _scan(spark: SparkSession, job: ImportJob, conditions: str | None) -> DataFrame:
    if isinstance(job.source, JdbcSource):
        # for a query the row filter travels in its slot, for a table as WHERE
        where = conditions if job.query is not None else job.where
        rows = split_scan(
            spark,
            job.source,
            job.split_by,
            job.num_splits,
            split_limit=job.split_limit,
            where=where,
            query=job.query,
            boundary_query=job.boundary_query,
            auto_reset=job.auto_reset,
        )
    elif job.query is not None:
        rows = scan_query(spark, None, job.query, conditions, job.tables)
    else:
        rows = scan_table(spark, job.source, where=job.where)
    if job.split_by is not None and not isinstance(job.source, JdbcSource):
        resolve(rows, job.split_by)  # files are split by their bytes, but a column that does not exist is a mistake
    return rows if job.columns is None else select_columns(rows, job.columns)


def _max_value(spark: SparkSession, job: ImportJob, probe: DataFrame, check: str):
    if isinstance(job.source, JdbcSource):
        where = None if job.query is not None else job.where
        return single_row(jdbc_max_check_value(spark, job.source, check, job.query, where))[0]
    return single_row(max_check_value(probe, check))[0]


def _clock(spark: SparkSession, job: ImportJob) -> datetime:
    if isinstance(job.source, JdbcSource):
        options = job.source.options(query="SELECT CURRENT_TIMESTAMP AS now_value")
        return single_row(spark.read.format("jdbc").options(**options).load())[0]
    return single_row(spark.range(1).select(F.current_timestamp().alias("now_value")))[0]


def _convert(rows: DataFrame, job: ImportJob) -> DataFrame:
    if job.decimals:
        rows = decimal_typed(rows, job.decimals, as_string=job.wide_as_text)
    if job.years:
        rows = year_as_smallint(rows, job.years)
    if job.overrides:
        rows = cast_overrides(rows, job.overrides)
    if job.drop_delims:
        rows = drop_delims(rows)
    if job.decimals_as_text is not None:
        to_text = decimal_to_plain_string if job.decimals_as_text == "plain" else decimal_to_java_string
        rows = to_text(rows)
    if job.dates_as_millis:
        rows = datetime_to_millis(rows)
    return sanitize_columns(rows)


def _wide_decimals(job: ImportJob, rows: DataFrame) -> list[str]:
    """Stored columns that hold numbers as text: merges compare them by value."""
    if job.decimals_as_text == "java":  # may have exponents, and all are narrow: their text order decides
        return []
    wide = [c for c, (precision, _) in job.decimals.items() if job.decimals_as_text or precision > MAX_PRECISION]
    names = [resolve(rows, safe_name(c)) for c in wide]
    return [c for c in names if isinstance(rows.schema[c].dataType, StringType)]


def _stored_names(columns: str | Sequence[str]) -> list[str]:
    return [safe_name(c) for c in ([columns] if isinstance(columns, str) else columns)]


def _store(spark: SparkSession, rows: DataFrame, job: ImportJob) -> None:
    appends = job.append or job.incremental == inc.APPEND
    merges = job.merge_key is not None and not appends and not job.overwrite
    if merges:
        how = {
            "key": _stored_names(job.merge_key),
            "tie_break": _stored_names(job.tie_break),
            "key_as_text": job.merge_key_as_text,
            "wide_decimals": _wide_decimals(job, rows),
        }
    if job.catalog_table is not None:
        known = spark.catalog.tableExists(job.catalog_table)
        if known and merges and job.incremental is not None:
            merge_table(spark, job.catalog_table, rows, codec=job.codec or "snappy", **how)
        elif job.overwrite or not known:
            first = latest_per_key(rows, **how) if merges else rows
            write_table(
                first,
                job.catalog_table,
                mode="overwrite" if job.overwrite else "error",
                partition_by=job.partition_by,
                bucket_by=job.bucket_by,
            )
        elif appends or job.incremental is not None:
            append_table(rows, job.catalog_table)
        else:
            raise ValueError(f"table {job.catalog_table} exists: append or overwrite?")
        return
    options = dict(job.layout_options)
    if job.partition_by:
        options["partition_by"] = _stored_names(job.partition_by)
    if job.lobs:
        limits = {safe_name(c): limit for c, limit in job.lobs.items()}
        write_with_lobs(rows, job.target, safe_name(job.lob_key), limits, job.lob_label, job.codec or "snappy", job.overwrite)
    elif job.overwrite:
        write_overwrite(rows, job.target, job.layout, job.codec, **options)
    elif appends:
        append_files(rows, job.target, job.layout, job.codec, **options)
    elif merges and exists(spark, job.target) and job.rewrite == "touched":
        merge_touched(spark, job.target, rows, codec=job.codec or "snappy", **how)
    elif merges and exists(spark, job.target):
        # written out first: the merge reads the batch twice, the source only once
        batch_path = shared_dir(spark, "batch")
        try:
            write_files(rows, batch_path, job.layout, job.codec, **job.layout_options)
            merge_paths(
                spark,
                job.target,
                batch_path,
                layout=job.layout,
                schema=rows.schema,
                codec=job.codec,
                layout_options=job.layout_options,
                old_is_unique=job.old_is_unique,
                **how,
            )
        finally:
            delete(spark, batch_path)
    else:
        if merges and (job.old_is_unique or job.rewrite == "touched"):
            # the first batch has to keep what the next merge relies on
            rows = latest_per_key(rows, **how)
        write_files(rows, job.target, job.layout, job.codec, **options)


def merge_paths(
    spark: SparkSession,
    old_path: str,
    new_path: str,
    key: str | Sequence[str],
    layout: str = "parquet",
    schema=None,
    target: str | None = None,
    codec: str | None = None,
    layout_options: Mapping[str, Any] | None = None,
    tie_break: str | Sequence[str] = (),
    key_as_text: bool = False,
    old_is_unique: bool = False,
    check_all_files: bool = True,
    wide_decimals: Sequence[str] = (),
) -> None:
    """Merge the files at ``new_path`` into those at ``old_path``.

    All files are written again, in the partition folders that the old ones had; see
    ``merge_touched`` for a merge that leaves files alone. Without new rows, files whose keys are unique stay as they are. Otherwise the result goes to ``target`` or, by default, takes the old files' place once
    it is complete. Parquet schemas are checked over the footers of all files;
    ``check_all_files=False`` trusts one file per side, for datasets with so many
    files that opening them all is too slow. ``schema`` is needed for text.
    """
    write_options = dict(layout_options or {})
    options = {"merge_schema": check_all_files} if layout == "parquet" else {}
    read_schema = None
    if layout == "text":
        options, read_schema = write_options, schema
    if not has_data(spark, old_path):
        raise ValueError(f"no existing data at {old_path} to merge into")
    old = read_files(spark, old_path, layout, read_schema, **options)
    if layout == "parquet" and "partition_by" not in write_options:
        parts = partition_columns(list(data_files(spark, old_path)))
        write_options["partition_by"] = [c for c in old.columns if c in parts]
    in_place = target is None or target.rstrip("/") == old_path.rstrip("/")
    new = read_files(spark, new_path, layout, read_schema, **options) if has_data(spark, new_path) else None
    if new is not None:
        merge_schema_check(old.schema, new.schema, strict=layout == "avro")
    if in_place and old_is_unique and (new is None or new.isEmpty()):
        return
    if new is not None:
        merged = merge_latest(old, new, key, tie_break, key_as_text, old_is_unique, wide_decimals)
    else:
        merged = old if old_is_unique else latest_per_key(old, key, tie_break, key_as_text, wide_decimals)
    if in_place:
        write_and_swap(merged, old_path, lambda frame, to: write_files(frame, to, layout, codec, **write_options))
    else:
        write_files(merged, target, layout, codec, **write_options)


def _stored(spark: SparkSession, rows: DataFrame, job: ImportJob) -> DataFrame:
    if job.catalog_table is not None:
        return spark.table(job.catalog_table)
    if job.layout == "text":
        return read_files(spark, job.target, "text", rows.schema, **job.layout_options)
    return read_files(spark, job.target, job.layout)


def _stored_rows(spark: SparkSession, rows: DataFrame, job: ImportJob) -> int:
    """How many rows are stored; of Parquet files Spark reads the footers only."""
    if job.catalog_table is not None:
        known = spark.catalog.tableExists(job.catalog_table)
    else:
        known = has_data(spark, job.target)
    return _stored(spark, rows, job).count() if known else 0


def _validated(read: int, stored: int, result: ImportResult) -> ImportResult:
    if read != stored:
        raise RuntimeError(f"{read} rows read but {stored} rows stored")
    return replace(result, source_rows=read, target_rows=stored)
