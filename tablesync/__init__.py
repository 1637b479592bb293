"""Exact table ingestion and keyed merging on Spark."""

from tablesync.functions.datetimes import datetime_to_millis, millis_to_datetime, string_to_datetime
from tablesync.functions.decimals import (
    decimal_layout,
    decimal_rescale_exact,
    decimal_to_fixed,
    decimal_to_java_string,
    decimal_to_plain_string,
    decimal_typed,
    fixed_to_decimal,
    number_order,
    string_to_decimal,
)
from tablesync.functions.texts import drop_delims, lob_inline
from tablesync.operators.checks import (
    guard_keys,
    jdbc_max_check_value,
    key_profile,
    max_check_value,
    max_wide_value,
    merge_schema_check,
    single_row,
    validate_counts,
)
from tablesync.operators.columns import (
    cast_overrides,
    safe_name,
    sanitize_columns,
    select_columns,
    where_filter,
    year_as_smallint,
)
from tablesync.operators.incremental import (
    StateConflict,
    bounds_sql,
    compact_state,
    incremental_append,
    incremental_lastmodified,
    incremental_noop,
    incremental_null_bound,
    latest_state,
    load_state,
    save_state,
    state_log,
)
from tablesync.operators.merge import (
    append_rows,
    latest_per_key,
    merge_latest,
    merge_null_key,
    merge_to_old_schema,
    merge_unique,
    tag_origin,
    tag_origin_by_path,
    upsert_rows,
)
from tablesync.plans.import_job import ImportJob, ImportResult, check_job, merge_paths, run_import
from tablesync.plans.merge_table import merge_table, merged_rows, stored_table
from tablesync.plans.touched import TouchedMerge, merge_touched
from tablesync.sinks.files import (
    append_files,
    read_avro,
    read_files,
    read_text,
    text_schema,
    write_avro,
    write_files,
    write_overwrite,
    write_parquet,
    write_text,
)
from tablesync.sinks.journal import recover_files, replace_files
from tablesync.sinks.lobs import lob_path, read_lobs, write_with_lobs
from tablesync.sinks.swap import recover_swap, swap_into_place, write_and_swap
from tablesync.sinks.tables import append_table, export_jdbc, export_table, move_statement, write_table
from tablesync.sources.balanced import (
    balanced_predicates,
    balanced_scan,
    balanced_split_plan,
    typed_split_plan,
    with_typed_split,
)
from tablesync.sources.jdbc import JdbcSource
from tablesync.sources.scan import parquet_scan, scan_query, scan_table
from tablesync.sources.splits import (
    cluster_by_range,
    split_bounds,
    split_count,
    split_plan,
    split_scan,
    with_split_id,
)
from tablesync.storage import shared_dir

__all__ = [name for name in dir() if not name.startswith("_")]
