"""High-water-mark windows: which rows are new since the last run."""

from __future__ import annotations

import json
from datetime import UTC, datetime, time, timedelta
from decimal import Decimal
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)

from tablesync.operators.checks import require_check_column
from tablesync.operators.columns import quoted
from tablesync.sources.jdbc import JdbcSource
from tablesync.storage import delete, names_in, read_whole, write_new

# The two incremental modes.
APPEND = "append"
LAST_MODIFIED = "lastmodified"

STATE_SCHEMA = "job string, mode string, check_column string, last_value string, run_at timestamp_ntz"


def typed_value(value, kind: DataType, mode: str = APPEND):
    """A bound as a Python value of the check column's type, so that 5 equals '5' and 5.0.

    A time of day against a date column: ``d <= t`` is ``d <= day of t``, but
    ``d < t`` and ``d >= t``, the last-modified tests, hold from the next day on.
    """
    if value is None:
        return None
    if isinstance(kind, IntegralType):
        return int(Decimal(str(value)))
    if isinstance(kind, DecimalType):
        return Decimal(str(value))
    if isinstance(kind, (FloatType, DoubleType)):
        return float(value)
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(str(value).strip("'"))
        if not isinstance(kind, DateType):
            return moment
        partial = mode == LAST_MODIFIED and moment.time() != time()
        return moment.date() + timedelta(days=1 if partial else 0)
    raise ValueError(f"a column of type {kind.simpleString()} cannot be a check column")


def _bound(df: DataFrame, name: str, value, mode: str = APPEND) -> Column:
    kind = df.schema[name].dataType
    # text and a cast fold into one literal, which the scan can push down
    return F.lit(str(typed_value(value, kind, mode))).cast(kind)


def incremental_append(df: DataFrame, col: str, last=None, upper=None) -> DataFrame:
    """Rows with ``last < col <= upper``; without ``last`` there is no lower bound.

    ``upper`` is the column's maximum, taken before the read (see
    ``max_check_value``), so rows arriving meanwhile wait for the next run. If it
    is None (empty or all-null column) the rows are those of the null bound.
    """
    name = require_check_column(df, col)
    if upper is None:
        return incremental_null_bound(df, name, last)
    condition = quoted(name) <= _bound(df, name, upper)
    if last is not None:
        condition = (quoted(name) > _bound(df, name, last)) & condition
    return df.where(condition)


def incremental_lastmodified(df: DataFrame, col: str, last, now) -> DataFrame:
    """Rows with ``last <= col < now``, ``now`` being the source's clock."""
    name = require_check_column(df, col)
    if not isinstance(df.schema[name].dataType, (DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"last-modified column {name!r} is no date or timestamp")
    if now is None:
        raise ValueError("the source's current time is required")
    condition = quoted(name) < _bound(df, name, now, LAST_MODIFIED)
    if last is not None:
        condition = (quoted(name) >= _bound(df, name, last, LAST_MODIFIED)) & condition
    return df.where(condition)


def incremental_null_bound(df: DataFrame, col: str, last=None) -> DataFrame:
    """Rows for a column without a maximum: ``col IS NULL``; with ``last``, none."""
    name = require_check_column(df, col)
    condition = quoted(name).isNull()
    if last is not None:
        condition = (quoted(name) > _bound(df, name, last)) & condition
    return df.where(condition)


def is_noop(df: DataFrame, col: str, last, upper, mode: str = APPEND) -> bool:
    """Whether nothing can be new: the last value equals the new bound."""
    kind = df.schema[require_check_column(df, col)].dataType
    if last is None or upper is None:
        return False
    return typed_value(last, kind, mode) == typed_value(upper, kind, mode)


def incremental_noop(df: DataFrame, col: str, last, upper, mode: str = APPEND) -> DataFrame | None:
    """An empty frame that plans no scan if nothing can be new, else None."""
    return df.where(F.lit(False)) if is_noop(df, col, last, upper, mode) else None


def bounds_sql(src: JdbcSource, col: str, mode: str, last=None, upper=None) -> str:
    """The same window as text for the ``$CONDITIONS`` slot of a database query."""
    above, below = (">", "<=") if mode == APPEND else (">=", "<")
    name = src.quote(col)
    parts = [] if last is None else [f"{name} {above} {src.literal(last)}"]
    parts.append(f"{name} IS NULL" if upper is None else f"{name} {below} {src.literal(upper)}")
    return " AND ".join(parts)


def latest_state(log: DataFrame) -> DataFrame:
    """The latest entry per job of a run log ``(job, ..., run_at)``.

    One aggregate with map-side combining; ``run_at`` should differ between a job's entries, so
    that all columns come from the same one.
    """
    values = [c for c in log.columns if c not in ("job", "run_at")]
    return log.groupBy("job").agg(
        *[F.max_by(quoted(c), F.col("run_at")).alias(c) for c in values],
        F.max("run_at").alias("run_at"),
    )


class StateConflict(RuntimeError):
    """Another run of the job has saved its state since this one read it."""


#: Digits of a state file's number, so that names sort as numbers do.
_STATE_DIGITS = 12


def _state_folder(path: str, job: str) -> str:
    return f"{path.rstrip('/')}/job={quote(job, safe='')}"


def _versions(spark: SparkSession, path: str, job: str) -> list[str]:
    names = names_in(spark, _state_folder(path, job))
    return [n for n in names if n.endswith(".json") and n[: -len(".json")].isdigit()]


def load_state(spark: SparkSession, path: str, job: str) -> dict | None:
    """The job's latest entry, or None before its first run. ``version`` is its number."""
    for name in reversed(_versions(spark, path, job)):
        text = read_whole(spark, f"{_state_folder(path, job)}/{name}")
        if text.endswith("\n"):  # else its writer was cut off
            return {**json.loads(text), "version": int(name[: -len(".json")])}
    return None


def save_state(
    spark: SparkSession, path: str, job: str, mode: str, check_column: str, last_value, expected: int | None = None
) -> int:
    """Add an entry and give its number; call it only after the run's data is in place.

    Entries are files numbered per job, and a file that exists is never written again. ``expected`` is the number of the entry that the
    run started from (0 if there was none): if another run has saved since, the next number is taken and this one raises
    ``StateConflict``, with the other's state in place. Without it the entry follows whatever is there.
    """
    known = _versions(spark, path, job)
    latest = int(known[-1][: -len(".json")]) if known else 0
    if expected is not None:
        state = load_state(spark, path, job)
        if (state["version"] if state else 0) != expected:
            raise StateConflict(f"job {job!r} was saved by another run: entry {latest} follows {expected}")
    entry = {
        "job": job,
        "mode": mode,
        "check_column": check_column,
        "last_value": None if last_value is None else str(last_value),
        "run_at": datetime.now(UTC).replace(tzinfo=None).isoformat(),
    }
    version = latest + 1
    try:
        write_new(spark, f"{_state_folder(path, job)}/{version:0{_STATE_DIGITS}d}.json", json.dumps(entry))
    except FileExistsError as error:
        raise StateConflict(f"job {job!r} was saved by another run at the same time: entry {version}") from error
    return version


def state_log(spark: SparkSession, path: str) -> DataFrame:
    """All entries of all jobs, as ``latest_state`` takes them."""
    rows = spark.read.schema(STATE_SCHEMA).json(f"{path.rstrip('/')}/*/*.json")
    return rows.where(F.col("job").isNotNull())


def compact_state(spark: SparkSession, path: str) -> None:
    """Remove all but the latest entry of each job. Numbers go on, so runs under way are not misled."""
    for folder in names_in(spark, path):
        if folder.startswith("job="):
            job = unquote(folder.removeprefix("job="))
            for name in _versions(spark, path, job)[:-1]:
                delete(spark, f"{_state_folder(path, job)}/{name}")
