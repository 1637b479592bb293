"""Keyed merging of a batch into existing data.

The rule: one row per key; any new row beats every old row. Where several rows
compete on one side, a total order decides - ``tie_break`` columns descending,
then all other columns descending - so a retried or recomputed task picks the
same winner.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesync.functions.casts import lossless
from tablesync.functions.decimals import number_order
from tablesync.operators.checks import guard_keys, key_columns, merge_schema_check
from tablesync.operators.columns import quoted, refuse_column, resolve
from tablesync.storage import qualified

ORIGIN = "is_new"


def merge_to_old_schema(new: DataFrame, old_schema: StructType) -> DataFrame:
    """The batch under the existing schema.

    Columns are matched without regard to case; columns only in the batch are
    dropped, columns missing from it are null. A value that its new type cannot
    hold exactly fails the job.
    """
    by_name = {}
    for c in new.columns:
        if by_name.setdefault(c.lower(), c) != c:
            raise ValueError(f"columns {by_name[c.lower()]!r} and {c!r} differ only in case")
    return new.select(
        [
            lossless(new, by_name[f.name.lower()], f.dataType).alias(f.name)
            if f.name.lower() in by_name
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in old_schema.fields
        ]
    )


def tag_origin(old: DataFrame, new: DataFrame, name: str = ORIGIN) -> DataFrame:
    """All rows of both sides with a flag ``is_new``."""
    refuse_column(old, name)
    return old.withColumn(name, F.lit(False)).unionByName(new.withColumn(name, F.lit(True)))


def tag_origin_by_path(df: DataFrame, old_path: str, new_path: str) -> DataFrame:
    """The flag taken from each row's file, for data read from both places at once.

    A path counts as inside a directory only below its slash, so ``/data/t1`` is
    not taken for a part of ``/data/t``. A file under neither fails the job.
    """
    # one slash after the scheme on both sides: readers and file systems differ in that
    path = F.regexp_replace(F.col("_metadata.file_path"), "^([^:/]+):/+", "$1:/")

    def under(folder: str) -> Column:
        return path.startswith(re.sub("^([^:/]+):/+", r"\1:/", qualified(df.sparkSession, folder)) + "/")

    stray = F.raise_error(F.concat(F.lit("file is neither old nor new: "), path)).cast("boolean")
    flag = F.when(under(new_path), F.lit(True)).when(under(old_path), F.lit(False)).otherwise(stray)
    refuse_column(df, ORIGIN)
    return df.withColumn(ORIGIN, flag)


def merge_latest(
    old: DataFrame,
    new: DataFrame,
    key: str | Sequence[str],
    tie_break: str | Sequence[str] = (),
    key_as_text: bool = False,
    old_is_unique: bool = False,
    wide_decimals: Sequence[str] = (),
) -> DataFrame:
    """One row per key where both sides may repeat keys.

    Plan: Spark keeps only the best row per key inside each map task
    (``WindowGroupLimit``, partial) before the one shuffle on the key. A key that
    holds a third of all rows therefore sends one row per task, not its rows.

    ``old_is_unique`` says the existing side is the output of an earlier merge.
    Then only the batch is reduced to one row per key and the existing side is
    anti-joined (see :func:`merge_unique`), which spares it the sort and, for a
    small batch, the shuffle.

    Keys compare by value. ``key_as_text`` compares their text instead.
    ``wide_decimals`` are text columns that hold numbers, of more digits than a decimal has:
    where they decide between rows they do so by value.
    """
    new = merge_to_old_schema(new, old.schema)
    keys = key_columns(old, key)
    if old_is_unique:
        kept = without_keys(guard_keys(old, keys), _distinct_keys(guard_keys(new, keys), keys), keys, key_as_text)
        return kept.unionByName(latest_per_key(new, keys, tie_break, key_as_text, wide_decimals))
    flag = free_name("__is_new", old)
    both = guard_keys(tag_origin(old, new, flag), keys)
    best = _best_rows(both, keys, [flag, *_names(tie_break)], key_as_text, wide_decimals)
    return best.select(*[quoted(c) for c in old.columns])


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    tie_break: str | Sequence[str] = (),
    key_as_text: bool = False,
    wide_decimals: Sequence[str] = (),
) -> DataFrame:
    """One row per key of a single table, by the order a merge uses."""
    keys = key_columns(df, key)
    return _best_rows(guard_keys(df, keys), keys, tie_break, key_as_text, wide_decimals)


def _names(tie_break: str | Sequence[str]) -> list[str]:
    return [tie_break] if isinstance(tie_break, str) else list(tie_break)


def _best_rows(df: DataFrame, keys: list[str], tie_break, key_as_text: bool, wide_decimals: Sequence[str] = ()) -> DataFrame:
    first = [resolve(df, c) for c in _names(tie_break)]
    others = [c for c in df.columns if c not in first and (key_as_text or c not in keys)]
    wide = [resolve(df, c) for c in wide_decimals]
    # the same number may be written in several ways; the text itself then decides, after all other columns
    by_value = [number_order(quoted(c), c).desc() if c in wide else quoted(c).desc() for c in first + others]
    order = by_value + [quoted(c).desc() for c in first + others if c in wide]
    by = [quoted(k).cast("string") if key_as_text else quoted(k) for k in keys]
    window = Window.partitionBy(*by).orderBy(*(order or by))
    rank = free_name("__rank", df)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).select(*[quoted(c) for c in df.columns])


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of the frames has it, in any spelling."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def merge_unique(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], key_as_text: bool = False
) -> DataFrame:
    """The same result when keys are unique on both sides.

    Existing rows whose key is in the batch go, the batch is added. Only the
    batch's key column enters the join, and Spark broadcasts it only if its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``; then the
    existing side is not shuffled. Beyond that it is a shuffled anti-join whose
    skewed partitions adaptive execution can split. Existing data bucketed by
    the key joins without a shuffle of its own at any batch size.

    The batch is read twice: write it out first if computing it is expensive.
    """
    new = merge_to_old_schema(new, old.schema)
    keys = key_columns(old, key)
    old, new = guard_keys(old, keys), guard_keys(new, keys)
    return without_keys(old, new, keys, key_as_text).unionByName(new)


def _distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once: repeats of a heavy key go map-side, before any join sees them."""
    return df.select([quoted(k) for k in keys]).distinct()


def without_keys(df: DataFrame, other: DataFrame, keys: list[str], as_text: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``."""
    return _match(df, other, keys, "left_anti", as_text)


def matching(df: DataFrame, other: DataFrame, keys: list[str], as_text: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``."""
    return _match(df, other, keys, "left_semi", as_text)


def _match(df: DataFrame, other: DataFrame, keys: list[str], how: str, as_text: bool = False) -> DataFrame:
    kind = (lambda c: c.cast("string")) if as_text else (lambda c: c)
    names = [free_name(f"__key_{i}", df) for i in range(len(keys))]
    right = other.select([kind(quoted(k)).alias(n) for k, n in zip(keys, names)])
    condition = [kind(quoted(k)) == F.col(n) for k, n in zip(keys, names)]
    return df.join(right, condition, how)


def merge_null_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows unchanged; a null key in any of them fails the job."""
    return guard_keys(df, key)


def to_append(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows for a dataset of that schema: its column order, no unknown columns, every value exact or an error."""
    known = {f.name.lower() for f in schema.fields}
    unknown = [c for c in rows.columns if c.lower() not in known]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    return merge_to_old_schema(rows, schema)


def append_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both sides; nothing is compared."""
    return old.unionByName(new)


def upsert_rows(
    target: DataFrame,
    batch: DataFrame,
    key: str | Sequence[str],
    tie_break: str | Sequence[str] = (),
    small_batch: bool = False,
) -> DataFrame:
    """Update rows of ``target`` by its unique key, insert the rest of the batch.

    The batch may hold only some of the columns: the others keep their value in
    updated rows and are null in inserted ones. Repeated keys in the batch are
    settled first. A row without a key never matches: it is kept, or inserted.

    By default this is one full outer join: each side is shuffled once. Rows
    without a key stay out of it, as they would all meet in one task.

    ``small_batch`` is for a batch that Spark can broadcast. It joins the updates
    (left join) and the inserts (anti-join) apart, which leaves the target in
    place - a full outer join cannot - and scans its key column a second time.
    Spark still checks the size; a batch too large to broadcast only costs more.
    """
    keys = key_columns(target, key)
    known = {c.lower(): c for c in target.columns}
    unknown = [c for c in batch.columns if c.lower() not in known]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    names = {c: known[c.lower()] for c in batch.columns}
    batch = batch.select([lossless(batch, c, target.schema[n].dataType).alias(n) for c, n in names.items()])
    missing = [k for k in keys if k not in batch.columns]
    if missing:
        raise ValueError(f"the batch lacks key columns {missing}")

    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & quoted(k).isNotNull()
    keyed = _best_rows(batch.where(has_key), keys, tie_break, key_as_text=False)
    fresh = {c: free_name(f"__new_{i}", target) for i, c in enumerate(batch.columns)}
    hit = free_name("__hit", target)
    changes = keyed.select([quoted(c).alias(n) for c, n in fresh.items()] + [F.lit(True).alias(hit)])
    condition = [quoted(k) == F.col(fresh[k]) for k in keys]
    merged = [
        F.when(F.col(hit), F.col(fresh[c])).otherwise(quoted(c)).alias(c) if c in fresh else quoted(c)
        for c in target.columns
    ]
    without_key = merge_to_old_schema(batch.where(~has_key), target.schema)
    if not small_batch:
        joined = target.where(has_key).join(changes, condition, "full_outer").select(merged)
        return joined.unionByName(target.where(~has_key)).unionByName(without_key)

    updated = target.join(changes, condition, "left").select(merged)
    matched = matching(target.select([quoted(k) for k in keys]), _distinct_keys(batch, keys), keys)
    inserted = without_keys(keyed, matched, keys)
    return updated.unionByName(merge_to_old_schema(inserted, target.schema)).unionByName(without_key)


__all__ = [
    "append_rows",
    "latest_per_key",
    "merge_latest",
    "merge_null_key",
    "merge_schema_check",
    "merge_to_old_schema",
    "matching",
    "merge_unique",
    "tag_origin",
    "tag_origin_by_path",
    "upsert_rows",
    "without_keys",
]
