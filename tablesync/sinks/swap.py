"""Replacing a dataset only once its successor is complete.

The swap is two renames, so for a moment there is no dataset at the path; a crash
in that moment is repaired by the next ``recover_swap`` (every swap starts with
one). On object stores a rename copies the data and is not atomic: publish to a
catalog table there instead.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tablesync.storage import delete, exists, rename, touch

PREVIOUS = "__previous"
#: An empty file beside the folder that a swap put aside. Without it the folder is not the swap's.
MARK = "__previous__swap"


def recover_swap(spark: SparkSession, target: str) -> None:
    """Finish or undo a swap that was cut off. Folders that no swap marked stay as they are."""
    target = target.rstrip("/")
    previous, mark = target + PREVIOUS, target + MARK
    if not exists(spark, mark):
        return
    if exists(spark, previous):
        if exists(spark, target):
            delete(spark, previous)  # cut off after the new data was in place
        else:
            rename(spark, previous, target)  # cut off between the renames
    delete(spark, mark)


def swap_into_place(spark: SparkSession, incoming: str, target: str) -> None:
    """Make the complete dataset ``incoming`` the one at ``target``.

    If the new data cannot be moved in, the old data is put back and the error
    raised; the old data goes last.
    """
    target = target.rstrip("/")
    recover_swap(spark, target)
    if not exists(spark, target):
        rename(spark, incoming, target)
    else:
        previous, mark = target + PREVIOUS, target + MARK
        if exists(spark, previous):
            raise FileExistsError(f"{previous} is in the way and was not made by a swap")
        touch(spark, mark)  # before the rename: a folder put aside is always marked
        rename(spark, target, previous)
        try:
            rename(spark, incoming, target)
        except Exception:
            rename(spark, previous, target)
            delete(spark, mark)
            raise
        if exists(spark, incoming) or not exists(spark, target):
            raise RuntimeError(f"another swap ran at {target}; the data before it is in {previous}")
        delete(spark, previous)
        delete(spark, mark)
    spark.catalog.refreshByPath(target)


def write_and_swap(df: DataFrame, target: str, write: Callable[[DataFrame, str], None]) -> None:
    """Write ``df`` beside ``target`` (same file system) and swap it in.

    ``df`` may read from ``target``. On failure the target is untouched and the
    partial output removed.
    """
    spark = df.sparkSession
    incoming = f"{target.rstrip('/')}__incoming-{uuid4().hex}"
    try:
        write(df, incoming)
    except Exception:
        delete(spark, incoming)
        raise
    swap_into_place(spark, incoming, target)
