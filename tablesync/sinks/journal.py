"""Replacing some files of a dataset by others, all or none.

The new files are complete in a folder beside the dataset before a journal is
written that names them and the files they replace. Writing the journal is the
moment of decision: without one, nothing has happened; with one, whoever comes next
finishes the work. Files that are not named are never touched and keep their names.

New files go in before old ones go out, so no row is ever missing from the
dataset; between the two a reader may meet a row in its old and its new version.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tablesync.storage import delete, exists, read_whole, rename, write_new

JOURNAL = "__journal"
#: File operations at a time; each is a call to the file system's server.
OPERATIONS = 16


def _each(action: Callable, items: Iterable) -> None:
    with ThreadPoolExecutor(OPERATIONS) as pool:
        list(pool.map(action, items))


def replace_files(spark: SparkSession, target: str, staging: str, added: Sequence[str], removed: Sequence[str]) -> None:
    """Move ``added`` from ``staging`` into ``target`` and remove ``removed`` there.

    Both are paths inside their folder.
    """
    target = target.rstrip("/")
    moves = [(f"{staging}/{name}", f"{target}/{name}") for name in added]
    commit(spark, target, staging, moves, [f"{target}/{name}" for name in removed])


def commit(
    spark: SparkSession, target: str, staging: str, moves: Sequence[tuple[str, str]], removed: Sequence[str]
) -> None:
    """Move files to new places and remove others, all or none; the journal stands beside ``target``.

    A second writer finds the journal of the first and fails.
    """
    target = target.rstrip("/")
    recover_files(spark, target)
    plan = {"staging": staging, "moves": list(moves), "removed": list(removed)}
    write_new(spark, target + JOURNAL, json.dumps(plan))
    recover_files(spark, target)


def recover_files(spark: SparkSession, target: str) -> None:
    """Finish a replacement that was cut off, if there is one; safe to repeat."""
    target = target.rstrip("/")
    if not exists(spark, target + JOURNAL):
        return
    text = read_whole(spark, target + JOURNAL)
    if not text.endswith("\n"):  # its writer was cut off before it had decided
        delete(spark, target + JOURNAL)
        return
    plan = json.loads(text)

    def move(pair: tuple[str, str]) -> None:
        source, place = pair
        if exists(spark, source):
            rename(spark, source, place)
        elif not exists(spark, place):
            raise FileNotFoundError(f"neither {source} nor {place} exists")

    _each(move, plan["moves"])
    _each(lambda path: delete(spark, path), plan["removed"])
    delete(spark, plan["staging"])
    delete(spark, target + JOURNAL)
    spark.catalog.refreshByPath(target)
