"""Words, their hashes and written intermediate tables, as several operators need them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tablesync.storage import shared_dir

#: The document id that stands for null inside operators; it sorts before all others.
NULL_ID = -(2**63)
#: Rows that one task numbers, on average.
NUMBERED_TOGETHER = 1_000_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, *more: str | Column) -> DataFrame:
    """Only the id, as a never-null ``id``, the text and the named columns."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "text", *more)


def public_id(col: str = "id") -> Column:
    """The document id as given, null included."""
    return F.when(F.col(col) != NULL_ID, F.col(col)).alias("doc_id")


def numbered(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """``index`` of each row in its ``tree`` by the order, from 0, and ``n``, the tree's rows.

    The order must be total; the rows must be stored, as they are read twice. Ranges of the order are
    numbered each on their own; one total per range and tree meets the others of its tree.
    """
    count = rows.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // NUMBERED_TOGETHER))
    placed = rows.repartitionByRange(ranges, "tree", *order).withColumn("range", F.spark_partition_id())
    placed = written(spark, placed, "numbered-ranges")
    totals = placed.groupBy("tree", "range").agg(F.count("*").alias("rows"))
    by_tree = Window.partitionBy("tree")
    starts = totals.select(
        "tree",
        "range",
        (F.sum("rows").over(by_tree.orderBy("range")) - F.col("rows")).alias("start"),
        F.sum("rows").over(by_tree).alias("n"),
    )
    inside = Window.partitionBy("tree", "range").orderBy(*order)
    ranked = placed.withColumn("place", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["tree", "range"]).withColumn("index", F.col("start") + F.col("place")).drop(
        "range", "start", "place"
    )


def row_keyed(spark: SparkSession, docs: DataFrame, *more: str | Column) -> tuple[DataFrame, DataFrame | None]:
    """Rows as ``keyed`` gives them, under an ``id`` that no two rows share, and what each id stands for.

    Where doc_ids already are different (null being one of them) they are the ids, and the second is None. Otherwise the
    rows are written once and numbered by doc_id, null first, then by their texts' hashes and where they were read; the second is then a table
    (row_id, doc_id). Rows that share a doc_id are thus documents of their own, one after the other.
    ``text`` may be of any type that Spark can hash.
    """
    rows = keyed(docs, *more)
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return rows, None
    stored = written(spark, rows.withColumn("read_at", F.monotonically_increasing_id()), "rows-with-shared-ids")
    slim = stored.select(F.lit("").alias("tree"), "id", F.xxhash64("text").alias("hash"), "read_at")
    names = written(spark, numbered(spark, slim, ["id", "hash", "read_at"]).select("read_at", "id", "index"), "row-keys")
    keys = names.select("read_at", F.col("index").alias("row_id"))
    whole = stored.join(keys, "read_at").withColumn("id", F.col("row_id")).select(*rows.columns)
    return written(spark, whole, "keyed-rows"), names.select(F.col("index").alias("row_id"), public_id())


def with_doc_id(found: DataFrame, names: DataFrame | None, col: str = "id", name: str = "doc_id") -> DataFrame:
    """``found`` and, under ``name``, the doc_id that the row key in ``col`` stands for."""
    if names is None:
        return found.withColumn(name, public_id(col))
    meant = names.select(F.col("row_id").alias("__row"), F.col("doc_id").alias(name))
    return found.join(meant, F.col(col) == F.col("__row")).drop("__row")


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of UTF-8 bytes other than space and \\t to \\r; none for null."""
    return text.encode().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k consecutive words, by its start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * _MULTIPLIER + hashes[i : i + n]
    return mixed(total)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's long, bit by bit."""
    return x.view(np.int64)
