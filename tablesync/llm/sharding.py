"""Contiguous shards of equal byte size, from global prefix sums of document sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.words import keyed, public_id, written


def shard_by_bytes(spark: SparkSession, docs: DataFrame, shards: int = 16) -> DataFrame:
    """Cut the documents, in the order of doc_id, at equal byte targets.

    A document's size is its text's UTF-8 bytes plus one. With P the bytes before
    a document and T those of all, it goes to shard ``floor(P * shards / T)``; shards
    are thus contiguous in doc_id and differ by less than twice the largest
    document. ``slot`` counts the documents of a shard from 0.

    The rows that are sorted hold an id and two numbers, no text. They are cut into
    ranges, written once, and numbered inside each range; only one total per range
    meets in one place. Rows that agree in all columns are told apart by where they
    were read, so many repeats of a row spread over ranges, too.

    A null text has size 1 and a null crc. A null doc_id comes first. Rows that
    repeat each take their own slot. An empty table gives no rows. Other columns
    are not looked at.
    """
    slim = keyed(docs).select(
        "id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("read_at"),
    )
    order = ["id", "text_crc32", "size", "read_at"]
    # A fixed number of ranges: a range's share of the rows does not grow with its neighbours'.
    ranges = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = written(
        spark, slim.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "shard-rows"
    )
    totals = rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("range").orderBy(*order)
    start = F.col("bytes_before") + F.sum("size").over(inside) - F.col("size")
    placed = (
        rows.join(starts, "range")
        .withColumn("start", start.cast("decimal(28,0)"))  # whole numbers: doubles would round above 2**53 bytes
        .withColumn("shard", F.expr(f"CAST(start * {shards} div CAST(all_bytes AS DECIMAL(28,0)) AS INT)"))
        .withColumn("index", F.col("rows_before") + F.row_number().over(inside) - 1)
    )
    placed = written(spark, placed, "shard-placed")
    firsts = placed.groupBy("shard").agg(F.min("index").alias("first"))
    return placed.join(firsts, "shard").select(
        public_id(), "size", "text_crc32", "shard", (F.col("index") - F.col("first")).alias("slot")
    )


def op8_shard_by_bytes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The digest of ``shard_by_bytes`` over 16 shards; a null text counts as empty."""
    return shard_by_bytes(spark, docs).select(
        "doc_id",
        "size",
        F.coalesce("text_crc32", F.lit(0).cast("long")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: crc32 is not a function of DuckDB: its table is made by the usual rule and the bytes folded in.
SQL = """
WITH RECURSIVE bits AS (SELECT range AS i, range::UBIGINT AS c, 0 AS step FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, step + 1
  FROM bits WHERE step < 8),
t AS (SELECT list(c ORDER BY i) AS crc_table FROM bits WHERE step = 8),
d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, size, xor(4294967295::UBIGINT, CASE WHEN text = '' THEN 4294967295::UBIGINT ELSE list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split(regexp_replace(hex(encode(text)), '(..)', '\\1 ', 'g'), ' ')[:-2],
    lambda x: ('0x' || x)::UBIGINT)),
  lambda a, b: xor(crc_table[(xor(a, b) & 255)::BIGINT + 1], a >> 8)) END)::BIGINT AS text_crc32 FROM d, t),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS start, sum(size) OVER () AS all_bytes FROM c),
s AS (SELECT *, least(start * 16 // all_bytes, 15)::INTEGER AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard FROM s
"""
