"""Connected components of a table of links, in rounds of grouping and joining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.words import written


#: Links in one file of a round, so that late rounds over few links are not spread over many tasks.
FILE_LINKS = 100_000
#: Tasks that write a round at least.
LEAST_TASKS = 12


def _marks(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, the least id reachable over the links (a, b); linked ids alone occur.

    Large-star and small-star rounds: each hangs the neighbours of an id on the least id
    near it, until every id hangs on the least of its component. Rounds grow with the logarithm of a
    component's size. Each is written to the shared folder. A frequent id is one row per
    task when grouped, and its side of the join can be split.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = written(spark, pairs, "component-links")
    marks = _marks(pairs)
    while True:
        tasks = max(LEAST_TASKS, marks[0] // FILE_LINKS)
        # large star: from each id to its greater neighbours
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(spark, large.coalesce(tasks), "large-star")
        # small star: from each id to its lesser neighbours and itself
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        pairs = written(spark, small.coalesce(tasks), "small-star")
        if (now := _marks(pairs)) == marks:
            break
        marks = now
    roots = pairs.select(F.col("b").alias("id")).distinct()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
