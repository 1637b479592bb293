from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.sources import splits
from tablesync.sources.jdbc import fill_conditions

MYSQL = ts.JdbcSource("jdbc:mysql://host/db", table="or`ders", user="me", password="secret")
OTHER = ts.JdbcSource("jdbc:derby:memory:x", table="orders")


class RecordingReader:
    """Stands in for a session's reader: no database is started for a test."""

    def __init__(self, spark, bounds):
        self.spark, self.bounds, self.reads = spark, bounds, []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.reads.append(options)
        return self

    def load(self):
        if "query" in self.reads[-1]:
            return self.spark.createDataFrame([self.bounds], "lo bigint, hi bigint")
        return self.spark.createDataFrame([(1, "a")], "id bigint, name string")


def test_jdbc_options():
    options = MYSQL.options(dbtable="t")
    assert options["fetchsize"] == "-2147483648"
    assert (options["url"], options["user"], options["dbtable"]) == ("jdbc:mysql://host/db", "me", "t")
    assert "secret" not in repr(MYSQL)
    assert "fetchsize" not in OTHER.options()
    with pytest.raises(ValueError, match="negative"):
        ts.JdbcSource("jdbc:derby:x", fetchsize=-1).options()
    assert ts.JdbcSource("jdbc:mysql:x", fetchsize=500).options()["fetchsize"] == "500"
    relaxed = ts.JdbcSource("jdbc:mysql:x", relaxed_isolation=True).options()
    assert relaxed["sessionInitStatement"].endswith("READ UNCOMMITTED")
    with pytest.raises(ValueError, match="sessionInitStatement"):
        ts.JdbcSource("jdbc:other:x", relaxed_isolation=True).options()


def test_jdbc_texts():
    assert MYSQL.relation() == "`or``ders`"
    assert OTHER.relation(where="a = 1 OR b") == '(SELECT * FROM "orders" WHERE (a = 1 OR b)) t1'
    assert OTHER.relation("SELECT 1 WHERE $CONDITIONS") == "(SELECT 1 WHERE (1 = 1)) t1"
    assert MYSQL.max_query("k") == "SELECT MAX(`k`) AS max_value FROM `or``ders`"
    assert OTHER.bounds_query("k", "SELECT * FROM t") == (
        'SELECT MIN("k") AS lo, MAX("k") AS hi FROM (SELECT * FROM t) t1'
    )
    assert fill_conditions("x WHERE $CONDITIONS AND b", "a > 1") == "x WHERE (a > 1) AND b"
    with pytest.raises(ValueError, match="slot"):
        fill_conditions("SELECT 1", "a > 1")
    with pytest.raises(ValueError, match="table or a query"):
        ts.JdbcSource("jdbc:x").relation()


def test_jdbc_scans(spark):
    fake = RecordingReader(spark, (1, 1000))
    assert ts.scan_table(fake, OTHER, "NAME", "id > 0").columns == ["NAME"]
    assert fake.reads[-1]["dbtable"] == '(SELECT * FROM "orders" WHERE (id > 0)) t1'
    ts.scan_query(fake, OTHER, "SELECT 1 WHERE $CONDITIONS", "a = 1")
    assert fake.reads[-1]["dbtable"] == "(SELECT 1 WHERE (a = 1)) t1"


def test_jdbc_max(spark):
    class MaxReader(RecordingReader):
        def load(self):
            return self.spark.createDataFrame([self.bounds], f"max_value {self.kind}")

    fake = MaxReader(spark, (7,))
    fake.kind = "bigint"
    assert ts.jdbc_max_check_value(fake, OTHER, "k").first()[0] == 7
    assert fake.reads[-1]["query"] == 'SELECT MAX("k") AS max_value FROM "orders"'
    fake.kind, fake.bounds = "string", ("a",)
    with pytest.raises(ValueError, match="character column"):
        ts.jdbc_max_check_value(fake, OTHER, "k")


def test_jdbc_splits(spark):
    fake = RecordingReader(spark, (1, 1000))
    ts.split_scan(fake, OTHER, "id", 4, where="a = 1")
    assert fake.reads[0]["query"].startswith('SELECT MIN("id") AS lo, MAX("id") AS hi FROM (SELECT * FROM "orders"')
    ranges = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    assert [fake.reads[1][r] for r in ranges] == ["id", "1", "1000", "4"]

    fake.reads.clear()
    ts.split_scan(fake, OTHER, "id", 4, bounds=(0, 999), split_limit=100)
    assert len(fake.reads) == 1 and fake.reads[0]["numPartitions"] == "10"

    fake.reads.clear()
    ts.split_scan(fake, OTHER, "id", 2, boundary_query="SELECT 5, 6")
    assert fake.reads[0]["query"] == "SELECT 5, 6"

    for arguments in ({"split_by": None, "n": 4, "auto_reset": True}, {"split_by": "id", "n": 1}):
        fake.reads.clear()
        ts.split_scan(fake, OTHER, **arguments)
        assert len(fake.reads) == 1 and "partitionColumn" not in fake.reads[0]
    with pytest.raises(ValueError, match="split column"):
        ts.split_scan(fake, OTHER, None, 4)

    empty = RecordingReader(spark, (None, None))
    ts.split_scan(empty, OTHER, "id", 4)
    assert "partitionColumn" not in empty.reads[-1]


def test_split_count():
    assert ts.split_count(1, 1000, 4) == 4
    assert ts.split_count(1, 1000, 4, 100) == 10
    assert ts.split_count(1, 1001, 4, 100) == 11
    assert ts.split_count(date(2024, 1, 1), date(2024, 1, 10), 2, 3) == 4
    assert ts.split_count(Decimal(0), Decimal(9), 3, 5) == 3
    for bad in ((1, 2, 0, None), (1, 2, 1, 0)):
        with pytest.raises(ValueError):
            ts.split_count(*bad)
    assert splits.range_options("k", (1, 2), 1) == {}


@pytest.mark.parametrize(("n", "limit"), [(1, None), (4, None), (7, None), (2, 3), (50, 1000)])
def test_split_plan_covers_every_row_once(spark, n, limit):
    keys = [-20, -20, -19, 3, 3, 3, 3, 17, 40, None]
    df = spark.createDataFrame([(k,) for k in keys], "key int")
    plan = sorted(ts.split_plan(df, "KEY", n, limit).collect())
    assert [r["split_id"] for r in plan] == list(range(len(plan)))
    assert (plan[0]["low"], plan[-1]["high"]) == (-20, 40)
    assert len(plan) <= max(n, 61 // (limit or 61) + 1)
    for a, b in zip(plan, plan[1:]):
        assert b["low"] == a["high"] + 1
    for i, r in enumerate(plan):
        inside = sum(1 for k in keys if k is not None and r["low"] <= k <= r["high"])
        assert r["rows"] == inside + (1 if i == 0 else 0)  # the row without a key
        assert limit is None or r["high"] - r["low"] < limit


def test_many_splits(spark):
    ends = spark.createDataFrame([(0,), (4 * 10**9,)], "key bigint")
    assert sorted(r["split_id"] for r in ts.with_split_id(ends, "key", 1, 1).collect()) == [0, 4 * 10**9]
    plan = ts.split_plan(ends, "key", 1, 400)
    row = plan.agg(F.count("*").alias("n"), F.sum("rows").alias("rows"), F.max("high").alias("high")).first()
    assert tuple(row) == (10**7 + 1, 2, 4 * 10**9)


def test_split_plan_edges(spark):
    assert ts.split_plan(spark.range(0), "id", 4).collect() == []
    wide = spark.createDataFrame([(-(2**62),), (2**62 - 1,)], "key bigint")
    assert sum(r["rows"] for r in ts.split_plan(wide, "key", 4).collect()) == 2
    for bad in ((0, None), (1, 0)):
        with pytest.raises(ValueError):
            ts.split_plan(spark.range(3), "id", *bad)
    with pytest.raises(ValueError, match="integer"):
        ts.split_plan(spark.createDataFrame([("a",)], "s string"), "s", 2)


def test_clustered_scan_spreads_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("k"), "id")
    out = ts.split_scan(spark, df, "k", 6, clustered=True)
    assert out.rdd.getNumPartitions() == 6
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000
    ends = out.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    ordered = ends.orderBy("p").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(ordered, ordered[1:]))


def test_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").parquet(path)
    assert set(ts.parquet_scan(spark, path, merge_schema=True).columns) == {"a", "b"}
    assert set(ts.parquet_scan(spark, path, "b string, c int").collect()) == {(None, None), ("x", None)}


def test_spark_query(spark):
    df = spark.range(5)
    out = ts.scan_query(spark, None, "SELECT id FROM {t} WHERE $CONDITIONS AND id > 1", "id < 4", {"t": df})
    assert [r[0] for r in out.collect()] == [2, 3]
    assert ts.scan_query(spark, None, "SELECT 1 AS one WHERE $CONDITIONS").collect() == [(1,)]
    assert [r[0] for r in ts.scan_table(spark, df, ["ID"], "id >= 3").collect()] == [3, 4]


def test_clustered_ranges_follow_the_size_of_the_table(spark, monkeypatch):
    """A range that one task reads stays as large as it is when the table grows; few rows keep the given number."""
    monkeypatch.setattr(splits, "RANGE_BYTES", 20_000)
    shares = []
    for rows in (3000, 12_000):
        df = spark.range(rows).select("id", F.lit("x" * 20).alias("t"), F.array("id").alias("a"), F.lit(b"y").alias("b"))
        out = ts.split_scan(spark, df, "id", 2, clustered=True)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == rows and out.agg(F.sum("id")).first()[0] == rows * (rows - 1) // 2
        shares.append(max(sizes))
    assert shares[1] < 1.5 * shares[0]
    assert splits.ranges_for(spark.range(5), 3) == 3 and splits.ranges_for(spark.range(0), 1) == 1
    nulls = spark.sql("SELECT CAST(NULL AS STRING) AS s, CAST(NULL AS MAP<STRING, INT>) AS m, 1.5 AS d FROM range(3000)")
    assert splits.ranges_for(nulls, 1) >= 3000 * 40 // 20_000
