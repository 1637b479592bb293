"""Database imports and exports with Spark answering the generated SQL.

No database runs here. The reader and writer below take the JDBC options the
library sets and let Spark SQL evaluate the query texts over views (which accept
MySQL's quoting), so the texts and options are real, the connection is not.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tablesync as ts

DATABASE = ts.JdbcSource("jdbc:mysql://host/db")


class Reads:
    def __init__(self, spark, real):
        self.spark, self.real, self.log = spark, real, []

    def __getattr__(self, name):
        return getattr(self.real, name)

    def format(self, name):
        return self if name == "jdbc" else self.real.format(name)

    def options(self, **options):
        if "url" not in options:
            return self.real.options(**options)
        self.log.append(options)
        return self

    def load(self):
        options = self.log[-1]
        assert ("query" in options) != ("dbtable" in options)
        return self.spark.sql(options.get("query") or f"SELECT * FROM {options['dbtable']}")


@pytest.fixture
def reads(spark, monkeypatch):
    log, kind = [], type(spark)
    original = kind.read

    def read(session):
        reader = Reads(session, original.fget(session))
        reader.log = log
        return reader

    monkeypatch.setattr(kind, "read", property(read))
    rows = [(i, f"n{i}", datetime(2024, 1, 1 + i)) for i in range(10)]
    spark.createDataFrame(rows, "id bigint, name string, ts timestamp_ntz").createOrReplaceTempView("people")
    yield log
    spark.catalog.dropTempView("people")


def stored(spark, job):
    return sorted(r["id"] for r in spark.read.parquet(job.target).collect())


def test_parallel_table_import(spark, reads, tmp_path):
    job = ts.ImportJob(
        source=replace(DATABASE, table="people"),
        columns="id, NAME",
        where="id < 4 OR id = 7",
        split_by="id",
        num_splits=4,
        target_dir=str(tmp_path / "t"),
        layout="parquet",
    )
    ts.run_import(spark, job)
    assert stored(spark, job) == [0, 1, 2, 3, 7]
    assert spark.read.parquet(job.target).columns == ["id", "NAME"]
    assert reads[-1]["dbtable"] == "(SELECT * FROM `people` WHERE (id < 4 OR id = 7)) t1"
    assert (reads[-1]["lowerBound"], reads[-1]["upperBound"], reads[-1]["numPartitions"]) == ("0", "7", "4")


def test_parallel_query_import(spark, reads, tmp_path):
    job = ts.ImportJob(
        source=DATABASE,
        query="SELECT id, name FROM people WHERE $CONDITIONS",
        split_by="id",
        num_splits=2,
        split_limit=3,
        target_dir=str(tmp_path / "t"),
        layout="parquet",
    )
    ts.run_import(spark, job)
    assert stored(spark, job) == list(range(10))
    assert reads[-1]["numPartitions"] == "4"


@pytest.mark.parametrize("query", [None, "SELECT id, ts FROM people WHERE $CONDITIONS", "SELECT id, ts FROM people"])
def test_append_import(spark, reads, tmp_path, query):
    job = ts.ImportJob(
        source=DATABASE if query else replace(DATABASE, table="people"),
        query=query,
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="append",
        check_column="id",
        last_value="6",
    )
    result = ts.run_import(spark, job)
    assert (result.last_value, stored(spark, job)) == (9, [7, 8, 9])
    maxima = [r["query"] for r in reads if "query" in r]
    assert len(maxima) == 1 and maxima[0].startswith("SELECT MAX(`id`)")
    assert not ts.run_import(spark, replace(job, last_value="9")).imported


@pytest.mark.parametrize("query", [None, "SELECT id, ts FROM people WHERE $CONDITIONS"])
def test_lastmodified_import(spark, reads, tmp_path, query):
    job = ts.ImportJob(
        source=DATABASE if query else replace(DATABASE, table="people"),
        query=query,
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="lastmodified",
        check_column="ts",
        last_value="2024-01-03",
        now=datetime(2024, 1, 6),
    )
    ts.run_import(spark, job)
    assert stored(spark, job) == [2, 3, 4]


def test_the_database_clock(spark, reads, tmp_path):
    job = ts.ImportJob(
        source=replace(DATABASE, table="people"),
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="lastmodified",
        check_column="ts",
    )
    result = ts.run_import(spark, job)
    assert any("CURRENT_TIMESTAMP" in r.get("query", "") for r in reads)
    assert result.last_value > datetime(2025, 1, 1) and stored(spark, job) == list(range(10))


class Writes:
    """Takes the place of ``df.write``: the staging table becomes a view."""

    def __init__(self, df, surplus):
        self.df, self.surplus = df, surplus

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        assert "fetchsize" not in options
        self.table = options["dbtable"]
        return self

    def mode(self, mode):
        assert mode == "overwrite"
        return self

    def save(self):
        rows = self.df.collect()  # a write runs its rows, which counts them
        stored = self.df.sparkSession.createDataFrame(rows + rows[: self.surplus], self.df.schema)
        stored.createOrReplaceTempView(self.table.strip("`"))


@pytest.mark.parametrize("surplus", [0, 1])
def test_export(spark, reads, monkeypatch, surplus):
    dest = replace(DATABASE, table="people")
    df = spark.range(3).select("id", F.lit("x").alias("name"))
    df.limit(0).createOrReplaceTempView("people")
    monkeypatch.setattr(type(df), "write", property(lambda frame: Writes(frame, surplus)))
    ran = []
    if surplus:  # a retried task wrote its rows twice
        with pytest.raises(RuntimeError, match="4 rows, expected 3"):
            ts.export_jdbc(df, dest, "people_staging", ran.append)
        assert ran == []
    else:
        ts.export_jdbc(df, dest, "people_staging", ran.append, columns=["NAME", "id"])
        assert ran == [
            "INSERT INTO `people` (`NAME`, `id`) SELECT `NAME`, `id` FROM `people_staging`",
            "DROP TABLE `people_staging`",
        ]


def test_export_is_exact(spark, reads, monkeypatch):
    """A value that the target's column cannot hold exactly fails before the target is touched."""
    dest = replace(DATABASE, table="people")
    spark.sql("SELECT CAST(1 AS DECIMAL(4,1)) AS price").createOrReplaceTempView("people")
    df = spark.sql("SELECT CAST(1.25 AS DECIMAL(6,2)) AS price")
    monkeypatch.setattr(type(df), "write", property(lambda frame: Writes(frame, 0)))
    ran = []
    with pytest.raises(Exception, match="not exact"):
        ts.export_jdbc(df, dest, "people_staging", ran.append)
    with pytest.raises(ValueError, match="no columns"):
        ts.export_jdbc(df.withColumn("other", F.lit(1)), dest, "people_staging", ran.append)
    assert ran == []
