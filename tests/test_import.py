from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.storage import exists

TABLE = ts.JdbcSource("jdbc:mysql:x", table="t")
DATABASE = ts.JdbcSource("jdbc:mysql:x")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    ("options", "message"),
    [
        ({}, "table or a query is required"),
        ({"source": DATABASE}, "table or a query is required"),
        ({"source": TABLE, "query": "q"}, "exclude"),
        ({"source": TABLE, "warehouse_dir": "w"}, "target_dir and warehouse_dir"),
        ({"source": DATABASE, "query": "q", "target_dir": None}, "query needs a target_dir"),
        ({"source": DATABASE, "query": "q", "num_splits": 4}, "needs split_by"),
        ({"source": DATABASE, "query": "q", "validate": True}, "for a query"),
        ({"source": TABLE, "where": "a", "validate": True}, "row filter"),
        ({"source": TABLE, "incremental": "append", "check_column": "a", "validate": True}, "for an incremental"),
        ({"source": TABLE, "append": True, "overwrite": True}, "append and overwrite"),
        ({"source": TABLE, "overwrite": True, "incremental": "append", "check_column": "a"}, "overwrite excludes"),
        ({"source": TABLE, "auto_reset": True, "split_by": "a"}, "auto_reset and split_by"),
        ({"source": TABLE, "incremental": "daily", "check_column": "a"}, "incremental is"),
        ({"source": TABLE, "incremental": "append"}, "needs a check_column"),
        ({"source": TABLE, "check_column": "a"}, "needs an incremental mode"),
        ({"source": TABLE, "incremental": "lastmodified", "check_column": "a", "layout": "avro"}, "Avro"),
        ({"source": TABLE, "layout": "sequence"}, "layout is one of"),
        ({"source": TABLE, "target_dir": None}, "is required"),
        ({"source": TABLE, "job": "j"}, "go together"),
        ({"source": TABLE, "catalog_table": "c", "append": True, "merge_key": "k"}, "appended or merged"),
        ({"source": TABLE, "rewrite": "some"}, "rewrite is"),
        ({"source": TABLE, "rewrite": "touched", "layout": "text"}, "only Parquet"),
        ({"source": TABLE, "bucket_by": (2, ["k"])}, "needs a catalog_table"),
        ({"source": TABLE, "decimals_as_text": "short"}, "plain"),
        ({"source": "p", "split_by": "k", "split_limit": 3}, "needs a database"),
    ],
)
def test_options_that_do_not_go_together(options, message):
    with pytest.raises(ValueError, match=message):
        ts.check_job(ts.ImportJob(**{"target_dir": "d", **options}))


def test_target():
    job = ts.ImportJob(source=TABLE, name="t")
    assert job.target == "t"
    assert replace(job, warehouse_dir="/w/").target == "/w/t"
    assert replace(job, target_dir="/d").target == "/d"


def test_table_import(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, "a\nb", 2001), (2, None, None, 1999)], "`1d` int, price double, s string, y int")
    target = str(tmp_path / "t")
    job = ts.ImportJob(
        source=df,
        target_dir=target,
        layout="parquet",
        codec="zstd",
        columns="1d, PRICE, s, y",
        decimals={"price": (5, 2)},
        overrides={"1d": "LONG"},
        years=["y"],
        drop_delims=True,
        validate=True,
    )
    result = ts.run_import(spark, job)
    assert (result.imported, result.source_rows, result.target_rows) == (True, 2, 2)
    stored = ts.parquet_scan(spark, target)
    assert stored.columns == ["AVRO_1d", "PRICE", "s", "y"]
    assert [f.dataType.simpleString() for f in stored.schema] == ["bigint", "decimal(5,2)", "string", "smallint"]
    assert rows(stored) == [(1, Decimal("0.50"), "ab", 2001), (2, None, None, 1999)]

    with pytest.raises(Exception, match="(?i)exists"):
        ts.run_import(spark, job)
    again = ts.run_import(spark, replace(job, append=True))
    assert (again.source_rows, again.target_rows) == (2, 2)
    assert ts.parquet_scan(spark, target).count() == 4
    ts.run_import(spark, replace(job, overwrite=True))
    assert ts.parquet_scan(spark, target).count() == 2


@pytest.mark.parametrize("layout", ["text", "parquet"])
def test_query_import(spark, tmp_path, layout):
    job = ts.ImportJob(
        query="SELECT id, id * 2 AS twice FROM {t} WHERE $CONDITIONS",
        tables={"t": spark.range(5)},
        target_dir=str(tmp_path / "t"),
        layout=layout,
    )
    ts.run_import(spark, job)
    stored = ts.read_files(spark, job.target, layout, "id bigint, twice bigint" if layout == "text" else None)
    assert rows(stored) == [(i, 2 * i) for i in range(5)]


def test_layout_options(spark, tmp_path):
    df = spark.createDataFrame([(1, Decimal("0.50")), (2, None)], "k int, price decimal(9,2)")
    text = ts.ImportJob(
        source=df,
        target_dir=str(tmp_path / "text"),
        layout_options={"sep": "|", "null_text": "-"},
        incremental="lastmodified",
        check_column="ts",
        now=datetime(2024, 2, 1),
        merge_key="k",
    )
    dated = df.withColumn("ts", F.lit("2024-01-01").cast("date"))
    for _ in range(2):
        ts.run_import(spark, replace(text, source=dated))
    lines = "".join(p.read_text() for p in (tmp_path / "text").glob("*.csv")).split()
    assert sorted(lines) == ["1|0.50|2024-01-01", "2|-|2024-01-01"]

    fixed = ts.ImportJob(
        source=df, target_dir=str(tmp_path / "p"), layout="parquet", layout_options={"fixed_layout": True}, overwrite=True
    )
    ts.run_import(spark, fixed)
    file = next(f for f in (tmp_path / "p").glob("*.parquet") if pq.ParquetFile(f).metadata.num_rows)
    assert pq.ParquetFile(file).schema.column(1).physical_type == "FIXED_LEN_BYTE_ARRAY"


def test_append_runs(spark, tmp_path):
    source = str(tmp_path / "source")
    job = ts.ImportJob(
        source=source,
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="append",
        check_column="ID",
        job="j",
        state_path=str(tmp_path / "state"),
    )
    ts.write_parquet(spark.range(10), source)
    assert ts.run_import(spark, job).last_value == 9
    again = ts.run_import(spark, job)
    assert not again.imported and ts.parquet_scan(spark, job.target).count() == 10
    ts.write_parquet(spark.range(5, 15), source, mode="append")
    assert ts.run_import(spark, job).last_value == 14
    assert rows(ts.parquet_scan(spark, job.target)) == [(i,) for i in range(15)]
    assert ts.load_state(spark, job.state_path, "j")["last_value"] == "14"


@pytest.mark.parametrize(("layout", "unique"), [("parquet", False), ("parquet", True), ("text", False)])
def test_lastmodified_runs(spark, tmp_path, layout, unique):
    def table(*data):
        return spark.createDataFrame(data, "k int, s string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    job = ts.ImportJob(
        source=table((1, "a", "2024-01-01"), (2, "b", "2024-01-02")),
        target_dir=str(tmp_path / "t"),
        layout=layout,
        incremental="lastmodified",
        check_column="ts",
        now=datetime(2024, 1, 3),
        merge_key="k",
        old_is_unique=unique,
        job="j",
        state_path=str(tmp_path / "state"),
    )
    ts.run_import(spark, job)
    second = replace(
        job,
        source=table((1, "a", "2024-01-01"), (2, "new", "2024-01-03"), (3, "c", "2024-01-04"), (4, "later", "2024-01-05")),
        now=datetime(2024, 1, 5),
    )
    assert ts.run_import(spark, second).last_value == datetime(2024, 1, 5)
    stored = ts.read_files(spark, job.target, layout, job.source.schema if layout == "text" else None)
    assert rows(stored.drop("ts")) == [(1, "a"), (2, "new"), (3, "c")]
    assert ts.load_state(spark, job.state_path, "j")["last_value"] == "2024-01-05 00:00:00"
    with pytest.raises(ValueError, match="merge_key or append"):
        ts.run_import(spark, replace(second, merge_key=None, now=datetime(2024, 1, 6)))


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_zoned_check_column_in_another_zone(spark, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = spark.sql("SELECT id, timestamp'2024-01-05 10:00:00' + make_dt_interval(0, id) AS ts FROM range(12)")
        job = ts.ImportJob(
            source=times.where("id < 10"),
            target_dir=str(tmp_path / "t"),
            layout="parquet",
            incremental="append",
            check_column="ts",
            job="j",
            state_path=str(tmp_path / "state"),
        )
        assert ts.run_import(spark, job).last_value == datetime(2024, 1, 5, 19)
        ts.run_import(spark, replace(job, source=times))
        assert sorted(r["id"] for r in ts.parquet_scan(spark, job.target).collect()) == list(range(12))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def dated(spark, *data, key="k"):
    """Keys with the day of January 2024 on which the row was last changed."""
    return spark.createDataFrame(data, f"`{key}` int, day int").select(
        f"`{key}`", F.date_add(F.lit("2023-12-31").cast("date"), F.col("day")).alias("last-change")
    )


def days(df):
    return sorted((k, day.day) for k, day in df.collect())


def test_first_import_keeps_the_promise_of_unique_keys(spark, tmp_path):
    job = ts.ImportJob(
        source=dated(spark, (1, 1), (1, 2), (2, 1)),
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="lastmodified",
        check_column="last-change",
        now=datetime(2024, 1, 3),
        merge_key="k",
        tie_break="last-change",
        old_is_unique=True,
    )
    ts.run_import(spark, job)
    assert days(ts.parquet_scan(spark, job.target)) == [(1, 2), (2, 1)]
    again = replace(job, source=dated(spark, (2, 3), (2, 4)), last_value="2024-01-03", now=datetime(2024, 1, 9))
    ts.run_import(spark, again)
    assert days(ts.parquet_scan(spark, job.target)) == [(1, 2), (2, 4)]


def test_merge_key_with_a_cleaned_name(spark, tmp_path):
    job = ts.ImportJob(
        source=dated(spark, (1, 1), (2, 1), key="1st key"),
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="lastmodified",
        check_column="last-change",
        now=datetime(2024, 1, 2),
        merge_key="1st key",
        tie_break="last-change",
    )
    ts.run_import(spark, job)
    more = dated(spark, (2, 2), (2, 3), (3, 2), key="1st key")
    ts.run_import(spark, replace(job, source=more, last_value="2024-01-02", now=datetime(2024, 1, 9)))
    stored = ts.parquet_scan(spark, job.target)
    assert stored.columns == ["AVRO_1st_key", "last_change"]
    assert days(stored) == [(1, 1), (2, 3), (3, 2)]


def test_failed_merge_saves_no_state(spark, tmp_path):
    source = dated(spark, (1, 1), (None, 2))
    ts.write_parquet(source.where("k = 1").withColumnRenamed("last-change", "last_change"), str(tmp_path / "t"))
    job = ts.ImportJob(
        source=source,
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="lastmodified",
        check_column="last-change",
        now=datetime(2024, 1, 9),
        merge_key="k",
        job="j",
        state_path=str(tmp_path / "state"),
    )
    with pytest.raises(Exception, match="null key"):
        ts.run_import(spark, job)
    assert ts.load_state(spark, job.state_path, "j") is None
    assert days(ts.parquet_scan(spark, job.target)) == [(1, 1)]


def test_append_mode_appends(spark, tmp_path):
    """With a merge key, too: new rows go beside the old ones, nothing is compared."""
    job = ts.ImportJob(
        source=spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"),
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        incremental="append",
        check_column="v",
        merge_key="k",
    )
    ts.run_import(spark, job)
    more = spark.createDataFrame([(1, 2), (1, 3), (None, 4)], "k int, v int")
    ts.run_import(spark, replace(job, source=more, last_value=2))
    assert sorted(map(tuple, ts.parquet_scan(spark, job.target).collect()), key=repr) == [(1, 1), (1, 2), (1, 3), (None, 4)]


def test_stored_as_text_and_milliseconds(spark, tmp_path):
    df = spark.sql("SELECT 1 AS k, 0.5D AS price, '0.00000001' AS tiny, timestamp_ntz'2024-01-02 03:04:05.678901' AS at")
    job = ts.ImportJob(
        source=df,
        target_dir=str(tmp_path / "plain"),
        layout="parquet",
        decimals={"price": (5, 2), "tiny": (20, 10)},
        decimals_as_text="plain",
        dates_as_millis=True,
    )
    ts.run_import(spark, job)
    assert rows(ts.parquet_scan(spark, job.target)) == [(1, "0.50", "0.0000000100", 1704164645678)]
    job = replace(job, decimals_as_text="java", dates_as_millis=False, target_dir=str(tmp_path / "java"))
    ts.run_import(spark, job)
    stored = rows(ts.parquet_scan(spark, job.target))
    assert stored == [(1, "0.50", "1.00E-8", datetime(2024, 1, 2, 3, 4, 5, 678901))]


def test_wide_numbers_merge_by_value(spark, tmp_path):
    nines = "9" * 40

    def source(*data):
        return spark.createDataFrame(data, "k int, amount string, ts string").withColumn("ts", F.col("ts").cast("date"))

    job = ts.ImportJob(
        source=source((1, nines, "2024-01-01")),
        target_dir=str(tmp_path / "t"),
        layout="parquet",
        decimals={"amount": (65, 30)},
        wide_as_text=True,
        incremental="lastmodified",
        check_column="ts",
        now=datetime(2024, 1, 2),
        merge_key="k",
        tie_break="amount",
    )
    ts.run_import(spark, job)
    more = source((2, "9.5", "2024-01-03"), (2, "10.5", "2024-01-03"), (2, "-11", "2024-01-03"), (1, "1" + nines, "2024-01-03"))
    ts.run_import(spark, replace(job, source=more, last_value="2024-01-02", now=datetime(2024, 1, 9)))
    assert rows(ts.parquet_scan(spark, job.target).select("k", "amount")) == [(1, "1" + nines), (2, "10.5")]
    with pytest.raises(ValueError, match="wider than"):
        ts.run_import(spark, replace(job, wide_as_text=False, target_dir=str(tmp_path / "u")))


def test_split_column_must_exist(spark, tmp_path):
    job = ts.ImportJob(source=spark.range(3), target_dir=str(tmp_path / "t"), layout="parquet", split_by="nope", num_splits=2)
    with pytest.raises(ValueError, match="no column named 'nope'"):
        ts.run_import(spark, job)


def test_text_appends_check_their_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    job = ts.ImportJob(source=spark.createDataFrame([(1, 2)], "a int, b int"), target_dir=path, append=True)
    ts.run_import(spark, job)
    ts.run_import(spark, replace(job, source=spark.createDataFrame([(3, 4)], "a int, b int")))
    for other in ("b int, a int", "a int", "a int, b long"):
        rows_of = spark.createDataFrame([(5, 6)[: other.count(" int") + other.count("long")]], other)
        with pytest.raises(ValueError, match="cannot append"):
            ts.run_import(spark, replace(job, source=rows_of))
    assert rows(ts.read_text(spark, path, "a int, b int")) == [(1, 2), (3, 4)]


def test_catalog_import(spark):
    job = ts.ImportJob(source=spark.range(3), catalog_table="t_imported", incremental="append", check_column="id")
    ts.run_import(spark, job)
    ts.run_import(spark, replace(job, source=spark.range(5), last_value=2))
    assert rows(spark.table("t_imported")) == [(i,) for i in range(5)]
    full = ts.ImportJob(source=spark.range(2), catalog_table="t_imported")
    with pytest.raises(ValueError, match="exists"):
        ts.run_import(spark, full)
    ts.run_import(spark, replace(full, overwrite=True, validate=True))
    assert spark.table("t_imported").count() == 2


def test_merge_paths(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    with pytest.raises(ValueError, match="no existing data"):
        ts.merge_paths(spark, old, new, "k")
    ts.write_parquet(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), old)
    ts.merge_paths(spark, old, new, "k")  # a batch without files: duplicates still collapse
    assert rows(ts.parquet_scan(spark, old)) == [(1, "b")]

    ts.write_parquet(spark.createDataFrame([(2, "c")], "k int, v string"), new)
    ts.merge_paths(spark, old, new, "k", target=str(tmp_path / "merged"), codec="gzip")
    assert rows(ts.parquet_scan(spark, str(tmp_path / "merged"))) == [(1, "b"), (2, "c")]
    assert rows(ts.parquet_scan(spark, old)) == [(1, "b")]

    # one file of the batch has another type for v: seen although it is not the first
    ts.write_parquet(spark.createDataFrame([(3, "d", 1)], "k int, v string, w int"), new, mode="append")
    ts.merge_paths(spark, old, new, "k")
    assert ts.parquet_scan(spark, old).columns == ["k", "v"]
    other = str(tmp_path / "other")
    ts.write_parquet(spark.createDataFrame([(3, 7)], "k int, v int"), other)
    with pytest.raises(ValueError, match="not compatible"):
        ts.merge_paths(spark, old, other, "k")
    assert not exists(spark, old + "__previous")
