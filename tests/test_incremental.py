from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.operators.incremental import STATE_SCHEMA, typed_value

MYSQL = ts.JdbcSource("jdbc:mysql:x", table="t")


def ids(df):
    return [r[0] for r in df.collect()]


def test_append_windows_partition_the_table(spark):
    df = spark.range(100)
    parts = [ids(ts.incremental_append(df, "id", a, b)) for a, b in ((None, 30), ("30", 31), (31, 99))]
    assert sorted(sum(parts, [])) == list(range(100)) and parts[1] == [31]


def test_lastmodified_window(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01' + make_dt_interval(id) AS ts, id FROM range(10)")
    out = ts.incremental_lastmodified(df, "TS", "2024-01-03", datetime(2024, 1, 6))
    assert [r["id"] for r in out.collect()] == [2, 3, 4]
    assert ts.incremental_lastmodified(df, "ts", None, "2024-01-02 00:00:00.000001").count() == 2
    with pytest.raises(ValueError, match="current time"):
        ts.incremental_lastmodified(df, "ts", None, None)


def test_lastmodified_by_date(spark):
    df = spark.sql("SELECT date_add(date'2024-01-01', int(id)) AS d, id FROM range(10)")

    def window(last, now):
        return [r["id"] for r in ts.incremental_lastmodified(df, "d", last, now).collect()]

    first, second = window(None, datetime(2024, 1, 3, 10)), window("2024-01-03 10:00:00", datetime(2024, 1, 5))
    assert (first, second) == ([0, 1, 2], [3])
    assert window("2024-01-03 10:00:00", datetime(2024, 1, 3, 11)) == []
    with pytest.raises(ValueError, match="no date"):
        ts.incremental_lastmodified(df, "id", 1, 2)


def test_null_bound(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, c bigint")
    assert ts.incremental_append(df, "c", None, None).count() == 2
    assert ts.incremental_append(df, "c", 5, None).count() == 0
    assert ts.max_check_value(df, "c").collect() == [(None,)]


def test_text_check_column(spark):
    df = spark.createDataFrame([("a",)], "c string")
    for call in (ts.max_check_value, ts.incremental_append, ts.incremental_null_bound):
        with pytest.raises(ValueError, match="character column"):
            call(df, "c")


def test_noop(spark):
    df = spark.createDataFrame([(Decimal("5.00"),)], "c decimal(5,2)")
    nothing = ts.incremental_noop(df, "c", "5", Decimal("5.00"))
    assert nothing.count() == 0 and nothing.columns == ["c"]
    assert "Scan" not in nothing._jdf.queryExecution().executedPlan().toString().replace("LocalTableScan", "")
    assert ts.incremental_noop(df, "c", 4, 5) is None
    assert ts.incremental_noop(df, "c", None, 5) is None


def test_typed_value(spark):
    kinds = {f.name: f.dataType for f in spark.createDataFrame(
        [], "i int, d decimal(5,2), f double, a date, t timestamp, n timestamp_ntz, b binary").schema}
    assert typed_value("7.0", kinds["i"]) == 7
    assert typed_value(1, kinds["d"]) == Decimal(1)
    assert typed_value("1.5", kinds["f"]) == 1.5
    assert typed_value("'2024-01-05 01:00:00'", kinds["a"]) == date(2024, 1, 5)
    assert typed_value("2024-01-05", kinds["n"]) == typed_value(datetime(2024, 1, 5), kinds["t"])
    assert typed_value(None, kinds["i"]) is None
    with pytest.raises(ValueError):
        typed_value("x", kinds["b"])


def test_bounds_sql():
    assert ts.bounds_sql(MYSQL, "k", "append", 5, 9) == "`k` > 5 AND `k` <= 9"
    assert ts.bounds_sql(MYSQL, "k", "append", None, None) == "`k` IS NULL"
    when = datetime(2024, 1, 5)
    assert ts.bounds_sql(MYSQL, "k", "lastmodified", "2024-01-01", when) == (
        "`k` >= '2024-01-01' AND `k` < '2024-01-05 00:00:00'"
    )


def test_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert ts.load_state(spark, path, "orders") is None
    for value in (1, 2, 3):
        ts.save_state(spark, path, "orders", "append", "id", value)
    ts.save_state(spark, path, "events", "lastmodified", "ts", datetime(2024, 1, 1))
    assert ts.load_state(spark, path, "orders")["last_value"] == "3"
    assert ts.load_state(spark, path, "events")["last_value"] == "2024-01-01 00:00:00"
    assert ts.load_state(spark, path, "other") is None
    log = ts.state_log(spark, path)
    assert log.count() == 4
    latest = {r["job"]: r["last_value"] for r in ts.latest_state(log).collect()}
    assert latest == {"orders": "3", "events": "2024-01-01 00:00:00"}
    assert log.where("job = 'orders'").select(F.countDistinct("run_at")).first()[0] == 3


def test_compact_state(spark, tmp_path):
    path = str(tmp_path / "state")
    for value in (1, 2):
        ts.save_state(spark, path, "orders", "append", "id", value)
    ts.save_state(spark, path, "events", "append", "id", 7)
    before = [ts.load_state(spark, path, job) for job in ("orders", "events")]
    ts.compact_state(spark, path)
    assert ts.state_log(spark, path).count() == 2
    assert [ts.load_state(spark, path, job) for job in ("orders", "events")] == before
    ts.save_state(spark, path, "orders", "append", "id", 3)
    assert ts.load_state(spark, path, "orders")["last_value"] == "3"


def test_two_savers(spark, tmp_path):
    """Both start from the same entry: one wins, the other raises and leaves the winner's state."""
    path = str(tmp_path / "state")
    first = ts.save_state(spark, path, "a/b c", "append", "id", 1, expected=0)
    one, two = (ts.load_state(spark, path, "a/b c")["version"] for _ in range(2))
    assert first == one == two == 1
    assert ts.save_state(spark, path, "a/b c", "append", "id", 2, expected=one) == 2
    with pytest.raises(ts.StateConflict):
        ts.save_state(spark, path, "a/b c", "append", "id", 3, expected=two)
    assert ts.load_state(spark, path, "a/b c")["last_value"] == "2"
    with pytest.raises(ts.StateConflict):
        ts.save_state(spark, path, "a/b c", "append", "id", 3, expected=0)


def test_savers_in_threads(spark, tmp_path):
    path = str(tmp_path / "state")
    ts.save_state(spark, path, "j", "append", "id", 0)

    def save(i):
        try:
            return ts.save_state(spark, path, "j", "append", "id", i, expected=1) and i
        except ts.StateConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(save, range(1, 9)) if i is not None]
    assert len(won) == 1 and ts.load_state(spark, path, "j")["last_value"] == str(won[0])


def test_an_entry_that_was_cut_off_is_not_read(spark, tmp_path):
    path = str(tmp_path / "state")
    ts.save_state(spark, path, "j", "append", "id", 1)
    (tmp_path / "state" / "job=j" / "000000000002.json").write_text('{"job": "j", "last')
    state = ts.load_state(spark, path, "j")
    assert (state["last_value"], state["version"]) == ("1", 1)
    assert ts.save_state(spark, path, "j", "append", "id", 3, expected=1) == 3
    assert ts.load_state(spark, path, "j")["last_value"] == "3"


def test_latest_state_keeps_one_entry_whole(spark):
    log = spark.createDataFrame(
        [
            ("a", "append", "id", "9", datetime(2024, 1, 1)),
            ("a", "lastmodified", "ts", "1", datetime(2024, 1, 2)),
            ("b", "append", "id", None, datetime(2024, 1, 1)),
        ],
        STATE_SCHEMA,
    )
    latest = {r["job"]: r for r in ts.latest_state(log).collect()}
    assert latest["a"][1:4] == ("lastmodified", "ts", "1")
    assert latest["b"]["last_value"] is None
