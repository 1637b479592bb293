from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tablesync as ts


@pytest.mark.parametrize(
    ("name", "safe"),
    [
        ("1abc", "AVRO_1abc"),
        ("a  b", "a_b"),
        ("-x", "_x"),
        ("a-_b", "a__b"),
        ("9 9", "AVRO_9_9"),
        ("ü$%1", "ü_1"),
        ("plain_1", "plain_1"),
        ("__", "__"),
        ("a$ %b", "a_b"),
        ("日本", "日本"),
    ],
)
def test_safe_name(name, safe):
    assert ts.safe_name(name) == safe


def test_sanitize(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `1c` int")
    out = ts.sanitize_columns(df)
    assert out.columns == ["a_b", "AVRO_1c"]
    assert out.schema["a_b"].metadata["columnName"] == "a.b"
    assert out.collect() == [(1, 2)]
    with pytest.raises(ValueError, match="collide"):
        ts.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    with pytest.raises(ValueError, match="empty"):
        ts.safe_name("")


def test_select(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Id int, name int, `x.y` int")
    assert ts.select_columns(df, ' "ID" , name').columns == ["ID", "name"]
    assert ts.select_columns(df, ["x.y"]).collect() == [(3,)]
    for bad in ("nope", "", "id,,name"):
        with pytest.raises(ValueError):
            ts.select_columns(df, bad)


def test_where_keeps_or_inside(spark):
    df = spark.range(10)
    kept = ts.where_filter(df, "id = 1 OR id = 8", F.col("id") < 5)
    assert [r[0] for r in kept.collect()] == [1]
    assert ts.where_filter(df, None) is df


def test_overrides(spark):
    df = spark.createDataFrame([(1, "7", Decimal("1.50"))], "a bigint, b string, c decimal(5,2)")
    out = ts.cast_overrides(df, {"A": "integer", "b": "LONG", "c": "STRING"})
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "bigint", "decimal(5,2)"]
    assert out.collect() == [(1, 7, Decimal("1.50"))]
    with pytest.raises(ValueError, match="cannot store"):
        ts.cast_overrides(df, {"a": "DECIMAL"})


def test_year(spark):
    df = spark.createDataFrame([(date(1999, 5, 1), 2001)], "a date, b int")
    out = ts.year_as_smallint(df, ["a", "B"])
    assert [f.dataType.simpleString() for f in out.schema] == ["smallint", "smallint"]
    assert out.collect() == [(1999, 2001)]


def test_millis(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'1969-12-31 23:59:59.999500' AS a, date'1970-01-02' AS b, "
        "timestamp_ntz'2024-01-05 10:00:00.123999' AS c"
    )
    millis = ts.datetime_to_millis(df)
    assert millis.collect() == [(-1, 86_400_000, 1704448800123)]
    back = ts.millis_to_datetime(
        millis.select("b", "c", F.col("c").alias("t"), F.col("a").alias("n")),
        {"b": "date", "c": "timestamp_ntz", "t": "time", "n": "time"},
    )
    assert back.collect() == [(date(1970, 1, 2), datetime(2024, 1, 5, 10, 0, 0, 123000), 36_000_123, 86_399_999)]
    with pytest.raises(ValueError):
        ts.datetime_to_millis(spark.range(1), ["id"])
    with pytest.raises(ValueError):
        ts.millis_to_datetime(millis, {"a": "year"})


def test_string_to_datetime(spark):
    df = spark.createDataFrame([("2024-01-05", "2024-01-05 01:02:03.000004", None)], "a string, b string, c string")
    out = ts.string_to_datetime(df, {"a": "date", "b": "timestamp_ntz", "c": "date"})
    assert out.collect() == [(date(2024, 1, 5), datetime(2024, 1, 5, 1, 2, 3, 4), None)]
    with pytest.raises(Exception, match="not a date"):
        ts.string_to_datetime(df.select(F.lit("soon").alias("a")), {"a": "date"}).collect()


def test_lob(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "üü"), (3, None), (4, "abcd")], "id int, x string")
    main, side = ts.lob_inline(df, "id", "x", 3, "t")
    assert main.collect() == [(1, "ab"), (2, "lob:t/x/2"), (3, None), (4, "lob:t/x/4")]
    assert side.collect() == [("lob:t/x/2", "üü"), ("lob:t/x/4", "abcd")]
    binary, _ = ts.lob_inline(df.withColumn("x", F.col("x").cast("binary")), "id", "x", 3, "t")
    assert binary.collect()[1][1] == bytearray(b"lob:t/x/2")
    with pytest.raises(ValueError):
        ts.lob_inline(df, "x", "id", 3)
    no_key = df.withColumn("id", F.lit(None).cast("int"))
    for part in ts.lob_inline(no_key, "id", "x", 3, "t"):
        with pytest.raises(Exception, match="needs a value of id"):
            part.collect()


def test_drop_delims(spark):
    df = spark.createDataFrame([("a\nb\r\x01c", 1)], "x string, n int")
    assert ts.drop_delims(df).collect() == [("abc", 1)]
    assert ts.drop_delims(df, replacement=" ").collect() == [("a b  c", 1)]
    assert ts.drop_delims(df, ["x"], chars="a]^-b", replacement="$1\\").collect() == [("$1\\\n$1\\\r\x01c", 1)]
