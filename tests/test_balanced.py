"""Balanced ranges and equal-width ranges of every type, against plain counting."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.sources import balanced as b

SOURCE = ts.JdbcSource("jdbc:mysql:x", table="t")


def plan(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("n", [1, 2, 7, 16])
def test_no_range_over_twice_the_mean(spark, n):
    """Skewed values and two heavy ones: only a single value may hold more."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, 100_000).otherwise(F.col("id") * F.col("id")).alias("v")
    )
    values = sorted(r[0] for r in df.collect())
    found = plan(ts.balanced_split_plan(df, "v", n, accuracy=100_000))
    assert sum(r[3] for r in found) == len(values)
    assert [r[0] for r in found] == list(range(len(found)))
    before = None
    for _, low, high, rows in found:
        assert rows == sum(low <= v <= high for v in values)
        assert low == high or rows <= 2 * len(values) / n
        assert before is None or before < low
        before = high
    assert len(found) <= 2 * n


@pytest.mark.parametrize(("kind", "accuracy"), [("bigint", 2), ("bigint", 100_000), ("double", 50), ("decimal(20,2)", 50), ("date", 50)])
def test_cuts_are_exact_however_coarse_the_sketch(spark, kind, accuracy):
    """One value with an eighth of the rows, repeats and gaps; over more rows than the sketch keeps."""
    number = F.when(F.col("id") % 8 == 0, 77).otherwise(F.pmod(F.hash("id"), F.lit(9000)))
    value = F.date_add(F.lit("2000-01-01").cast("date"), number.cast("int")) if kind == "date" else number.cast(kind)
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 100 != 1, value).alias("v"))
    values = sorted(r[0] for r in df.collect() if r[0] is not None)
    for n in (2, 7):
        exact = sorted({values[-(-i * len(values) // n) - 1] for i in range(1, n)})
        assert b._cuts(df, "v", n, accuracy) == exact


def test_balanced_odd_columns(spark):
    df = spark.createDataFrame([(None,), (1.5,), (float("nan"),), (2.5,), (float("inf"),), (None,)], "v double")
    found = plan(ts.balanced_split_plan(df, "v", 2))
    assert found[0] == (0, None, None, 3)  # without a value, or none that has a place
    assert sum(r[3] for r in found) == 6
    assert plan(ts.balanced_split_plan(df.limit(0), "v", 4)) == []
    nulls = spark.createDataFrame([(None,), (None,)], "v int")
    assert plan(ts.balanced_split_plan(nulls, "v", 4)) == [(0, None, None, 2)]
    one = spark.createDataFrame([(5,)] * 10, "v int")
    assert plan(ts.balanced_split_plan(one, "v", 4)) == [(0, 5, 5, 10)]
    days = spark.sql("SELECT date_add(DATE'2024-01-01', CAST(id AS INT)) AS d FROM range(100)")
    found = plan(ts.balanced_split_plan(days, "d", 4, accuracy=1000))
    assert [r[3] for r in found] == [25, 25, 25, 25] and found[0][1] == date(2024, 1, 1)
    with pytest.raises(ValueError, match="no quantiles"):
        ts.balanced_split_plan(spark.createDataFrame([("x",)], "v string"), "v", 2)
    with pytest.raises(ValueError, match="at least 1"):
        ts.balanced_split_plan(days, "d", 0)


def test_database_predicates():
    """Each row satisfies exactly one condition, in the database's own order."""
    assert ts.balanced_predicates(SOURCE, "k", []) == ["(`k` IS NULL OR `k` IS NOT NULL)"]
    assert ts.balanced_predicates(SOURCE, "k", ["b", "o'x"]) == [
        "(`k` < 'b' OR `k` IS NULL)",
        "`k` >= 'b' AND `k` < 'o''x'",
        "`k` >= 'o''x'",
    ]
    assert b.distinct_bounds([1, 3, 3, 3, 9]) == [3, 9]
    assert b.distinct_bounds([1, 1, 1]) == [] and b.distinct_bounds([]) == []
    text = b.bounds_by_rank(SOURCE, "k", 4, where="a > 1")
    assert "NTILE(4) OVER (ORDER BY `k`)" in text and "WHERE (a > 1)" in text


@pytest.mark.parametrize("values", [["a", "b", "b", "c", None, "d", "e", "é", "z"], list(range(40)) + [None], [3] * 20 + [4, 5]])
def test_database_ranges_by_rank(spark, values):
    """The text of the ranking query and of the conditions, run by Spark SQL on a view: every row in one range."""
    kind = "string" if isinstance(values[0], str) else "int"
    spark.createDataFrame([(v,) for v in values], f"k {kind}").createOrReplaceTempView("t")
    found = spark.sql(b.bounds_by_rank(SOURCE, "k", 4)).collect()
    bounds = b.distinct_bounds([r["low"] for r in found])
    if kind == "int":
        bounds = [int(x) for x in bounds]
    parts = [spark.sql(f"SELECT * FROM t WHERE {p}").collect() for p in ts.balanced_predicates(SOURCE, "k", bounds)]
    spark.catalog.dropTempView("t")
    assert sorted((r[0] for p in parts for r in p), key=repr) == sorted(values, key=repr)
    distinct = len(set(values) - {None})
    assert max(map(len, parts)) <= 2 * -(-len(values) // 4) or distinct < 4


CASES = {
    "date": ([date(2024, 1, 1), date(2024, 3, 1), date(2024, 1, 15), None, date(1969, 12, 1)], 5),
    "timestamp_ntz": ([datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 9), datetime(1960, 5, 5, 1, 2, 3, 4), None], 3),
    "timestamp": ([datetime(2024, 1, 1), datetime(2024, 6, 1, 12)], 4),
    "decimal(38,10)": ([Decimal("-1e27"), Decimal("1e27"), Decimal("0.0000000001"), None], 7),
    "decimal(5,2)": ([Decimal("0.01"), Decimal("0.02"), Decimal("0.03")], 10),
    "double": ([0.1, 1e300, -1e300, float("nan"), float("inf"), None], 4),
    "bigint": ([-(2**63), 2**63 - 1, 0, 5], 3),
    "string": (["prefix-a", "prefix-zebra", "prefix-", "prefix-müller", "prefix-😀", None, "prefix-aa"], 5),
}


@pytest.mark.parametrize("kind", CASES)
def test_typed_ranges(spark, kind):
    values, n = CASES[kind]
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    found = plan(ts.typed_split_plan(df, "v", n))
    assert len(found) <= n and sum(r[3] for r in found) == len(values)
    lows = [r[1] for r in found]
    assert lows == sorted(set(lows))
    rows = ts.with_typed_split(df, "v", n).collect()
    for r in rows:
        placeless = r["v"] is None or r["v"] != r["v"] or r["v"] in (float("inf"), float("-inf"))
        place = 0 if placeless else max(i for i, low in enumerate(lows) if low <= r["v"])
        assert r["split_id"] == place
    for i, _, high, count in found:
        assert count == sum(r["split_id"] == i for r in rows)
        assert kind in ("string", "double") or all(r["v"] is None or r["v"] <= high for r in rows if r["split_id"] == i)


def test_typed_odd_columns(spark):
    for kind in CASES:
        empty = spark.createDataFrame([], f"v {kind}")
        assert plan(ts.typed_split_plan(empty, "v", 3)) == []
        assert ts.with_typed_split(spark.createDataFrame([(None,)], f"v {kind}"), "v", 3).collect()[0]["split_id"] == 0
    one = spark.createDataFrame([("same",)] * 3, "v string")
    assert plan(ts.typed_split_plan(one, "v", 4)) == [(0, "same", "same", 3)]
    with pytest.raises(ValueError, match="cannot be split"):
        ts.typed_split_plan(spark.createDataFrame([(True,)], "v boolean"), "v", 2)
    with pytest.raises(ValueError, match="at least 1"):
        ts.typed_split_plan(one, "v", 0)
    with pytest.raises(ValueError, match="already has"):
        ts.with_typed_split(one.withColumn("split_id", F.lit(1)), "v", 2)


texts = st.text(st.characters(blacklist_categories=["Cs"]), max_size=9)


@given(texts, texts)
@settings(max_examples=300, deadline=None)
def test_numbers_of_texts_keep_their_order(x, y):
    if x[: b.TEXT_CHARS] < y[: b.TEXT_CHARS]:
        assert b.text_number(x) < b.text_number(y)
    assert b.number_text(b.text_number(x)) == x[: b.TEXT_CHARS]
    assert b.number_text(b.text_number(x), "p") == "p" + x[: b.TEXT_CHARS]


@given(st.lists(texts, min_size=1, max_size=20), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_bounds_of_texts_ascend(values, n):
    lo, hi = min(values), max(values)
    from pyspark.sql.types import StringType

    cuts = b.typed_bounds(lo, hi, StringType(), n)
    assert cuts == sorted(set(cuts)) and len(cuts) < n
    assert all(lo < c <= hi for c in cuts)
    assert all(c.encode() for c in cuts)  # no half of a surrogate pair
