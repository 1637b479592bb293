from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tablesync as ts

SCHEMA = "k int, v int, w string"


def brute_force(old, new):
    """One row per key, new before old, greatest (v, w) first; no nulls."""
    best = {}
    for is_new, rows in ((0, old), (1, new)):
        for k, v, w in rows:
            rank = (is_new, v, w)
            if k not in best or rank > best[k]:
                best[k] = rank
    return sorted((k, v, w) for k, (_, v, w) in best.items())


def frames(spark, old, new):
    return spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_merge_latest_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def some(n):
        # a third of all rows share one key
        return [(rng.choice([1, rng.randrange(40), rng.randrange(40)]), rng.randrange(5), rng.choice("abc")) for _ in range(n)]

    old, new = some(300), some(80)
    a, b = (df.repartition(5) for df in frames(spark, old, new))
    expected = brute_force(old, new)
    assert rows(ts.merge_latest(a, b, "k", "v")) == expected
    assert rows(ts.merge_latest(a, b, "k", "v", key_as_text=True)) == expected

    unique_old = brute_force(old, [])
    c, _ = frames(spark, unique_old, [])
    assert rows(ts.merge_latest(c, b, "k", "v", old_is_unique=True)) == expected


def test_merge_unique_is_merge_latest(spark):
    old, new = frames(spark, [(i, i, "o") for i in range(20)], [(i, i, "n") for i in range(10, 30)])
    merged = rows(ts.merge_unique(old, new, "k"))
    assert merged == rows(ts.merge_latest(old, new, "k"))
    assert rows(ts.merge_unique(spark.createDataFrame(merged, SCHEMA), new, "k")) == merged  # twice is once
    assert rows(ts.merge_unique(old, new.limit(0), "k")) == rows(old)  # nothing new


def test_own_columns_are_not_replaced(spark):
    old = spark.createDataFrame([(1, "mine")], "k int, is_new string")
    assert rows(ts.merge_latest(old, old, "k")) == [(1, "mine")]
    with pytest.raises(ValueError, match="already has"):
        ts.tag_origin(old, old)
    with pytest.raises(ValueError, match="already has"):
        ts.with_split_id(spark.range(3).withColumnRenamed("id", "Split_ID"), "split_id", 2)


def test_multi_column_key(spark):
    old, new = frames(spark, [(1, 1, "a"), (1, 1, "b"), (1, 2, "a")], [(1, 9, "a")])
    assert rows(ts.merge_latest(old, new, ["k", "w"])) == [(1, 1, "b"), (1, 9, "a")]


def test_text_keys(spark):
    old = spark.createDataFrame([(Decimal("1.0"), "o")], "k decimal(5,1), v string")
    new = spark.createDataFrame([("1", "n")], "k string, v string")
    as_text = old.withColumn("k", F.col("k").cast("string"))
    assert rows(ts.merge_latest(as_text, new, "k", key_as_text=True)) == [("1", "n"), ("1.0", "o")]
    assert rows(ts.merge_latest(old, new, "k")) == [(Decimal("1.0"), "n")]


@pytest.mark.parametrize("side", [0, 1])
@pytest.mark.parametrize("merge", [ts.merge_latest, ts.merge_unique])
def test_null_key_fails(spark, merge, side):
    data = [[(1, 1, "a")], [(2, 2, "b")]]
    data[side].append((None, 3, "c"))
    with pytest.raises(PySparkException, match="null key"):
        merge(*frames(spark, *data), "k").collect()


def test_null_key_guard_survives_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string").write.parquet(path)
    with pytest.raises(PySparkException, match="null key"):
        ts.merge_null_key(spark.read.parquet(path), "k").select("v").collect()
    with pytest.raises(PySparkException, match="null key"):
        ts.merge_null_key(spark.read.parquet(path), "k").count()


def test_to_old_schema(spark):
    old = spark.createDataFrame([], "Id bigint, a string, b decimal(5,2)")
    new = spark.createDataFrame([(1, "x", Decimal("1.5"))], "ID int, extra string, B decimal(5,2)")
    assert ts.merge_to_old_schema(new, old.schema).schema.simpleString() == old.schema.simpleString()
    assert ts.merge_to_old_schema(new, old.schema).collect() == [(1, None, Decimal("1.50"))]
    with pytest.raises(ValueError, match="case"):
        ts.merge_to_old_schema(spark.createDataFrame([(1, 2)], "a int, A int"), old.schema)


@pytest.mark.parametrize(
    ("source", "value", "target", "ok"),
    [
        ("int", 5, "bigint", True),
        ("bigint", 5, "int", True),
        ("bigint", 2**40, "int", False),
        ("decimal(10,3)", Decimal("1.230"), "decimal(10,2)", True),
        ("decimal(10,3)", Decimal("1.239"), "decimal(10,2)", False),
        ("double", 1.25, "decimal(10,2)", True),
        ("double", 1.239, "decimal(10,2)", False),
        ("float", 1.5, "double", True),
        ("int", 7, "string", True),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_fit_or_fail(spark, source, value, target, ok, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_fit(spark, source, value, target, ok)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def check_fit(spark, source, value, target, ok):
    new = spark.createDataFrame([(value,)], f"x {source}")
    fitted = ts.merge_to_old_schema(new, schema(spark, f"x {target}"))
    if ok:
        assert fitted.schema["x"].dataType.simpleString() == target
        assert str(fitted.first()[0]).rstrip("0") == str(value).rstrip("0")
    else:
        with pytest.raises(PySparkException):
            fitted.collect()


@pytest.mark.parametrize(("source", "target"), [("double", "int"), ("timestamp", "date"), ("double", "float"), ("bigint", "double")])
def test_lossy_types_are_refused(spark, source, target):
    with pytest.raises(ValueError, match="cast it first"):
        ts.merge_to_old_schema(spark.createDataFrame([], f"x {source}"), schema(spark, f"x {target}"))


def schema(spark, text):
    return spark.createDataFrame([], text).schema


@pytest.mark.parametrize(
    ("old", "new", "ok"),
    [
        ("a int, b string", "a int, b string", True),
        ("a int, b string", "B string, A int", True),
        ("a int, b string", "a int", True),
        ("a int", "a int, c decimal(5,2)", True),
        ("a int", "a bigint", False),
        ("a decimal(5,2)", "a decimal(6,2)", False),
        ("a decimal(5,2)", "a decimal(5,1)", False),
        ("a int, b string NOT NULL", "a int", False),
        ("a int", "a int, b string NOT NULL", False),
    ],
)
def test_schema_check(spark, old, new, ok):
    check = lambda: ts.merge_schema_check(schema(spark, old), schema(spark, new))
    if ok:
        check()
    else:
        with pytest.raises(ValueError, match="not compatible"):
            check()


def test_schema_check_edges(spark):
    a = schema(spark, "a int")
    ts.merge_schema_check(a, None)
    ts.merge_schema_check(a, a, strict=True)
    with pytest.raises(ValueError, match="differ"):
        ts.merge_schema_check(a, schema(spark, "a int, b int"), strict=True)
    with pytest.raises(ValueError, match="no schema"):
        ts.merge_schema_check(None, a)


def test_tag_origin_by_path(spark, tmp_path):
    base = str(tmp_path)
    for name, value in (("t", 1), ("t1", 2), ("other", 3)):
        spark.createDataFrame([(value,)], "x int").write.parquet(f"{base}/{name}")
    both = spark.read.parquet(f"{base}/t", f"{base}/t1")
    assert rows(ts.tag_origin_by_path(both, f"{base}/t1", f"{base}/t")) == [(1, True), (2, False)]
    assert rows(ts.tag_origin_by_path(both, f"file:{base}/t", f"file://{base}/t1/")) == [(1, False), (2, True)]
    stray = spark.read.parquet(f"{base}/t", f"{base}/other")
    with pytest.raises(PySparkException, match="neither old nor new"):
        ts.tag_origin_by_path(stray, f"{base}/t", f"{base}/t1").collect()


def test_append(spark):
    a, b = frames(spark, [(1, 1, "a")], [(1, 1, "a")])
    assert rows(ts.append_rows(a, b)) == [(1, 1, "a"), (1, 1, "a")]


@pytest.mark.parametrize("small", [False, True])
def test_upsert(spark, small):
    target = spark.createDataFrame(
        [(1, "a", 1), (2, "b", 2), (None, "x", 9), (None, "y", 8)], "k int, name string, v int"
    )
    batch = spark.createDataFrame([(2, 20), (2, 21), (3, 30), (3, 31), (1, None), (None, 7), (None, 7)], "K int, V int")
    out = ts.upsert_rows(target, batch, "k", "v", small_batch=small)
    assert out.columns == ["k", "name", "v"]
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in out.collect()), key=key)
    assert got == sorted(
        [
            (1, "a", None),
            (2, "b", 21),
            (3, None, 31),
            (None, "x", 9),
            (None, "y", 8),
            (None, None, 7),
            (None, None, 7),
        ],
        key=key,
    )
    with pytest.raises(ValueError, match="no columns"):
        ts.upsert_rows(target, batch.withColumn("z", F.lit(1)), "k")
    with pytest.raises(ValueError, match="lacks key"):
        ts.upsert_rows(target, batch.select("v"), "k")


def test_key_profile(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, None), (3, 1)], "a int, b int")
    assert ts.key_profile(df, "a").collect() == [(5, 3, 1, 1)]
    assert ts.key_profile(df, ["a", "b"]).collect() == [(5, 2, 2, 1)]
    assert ts.key_profile(df.limit(0), "a").collect() == [(0, 0, 0, 0)]
