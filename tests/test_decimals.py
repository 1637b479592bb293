from __future__ import annotations

import re
from decimal import Context, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.functions.decimals import fixed_length

# Bytes that hold 1 to 18 digits.
LENGTHS = [1, 1, 2, 2, 3, 3, 4, 4, 4, 5, 5, 6, 6, 6, 7, 7, 8, 8]


def decimals(spark, kind, values):
    return spark.createDataFrame([(None if v is None else Decimal(v),) for v in values], f"x {kind}")


def values(df):
    return [row[0] for row in df.collect()]


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(spark, request):
    """Exactness must not depend on the session's mode."""
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_fixed_length():
    assert [fixed_length(p) for p in range(1, 19)] == LENGTHS
    assert fixed_length(38) == 16


@pytest.mark.parametrize("kind", [(0, 0), (None, 2), (5, 6), (5, None), (39, 2)])
def test_impossible_types(spark, kind):
    with pytest.raises(ValueError):
        ts.decimal_typed(spark.range(1), {"id": kind})


def test_wide_type_as_string(spark):
    df = spark.createDataFrame([("1" * 50,)], "x string")
    assert values(ts.decimal_typed(df, {"x": (65, 30)}, as_string=True)) == ["1" * 50]


def test_typed_from_doubles_is_exact(spark, ansi):
    df = spark.createDataFrame([(0.1,), (-999.85,), (None,), (0.0,)], "x double")
    typed = ts.decimal_typed(df, {"X": (12, 2)})
    assert typed.schema["x"].dataType.simpleString() == "decimal(12,2)"
    assert values(typed) == [Decimal("0.10"), Decimal("-999.85"), None, Decimal("0.00")]
    assert typed.schema["x"].nullable


@settings(max_examples=15, deadline=None)
@given(st.data())
def test_every_decimal_of_15_digits_survives_a_double(spark, data):
    precision = data.draw(st.integers(1, 15))
    scale = data.draw(st.integers(0, precision))
    top = 10**precision - 1
    units = data.draw(st.lists(st.integers(-top, top), min_size=1, max_size=200)) + [top, -top, 0, top - 1]
    expected = [Decimal(u).scaleb(-scale) for u in units]
    df = spark.createDataFrame([(float(d),) for d in expected], "x double")
    assert values(ts.decimal_typed(df, {"x": (precision, scale)})) == expected


@pytest.mark.parametrize(
    ("kind", "value", "target"),
    [
        ("double", 1.239, (12, 2)),
        ("double", 1e12, (12, 2)),
        ("double", 1.239, (18, 2)),
        ("double", 1e13, (12, 0)),
        ("double", 0.1 + 0.2, (15, 15)),
        ("double", float("nan"), (12, 2)),
        ("double", float("inf"), (12, 2)),
        ("double", float("-inf"), (18, 2)),
        ("float", 1.239, (12, 2)),
        ("string", "1.239", (12, 2)),
        ("string", "0." + "0" * 30 + "1", (12, 2)),
        ("string", "1E-40", (12, 2)),
        ("string", "abc", (12, 2)),
        ("decimal(10,3)", Decimal("1.239"), (12, 2)),
        ("bigint", 10**11, (12, 2)),
    ],
)
def test_typed_refuses_to_lose_digits(spark, ansi, kind, value, target):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    with pytest.raises(PySparkException):
        ts.decimal_typed(df, {"x": target}).collect()


def test_rescale(spark, ansi):
    df = decimals(spark, "decimal(10,3)", ["1.230", "-5", None])
    assert values(ts.decimal_rescale_exact(df, {"x": (9, 2)})) == [Decimal("1.23"), Decimal("-5.00"), None]
    assert values(ts.decimal_rescale_exact(df, {"x": (20, 10)})) == [Decimal("1.23"), Decimal("-5"), None]
    lossy = decimals(spark, "decimal(10,3)", ["1.239"])
    with pytest.raises(PySparkException, match="not exact"):
        ts.decimal_rescale_exact(lossy, {"x": (9, 2)}).collect()
    with pytest.raises(ValueError, match="not a decimal"):
        ts.decimal_rescale_exact(spark.range(1), {"id": (9, 2)})


def test_strings(spark, ansi):
    vectors = {
        "0.0000000100": "1.00E-8",
        "-0.0000000123": "-1.23E-8",
        "0.0000000000": "0E-10",
        "0.0000010000": "0.0000010000",
        "0.0000009999": "9.999E-7",
        "0.0000000001": "1E-10",
        "-123.4500000000": "-123.4500000000",
    }
    df = decimals(spark, "decimal(20,10)", [*vectors, None])
    assert values(ts.decimal_to_plain_string(df)) == [*vectors, None]
    assert values(ts.decimal_to_java_string(df)) == [*vectors.values(), None]
    assert values(ts.decimal_to_java_string(decimals(spark, "decimal(12,2)", ["0", "0.01"]))) == ["0.00", "0.01"]


def test_java_string_agrees_with_legacy_cast(spark):
    df = decimals(spark, "decimal(20,10)", ["0.0000000100", "-0.0000000123", "0", "0.000001", "-7", "0.0000009"])
    mine = values(ts.decimal_to_java_string(df))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert mine == values(df.select(F.col("x").cast("string")))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_fixed_bytes(spark, ansi):
    vectors = {
        "0.01": "000000000001",
        "-0.01": "FFFFFFFFFFFF",
        "123.45": "000000003039",
        "-9999999999.99": "FF172B5AF001",
        "9999999999.99": "00E8D4A50FFF",
        "0.00": "000000000000",
    }
    fixed = ts.decimal_to_fixed(decimals(spark, "decimal(12,2)", [*vectors, None]))
    assert values(fixed.select(F.hex("x"))) == [*vectors.values(), None]
    back = ts.fixed_to_decimal(fixed, {"x": (12, 2)})
    assert values(back) == [*(Decimal(v) for v in vectors), None]


@settings(max_examples=15, deadline=None)
@given(st.data())
def test_fixed_bytes_round_trip(spark, data):
    precision = data.draw(st.integers(1, 18))
    scale = data.draw(st.integers(0, precision))
    top = 10**precision - 1
    unscaled = data.draw(st.lists(st.integers(-top, top), min_size=1, max_size=20)) + [top, -top, 0]
    numbers = [Decimal(u).scaleb(-scale) for u in unscaled]
    fixed = ts.decimal_to_fixed(decimals(spark, f"decimal({precision},{scale})", numbers))
    length = fixed_length(precision)
    expected = [bytearray(u.to_bytes(length, "big", signed=True)) for u in unscaled]
    assert values(fixed) == expected
    assert values(ts.fixed_to_decimal(fixed, {"x": (precision, scale)})) == numbers


def test_fixed_bytes_limits(spark):
    wide = decimals(spark, "decimal(19,2)", ["1"])
    assert values(ts.decimal_to_fixed(wide)) == [(100).to_bytes(16)]
    with pytest.raises(ValueError, match="not binary"):
        ts.fixed_to_decimal(wide, {"x": (12, 2)})


WIDE = [0, 1, -1, 255, -256, 2**31, -(2**31), 2**32, 2**63 - 1, -(2**63), 2**64, -(2**64), 2**96 + 5, -(2**96) - 5]
WIDE += [10**37, -(10**37), 10**38 - 1, -(10**38) + 1, 12345678901234567890123456789012345678]


@pytest.mark.parametrize("scale", [0, 1, 10, 38])
def test_wide_bytes(spark, ansi, scale):
    """Both signs, every length from the shortest to one more than 16, against Python's own reading."""
    data = []
    for i, number in enumerate(WIDE):
        least = max(1, ((number if number >= 0 else number + 1).bit_length() + 8) // 8)
        lengths = {least, min(least + 1, 17), 9, 16, 17} - set(range(least))
        data += [(i, n, bytearray(number.to_bytes(n, signed=True))) for n in sorted(lengths)]
    df = spark.createDataFrame(data, "i int, n int, x binary").coalesce(1)
    found = ts.fixed_to_decimal(df, {"x": (38, scale)})
    assert found.schema["x"].dataType.simpleString() == f"decimal(38,{scale})"
    back = ts.decimal_to_fixed(found.withColumnRenamed("x", "y")).withColumnRenamed("y", "b")
    for (i, n, _), r, again in zip(data, found.collect(), back.collect(), strict=True):
        assert r["x"] == Decimal(WIDE[i]).scaleb(-scale, Context(prec=60)), (i, n)
        assert bytes(again["b"]) == WIDE[i].to_bytes(16, signed=True), (i, n)


@pytest.mark.parametrize(
    ("number", "length", "precision"),
    [(10**38, 16, 38), (-(10**38), 16, 38), (2**127 - 1, 16, 38), (-(2**127), 16, 38), (10**20, 9, 20), (-(10**20), 9, 20), (2**130, 17, 38), (-(2**130), 18, 38)],
)
def test_wide_bytes_that_do_not_fit(spark, ansi, number, length, precision):
    df = spark.createDataFrame([(bytearray(number.to_bytes(length, signed=True)),)], "x binary")
    with pytest.raises(Exception, match="do not fit"):
        ts.fixed_to_decimal(df, {"x": (precision, 2)}).collect()
    with pytest.raises(Exception, match="do not fit"):
        ts.fixed_to_decimal(spark.createDataFrame([(bytearray(b""),)], "x binary"), {"x": (30, 2)}).collect()
    none = spark.createDataFrame([(None,)], "x binary")
    assert values(ts.fixed_to_decimal(none, {"x": (30, 2)})) == [None]


@pytest.mark.parametrize("number", [2**127, 2**128 - 1, -(2**127) - 1, -(2**128), 10**38, -(10**38)])
def test_surplus_bytes_are_not_dropped(spark, ansi, number):
    """The last 16 bytes alone would be a number of the other sign, or one that fits."""
    df = spark.createDataFrame([(bytearray(number.to_bytes(20, signed=True)),)], "x binary")
    for scale in (0, 10):
        with pytest.raises(Exception, match="do not fit"):
            ts.fixed_to_decimal(df, {"x": (38, scale)}).collect()


def test_wide_bytes_compile(spark, capsys):
    """Java leaves methods of over 8,000 bytes of code uncompiled: each row took 150 microseconds more."""
    numbers = spark.range(10).select(F.col("id").cast("decimal(38,0)").alias("x"), F.col("id").cast("decimal(38,0)").alias("y"))
    stored = ts.decimal_to_fixed(numbers)
    for df in (stored, ts.fixed_to_decimal(stored, {"x": (38, 10), "y": (38, 0)})):
        df.explain("codegen")
        sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000


def test_order_of_numbers_in_text(spark):
    texts = ["-1" + "0" * 50, "-99.5", "-99.45", "-99.4", "-10", "-9.5", "-1", "-0.001", "0", "0.0009", "0.001", "1", "1.05", "1.5", "9.5"]
    texts += ["10.5", "99999999999999999999999999999999999999.1", "1" + "0" * 60]
    same = {"9.5": ["+9.50", "009.5", " 9.5000 "], "0": ["-0", "-0.00", "000", ".0", "0."], "-1": ["-1.0", "-01"], "0.001": [".00100"]}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for fn, want in ((ts.max_wide_value(df, "t"), texts[-1]), (ts.max_wide_value(df, "t", "t LIKE '-%'"), "-0.001")):
        assert fn.first()[0] == want
    keys = [r[0] for r in df.select(ts.number_order(F.col("t"))).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    for text, others in same.items():
        found = spark.createDataFrame([(t,) for t in [text, *others]], "t string").select(ts.number_order(F.col("t"))).distinct()
        assert found.count() == 1, text
    assert spark.createDataFrame([(None,)], "t string").select(ts.number_order(F.col("t"))).first()[0] is None
    for bad in ("", " ", ".", "-", "1e5", "1,5", "abc"):
        with pytest.raises(Exception, match="plain number"):
            spark.createDataFrame([(bad,)], "t string").select(ts.number_order(F.col("t"))).collect()
    assert ts.max_wide_value(df.limit(0), "t").first()[0] is None
    with pytest.raises(ValueError, match="not text"):
        ts.max_wide_value(spark.range(1), "id")


def test_order_of_long_numbers_in_text(spark, capsys):
    """One pattern per row, and none that goes over the digits once per digit."""
    texts = ["0." + "0" * 50_000 + "1", "0." + "0" * 49_999 + "1", "\t00" + "1" + "0" * 50_000 + ".0\n", "1" + "0" * 49_999 + "1\u2028"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    keyed = df.select("i", ts.number_order(F.col("t")).alias("key"))
    assert [r["i"] for r in sorted(keyed.collect(), key=lambda r: r["key"])] == [0, 1, 2, 3]
    keyed.explain()
    plan = capsys.readouterr().out
    assert "regexp_extract" not in plan and plan.count("RLIKE") == 1


def test_string_to_decimal(spark, ansi):
    df = spark.createDataFrame([("1.50",), ("-2",), ("+3.100000",), ("1.5E1",), (None,), (" 7 ",)], "x string")
    expected = [Decimal("1.50"), Decimal("-2"), Decimal("3.1"), Decimal("15"), None, Decimal("7")]
    assert values(ts.string_to_decimal(df, {"x": (12, 2)})) == expected
    with pytest.raises(ValueError, match="not text"):
        ts.string_to_decimal(spark.range(1), {"id": (12, 2)})


def test_layout(spark):
    df = spark.createDataFrame(
        [(Decimal("-12.50"), None, Decimal("0")), (Decimal("1"), None, None)],
        "a decimal(12,2), b decimal(5,0), c decimal(30,10)",
    )
    rows = {r["column_name"]: r for r in ts.decimal_layout(df).collect()}
    assert rows["a"][1:] == (12, 2, "FIXED", 6, 2, 0, 4)
    assert rows["b"][1:] == (5, 0, "FIXED", 3, 2, 2, None)
    assert rows["c"][1:] == (30, 10, "BYTES", None, 2, 1, 1)
    with pytest.raises(ValueError):
        ts.decimal_layout(spark.range(1))
