from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.sinks.swap import MARK
from tablesync.storage import exists, touch


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def parquet_file(path):
    """The file with rows; partitions without any have files, too."""
    files = [pq.ParquetFile(f) for f in Path(path).glob("*.parquet")]
    return next(f for f in files if f.metadata.num_rows)


@pytest.fixture
def decimals(spark):
    data = [(Decimal("1.5"), Decimal("-2.25"), Decimal("3"), Decimal("4.1")), (None,) * 4]
    return spark.createDataFrame(data, "a decimal(5,2), b decimal(15,2), c decimal(18,0), d decimal(30,10)")


@pytest.mark.parametrize("codec", ["none", "snappy", "gzip", "lz4", "zstd"])
def test_parquet_codecs(decimals, tmp_path, spark, codec):
    path = str(tmp_path / "t")
    ts.write_parquet(decimals, path, codec)
    used = parquet_file(path).metadata.row_group(0).column(0).compression
    # Spark's LZ4 is the Hadoop framing, which this reader has no name for
    assert used == {"none": "UNCOMPRESSED", "lz4": "UNKNOWN"}.get(codec, codec.upper())
    assert rows(ts.parquet_scan(spark, path)) == rows(decimals)


def test_parquet_layouts(decimals, tmp_path, spark):
    before = spark.conf.get("spark.sql.parquet.writeLegacyFormat")
    for fixed, expected in ((True, ["FIXED_LEN_BYTE_ARRAY"] * 4), (False, ["INT32", "INT64", "INT64", "FIXED_LEN_BYTE_ARRAY"])):
        path = str(tmp_path / str(fixed))
        ts.write_parquet(decimals, path, fixed_layout=fixed)
        columns = [parquet_file(path).schema.column(i) for i in range(4)]
        assert [c.physical_type for c in columns] == expected
        if fixed:
            assert [c.length for c in columns] == [3, 7, 8, 13]
        assert rows(ts.parquet_scan(spark, path)) == rows(decimals)
    assert spark.conf.get("spark.sql.parquet.writeLegacyFormat") == before
    with pytest.raises(ValueError, match="codec"):
        ts.write_parquet(decimals, "unused", codec="zip")


def test_text_round_trip(spark, tmp_path):
    data = [
        (1, "plain", Decimal("0.0000000100")),
        (2, 'quote " and, comma', None),
        (3, "line\nbreak\r\nand \\ slash", Decimal("-1")),
        (4, "", None),
        (5, None, None),
        (6, "  spaces ", Decimal("2")),
    ]
    df = spark.createDataFrame(data, "id int, s string, d decimal(20,10)")
    for codec in (None, "gzip"):
        path = str(tmp_path / str(codec))
        ts.write_text(df, path, sep="\t", codec=codec)
        assert rows(ts.read_text(spark, path, df.schema, sep="\t")) == rows(df)
    assert "0.0000000100" in "".join(p.read_text() for p in (tmp_path / "None").glob("*.csv"))


def test_text_that_does_not_fit_fails(spark, tmp_path):
    spark.createDataFrame([("x",)], "s string").write.csv(str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)malformed"):
        ts.read_text(spark, str(tmp_path / "t"), "n int").collect()


def test_avro_says_what_is_missing(spark, tmp_path):
    try:
        ts.write_avro(spark.range(1), str(tmp_path / "a"))
    except RuntimeError as error:
        assert "spark-avro" in str(error)
        with pytest.raises(RuntimeError, match="spark-avro"):
            ts.read_avro(spark, str(tmp_path / "a"))
    else:
        assert ts.read_avro(spark, str(tmp_path / "a")).count() == 1


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="layout"):
        ts.write_files(spark.range(1), "unused", "sequence")
    with pytest.raises(ValueError, match="layout"):
        ts.read_files(spark, "unused", "sequence")
    with pytest.raises(ValueError, match="schema"):
        ts.read_files(spark, "unused", "text")


def test_overwrite_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    ts.write_overwrite(spark.range(5), path)
    ts.write_overwrite(ts.parquet_scan(spark, path).where("id > 2"), path)
    assert rows(ts.parquet_scan(spark, path)) == [(3,), (4,)]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_failed_write_keeps_the_old_data(spark, tmp_path):
    path = str(tmp_path / "t")
    ts.write_overwrite(spark.range(5), path)
    broken = ts.parquet_scan(spark, path).select(F.raise_error("broken").cast("int").alias("id"))
    with pytest.raises(Exception, match="broken"):
        ts.write_overwrite(broken, path)
    assert ts.parquet_scan(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_failed_swap_puts_the_old_data_back(spark, tmp_path):
    path = str(tmp_path / "t")
    ts.write_parquet(spark.range(5), path)
    with pytest.raises(Exception):
        ts.swap_into_place(spark, str(tmp_path / "missing"), path)
    assert ts.parquet_scan(spark, path).count() == 5


def test_recover_swap(spark, tmp_path):
    path, previous = str(tmp_path / "t"), str(tmp_path / "t__previous")
    ts.write_parquet(spark.range(5), previous)
    ts.recover_swap(spark, path)  # no swap made it
    assert exists(spark, previous) and not exists(spark, path)
    touch(spark, path + MARK)
    ts.recover_swap(spark, path)  # cut off between the renames
    assert ts.parquet_scan(spark, path).count() == 5 and not exists(spark, previous)
    ts.write_parquet(spark.range(3), previous)
    touch(spark, path + MARK)
    ts.recover_swap(spark, path)  # cut off before the old data was deleted
    assert ts.parquet_scan(spark, path).count() == 5 and not exists(spark, previous)
    ts.recover_swap(spark, path)


def test_tables(spark, tmp_path):
    ts.write_table(spark.range(3).withColumn("x", F.lit("a")), "t_plain", path=str(tmp_path / "t"))
    ts.append_table(spark.range(3, 5).select(F.lit("b").alias("X"), "id"), "t_plain")
    assert rows(spark.table("t_plain")) == [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (4, "b")]


def test_export_table(spark, tmp_path):
    ts.write_table(spark.createDataFrame([(1, "a")], "id int, s string"), "t_target", path=str(tmp_path / "t"))
    new = spark.createDataFrame([("b", 2)], "S string, ID int")
    ts.export_table(new, "t_target", "t_staging")
    assert rows(spark.table("t_target")) == [(1, "a"), (2, "b")]
    broken = new.withColumn("ID", F.raise_error("broken").cast("int"))
    with pytest.raises(Exception, match="broken"):
        ts.export_table(broken, "t_target", "t_staging2")
    assert rows(spark.table("t_target")) == [(1, "a"), (2, "b")]


def test_move_statement():
    dest = ts.JdbcSource("jdbc:mysql:x", table="t")
    assert ts.move_statement(dest, "s", ["a", "b"]) == "INSERT INTO `t` (`a`, `b`) SELECT `a`, `b` FROM `s`"
    assert ts.move_statement(dest, "s", ["a"], update=True).endswith("ON DUPLICATE KEY UPDATE `a` = VALUES(`a`)")
    with pytest.raises(ValueError, match="MySQL"):
        ts.move_statement(ts.JdbcSource("jdbc:other:x", table="t"), "s", ["a"], update=True)


def test_shared_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert ts.shared_dir(spark, "x").startswith(f"{base}/tablesync/x-")
    assert ts.shared_dir(spark, "x") != ts.shared_dir(spark, "x")
