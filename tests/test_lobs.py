"""Rows and large values in one job, and counts taken while writing."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.sinks import journal, lobs
from tablesync.storage import data_files


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def docs(spark):
    data = [(1, "short", b"\x01" * 3, "a"), (2, "l" * 50, None, None), (3, None, b"\x02" * 99, "c"), (4, "ü" * 6, b"", "d"), (5, "x" * 99, b"y" * 99, "e")]
    return spark.createDataFrame(data, "id int, text string, raw binary, other string")


def job_of(spark, path, **more):
    return ts.ImportJob(
        source=docs(spark), name="docs", target_dir=str(path), layout="parquet", lobs={"text": 10, "raw": 20}, lob_key="id", **more
    )


def test_import_with_large_values(spark, tmp_path):
    path = str(tmp_path / "t")
    ts.run_import(spark, job_of(spark, path))
    stored = ts.parquet_scan(spark, path)
    assert stored.columns == docs(spark).columns
    assert rows(stored.select("id", "text", "raw")) == [
        (1, "short", b"\x01" * 3),
        (2, "lob:docs/text/2", None),
        (3, None, b"lob:docs/raw/3"),
        (4, "lob:docs/text/4", b""),
        (5, "lob:docs/text/5", b"lob:docs/raw/5"),
    ]
    text = ts.read_lobs(spark, path, "id", "text", "docs")
    assert rows(text) == [("lob:docs/text/2", "l" * 50), ("lob:docs/text/4", "ü" * 6), ("lob:docs/text/5", "x" * 99)]
    assert rows(ts.read_lobs(spark, path, "id", "raw", "docs")) == [("lob:docs/raw/3", b"\x02" * 99), ("lob:docs/raw/5", b"y" * 99)]
    assert {p.name for p in tmp_path.iterdir()} == {"t", "t__lobs"}
    # the two outputs are those of lob_inline
    main, side = ts.lob_inline(docs(spark), "id", "text", 10, "docs")
    assert rows(main.select("id", "text")) == rows(stored.select("id", "text")) and rows(side) == rows(text)


def test_again_and_over(spark, tmp_path):
    path = str(tmp_path / "t")
    ts.run_import(spark, job_of(spark, path))
    with pytest.raises(FileExistsError):
        ts.run_import(spark, job_of(spark, path))
    small = replace(job_of(spark, path, overwrite=True), source=docs(spark).where("id < 3"))
    ts.run_import(spark, small)
    assert rows(ts.parquet_scan(spark, path).select("id")) == [(1,), (2,)]
    assert rows(ts.read_lobs(spark, path, "id", "text", "docs")) == [("lob:docs/text/2", "l" * 50)]
    assert rows(ts.read_lobs(spark, path, "id", "raw", "docs")) == []


@pytest.mark.parametrize("cut", ["before", "within"])
def test_both_or_neither(spark, tmp_path, monkeypatch, cut):
    path = str(tmp_path / "t")
    moved, rename = [], journal.rename

    def broken(spark, a, b):
        moved.append(b)
        if len(moved) > 1:
            raise OSError("lost")
        rename(spark, a, b)

    if cut == "before":
        monkeypatch.setattr(lobs, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    else:
        monkeypatch.setattr(journal, "rename", broken)
    with pytest.raises(OSError, match="lost"):
        ts.run_import(spark, job_of(spark, path))
    monkeypatch.undo()
    ts.recover_files(spark, path)
    if cut == "before":
        assert not data_files(spark, path) and not data_files(spark, ts.lob_path(path, "text"))
    else:
        assert len(rows(ts.parquet_scan(spark, path))) == 5
        assert len(rows(ts.read_lobs(spark, path, "id", "text", "docs"))) == 3


def test_a_large_value_without_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    df = docs(spark).withColumn("id", F.when(F.col("id") != 5, F.col("id")))
    with pytest.raises(Exception, match="needs a value of id"):
        ts.run_import(spark, replace(job_of(spark, path), source=df))
    assert list(tmp_path.iterdir()) == []
    ts.run_import(spark, replace(job_of(spark, path), source=df.where("id IS NOT NULL OR text = 'short'")))
    ts.run_import(spark, replace(job_of(spark, str(tmp_path / "none")), source=docs(spark).limit(0)))


@pytest.mark.parametrize(
    "more",
    [{"lob_key": None}, {"layout": "text"}, {"append": True}, {"merge_key": "id"}, {"incremental": "append", "check_column": "id"}],
)
def test_options(spark, tmp_path, more):
    with pytest.raises(ValueError):
        ts.run_import(spark, replace(job_of(spark, str(tmp_path / "t")), **more))


def test_counts_are_taken_while_writing(spark, tmp_path):
    """A validated import runs its rows once: each row passes the counting function once."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    source = spark.range(1000).repartition(4).mapInArrow(count, "id long")
    for i, more in enumerate(({}, {"overwrite": True}, {"append": True})):
        before = passed.value
        job = ts.ImportJob(source=source, target_dir=str(tmp_path / "t"), layout="parquet", validate=True, **more)
        result = ts.run_import(spark, job)
        assert (result.source_rows, result.target_rows) == (1000, 1000)
        assert passed.value - before == 1000, i


def test_lost_rows_fail(spark, tmp_path, monkeypatch):
    from tablesync.plans import import_job

    real = import_job.write_files
    monkeypatch.setattr(import_job, "write_files", lambda df, *a, **k: real(df.where("id > 0"), *a, **k))
    job = ts.ImportJob(source=spark.range(3), target_dir=str(tmp_path / "t"), layout="parquet", validate=True)
    with pytest.raises(RuntimeError, match="3 rows read but 2 rows stored"):
        ts.run_import(spark, job)
