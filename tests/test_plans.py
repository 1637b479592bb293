"""The physical plans that make the operators scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import tablesync as ts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_no_python_and_no_cross_join_anywhere(spark, sf_dir):
    for name, query in driver.queries().items():
        text = full_plan(query(spark, sf_dir))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["scan_table", "incremental_append", "incremental_lastmodified", "where_filter"])
def test_filters_reach_the_scan(spark, sf_dir, name):
    text = full_plan(driver.queries()[name](spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^\]]*(Greater|Equal|Less)", text)


def test_only_needed_columns_are_read(spark, sf_dir):
    text = full_plan(driver.queries()["scan_table"](spark, sf_dir))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert [c.split(":")[0] for c in read.split(",")] == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def test_merge_latest_reduces_before_its_one_shuffle(spark, sf_dir):
    text = plan(driver.queries()["merge_latest_duplicates"](spark, sf_dir))
    assert text.count("Exchange") == 1
    before, after = text.split("Exchange")
    assert "Final" in before and "WindowGroupLimit" in after and "Partial" in after


def test_merge_latest_shuffles_few_rows_of_a_hot_key(spark):
    # two thirds of the rows share one key; each of 8 map tasks sends it once
    hot = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    merged = ts.merge_latest(hot, hot.limit(0), "k", "v")
    rows = {r["k"]: r["v"] for r in merged.collect()}
    assert rows[-1] == 89_998 and len(rows) == 30_001
    assert shuffled_rows(merged) == 30_000 + 8


def shuffled_rows(df) -> int:
    """Rows written to shuffles by the last run of this frame's plan."""
    total, nodes = 0, [df._jdf.queryExecution().executedPlan().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().get("shuffleRecordsWritten").get().value()
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_merge_unique_leaves_the_old_side_in_place(spark, sf_dir):
    text = plan(driver.queries()["merge_unique_changed"](spark, sf_dir))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "hashpartitioning" not in text


def test_merge_unique_with_a_large_batch(spark, sf_dir, no_broadcast):
    text = plan(driver.queries()["merge_unique"](spark, sf_dir))
    assert "SortMergeJoin" in text and "LeftAnti" in text
    assert text.count("Exchange hashpartitioning") == 2


def test_bucketed_table_merges_without_its_own_shuffle(spark, sf_dir, tmp_path, no_broadcast):
    old = ts.parquet_scan(spark, f"{sf_dir}/orders.parquet")
    ts.write_table(old, "t_bucketed", path=str(tmp_path / "t"), bucket_by=(8, ["o_orderkey"]))
    table = spark.table("t_bucketed")
    batch = old.withColumn("o_orderkey", F.col("o_orderkey") * 2)
    merged = ts.merge_unique(table, batch, "o_orderkey")
    assert plan(merged).count("Exchange hashpartitioning") == 1
    assert sorted(merged.collect()) == sorted(ts.merge_latest(old, batch, "o_orderkey").collect())


def test_upsert_shuffles_each_side_once(spark, sf_dir, no_broadcast):
    text = plan(driver.queries()["upsert_rows"](spark, sf_dir))
    assert "FullOuter" in text and text.count("Exchange hashpartitioning") == 2
    assert re.search(r"PushedFilters: \[IsNotNull\(c_custkey\)\]", full_plan(driver.queries()["upsert_rows"](spark, sf_dir)))
    assert re.search(r"PushedFilters: \[IsNull\(c_custkey\)\]", full_plan(driver.queries()["upsert_rows"](spark, sf_dir)))


def test_small_upsert_leaves_the_target_in_place(spark, sf_dir):
    target = ts.parquet_scan(spark, f"{sf_dir}/orders.parquet")
    batch = ts.parquet_scan(spark, f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("o_orderkey"), F.col("c_name").alias("o_orderstatus")
    )
    text = plan(ts.upsert_rows(target, batch, "o_orderkey", small_batch=True))
    shuffled = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    assert shuffled and text.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in text


def test_aggregates_combine_map_side(spark, sf_dir):
    for name in ("key_profile", "split_plan", "incremental_state", "decimal_layout", "max_check_value"):
        text = plan(driver.queries()[name](spark, sf_dir))
        assert "HashAggregate" in text and "partial_" in text and "SortAggregate" not in text, name


def test_narrow_operators_do_not_shuffle(spark, sf_dir):
    for name in (
        "scan_table split_scan parquet_scan select_columns sanitize_columns cast_overrides decimal_typed "
        "decimal_rescale_exact decimal_to_fixed fixed_to_decimal datetime_to_millis lob_inline lob_inline_side "
        "drop_delims tag_origin append_rows merge_null_key merge_to_old_schema incremental_append"
    ).split():
        text = plan(driver.queries()[name](spark, sf_dir))
        assert "hashpartitioning" not in text and "rangepartitioning" not in text, name
