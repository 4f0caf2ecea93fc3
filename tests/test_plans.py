import importlib

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet").filter(F.col("page_id") > 10).select("page_id", "url")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(page_id), GreaterThan(page_id,10)]" in plan
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_salted_join_spreads_hot_key(spark):
    from quarry.operators.joins import salted_join

    big = spark.createDataFrame([("the", i) for i in range(100)] + [("cat", 1)], "tok string, d int")
    small = spark.createDataFrame([("the", 5), ("cat", 1)], "tok string, c int")
    j = salted_join(big, small, ["tok"], 4, F.col("d"))
    assert j.count() == 101 and j.filter(F.col("c").isNull()).count() == 0


HEADLINE = importlib.import_module("bench").HEADLINE


@pytest.mark.parametrize("key", HEADLINE)
def test_headline_plans_scale(spark, key):
    """No cross product, no row-at-a-time Python, no window or sort of all rows in one task."""
    from quarry.plans import catalogue

    df = catalogue.QUERIES[key].build(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BatchEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in plan, key
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:  # partial sums meet there, never rows
            assert "Aggregate" in lines[i + 1], (key, lines[i : i + 2])
    scans = [line for line in lines if "FileScan parquet" in line and "/testdata/" in line]
    whole = {"documents": 5, "pages": 3, "conversations": 4, "embeddings": 3, "events": 6}
    for scan in scans:  # columns that the query does not need are not read
        name = scan.split("/testdata/")[1].split("/")[1].split(".parquet")[0]
        if name in ("documents", "events"):
            assert scan.split("ReadSchema: struct<")[1].count(":") < whole[name], (key, scan)


def test_cleaning_guards_are_in_the_plan(spark):
    from quarry.operators import clean as X

    df = spark.createDataFrame([("x",)], "raw_text string").select(X.clean_text("raw_text").alias("c"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 54 and plan.count("Contains(") + plan.count("contains(") > 47


def test_packing_and_first_rows_hold_no_whole_window(spark):
    from quarry.operators import order as O

    df = spark.range(300).withColumn("v", F.lit(2))
    plan = O.running_sum(df, ["id"], "v", range_rows=50)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in "".join(ln for ln in plan.splitlines() if "Window" in ln)
    assert O.ranged(df, ["id"], 50).select("_range").distinct().count() >= 5


def test_hot_join_repeats_hot_keys_only(spark):
    from quarry.operators.joins import hot_join

    big = spark.createDataFrame([("the", i) for i in range(900)] + [(f"w{i}", i) for i in range(100)], "tok string, d int")
    small = spark.createDataFrame([(f"w{i}", i) for i in range(1000)] + [("the", 1)], "tok string, c int")
    j = hot_join(big, small, ["tok"], "inner", 100)
    assert j.count() == 1000
    made = j._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in made  # the list of hot keys; its bound is HOT_KEYS
