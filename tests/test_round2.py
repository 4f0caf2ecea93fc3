"""Cases where an operator lost or mis-picked rows on real input."""

import pytest

from quarry.operators import clean as X
from quarry.operators import evaluation as E
from quarry.operators import splits as T
from quarry.sources import io as IO


def test_checkpoints_in_hundreds(spark):
    rows = [("r", s, l) for s, l in ((50, 3.0), (100, 1.0), (150, 2.0), (200, 2.5), (250, 2.6))] + [("q", 100, 1.0), ("q", 200, 0.5)]
    df = spark.createDataFrame(rows, "run_id string, step bigint, eval_loss double")
    got = {(r["run_id"], r["step"], r["is_best"]) for r in T.retain_checkpoints(df, 3).collect()}
    assert got == {("r", 100, True), ("r", 200, False), ("r", 250, False), ("q", 100, False), ("q", 200, True)}


def test_prompts_that_share_ids(spark):
    resp = spark.createDataFrame(
        [(1, 2000, [1.0, 0.0]), (1, 2001, [1.0, 0.0]), (2, 2000, [1.0, 0.0]), (2, 2001, [0.0, 1.0])], "grp bigint, rid bigint, embedding array<double>"
    )
    got = {r["grp"]: r["entropy"] for r in E.entropy_by_prompt(resp, 0.8).collect()}
    assert got[1] == 0.0 and abs(got[2] - 0.693147) < 1e-5


def test_no_length_cap_unless_asked(spark):
    df = spark.createDataFrame([("word " * 250_000,)], "raw_text string")
    assert X.clean_documents(df).count() == 1
    assert X.clean_documents(df, cap=1000).count() == 0


def test_missing_catalog_is_empty_but_other_failures_raise(spark, tmp_path):
    assert IO.read_catalog(spark, f"file://{tmp_path}/none").count() == 0
    with pytest.raises(Exception):
        IO.read_catalog(spark, "nosuchscheme://x/y").count()


def test_kernel_groups_follow_the_data(spark):
    from pyspark.sql import functions as F

    resp = spark.range(20_000).select((F.col("id") / 8).cast("bigint").alias("grp"), F.col("id").alias("rid"), F.array(F.lit(1.0)).alias("embedding"))
    hot = spark.range(900).select(F.lit(-1).cast("bigint").alias("grp"), F.col("id").alias("rid"), F.array(F.lit(1.0)).alias("embedding"))
    g = E.kernel_rows(resp.unionByName(hot), pack_vectors=200).groupBy("_pk", "_lo", "_hi").count()
    assert g.count() >= 100 and g.agg(F.max("count")).first()[0] <= 800


def test_split_keeps_null_keys_and_copies(spark):
    df = spark.createDataFrame([(None, "a")] * 3 + [(k, "b") for k in range(20)] + [(99, "c")] * 40, "k bigint, t string")
    rows = T.train_eval_split(df, "k", 0.5, bucket_hex=1).collect()
    assert len(rows) == 63
    assert len({r["split"] for r in rows if r["k"] == 99}) == 1 and {r["split"] for r in rows if r["k"] is None} == {"train"}
    assert T.train_eval_split(df.limit(0), "k").count() == 0


def test_split_reads_texts_once(spark, tmp_path):
    spark.createDataFrame([(k, f"text {k}") for k in range(50)], "k bigint, t string").write.parquet(f"{tmp_path}/d")
    plan = T.train_eval_split(spark.read.parquet(f"{tmp_path}/d"), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<k:bigint,t:string>") == 1
