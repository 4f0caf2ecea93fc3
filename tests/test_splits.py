import hashlib

from pyspark.sql import functions as F

from quarry.operators import splits as T


def _brute(keys, ratio, seed=42):
    order = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    n_train = int(len(order) * ratio)
    return {k: ("train" if i < n_train else "eval") for i, k in enumerate(order)}


def test_split_matches_brute_force(spark):
    keys = list(range(500))
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r["k"]: r["split"] for r in T.train_eval_split(df, "k", 0.9, bucket_hex=1).collect()}
    assert got == _brute(keys, 0.9)


def test_split_edges(spark):
    one_row = spark.createDataFrame([(1,)], "k bigint")
    assert [r["split"] for r in T.train_eval_split(one_row, "k").collect()] == ["eval"]
    df = spark.createDataFrame([(k,) for k in range(10)], "k bigint")
    assert {r["split"] for r in T.train_eval_split(df, "k", 0.0).collect()} == {"eval"}
    assert {r["split"] for r in T.train_eval_split(df, "k", 1.0).collect()} == {"train"}


def test_split_has_no_unpartitioned_window(spark):
    import re

    df = spark.range(1000).withColumnRenamed("id", "k")
    lines = T.train_eval_split(df, "k")._jdf.queryExecution().executedPlan().toString().split("\n")
    windows = [ln for ln in lines if re.search(r"\bWindow \[", ln)]
    assert windows and not any(re.search(r"\], \[\], \[", ln) for ln in windows)
    # single-partition exchanges only feed aggregates of bounded tables (16 digit groups)
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            assert "Aggregate" in lines[i + 1]


def test_packing_preserves_tokens_and_bounds_blocks(spark):
    rows = [(i, n) for i, n in enumerate([0, 5, 2048, 3000, 1, 4097])]
    df = spark.createDataFrame(rows, "k bigint, n bigint")
    p = T.pack_sequences(df, "k", "n", 2048)
    total = sum(n for _, n in rows)
    assert p.agg(F.sum("n_tokens")).first()[0] == total
    blocks = {r["block"]: r["s"] for r in p.groupBy("block").agg(F.sum("n_tokens").alias("s")).collect()}
    assert blocks == {b: min(2048, total - b * 2048) for b in range(-(-total // 2048))}


def test_best_and_retained_checkpoints(spark):
    ev = spark.createDataFrame([(1, s, l) for s, l in [(1, 3.0), (2, 1.0), (3, 1.0), (4, 2.0), (5, 2.5)]], "run_id int, step int, eval_loss double")
    assert T.best_checkpoint(ev).first()["best_step"] == 2
    kept = sorted(r["step"] for r in T.retain_checkpoints(ev, 2).collect())
    assert kept == [2, 5]


def test_histogram_single_value_and_quantiles(spark):
    from quarry.operators import stats as M

    df = spark.createDataFrame([(7,)] * 5, "n bigint")
    h = {r["bin"]: (r["lo"], r["hi"], r["count"]) for r in M.histogram(df, "n", 50).collect()}
    assert len(h) == 50 and sum(c for _, _, c in h.values()) == 5 and h[25][2] == 5 and h[0][0] == 6.5
    q = M.exact_quantiles(spark.createDataFrame([(v,) for v in [1, 2, 3, 4, -5]], "n bigint"), "n", [0.5, 0.9]).first()
    assert q["p50"] == 2.0 and abs(q["p90"] - 3.6) < 1e-12


def test_missing_catalog_is_empty(spark):
    from quarry.session import shared_dir
    from quarry.sources import io as S

    assert S.read_catalog(spark, shared_dir(spark, "no-such-catalog")).count() == 0
