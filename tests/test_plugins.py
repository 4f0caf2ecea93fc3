import numpy as np
from pyspark.sql import functions as F

from quarry.operators import evaluation as E
from quarry.operators import tokens as TK
from quarry.sources import results as RS


def test_plugin_token_counts(spark):
    count = TK.plugin_token_counts(lambda texts: [len(t.split()) for t in texts])
    df = spark.createDataFrame([("a b c",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(count("t")).collect()] == [3, 0, 0]


def test_native_token_count(spark):
    df = spark.createDataFrame([("Hello, world! 42",)], "t string")
    assert df.select(TK.token_count("t")).first()[0] == 5


def test_embed_with_plugin(spark):
    def make_model():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    emb = E.embed_with(make_model, 2)
    df = spark.createDataFrame([("abc",), ("de",)], "t string")
    assert [list(r[0]) for r in df.select(emb("t")).collect()] == [[3.0, 1.0], [2.0, 1.0]]


def test_hashed_embedding_counts_tokens(spark):
    df = spark.createDataFrame([("a a b",)], "t string")
    v = df.select(E.hashed_tf_embedding("t", 8)).first()[0]
    assert len(v) == 8 and sum(v) == 3.0 and max(v) >= 2.0


def test_result_names(spark):
    assert RS.result_name("org/base-model-8b") == "evaluation_results_base-model-8b.json"
    assert RS.result_name("checkpoints/x/final", "configs/dropped_lora.yaml") == "evaluation_results_dropped_lora.json"
    df = spark.createDataFrame([("org/base-model-8b", None), ("ck/final", "configs/pruned.yaml")], "m string, c string")
    got = [r[0] for r in df.select(RS.result_name_col(F.col("m"), F.col("c"))).collect()]
    assert got == ["evaluation_results_base-model-8b.json", "evaluation_results_pruned.json"]
