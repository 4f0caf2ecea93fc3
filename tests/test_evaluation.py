import math

from pyspark.sql import functions as F

from helpers import one
from quarry.operators import evaluation as E


def _entropy(spark, vecs, threshold=0.8):
    rows = [(0, i, v) for i, v in enumerate(vecs)]
    resp = spark.createDataFrame(rows, "grp bigint, rid bigint, embedding array<float>")
    return E.entropy_by_prompt(resp, threshold).first()["entropy"]


def test_identical_responses_have_zero_entropy(spark):
    assert _entropy(spark, [[1.0] * 10, [1.0] * 10]) == 0.0


def test_orthogonal_responses_have_ln2(spark):
    assert math.isclose(_entropy(spark, [[1.0, 0.0], [0.0, 1.0]]), math.log(2))


def test_single_response_is_zero(spark):
    assert _entropy(spark, [[1.0, 2.0]]) == 0.0


def test_chain_is_one_cluster(spark):
    a, b, c = [1.0, 0.0], [0.8, 0.6], [0.28, 0.96]  # cos(a,b)=0.8+, cos(b,c)=0.8, cos(a,c)=0.28
    vecs = [a, [0.79, 0.613], [0.28, 0.96]]
    ent = _entropy(spark, vecs, threshold=0.75)
    assert ent == 0.0


def test_threshold_is_strict_and_zero_vector_never_links(spark):
    assert math.isclose(_entropy(spark, [[1.0, 0.0], [0.0, 0.0]], threshold=0.0), math.log(2))


def test_large_group_spans_blocks(spark):
    vecs = [[1.0, 0.001 * i] for i in range(40)]
    resp = spark.createDataFrame([(0, i, v) for i, v in enumerate(vecs)], "grp bigint, rid bigint, embedding array<float>")
    edges = E.similarity_edges(resp, 0.99, block=8)
    assert edges.count() == 40 * 39 // 2


def test_parse_thinking(spark):
    p = one(spark, E.parse_thinking(F.col("t")), t="<think>I should say hello.</think> Hello world!")
    assert (p["thinking"], p["answer"]) == ("I should say hello.", "Hello world!")
    p = one(spark, E.parse_thinking(F.col("t")), t="Just a normal response.")
    assert (p["thinking"], p["answer"]) == (None, "Just a normal response.")
    p = one(spark, E.parse_thinking(F.col("t")), t="<think></think>a<think>x</think>b")
    assert (p["thinking"], p["answer"]) == ("", "ab")


def test_weighted_loss_and_perplexity(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 3)], "loss double, n_tokens bigint")
    r = E.weighted_loss(df).first()
    assert math.isclose(r["avg_loss"], 1.75) and math.isclose(r["perplexity"], math.exp(1.75)) and r["total_tokens"] == 4


def test_nonpad(spark):
    df = spark.createDataFrame([([5, 6, 7],)], "ids array<int>")
    assert df.select(E.nonpad_tokens(E.pad_labels("ids", 5))).first()[0] == 3
    assert df.select(E.nonpad_tokens(E.pad_labels("ids", 2))).first()[0] == 2


def test_strided_windows_score_each_token_once(spark):
    df = spark.createDataFrame([(1, 1000), (2, 10), (3, 0)], "doc_id int, n bigint")
    w = E.strided_windows(df, "n", 512, 256).groupBy("doc_id").agg(F.sum("n_scored").alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in w} == {1: 1000, 2: 10}


def test_strip_prompt_variants(spark):
    prompt = "<|im_start|>user\nQ<|im_end|>\n"
    out = "user\nQ\n  answer"
    assert one(spark, E.strip_prompt(F.col("o"), F.col("p")), o=out, p=prompt) == "answer"
    assert one(spark, E.strip_prompt(F.col("o"), F.col("p"), "raw"), o=out, p=prompt) == ""


def test_contracted_blocks_give_same_clusters(spark):
    import random

    rnd = random.Random(7)
    vecs = [[rnd.random() for _ in range(4)] for _ in range(60)]
    resp = spark.createDataFrame([(0, i, v) for i, v in enumerate(vecs)], "grp bigint, rid bigint, embedding array<float>")
    verts = resp.select("grp", "rid")
    full = E.connected_components(verts, E.similarity_edges(resp, 0.97, block=256))
    small = E.connected_components(verts, E.similarity_edges(resp, 0.97, block=7, contract=True))
    a = {r["rid"]: r["cluster"] for r in full.collect()}
    b = {r["rid"]: r["cluster"] for r in small.collect()}
    assert a == b and len(set(a.values())) < 60


def test_hub_and_chain_graph(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 50)] + [(100 + i, 101 + i) for i in range(30)], "a bigint, b bigint")
    verts = spark.createDataFrame([(0, i) for i in range(50)] + [(0, 100 + i) for i in range(31)] + [(0, 999)], "grp bigint, rid bigint")
    got = {r["rid"]: r["cluster"] for r in E.connected_components(verts, edges).collect()}
    assert all(got[i] == 0 for i in range(50)) and all(got[100 + i] == 100 for i in range(31)) and got[999] == 999


def test_failing_metric_is_recorded_not_fatal(spark):
    from quarry.evaluate import Model, evaluate
    from quarry.session import shared_dir

    good = lambda: spark.range(1).selectExpr("2.0D as perplexity", "ln(2.0D) as avg_loss", "5L as total_tokens")
    said = lambda: spark.range(3).selectExpr("id as prompt", "array('a', 'b') as responses")

    def unplanned():
        raise RuntimeError("embedder unavailable")

    # fails inside a task, long after the metric was planned
    late = lambda: spark.range(10).selectExpr("if(id = 7, raise_error('no answer'), 1.0D) as mean_entropy")
    folder = shared_dir(spark, "t-evaluate")
    got = {r["model_path"]: r for r in evaluate(spark, folder, [
        Model("org/a", {"perplexity": good, "semantic_entropy": unplanned, "generations": said}),
        Model("ck/b/final", {"perplexity": good, "semantic_entropy": late}, "configs/b_lora.yaml"),
    ]).collect()}
    a, b = got["org/a"], got["ck/b/final"]
    assert a["result_name"] == "evaluation_results_a.json" and b["result_name"] == "evaluation_results_b_lora.json"
    assert a["perplexity"]["perplexity"] == b["perplexity"]["perplexity"] == 2.0 and a["perplexity"]["error"] is None
    assert "embedder unavailable" in a["semantic_entropy"]["error"] and "no answer" in b["semantic_entropy"]["error"]
    assert a["semantic_entropy"]["mean_entropy"] is None and (a["generations"]["n_prompts"], a["generations"]["n_responses"]) == (3, 6)
    assert b["generations"] is None and b["config"] == "configs/b_lora.yaml"  # skipped
    again = evaluate(spark, folder, [Model("org/a", {"perplexity": good})]).collect()
    assert len(again) == 2 and next(r for r in again if r["model_path"] == "org/a")["generations"] is None  # replaced, the other stays


def _labelled(spark, folder):
    """Two labels and no label; the linked rows of a label lie far apart by id, one row has no vector."""
    rows = [(0, [1.0, 0.0], 1), (200, [1.0, 0.1], 1), (400, [0.0, 1.0], 1), (1, [1.0, 0.0], 2), (2, [1.0, 0.0], None), (3, [1.0, 0.0], None), (4, None, 2)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def _query(spark, folder, name):
    from quarry.plans import catalogue

    return sorted((tuple(r) for r in catalogue.QUERIES[name].build(spark, _labelled(spark, folder)).collect()), key=str)


def test_pairs_are_all_of_a_label(spark, tmp_path):
    assert [r[:3] for r in _query(spark, tmp_path, "pairwise_cosine")] == [(1, 0, 200)]


def test_clusters_are_those_of_a_label(spark, tmp_path):
    got = _query(spark, tmp_path, "semantic_clusters")
    assert got == sorted([(1, 0, 0), (1, 200, 0), (1, 400, 400), (2, 1, 1), (2, 4, 4), (None, 2, 2), (None, 3, 3)], key=str)


def test_cluster_sizes_are_those_of_a_label(spark, tmp_path):
    got = _query(spark, tmp_path, "cluster_sizes")
    assert got == sorted([(1, 0, 2), (1, 400, 1), (2, 1, 1), (2, 4, 1), (None, 2, 1), (None, 3, 1)], key=str)


def test_entropy_is_that_of_a_label(spark, tmp_path):
    two, three = round(math.log(2), 6), round(math.log(3) - 2 / 3 * math.log(2), 6)
    assert _query(spark, tmp_path, "semantic_entropy") == sorted([(1, three, 3), (2, two, 2), (None, two, 2)], key=str)
