"""Phase runs, their manifest, repeated headers, model plug-ins."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from quarry import pipeline as P
from quarry.manifest import COMPLETE, FAILED, STARTED, Manifest, parquet_step
from quarry.operators import evaluation as E
from quarry.operators import filtering as L
from quarry.operators import headers as H
from quarry.session import shared_dir

LONG = "The plant builds cars and the engines for them, as it has done for many years, and it will do so in the years to come. "


def documents(spark, ids):
    return spark.createDataFrame([(f"{i:03d}_x.pdf", f"{LONG}Number {i}." if i % 4 else "• one\n• two\n• three") for i in ids], "source string, raw_text string").withColumn("lang", F.lit("en"))


def test_phases_resume_and_skip(spark):
    folder = shared_dir(spark, "t-run")
    cat = spark.createDataFrame([(1, "One", "2024-01-02")], "idx bigint, title string, date string")
    assert P.preprocess(spark, folder, documents(spark, range(4)), cat, "regex").examples is None
    assert P.preprocess(spark, folder, phase="llm").examples is None
    m = Manifest(spark, folder)
    assert m.read("regex", P.CLEANED).count() == 4 and P.accepted(m).count() == 3 and P.rejected(m).first()["reason"] == "only tables or lists"
    # a second run cleans and judges what is new, and judges the reject again
    got = P.preprocess(spark, folder, documents(spark, range(8)), cat, "all")
    assert [r["attempt"] for r in m.read("regex", P.CLEANED).orderBy("source").select("attempt").collect()] == [1] * 4 + [2] * 4
    assert P.accepted(m).count() == 6 and P.rejected(m).count() == 2
    s = got.summary.first()
    assert (s["total_processed"], s["train_samples"], s["eval_samples"], s["llm_filtered"], s["rejected_count"]) == (6, 5, 1, True, 2)
    ex = {r["source_pdf"]: r for r in got.examples.collect()}
    assert ex["001_x.pdf"]["title"] == "One" and ex["001_x.pdf"]["date"] == "2024-01-02" and ex["005_x.pdf"]["title"] == "005_x" and ex["005_x.pdf"]["date"] is None
    # format alone prefers accepted texts, no-llm takes the cleaned ones
    assert P.preprocess(spark, folder, phase="format").summary.first()["rejected_count"] == 0
    last = P.preprocess(spark, folder, documents(spark, range(8)), cat, "no-llm", style="article")
    assert last.examples.count() == 8 and last.summary.first()["format_style"] == "article"
    outs = [e["output"] for e in m.events() if e["phase"] == "format" and e["state"] == COMPLETE]
    assert last.output == outs[-1] and len(outs) == 3
    with pytest.raises(ValueError, match="phase must be"):
        P.preprocess(spark, folder, phase="clean")


def test_empty_runs_leave_nothing(spark):
    for phase in P.PHASES:
        folder = shared_dir(spark, "t-empty")
        got = P.preprocess(spark, folder, documents(spark, []), phase=phase)
        assert got.examples is None and got.summary is None and not Manifest(spark, folder).outputs("format")


def test_a_failed_step_is_recorded_and_never_read(spark):
    m = Manifest(spark, shared_dir(spark, "t-manifest"))
    assert m.events() == [] and m.read("a", "id bigint").count() == 0
    m.step("a", [], parquet_step(spark.range(3)))
    with pytest.raises(Exception, match="half way"):
        m.step("a", [], parquet_step(spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("half way"))).cast("bigint").alias("id"))))
    m.step("a", [], parquet_step(spark.range(2)))
    assert [(e["seq"], e["state"]) for e in m.events()] == [(1, STARTED), (1, COMPLETE), (2, STARTED), (2, FAILED), (3, STARTED), (3, COMPLETE)]
    assert sorted(tuple(r) for r in m.read("a", "id bigint").collect()) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1)]
    # as if the driver had gone away in between: started, never ended
    m._record(seq=9, phase="a", state=STARTED, inputs=[], output=f"{m.folder}/a/000009")
    assert len(m.outputs("a")) == 2 and m.step("a", [], parquet_step(spark.range(1))).endswith("000010")
    m.drop_superseded("a")
    assert spark.read.parquet(m.outputs("a")[-1][1]).count() == 1


def test_repeated_headers_in_both_forms(spark):
    rows = [(i, f"HEAD\n\ttext {i}\n  HEAD \nPage {i % 2}\nend {i}") for i in range(20)] + [(20, None), (21, "HEAD"), (22, "no header\n\nhere")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    freq = {r["line"]: r["n_documents"] for r in H.line_frequencies(docs, min_share=0.2).collect()}
    assert freq == {"HEAD": 21, "Page 0": 10, "Page 1": 10}
    lines = H.line_frequencies(docs, min_share=0.2)
    want = {i: (f"\ttext {i}\nend {i}", 3) for i in range(20)} | {20: (None, 0), 21: ("", 1), 22: ("no header\n\nhere", 0)}
    for inline in (100, 1):  # inside the row, and by a join
        got = H.drop_lines(docs, lines, inline=inline)
        assert got.columns == ["doc_id", "text", "n_removed"]
        assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in got.collect()} == want
    assert H.line_frequencies(docs.limit(0)).count() == 0 and H.without_headers(docs.limit(0)).count() == 0


def test_lists_and_tables_are_rejected(spark):
    texts = ["• a b\n• c d\n- e f\n1) g h", "a\tb\tc\nd\te\tf\n| g | h |\n", f"{LONG}\n• one point\n{LONG}", LONG * 3, "• a\n• b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(L.only_lists(F.col("t"))).collect()] == [True, True, False, False, False]


def test_batches_reach_the_model_whole(spark):
    def make_model():
        calls = {"n": 0}

        def answers(users):
            calls["n"] += 1
            return [{"label": "long" if len(u) > 60 else "short", "score": float(len(users)), "call": calls["n"]} for u in users]

        return answers

    rows = [(i, "t", "x" * (10 * (i % 12) + 1) if i % 7 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, title string, text string").coalesce(1)
    got = L.score_with(df, make_model, "label string, score double, call int", batch_size=14).collect()
    asked = [r["answer"] for r in got if r["text"] is not None]
    assert all(r["answer"]["label"] is None for r in got if r["text"] is None)
    assert max(a["score"] for a in asked) <= 14 and max(a["call"] for a in asked) == 4  # loaded once, called per batch
    with pytest.raises(Exception, match="prompts, 0 answers"):
        L.score_with(df, lambda: lambda users: [], "label string").collect()


def test_system_prompt_is_added_in_the_worker(spark):
    def make_generator():
        def generate(batch):
            return [f"{m[0]['role']} {len(m[0]['content'])} {m[1]['role']}" for m in batch]

        return generate

    df = spark.createDataFrame([("T", "some text"), ("T", " "), (None, "more")], "title string, text string")
    x = L.score_batches(df, make_generator)
    from quarry.functions import fixed

    assert [r["generated"] for r in x.collect()] == [f"system {len(fixed.FILTER_SYSTEM_PROMPT)} user", "", f"system {len(fixed.FILTER_SYSTEM_PROMPT)} user"]
    assert fixed.FILTER_SYSTEM_PROMPT[:40] not in x._jdf.queryExecution().optimizedPlan().toString()


def test_token_tensor_embedding(spark):
    def make_encoder():
        weights = np.arange(8, dtype=np.float32).reshape(4, 2)
        return lambda ids: (ids != -100) @ weights

    df = spark.createDataFrame([([5, 6, 7, 8, 9],), ([1],), ([],), (None,)], "ids array<int>")
    got = [list(r[0]) for r in df.select(E.embed_ids("ids", make_encoder, 4, 2, batch_size=3)).collect()]
    assert got == [[12.0, 16.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_hashed_embedding_in_two_levels(spark):
    text = "a b c d e f g a a, b."
    for dim in (1, 7, 8, 64):
        v = spark.createDataFrame([(text,), ("",)], "t string").select(E.hashed_tf_embedding("t", dim)).collect()
        assert len(v[0][0]) == dim and sum(v[0][0]) == 12 and list(v[1][0]) == [0.0] * dim
    h = lambda t: int(__import__("hashlib").md5(t.encode()).hexdigest()[:8], 16) % 64
    assert all(v[0][0][h(t)] >= text.count(t) for t in "abc")


def test_character_references(spark):
    from quarry.operators import pages as PG

    cases = {
        "&#8217;": "’", "&eacute;": "é", "&#x27;": "'", "&#X27;": "'", "&amp;lt;": "&lt;", "&amp;amp;": "&amp;", "&nbsp;x": " x", "&#160;": " ", "&apos;": "'",
        "&#146;": "’", "&#0;": "�", "&#xD800;": "�", "&#1114112;": "�", "&#128512;": "😀", "&#x1F600;": "😀", "&unknown;": "&unknown;",
        "a & b &": "a & b &", "&copy 2024": "&copy 2024", "&Omega;&omega;": "Ωω", "R&D; &&lt;": "R&D; &<", "plain": "plain", "": "", "&#;": "&#;", "&euro;5 &hellip;": "€5 …",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["d"] for r in df.select("t", PG.decode_references("t").alias("d")).collect()} == cases


def test_sketches_merge_within_the_stated_error(spark):
    from quarry.operators import stats as M

    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 50, 30_000), rng.lognormal(8, 2, 60_000).astype(int), np.full(40_000, 77)])
    df = spark.createDataFrame([(int(v), i % 13) for i, v in enumerate(values)], "n bigint, part int").unionByName(spark.createDataFrame([(None, 0)], "n bigint, part int"))
    parts = M.length_sketches(df, "n", ["part"])
    assert parts.count() == 13
    pairs = M.merged_sketches(parts.withColumn("half", F.col("part") % 2), ["half"])  # merging merged ones again
    for sketches in (parts, pairs):
        q = M.rank_errors(M.sketch_quantiles(sketches, [0.0, 0.01, 0.5, 0.9, 0.999, 1.0]), df, "n").collect()
        assert len(q) == 6 and all(r["n"] == len(values) and r["rank_error"] <= M.rank_bound() for r in q)
    assert M.rank_bound() < 0.005
    assert M.sketch_quantiles(M.length_sketches(df.limit(0), "n", ["part"]), [0.5]).count() == 0


def test_streams_of_known_ids_survive_restarts(spark):
    from quarry.streaming import discovery as D

    inbox, out, ckpt = (shared_dir(spark, n) for n in ("t-in", "t-out", "t-ckpt"))
    schema = "id string, place int, known boolean"
    put = lambda rows, name: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{inbox}/{name}")
    run = lambda: D.run_new_ids(spark, inbox, spark.createDataFrame([], schema).schema, out, ckpt)
    got = lambda: sorted((r["id"], r["place"]) for r in spark.read.parquet(out).collect())
    put([("k", 0, True)], "a")
    put([("x", 5, False), ("x", 2, False), ("k", 1, False), (None, 3, False), ("y", 9, None)], "b")
    run()
    assert got() == [("x", 2), ("y", 9)]
    run()  # restart without new files
    assert got() == [("x", 2), ("y", 9)]
    put([("x", 0, False), ("z", 1, False), ("w", 1, True), ("w", 2, False)], "c")
    run()
    assert got() == [("x", 2), ("y", 9), ("z", 1)]


def test_order_without_a_whole_window(spark):
    from quarry.operators.order import first_n, ranged, running_sum

    rows = [((i * 37) % 50 if i % 3 else 7, i % 5, i) for i in range(300)]  # a third of the rows have one key
    df = spark.createDataFrame(rows, "k int, v int, id int")
    for size in (1000, 40, 7):
        got = running_sum(df, ["k", "id"], "v", range_rows=size).collect()
        total = 0
        for r in sorted(got, key=lambda r: (r["k"], r["id"])):
            assert r["before"] == total
            total += r["v"]
        for n in (0, 1, 99, 100, 101, 300, 500):
            want = sorted((k, i) for k, _, i in rows)[:n]
            assert sorted((r["k"], r["id"]) for r in first_n(df, ["k", "id"], n, size, top_rows=0).collect()) == want
    sizes = ranged(df, ["k"], 20).groupBy("_range").count().collect()
    assert len(sizes) >= 12 and max(r["count"] for r in sizes) <= 60  # the hot key is split
    assert running_sum(df.limit(0), ["k"], "v").count() == 0 and first_n(df.limit(0), ["k"], 5, top_rows=0).count() == 0


def test_hot_keys_get_salts_from_counts(spark):
    from quarry.operators.joins import hot_join, hot_keys

    big = spark.createDataFrame([("the", i) for i in range(900)] + [(f"w{i % 40}", i) for i in range(400)] + [(None, 1)], "tok string, d int")
    small = spark.createDataFrame([("the", 5), ("w1", 1), ("none", 2)], "tok string, c int")
    assert hot_keys(big, ["tok"], 5000) is None
    assert [tuple(r) for r in hot_keys(big, ["tok"], 100).collect()] == [("the", 9)]
    for how in ("left", "inner"):
        for rows in (100, 5000, 5):
            j = hot_join(big, small, ["tok"], how, rows)
            assert j.columns == ["tok", "d", "c"] and j.filter("tok = 'the' and c = 5").count() == 900
            assert j.count() == (1301 if how == "left" else 910)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_model_equals_brute_force(spark, order):
    import math
    from collections import Counter, defaultdict

    train = ["the cat sat on the mat", "the dog sat", "a cat, a dog", "the", ""]
    test = {10: "the cat sat on a dog", 11: "unknown words sat", 12: "the the the", 13: ""}
    df = spark.createDataFrame([(i, t, "train") for i, t in enumerate(train)] + [(i, t, "eval") for i, t in test.items()], "doc_id int, text string, split string")
    toks = lambda t: re.findall(r"\w+|[^\w\s]", t.lower())
    windows = lambda t: [tuple((["\x02"] * (order - 1) + toks(t))[i : i + order]) for i in range(len(toks(t)))]
    counts = {order: Counter(g for t in train for g in windows(t))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    sums, kinds = defaultdict(Counter), defaultdict(Counter)
    for n, c in counts.items():
        for g, k in c.items():
            sums[n][g[:-1]] += k
            kinds[n][g[:-1]] += 1

    def p(g):
        n = len(g)
        low = p(g[1:]) if n > 1 else 1 / (len(counts[1]) + 1)
        h = g[:-1]
        return (max(counts[n][g] - 0.75, 0) + 0.75 * kinds[n][h] * low) / sums[n][h] if sums[n][h] else low

    got = {r["doc_id"]: (r["n_tokens"], r["loss"]) for r in E.ngram_doc_losses(df, "doc_id", "text", order, hot_rows=2).collect()}
    assert set(got) == {10, 11, 12}
    for i, (n, loss) in got.items():
        w = windows(test[i])
        assert n == len(w) and math.isclose(loss, -sum(math.log(p(g)) for g in w) / n, rel_tol=1e-9)


def test_run_queries_on_the_small_tables(spark):
    import __spark_entry__ as entry

    q = lambda k: entry.queries()[k](spark, SF_SMALL)
    assert {r["attempt"] for r in q("run_regex").select("attempt").distinct().collect()} == {1, 2}
    assert q("run_format").first()["total_processed"] > 0


def test_collection_goes_on_where_it_ended(spark):
    from quarry.collect import collect

    pattern = r'<a href="/([^",]+)([^"]*)"'
    listing = spark.createDataFrame([(0, '<a href="/b/x"><a href="/a">'), (1, '<a href="/a"><a href="/c"><a href="/d">')], "page_id bigint, html string")
    asked = []

    def pages(todo):
        rows = [r["idx"] for r in todo.collect()]
        asked.append(rows)
        word = "<p>" + "word " * 60 + "</p>"
        link = "https://www.press.bmwgroup.com/global/article/attachment/T1EN/"
        # the page at position 1 is empty, the one at 2 does not come back
        return spark.createDataFrame([(i, "" if i == 1 else f"<h1>Title {i}</h1>{word}<h3>{link}{i}</h3>") for i in rows if i != 2], "idx bigint, html string")

    def files(todo):
        return todo.select("idx", F.lit(200).alias("status"), F.encode(F.when(F.col("idx") == 0, F.lit("%PDF-1 x")).otherwise(F.lit("<html>")), "UTF-8").alias("content"))

    folder, at = shared_dir(spark, "t-collect"), F.lit("2024-01-01")
    first = collect(spark, folder, listing, 2, pattern=pattern)
    assert [(r["idx"], r["article_id"], r["scraped"]) for r in first.catalog.orderBy("idx").collect()] == [(0, "b/x", False), (1, "a", False)]
    got = collect(spark, folder, listing, 10, pages, files, at, pattern)
    cat = {r["article_id"]: r for r in got.catalog.collect()}
    assert sorted((r["idx"], a) for a, r in cat.items()) == [(0, "b/x"), (1, "a"), (2, "c"), (3, "d")]
    assert [cat[a]["scraped"] for a in ("b/x", "a", "c", "d")] == [True, False, False, True] and cat["d"]["title"] == "Title 3"
    assert {(r["idx"], r["result"]) for r in got.files.collect()} == {(0, "ok"), (3, "not_pdf")}
    again = collect(spark, folder, listing, 10, pages, files, at, pattern)
    assert [sorted(x) for x in asked] == [[0, 1, 2, 3], [1, 2]] and again.records.count() == 2
    assert sorted((r["idx"], r["result"]) for r in again.files.collect()) == [(0, "ok"), (3, "not_pdf"), (3, "not_pdf")]
    empty = collect(spark, shared_dir(spark, "t-collect"), listing.limit(0), 5, pages, files, at, pattern)
    assert empty.catalog.count() == 0 and empty.records.count() == 0 and empty.files.count() == 0
