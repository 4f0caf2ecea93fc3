"""Cases where an operator once did less than the whole job."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import html_extract, language, lmscore, mixing, ngram_join, packing, quality, token_hist
from quarry.llm import queries as llm_queries
from quarry.session import materialize


def test_pipeline_drops_near_copies_edited_in_two_percent(spark):
    rnd = random.Random(11)
    words = [f"{rnd.choice('bcdfg')}{i}" for i in range(1000)]
    edited = [f"new{i}" if i % 50 == 25 else w for i, w in enumerate(words)]
    apart = [f"new{i}" if i % 20 == 10 else w for i, w in enumerate(words)]  # five-word likeness 0.6
    shingles = lambda ws, k: {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}
    like = lambda a, b, k: len(shingles(a, k) & shingles(b, k)) / len(shingles(a, k) | shingles(b, k))
    assert like(words, edited, 5) >= 0.8 and like(words, edited, 3) < 0.9 and like(words, apart, 5) < 0.8
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(apart))], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 3]


def test_packing_pieces_that_never_fit_stay_in_their_shards(spark):
    pieces = spark.range(640).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"), F.lit(1300).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("ids_crc32"), F.xxhash64("id").alias("tie")
    )
    got = packing.pack(materialize(pieces), shard_pieces=64)
    assert got.count() == got.select("sequence_id").distinct().count() == got.select("doc_id").distinct().count() == 640
    shards = got.groupBy(F.shiftright("sequence_id", 24).alias("shard")).count().collect()
    assert len(shards) == 10 and max(r["count"] for r in shards) < 128


def test_bigrams_learnt_once_count(spark):
    rnd = random.Random(5)
    pool = [f"w{i}" for i in range(300)]
    texts = [" ".join(rnd.sample(pool, 20)) for _ in range(300)]
    seen = {p for t in texts for p in zip(t.split(), t.split()[1:], strict=False)}
    new = []
    while len(new) < 60:  # the same words, in pairs never learnt
        ws = rnd.sample(pool, 20)
        if seen.isdisjoint(zip(ws, ws[1:], strict=False)):
            new.append(" ".join(ws))
    df = spark.createDataFrame([(i, t, i < 300) for i, t in enumerate(texts + new)], "doc_id bigint, text string, l boolean")
    got = {r["doc_id"]: r["score"] - r["base_score"] for r in lmscore.score(df, F.col("l")).collect()}
    pairs = lambda t: list(zip(t.split(), t.split()[1:], strict=False))
    times = {}
    for t in texts:
        for p in pairs(t):
            times[p] = times.get(p, 0) + 1
    # texts of pairs learnt once each gain over the same words in pairs never learnt
    single = [i for i, t in enumerate(texts) if all(times[p] == 1 for p in pairs(t))]
    assert len(single) > 10 and sum(got[i] for i in single) / len(single) > 3 + sum(got[i] for i in range(300, 360)) / 60


def test_frequent_bigrams_are_counted_before_they_move(spark):
    df = spark.createDataFrame([("so it " * 50_000,), ("so it goes",)] * 4, "t string").repartition(2)
    moved = lmscore.bigram_counts(df, 3)
    assert moved.count() <= 2 * 8  # two tasks; start-so, so-it, it-so, it-END, it-goes, goes-END
    assert moved.agg(F.sum("c")).first()[0] == 4 * (100_001 + 4)
    parts = lmscore.filter_parts(df, 3, 16, 1)
    levels = parts.select(F.posexplode("level_c").alias("q", "c")).groupBy("q").agg(F.sum("c").alias("c")).filter("c > 0").collect()
    # counts: start-so 8, so-it 200,004, it-so 199,996, it-END, it-goes and goes-END 4
    assert {r["q"]: r["c"] for r in levels} == {3: 12, 4: 8, 18: 400_000}


def test_broadcast_tokens_stay_within_their_bound(spark):
    counts = [1] * 9 + [4095] * 3 + [4096, 5000, 8191, 8192, 70_000, 1 << 40]
    vocab = spark.createDataFrame([(f"w{i}", c) for i, c in enumerate(counts)], "token string, c bigint")
    for most, least in ((18, 1), (17, 4095), (9, 4095), (8, 4096), (5, 8192), (2, 1 << 16), (1, 1 << 40)):
        assert lmscore.broadcast_from(vocab, most) == least
    assert vocab.filter(F.col("c") >= lmscore.broadcast_from(vocab, 0)).count() == 0
    # scores do not depend on it, even where all broadcast tokens would be very frequent
    texts = spark.createDataFrame([(i, "a b c " * 3000, True) for i in range(2)], "doc_id bigint, text string, l boolean")
    few, all_of = (lmscore.score(texts, F.col("l"), frequent=n).first() for n in (2, 100))
    assert few["n_known"] == all_of["n_known"] == 9001 and abs(few["base_score"] - all_of["base_score"]) < 1e-6


def test_points_of_very_large_groups_prune_no_link(spark):
    big = np.arange(200_000, dtype=np.uint64) * np.uint64(ngram_join.GROUPS << 16)  # all in one group
    sets = {1: big, 2: big[1000:], 3: big[100_000:], 4: np.arange(200_000, dtype=np.uint64) << np.uint64(16)}
    kept = lambda s: (s >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    df = spark.createDataFrame([(c, len(s), bytearray(ngram_join.packed_point(s)), bytearray(kept(s))) for c, s in sets.items()], "cls bigint, n bigint, point binary, shingles binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (1, 4)], "a bigint, b bigint")
    assert [tuple(r) for r in ngram_join.verified(pairs, df, 90).collect()] == [(1, 2)]
    members = df.select(F.lit(1).cast("bigint").alias("block"), "cls", F.col("cls").alias("comp"), "n", "point")
    assert (1, 2) in {(r["a"], r["b"]) for r in ngram_join.tree_pairs(members, 90).collect()}
    small = ngram_join.packed_point(np.arange(500, dtype=np.uint64))
    assert len(small) == 2 * ngram_join.GROUPS and (ngram_join.unpacked_points([small, ngram_join.packed_point(big)]).sum(axis=1) == [500, 200_000]).all()


ARTICLE = "This is a long paragraph of the article, which says many things about the topic at hand, and goes on for a while. " * 2


@pytest.mark.parametrize(
    ("open_", "close"),
    [
        ('<article data-id="comment-5">', "</article>"),
        ('<p data-hidden="false">', "</p>"),
        ('<div alt="a hidden b" title="class=comments">', "</div>"),
        ('<article class="post tags">', "</article>"),
        ('<main><div class="legal-analysis">', "</div></main>"),
        ('<div class="has-sidebar"><article>', "</article></div>"),
        ('<div class="widget"><main>', "</main></div>"),
        ("<div><math>", "</math></div>"),
    ],
)
def test_articles_in_real_markup_are_kept(open_, close):
    page = f"<html><body><nav><a href=/>Home</a> <a href=/x>More</a></nav>{open_}<p>{ARTICLE}</p><p>{ARTICLE}</p>{close}<footer>Copyright 2024</footer></body></html>"
    assert html_extract.main_text(page) == f"{ARTICLE.strip()}\n\n{ARTICLE.strip()}"


@pytest.mark.parametrize(
    "open_",
    ['<div class="comments-area">', '<article class="comment">', "<aside>", '<div id="cookie-banner">', '<div class="site-footer">', '<div style="display: none">', "<div hidden>", '<div class="sidebarWidget">', "<div role=complementary>"],
)
def test_boilerplate_beside_an_article_goes(open_):
    name = open_[1:].split()[0].rstrip(">")
    page = f"<body><article><p>{ARTICLE}</p><p>{ARTICLE}</p></article>{open_}<p>Short words to go away, they say, and so it was.</p></{name}></body>"
    assert html_extract.main_text(page) == f"{ARTICLE.strip()}\n\n{ARTICLE.strip()}"


def test_very_deep_and_very_long_pages():
    import time

    t = time.perf_counter()
    assert len(html_extract.blocks("<div>" * 20_000 + "<p>word</p></i></span>" * 20_000)) == 20_000
    assert time.perf_counter() - t < 5
    long = "<p>" + "A sentence of the text that is said again and again. " * 100_000 + "</p>"  # 5.3 MB
    assert len(html_extract.main_text(f"<article>{long}</article>")) > 5_000_000
    assert html_extract.main_text("") == html_extract.main_text(None) == html_extract.main_text("<div><p") == ""


def test_budgets_of_very_long_documents_are_met():
    import itertools

    rng = np.random.default_rng(3)
    cases = [([74_000, 76_000, 90_000], [1, 1, 1], 150_000, 1), ([100_000, 100_001, 3], [5, 5, 1], 300_004, 1)]
    cases += [(sorted(rng.choice(300_000, 4, replace=False) + 1), list(rng.integers(1, 3, 4)), int(rng.integers(1, 900_000)), 1) for _ in range(40)]
    for lengths, counts, budget, most in cases:
        got = int((np.array(lengths) * mixing.fit_counts(lengths, counts, budget, most)).sum())
        sums = {sum(n * x for n, x in zip(ns, lengths, strict=True)) for ns in itertools.product(*(range(c * most + 1) for c in counts))}
        assert abs(got - budget) == min(abs(s - budget) for s in sums), (lengths, counts, budget)


def test_every_context_limit_is_answered(spark):
    lengths = {0: 3, 5: 2, 600: 4, 70_000: 1}
    hist = spark.createDataFrame(list(lengths.items()), "length bigint, documents bigint")
    totals = token_hist.context_totals(hist, block=4)
    got = {r["limit"]: r for r in token_hist.at_limits(totals, (1, 5, 512, 600, 4096, 1 << 20)).collect()}
    flat = np.repeat(list(lengths), list(lengths.values()))
    for x, r in got.items():
        assert (r["documents_ge"], r["tokens_ge"], r["truncated_tokens"]) == ((flat >= x).sum(), flat[flat >= x].sum(), np.minimum(flat, x).sum())
        assert abs(r["share_le"] - (flat <= x).mean()) < 1e-12
    none = token_hist.at_limits(token_hist.context_totals(hist.limit(0)), (512,)).first()
    assert tuple(none) == (512, 0, 0, 0, None)
    q = {r["length"]: r["documents"] for r in llm_queries.QUERIES["op8_token_histogram"](spark, "/root/testdata/sf0.001").collect()}
    assert set(token_hist.LIMITS) <= set(q) and sum(q.values()) == 200


def test_linked_sets_share_what_the_blocks_need():
    rng = np.random.default_rng(8)
    for percent in (80, 90):
        ends = np.array(ngram_join.bands(percent, 1 << 40), np.int64)
        for n in (12, 40, 300, 2000):
            base = np.sort(rng.choice(1 << 62, n, replace=False).astype(np.uint64))
            drop = int(n * (100 - percent) / (100 + percent))
            other = np.sort(np.concatenate([rng.permutation(base)[drop:], rng.choice(1 << 62, drop, replace=False).astype(np.uint64)]))
            common = len(np.intersect1d(base, other))
            if 100 * common < percent * (2 * n - common):
                continue
            a, b = ({band: (need, set(k.tolist())) for band, need, k in ngram_join.band_keys(s, percent, ends)} for s in (base, other))
            for band in a.keys() & b.keys():
                assert len(a[band][1] & b[band][1]) >= max(a[band][0], b[band][0])


def test_frequent_blocks_go_and_linked_pairs_stay(spark):
    rows = [(1, c, 0, 2, 3) for c in (10, 11, 12)] + [(2, c, 0, 2, 2) for c in (10, 11)] + [(3, 13, 0, 1, 2), (1, 13, 0, 1, 3)]
    kept = ngram_join.rarest(spark.createDataFrame(rows, "block bigint, cls bigint, band int, need int, size bigint")).select("block", "cls").collect()
    assert sorted(tuple(r) for r in kept) == [(1, 13), (2, 10), (2, 11), (3, 13)]


def test_pipeline_keeps_columns_that_are_named_like_results(spark):
    docs = spark.createDataFrame([(1, "the words of a text", "en", 42.0, "mine", 5), (2, "der text und das wort", "de", 1.0, "x", 6), (3, "12 !", "en", 2.0, "y", 7)], "doc_id bigint, text string, lang string, score double, lang_pred string, _xl int")
    got = corpus_pipeline.keep_known_language(spark, docs, "")
    assert got.columns == docs.columns and sorted(tuple(r)[3:] for r in got.collect()) == [(1.0, "x", 6), (42.0, "mine", 5)]


def test_pipeline_over_an_empty_table(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_queries_run_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op1_exact_dedup", "op4_fingerprints", "op5_source_mix", "op6_language_id", "op7_ngram_jaccard_join", "op9_quality_model", "op10_bloom_lm_scores"):
        assert llm_queries.QUERIES[name](spark, sf).count() == docs, name
    assert llm_queries.QUERIES["op2_best_fit_packing"](spark, sf).select("doc_id").distinct().count() == docs
    assert llm_queries.QUERIES["op3_html_main_text"](spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()


def test_context_trees_of_all_ngrams(spark):
    docs = spark.createDataFrame([(1, "abab", "x"), (2, "abc", "x"), (3, "zzz", "y")], "doc_id bigint, text string, lang string")
    whole, cut = (language.fit(docs, min_count=n) for n in (1, 2))
    sizes = lambda t: [len(c) for c in t.cost]
    assert sizes(whole)[1:] > sizes(cut)[1:] and sizes(whole)[0] == sizes(cut)[0]
    # order 1 of "x": a is followed by b three times, b by a and c once each
    raw = np.frombuffer(b"ab", np.uint8)
    bits = whole.bits(raw, np.array([0, 2]))[0]
    at = whole.langs.index("x")
    assert np.isfinite(bits).all() and bits[at] == bits.min()


@pytest.mark.parametrize("frequent", [1000, 6])
def test_scores_equal_a_model_of_exact_counts(spark, frequent):
    import math
    from collections import Counter

    rnd = random.Random(2)
    pool = [f"w{i}" for i in range(25)]
    texts = [" ".join(rnd.choices(pool, weights=range(25, 0, -1), k=rnd.randint(0, 30))) for _ in range(60)] + ["new words here", "w0 w1 new", None, "W0  W1"]
    learnt = 50
    df = spark.createDataFrame([(i, t, i < learnt) for i, t in enumerate(texts)], "doc_id bigint, text string, l boolean").repartition(3)
    toks = lambda t: [*(t or "").lower().split(), ""]
    uni = Counter(w for t in texts[:learnt] for w in toks(t))
    pairs = lambda t: list(zip(["<s>", *toks(t)], toks(t), strict=False))
    bi = Counter(p for t in texts[:learnt] for p in pairs(t))
    level = lambda c: 1 + int(math.log2(c))
    sums, kinds = Counter(), Counter()
    for c in bi.values():
        sums[level(c)] += c
        kinds[level(c)] += 1
    mean = {q: sums[q] / kinds[q] for q in sums}
    once, twice = sum(c == 1 for c in bi.values()), sum(c == 2 for c in bi.values())
    d = once / (once + 2 * max(twice, 1))
    # tokens of the broadcast: all whose count reaches the least one that keeps within the bound
    wide = {w for w in uni if sum(c >= uni[w] for c in uni.values()) <= frequent}
    before = lambda w: learnt if w == "<s>" else uni[w]
    kind = lambda w: 1 + int(math.log2(before(w))) if w == "<s>" or w in wide else 0
    met, mass = Counter(), Counter()
    for t in texts[:learnt]:
        for u, _ in pairs(t):
            met[kind(u)] += 1
        for p in pairs(t):
            mass[kind(p[0])] += d / mean[level(bi[p])]
    base = lambda w: math.log10((uni[w] + 1) / (sum(uni.values()) + len(uni) + 1))

    def score(t):
        z = 0.0
        for u, w in pairs(t):
            if bi[u, w]:
                z += math.log10(mean[level(bi[u, w])] - d) - math.log10(before(u))
            else:
                k = kind(u)
                z += base(w) + math.log10(min(1.0, max(1e-6, mass[k] / met[k])) if met[k] else 1.0)
        return z

    got = lmscore.score(df, F.col("l"), bits_per_entry=64, frequent=frequent, shard_tokens=200).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(toks(t)), sum(uni[w] > 0 for w in toks(t)), sum(uni.values()))
        assert abs(r["base_score"] - sum(map(base, toks(t)))) < 1e-6 and abs(r["score"] - score(t)) < 1e-6


def slow_split(g, h, lo, hi):
    """Best cut of bins lo..hi by trying all."""
    best = (0.0, lo)
    total = lambda x, a, b: sum(x[a:b])
    for i, cut in enumerate(range(lo + 1, hi)):
        gain = total(g, lo, cut) ** 2 / (total(h, lo, cut) + 1) + total(g, cut, hi) ** 2 / (total(h, cut, hi) + 1) - total(g, lo, hi) ** 2 / (total(h, lo, hi) + 1)
        if i == 0 or gain > best[0] + 1e-12:
            best = (gain, cut)
    return best


def slow_tree(g, h, leaves):
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*slow_split(g, h, *p), p) for p in parts]
        gain, cut, p = max(found, key=lambda f: f[0])
        if gain <= 1e-9:
            break
        parts.remove(p)
        parts += [(p[0], cut), (cut, p[1])]
    return [next(sum(g[a:b]) / (sum(h[a:b]) + 1) for a, b in parts if a <= i < b) for i in range(len(g))]


def test_quality_tables_equal_a_slow_fit():
    import itertools
    import math

    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(size=160), rng.integers(0, 4, 160).astype(float), rng.normal(size=160)])
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 1)).astype(int)  # needs a pair
    m = quality.fit_model(x, y, max_bins=6, rounds=4, pairs=2, pair_rounds=3)
    bins = [[sum(v >= e for e in np.unique(np.quantile(x[:, j], np.linspace(0, 1, 7)[1:-1]))) for v in x[:, j]] for j in range(3)]
    weight = [0.5 / y.mean() if t else 0.5 / (1 - y.mean()) for t in y]
    size = [len(t) for t in m.tables]
    tables, z = [[0.0] * s for s in size], [0.0] * len(y)

    def slopes():
        p = [1 / (1 + math.exp(-v)) for v in z]
        return [w * (t - q) for w, t, q in zip(weight, y, p, strict=True)], [w * q * (1 - q) for w, q in zip(weight, p, strict=True)]

    def summed(values, at, n, rows):
        out = [0.0] * n
        for r in rows:
            out[at[r]] += values[r]
        return out

    every = range(len(y))
    for _ in range(4):
        for j in range(3):
            g, h = slopes()
            leaf = [0.2 * v for v in slow_tree(summed(g, bins[j], size[j], every), summed(h, bins[j], size[j], every), 4)]
            tables[j] = [a + b for a, b in zip(tables[j], leaf, strict=True)]
            z = [a + leaf[bins[j][r]] for r, a in enumerate(z)]
    g, h = slopes()
    gains = []
    for i, j in itertools.combinations(range(3), 2):
        side = [2 * (bins[i][r] >= np.median(bins[i])) + (bins[j][r] >= np.median(bins[j])) for r in every]
        gains.append((sum(a * a / (b + 1) for a, b in zip(summed(g, side, 4, every), summed(h, side, 4, every), strict=True)), i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:2]]
    assert [(i, j) for i, j, _ in m.pairs] == chosen
    pair_tables = [np.zeros((size[i], size[j])) for i, j in chosen]
    for _ in range(3):
        for (i, j), t in zip(chosen, pair_tables, strict=True):
            g, h = slopes()
            cut = slow_split(summed(g, bins[i], size[i], every), summed(h, bins[i], size[i], every), 0, size[i])[1]
            leaf = np.zeros_like(t)
            for low in (True, False):
                rows = [r for r in every if (bins[i][r] < cut) == low]
                leaf[slice(0, cut) if low else slice(cut, None)] = [0.2 * v for v in slow_tree(summed(g, bins[j], size[j], rows), summed(h, bins[j], size[j], rows), 2)]
            t += leaf
            z = [a + leaf[bins[i][r], bins[j][r]] for r, a in enumerate(z)]
    for got, want in zip(m.tables, tables, strict=True):
        assert np.allclose(got, want, atol=1e-9)
    for (_, _, got), want in zip(m.pairs, pair_tables, strict=True):
        assert np.allclose(got, want, atol=1e-9)
    assert np.allclose(m.score(x), [1 / (1 + math.exp(-v)) for v in z], atol=1e-9)


def test_quality_sample_does_not_depend_on_row_order(spark):
    rows = [(i % 40, f"{'good words here ' * (i % 7 + 1) if i % 2 else '#### || ' * (i % 5 + 1)}", i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    scores = []
    for parts in (1, 7):
        x = df.repartition(parts)
        feats = materialize(quality.features(x))
        model = quality.fit(feats, x.select("doc_id", "quality"), max_rows=50)
        scores.append(model.score(np.array([[1.0] * len(quality.FEATURES), [0.0] * len(quality.FEATURES)])).tolist())
    assert scores[0] == scores[1]
