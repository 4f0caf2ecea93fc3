"""Operators of quarry.llm against brute force on a small table, and on an empty one."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import exact_dedup, fingerprint, html_extract, language, lmscore, mixing, ngram_join, packing, quality, token_hist
from quarry.llm.common import held_out, may_learn, suspects, tokenizer_path
from quarry.session import materialize

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_exact_groups(docs, nothing):
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t)
    groups = defaultdict(list)
    for k, t in table_of(docs):
        groups[norm(t)].append(k)
    want = Counter()
    for t, keys in groups.items():
        known = [k for k in keys if k is not None]
        keep = min(known) if known else None
        h, first = hashlib.sha256(t.encode()).hexdigest(), True
        for k in sorted(keys, key=lambda k: (k is None, k or 0)):
            want[(k, keep, len(keys), first, h)] += 1
            first = False
    got = exact_dedup.exact_groups(docs, hash_all=True, bits=1 << 10).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["full_hash"]) for r in got) == want
    assert exact_dedup.exact_groups(nothing).count() == 0
    kept = exact_dedup.drop_exact(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.drop_exact(nothing).count() == 0


def test_suspects_miss_no_key(spark):
    rows = spark.range(3000).selectExpr("case when id < 2990 then id end as k", "cast(id as string) as _word")
    wanted = rows.filter("k % 7 = 0 or k is null").selectExpr("k as _w")
    for bits in (1 << 8, 1 << 20):
        got = suspects(rows, "k", wanted, bits)
        assert got.columns == ["k", "_word", "_maybe"] and got.count() == 3000
        assert got.filter("(k % 7 = 0 or k is null) and not _maybe").isEmpty()
    assert got.filter("_maybe").count() < 500
    short = rows.selectExpr("cast(k as int) as k", "_word")
    assert suspects(short, "k", wanted).filter("k % 7 = 0 and not _maybe").isEmpty()
    assert suspects(rows, "k", wanted.limit(0)).filter("_maybe").isEmpty()


def test_pieces_and_packing(docs, nothing):
    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for k, t in table_of(docs):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 128):
            part = ids[at : at + 128]
            want[(k, at // 128, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    pieces = materialize(packing.cut_pieces(docs, tokenizer_path(), capacity=128))
    got = packing.pack(pieces, capacity=128, shard_pieces=16).toPandas()
    have = Counter((None if r.doc_id != r.doc_id or r.doc_id is None else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples())
    assert have == want
    g = got.sort_values(["sequence_id", "offset"])
    assert ((g.groupby("sequence_id").length.cumsum() - g.length) == g.offset).all()
    n, least = g.sequence_id.nunique(), -(-int(g.length.sum()) // 128)
    assert g.groupby("sequence_id").length.sum().max() <= 128 and n <= least * 1.1 + 2
    assert packing.pack(materialize(packing.cut_pieces(nothing, tokenizer_path()))).count() == 0


def test_sum_of_squares_rule():
    rng = np.random.default_rng(1)
    lengths, cap = rng.integers(1, 40, 400), 50
    bins, _ = packing.sum_of_squares(lengths, cap)
    gaps, opened = {}, 0
    for s, b in zip(lengths, bins, strict=True):
        count = Counter(g for g in gaps.values() if g)
        ss = lambda c: sum(v * v for v in c.values())
        options = []
        for g in [cap, *(g for g in count if g >= s)]:
            c = count.copy()
            if g != cap:
                c[g] -= 1
            if g - s:
                c[g - s] += 1
            options.append(ss(c))
        before = gaps.get(b, cap)
        c = count.copy()
        if before != cap:
            c[before] -= 1
        if before - s:
            c[before - s] += 1
        assert ss(c) == min(options)
        opened += b not in gaps
        gaps[b] = before - s


def test_token_histogram(docs, nothing):
    tok = Tokenizer.from_file(tokenizer_path())
    n = np.array([len(tok.encode(t, add_special_tokens=False).ids) for _, t in table_of(docs)])
    hist = materialize(token_hist.length_histogram(docs, tokenizer_path()))
    got = token_hist.context_totals(hist, block=8)
    for r in got.collect():
        at = r["length"]
        assert (r["documents"], r["documents_ge"], r["tokens_ge"], r["truncated_tokens"]) == ((n == at).sum(), (n >= at).sum(), n[n >= at].sum(), np.minimum(n, at).sum())
        assert math.isclose(r["share_le"], (n <= at).mean())
    assert got.count() == len(set(n))
    assert token_hist.quantile(got, 0.5).first()["length"] == np.sort(n)[math.ceil(len(n) / 2) - 1]
    assert token_hist.context_totals(token_hist.length_histogram(nothing, tokenizer_path())).count() == 0


def test_fingerprints(docs, nothing):
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")), fingerprint.sketch("text")).alias("h")).collect()
    order = sorted(rows, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    want = Counter()
    for i, r in enumerate(order):
        t, nxt = r["text"] or "", order[(i + 1) % len(order)]["text"] or ""
        m = len(t) // 3
        want[(r["doc_id"], len(t), t[: len(t) - m] + nxt[:m])] += 1
    got = fingerprint.edited_pairs(docs, buckets=7).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_text"]) for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprint.edited_pairs(nothing).count() == 0


def test_sketch_estimates(spark):
    a = " ".join(f"a{i}" for i in range(3000))
    b = " ".join([f"a{i}" for i in range(2000)] + [f"b{i}" for i in range(1000)])
    x = spark.createDataFrame([(a, b)], "a string, b string").select(fingerprint.sketch("a", 256).alias("sa"), fingerprint.sketch("b", 256).alias("sb"))
    r = x.select(
        fingerprint.resemblance("sa", "sb", 256).alias("j"), fingerprint.distinct_shingles("sa", 256).alias("n"), fingerprint.containment("sa", "sb", 256).alias("c")
    ).first()
    assert abs(r["j"] - 0.5) < 0.12 and abs(r["n"] - 2996) < 700 and abs(r["c"] - 2 / 3) < 0.2


def test_mix(docs, nothing):
    got = mixing.mix(docs).collect()
    size = lambda t: len(WORD.findall(t))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((k, size(t)) for k, t in table_of(docs))
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    total = sum(r["size"] for r in got)
    assert math.isclose(sum(rs[0]["target"] for rs in by.values()), total, rel_tol=1e-9)
    for rs in by.values():
        assert all(0 <= r["copies"] <= 3 for r in rs) and rs[0]["source_size"] == sum(r["size"] for r in rs)
        assert rs[0]["target"] <= 3 * rs[0]["source_size"] + 1e-6
        # no choice of 0..3 copies comes nearer, but for rounding the target
        sums = 1
        for r in rs:
            for _ in range(3):
                sums |= sums << r["size"]
        goal = round(rs[0]["target"])
        off = abs(sum(r["size"] * r["copies"] for r in rs) - goal)
        assert off <= max(40, min(abs(i - goal) for i in range(2 * goal + 1) if sums >> i & 1))
    assert mixing.mix(nothing).count() == 0
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)


def test_fit_counts_hits_reachable_sums():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 300, 25))
        counts = rng.integers(1, 30, len(lengths))
        whole = int((lengths * counts).sum())
        budget = int(rng.integers(0, whole + 50))
        take = mixing.fit_counts(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert abs(min(budget, whole) - (lengths * take).sum()) <= 1 + lengths.min()


def test_language_costs_are_exact():
    texts = [("x", "abracadabra abra"), ("x", "cabra"), ("y", "barbara bar"), ("y", "zzba")]
    order, rows = 3, []
    counts = {}
    for lang in "xy":
        grams = Counter()
        for _, t in (r for r in texts if r[0] == lang):
            b = t.encode()
            for d in range(1, order + 2):
                for i in range(len(b) - d + 1):
                    grams[b[i : i + d]] += 1
                    counts.setdefault((lang, b[i : i + d - 1]), Counter())[b[i + d - 1]] += 1
        for g, c in grams.items():
            code = 0
            for v in g:
                code = code * 257 + v
            rows.append((lang, len(g), code, c))

    def bits(lang, text):
        b, out = text.encode(), 0.0
        for i in range(len(b)):
            for k in range(min(order, i), -1, -1):
                c = counts.get((lang, b[i - k : i]))
                if c and b[i] in c:
                    out += math.log2((c.total() + len(c)) / c[b[i]])
                    break
                out += math.log2((c.total() + len(c)) / len(c)) if c else 0
            else:
                out += 8
        return out

    asked = ["abra bar", "", "zebra!", "cab", "qq", "bbbbarbadabra"]
    raw, off = np.frombuffer("".join(asked).encode(), np.uint8), np.cumsum([0] + [len(x) for x in asked])
    got = language.build_trees(rows, order).bits(raw, off)
    assert np.allclose(got, [[bits(lang, t) for lang in "xy"] for t in asked], atol=1e-4)


def test_language_of_rows(docs, nothing):
    trees = language.fit(docs)
    got = language.predict(docs.withColumn("score", F.lit("old")), trees)
    rows = got.collect()
    assert len(rows) == docs.count() and set(got.columns) == {*docs.columns, "lang_pred", "score"}
    for r in rows:
        known = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not known) and 0 <= r["score"] <= 1
        if r["text"] and len(r["text"]) > 60:
            assert r["lang_pred"] == r["lang"]
    assert language.predict(nothing, language.fit(nothing)).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(nothing)).collect()} == {"und"}


def test_jaccard_components(docs, nothing):
    sets = []
    for k, t in table_of(docs):
        w = WORD.findall(t.translate(LOWER))
        sets.append((k, {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()))
    comp = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b) and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {}
    for (k, _), c in zip(sets, comp, strict=True):
        least[c] = k if least.get(c) is None else least[c] if k is None else min(k, least[c])
    want = Counter((k, len(s), least[c]) for (k, s), c in zip(sets, comp, strict=True))
    got = ngram_join.jaccard_components(docs)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == want
    assert ngram_join.jaccard_components(nothing).count() == 0
    kept = ngram_join.drop_near(docs)
    assert kept.columns == docs.columns


def test_block_keys_meet_for_every_linked_pair():
    rng, ends = np.random.default_rng(5), np.array(ngram_join.bands(90, 1 << 40), np.int64)
    for n in [10, 11, 12, 19, 20, 35, 60, 200, 900]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            d = 10 * len(a) // 100
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[: len(a) - d // 2]], rng.integers(0, 1 << 63, d // 2).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 90 * (len(a) + len(b) - common):
                assert np.intersect1d(ngram_join.block_keys(a, 90, ends), ngram_join.block_keys(b, 90, ends)).size


def test_tree_search_finds_all_within_the_bound(spark):
    rng = np.random.default_rng(4)
    base = rng.poisson(2, (40, ngram_join.GROUPS))
    pts = np.concatenate([base, np.maximum(base + rng.integers(-1, 2, base.shape) * (rng.random(base.shape) < 0.02), 0)])
    rows = [(7, i, i, int(p.sum()), bytearray(p.astype("<u2").tobytes())) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "block bigint, cls bigint, comp bigint, n bigint, point binary")
    n = pts.sum(axis=1)
    want = {(i, j) for i in range(len(pts)) for j in range(i + 1, len(pts)) if np.minimum(pts[i], pts[j]).sum() >= ngram_join.enough(n[i], n[j], 90)}
    for part in (1000, 10):  # one group, and parts that meet in pairs
        assert {(r["a"], r["b"]) for r in ngram_join.tree_pairs(df, 90, part).collect()} == want


def test_quality(spark, docs, nothing):
    good = [(i, f"the cat sat on mat number {i} and looked around the house quietly", 1) for i in range(200)]
    bad = [(1000 + i, "$$$ the%%% cat### " * (5 + i % 7), 0) for i in range(60)]
    df = spark.createDataFrame(good + bad, "doc_id bigint, text string, quality int")
    feats = materialize(quality.features(df))
    model = quality.fit(feats.filter(may_learn("doc_id", 3, 1)), df.select("doc_id", "quality"))
    got = quality.predict(feats, model).join(df, "doc_id").filter(held_out("doc_id", 3, 1)).collect()
    assert all((r["score"] >= 0.5) == (r["quality"] == 1) for r in got) and len(got) > 50
    out = quality.predict(quality.features(docs), model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    none = quality.fit(feats, df.filter("false").select("doc_id", "quality"))
    assert {r["score"] for r in quality.predict(feats, none).collect()} == {0.5}
    assert quality.predict(quality.features(nothing), model).count() == 0


def test_lm_scores(docs, nothing):
    learn = may_learn("doc_id", 7, 2)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), learn.alias("l")).collect()
    toks = [(r["doc_id"], [*WORD.findall(r["t"].translate(LOWER)), ""], r["l"]) for r in rows]
    c = Counter(w for _, ws, ok in toks if ok for w in ws)
    n, v = c.total(), len(c)
    want = Counter((k, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for k, ws, _ in toks)
    got = lmscore.score(docs, learn).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    # few tokens broadcast and the filter in several passes: the same scores
    again = lmscore.score(docs, learn, frequent=5, segment_bytes=1, shard_tokens=3000).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"])
    for a, b in zip(sorted(got, key=key), sorted(again, key=key), strict=True):
        assert math.isclose(a["base_score"], b["base_score"], abs_tol=1e-6) and a["n_known"] == b["n_known"]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got + again)
    assert lmscore.score(nothing, learn).count() == 0


def test_filter_levels():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 500).astype(np.uint64))
    size = 64 * len(keys)
    bits = np.zeros(size // 8 + 1, np.uint8)
    level = np.arange(len(keys)) % 5
    for j in range(1, 5):
        for p in lmscore.probe_places(keys[level >= j], j, np.uint64(size)):
            np.bitwise_or.at(bits, (p >> np.uint64(3)).astype(np.int64), (1 << (p & np.uint64(7))).astype(np.uint8))
    got = lmscore.probed_levels(keys, np.zeros(len(keys), np.int64), bits, np.zeros(1, np.int64), np.array([size], np.uint64))
    assert (got >= level).all() and (got == level).mean() > 0.99


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a> <a href="/x">News</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice">We use cookies to improve your visit. Please accept them all now.</div><!-- <p>hidden</p> -->
<div id="content"><h1>Caf&eacute; &#8217;news&#x27;</h1><p>First   paragraph of the
article, with a <a href="/l">link</a> and <b>bold</b> text.<p>Second one &amp; more words here to read.
<ul><li>An item of the list in the article.</li></ul><form><input name=q><label>Search here</label></form></div>
<section class="comments"><h3>Comments</h3><p>I like this article very much, thank you for it.</p></section>
<aside class="sidebar">Related stories that you may like to read today.</aside><footer>&copy; 2020 Site. All rights reserved.</footer></body>"""


def test_main_text(spark):
    assert html_extract.main_text(PAGE) == (
        "Café ’news'\n\nFirst paragraph of the article, with a link and bold text.\n\nSecond one & more words here to read.\n\nAn item of the list in the article."
    )
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<nav><a href=/>Home</a></nav>") == ""
    df = spark.createDataFrame([(1, PAGE, "old"), (2, None, None)], "page_id bigint, html string, text string")
    out = html_extract.extract(df)
    assert {r["page_id"]: r["text"] for r in out.collect()}[2] == "" and out.columns.count("text") == 1
    assert html_extract.extract(df.filter("false")).count() == 0
    deep = "<article>" + "<div>" * 3000 + "Words of a deeply nested page." + "</div>" * 3000
    assert html_extract.main_text(deep) == "Words of a deeply nested page."


def test_minimum_cut_is_minimal():
    rng = np.random.default_rng(9)
    for _ in range(40):
        n = 7
        odds = rng.normal(size=n).round(2).tolist()
        edges = [(i, j, float(rng.random().__round__(2))) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4]
        cost = lambda x: sum(z for z, c in zip(odds, x, strict=True) if z > 0 and not c) + sum(-z for z, c in zip(odds, x, strict=True) if z < 0 and c) + sum(w for i, j, w in edges if x[i] != x[j])  # noqa: B023, E731
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert math.isclose(cost(html_extract.minimum_cut(odds, edges)), best, abs_tol=1e-6)


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    table.write.parquet(f"file://{tmp_path}/documents.parquet")
    at = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, at, str(tmp_path)))
        if name != "best_fit_packing":
            assert out.columns == table.columns
        kept[name], at = out, out
    ids = {r["doc_id"] for r in kept["language_id"].collect()}
    assert not ids & {104, 105, 106, 107} and {108, 111} <= ids
    once = [r["doc_id"] for r in kept["ngram_jaccard_join"].collect()]
    assert 101 in once and not {102, 103, 110} & set(once) and len(once) == len(set(once))
    assert kept["best_fit_packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048
