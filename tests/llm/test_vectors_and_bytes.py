"""Operators 11 to 13 against the tokenizer library and brute force, with nulls, ties, repeats and empty tables."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from quarry.llm import byte_bpe, centroids, whitening
from quarry.llm.common import BYTE_TOKENIZER, tokenizer_path
from quarry.llm.queries import QUERIES
from quarry.llm.vectors import LONG_MAX, as_long, integer_vectors, matrix, squares

PATH = tokenizer_path(BYTE_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.tables(byte_bpe.read_ranks(PATH))


ODD = ["a" * 5000, " " * 3000 + "x", "'" * 401 + "s", "\n" * 100, "It's they'll 'sam ''s \"'s  's \t's ' s 'l 'lll 'rre", "x " * 20_000, "﻿é́ 漢字🙂　  ²ſ'ſ", "'", " '", " 's", "\r\n\r\n a", "a\x00b"]


def test_slices_and_ids_equal_the_library(bpe, library):
    rnd = random.Random(1)
    marks = [*"aAst'rveldm 's  \n\t12.,!é漢🙂\xa0²ſß\r\x85​", "'s", "'re", "'ll", " '"]
    texts = ["".join(rnd.choices(marks, k=rnd.choice([0, 1, 2, 5, 20, 200]))) for _ in range(4000)] + ODD
    ids, at, n = byte_bpe.Merger(bpe).encode(pa.array(texts, pa.large_string()))
    ends = np.concatenate([[0], np.cumsum(n)])
    flat = bpe["bytes"].tobytes()
    for i, t in enumerate(texts):
        own = ids[ends[i] : ends[i + 1]].tolist()
        assert own == library.encode_ordinary(t)
        for j, p in zip(own, at[ends[i] : ends[i + 1]].tolist(), strict=True):  # offsets name the bytes
            token = flat[bpe["ends"][j] : bpe["ends"][j + 1]]
            assert t.encode()[p : p + len(token)] == token


def test_classes_are_those_of_the_pattern(bpe):
    # a letter that Python's own tables lack or have is judged as the library judges it
    whole = tiktoken.Encoding("letters", pat_str=r"\p{L}+", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    for c in [0x41, 0x2EBF0, 0x323B0, 0x1C89, 0x85, 0x200B, 0x345]:
        assert (bpe["classes"][c] == byte_bpe.LETTER) == bool(whole.encode_ordinary(chr(c)))


def test_scan_equals_a_walk(bpe):
    to, _ = byte_bpe.transitions()
    sym = np.random.default_rng(2).integers(0, 2 * byte_bpe.FIRST, 10_000).astype(np.uint8)
    state, want = byte_bpe.START, []
    for s in sym:
        want.append(state)
        state = to[s, state]
    for block in (2, 7, 64, 20_000):
        assert byte_bpe.scan_states(sym, bpe["monoid"], block).tolist() == want


def test_encode_and_decode(docs, nothing, spark, library):
    text = {}
    for k, t in docs.select("doc_id", "text").collect():
        text.setdefault(k, []).append(t or "")
    back = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH).collect()
    assert len(back) == docs.count()
    for r in back:
        t = text[r["doc_id"]][0]
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(t) and r["n_tokens"] == len(r["ids"]) // 4 == len(r["starts"]) // 8
        assert bytes(r["decoded"]) == t.encode()
    assert byte_bpe.encode(nothing, PATH).count() == 0
    long = spark.createDataFrame([(1, "naïve wörds, 12 " * 350_000)], "doc_id bigint, text string")  # 5.9 MB
    got = byte_bpe.decode(byte_bpe.encode(long, PATH), PATH, out="ids_text").first()
    assert bytes(got["ids_text"]).decode() == "naïve wörds, 12 " * 350_000
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(bytearray(np.array([60_000], "<u4").tobytes()),)], "ids binary"), PATH).collect()


def test_byte_query_columns(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op11_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for k, t in rows:
        ids = library.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert tuple(got[k])[1:] == want


# --- vectors ---------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, x binary, size int, k int"


def with_odd_rows(vectors):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, []), (902, [1.0] * (len(vectors[0]) - 1) + [None]), (903, [float("nan")] * len(vectors[0])), (904, [float("-inf")] + [0.0] * (len(vectors[0]) - 1)), (905, [1.0, 2.0])]
    rows += [rows[3], rows[3], (3, rows[4][1]), (None, rows[5][1])]  # repeated row, repeated key, null key
    return [(*r, 1, b"", 2, 3) for r in rows]


def kept(rows, size):
    return [(k, [int(np.floor(256 * np.float64(np.float32(c)))) for c in v]) for k, v, *_ in rows if v and len(v) == size and all(c is not None and np.isfinite(c) for c in v)]


def test_integer_vectors_pack_and_saturate(spark):
    df = spark.createDataFrame([(1, [-0.5, 127.99]), (2, [1e30, -1e30]), (3, [200.0, 1e6]), (4, [-128.0, 0.0])], "vec_id bigint, embedding array<float>")
    got = {r["vec_id"]: bytes(r["x"]) for r in integer_vectors(df, "vec_id", "embedding").collect()}
    assert [len(got[i]) for i in (1, 2, 3, 4)] == [4, 16, 8, 4]
    assert matrix(pa.array([got[i] for i in (1, 2, 3, 4)]), 2).tolist() == [[-128, 32765], [LONG_MAX, -LONG_MAX - 1], [51200, 256_000_000], [-32768, 0]]


def test_squares_are_exact_at_every_size():
    rng = np.random.default_rng(0)
    for bound in (1 << 20, (1 << 46), (1 << 62)):
        d = rng.integers(-bound, bound, (5, 64))
        want = [sum(int(c) ** 2 for c in row) for row in d]
        got = squares(d, bound)
        assert [int(g) for g in got] == want and as_long(got).to_pylist() == [min(w, LONG_MAX) for w in want]


def lloyd(rows, k, rounds, seed=2):
    """Brute force in Python integers: centroid numbers, distances, centroids."""
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i2").tobytes()))
    centroids_ = [list(v) for _, v in order[:k]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids_]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)

    for _ in range(rounds):
        own = [nearest(v)[0] for _, v in rows]
        for j in range(len(centroids_)):
            members = [v for (_, v), o in zip(rows, own, strict=True) if o == j]
            if members:
                centroids_[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    return [nearest(v) for _, v in rows], centroids_


@pytest.mark.parametrize(("size", "k", "spread"), [(8, 5, 1.0), (8, 40, 0.05), (16, 7, 3.0)])
def test_clusters_equal_brute_force(spark, size, k, spread):
    rng = np.random.default_rng(size + k)
    vectors = rng.normal(size=(4, size))[rng.integers(0, 4, 150)] + spread * rng.normal(size=(150, size)).round(1)
    vectors[20:40] = vectors[20]  # ties
    rows = with_odd_rows(vectors)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    mine = kept(rows, size)
    want, final = lloyd(mine, k, 3)
    for pivots in (1, 4, 56):
        got, c = centroids.cluster(df, size=size, k=k, rounds=3, pivots=pivots)
        assert c.tolist() == final
        out = [(r["vec_id"], r["cluster"], r["distance"]) for r in got.collect()]
        assert sorted(out, key=repr) == sorted([(i, *w) for (i, _), w in zip(mine, want, strict=True)], key=repr)
    total = centroids.with_totals(got, c).collect()
    sums = {}
    for _, j, d in out:
        sums[j] = sums.get(j, 0) + d
    for r in total:
        assert r["cluster_inertia"] == sums[r["cluster"]] and r["inertia"] == sum(sums.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, final[r["cluster"]])).encode()).hexdigest()


def test_bounds_keep_the_nearest_and_prune():
    rng = np.random.default_rng(5)
    x = rng.integers(-100, 100, (2000, 64))
    c = x[:40]
    d = ((x[:, None] - c) ** 2).sum(axis=2)
    left = []
    for pivots in (2, 16, 64):
        used, base = centroids.simplex(x[100 : 100 + pivots])
        p = x[100:][used].astype(float)
        near = centroids.Nearest(c, p, base)
        found = near.candidates(centroids.apexes(centroids.distances(x.astype(float), p), base))
        assert found[np.arange(len(x)), d.argmin(axis=1)].all()
        left.append(found.mean())
    assert left[0] >= left[1] > left[2] and left[2] < 0.1


def test_no_vectors_and_huge_ones(spark):
    none = spark.createDataFrame([(1, None, 1, b"", 2, 3)], VECTORS)
    got, c = centroids.cluster(none, size=4)
    assert got.count() == 0 and centroids.with_totals(got, c).count() == 0
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    got, _ = centroids.cluster(huge, size=2, k=1, rounds=1)
    assert max(r["distance"] for r in got.collect()) == LONG_MAX
    v, size = whitening.vectors_of(none)
    assert whitening.whiten(v, size, whitening.fit(v, size)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(v, size, None).count() == 0
    v, size = whitening.vectors_of(huge)
    assert whitening.whiten(v, size, whitening.fit(v, size)).filter(f"deviation = {LONG_MAX}").count() > 0


# --- whitening -------------------------------------------------------------


def scatter(x):
    a = x - x.mean(axis=0)
    return a.T @ a


@pytest.mark.parametrize("chains", [1, 3])
def test_rank_one_updates_equal_the_scatter(chains):
    rng = np.random.default_rng(chains)
    cases = [rng.integers(-50, 50, (300, 12)), np.ones((7, 5)), np.eye(6)[rng.integers(0, 6, 90)] * 3, rng.integers(-9, 9, (4, 10)), rng.integers(-99, 99, (60, 1)) * np.arange(5), rng.normal(size=(80, 6)) * 10.0 ** np.arange(6)]
    for x in cases:
        s = whitening.Spectra(chains, x.shape[1])
        for i in range(0, len(x), chains):
            s.add(x[i : i + chains].astype(float))
        s.fold()
        want, v = scatter(x.astype(float)), s.vector[0]
        top = max(np.linalg.eigvalsh(want)[-1], 1e-9)
        assert s.n[0] == len(x) and np.allclose(s.mean[0], x.mean(axis=0))
        assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-12  # orthogonal after every update
        assert np.abs((v * s.value[0]) @ v.T - want).max() < 1e-12 * top
        assert (np.diff(s.value[0]) >= 0).all()


def test_spectra_of_parts_combine():
    x = np.random.default_rng(3).integers(-40, 40, (200, 9)).astype(float)
    parts = []
    for part in np.split(x, [50, 51, 120]):
        s = whitening.Spectra(1, 9)
        for row in part:
            s.add(row[None])
        parts.append(s)
    for other in parts[1:]:
        parts[0].merge(other)
    assert np.abs((parts[0].vector[0] * parts[0].value[0]) @ parts[0].vector[0].T - scatter(x)).max() < 1e-9


def test_whitened_rows_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TASK_ROWS", 20)  # more tasks than one group of spectra takes
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(250, 10)) * np.linspace(0.2, 2, 10)
    rows = with_odd_rows(vectors)
    v, size = whitening.vectors_of(spark.createDataFrame(rows, VECTORS).repartition(5))
    got = whitening.whiten(v, size, whitening.fit(v, size)).toPandas()
    mine = kept(rows, 10)
    fit = np.array(sorted({tuple(x) for _, x in mine}), float)
    n, s = len(fit), [int(t) for t in fit.sum(axis=0)]
    e, u = np.linalg.eigh(scatter(fit) / n)
    e, u = e[::-1], u[:, ::-1]
    assert size == 10 and len(got) == 4 * len(mine) and (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    side = {}
    for k, x in mine:
        own = got[got.vec_id.isna() if k is None else got.vec_id == k]
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        own = own[own.deviation == dev]
        assert len(own) >= 4
        for c in range(4):
            want = (np.array(x) - fit.mean(axis=0)) @ u[:, c] / np.sqrt(e[c])
            y = own[own.component == c + 1]
            side.setdefault(c, np.sign(y.whitened.iloc[0] * want))
            assert np.abs(y.whitened * side[c] - want).max() < 1e-9
            assert np.abs(y.explained - e[c] / e.sum()).max() < 1e-12


def test_flat_directions_are_zero(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 1.0, 2.0]) for i in range(9)], "vec_id bigint, embedding array<float>")
    v, size = whitening.vectors_of(df)
    got = whitening.whiten(v, size, whitening.fit(v, size)).toPandas()
    assert (got.n == 3).all() and len(got) == 27 and got.identity_error.max() < 1e-9
    flat = got[got.component > 1]
    assert (flat.whitened == 0).all() and (flat.explained == 0).all()
    assert np.allclose(sorted(got[got.component == 1].whitened.abs().round(9).unique()), [0, np.sqrt(1.5)])


def test_vector_queries_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    mine = kept([(r[0], r[1]) for r in rows], 64)
    x = np.array([v for _, v in mine])
    got = QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001").toPandas()
    e = np.linalg.eigvalsh(np.cov(np.unique(x, axis=0).T, bias=True))[::-1]
    assert len(got) == 4 * len(mine) and got.identity_error.max() < 1e-9
    assert np.allclose(sorted(got.explained.unique(), reverse=True), e[:4] / e.sum(), rtol=1e-9)
    out = QUERIES["op12_centroid_clusters"](spark, "/root/testdata/sf0.001").collect()
    want, _ = lloyd(mine, 40, 5)
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in out) == sorted((k, *w) for (k, _), w in zip(mine, want, strict=True))
