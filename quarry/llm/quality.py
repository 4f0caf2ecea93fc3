"""Quality classifier: a generalised additive model with pairwise interactions (operator 9).

Features of a text are binned; cyclic boosting visits them in turn and adds a
shallow tree on one feature's bins, then on the bins of the best pairs. The
trees are summed into one look-up table per feature and pair, so a score is a
few additions of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bytes_of, rebuilt, text_slices

FEATURES = (
    "log_bytes", "log_words", "mean_word", "upper", "digit", "symbol", "bar", "stop_mark", "space",
    "newline", "letter", "capital_words", "marked_words", "repeated_next", "distinct_words", "wide_bytes",
)


def byte_classes():
    """A row of class flags per byte value."""
    import numpy as np

    v = np.arange(256)
    is_in = lambda s: np.isin(v, list(s))
    return {
        "upper": (v >= 65) & (v <= 90),
        "digit": (v >= 48) & (v <= 57),
        "symbol": is_in(b"#$%&*!@^~=+<>{}[]\\/_`"),
        "bar": v == 124,
        "stop_mark": is_in(b".,;:?"),
        "space": (v == 32) | ((v >= 9) & (v <= 13)),
        "newline": v == 10,
        "letter": ((v >= 65) & (v <= 90)) | ((v >= 97) & (v <= 122)) | (v >= 128),
        "wide_bytes": v >= 128,
    }


def feature_matrix(texts):
    """(texts, features) float64 of an Arrow string array without nulls; every whole text."""
    import numpy as np
    import pyarrow.compute as pc

    raw, off = bytes_of(texts)
    n = np.diff(off)
    full = n > 0
    starts = off[:-1][full]

    def total(flags):
        out = np.zeros(len(n))
        if len(raw):
            out[full] = np.add.reduceat(flags, starts, dtype=np.int64)
        return out

    got = {k: total(c[raw]) / np.maximum(n, 1) for k, c in byte_classes().items()}
    lists = pc.ascii_split_whitespace(texts)
    enc = lists.flatten().dictionary_encode()
    words = enc.dictionary
    w_off = lists.offsets.to_numpy().astype(np.int64)
    w_off = w_off - w_off[0]
    at = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False)
    real = size[at] > 0
    before = np.concatenate([[0], np.cumsum(real)])
    w_off, at = before[w_off], at[real]
    count = np.diff(w_off)
    some = count > 0
    own = np.repeat(np.arange(len(count)), count)

    def per_word(x):
        return np.bincount(own, weights=x, minlength=len(count)) / np.maximum(count, 1)

    flag = lambda p: pc.match_substring_regex(words, p).to_numpy(zero_copy_only=False)
    same = np.zeros(len(at))
    if len(at) > 1:
        same[1:] = (at[1:] == at[:-1]) & (own[1:] == own[:-1])
    pairs = np.unique(own * max(1, len(words)) + at)
    distinct = np.bincount(pairs // max(1, len(words)), minlength=len(count)) if len(pairs) else np.zeros(len(count))
    # long texts repeat words anyway: distinct words against a power of the count
    got |= {
        "log_bytes": np.log1p(n),
        "log_words": np.log1p(count),
        "mean_word": per_word(size[at]),
        "capital_words": per_word(flag("^[A-Z]{2,}")[at]),
        "marked_words": per_word(flag("[^A-Za-z0-9.,;:?\\x{80}-\\x{10ffff}]{2,}$")[at]),
        "repeated_next": per_word(same),
        "distinct_words": np.where(some, distinct / np.maximum(count, 1) ** 0.85, 1.0),
    }
    return np.column_stack([got[f] for f in FEATURES])


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x): x the features of every whole text as array<double>; null is empty."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            got = [feature_matrix(part) for _, part in text_slices(b.column(1))]
            x = np.concatenate(got) if got else np.zeros((0, len(FEATURES)))
            off = np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(x.ravel()))], ["k", "x"])

    src = docs.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return src.mapInArrow(run, "k bigint, x array<double>").withColumnRenamed("k", key)


class AdditiveModel:
    """Look-up tables per feature and per pair of features; log-odds are their sum."""

    def __init__(self, edges, base, tables, pairs):
        self.edges, self.base, self.tables, self.pairs = edges, base, tables, pairs

    def bins(self, x):
        import numpy as np

        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def score(self, x):
        """Probability of label 1 for each row of features."""
        import numpy as np

        b = self.bins(x)
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for i, j, t in self.pairs:
            z += t[b[:, i], b[:, j]]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def best_split(g, h, lo: int, hi: int):
    """(gain, cut) of the best two-way split of bins lo..hi by second-order gain."""
    import numpy as np

    if hi - lo < 2:
        return 0.0, lo
    cg, ch = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    tg, th = g[lo:hi].sum(), h[lo:hi].sum()
    gain = cg**2 / (ch + 1) + (tg - cg) ** 2 / (th - ch + 1) - tg**2 / (th + 1)
    k = int(gain.argmax())
    return float(gain[k]), lo + k + 1


def shallow_tree(g, h, leaves: int = 4):
    """Leaf values per bin of a greedy tree on one feature."""
    import numpy as np

    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*best_split(g, h, *p), p) for p in parts]
        gain, cut, p = max(found, key=lambda f: f[0])
        if gain <= 1e-9:
            break
        parts.remove(p)
        parts += [(p[0], cut), (cut, p[1])]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return out


def fit_model(x, y, max_bins: int = 24, rounds: int = 120, pairs: int = 5, pair_rounds: int = 40, rate: float = 0.2) -> AdditiveModel:
    """Cyclic boosting on features ``x`` with labels ``y`` (0/1); classes weigh alike."""
    import numpy as np

    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return AdditiveModel([np.zeros(0)] * x.shape[1], float(np.log(p / (1 - p))), [np.zeros(1)] * x.shape[1], [])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, max_bins + 1)[1:-1])) for j in range(x.shape[1])]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    m = AdditiveModel(edges, 0.0, [np.zeros(len(e) + 1) for e in edges], [])
    b = m.bins(x)
    z = np.zeros(len(y))

    def slope():
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(m.tables):
            g, h = slope()
            leaf = rate * shallow_tree(np.bincount(b[:, j], g, len(t)), np.bincount(b[:, j], h, len(t)))
            t += leaf
            z += leaf[b[:, j]]
    # pairs by what a 2 x 2 split of the remaining slope gains
    g, h = slope()
    found = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            a, c = b[:, i] >= np.median(b[:, i]), b[:, j] >= np.median(b[:, j])
            q = 2 * a + c
            found.append((float((np.bincount(q, g, 4) ** 2 / (np.bincount(q, h, 4) + 1)).sum()), i, j))
    for _, i, j in sorted(found, reverse=True)[:pairs]:
        m.pairs.append((i, j, np.zeros((len(m.tables[i]), len(m.tables[j])))))
    for _ in range(pair_rounds):
        for i, j, t in m.pairs:
            g, h = slope()
            gi, hi = np.bincount(b[:, i], g, t.shape[0]), np.bincount(b[:, i], h, t.shape[0])
            cut = best_split(gi, hi, 0, t.shape[0])[1]
            leaf = np.zeros_like(t)
            low = b[:, i] < cut
            for side, rows in ((low, slice(0, cut)), (~low, slice(cut, None))):
                leaf[rows] = rate * shallow_tree(np.bincount(b[side, j], g[side], t.shape[1]), np.bincount(b[side, j], h[side], t.shape[1]), 2)
            t += leaf
            z += leaf[b[:, i], b[:, j]]
    return m


def fit(feats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_rows: int = 20_000) -> AdditiveModel:
    """Model from at most ``max_rows`` labelled rows, the first by a hash of their key.

    Labels other than 0 and 1 teach nothing; a key labelled both ways teaches
    both. Without rows of both labels the score is one constant.
    """
    import numpy as np

    lab = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.col(label).cast("int").alias("y"))
    # threshold by the share of rows wanted, so no sort of all labels; the cut is by hash, the same in every run
    n = lab.count()
    if n > max_rows:
        lab = lab.filter(F.pmod(F.xxhash64("_k"), F.lit(1 << 30)) < int(0.9 * max_rows / n * (1 << 30)))
    # keys that repeat can pass the bound: the first rows by hash and values, whatever order they come in
    got = feats.join(lab, feats[key] == lab["_k"]).orderBy(F.xxhash64("_k"), "_k", "y", "x").select("x", "y").limit(max_rows).toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit_model(x, np.array(got.column("y").to_pylist(), float))


def predict(feats: DataFrame, model: AdditiveModel, key: str = "doc_id") -> DataFrame:
    """(key, score): probability of label 1 for every row of features."""
    held = feats.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        m = rebuilt(AdditiveModel, held.value)
        for b in batches:
            x = np.asarray(b.column(1).flatten(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.score(x))], ["k", "score"])

    return feats.select(F.col(key).alias("k"), "x").mapInArrow(run, "k bigint, score double").withColumnRenamed("k", key)
