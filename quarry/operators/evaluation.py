"""Evaluation metrics (E1-E17) as Spark jobs.

* Perplexity: token-weighted loss aggregates; the default scorer is an
  additive-smoothed unigram model fitted on the train split (E4), a Spark
  re-aim of a GPU forward pass. Its numbers are not comparable with a
  neural model's; the aggregation (E1-E3) is the same for any scorer.
* Semantic entropy: responses are grouped per prompt, linked when their
  cosine similarity exceeds a threshold, clustered by connected components
  (transitive closure) and scored by the entropy of cluster sizes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import strip_space
from quarry.operators import tokens as TK
from quarry.operators.clean import bind
from quarry.operators.joins import HOT_ROWS, hot_join, salted_join


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    return strip_space(c)


# ------------------------------------------------------------------ E1-E3
def pad_labels(ids: Column | str, max_length: int) -> Column:
    """Truncate to ``max_length`` and pad with the padding label (-100)."""
    t = F.slice(_c(ids), 1, max_length)
    pad = F.array_repeat(F.lit(fixed.PADDING_LABEL), F.greatest(F.lit(max_length) - F.size(t), F.lit(0)))
    return F.concat(t, pad)


def nonpad_tokens(labels: Column | str) -> Column:
    """Number of labels that are not padding."""
    return F.size(F.filter(_c(labels), lambda x: x != fixed.PADDING_LABEL)).cast("bigint")


def weighted_loss(df: DataFrame, loss: str = "loss", n: str = "n_tokens") -> DataFrame:
    """E2 + E3: token-weighted mean loss, perplexity and token total (one row)."""
    total = F.sum(n)
    avg = F.sum(F.col(loss) * F.col(n)) / F.nullif(total, F.lit(0))
    return df.agg(avg.alias("avg_loss"), total.cast("bigint").alias("total_tokens")).select(
        F.exp("avg_loss").alias("perplexity"), "avg_loss", "total_tokens"
    )


# --------------------------------------------------------------------- E4
def token_counts(docs: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys..., tok, k): lower-cased native tokens counted per document."""
    toks = docs.select(*keys, F.explode(TK.tokens(text, lower=True)).alias("tok"))
    return toks.groupBy(*keys, "tok").agg(F.count(F.lit(1)).alias("k"))


def unigram_doc_losses(
    docs: DataFrame,
    key: str,
    text: str,
    split_col: str = "split",
    alphas: Sequence[float] = (1.0,),
    train: str = "train",
    evaluate: str = "eval",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per-document mean negative log-likelihood under add-alpha unigrams
    fitted on the ``train`` rows, for the ``evaluate`` rows.

    ``p(t) = (c_t + a) / (N + a V)`` with ``V`` = train vocabulary + 1
    (unknown). Returns ``key, n_tokens, loss`` (first alpha) plus ``loss_<i>``
    for every alpha. Texts are tokenised once into per-document token counts
    (written at a phase boundary); in the join with the vocabulary, tokens of
    very many documents are split by their counts.
    """
    from quarry.session import materialize

    # one tokenisation: train tokens are counted per token only, eval tokens per document
    is_train = F.col(split_col) == train
    scoped = docs.filter(is_train | (F.col(split_col) == evaluate)).select(
        F.when(is_train, F.lit(None)).otherwise(F.col(key)).alias(key), split_col, text
    )
    counts = materialize(token_counts(scoped, [key, split_col], text))
    vocab = counts.filter(F.col(split_col) == train).groupBy("tok").agg(F.sum("k").alias("c"))
    consts = vocab.agg(F.sum("c").alias("N"), (F.count(F.lit(1)) + 1).alias("V")).first()
    n_all, v_all = float(consts["N"] or 0), float(consts["V"])
    ev = counts.filter(F.col(split_col) == evaluate).select(key, "tok", "k")
    j = hot_join(ev, vocab, ["tok"], "left", hot_rows)
    c = F.coalesce(F.col("c"), F.lit(0)).cast("double")
    aggs = [F.sum("k").alias("n_tokens")]
    for i, a in enumerate(alphas):
        nll = -F.log((c + F.lit(a)) / F.lit(n_all + a * v_all))
        aggs.append((F.sum(F.col("k") * nll) / F.sum("k")).alias(f"loss_{i}"))
    out = j.groupBy(key).agg(*aggs).withColumn("n_tokens", F.col("n_tokens").cast("bigint"))
    return out.withColumn("loss", F.col("loss_0"))


#: Fills the places before a text's first token; no token is a control character.
START = "\x02"
DISCOUNT = 0.75


def grams(docs: DataFrame, keys: Sequence[str], text: str, order: int) -> DataFrame:
    """(keys..., w0 .. w<order-1>): every token with the order - 1 before it, each as its 64-bit hash."""
    x = docs.select(*keys, F.transform(TK.tokens(text, lower=True), lambda t: F.xxhash64(t)).alias("_t"))

    def gram(t: Column, i: Column) -> Column:
        before = [F.coalesce(F.get("_t", i - j), F.xxhash64(F.lit(START))).alias(f"w{order - 1 - j}") for j in range(order - 1, 0, -1)]
        return F.struct(*before, t.alias(f"w{order - 1}"))

    return x.select(*keys, F.inline(F.transform("_t", gram)))


def ngram_doc_losses(
    docs: DataFrame,
    key: str,
    text: str,
    order: int = 2,
    discount: float = DISCOUNT,
    split_col: str = "split",
    train: str = "train",
    evaluate: str = "eval",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """E4 of order n: (key, n_tokens, loss) of the ``evaluate`` rows under an interpolated back-off model of the ``train`` rows.

    At the highest order an n-gram's count is what it occurs, below it the
    number of different tokens before it (continuation count). With ``c`` the
    count, ``h`` the sum and ``t`` the number of n-grams with the same history,
    ``p(w | history) = max(c - D, 0) / h + D t / h * p(w | shorter history)``; an
    unknown history leaves its place to the shorter one, and the lowest order
    goes over into ``1 / (V + 1)``, V being the train vocabulary.

    Tokens are told apart by their 64-bit hashes. One table of n-grams per order
    holds the counts of the ``train`` rows and which n-grams the ``evaluate``
    rows ask for; each shorter order is counted from the longer one's table.
    Only n-grams and histories that are asked for are joined, order by order, and
    the highest order's probabilities then meet the documents. Histories and
    n-grams with very many rows are split by their counts. Without train tokens
    p is 1; texts without tokens have no row.
    """
    from quarry.session import materialize, release

    w = [f"w{j}" for j in range(order)]
    ev = materialize(grams(docs.filter(F.col(split_col) == evaluate), [key], text, order), "grams-asked")
    train = grams(docs.filter(F.col(split_col) == train), [], text, order)
    seen = train.select(*w, F.lit(1).alias("k"), F.lit(False).alias("a")).unionByName(ev.select(*w, F.lit(0).alias("k"), F.lit(True).alias("a")))
    table = materialize(seen.groupBy(*w).agg(F.sum("k").alias("c"), F.max("a").alias("a")), "gram-counts")
    # tables of each order, the highest first: n-gram (its last n tokens), c (0: not in train), whether it is asked for
    tables = [(w, table)]
    for n in range(order - 1, 0, -1):  # continuation counts: different tokens in the place before, the start mark among them
        own = w[order - n :]
        table = materialize(table.groupBy(*own).agg(F.count_if(F.col("c") > 0).alias("c"), F.max("a").alias("a")), "gram-continuations")
        tables.append((own, table))
    low = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("h"), F.count_if(F.col("c") > 0).alias("t")).first()
    d, lower = F.lit(float(discount)), None
    for own, table in reversed(tables):
        x = table.filter("a").select(*own, "c")
        if lower is None:
            x = x.withColumn("h", F.lit(low["h"])).withColumn("t", F.lit(low["t"])).withColumn("_low", F.lit(1.0 / (low["t"] + 1)))
        else:
            hist = table.groupBy(*own[:-1]).agg(F.sum("c").alias("h"), F.count_if(F.col("c") > 0).alias("t"), F.max("a").alias("a")).filter("a").drop("a")
            x = materialize(hot_join(x, hist, own[:-1], "inner", hot_rows), "gram-histories")
            x = hot_join(x, lower.withColumnRenamed("p", "_low"), own[1:], "inner", hot_rows)
        h = F.nullif(F.col("h").cast("double"), F.lit(0.0))
        here = F.greatest(F.col("c") - d, F.lit(0.0)) / h + d * F.col("t") / h * F.col("_low")
        lower = materialize(x.select(*own, F.coalesce(here, "_low").alias("p")), "gram-probabilities")
    release(*(t for _, t in tables))
    j = hot_join(ev, lower, w, "inner", hot_rows)
    nll = -F.log("p")
    return j.groupBy(key).agg(F.count(F.lit(1)).alias("n_tokens"), F.avg(nll).alias("loss"))


# ------------------------------------------------------------------ E6-E10
EDGE_SCHEMA = "grp bigint, a bigint, b bigint, cos double"


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace a set of links by one star per connected component, centred
    on the component's smallest id (union-find over the ids of one task)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:  # path compression
            parent[x], x = root, parent[x]
        return root

    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
    members = [v for v in parent]
    roots = [find(v) for v in members]
    centre = np.asarray(roots, dtype=np.int64)
    leaf = np.asarray(members, dtype=np.int64)
    keep = leaf != centre
    return centre[keep], leaf[keep]


def _block_kernel(threshold: float, eps: float, contract: bool):
    def one(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lo, hi = int(pdf["_lo"].iloc[0]), int(pdf["_hi"].iloc[0])
        a_side = pdf[pdf["_blk"] == lo]
        b_side = pdf[pdf["_blk"] == hi] if hi != lo else a_side
        if a_side.empty or b_side.empty:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        xa = np.stack([np.asarray(v, dtype=np.float64) for v in a_side["vec"]])
        xb = np.stack([np.asarray(v, dtype=np.float64) for v in b_side["vec"]])
        na = np.sqrt((xa * xa).sum(axis=1))
        nb = np.sqrt((xb * xb).sum(axis=1))
        cos = (xa @ xb.T) / np.maximum(np.outer(na, nb), eps)
        ra = a_side["rid"].to_numpy(dtype=np.int64)
        rb = b_side["rid"].to_numpy(dtype=np.int64)
        mask = cos > threshold
        if hi == lo:
            mask &= ra[:, None] < rb[None, :]
        i, j = np.nonzero(mask)
        x, y = ra[i], rb[j]
        a, b, c = np.minimum(x, y), np.maximum(x, y), cos[i, j]
        if contract:
            a, b = _stars(a, b)
            c = np.full(len(a), np.nan)
        return a, b, c

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        # one call holds either one block pair of a large prompt or many
        # whole small prompts; pairs never cross prompts
        out = []
        for grp, part in pdf.groupby("grp", sort=False):
            a, b, c = one(part)
            if len(a):
                out.append(pd.DataFrame({"grp": np.full(len(a), int(grp), dtype=np.int64), "a": a, "b": b, "cos": c}))
        if not out:
            return pd.DataFrame({"grp": [], "a": [], "b": [], "cos": []}).astype(
                {"grp": "int64", "a": "int64", "b": "int64", "cos": "float64"}
            )
        return pd.concat(out, ignore_index=True)

    return kernel


def kernel_rows(
    resp: DataFrame,
    grp: str = "grp",
    rid: str = "rid",
    vec: str = "embedding",
    block: int = 256,
    salts: int = 8,
    pack_vectors: int = 4096,
) -> DataFrame:
    """Rows of the similarity kernel, one group per (_pk, _lo, _hi).

    A prompt of more than ``block`` responses gets one group per pair of its
    blocks. Smaller prompts share groups; how many groups there are follows
    from the counted sizes, so that one holds about ``pack_vectors`` vectors
    at any number of prompts.
    """
    r = resp.select(F.col(grp).alias("grp"), F.col(rid).cast("bigint").alias("rid"), F.col(vec).alias("vec"))
    r = r.filter(F.col("rid").isNotNull() & F.col("vec").isNotNull())  # without a vector a response has no link
    sizes = r.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    small = sizes.filter(F.col("_n") <= block).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_t"))
    least = r.sparkSession.sparkContext.defaultParallelism * 4  # small inputs still use every core
    packs = F.greatest(F.lit(least).cast("bigint"), F.ceil(small.scalar() / F.lit(pack_vectors)))
    nblk = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(block))).cast("int")
    x = salted_join(r, sizes, ["grp"], salts, F.xxhash64("rid"), how="inner")
    x = x.withColumn("_nb", nblk).withColumn("_blk", F.pmod(F.xxhash64("rid"), F.col("_nb")).cast("int"))
    x = x.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    x = x.withColumn("_lo", F.least("_blk", "_j")).withColumn("_hi", F.greatest("_blk", "_j"))
    pack = F.when(F.col("_nb") == 1, -1 - F.pmod(F.xxhash64("grp"), packs)).otherwise(F.col("grp"))
    return x.select("grp", "rid", "vec", "_blk", "_lo", "_hi", pack.alias("_pk"))


def similarity_edges(
    resp: DataFrame,
    threshold: float = fixed.ENTAILMENT_THRESHOLD,
    grp: str = "grp",
    rid: str = "rid",
    vec: str = "embedding",
    block: int = 256,
    salts: int = 8,
    contract: bool = False,
    pack_vectors: int = 4096,
) -> DataFrame:
    """Pairs of responses of one prompt with cosine > ``threshold``.

    Every pair of a prompt is compared (the metric's definition), but pairs
    are never materialised as rows: the prompt's responses are hashed into
    blocks of about ``block`` vectors and each pair of blocks is one group
    of a vectorised kernel (numpy matrix product, Arrow batches) that emits
    only the linked pairs. A prompt with many responses is thus spread over
    many tasks, each holding at most two blocks. Cosine is computed in
    double with the norm product clamped at 1e-8 (zero vectors never link
    for a non-negative threshold).

    With ``contract=True`` each task replaces its links by one star per
    local connected component (same connectivity, far fewer edges; cos is
    then null). Clustering uses this form: when a prompt fits in one block,
    its components are already complete.
    """
    x = kernel_rows(resp, grp, rid, vec, block, salts, pack_vectors)
    return x.groupBy("_pk", "_lo", "_hi").applyInPandas(_block_kernel(threshold, fixed.COSINE_EPS, contract), EDGE_SCHEMA)


def connected_components(vertices: DataFrame, edges: DataFrame, rid: str = "rid", salts: int = 8, grp: str = "grp") -> DataFrame:
    """``(rid, cluster)`` with cluster = smallest member id of the
    connected component (transitive closure of the links). Where both
    tables have ``grp``, ids count within their group only.

    Min-label propagation with pointer jumping: each round every vertex
    takes the smallest label among itself and its neighbours (a partial
    aggregate, so a hub vertex is no hot task) and then the label of that
    label, which roughly halves the remaining distance to the component's
    smallest id. Rounds repeat until no label changes (no cap). Each
    round's labels are checkpointed to the shared folder, which cuts the
    lineage and survives executor loss. Only vertices with edges take part;
    the others are their own cluster.
    """
    from quarry.session import materialize, release

    # the edge list is read every round: compute it once
    keyed = grp in edges.columns and grp in vertices.columns

    def node(c: str) -> Column:
        r = F.col(c).cast("bigint")
        return F.struct(F.col(grp).alias("g"), r.alias("r")) if keyed else r

    e = materialize(edges.select(node("a").alias("a"), node("b").alias("b")), "cc-edges")
    if e.isEmpty():  # no links: every response is its own cluster
        return vertices.withColumn("cluster", F.col(rid))
    und = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = und.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("cl")).withColumnRenamed("a", "v")
    def step(lab: DataFrame) -> DataFrame:
        # a hub vertex has many edges: salt its edge rows
        sent = salted_join(und, lab.withColumnRenamed("v", "a"), ["a"], salts, F.xxhash64("b"), how="inner")
        m = lab.unionByName(sent.select(F.col("b").alias("v"), "cl")).groupBy("v").agg(F.min("cl").alias("cl"))
        # a giant component shares one label: salt the vertices that point to it
        parent = m.select(F.col("v").alias("cl"), F.col("cl").alias("pcl"))
        return salted_join(m, parent, ["cl"], salts, F.xxhash64("v"), how="inner").select(
            "v", F.least(F.col("cl"), F.col("pcl")).alias("cl")
        )

    done = None
    while True:  # two propagate-and-jump steps per written round; ends when nothing changes
        nxt = step(step(labels))
        new = materialize(
            nxt.join(labels.withColumnRenamed("cl", "_old"), "v").withColumn("_chg", F.col("cl") != F.col("_old")).drop("_old"),
            "cc-labels",
        )
        if done is not None:
            release(done, sweep=False)
        done, labels = new, new.select("v", "cl")
        if new.filter("_chg").isEmpty():
            break
    release(e, sweep=False)
    out = vertices.withColumn("_node", node(rid)).join(labels, F.col("_node") == F.col("v"), "left")
    found = F.col("cl.r") if keyed else F.col("cl")
    return out.select(*vertices.columns, F.coalesce(found, F.col(rid)).alias("cluster"))


def cluster_sizes(clustered: DataFrame, grp: str = "grp") -> DataFrame:
    """Members per (prompt, cluster)."""
    return clustered.groupBy(grp, "cluster").agg(F.count(F.lit(1)).alias("size"))


def semantic_entropy(clustered: DataFrame, grp: str = "grp") -> DataFrame:
    """``-sum p ln p`` over a prompt's cluster sizes (natural log).

    Computed as ``0.0 - sum`` so that a single cluster gives +0.0. Rows
    without a prompt count as one prompt.
    """
    sizes = cluster_sizes(clustered, grp).withColumn("_g", F.struct(grp))  # a struct is equal to itself with a null inside
    totals = sizes.groupBy("_g").agg(F.sum("size").alias("_tot"))  # no per-prompt window: a prompt may have many clusters
    p = salted_join(sizes, totals, ["_g"], 8, F.xxhash64("cluster"), how="inner").withColumn("p", F.col("size") / F.col("_tot"))
    return p.groupBy(grp).agg(
        (F.lit(0.0) - F.sum(F.col("p") * F.log("p"))).alias("entropy"),
        F.sum("size").cast("bigint").alias("n_responses"),
    )


def entropy_summary(entropies: DataFrame) -> DataFrame:
    """Prompts, samples per prompt (largest), mean/max/min entropy (0 when empty)."""
    return entropies.agg(
        F.count(F.lit(1)).alias("prompts_evaluated"),
        F.coalesce(F.max("n_responses"), F.lit(0)).cast("bigint").alias("samples_per_prompt"),
        F.coalesce(F.avg("entropy"), F.lit(0.0)).alias("mean_entropy"),
        F.coalesce(F.max("entropy"), F.lit(0.0)).alias("max_entropy"),
        F.coalesce(F.min("entropy"), F.lit(0.0)).alias("min_entropy"),
    )


def entropy_by_prompt(resp: DataFrame, threshold: float = fixed.ENTAILMENT_THRESHOLD, **kw) -> DataFrame:
    """E6 -> E7 -> E9 for a response table ``(grp, rid, embedding)``."""
    edges = similarity_edges(resp, threshold, contract=True, **kw)
    clustered = connected_components(resp.select("grp", "rid"), edges)
    return semantic_entropy(clustered)


# ---------------------------------------------------------------- E11-E13
SPECIAL_TOKENS = (fixed.IM_START, fixed.IM_END)


def decode_without_special(c: Column | str) -> Column:
    """Text as a tokenizer decodes it with special tokens skipped."""
    out = _c(c)
    for tok in SPECIAL_TOKENS:
        out = F.replace(out, F.lit(tok), F.lit(""))
    return out


def strip_prompt(output: Column | str, prompt: Column | str, mode: str = "decoded") -> Column:
    """Drop the prompt prefix from a decoded output and strip.

    ``decoded`` cuts the length of the decoded prompt (correct); ``raw``
    cuts the length of the raw prompt, over-trimming by the special tokens.
    """
    p = decode_without_special(prompt) if mode == "decoded" else _c(prompt)
    return _strip(_c(output).substr(F.length(p) + 1, F.lit(1 << 30)))


THINK_BLOCK = r"(?s)<think>(.*?)</think>"


def parse_thinking(text: Column | str) -> Column:
    """struct(thinking, answer). First block's body (stripped) is the
    thinking, all blocks are removed from the answer; no block -> null."""
    t = _c(text)
    has = t.rlike(THINK_BLOCK)
    thinking = F.when(has, _strip(F.regexp_extract(t, THINK_BLOCK, 1)))
    answer = F.when(has, _strip(F.regexp_replace(t, THINK_BLOCK, ""))).otherwise(_strip(t))
    return F.struct(thinking.alias("thinking"), answer.alias("answer"))


def group_responses(
    df: DataFrame, prompt: str, sample_no: str, answer: str, thinking: str, enable_thinking: bool = False
) -> DataFrame:
    """Per prompt, responses in sample order; thinking list only when
    enabled or when any sample had a thinking block (else null)."""
    items = F.array_sort(F.collect_list(F.struct(F.col(sample_no).alias("n"), F.col(answer).alias("r"), F.col(thinking).alias("t"))))
    g = df.groupBy(prompt).agg(items.alias("_items"))
    responses = F.transform("_items", lambda x: x["r"])
    thinks = F.transform("_items", lambda x: x["t"])
    show = F.lit(True) if enable_thinking else F.exists(thinks, lambda x: x.isNotNull())
    return g.select(prompt, responses.alias("responses"), F.when(show, thinks).alias("thinking"))


# ---------------------------------------------------------------- E15-E17
def max_length_choice(cli: Column, config: Column, model_limit: Column, default: int = fixed.DEFAULT_MAX_LENGTH) -> Column:
    """Command line > config > model limit > default."""
    return F.coalesce(cli, config, model_limit, F.lit(default)).cast("bigint")


def strided_windows(df: DataFrame, n_tokens: str, max_length: int, stride: int) -> DataFrame:
    """Scoring windows of ``max_length`` tokens every ``stride`` tokens;
    each token is scored once (``score_from`` = previous window's end)."""
    n = F.col(n_tokens)
    last = F.ceil(F.greatest(n - max_length, F.lit(0)) / F.lit(stride)).cast("bigint")
    x = df.filter(n > 0).withColumn("win", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    begin = F.col("win") * stride
    end = F.least(begin + max_length, n)
    prev_end = F.when(F.col("win") == 0, F.lit(0)).otherwise(F.least(begin - stride + max_length, n))
    return x.withColumn("begin", begin.cast("bigint")).withColumn("end", end.cast("bigint")).withColumn(
        "score_from", prev_end.cast("bigint")
    ).withColumn("n_scored", (F.col("end") - F.col("score_from")).cast("bigint"))


# --------------------------------------------------------------------- E5
def hashed_tf_embedding(text: Column | str, dim: int = 64) -> Column:
    """E5 (native default): term-frequency vector of lower-cased tokens
    hashed into ``dim`` buckets (md5 prefix), as ``ARRAY<FLOAT>``."""
    hs = F.transform(TK.tokens(text, lower=True), lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint"), F.lit(dim)))
    # the text is tokenised and hashed once; buckets are counted in two levels, so that each token is looked at
    # about 2 sqrt(dim) times and not dim times
    step = max(1, math.isqrt(dim))
    count = lambda g, i: F.size(F.filter(g, lambda h: h == i)).cast("float")
    group = lambda h, a: F.filter(h, lambda x: (x >= a) & (x < a + step))
    ends = F.sequence(F.lit(0), F.lit(dim - 1), F.lit(step))
    within = lambda g, a: F.transform(F.sequence(a, F.least(a + step - 1, F.lit(dim - 1))), lambda i: count(g, i))
    return bind(hs, lambda h: F.flatten(F.transform(ends, lambda a: bind(group(h, a), lambda g: within(g, a)))))


def embed_with(make_model, dim: int):
    """E5 plug-in: ``make_model()`` -> ``encode(list[str]) -> array (n, dim)``,
    loaded once per Python worker and called per Arrow batch."""
    from pyspark.sql.functions import pandas_udf

    state: dict = {}

    @pandas_udf(f"array<float>")
    def _embed(texts: pd.Series) -> pd.Series:
        if "m" not in state:
            state["m"] = make_model()
        vecs = np.asarray(state["m"](texts.fillna("").tolist()), dtype=np.float32).reshape(len(texts), dim)
        return pd.Series(list(vecs))

    return _embed


def embed_ids(ids: Column | str, make_encoder, length: int, dim: int, batch_size: int = 32) -> Column:
    """E5 plug-in over token ids: ``make_encoder()`` -> ``encode(int array (n, length)) -> array (n, dim)``.

    Ids are cut or padded to ``length`` in the JVM and arrive as one matrix of
    at most ``batch_size`` rows, so a model takes them without a Python loop. The
    encoder is made once per Python worker. Null id lists are all padding.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    def make_predict():
        encode = make_encoder()

        def predict(batch: np.ndarray) -> np.ndarray:
            return np.asarray(encode(batch.astype(np.int64)), dtype=np.float32).reshape(len(batch), dim)

        return predict

    embed = predict_batch_udf(make_predict, return_type=ArrayType(FloatType()), batch_size=batch_size, input_tensor_shapes=[[length]])
    return embed(pad_labels(F.coalesce(_c(ids), F.array().cast("array<int>")), length))
