"""Queries for statistics (M), evaluation (E) and checkpoint selection."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.evaluate import Model, evaluate
from quarry.functions import fixed
from quarry.functions.regex import sql_str
from quarry.operators import evaluation as E
from quarry.operators import formatting as FM
from quarry.operators import splits as T
from quarry.operators import stats as M
from quarry.operators import tokens as TK
from quarry.operators.windows import row_number_within
from quarry.plans import views as V
from quarry.plans.q_prepare import SPLIT_SQL, sql_prompt, split_documents
from quarry.plans.registry import query, with_views
from quarry.session import materialize, shared_dir
from quarry.sources import results as RS

TOK = sql_str(TK.TOKEN_RE2)
NTOK_SQL = f"CAST(len(regexp_extract_all(text, {TOK})) AS BIGINT)"
DOCS_SPLIT_SQL = f"SELECT d.doc_id, d.text, s.split, {NTOK_SQL} AS n FROM documents d JOIN sp s USING (doc_id)"
DS = dict(sp=SPLIT_SQL, ds=DOCS_SPLIT_SQL)


def r6(c):
    return F.round(c, 6)


def docs_split(spark, sf):
    """The saved split dataset the statistics read: (doc_id, split, n tokens, characters)."""
    d = split_documents(spark, sf).select("doc_id", "split", TK.token_count("text").alias("n"), F.length("text").alias("n_chars"))
    return materialize(d, "split-lengths")


# ------------------------------------------------------------------ M1-M6
@query("token_length", f"SELECT doc_id, {NTOK_SQL} AS n_tokens FROM documents")
def q_token_length(spark, sf):
    """M1 native token count per text"""
    return V.table(spark, sf, "documents").select("doc_id", TK.token_count("text").alias("n_tokens"))


STATS_COLS = "CAST(count(*) AS BIGINT) AS count, min(n) AS min, max(n) AS max, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS median"


def _stats_out(df):
    return df.select(
        "split", F.col("count").cast("bigint"), "min", "max", r6(F.col("mean")).alias("mean"), r6(F.col("median")).alias("median")
    )


@query("length_stats_by_split", with_views(f"SELECT split, {STATS_COLS} FROM ds GROUP BY split", **DS))
def q_stats_split(spark, sf):
    """M2 token-length stats per split"""
    return _stats_out(M.length_stats(docs_split(spark, sf), "n", ["split"]))


@query(
    "length_stats_overall",
    with_views(f"SELECT split, {STATS_COLS} FROM ds GROUP BY split UNION ALL SELECT 'all', {STATS_COLS} FROM ds", **DS),
)
def q_stats_all(spark, sf):
    """M3 stats per split plus the overall row"""
    return _stats_out(M.length_stats_with_total(docs_split(spark, sf), "n", "split"))


@query(
    "length_percentiles",
    with_views(
        "SELECT round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95, "
        "round(quantile_cont(n, 0.99), 6) AS p99 FROM ds",
        **DS,
    ),
)
def q_percentiles(spark, sf):
    """M4 p90/p95/p99 with linear interpolation"""
    q = M.exact_quantiles(docs_split(spark, sf), "n", [0.9, 0.95, 0.99])
    return q.select(*[r6(F.col(c)).alias(c) for c in ("p90", "p95", "p99")])


SKETCH_PROBS = (0.01, 0.25, 0.5, 0.9, 0.95, 0.99)


@query(
    "length_sketches",
    "SELECT p.prob, true AS within_error, count(*) AS n FROM documents, "
    f"(SELECT unnest([{', '.join(map(str, SKETCH_PROBS))}]::DOUBLE[]) AS prob) p GROUP BY p.prob",
)
def q_sketches(spark, sf):
    """M4 from mergeable sketches, one per source as a run would keep them; each quantile's exact rank is within the stated error"""
    d = V.table(spark, sf, "documents").select("source", TK.token_count("text").alias("n"))
    d = materialize(d, "sketch-lengths")
    parts = materialize(M.length_sketches(d, "n", ["source"]), "length-sketches")
    q = M.sketch_quantiles(parts, SKETCH_PROBS)
    return M.rank_errors(q, d, "n").select(F.col("prob").cast("double"), (F.col("rank_error") <= M.rank_bound()).alias("within_error"), "n")


HIST_SQL = with_views(
    """SELECT g.bin, round(bb.lo + g.bin * ((bb.hi - bb.lo) / 50), 6) AS lo,
         round(bb.lo + (g.bin + 1) * ((bb.hi - bb.lo) / 50), 6) AS hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
       FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) g CROSS JOIN bb LEFT JOIN c ON c.bin = g.bin""",
    **DS,
    b="SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) AS DOUBLE) AS hi FROM ds",
    bb="SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM b",
    c="SELECT CAST(least(floor((n - bb.lo) * (50 / (bb.hi - bb.lo))), 49) AS INTEGER) AS bin, count(*) AS cnt "
    "FROM ds CROSS JOIN bb GROUP BY 1",
)


@query("length_histogram", HIST_SQL)
def q_hist(spark, sf):
    """M5 50-bin equal-width histogram of token lengths"""
    h = M.histogram(docs_split(spark, sf), "n", fixed.HISTOGRAM_BINS)
    return h.select("bin", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), "count")


@query(
    "corpus_totals",
    with_views(
        "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(length(text)) AS BIGINT) AS total_chars, "
        "round(sum(length(text)) / 4.0, 6) AS est_tokens, CAST(sum(n) AS BIGINT) AS total_tokens "
        "FROM ds WHERE split = 'train'",
        **DS,
    ),
)
def q_totals(spark, sf):
    """M6 train-split totals: rows, characters, chars/4, tokens"""
    t = M.corpus_totals(docs_split(spark, sf).filter(F.col("split") == "train"), "n", "n_chars")
    return t.select(F.col("rows").cast("bigint"), "total_chars", r6(F.col("est_tokens")).alias("est_tokens"), "total_tokens")


# ------------------------------------------------------------------ E1-E4
MAXLEN = 512
IDS_SQL = f"list_transform(regexp_extract_all(text, {TOK}), lambda t: CAST(('0x' || substr(md5(t), 1, 6)) AS INTEGER))"


@query(
    "nonpad_tokens",
    f"SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, "
    f"CAST(len(list_filter(list_resize(ids[1:{MAXLEN}], {MAXLEN}, -100), lambda x: x <> -100)) AS BIGINT) AS n_nonpad, "
    f"CAST(list_sum(list_filter(list_resize(ids[1:{MAXLEN}], {MAXLEN}, -100), lambda x: x <> -100)) AS BIGINT) AS id_sum "
    f"FROM (SELECT doc_id, {IDS_SQL} AS ids FROM documents)",
)
def q_nonpad(spark, sf):
    """E1 non-padding label count after truncate-and-pad to 512"""
    d = V.table(spark, sf, "documents").select("doc_id", TK.token_ids("text").alias("ids"))
    labels = E.pad_labels("ids", MAXLEN)
    kept = F.filter(labels, lambda x: x != fixed.PADDING_LABEL)
    return d.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        E.nonpad_tokens(labels).alias("n_nonpad"),
        F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("id_sum"),
    )


ALPHAS = (1.0, 0.5, 2.0)


def _ngram_sql(alpha: float) -> dict:
    return dict(
        sp=SPLIT_SQL,
        toks=f"SELECT d.doc_id, s.split, unnest(regexp_extract_all(lower(d.text), {TOK})) AS tok "
        "FROM documents d JOIN sp s USING (doc_id)",
        vocab="SELECT tok, count(*) AS c FROM toks WHERE split = 'train' GROUP BY tok",
        consts="SELECT CAST(sum(c) AS DOUBLE) AS nn, CAST(count(*) + 1 AS DOUBLE) AS vv FROM vocab",
        ev="SELECT doc_id, tok, count(*) AS k FROM toks WHERE split = 'eval' GROUP BY doc_id, tok",
        dl=f"""SELECT doc_id, CAST(sum(k) AS BIGINT) AS n_tokens,
                 sum(k * -ln((coalesce(c, 0) + {alpha}) / (nn + {alpha} * vv))) / sum(k) AS loss
               FROM ev LEFT JOIN vocab USING (tok) CROSS JOIN consts GROUP BY doc_id""",
    )


def doc_losses(spark, sf, alphas=(1.0,)):
    return E.unigram_doc_losses(split_documents(spark, sf), "doc_id", "text", "split", alphas)


@query("ngram_perplexity", with_views("SELECT doc_id, n_tokens, round(loss, 6) AS loss FROM dl", **_ngram_sql(1.0)))
def q_ngram(spark, sf):
    """E4 unigram (add-1) loss per eval document, model fitted on train"""
    return doc_losses(spark, sf).select("doc_id", "n_tokens", r6(F.col("loss")).alias("loss"))


@query(
    "weighted_loss",
    with_views(
        "SELECT round(sum(loss * n_tokens) / sum(n_tokens), 6) AS avg_loss, CAST(sum(n_tokens) AS BIGINT) AS total_tokens FROM dl",
        **_ngram_sql(1.0),
    ),
)
def q_weighted(spark, sf):
    """E2 token-weighted mean loss over eval documents"""
    w = E.weighted_loss(doc_losses(spark, sf))
    return w.select(r6(F.col("avg_loss")).alias("avg_loss"), "total_tokens")


@query(
    "perplexity",
    with_views(
        "SELECT round(exp(sum(loss * n_tokens) / sum(n_tokens)), 6) AS perplexity, "
        "round(sum(loss * n_tokens) / sum(n_tokens), 6) AS avg_loss, CAST(sum(n_tokens) AS BIGINT) AS total_tokens FROM dl",
        **_ngram_sql(1.0),
    ),
)
def q_perplexity(spark, sf):
    """E3 perplexity = exp(avg loss)"""
    w = E.weighted_loss(doc_losses(spark, sf))
    return w.select(r6(F.col("perplexity")).alias("perplexity"), r6(F.col("avg_loss")).alias("avg_loss"), "total_tokens")


def _backoff_sql(order: int, d: float = E.DISCOUNT) -> dict:
    """Views of the interpolated back-off model: counts of each order, probabilities from the lowest up, document losses."""
    w = [f"w{j}" for j in range(order)]
    lags = ", ".join(f"lag(tok, {order - 1 - j}, chr(2)) OVER (PARTITION BY doc_id ORDER BY i) AS w{j}" for j in range(order - 1))
    views = dict(
        sp=SPLIT_SQL,
        tk=f"SELECT doc_id, split, unnest(t) AS tok, generate_subscripts(t, 1) AS i FROM "
        f"(SELECT d.doc_id, s.split, regexp_extract_all(lower(d.text), {TOK}) AS t FROM documents d JOIN sp s USING (doc_id))",
        g=f"SELECT doc_id, split, {lags}, tok AS w{order - 1} FROM tk",
        ev=f"SELECT doc_id, {', '.join(w)}, count(*) AS k FROM g WHERE split = 'eval' GROUP BY ALL",
    )
    views[f"c{order}"] = f"SELECT {', '.join(w)}, count(*) AS c FROM g WHERE split = 'train' GROUP BY ALL"
    for n in range(order - 1, 0, -1):
        own = ", ".join(w[order - n :])
        views[f"c{n}"] = f"SELECT {own}, count(*) AS c FROM c{n + 1} GROUP BY ALL"
    views["h1"] = "SELECT CAST(sum(c) AS DOUBLE) AS h, count(*) AS t FROM c1"
    last = w[-1]
    views["p1"] = f"""SELECT DISTINCT {', '.join(f'ev.{x}' for x in w)},
        greatest(coalesce(c, 0) - {d}, 0) / h + {d} * t / h / (t + 1) AS p FROM ev LEFT JOIN c1 USING ({last}) CROSS JOIN h1"""
    for n in range(2, order + 1):
        own, past = w[order - n :], w[order - n : -1]
        views[f"h{n}"] = f"SELECT {', '.join(past)}, CAST(sum(c) AS DOUBLE) AS h, count(*) AS t FROM c{n} GROUP BY ALL"
        views[f"p{n}"] = f"""SELECT {', '.join(f'q.{x}' for x in w)}, coalesce(greatest(coalesce(c, 0) - {d}, 0) / h + {d} * t / h * q.p, q.p) AS p
            FROM p{n - 1} q LEFT JOIN c{n} ON {' AND '.join(f'q.{x} = c{n}.{x}' for x in own)}
            LEFT JOIN h{n} ON {' AND '.join(f'q.{x} = h{n}.{x}' for x in past)}"""
    on = " AND ".join(f"ev.{x} = q.{x}" for x in w)
    views["dl"] = f"SELECT doc_id, CAST(sum(k) AS BIGINT) AS n_tokens, sum(k * -ln(p)) / sum(k) AS loss FROM ev JOIN p{order} q ON {on} GROUP BY doc_id"
    return views


@query("bigram_perplexity", with_views("SELECT doc_id, n_tokens, round(loss, 6) AS loss FROM dl", **_backoff_sql(2)))
def q_bigram(spark, sf):
    """E4 of order 2: interpolated back-off with continuation counts, per eval document"""
    return E.ngram_doc_losses(split_documents(spark, sf), "doc_id", "text", 2).select("doc_id", "n_tokens", r6(F.col("loss")).alias("loss"))


@query("trigram_perplexity", with_views("SELECT doc_id, n_tokens, round(loss, 6) AS loss FROM dl", **_backoff_sql(3)))
def q_trigram(spark, sf):
    """E4 of order 3"""
    return E.ngram_doc_losses(split_documents(spark, sf), "doc_id", "text", 3).select("doc_id", "n_tokens", r6(F.col("loss")).alias("loss"))


# ------------------------------------------------------------------ E6-E10
def _edges_sql(by: str, t: float, r_sql: str | None = None) -> dict:
    return dict(
        r=r_sql or V.responses_sql(by),
        rr="SELECT grp, rid, CAST(embedding AS DOUBLE[]) AS v, "
        "sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS nv FROM r",
        pairs="SELECT x.grp, x.rid AS a, y.rid AS b, list_dot_product(x.v, y.v) / greatest(x.nv * y.nv, 1e-8) AS cos "
        "FROM rr x JOIN rr y ON x.grp = y.grp AND x.rid < y.rid",
        e=f"SELECT * FROM pairs WHERE cos > {t}",
    )


# response ids count within their prompt
UND_SQL = "SELECT grp, a, b FROM e UNION ALL SELECT grp, b AS a, a AS b FROM e"
CLUSTERS_SQL = """reach(grp, src, dst) AS (SELECT grp, rid, rid FROM r UNION
      SELECT reach.grp, reach.src, und.b FROM reach JOIN und ON reach.grp = und.grp AND reach.dst = und.a),
    cl AS (SELECT grp, src AS rid, min(dst) AS cluster FROM reach GROUP BY grp, src)"""


def _cc_sql(by: str, t: float, body: str, r_sql: str | None = None) -> str:
    views = _edges_sql(by, t, r_sql)
    views["und"] = UND_SQL
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in views.items())
    return f"""WITH RECURSIVE {ctes},
    {CLUSTERS_SQL},
    sizes AS (SELECT grp, cluster, count(*) AS size FROM cl GROUP BY grp, cluster),
    ent AS (SELECT grp, 0.0 - sum((size / tot) * ln(size / tot)) AS entropy, CAST(sum(size) AS BIGINT) AS n_responses
            FROM (SELECT *, CAST(sum(size) OVER (PARTITION BY grp) AS DOUBLE) AS tot FROM sizes) GROUP BY grp)
    {body}"""


def _clusters(spark, sf, by, t):
    resp = V.responses(spark, sf, by)
    edges = E.similarity_edges(resp, t, contract=True)
    return E.connected_components(resp.select("grp", "rid"), edges)


@query("pairwise_cosine", with_views("SELECT grp, a, b, round(cos, 6) AS cos FROM e", **_edges_sql("label", 0.3)))
def q_pairwise(spark, sf):
    """E6 linked pairs (cosine > 0.3) among responses grouped by label"""
    e = E.similarity_edges(V.responses(spark, sf, "label"), 0.3)
    return e.select("grp", "a", "b", r6(F.col("cos")).alias("cos"))


@query("semantic_clusters", _cc_sql("label", 0.3, "SELECT grp, rid, cluster FROM cl"))
def q_clusters(spark, sf):
    """E7 connected components of the cosine > 0.3 links"""
    return _clusters(spark, sf, "label", 0.3).select("grp", "rid", "cluster")


@query("cluster_sizes", _cc_sql("label", 0.3, "SELECT grp, cluster, CAST(size AS BIGINT) AS size FROM sizes"))
def q_cluster_sizes(spark, sf):
    """E8 members per cluster"""
    s = E.cluster_sizes(_clusters(spark, sf, "label", 0.3))
    return s.select("grp", "cluster", F.col("size").cast("bigint"))


@query("semantic_entropy", _cc_sql("label", 0.3, "SELECT grp, round(entropy, 6) AS entropy, n_responses FROM ent"))
def q_entropy(spark, sf):
    """E9 entropy of cluster sizes per group (label groups, threshold 0.3)"""
    ent = E.semantic_entropy(_clusters(spark, sf, "label", 0.3))
    return ent.select("grp", r6(F.col("entropy")).alias("entropy"), "n_responses")


SUMMARY_BODY = """SELECT CAST(count(*) AS BIGINT) AS prompts_evaluated, CAST(coalesce(max(n_responses), 0) AS BIGINT) AS samples_per_prompt,
  round(coalesce(avg(entropy), 0.0), 6) AS mean_entropy, round(coalesce(max(entropy), 0.0), 6) AS max_entropy,
  round(coalesce(min(entropy), 0.0), 6) AS min_entropy FROM ent"""


def entropy_summary_df(spark, sf, by="prompt", t=fixed.ENTAILMENT_THRESHOLD):
    s = E.entropy_summary(E.entropy_by_prompt(V.responses(spark, sf, by), t))
    return s.select(
        F.col("prompts_evaluated").cast("bigint"),
        "samples_per_prompt",
        *[r6(F.col(c)).alias(c) for c in ("mean_entropy", "max_entropy", "min_entropy")],
    )


@query("entropy_summary", _cc_sql("prompt", fixed.ENTAILMENT_THRESHOLD, SUMMARY_BODY))
def q_entropy_summary(spark, sf):
    """E10 entropy summary: 8 samples per prompt, threshold 0.8"""
    return entropy_summary_df(spark, sf)


# ---------------------------------------------------------------- E11-E13
PROMPT_SQL = sql_prompt("text", "''")
DECODED_SQL = f"replace(replace({PROMPT_SQL}, {sql_str(fixed.IM_START)}, ''), {sql_str(fixed.IM_END)}, '')"


def _strip_sql(e):
    return f"regexp_replace({e}, '\\A\\s+|\\s+\\z', '', 'g')"


@query(
    "strip_prompt",
    f"""SELECT item_id, {_strip_sql('substr(out, length(dp) + 1)')} AS response,
           {_strip_sql('substr(out, length(p) + 1)')} AS response_raw_cut
        FROM (SELECT item_id, {PROMPT_SQL} AS p, {DECODED_SQL} AS dp, {DECODED_SQL} || ' Answer: ' || text AS out FROM benchmark)""",
)
def q_strip_prompt(spark, sf):
    """E11 prompt removal from decoded outputs (decoded and raw-length variants)"""
    b = V.table(spark, sf, "benchmark")
    p = FM.prompt_text(F.col("text"), F.lit(""))
    out = F.concat(E.decode_without_special(p), F.lit(" Answer: "), F.col("text"))
    return b.select(
        "item_id",
        E.strip_prompt(out, p, "decoded").alias("response"),
        E.strip_prompt(out, p, "raw").alias("response_raw_cut"),
    )


def _think_text(turn, text):
    return (
        F.when(turn % 3 == 0, F.concat(F.lit("<think>"), F.substring_index(text, ".", 1), F.lit("</think> "), text))
        .when(turn % 3 == 1, F.concat(F.lit("<think></think>"), text))
        .otherwise(text)
    )


THINK_SQL = """CASE turn % 3 WHEN 0 THEN '<think>' || split_part(text, '.', 1) || '</think> ' || text
                  WHEN 1 THEN '<think></think>' || text ELSE text END"""
PARSED_SQL = f"""SELECT conv_id, turn,
    CASE WHEN regexp_matches(tt, '(?s)<think>.*?</think>') THEN {_strip_sql("regexp_extract(tt, '(?s)<think>(.*?)</think>', 1)")} END AS thinking,
    CASE WHEN regexp_matches(tt, '(?s)<think>.*?</think>') THEN {_strip_sql("regexp_replace(tt, '(?s)<think>(.*?)</think>', '', 'g')")}
         ELSE {_strip_sql('tt')} END AS answer
  FROM (SELECT conv_id, turn, {THINK_SQL} AS tt FROM conversations WHERE role = 'assistant')"""


def parsed_turns(spark, sf):
    c = V.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    tt = _think_text(F.col("turn"), F.col("text"))
    return c.select("conv_id", "turn", E.parse_thinking(tt).alias("p")).select("conv_id", "turn", "p.thinking", "p.answer")


@query("parse_thinking", PARSED_SQL)
def q_parse_thinking(spark, sf):
    """E12 reasoning-block parse of assistant turns"""
    return parsed_turns(spark, sf)


@query(
    "group_responses",
    with_views(
        "SELECT conv_id, CAST(count(*) AS BIGINT) AS n_responses, string_agg(answer, chr(30) ORDER BY turn) AS responses, "
        "CASE WHEN bool_or(thinking IS NOT NULL) THEN string_agg(coalesce(thinking, '∅'), chr(30) ORDER BY turn) END AS thinking "
        "FROM pt GROUP BY conv_id",
        pt=PARSED_SQL,
    ),
)
def q_group_responses(spark, sf):
    """E13 responses (and thinking when present) per conversation in turn order"""
    g = E.group_responses(parsed_turns(spark, sf), "conv_id", "turn", "answer", "thinking")
    return g.select(
        "conv_id",
        F.size("responses").cast("bigint").alias("n_responses"),
        F.array_join("responses", "\x1e").alias("responses"),
        F.when(F.col("thinking").isNotNull(), F.array_join("thinking", "\x1e", "∅")).alias("thinking"),
    )


# ---------------------------------------------------------------- E14-E17
# The models under evaluation come from the data: one per language of the
# documents, fitted on the train rows of that language. Every second one has a
# training config; each links responses at a threshold of its own. The last
# one's generator is not there, which its record must tell.
MODELS_SQL = """SELECT lang, k, 'hub/unigram-' || lang AS model_path, CASE WHEN k % 2 = 1 THEN 'configs/' || lang || '_lora.yaml' END AS config,
      0.2 + 0.05 * k AS threshold FROM (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS k FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))"""
RESPONSES_A_PROMPT = 32


def model_runs(spark, sf):
    """(lang, k, model_path, config, threshold): one row per model, as many as the documents have languages."""
    langs = V.table(spark, sf, "documents").select("lang").filter("lang is not null").distinct()
    k = F.row_number().over(Window.orderBy("lang")) - 1  # over the list of models
    x = langs.select("lang", k.cast("bigint").alias("k"))
    config = F.when(F.col("k") % 2 == 1, F.concat(F.lit("configs/"), F.col("lang"), F.lit("_lora.yaml")))
    return x.select("lang", "k", F.concat(F.lit("hub/unigram-"), F.col("lang")).alias("model_path"), config.alias("config"), (F.lit(0.2) + F.lit(0.05) * F.col("k")).alias("threshold"))


def evaluated_models(spark, sf):
    """The run table's models with their metrics."""
    runs = model_runs(spark, sf).orderBy("k").collect()

    def perplexity(r):
        docs = split_documents(spark, sf).filter((F.col("split") == "eval") | (F.col("lang") == r["lang"]))
        return E.weighted_loss(E.unigram_doc_losses(docs, "doc_id", "text"))

    def entropy(r):
        e = V.table(spark, sf, "embeddings").filter(F.col("label") % len(runs) == r["k"])
        resp = e.select((F.col("vec_id") / RESPONSES_A_PROMPT).cast("bigint").alias("grp"), F.col("vec_id").alias("rid"), "embedding")
        return E.entropy_summary(E.entropy_by_prompt(resp, r["threshold"]))

    def generations(r):
        turns = parsed_turns(spark, sf).filter(F.col("conv_id") % len(runs) == r["k"])
        if r["k"] == len(runs) - 1:
            turns = turns.withColumn("answer", F.when(F.col("turn") >= 0, F.raise_error(F.lit("no generator for " + r["lang"]))).otherwise(F.col("answer")))
        return E.group_responses(turns, "conv_id", "turn", "answer", "thinking")

    made = {"perplexity": perplexity, "semantic_entropy": entropy, "generations": generations}
    return [Model(r["model_path"], {n: (lambda f=f, r=r: f(r)) for n, f in made.items()}, r["config"]) for r in runs]


def assembled_results(spark, sf):
    """E14 over the run table: one record per model."""
    return evaluate(spark, shared_dir(spark, "evaluation"), evaluated_models(spark, sf))


def _results_sql(body: str) -> str:
    views = dict(sp=SPLIT_SQL, m=MODELS_SQL, nm="SELECT count(*) AS n FROM m", pt=PARSED_SQL)
    views["toks"] = f"SELECT d.doc_id, d.lang, s.split, unnest(regexp_extract_all(lower(d.text), {TOK})) AS tok FROM documents d JOIN sp s USING (doc_id)"
    views["vocab"] = "SELECT lang, tok, count(*) AS c FROM toks WHERE split = 'train' GROUP BY lang, tok"
    views["consts"] = "SELECT m.lang, CAST(coalesce(sum(c), 0) AS DOUBLE) AS nn, CAST(count(tok) + 1 AS DOUBLE) AS vv FROM m LEFT JOIN vocab USING (lang) GROUP BY m.lang"
    views["ev"] = "SELECT tok, count(*) AS k FROM toks WHERE split = 'eval' GROUP BY tok"
    views["pp"] = """SELECT x.lang, sum(k * -ln((coalesce(c, 0) + 1.0) / (nn + vv))) / sum(k) AS avg_loss, CAST(sum(k) AS BIGINT) AS total_tokens
        FROM ev CROSS JOIN consts x LEFT JOIN vocab v ON v.lang = x.lang AND v.tok = ev.tok GROUP BY x.lang"""
    views |= _edges_sql("prompt", 0, f"SELECT (label % n) * 1000000000 + vec_id // {RESPONSES_A_PROMPT} AS grp, vec_id AS rid, embedding FROM embeddings, nm")
    views["e"] = "SELECT pairs.* FROM pairs JOIN m ON grp // 1000000000 = k WHERE cos > threshold"
    views["und"] = UND_SQL
    views["gn"] = "SELECT conv_id % n AS k, count(DISTINCT conv_id) AS n_prompts, count(*) AS n_responses FROM pt, nm GROUP BY 1"
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in views.items())
    name = "'evaluation_results_' || CASE WHEN config IS NOT NULL THEN lang || '_lora' ELSE 'unigram-' || lang END || '.json'"
    return f"""WITH RECURSIVE {ctes},
    {CLUSTERS_SQL},
    sizes AS (SELECT grp, cluster, count(*) AS size FROM cl GROUP BY grp, cluster),
    ent AS (SELECT grp, 0.0 - sum((size / tot) * ln(size / tot)) AS entropy FROM
            (SELECT *, CAST(sum(size) OVER (PARTITION BY grp) AS DOUBLE) AS tot FROM sizes) GROUP BY grp),
    es AS (SELECT m.k, coalesce(avg(entropy), 0.0) AS mean_entropy, coalesce(max(entropy), 0.0) AS max_entropy,
                  coalesce(min(entropy), 0.0) AS min_entropy FROM m LEFT JOIN ent ON grp // 1000000000 = m.k GROUP BY m.k),
    rs AS (SELECT model_path, config, {name} AS result_name, avg_loss, total_tokens, mean_entropy, max_entropy, min_entropy,
                  CASE WHEN m.k < n - 1 THEN coalesce(n_prompts, 0) END AS n_prompts, CASE WHEN m.k < n - 1 THEN coalesce(n_responses, 0) END AS n_responses, m.k = n - 1 AS failed
           FROM m CROSS JOIN nm JOIN pp USING (lang) JOIN es USING (k) LEFT JOIN gn USING (k))
    {body}"""


@query(
    "assemble_results",
    _results_sql(
        "SELECT model_path, config, result_name, round(exp(avg_loss), 6) AS perplexity, round(avg_loss, 6) AS avg_loss, total_tokens, "
        "round(mean_entropy, 6) AS mean_entropy, round(max_entropy, 6) AS max_entropy, round(min_entropy, 6) AS min_entropy, "
        "n_prompts, n_responses, failed AS generations_failed FROM rs"
    ),
)
def q_assemble(spark, sf):
    """E14 per-model records: perplexity, entropy, generations, path and config; a failed metric leaves its own error"""
    r = assembled_results(spark, sf)
    return r.select(
        "model_path",
        "config",
        "result_name",
        r6(F.col("perplexity.perplexity")).alias("perplexity"),
        r6(F.col("perplexity.avg_loss")).alias("avg_loss"),
        F.col("perplexity.total_tokens").alias("total_tokens"),
        *[r6(F.col(f"semantic_entropy.{c}")).alias(c) for c in ("mean_entropy", "max_entropy", "min_entropy")],
        "generations.n_prompts",
        "generations.n_responses",
        F.coalesce(F.col("generations.error").contains("no generator for"), F.lit(False)).alias("generations_failed"),
    )


@query(
    "model_leaderboard",
    _results_sql(
        "SELECT model_path AS model, round(exp(avg_loss), 6) AS perplexity, round(mean_entropy, 6) AS mean_entropy, "
        "CAST(rank() OVER (ORDER BY round(exp(avg_loss), 6)) AS INTEGER) AS perplexity_rank, "
        "CAST(rank() OVER (ORDER BY round(mean_entropy, 6)) AS INTEGER) AS entropy_rank FROM rs"
    ),
)
def q_leaderboard(spark, sf):
    """E16 model comparison over the scanned result records"""
    return RS.leaderboard(assembled_results(spark, sf))


@query(
    "eval_result_name",
    f"SELECT model_path AS model, 'evaluation_results_' || CASE WHEN config IS NOT NULL THEN regexp_replace(list_extract(string_split(config, '/'), -1), '\\.[^.]*$', '') "
    f"ELSE list_extract(string_split(model_path, '/'), -1) END || '.json' AS result_name FROM ({MODELS_SQL})",
)
def q_result_name(spark, sf):
    """S12 result-file names of the run table: config stem, else last segment of the model id"""
    return model_runs(spark, sf).select(F.col("model_path").alias("model"), RS.result_name_col(F.col("model_path"), F.col("config")).alias("result_name"))


@query(
    "max_length_choice",
    f"""SELECT user_id AS run_id, CAST(coalesce(cli, cfg, lim, {fixed.DEFAULT_MAX_LENGTH}) AS BIGINT) AS max_length FROM (
          SELECT user_id,
            max(CASE WHEN event_type = 'signup' THEN CAST(floor(value * 100) AS BIGINT) END) AS cli,
            max(CASE WHEN event_type = 'purchase' THEN CAST(floor(value * 100) AS BIGINT) END) AS cfg,
            max(CASE WHEN event_type = 'view' THEN CAST(floor(value * 100) AS BIGINT) END) AS lim
          FROM events GROUP BY user_id)""",
)
def q_max_length(spark, sf):
    """E15 max-length precedence over a run table derived from events"""
    ev = V.table(spark, sf, "events")

    def pick(kind):
        return F.max(F.when(F.col("event_type") == kind, F.floor(F.col("value") * 100).cast("bigint")))

    runs = ev.groupBy("user_id").agg(pick("signup").alias("cli"), pick("purchase").alias("cfg"), pick("view").alias("lim"))
    return runs.select(F.col("user_id").alias("run_id"), E.max_length_choice(F.col("cli"), F.col("cfg"), F.col("lim")).alias("max_length"))


@query(
    "strided_windows",
    f"""SELECT doc_id, win, begin, "end", score_from, "end" - score_from AS n_scored FROM (
          SELECT doc_id, win, win * 256 AS begin, least(win * 256 + 512, n) AS "end",
                 CASE WHEN win = 0 THEN 0 ELSE least(win * 256 - 256 + 512, n) END AS score_from
          FROM (SELECT doc_id, n, unnest(generate_series(0, CAST(ceil(greatest(n - 512, 0) / 256) AS BIGINT))) AS win
                FROM (SELECT doc_id, {NTOK_SQL} AS n FROM documents) WHERE n > 0))""",
)
def q_strided(spark, sf):
    """E17 strided scoring windows (512 tokens, stride 256)"""
    d = V.table(spark, sf, "documents").select("doc_id", TK.token_count("text").alias("n"))
    w = E.strided_windows(d, "n", 512, 256)
    return w.select("doc_id", "win", "begin", "end", "score_from", "n_scored")


# ------------------------------------------------------------------ T6, T7
EVALS_SQL = """SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
                      value AS eval_loss FROM events"""


def run_evals(spark, sf):
    ev = V.table(spark, sf, "events")
    ev = row_number_within(ev, "user_id", ["ts", "event_id"], F.date_trunc("hour", F.col("ts")), "step")
    return ev.select(F.col("user_id").alias("run_id"), "step", F.col("value").alias("eval_loss"))


@query(
    "best_checkpoint",
    with_views(
        "SELECT run_id, step AS best_step, eval_loss AS best_loss FROM "
        "(SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) AS k FROM ev) WHERE k = 1",
        ev=EVALS_SQL,
    ),
)
def q_best(spark, sf):
    """T6 lowest eval loss per run (events as training logs)"""
    return T.best_checkpoint(run_evals(spark, sf))


@query(
    "retain_checkpoints",
    with_views(
        "SELECT run_id, step, eval_loss, is_best FROM (SELECT *, "
        "row_number() OVER (PARTITION BY run_id ORDER BY is_best DESC, step DESC) AS k FROM "
        "(SELECT *, step = first_value(step) OVER (PARTITION BY run_id ORDER BY eval_loss, step) AS is_best FROM ev)) WHERE k <= 3",
        ev=EVALS_SQL,
    ),
)
def q_retain(spark, sf):
    """T7 keep 3 checkpoints per run: the best plus the newest"""
    return T.retain_checkpoints(run_evals(spark, sf), 3)


# --------------------------------------------------------------------- E5
EMB_DIM = 64
HASH_SQL = f"list_transform(regexp_extract_all(lower(text), {TOK}), lambda t: CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % {EMB_DIM})"


@query(
    "embed_text",
    f"""SELECT conv_id, turn, array_to_string(list_transform(range({EMB_DIM}), lambda i: CAST(len(list_filter(hs, lambda h: h = i)) AS VARCHAR)), ',') AS vec
        FROM (SELECT conv_id, turn, {HASH_SQL} AS hs FROM conversations WHERE role = 'assistant')""",
)
def q_embed(spark, sf):
    """E5 hashed term-frequency embedding of assistant turns"""
    c = V.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    v = E.hashed_tf_embedding("text", EMB_DIM)
    return c.select("conv_id", "turn", F.array_join(F.transform(v, lambda x: x.cast("int").cast("string")), ",").alias("vec"))


RESP_TEXT_SQL = f"""SELECT conv_id AS grp, turn AS rid,
    list_transform(range({EMB_DIM}), lambda i: CAST(len(list_filter(hs, lambda h: h = i)) AS FLOAT)) AS embedding
  FROM (SELECT conv_id, turn, {HASH_SQL} AS hs FROM conversations WHERE role = 'assistant')"""


@query(
    "response_entropy",
    _cc_sql("prompt", fixed.ENTAILMENT_THRESHOLD, "SELECT grp, round(entropy, 6) AS entropy, n_responses FROM ent", RESP_TEXT_SQL),
)
def q_response_entropy(spark, sf):
    """E5 -> E6..E10: entropy of a conversation's assistant turns, embedded from text"""
    c = V.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    resp = c.select(F.col("conv_id").alias("grp"), F.col("turn").alias("rid"),
                    E.hashed_tf_embedding("text", EMB_DIM).alias("embedding"))
    ent = E.entropy_by_prompt(resp, fixed.ENTAILMENT_THRESHOLD)
    return ent.select("grp", r6(F.col("entropy")).alias("entropy"), "n_responses")
