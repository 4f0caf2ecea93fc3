"""Registered queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import byte_bpe, centroids, exact_dedup, fingerprint, html_extract, language, lmscore, mixing, ngram_join, packing, quality, token_hist, whitening
from quarry.llm.common import BYTE_TOKENIZER, SPACES, held_out, may_learn, table, tokenizer_path
from quarry.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return deco


@register(
    "op1_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[{SPACES}]+', ' ', 'g')) AS h FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
    FROM t WINDOW w AS (PARTITION BY h)""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), hash_all=True)
    return g.withColumnRenamed("full_hash", "text_sha256")


@register("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = materialize(packing.cut_pieces(table(spark, sf_dir, "documents"), tokenizer_path()), "pieces")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packing.pack(pieces).select(*cols)


@register("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fingerprint.edited_pairs(table(spark, sf_dir, "documents"))
    return e.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint.to_string("sketch").alias("fingerprint"),
        fingerprint.to_string("edited_sketch").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@register("op5_source_mix")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op8_token_histogram")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = token_hist.length_histogram(table(spark, sf_dir, "documents"), tokenizer_path())
    totals = materialize(token_hist.context_totals(materialize(h, "length-histogram")), "length-totals")
    asked = token_hist.at_limits(totals)
    missing = asked.join(totals.select("length"), asked["limit"] == totals["length"], "left_anti")
    none = F.lit(0).cast("bigint")
    return totals.unionByName(missing.select(F.col("limit").alias("length"), none.alias("documents"), none.alias("tokens"), "documents_ge", "tokens_ge", "truncated_tokens", "share_le"))


@register("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trees = language.fit(docs.filter(may_learn("doc_id", 4, 2)))
    return language.predict(docs.select("doc_id", "text"), trees).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@register("op9_quality_model")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = materialize(quality.features(table(spark, sf_dir, "documents")), "quality-features")
    labels = table(spark, sf_dir, "labels").filter(may_learn("doc_id", 3, 1))
    scored = quality.predict(feats, quality.fit(feats, labels))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op3_html_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    got = html_extract.extract(pages.select("page_id", "url", "html"), out="text")
    return got.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@register("op10_bloom_lm_scores")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lmscore.score(table(spark, sf_dir, "documents"), may_learn("doc_id", 7, 2))
    cols = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), *cols)


@register("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(BYTE_TOKENIZER)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path)
    got = byte_bpe.decode(encoded.select("doc_id", "n_tokens", "ids"), path)
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op12_centroid_clusters")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, final = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return centroids.with_totals(clustered, final).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@register("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, size = whitening.vectors_of(table(spark, sf_dir, "embeddings"))
    return whitening.whiten(vectors, size, whitening.fit(vectors, size))
