"""Corpus pipeline: language, exact and near duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage
before kept. All but the last return the columns of documents; the last
returns pieces placed in sequences. Stages are written and read again by
``run``, so a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import exact_dedup, language, mixing, ngram_join, packing
from quarry.llm.common import may_learn, table, tokenizer_path
from quarry.session import materialize


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a known language (null text or no letter).

    Every other row stays as it is, repeated ones too, with all of its columns
    whatever their names. Nothing learnt (no labelled text) or an empty table:
    no rows.
    """
    trees = language.fit(docs.filter(may_learn("doc_id", 4, 2)))
    named = language.predict(docs, trees, pred="_xl_pred", score_as="_xl_score")
    return named.filter(F.col("_xl_pred") != language.UNKNOWN).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of equal texts; null and empty texts are equal, of rows that repeat it one stays."""
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of documents whose five-word likeness is 0.8 or more.

    Texts without a word stay. An empty table stays empty.
    """
    return ngram_join.drop_near(docs, percent=80, width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their targets; a null source is one of its own, the last."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens in sequences; a document that is there n times gives its pieces n times."""
    """Pieces of documents in sequences of at most 2,048 tokens."""
    pieces = materialize(packing.cut_pieces(docs, tokenizer_path()), "pipeline-pieces")
    return packing.pack(pieces).drop("tie")


STAGES = [
    ("language_id", keep_known_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: No SQL: code lengths of context trees and sum-of-squares packing are not expressible; tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
