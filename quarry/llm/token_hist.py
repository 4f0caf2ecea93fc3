"""Token counts by an exact length histogram (operator 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.tokens import token_counts


def length_histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(length, documents): how many documents encode to ``length`` ids.

    Whole texts; a null or empty text has length 0. Repeated rows count each.
    An empty table gives no rows. Counts are partial per batch, so a length
    shared by any share of the documents reaches the shuffle once per batch.
    """
    return token_counts(docs, path, text).groupBy("length").agg(F.sum("documents").alias("documents"))


def context_totals(hist: DataFrame, block: int = 256) -> DataFrame:
    """For every length L as a context limit: suffix sums over the histogram.

    documents_ge/tokens_ge: documents of at least L ids and their ids;
    truncated_tokens: ids left when every document is cut at L; share_le:
    share of documents of at most L ids (the quantile level of L). Sums run
    in two levels (lengths within a block of ``block``, then blocks), so no
    window holds the whole histogram.
    """
    x = hist.withColumn("tokens", F.col("length") * F.col("documents")).withColumn("_b", F.floor(F.col("length") / block))
    w = Window.partitionBy("_b").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("_d", F.sum("documents").over(w)).withColumn("_t", F.sum("tokens").over(w))
    # one row per block of lengths: bounded by the longest document, not by the number of documents
    tot = x.groupBy("_b").agg(F.sum("documents").alias("_bd"), F.sum("tokens").alias("_bt"))
    higher = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    j = tot.select(
        "_b",
        F.coalesce(F.sum("_bd").over(higher), F.lit(0)).alias("_ad"),
        F.coalesce(F.sum("_bt").over(higher), F.lit(0)).alias("_at"),
        F.sum("_bd").over(every).alias("_nd"),
        F.sum("_bt").over(every).alias("_nt"),
    )
    r = x.join(F.broadcast(j), "_b")
    ge, tge = F.col("_d") + F.col("_ad"), F.col("_t") + F.col("_at")
    return r.select(
        "length",
        "documents",
        "tokens",
        ge.alias("documents_ge"),
        tge.alias("tokens_ge"),
        (F.col("_nt") - tge + F.col("length") * ge).alias("truncated_tokens"),
        ((F.col("_nd") - ge + F.col("documents")) / F.col("_nd")).alias("share_le"),
    )


#: Context limits that are usually asked for.
LIMITS = tuple(1 << k for k in range(7, 21))


def at_limits(totals: DataFrame, limits=LIMITS) -> DataFrame:
    """(limit, documents_ge, tokens_ge, truncated_tokens, share_le) at each of ``limits``, occurring lengths or not.

    What holds from a limit on are the suffix sums of the next length that
    occurs; beyond the longest document nothing is cut. One pass over
    ``totals`` (of ``context_totals``), whose rows are distinct lengths. An empty
    table gives zeros, and a null share.
    """
    whole = F.max_by("truncated_tokens", "length")  # at the longest length nothing is cut
    n = F.max("documents_ge")
    some = totals.agg(whole.alias("_t"), n.alias("_n"), *[F.min_by(F.struct("documents_ge", "tokens_ge"), F.when(F.col("length") >= x, F.col("length"))).alias(f"_{x}") for x in limits],
                      *[F.max_by("share_le", F.when(F.col("length") <= x, F.col("length"))).alias(f"_s{x}") for x in limits])
    zero = F.lit(0).cast("bigint")

    def row(x: int):
        ge, tge = F.coalesce(F.col(f"_{x}.documents_ge"), zero), F.coalesce(F.col(f"_{x}.tokens_ge"), zero)
        share = F.when(F.col("_n") > 0, F.coalesce(F.col(f"_s{x}"), F.lit(0.0)))
        return F.struct(F.lit(x).cast("bigint").alias("limit"), ge.alias("documents_ge"), tge.alias("tokens_ge"), (F.coalesce("_t", zero) - tge + ge * x).alias("truncated_tokens"), share.alias("share_le"))

    return some.select(F.inline(F.array(*[row(int(x)) for x in limits])))


def quantile(totals: DataFrame, q: float) -> DataFrame:
    """One row (length): the smallest length with ``share_le`` >= q; null over an empty table."""
    return totals.filter(F.col("share_le") >= q).agg(F.min("length").alias("length"))
