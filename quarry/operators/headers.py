"""Repeated headers (L9, rule 2): lines that stand in a large share of all documents.

A page header or a contact line is the same text in document after document,
so it is found by counting: the number of documents that hold each line, over
the whole corpus. Counts are taken first of line hashes, combined before they
move, so that neither a line of a third of all documents nor the texts meet in
one task; only lines whose hash is frequent are then counted as texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

#: Least share of the documents, and least number, in which a header stands.
MIN_SHARE = 0.1
MIN_DOCUMENTS = 3
#: Most header lines that are tested inside the row; more go through a join.
INLINE_LINES = 10_000


def lines(text: Column | str) -> Column:
    """Lines without the blanks around them."""
    t = F.col(text) if isinstance(text, str) else text
    return F.transform(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))


def line_frequencies(docs: DataFrame, text: str = "text", min_share: float = MIN_SHARE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(line, n_documents): non-blank lines in at least ``min_share`` of all documents and ``min_documents`` of them; written.

    A line counts once a document. All rows are counted, null texts as
    documents without lines; an empty table has no such line.
    """
    own = F.array_distinct(F.filter(lines(text), lambda x: x != ""))
    total = docs.count()
    need = max(min_documents, -(-total * int(round(min_share * 1_000_000)) // 1_000_000))
    hashed = docs.select(F.explode(F.transform(own, lambda x: F.xxhash64(x))).alias("h"))
    often = materialize(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= need).select("h"), "frequent-lines")
    # a document holds few frequent lines, and those are counted before they move as well
    x = docs.select(F.explode(own).alias("line")).withColumn("h", F.xxhash64("line")).join(often, "h", "left_semi")
    out = x.groupBy("line").agg(F.count(F.lit(1)).alias("n_documents")).filter(F.col("n_documents") >= need)
    return materialize(out, "repeated-lines")


def drop_lines(docs: DataFrame, headers: DataFrame, text: str = "text", removed: str = "n_removed", inline: int = INLINE_LINES) -> DataFrame:
    """``docs`` without the lines of ``headers`` (line), and how many went as ``removed``.

    All other lines stay as they are, in order. Up to ``inline`` header lines are
    tested inside the row, against a hash set; beyond it the texts' lines meet
    them in a join and are put together again, with the same result. Null texts
    stay null, with 0 removed.
    """
    out = [F.col(f"`{c}`") for c in docs.columns if c not in (text, removed)]
    few = headers.select("line").limit(inline + 1).collect()  # bounded by the parameter
    if len(few) <= inline:
        known = [r["line"] for r in few]
        whole = F.split(text, "\n")
        kept = F.filter(whole, lambda x: ~F.btrim(x, F.lit(" \t\r")).isin(known)) if known else whole
        x = docs.withColumn("_kept", kept)
        gone = F.coalesce(F.size(whole) - F.size("_kept"), F.lit(0))
        return x.select(*out, F.when(gone > 0, F.array_join("_kept", "\n")).otherwise(F.col(text)).alias(text), gone.cast("bigint").alias(removed))
    # rows have no key that is sure to be unique, so they are written with one
    rows = materialize(docs.select("*", F.monotonically_increasing_id().alias("_row")), "numbered-rows")
    parts = rows.select("_row", F.posexplode(F.split(text, "\n")).alias("_at", "_line")).withColumn("line", F.btrim("_line", F.lit(" \t\r")))
    hit = parts.join(headers.select("line", F.lit(True).alias("_hit")), "line", "left")
    again = hit.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.when(F.col("_hit").isNull(), F.struct("_at", "_line")))).alias("_kept"), F.count("_hit").alias("_gone")
    )
    again = again.select("_row", "_gone", F.array_join(F.transform("_kept", lambda x: x["_line"]), "\n").alias("_text"))
    x = rows.join(again, "_row", "left")
    gone = F.coalesce("_gone", F.lit(0))
    return x.select(*out, F.when(gone > 0, F.col("_text")).otherwise(F.col(text)).alias(text), gone.cast("bigint").alias(removed))


def without_headers(docs: DataFrame, text: str = "text", min_share: float = MIN_SHARE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` without their repeated header lines, and ``n_removed``."""
    return drop_lines(docs, line_frequencies(docs, text, min_share, min_documents), text)
