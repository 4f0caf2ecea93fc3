"""Exact dedup by progressive refinement (operator 1); DataFrame functions only.

Level 1 groups by length, level 2 by a hash of a short prefix, level 3 by a
hash of the full content, which is taken only of rows whose (length, prefix)
group has other members. What levels 1 and 2 leave is kept as a bitmap of
fixed size, so it can be broadcast whatever the table holds: a set bit means
"may have a twin". Rows never move with their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, suspects
from quarry.session import materialize


def normalised(text: str | Column) -> Column:
    """Every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), f"[{SPACES}]+", " ")


def may_repeat(docs: DataFrame, text: str = "text", prefix_chars: int = 64, bits: int = 1 << 22) -> DataFrame:
    """Bitmap rows (word, mask) over hashes of (length, prefix) groups with several rows.

    At most ``bits``/64 rows, a bound that does not depend on the data. Two
    groups that share a bit only cost a full hash more.
    """
    t = docs.select(normalised(text).alias("_t"))
    t = t.select(F.length("_t").alias("n"), F.xxhash64(F.substring("_t", 1, prefix_chars)).alias("p"))
    groups = materialize(t.groupBy("n", "p").agg(F.count(F.lit(1)).alias("rows")), "dedup-prefix")
    lengths = groups.groupBy("n").agg(F.sum("rows").alias("_r")).filter("_r > 1").select("n")  # level 1
    left = groups.join(lengths, "n", "left_semi").filter("rows > 1")  # level 2
    bit = F.pmod(F.xxhash64("n", "p"), F.lit(bits))
    return left.groupBy(F.floor(bit / 64).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(n, p), {bits}L) % 64 AS int))")).alias("mask"))


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    hash_all: bool = False,
    prefix_chars: int = 64,
    bits: int = 1 << 22,
) -> DataFrame:
    """(key, keep_id, group_size, kept, full_hash), one row per row of ``docs``.

    Texts are equal when their normalised forms are. The smallest key of a
    group stays; a null key ranks after all others (keep_id is then null
    only if every key of the group is), and of rows that repeat the same key
    one stays. Null and empty texts are equal to each other. Other columns
    are not read, so their names cannot clash. ``full_hash`` is the SHA-256
    of the normalised text, null for rows proven single by length and prefix
    unless ``hash_all``. An empty table gives no rows.
    """
    seen = F.broadcast(may_repeat(docs, text, prefix_chars, bits))
    x = docs.select(F.col(key).alias("_k"), normalised(text).alias("_t"))
    x = x.select("_k", "_t", F.length("_t").alias("_n"), F.xxhash64(F.substring("_t", 1, prefix_chars)).alias("_p"))
    bit = F.pmod(F.xxhash64("_n", "_p"), F.lit(bits))
    x = x.withColumn("word", F.floor(bit / 64)).withColumn("_b", (bit % 64).cast("int")).join(seen, "word", "left")
    twin = F.coalesce(F.expr("(shiftright(mask, _b) & 1L) = 1L"), F.lit(False))
    digest = F.sha2(F.encode("_t", "UTF-8"), 256)
    x = x.select("_k", "_n", twin.alias("_twin"), (digest if hash_all else F.when(twin, digest)).alias("_h"))
    # row numbers are fixed by writing them once
    rows = materialize(x.withColumn("_r", F.monotonically_increasing_id()), "dedup-rows")
    first = F.min(F.struct(F.col("_k").isNull().alias("no"), F.col("_k").alias("k"), F.col("_r").alias("r")))
    groups = rows.filter("_twin").groupBy("_n", "_h").agg(F.count(F.lit(1)).alias("_size"), first.alias("_first")).filter("_size > 1")
    # written, so that both sides of the join are shuffles that AQE can split where a group is hot
    groups = materialize(groups.select(F.col("_n").alias("n"), F.col("_h").alias("h"), "_size", "_first"), "dedup-groups")
    j = rows.join(groups, (rows["_n"] == groups["n"]) & (rows["_h"] == groups["h"]) & rows["_twin"], "left")
    grouped = F.col("_size").isNotNull()
    return j.select(
        F.col("_k").alias(key),
        F.when(grouped, F.col("_first.k")).otherwise(F.col("_k")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.when(grouped, F.col("_r") == F.col("_first.r")).otherwise(F.lit(True)).alias("kept"),
        F.col("_h").alias("full_hash"),
    )


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; all columns as they are.

    Rows are told apart by (key, hash of the text). Where the same key
    repeats with an equal text, one of those rows stays.
    """
    g = materialize(exact_groups(docs, key, text), "dedup-groups-all").filter("group_size > 1")
    lost = g.groupBy(F.col(key).alias("_xd_k"), F.col("full_hash").alias("_xd_h")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    lost = materialize(lost.filter("not kept or rows > 1"), "dedup-lost")
    # only rows whose key may be among the lost ones are hashed and moved
    x = suspects(docs, key, lost.select(F.col("_xd_k").alias("_w")))
    clear = x.filter("not _maybe").select(*[F.col(f"`{c}`") for c in docs.columns])
    x = x.filter("_maybe").drop("_maybe").withColumn("_xd_hash", F.sha2(F.encode(normalised(text), "UTF-8"), 256))
    same = F.col(key).eqNullSafe(F.col("_xd_k")) & (F.col("_xd_hash") == F.col("_xd_h"))
    out = x.join(lost.filter("not kept").select("_xd_k", "_xd_h"), same, "left_anti")
    again = lost.filter("kept and rows > 1").select("_xd_k", "_xd_h")
    if not again.isEmpty():
        twice = out.join(again, same, "left_semi").dropDuplicates([key, "_xd_hash"])
        out = out.join(again, same, "left_anti").unionByName(twice)
    return clear.unionByName(out.drop("_xd_hash"))
