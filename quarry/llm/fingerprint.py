"""Document fingerprints by bottom-k sketches (operator 4); DataFrame functions only.

A sketch is the sorted array of the ``k`` smallest 48-bit hashes of a text's
distinct word shingles. The sketch of a union is the k smallest of the
sketches together, so parts merge; resemblance, containment and the number
of distinct shingles are read off sketches alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACES

HASH_BITS = 48


def sketch(text: str | Column, k: int = 128, width: int = 5) -> Column:
    """Bottom-k sketch (array<bigint>, ascending) of the shingles of ``width`` words.

    Words are the runs of anything but ASCII white space. A text with
    fewer words is one shingle; null, empty or blank texts have an empty
    sketch. Repeated shingles count once.
    """
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    words = F.filter(F.split(t, f"[{SPACES}]+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    # a lambda over one element binds the hashes once: they are read for every shingle
    shingles = F.transform(
        F.array(hashed),
        lambda h: F.when(
            F.size(h) >= width,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(h) - width, F.lit(0))),
                lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + j) for j in range(width)]), 64 - HASH_BITS),
            ),
        )
        .when(F.size(h) > 0, F.array(F.shiftrightunsigned(F.xxhash64(h), 64 - HASH_BITS)))
        .otherwise(F.array().cast("array<bigint>")),
    )
    return F.slice(F.sort_array(F.array_distinct(shingles[0])), 1, k)


def merge(a: Column, b: Column, k: int = 128) -> Column:
    """Sketch of the union of two shingle sets (of parts whose shingles are known apart)."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: str, b: str, k: int = 128) -> Column:
    """Estimated Jaccard likeness of two sketch columns; two empty ones are alike (1)."""
    u = merge(F.col(a), F.col(b), k)
    hits = F.size(F.array_intersect(F.array_intersect(F.col(a), F.col(b)), u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(hits / F.greatest(F.size(u), F.lit(1)))


def distinct_shingles(s: str | Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    c = F.col(s) if isinstance(s, str) else s
    return F.when(F.size(c) < k, F.size(c).cast("double")).otherwise(F.lit(float((k - 1) * 2**HASH_BITS)) / F.element_at(c, -1))


def containment(a: str, b: str, k: int = 128) -> Column:
    """Estimated share of a's shingles that b holds; an empty a is contained in anything (1)."""
    both = resemblance(a, b, k) * distinct_shingles(merge(F.col(a), F.col(b), k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def to_string(s: str | Column) -> Column:
    """The sketch as text: 12 hex digits per hash, ascending, nothing between."""
    c = F.col(s) if isinstance(s, str) else s
    return F.array_join(F.transform(c, lambda h: F.lower(F.lpad(F.hex(h), HASH_BITS // 4, "0"))), "")


#: Rows that one bucket of neighbouring keys holds, at most about.
BUCKET_ROWS = 20_000


def with_next(docs: DataFrame, key: str, carried: list[str], buckets: int) -> DataFrame:
    """Adds ``_next``: struct of ``carried`` of the next row by descending ``key``; the first row's after the last.

    Ties of the key are ordered by a hash of the carried columns; a null key
    comes last. Rows are dealt to ``buckets`` by key quantiles that are keys
    of the table, and the row with such a key is also sent to the bucket
    above, whose last row it follows: one shuffle, no global window.
    """
    k = F.coalesce(F.col(key).cast("bigint"), F.lit(-(2**63)))
    x = docs.withColumn("_k", k)
    cut = x.agg(F.percentile_approx("_k", [i / buckets for i in range(1, buckets)], 10000).alias("c"), F.max("_k").alias("m")).first()
    if cut is None or cut["m"] is None:
        bounds: list[int] = []
        top = None
    else:
        top = cut["m"]
        bounds = sorted({b for b in cut["c"] if b < top}) + [top]
    # one row of at most ``buckets`` keys, as a literal: bucket i holds bounds[i - 1] < key <= bounds[i]
    arr = F.lit(",".join(map(str, bounds)))
    arr = F.split(arr, ",").cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    at = F.size(F.filter(arr, lambda b: b < F.col("_k")))
    last = len(bounds) - 1
    above = F.when(at == last, F.lit(0)).otherwise(at + 1)
    sent = F.when(F.array_contains(arr, F.col("_k")), F.array(F.struct(at.alias("b"), F.lit(0).alias("g")), F.struct(above.alias("b"), F.lit(1).alias("g")))).otherwise(F.array(F.struct(at.alias("b"), F.lit(0).alias("g"))))
    x = x.withColumn("_s", F.explode(sent)).withColumn("_b", F.col("_s.b")).withColumn("_g", F.col("_s.g")).drop("_s")
    w = Window.partitionBy("_b").orderBy("_g", F.desc("_k"), F.xxhash64(*carried))
    nxt = F.lead(F.struct(*carried)).over(w)
    return x.withColumn("_next", nxt).filter("_g = 0").drop("_g", "_b", "_k")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 128, width: int = 5) -> DataFrame:
    """(key, n_chars, sketch): one row per row of ``docs``; see ``sketch`` for empty and short texts."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key), F.length(t).cast("bigint").alias("n_chars"), sketch(t, k, width).alias("sketch"))


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 128, width: int = 5, buckets: int | None = None) -> DataFrame:
    """Every text beside its edited form and the next document.

    The edited text's last third (floor) is the next document's first as
    many code points, or all it has. One row per row of ``docs``; a single
    row is its own next; an empty table gives no rows. Rows are dealt by key to
    as many buckets as their number asks for (``BUCKET_ROWS``), unless given.
    """
    if buckets is None:
        buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // BUCKET_ROWS))
    x = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    x = x.withColumn("_sk", sketch("_t", k, width))
    x = with_next(x, "_id", ["_t", "_sk"], buckets)
    n = F.length("_t")
    third = F.floor(n / 3).cast("int")
    x = x.withColumn("_nx_sk", F.coalesce(F.col("_next._sk"), F.col("_sk")))
    x = x.withColumn("_ed", F.concat(F.substring(F.col("_t"), F.lit(1), n - third), F.substring(F.coalesce(F.col("_next._t"), F.col("_t")), F.lit(1), third)))
    x = x.select("_id", n.cast("bigint").alias("n_chars"), "_ed", "_sk", "_nx_sk", sketch("_ed", k, width).alias("_ed_sk"))
    return x.select(
        F.col("_id").alias(key),
        "n_chars",
        F.col("_ed").alias("edited_text"),
        F.col("_sk").alias("sketch"),
        F.col("_ed_sk").alias("edited_sketch"),
        resemblance("_sk", "_ed_sk", k).alias("near_edited"),
        resemblance("_sk", "_nx_sk", k).alias("near_next"),
    )
