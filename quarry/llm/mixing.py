"""Mixing sources to target weights by subset-sum budget fitting (operator 5).

Per source, documents are counted by exact length. A target is met by whole
copies of every document plus a chosen part: the same share of every length's
count, then a bounded-knapsack dynamic program over the lengths for the words
still missing. Which documents of a length are chosen is decided by a seeded
hash, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bytes_of, give_back, text_slices
from quarry.session import materialize

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3


def word_sizes(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(key, source, text_hash, size): number of words of every whole text; null is 0."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            sizes = [np.zeros(0, np.int64)]
            for _, part in text_slices(b.column(3)):
                raw, off = bytes_of(part)
                word = (raw != 32) & ((raw < 9) | (raw > 13))
                first = word.copy()
                first[1:] &= ~word[:-1]
                starts = off[:-1][off[:-1] < len(raw)]
                first[starts] = word[starts]
                at = np.concatenate([[0], np.cumsum(first, dtype=np.int64)])
                sizes.append(at[off[1:]] - at[off[:-1]])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.concatenate(sizes))], ["k", "s", "text_hash", "size"])
        give_back()

    x = docs.select(F.col(key).cast("bigint").alias("k"), F.col(source).alias("s"), F.xxhash64(text).alias("text_hash"), F.coalesce(text, F.lit("")).alias("t"))
    return x.mapInArrow(run, "k bigint, s string, text_hash bigint, size bigint").select(F.col("k").alias(key), F.col("s").alias(source), "text_hash", "size")


def ranked(names: DataFrame, column: str) -> DataFrame:
    """Adds ``pos``: 0-based place of each row by ``column`` (code points, null last).

    Range-partitioned sort, numbered within partitions and written once;
    offsets come from one count per partition.
    """
    x = names.withColumn("_no", F.col(column).isNull()).repartitionByRange("_no", column).sortWithinPartitions("_no", column)
    x = materialize(x.withColumn("_id", F.monotonically_increasing_id()).drop("_no"), "mix-rank")
    part = F.shiftrightunsigned("_id", 33)
    parts = x.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))  # one row per partition
    before = parts.groupBy().agg(F.array_sort(F.collect_list(F.struct("_p", "_c"))).alias("_a"))
    before = before.select(F.explode("_a").alias("_e"), "_a").select(
        F.col("_e._p").alias("_p"), F.aggregate(F.filter("_a", lambda y: y["_p"] < F.col("_e._p")), F.lit(0).cast("bigint"), lambda s, y: s + y["_c"]).alias("_o")
    )
    return x.withColumn("_p", part).join(F.broadcast(before), "_p").select(*names.columns, (F.col("_o") + F.col("_id") - F.shiftleft("_p", 33)).alias("pos"))


def targets(sizes: DataFrame, source: str = "source", weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target): shares of all words by weight, capped and reshared.

    Sources in code-point order, null last, take ``weights`` in turn. A
    target stops at ``max_copies`` times the source's size; the excess is
    reshared by weight among the others until none is above. Each round is
    one aggregate over the sources; the driver sees four numbers, all exact.
    """
    per = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    per = ranked(per, source)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    per = materialize(per.withColumn("_w", w.cast("bigint")), "mix-sources")
    total = per.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    level: float | None = None  # words per unit of weight
    while True:
        capped = F.lit(False) if level is None else F.col("source_size") * max_copies <= F.col("_w") * F.lit(level)
        r = per.agg(
            F.coalesce(F.sum(F.when(capped, F.col("source_size") * max_copies)), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~capped, F.col("_w"))), F.lit(0)).alias("w"),
            F.count(F.when(capped, F.lit(1))).alias("n"),
        ).first()
        if level is not None and r["n"] == n_capped or r["w"] == 0:
            break
        n_capped, level = r["n"], (total - r["full"]) / r["w"]
    t = F.least(F.col("source_size") * float(max_copies), F.col("_w") * F.lit(float(level or 0.0)))
    return per.select(source, "source_size", t.alias("target"))


def fit_counts(lengths, counts, budget: int, most: int = 1, reach: int = 1 << 16):
    """How many takes of documents of each length come nearest to ``budget`` words.

    Takes the same share of every count, then, from the longest down, what
    still fits until less than ``reach`` words are missing, and closes the
    rest by a bounded knapsack over reachable sums (a bit set per length),
    with each document once if that hits the budget, else up to ``most`` times.
    ``reach`` is at least four times the longest length, so that what the
    knapsack closes has room for any document at every budget; where it does
    not hit, it chooses anew with ever more of the even share given back.
    """
    import numpy as np

    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    whole = int((lengths * counts).sum())
    if budget <= 0 or whole == 0 or most < 1:
        return np.zeros(len(lengths), np.int64)
    reach = max(reach, 4 * int(lengths.max()))
    order = np.argsort(-lengths, kind="stable")
    even = np.array([min(int(c), int(c) * budget // whole) for c in counts], np.int64)
    best = None
    while True:
        take, left = even.copy(), budget - int((lengths * even).sum())
        for i in order:
            if left <= reach:
                break
            n = min(int(counts[i] - take[i]), (left - reach // 2) // int(lengths[i]) if lengths[i] else 0)
            if n > 0:
                take[i] += n
                left -= n * int(lengths[i])
        for times in range(1, most + 1):
            more, miss = nearest_sum(lengths, counts * times - take, left, order)
            if best is None or miss < best[0]:
                best = miss, take + more
            if not miss:
                return best[1]
        if not even.any() or budget - int((lengths * even).sum()) > reach:  # nothing left to give back, or more than the knapsack closes
            return best[1]
        even = even // 2


def nearest_sum(lengths, room, goal: int, order):
    """(takes per length, words off ``goal``): bounded knapsack for the sum nearest to ``goal``, below on ties."""
    import numpy as np

    more = np.zeros(len(lengths), np.int64)
    mask = (1 << (2 * goal + 1)) - 1
    sums, steps = 1, []
    for i in order[::-1]:
        if sums >> goal & 1:
            break
        size, n = int(lengths[i]), int(room[i])
        if not size or size > 2 * goal or n <= 0:
            continue
        n, k = min(n, 2 * goal // size), 1
        while n > 0:  # a count as powers of two
            k = min(k, n)
            steps.append((i, k, size * k, sums))
            sums |= (sums << (size * k)) & mask
            n, k = n - k, 2 * k
    below = (sums & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = sums >> (goal + 1)
    at = below
    if above:
        up = goal + 1 + (above & -above).bit_length() - 1
        if up - goal < goal - below:
            at = up
    off = abs(goal - at)
    for i, k, words, before in reversed(steps):
        if not before >> at & 1:
            more[i] += k
            at -= words
    return more, off


def quotas(sizes: DataFrame, per_source: DataFrame, source: str = "source", max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, size, n, source_size, target, copies, extra): copies of every document of a length, and how many get one more."""
    hist = sizes.groupBy(source, "size").agg(F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    same = hist[source].eqNullSafe(per_source[source])
    h = hist.join(per_source, same).select(hist[source].alias("s"), "size", "n", "source_size", "target", n.alias("copies"))

    def run(pdf):
        pdf = pdf.sort_values("size").reset_index(drop=True)
        goal = round(float(pdf["target"][0])) - int(pdf["copies"][0]) * int(pdf["source_size"][0])
        extra = fit_counts(pdf["size"].to_numpy(), pdf["n"].to_numpy(), goal, max_copies - int(pdf["copies"][0]))
        pdf["copies"] += extra // pdf["n"]
        pdf["extra"] = extra % pdf["n"]
        return pdf

    # a group is one source's lengths: bounded by its longest document
    out = h.groupBy("s").applyInPandas(run, "s string, size bigint, n bigint, source_size bigint, target double, copies bigint, extra bigint")
    return out.withColumnRenamed("s", source)


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 7, **kw) -> DataFrame:
    """(key, source, text_hash, size, source_size, target, copies): one row per row of ``docs``.

    ``copies`` (0..3) is how often the mix takes the document. Empty and null
    texts have size 0 and are taken as often as their source's whole copies.
    Rows that repeat key and text are told apart by nothing but their number.
    An empty table gives no rows.
    """
    sizes = materialize(word_sizes(docs, key, source, text), "mix-sizes")
    per = targets(sizes, source, **kw)
    q = materialize(quotas(sizes, per, source), "mix-quotas")
    q = q.select(F.col(source).alias("_s"), F.col("size").alias("_z"), "n", "source_size", "target", "copies", "extra")
    rows = sizes.withColumn("_h", F.xxhash64(key, "text_hash", F.lit(seed))).withColumn("_slice", F.shiftrightunsigned("_h", 54))
    # the cut: the slice of 1,024 in which the last extra document lies, and how many of it are taken
    per_slice = rows.groupBy(F.col(source).alias("_s"), F.col("size").alias("_z"), "_slice").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_s", "_z").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = per_slice.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    cut = cut.join(q.filter("extra > 0 and extra < n").select(F.col("_s").alias("s"), F.col("_z").alias("z"), "extra"), F.col("_s").eqNullSafe(F.col("s")) & (F.col("_z") == F.col("z")))
    cut = cut.filter("_before < extra and extra <= _before + _c").select("_s", "_z", F.col("_slice").alias("_cut"), (F.col("extra") - F.col("_before")).alias("_of_cut"))
    qc = q.join(cut.withColumnsRenamed({"_s": "s", "_z": "z"}), F.col("_s").eqNullSafe(F.col("s")) & (F.col("_z") == F.col("z")), "left").drop("s", "z")
    qc = materialize(qc, "mix-cuts")
    j = rows.join(qc, F.col(source).eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "inner").drop("_s", "_z")
    edge = F.coalesce(F.col("_slice") == F.col("_cut"), F.lit(False))
    out = [key, source, "text_hash", "size", "source_size", "target"]
    sure = F.when(F.col("extra") == 0, F.lit(0)).when(F.col("extra") >= F.col("n"), F.lit(1)).when(F.col("_slice") < F.col("_cut"), F.lit(1)).otherwise(F.lit(0))
    rank = F.row_number().over(Window.partitionBy(source, "size").orderBy("_h", key))
    near = j.filter(edge).withColumn("_one", (rank <= F.col("_of_cut")).cast("int"))
    both = j.filter(~edge).withColumn("_one", sure).unionByName(near)
    return both.select(*out, (F.col("copies") + F.col("_one")).cast("bigint").alias("copies"))


def apply_mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **kw) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0 to 3 times); all columns as they are."""
    m = mix(docs, key, source, text, **kw)
    m = m.groupBy(F.col(key).alias("_xm_k"), F.col("text_hash").alias("_xm_t")).agg(F.sum("copies").alias("_xm_n"), F.count(F.lit(1)).alias("_xm_rows"))
    m = materialize(m.filter("_xm_n > 0"), "mix-copies")
    same = F.col(key).eqNullSafe(F.col("_xm_k")) & (F.xxhash64(text) == F.col("_xm_t"))

    def taken(x: DataFrame, n: DataFrame) -> DataFrame:
        j = x.join(n, same).withColumn("_xm_i", F.explode(F.sequence(F.lit(1), F.col("_xm_n"))))
        return j.select(*[F.col(f"`{c}`") for c in docs.columns])

    out = taken(docs, m.filter("_xm_rows = 1"))
    again = m.filter("_xm_rows > 1")
    if not again.isEmpty():  # rows that repeat: their copies together
        once = docs.withColumn("_xm_h", F.xxhash64(text)).join(again, same, "left_semi").dropDuplicates([key, "_xm_h"]).drop("_xm_h")
        out = out.unionByName(taken(once, again))
    return out
