"""Corpus statistics (M1-M6).

Quantiles are exact but never buffer a group's values: rows are first
counted per distinct value (a partial aggregate), and order statistics are
read off the running counts of that frequency table, whose size is bounded
by the number of distinct lengths, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.functions import fixed
from quarry.operators.windows import running_count


def frequency(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """``(group..., _v, _c)``: rows counted per distinct value (partial aggregate)."""
    return df.groupBy(*group, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))


def _value_at(rank: Column) -> Column:
    """min value whose running count exceeds the 0-based ``rank``."""
    return F.min(F.when(F.col("_cum") > rank, F.col("_v")))


def quantiles_from_frequency(
    freq: DataFrame,
    probs: Sequence[float],
    group: Sequence[str] = (),
    names: Sequence[str] | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles (numpy's default) read off a frequency table.

    ``extra`` are further aggregates over the frequency table by name, taken in the same pass.
    """
    g, extra = list(group), extra or {}
    freq = running_count(freq, "_v", "_c", g)
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [_value_at(lo).alias(f"_lo{i}"), _value_at(hi).alias(f"_hi{i}"), F.first(pos - lo).alias(f"_f{i}")]
    out = freq.groupBy(*g).agg(*aggs, *[c.alias(n) for n, c in extra.items()])
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    cols = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).cast("double").alias(names[i])
        for i in range(len(probs))
    ]
    return out.select(*g, *extra, *cols)


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = (), names: Sequence[str] | None = None
) -> DataFrame:
    """M4: exact quantiles per group without buffering a group's values."""
    return quantiles_from_frequency(frequency(df, value, group), probs, group, names)


def stats_from_frequency(freq: DataFrame, group: Sequence[str]) -> DataFrame:
    """count, min, max, mean, median per group from a frequency table, in one aggregate."""
    basic = {
        "count": F.sum("_c").cast("bigint"),
        "min": F.min("_v").cast("bigint"),
        "max": F.max("_v").cast("bigint"),
        "mean": F.sum(F.col("_v") * F.col("_c")) / F.sum("_c"),
    }
    return quantiles_from_frequency(freq, [0.5], group, ["median"], basic)


def length_stats(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """M2: count, min, max, mean, median of ``value`` per group (one scan)."""
    g = list(group)
    if not g:
        return length_stats(df.withColumn("_all", F.lit(1)), value, ["_all"]).drop("_all")
    return stats_from_frequency(frequency(df, value, g), g)


def length_stats_with_total(df: DataFrame, value: str, group: str, total_label: str = "all") -> DataFrame:
    """M3: per-group stats plus one row over all groups, from one frequency table, written once."""
    from quarry.session import materialize

    freq = materialize(frequency(df, value, [group]), "length-freq")
    total = freq.groupBy("_v").agg(F.sum("_c").alias("_c")).withColumn(group, F.lit(total_label))
    return stats_from_frequency(freq.unionByName(total), [group])


def histogram(df: DataFrame, value: str, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """M5: equal-width bins on [min, max], last bin closed; empty bins kept.

    One pass over the rows: values are counted into a frequency table (one
    row per distinct value), which is written once; the two bounds are read
    from it and every distinct value is binned with them as literals. The
    bin list comes from ``range(bins)`` joined on the bin number. min == max
    uses [v - 0.5, v + 0.5].
    """
    from quarry.session import materialize

    freq = materialize(frequency(df, value), "histogram-freq")
    b = freq.agg(F.min("_v").cast("double").alias("lo"), F.max("_v").cast("double").alias("hi")).first()
    spark = df.sparkSession
    if b is None or b["lo"] is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count bigint")
    lo, hi = b["lo"], b["hi"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    scale = bins / (hi - lo)
    idx = F.least(F.floor((F.col("_v").cast("double") - F.lit(lo)) * F.lit(scale)), F.lit(bins - 1)).cast("int")
    counts = freq.groupBy(idx.alias("bin")).agg(F.sum("_c").alias("count"))
    width = (hi - lo) / bins
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def corpus_totals(df: DataFrame, n_tokens: str, n_chars: str) -> DataFrame:
    """M6: rows, characters, characters/4 estimate and token total."""
    chars = F.coalesce(F.sum(n_chars), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        chars.cast("bigint").alias("total_chars"),
        (chars / 4.0).alias("est_tokens"),
        F.coalesce(F.sum(n_tokens), F.lit(0)).cast("bigint").alias("total_tokens"),
    )


# ---------------------------------------------------------- sketches (M4 at scale)
#: Size of a sketch: k = 2,000 keeps some 6,000 values (about 50 KB) whatever it has seen.
SKETCH_K = 2_000


def rank_bound(k: int = SKETCH_K) -> float:
    """Stated error of a quantile: its rank differs from the one asked for by at most this share of the rows.

    A KLL sketch's normalized rank error is about 2.296 / k^0.9021 at 99 %
    confidence for one quantile; twice that is allowed, as several are asked for.
    """
    return 2 * 2.296 / k**0.9021


def length_sketches(df: DataFrame, value: str, parts: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(parts..., sketch, n): one mergeable quantile sketch per part of the data (a day, a source, a batch).

    Kept beside the data, the parts' sketches answer quantiles of any union of
    them later without another look at the rows. Null values are not counted.
    """
    x = df.filter(F.col(value).isNotNull())
    return x.groupBy(*parts).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged_sketches(sketches: DataFrame, group: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(group..., sketch, n): the sketches of each group as one; of ``length_sketches``'s form, so it merges again."""
    return sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], group: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(group..., prob, quantile, n): quantiles within ``rank_bound(k)`` of the rank asked for; no rows without values."""
    m = merged_sketches(sketches, group, k).filter(F.col("n") > 0)
    found = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))).alias("quantile")) for p in probs])
    return m.select(*group, F.inline(found), "n")


def rank_errors(quantiles: DataFrame, df: DataFrame, value: str) -> DataFrame:
    """``quantiles`` with ``rank_error``: how far its exact rank in ``df`` is from ``prob``, as a share of the rows.

    A value that repeats covers a range of ranks; the nearest of them counts.
    """
    freq = frequency(df.filter(F.col(value).isNotNull()), value)
    rows = quantiles.collect()  # the quantiles asked for
    below = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_c"))), F.lit(0))
    aggs = [F.struct(below(F.col("_v") < r["quantile"]), below(F.col("_v") <= r["quantile"])).alias(f"q{i}") for i, r in enumerate(rows)]
    found = freq.agg(*aggs).first() if rows else []
    far = [max(lo - r["prob"] * r["n"], r["prob"] * r["n"] - hi, 0.0) / r["n"] for r, (lo, hi) in zip(rows, found, strict=True)]
    schema = StructType([*quantiles.schema.fields, StructField("rank_error", DoubleType())])
    return quantiles.sparkSession.createDataFrame([(*r, x) for r, x in zip(rows, far, strict=True)], schema)
