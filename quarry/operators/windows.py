"""Row numbering inside a group without sending the whole group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_number_within(
    df: DataFrame, group: str, order: Sequence[str], coarse: Column, out: str = "rn"
) -> DataFrame:
    """``row_number() over (partition by group order by order)``, computed so
    that a group holding a large share of the rows is still split.

    ``coarse`` must be a non-decreasing function of ``order`` (for example
    the day of a timestamp). Rows are counted per (group, coarse) — a
    partial aggregate — a running sum over that small count table gives each
    slice's offset, and the final window runs per (group, coarse) slice.
    """
    x = df.withColumn("_slice", coarse)
    counts = x.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    j = x.join(offsets, [group, "_slice"])
    rn = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order)) + F.col("_off")
    return j.withColumn(out, rn.cast("bigint")).drop("_slice", "_off")


def magnitude_bucket(value: Column) -> Column:
    """A coarse key that never decreases with ``value``: sign times the
    binary magnitude (at most ~2,100 distinct keys for doubles, 127 for
    bigints)."""
    v = value.cast("double")
    mag = F.floor(F.log2(F.abs(v) + 1)).cast("int")
    return F.when(v < 0, -mag - 1).otherwise(mag)


def running_count(freq: DataFrame, value: str, count: str, group: Sequence[str] = ()) -> DataFrame:
    """Adds ``_cum`` (inclusive running sum of ``count`` in ``value`` order
    within ``group``) and ``_n`` (the group's total), without a window over
    a whole group: a window per (group, magnitude bucket) gives the running
    sum inside the bucket, and the bucket offsets come from the bucket
    totals (a bounded number per group, see ``magnitude_bucket``)."""
    g = list(group)
    x = freq.withColumn("_mb", magnitude_bucket(F.col(value)))
    w = Window.partitionBy(*g, "_mb").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("_in", F.sum(count).over(w))
    totals = x.groupBy(*g, "_mb").agg(F.sum(count).alias("_bt"))
    arr = totals.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("_mb", "_bt"))).alias("_a"))
    starts = F.transform(
        "_a",
        lambda s, i: F.struct(
            s["_mb"].alias("_mb"),
            F.aggregate(F.slice("_a", 1, i), F.lit(0).cast("bigint"), lambda acc, y: acc + y["_bt"]).alias("_off"),
        ),
    )
    total = F.aggregate("_a", F.lit(0).cast("bigint"), lambda acc, y: acc + y["_bt"])
    offs = arr.select(*g, F.inline(starts), total.alias("_n"))
    out = x.join(offs, [*g, "_mb"])
    return out.withColumn("_cum", F.col("_off") + F.col("_in")).drop("_mb", "_in", "_off")
