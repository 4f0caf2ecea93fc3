"""Positions in a global order without a window over the whole table.

Rows are dealt into key ranges, as many as the counted rows ask for, and
written with the number of their range. Sums per range (a small table) give
each range's offset; what remains is a window per range, which holds about
``range_rows`` rows however large the table is. Rows with equal keys may be
split between ranges, so that a key holding a third of the rows is no hot one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize, release

RANGE_ROWS = 200_000
#: Ranges per group when offsets are summed.
GROUP = 1024
#: Up to so many rows Spark's own top-k (one task, bounded) takes the first n.
TOP_ROWS = 10_000


def ranged(df: DataFrame, order: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df``, written, with ``_range`` (rising in ``order``) and ``_row``, which tells rows of equal keys apart."""
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_range", F.lit(0)), "order-rows")
    n = max(1, -(-rows.count() // range_rows))
    if n == 1:
        return rows
    dealt = rows.repartitionByRange(n, *order, "_row")
    out = materialize(dealt.withColumn("_range", F.spark_partition_id()), "order-ranges")
    release(rows, sweep=False)
    return out


def range_offsets(x: DataFrame, value: Column) -> DataFrame:
    """(_range, _sum, _offset): the sum of ``value`` in each range and in all ranges before it.

    Two levels: ranges within groups of ``GROUP``, then the groups' totals, one
    array of (rows / range_rows / GROUP) sums.
    """
    per = x.groupBy("_range").agg(F.sum(value).cast("bigint").alias("_sum")).withColumn("_g", F.floor(F.col("_range") / GROUP))
    w = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("_in", F.sum("_sum").over(w) - F.col("_sum"))
    totals = per.groupBy("_g").agg(F.sum("_sum").alias("_s")).agg(F.array_sort(F.collect_list(F.struct("_g", "_s"))).alias("_a"))
    before = F.transform("_a", lambda g, i: F.struct(g["_g"].alias("_g"), F.aggregate(F.slice("_a", 1, i), F.lit(0).cast("bigint"), lambda acc, y: acc + y["_s"]).alias("_b")))
    return per.join(totals.select(F.inline(before)), "_g").select("_range", "_sum", (F.col("_b") + F.col("_in")).alias("_offset"))


def running_sum(df: DataFrame, order: Sequence[str], value: Column | str, out: str = "before", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over all rows before each one in ``order``.

    Rows of equal keys follow one another in some order; keys should be unique
    where that matters. Null keys come first; null values count as 0.
    """
    v = F.coalesce((F.col(value) if isinstance(value, str) else value).cast("bigint"), F.lit(0))
    x = ranged(df.withColumn("_v", v), order, range_rows)
    offsets = range_offsets(x, F.col("_v"))
    w = Window.partitionBy("_range").orderBy(*order, "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("_in", F.sum("_v").over(w) - F.col("_v")).join(offsets, "_range")
    return x.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_offset") + F.col("_in")).alias(out))


def first_n(df: DataFrame, order: Sequence[str], n: int, range_rows: int = RANGE_ROWS, top_rows: int = TOP_ROWS) -> DataFrame:
    """The first ``n`` rows of ``df`` in ``order``, spread over tasks however large ``n`` is.

    Ranges that end before the cut are taken whole, and only the rows of the
    one range that holds it are ranked.
    """
    if n <= top_rows:
        return df.orderBy(*order).limit(max(n, 0))
    x = ranged(df, order, range_rows)
    x = x.join(range_offsets(x, F.lit(1)), "_range").filter(F.col("_offset") < n)
    cut = F.col("_offset") + F.col("_sum") > n
    ranked = x.filter(cut).withColumn("_k", F.row_number().over(Window.partitionBy("_range").orderBy(*order, "_row")))
    out = [F.col(f"`{c}`") for c in df.columns]
    return x.filter(~cut).select(*out).unionByName(ranked.filter(F.col("_offset") + F.col("_k") <= n).select(*out))
