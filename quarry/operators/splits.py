"""Splitting, packing, run summary and checkpoint bookkeeping.

No operator here sends document rows through a single-partition exchange.
Where an order over the whole table is needed (the seeded split, running
sums) it is taken over a *count table* whose size is bounded by the number
of hash buckets, and only the rows of one boundary bucket are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.operators.joins import salted_join
from quarry.operators.order import RANGE_ROWS, running_sum

SPLIT_BUCKET_HEX = 4  # 16**4 = 65,536 buckets in the count table


def split_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def bucket_offsets(counts: DataFrame) -> DataFrame:
    """Exclusive running sum of ``_cnt`` in ``_b`` (hex string) order, plus the total ``_n``.

    Two levels, no single-partition window: a window per leading hex digit
    (16 partitions) gives the offset inside the digit group, and the 16
    group totals - one aggregate of at most 16 elements - give the group
    offsets.
    """
    lvl = counts.withColumn("_b1", F.substring("_b", 1, 1))
    w = Window.partitionBy("_b1").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lvl = lvl.withColumn("_in", F.sum("_cnt").over(w) - F.col("_cnt"))
    groups = counts.groupBy(F.substring("_b", 1, 1).alias("_b1")).agg(F.sum("_cnt").alias("_c1"))
    arr = groups.agg(F.array_sort(F.collect_list(F.struct("_b1", "_c1"))).alias("_a"))  # <= 16 elements
    starts = F.transform(
        "_a",
        lambda x, i: F.struct(
            x["_b1"].alias("_b1"),
            F.aggregate(F.slice("_a", 1, i), F.lit(0).cast("bigint"), lambda acc, y: acc + y["_c1"]).alias("_off1"),
        ),
    )
    total = F.aggregate("_a", F.lit(0).cast("bigint"), lambda acc, y: acc + y["_c1"])
    first = arr.select(F.inline(starts), total.alias("_n"))
    out = lvl.join(F.broadcast(first), "_b1")
    return out.select("_b", "_cnt", (F.col("_off1") + F.col("_in")).alias("_before"), "_n")


def train_eval_split(
    df: DataFrame,
    key: str,
    ratio: float = fixed.DEFAULT_TRAIN_RATIO,
    seed: int = fixed.DEFAULT_SEED,
    split_col: str = "split",
    bucket_hex: int = SPLIT_BUCKET_HEX,
) -> DataFrame:
    """Exact seeded split; the first ``floor(n * ratio)`` rows in
    ``(md5(seed:key), key)`` order are ``train``, the rest ``eval``.

    Plan: the keys are counted per hash prefix (partial aggregation, at most
    ``16**bucket_hex`` groups); a two-level running sum over that bounded
    count table finds the one bucket that holds the cut; the distinct keys of
    that bucket alone are ranked, which leaves one row, the pair (hash, key)
    of the last train row. The rows themselves are read once and compared
    with that pair; they are never shuffled.

    Keys are meant to be unique. Rows that share the key of the cut all go to
    ``train`` (copies never straddle the split, at the price of an exact
    count); null keys come first. An empty table stays empty.
    """
    h = F.coalesce(split_hash(F.col(key), seed), F.lit(""))
    place = F.struct(h.alias("h"), F.col(key).alias("k"))
    keys = df.select(place.alias("_p")).withColumn("_b", F.substring("_p.h", 1, bucket_hex))
    counts = keys.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = bucket_offsets(counts).withColumn("_ntrain", F.floor(F.col("_n") * F.lit(float(ratio))).cast("bigint"))
    edge = offsets.filter((F.col("_before") < F.col("_ntrain")) & (F.col("_ntrain") <= F.col("_before") + F.col("_cnt")))
    edge = edge.select("_b", (F.col("_ntrain") - F.col("_before")).alias("_need"))  # at most one row
    near = keys.join(F.broadcast(edge), "_b").groupBy("_b", "_need", "_p").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_b").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = near.withColumn("_run", F.sum("_c").over(w)).filter(F.col("_run") >= F.col("_need")).agg(F.min("_p").alias("_cut"))
    return df.withColumn(split_col, F.when(place <= cut.scalar(), F.lit("train")).otherwise(F.lit("eval")))


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split (after a partition-pruned read this is metadata-light)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def run_summary(
    examples: DataFrame,
    style: str,
    llm_filtered: bool,
    rejected: DataFrame | None = None,
    split_col: str = "split",
) -> DataFrame:
    """One-row summary. Rejects (when the filter ran) are unioned in and
    counted by the same single aggregate."""
    ex = examples.select(F.col(split_col).alias("_s"), F.col("word_count").alias("_w"), F.lit(False).alias("_rej"))
    if rejected is not None and llm_filtered:
        rej = rejected.select(F.lit(None).cast("string").alias("_s"), F.lit(None).cast("bigint").alias("_w"), F.lit(True).alias("_rej"))
        ex = ex.unionByName(rej)
    kept = ~F.col("_rej")
    return ex.agg(
        F.count(F.when(kept, 1)).alias("total_processed"),
        F.count(F.when(kept & (F.col("_s") == "train"), 1)).alias("train_samples"),
        F.count(F.when(kept & (F.col("_s") == "eval"), 1)).alias("eval_samples"),
        F.coalesce(F.sum(F.when(kept, F.col("_w"))), F.lit(0)).cast("bigint").alias("total_words"),
        F.lit(style).alias("format_style"),
        F.lit(bool(llm_filtered)).alias("llm_filtered"),
        F.count(F.when(F.col("_rej"), 1)).alias("rejected_count"),
    )


def truncate_tokens(tokens: Column | str, max_length: int) -> Column:
    """T4: keep the first ``max_length`` tokens."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.slice(t, 1, max_length)


def pack_sequences(df: DataFrame, key: str, n_tokens: str, block_len: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """T5: pack examples into blocks of ``block_len`` tokens.

    All examples are concatenated in ``key`` order; the running token sum gives
    each one's ``[start, end)`` span, and an example that crosses a block border
    is split into pieces (``sequence`` + ``explode``). Output: one row per (block,
    example piece) with the piece's token count. Every block but the last holds
    ``block_len`` tokens; zero-token rows produce nothing. The running sum goes
    through key ranges counted from the rows (``order.running_sum``), so no task
    holds more than about ``range_rows`` rows.
    """
    L = int(block_len)
    x = df.select(F.col(key), F.col(n_tokens).cast("bigint").alias("_n")).filter(F.col("_n") > 0)
    x = running_sum(x, [key], "_n", "_start", range_rows).withColumn("_end", F.col("_start") + F.col("_n"))
    first = F.floor(F.col("_start") / L).cast("bigint")
    last = F.floor((F.col("_end") - 1) / L).cast("bigint")
    x = x.withColumn("block", F.explode(F.sequence(first, last)))
    piece = F.least(F.col("_end"), (F.col("block") + 1) * L) - F.greatest(F.col("_start"), F.col("block") * L)
    return x.select("block", key, piece.cast("bigint").alias("n_tokens"))


def best_checkpoint(evals: DataFrame, run: str = "run_id", step: str = "step", loss: str = "eval_loss") -> DataFrame:
    """Lowest eval loss per run, ties to the lowest step.

    ``min(struct(loss, step))`` is an ordinary aggregate with map-side
    partial aggregation, so a run holding most rows is not one hot task.
    """
    best = F.min(F.struct(F.col(loss).alias("l"), F.col(step).alias("s")))
    return evals.groupBy(run).agg(best.alias("_b")).select(
        run, F.col("_b.s").alias("best_step"), F.col("_b.l").alias("best_loss")
    )


def retain_checkpoints(
    evals: DataFrame, keep: int, run: str = "run_id", step: str = "step", loss: str = "eval_loss"
) -> DataFrame:
    """Keep ``keep`` checkpoints per run: the best one plus the newest others.

    "Newest" ranks the run's own step numbers, whatever their spacing. The
    best step is kept; the newest ``keep - 1`` other steps are kept, or the
    newest ``keep`` when the best is among them. The newest steps of a run
    are found in two levels (per slice of a step hash, then per run over at
    most ``keep`` steps of each slice), so no window holds a whole run.
    """
    w = Window.partitionBy(run, "_slice").orderBy(F.desc(step))
    top = evals.select(run, step).distinct().withColumn("_slice", F.pmod(F.xxhash64(step), F.lit(64)))
    top = top.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= keep)
    top = top.withColumn("_k", F.row_number().over(Window.partitionBy(run).orderBy(F.desc(step)))).filter(F.col("_k") <= keep)
    newest = top.groupBy(run).agg(F.sort_array(F.collect_list(step), asc=False).alias("_new"))
    per_run = evals.groupBy(run).agg(F.min(F.struct(F.col(loss).alias("l"), F.col(step).alias("s"))).alias("_b"))
    per_run = per_run.join(newest, run).select(run, F.col("_b.s").alias("_best"), "_new")
    kept = F.when(F.array_contains("_new", F.col("_best")), F.col("_new")).otherwise(F.concat(F.slice("_new", 1, keep - 1), F.array("_best")))
    j = salted_join(evals, per_run.select(run, "_best", kept.alias("_keep")), [run], 8, F.xxhash64(F.col(step)), how="inner")  # a run may hold most rows
    return j.filter(F.array_contains("_keep", F.col(step))).select(run, step, loss, (F.col(step) == F.col("_best")).alias("is_best"))
