"""Join helpers for keys that can be hot.

A key holding a large share of the rows (the token "the", one prompt, one
run) would put all of them in one shuffle partition of a sort-merge join.
``salted_join`` spreads the large side over ``salts`` sub-keys and
replicates the (per-key single-row) small side ``salts`` times, so no task
receives more than ``1/salts`` of a hot key. AQE's skew-join handling is on
as well; salting makes the plan independent of it. ``hot_join`` takes the number
of sub-keys from counts: only keys that hold many rows get any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salts: int,
    salt_of_big: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Equi-join ``big`` to ``small`` on ``on`` with ``salts`` sub-keys.

    ``salt_of_big`` must be a deterministic expression over ``big``'s
    columns (default: hash of all of them), so task retries see the same
    salt. ``how`` is ``inner`` or ``left`` (left keeps unmatched big rows).
    """
    if salts <= 1:
        return big.join(small, list(on), how)
    salt = salt_of_big if salt_of_big is not None else F.xxhash64(*[F.col(c) for c in big.columns])
    b = big.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [*on, "_salt"], how).drop("_salt")


#: Most keys that ``hot_join`` treats as hot; their list is broadcast.
HOT_KEYS = 10_000
#: Rows of one key in a task from which it is worth splitting.
HOT_ROWS = 200_000


def hot_keys(big: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """(on..., _parts): keys of ``big`` with more than ``hot_rows`` rows and into how many parts each goes.

    At most ``HOT_KEYS`` of them: of a table so large that more keys pass
    ``hot_rows``, a key counts as hot from rows / HOT_KEYS rows on. None where
    the whole table has no more rows than that.
    """
    total = big.count()
    if total <= hot_rows:
        return None
    least = max(hot_rows, total // HOT_KEYS)
    per = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return per.filter(F.col("_n") > least).select(*on, F.ceil(F.col("_n") / least).cast("int").alias("_parts"))


def hot_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi-join ``big`` to ``small`` (one row per key) with hot keys split by their counted rows.

    Rows of a hot key are dealt by their own hash; only the hot keys' rows of
    ``small`` are repeated. ``big`` is read twice, so it should be a written table.
    ``how`` is ``inner`` or ``left``.
    """
    hot = hot_keys(big, on, hot_rows)
    if hot is None:
        return big.join(small, list(on), how)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    names = big.columns
    b = big.join(F.broadcast(hot), list(on), "left").withColumn("_salt", F.pmod(F.xxhash64(*names), parts).cast("int")).drop("_parts")
    s = small.join(F.broadcast(hot), list(on), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return b.join(s, [*on, "_salt"], how).drop("_salt")
