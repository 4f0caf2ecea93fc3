"""Known ids as a stream's state: C5, C11 and A3 over arriving files.

A batch run compares with everything that is there (an anti-join); a run
that is called again whenever links, catalog rows or listings arrive keeps the
ids it has met in the state store instead. The first row of an id, by its
place in the batch it arrives in, is new; every later one, in this batch or in
any that follows, and after any restart, is not. Rows that only tell of an id
(what is in the catalog or on disk already) are marked as known.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructType

from quarry.streaming.incremental import source


def first_seen(rows: DataFrame, key: str, order: str, known: str, once: bool = True) -> DataFrame:
    """``rows`` (a stream) that are not known themselves, with ``is_new``: first of their ``key`` ever.

    Rows whose ``known`` is true enter the state and are not returned; in one
    batch they count as earlier than all others. ``order`` decides between rows
    that arrive together. A null key is never new. State: one flag per id,
    partitioned by it. With ``once`` false only known rows enter the state, and
    every row of an id that is not known is new.
    """
    out = StructType(list(rows.schema.fields)).add("is_new", BooleanType())

    def run(key_, batches: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        t = pd.concat(list(batches))
        told = t[known].fillna(False).astype(bool)
        had = state.exists or key_[0] is None or bool(told.any())
        if not state.exists and (once or told.any()):
            state.update((True,))
        t = t[~told].sort_values(order, kind="stable")
        yield t.assign(is_new=[not had and (i == 0 or not once) for i in range(len(t))])

    return rows.groupBy(key).applyInPandasWithState(run, out, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def _run(stream: DataFrame, output: str, checkpoint: str) -> None:
    q = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    q.trigger(availableNow=True).start(output).awaitTermination()


def run_new_ids(spark: SparkSession, links: str, schema: StructType, output: str, checkpoint: str, key: str = "id", order: str = "place", known: str = "known", max_files: int | None = None) -> None:
    """Appends the links in ``links`` whose id no earlier file, batch or run has had."""
    x = first_seen(source(spark, links, schema, max_files), key, order, known)
    _run(x.filter("is_new").drop("is_new", known), output, checkpoint)


def run_pending(spark: SparkSession, rows: str, schema: StructType, output: str, checkpoint: str, max_files: int | None = None) -> None:
    """C11: appends catalog rows still to scrape; ``rows`` holds catalog rows (idx, id, scraped, ...) and outputs (id, known = true)."""
    x = source(spark, rows, schema, max_files)
    x = x.filter(~F.coalesce("scraped", F.lit(False)))
    _run(first_seen(x, "id", "idx", "known", once=False).filter("is_new").drop("is_new", "known"), output, checkpoint)


def run_fetch_plan(spark: SparkSession, targets: str, schema: StructType, output: str, checkpoint: str, key: str = "file_name", order: str = "idx", max_files: int | None = None) -> None:
    """A3: appends each target with its ``action``: fetch for a file never met, else skipped; listings come as known rows."""
    x = first_seen(source(spark, targets, schema, max_files), key, order, "known")
    _run(x.withColumn("action", F.when(F.col("is_new"), F.lit("fetch")).otherwise(F.lit("skipped"))).drop("is_new", "known"), output, checkpoint)
