"""Connected components of a link table, without the links ever on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize, release


def components(links: DataFrame) -> DataFrame:
    """(v, comp): smallest member id of every vertex that has a link (a, b).

    Each round, every vertex takes the smallest label among its own and its
    neighbours', then its label's label. Rounds run until nothing changes;
    each is written to the shared folder, which cuts the lineage, and replaces
    the one before. A hub's
    links are partial aggregates on the way in; on the way out, both sides
    of the join are plain shuffles that AQE splits.
    """
    e = materialize(links.select("a", "b").filter("a <> b").distinct(), "links")
    und = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lab = materialize(und.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("comp")), "labels")
    written = lab
    while True:
        sent = und.join(lab.withColumnRenamed("v", "a"), "a").select(F.col("b").alias("v"), "comp")
        m = lab.unionByName(sent).groupBy("v").agg(F.min("comp").alias("comp"))
        m = materialize(m, "labels-near")
        up = m.select(F.col("v").alias("comp"), F.col("comp").alias("up"))
        old = lab.select(F.col("v").alias("ov"), F.col("comp").alias("oc"))
        nxt = m.join(up, "comp").select("v", F.least("comp", "up").alias("comp"))
        new = materialize(nxt.join(old, F.col("v") == F.col("ov")).select("v", "comp", (F.col("comp") != F.col("oc")).alias("moved")), "labels")
        release(written, m, sweep=False)
        written, lab = new, new.select("v", "comp")
        if new.filter("moved").isEmpty():
            release(e)
            return lab
