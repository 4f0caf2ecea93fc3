"""Run manifest: which step wrote which folder, and whether it got to its end.

Every step of a run writes into a folder of its own below the run's folder and
is recorded twice, when it starts and when it has ended. Only outputs whose end
is recorded count. A run that stops half way therefore resumes behind its last
complete output; what an unfinished step left is never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quarry.session import discard, path_exists

SCHEMA = "seq bigint, phase string, state string, inputs array<string>, output string, n_rows bigint, note string"
STARTED, COMPLETE, FAILED = "started", "complete", "failed"


class Manifest:
    """The steps of all runs in ``folder`` (shared storage), one JSON record per event."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @property
    def path(self) -> str:
        return f"{self.folder}/manifest"

    def events(self) -> list[Row]:
        """All events in order; two for each step ever run in this folder."""
        if not path_exists(self.spark, self.path):
            return []
        return self.spark.read.schema(SCHEMA).json(self.path).orderBy("seq", F.desc("state")).collect()

    def _record(self, **event) -> None:
        row = [event.get(c) for c in ("seq", "phase", "state", "inputs", "output", "n_rows", "note")]
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").json(self.path)

    def outputs(self, phase: str) -> list[tuple[int, str]]:
        """(attempt, folder) of the phase's complete outputs that hold rows; attempts count from 1."""
        done = [e for e in self.events() if e["phase"] == phase and e["state"] == COMPLETE]
        return [(i, e["output"]) for i, e in enumerate(done, 1) if e["n_rows"]]

    def read(self, phase: str, schema: str) -> DataFrame:
        """All complete outputs of ``phase`` with their ``attempt``; no rows where there is none."""
        found = None
        for i, path in self.outputs(phase):
            part = self.spark.read.schema(schema).parquet(path).withColumn("attempt", F.lit(i))
            found = part if found is None else found.unionByName(part)
        return found if found is not None else self.spark.createDataFrame([], f"{schema}, attempt int")

    def step(self, phase: str, inputs: list[str], write: Callable[[str], int]) -> str:
        """Runs ``write(output folder) -> rows`` as one recorded step; an error is recorded and raised."""
        events = self.events()
        seq = 1 + max((e["seq"] for e in events), default=0)
        out = f"{self.folder}/{phase}/{seq:06d}"
        self._record(seq=seq, phase=phase, state=STARTED, inputs=inputs, output=out)
        try:
            n = write(out)
        except Exception as e:
            self._record(seq=seq, phase=phase, state=FAILED, inputs=inputs, output=out, note=str(e).split("\n")[0][:500])
            raise
        self._record(seq=seq, phase=phase, state=COMPLETE, inputs=inputs, output=out, n_rows=n)
        return out

    def drop_superseded(self, phase: str) -> None:
        """Removes outputs of ``phase`` before its last complete one, and what failed attempts at it left.

        For phases whose every output is whole by itself. A later read of an
        older output finds nothing, so callers take the last one.
        """
        events = [e for e in self.events() if e["phase"] == phase]
        done = [e["output"] for e in events if e["state"] == COMPLETE]
        for path in {e["output"] for e in events if done and e["output"] < done[-1]}:
            discard(self.spark, path)


def parquet_step(df: DataFrame, partition_by: str | None = None) -> Callable[[str], int]:
    """A ``write`` for ``Manifest.step``: ``df`` as Parquet, counted from the files' footers."""

    def write(path: str) -> int:
        w = df.write.mode("errorifexists")
        (w.partitionBy(partition_by) if partition_by else w).parquet(path)
        return df.sparkSession.read.parquet(path).count()

    return write
