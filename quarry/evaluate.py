"""Evaluation run (E14): every metric of every model as a job of its own.

A metric is a function that returns a table. Its table is written as one step
of the run's manifest; a metric that fails, while it is planned or inside a
task, leaves its message in its own part of the model's record and the others
stay. The record of a model goes to ``results`` as one JSON object (S12), which
the leaderboard (E16) scans with a fixed schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarry.manifest import Manifest, parquet_step
from quarry.sources import results as RS

PERPLEXITY = ("perplexity", "avg_loss", "total_tokens")
ENTROPY = ("mean_entropy", "max_entropy", "min_entropy")


@dataclass
class Model:
    """A model to evaluate: its path, its training config if it has one, and its metrics by name.

    ``perplexity`` and ``semantic_entropy`` return one row with the columns above
    (E3, E10), ``generations`` one row per prompt with its ``responses`` (E13).
    A metric that is not given is skipped and stays null.
    """

    path: str
    metrics: Mapping[str, Callable[[], DataFrame]]
    config: str | None = None


def _values(m: Manifest, model: Model, metric: str, read: Callable[[DataFrame, str], dict]) -> dict | None:
    if metric not in model.metrics:
        return None
    try:
        out = m.step(f"{RS.result_name(model.path, model.config).removesuffix('.json')}/{metric}", [model.path], lambda path: parquet_step(model.metrics[metric]())(path))
        return read(m.spark.read.parquet(out), out)
    except Exception as e:  # noqa: BLE001 - a metric's failure belongs into its record
        return {"error": f"{type(e).__name__}: {str(e)}"[:1000]}


def record(m: Manifest, model: Model) -> dict:
    """Runs the model's metrics one after another; each leaves its values or its error."""
    from pyspark.sql import functions as F

    def one_row(names):
        return lambda df, _: {n: v for n, v in df.first().asDict().items() if n in names}

    def listed(df: DataFrame, out: str) -> dict:
        n = df.agg(F.count("*").alias("p"), F.coalesce(F.sum(F.size("responses")), F.lit(0)).alias("r")).first()
        return {"n_prompts": n["p"], "n_responses": n["r"], "output": out}

    return {
        "model_path": model.path,
        "config": model.config,
        "perplexity": _values(m, model, "perplexity", one_row(PERPLEXITY)),
        "semantic_entropy": _values(m, model, "semantic_entropy", one_row(ENTROPY)),
        "generations": _values(m, model, "generations", listed),
        "result_name": RS.result_name(model.path, model.config),
    }


def evaluate(spark: SparkSession, folder: str, models: Iterable[Model]) -> DataFrame:
    """Evaluates ``models`` in ``folder`` (shared storage); their records, as read back from it.

    Records are written model by model, so what has been evaluated stays when a
    later model breaks the run. A model that is evaluated again replaces its record.
    """
    m = Manifest(spark, folder)
    out = f"{m.folder}/results"
    for model in models:
        RS.write_results(spark.createDataFrame([record(m, model)], RS.RESULT_SCHEMA), spark, out)
    return RS.read_results(spark, out)
