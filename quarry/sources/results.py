"""Evaluation-result sink and scan (S12) and the model leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import shared_dir


def result_name(model: str, config: str | None = None) -> str:
    """S12 naming rule: config file stem if given, else the model id's last segment."""
    if config:
        stem = config.rsplit("/", 1)[-1]
        stem = stem.rsplit(".", 1)[0] if "." in stem else stem
        return f"evaluation_results_{stem}.json"
    return f"evaluation_results_{model.rsplit('/', 1)[-1]}.json"


def result_name_col(model, config=None):
    """Column form of ``result_name``."""
    last = F.element_at(F.split(model, "/"), -1)
    if config is None:
        return F.concat(F.lit("evaluation_results_"), last, F.lit(".json"))
    stem = F.regexp_replace(F.element_at(F.split(config, "/"), -1), r"\.[^.]*$", "")
    return F.concat(F.lit("evaluation_results_"), F.coalesce(stem, last), F.lit(".json"))


#: A model's record; a metric's ``error`` is null unless it failed, a skipped metric is null.
RESULT_SCHEMA = (
    "model_path string, config string, "
    "perplexity struct<perplexity:double,avg_loss:double,total_tokens:bigint,error:string>, "
    "semantic_entropy struct<mean_entropy:double,max_entropy:double,min_entropy:double,error:string>, "
    "generations struct<n_prompts:bigint,n_responses:bigint,output:string,error:string>, result_name string"
)


def write_results(results: DataFrame, spark: SparkSession, path: str | None = None) -> str:
    """Write one nested JSON record per model, partitioned by result name; a written name is replaced, others stay."""
    out = path or shared_dir(spark, "eval-results")
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("result_name").json(out)
    return out


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Scan result records back."""
    return spark.read.schema(RESULT_SCHEMA).json(path)


def leaderboard(results: DataFrame) -> DataFrame:
    """Perplexity and mean entropy per model with ranks (lower is better).

    The ranking windows run over one row per model, a table bounded by the
    number of evaluated models.
    """
    ppl = F.round(F.col("perplexity.perplexity"), 6)
    ent = F.round(F.col("semantic_entropy.mean_entropy"), 6)
    base = results.select(F.col("model_path").alias("model"), ppl.alias("perplexity"), ent.alias("mean_entropy"))
    return base.select(
        "model",
        "perplexity",
        "mean_entropy",
        F.rank().over(Window.orderBy("perplexity")).alias("perplexity_rank"),
        F.rank().over(Window.orderBy("mean_entropy")).alias("entropy_rank"),
    )
