"""Preprocessing run (I2) in phases over any tables.

``regex``   extracted texts -> cleaned texts with catalog metadata
``llm``     cleaned texts -> verdicts (accepted texts, rejects)
``format``  texts -> training examples, seeded split, JSON lines, summary
``all``     regex, llm, format; ``no-llm``: regex, format on the cleaned texts

Each phase skips what its complete outputs hold already (X14, L10) and appends
the rest as a new output; rejected texts are judged again by the next ``llm``
phase. A phase called alone reads what earlier runs in the same folder left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.manifest import Manifest, parquet_step
from quarry.operators import clean as X
from quarry.operators import filtering as L
from quarry.operators import formatting as FM
from quarry.operators import headers as H
from quarry.operators import splits as T
from quarry.sources import io as S

PHASES = ("regex", "llm", "format", "all", "no-llm")
CLEANED = "stem string, source string, title string, date string, lang string, content string"
SUMMARY = "total_processed bigint, train_samples bigint, eval_samples bigint, total_words bigint, format_style string, llm_filtered boolean, rejected_count bigint"
JUDGED = "source string, title string, date string, rejected boolean, reason string, reasoning string, content string"


@dataclass
class Prepared:
    """What a run left: folders of its format output, or None where nothing was formatted."""

    manifest: Manifest
    examples: DataFrame | None = None
    summary: DataFrame | None = None
    output: str | None = None


def stem(name: str = "source"):
    return F.regexp_replace(F.col(name), r"\.[^.]*$", "")


def regex_phase(m: Manifest, documents: DataFrame, catalog: DataFrame, cap: int | None = None) -> str:
    """Texts whose file stem is in no complete output yet, cleaned.

    documents: (source, raw_text) and, where known, lang. Rows without a source
    are cleaned in every run. ``cap`` drops longer cleaned texts (X11), as a
    stated choice: none by default.
    """
    docs = documents if "lang" in documents.columns else documents.withColumn("lang", F.lit(None).cast("string"))
    docs = docs.select("source", "raw_text", "lang").withColumn("stem", stem())
    todo = X.skip_processed(docs, m.read("regex", CLEANED), "stem")
    x = X.clean_documents(X.enrich_metadata(todo, catalog), cap=cap)
    x = x.select("stem", "source", FM._strip(F.col("title")).alias("title"), "date", "lang", F.col("cleaned").alias("content"))
    return m.step("regex", [p for _, p in m.outputs("regex")], parquet_step(x))


def llm_phase(m: Manifest, make_generator: Callable | None = None, header_share: float | None = None) -> str:
    """L10, then L1-L8 by ``make_generator`` (see ``filtering.score_batches``), else by the rules.

    Sources accepted before are skipped, all others judged; each is judged in
    one pass, whose verdicts are written once for accepted and rejected. With
    ``header_share``, lines that stand in that share of all cleaned texts go first
    (repeated headers).
    """
    known = accepted(m)
    texts = m.read("regex", CLEANED).drop("attempt").withColumnRenamed("content", "text")
    if header_share is not None:
        texts = H.drop_lines(texts, H.line_frequencies(texts, "text", header_share), "text").drop("n_removed")
    todo = L.skip_filtered(texts, known)
    if make_generator is None:
        v = L.verdicts(todo.withColumn("generated", L.rule_verdict("title", "text", "lang")), head_only=False)
    else:
        v = L.verdicts(L.score_batches(todo, make_generator))
    cols = [c.split()[0] for c in JUDGED.split(", ")]
    return m.step("llm", [p for _, p in m.outputs("regex")], parquet_step(v.select(*cols)))


def accepted(m: Manifest) -> DataFrame:
    """Accepted texts of all complete ``llm`` outputs."""
    return m.read("llm", JUDGED).filter(~F.col("rejected"))


def rejected(m: Manifest) -> DataFrame:
    """Rejects of the last complete ``llm`` output: what it judged and did not accept."""
    last = m.outputs("llm")[-1:]
    v = m.read("llm", JUDGED)
    return v.filter(F.col("rejected") & (F.col("attempt") == (last[0][0] if last else 0))).select("source", "title", "reason", "reasoning")


def format_phase(m: Manifest, phase: str, style: str, ratio: float, seed: int) -> Prepared:
    """F9, F10, T1, S8, S9, T3, S11. Without any text nothing is written and no summary made."""
    cleaned, good = m.read("regex", CLEANED), accepted(m)
    source, filtered = FM.select_source(good, cleaned, phase)
    if source.isEmpty():
        return Prepared(m)
    ex = T.train_eval_split(FM.training_examples(source, style), "source_pdf", ratio, seed)
    spark, used = m.spark, phase in ("llm", "all")

    def write(path: str) -> int:
        S.write_splits(ex, f"{path}/splits")
        done = spark.read.parquet(f"{path}/splits")
        S.write_jsonl(done, f"{path}/jsonl")
        S.write_summary(T.run_summary(done, style, used, rejected(m) if used else None), f"{path}/summary")
        return done.count()

    out = m.step("format", [p for _, p in m.outputs("llm" if filtered else "regex")], write)
    m.drop_superseded("format")
    return Prepared(m, spark.read.parquet(f"{out}/splits"), spark.read.schema(SUMMARY).json(f"{out}/summary"), out)


def preprocess(
    spark: SparkSession,
    folder: str,
    documents: DataFrame | None = None,
    catalog: DataFrame | None = None,
    phase: str = "no-llm",
    style: str = "instruct",
    ratio: float = fixed.DEFAULT_TRAIN_RATIO,
    seed: int = fixed.DEFAULT_SEED,
    make_generator: Callable | None = None,
    cap: int | None = None,
    header_share: float | None = None,
) -> Prepared:
    """Runs ``phase`` (one of ``PHASES``) in ``folder``, which all executors share.

    ``documents`` and ``catalog`` are needed by phases that clean; without a
    catalog, titles are file stems and dates empty. ``header_share`` switches the
    removal of repeated header lines on in the llm phase. An empty result leaves
    ``examples`` and ``summary`` None, whichever phase it was.
    """
    if phase not in PHASES:
        raise ValueError(f"phase must be one of {', '.join(PHASES)}: {phase}")
    m = Manifest(spark, folder)
    if phase in ("regex", "all", "no-llm"):
        if documents is None:
            raise ValueError(f"phase {phase} needs documents")
        if catalog is None:
            catalog = spark.createDataFrame([], "idx bigint, title string, date string")
        regex_phase(m, documents, catalog, cap)
    if phase in ("llm", "all"):
        llm_phase(m, make_generator, header_share)
    if phase in ("format", "all", "no-llm"):
        return format_phase(m, phase, style, ratio, seed)
    return Prepared(m)
