"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line.
Every query is fully executed into Spark's ``noop`` sink (no collect to the
driver); the reported time per query is the median of ``$BENCH_REPEAT``
runs on a warm JVM, and ``value`` is the sum of those medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "prepare_no_filter",
    "prepare_with_filter",
    "clean_text",
    "html_to_text",
    "article_record",
    "extract_links",
    "new_ids_anti",
    "rule_filter",
    "train_eval_split",
    "length_stats_overall",
    "length_histogram",
    "pack_sequences",
    "ngram_perplexity",
    "entropy_summary",
    "semantic_clusters",
    "best_checkpoint",
    "group_responses",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from quarry.session import ensure_checkpoint_dir, get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="quarry-bench")
    ensure_checkpoint_dir(spark)
    from quarry.plans import catalogue

    queries = catalogue.QUERIES
    keys = [k for k in HEADLINE if k in queries]

    def run(k: str) -> float:
        t0 = time.perf_counter()
        queries[k].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("word_count")  # warm the JVM, the Python workers and the file listing cache
    times: dict[str, float | None] = {}
    failed: list[str] = []
    for k in keys:
        try:
            times[k] = round(statistics.median(run(k) for _ in range(repeat)), 3)
        except Exception as e:  # noqa: BLE001 - report the failure, keep measuring the rest
            times[k] = None
            failed.append(f"{k}: {str(e).splitlines()[0][:200]}")
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(t for t in times.values() if t is not None), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeat": repeat,
                "failed": failed,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
