"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.catalogue import spark_queries  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = (
    "sft_examples",
    "encoded_docs",
    "decoded_docs",
    "bpe_merges",
    "word_counts",
    "pair_counts",
    "shuffle_order",
    "holdout_split",
    "split_leakage",
    "step_plan",
    "corpus_report",
    "validate_conversations",
    "request_outcomes",
    "replies",
    "judged_pairs",
    "preference_set",
    "repetition_penalty",
    "top_k",
    "top_p",
    "sampled_tokens",
    "masked_loss",
    "preference_metrics",
    "flat_tail",
    "run_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = spark_queries()
    # Start the JVM's scan path and the Python workers before anything is timed.
    queries["native_val"](spark, folder).collect()
    timings = {}
    for name in names:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
