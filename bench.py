"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from wordloom.plans.registry import queries

HEADLINE = (
    "corpus_stats distinct_words fit_vocab extend_vocab encode decode sliding_windows_w1 training_samples "
    "minibatches token_embedding sample_features self_attention_w2 average_params predict "
    "train_epoch validation_metrics generate"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wordloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.environ.get("CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="wordloom-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    all_queries, times = queries(), {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.monotonic()
        all_queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(folder)),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
