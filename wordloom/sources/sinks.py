"""Writing generated text and training metrics."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_PLACEHOLDER = "{instant}"


def run_stamp() -> str:
    """Start time of a run, usable in a path."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H-%M-%S.%fZ")


def stamped(path: str, run_id: str) -> str:
    return path.replace(RUN_PLACEHOLDER, run_id)


def write_generated(generated: DataFrame, path: str) -> None:
    """One output line per seed, an empty one for a seed without output."""
    generated.select(F.coalesce("output", F.lit("")).alias("output")).write.mode("overwrite").text(path)


def write_metrics(epoch_metrics: DataFrame, path: str) -> None:
    """Header and one row per epoch, in one file: there are only as many rows as epochs."""
    row = epoch_metrics.coalesce(1).sortWithinPartitions("epoch").select(
        "epoch",
        F.format_string("%.6f", "learning_rate").alias("learning_rate"),
        F.format_string("%.4f", "avg_loss").alias("avg_loss"),
        F.format_string("%.2f", "accuracy_pct").alias("accuracy_pct"),
        "batches",
        "predictions",
        "duration_ms",
        "shards",
        "snapshots",
        "lines",
        "out_of_range",
        "partitions",
    )
    row.write.mode("overwrite").csv(path, header=True)


def write_validation(validation: DataFrame, path: str) -> None:
    """Header and one row per epoch of the metrics on held-out samples, in one file."""
    validation.coalesce(1).sortWithinPartitions("epoch").select(
        "epoch", "n", "accuracy", "precision", "recall", "f1"
    ).write.mode("overwrite").csv(path, header=True)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Keeps a result of many runs in one parquet table, partitioned by run."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)
