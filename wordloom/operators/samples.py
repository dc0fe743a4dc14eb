"""Training samples: sliding windows, batches, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.config import Limits, ModelConfig
from wordloom.functions import draws
from wordloom.functions.text import split_words
from wordloom.operators.vocab import encode
from wordloom.sources.session import task_limit

# Tasks of a training pass for each core, and the shards of a task at most if more tasks are needed for that.
WAVES = 8
SHARDS_PER_TASK = 50


def _places(size: Column, width: int) -> Column:
    """Where the windows of `size` words begin: one for every run of `width`, or a partial one; null without words."""
    last = F.when(size > width, size - width - 1).when(size > 0, F.lit(0))
    return F.when(last.isNotNull(), F.sequence(F.lit(0), last))


def window_places(lines: DataFrame, width: int) -> DataFrame:
    """doc_id, line_no, k: the keys of sliding_windows, for which words are counted and need no ids. Narrow."""
    counted = lines.select("doc_id", "line_no", F.size(split_words(F.col("line"))).alias("n"))
    return counted.select("doc_id", "line_no", F.explode(_places(F.col("n"), width)).alias("k"))


def sliding_windows(encoded: DataFrame, width: int) -> DataFrame:
    """doc_id, line_no, k, context, label, is_partial: every run of `width` ids and the id after it.

    A line of 1 to `width` ids gives one partial window, an empty line none. Narrow: places are exploded
    and a window is cut at each, so a row never holds all windows of a line.
    """
    size, k = F.size("ids"), F.col("k")
    places = F.explode(_places(size, width)).alias("k")
    placed = encoded.select("doc_id", "line_no", (size <= width).alias("is_partial"), places, "ids")
    cut = F.when(F.col("is_partial"), F.size("ids") - 1).otherwise(F.lit(width))
    return placed.select(
        "doc_id",
        "line_no",
        "k",
        F.slice("ids", k + 1, cut).alias("context"),
        F.get("ids", k + cut).alias("label"),
        "is_partial",
    )


def training_samples(
    lines: DataFrame, vocab: DataFrame, width: int, limits: Limits | None = None
) -> DataFrame:
    """Samples of a whole corpus."""
    return sliding_windows(encode(lines, vocab, limits), width)


def shard_of(seed: int, num_shards: int) -> Column:
    """Shard a sample belongs to: an even spread, whatever the documents' sizes."""
    sample = draws.digest(seed, F.col("doc_id"), F.col("line_no"), F.col("k"))
    return (draws.hash60(sample, 17) % num_shards).cast("int")


def assign_batches(samples: DataFrame, num_shards: int, batch_size: int, seed: int = 42) -> DataFrame:
    """Adds shard and batch_no. Batches follow corpus order within a shard; the last may be short.

    The shard count is derived from the row count (ModelConfig.shards_for), so a shard is bounded.
    """
    in_shard = Window.partitionBy("shard").orderBy("doc_id", "line_no", "k")
    return samples.withColumn("shard", shard_of(seed, num_shards)).withColumn(
        "batch_no", F.floor((F.row_number().over(in_shard) - 1) / batch_size).cast("bigint")
    )


def shard_tasks(spark: SparkSession, num_shards: int, cfg: ModelConfig) -> int:
    """Tasks of a pass: as each sends a whole set of parameters, no more than balance and the bytes of a task ask for."""
    if cfg.max_tasks is not None:
        return min(num_shards, cfg.max_tasks)
    even = WAVES * spark.sparkContext.defaultParallelism
    return min(num_shards, max(even, task_limit(spark, waves=1), -(-num_shards // SHARDS_PER_TASK)))


def shard_samples(samples: DataFrame, num_shards: int, cfg: ModelConfig) -> DataFrame:
    """Each shard whole in one partition, in corpus order: what a training pass reads."""
    tasks = shard_tasks(samples.sparkSession, num_shards, cfg)
    return (
        samples.select(
            "doc_id", "line_no", "k", "context", "label", shard_of(cfg.seed, num_shards).alias("shard")
        )
        .repartitionById(tasks, F.col("shard") % tasks)
        .sortWithinPartitions("shard", "doc_id", "line_no", "k")
    )


def one_hot(samples: DataFrame, width: int) -> DataFrame:
    """Adds the label's one-hot row in sparse form; a label beyond the width has no entry."""
    fits = (F.col("label") >= 0) & (F.col("label") < width)
    return samples.withColumn(
        "one_hot",
        F.struct(
            F.lit(width).alias("size"),
            F.when(fits, F.array(F.col("label").cast("int")))
            .otherwise(F.array().cast("array<int>"))
            .alias("indices"),
            F.when(fits, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
        ),
    )
