"""Sums over batches, epoch metrics, classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = (
    "epoch int, shard int, batch_no bigint, loss double, correct bigint, total bigint, "
    "grad_mean double, grad_max double, grad_min double"
)


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOG_SCHEMA)


def batch_totals(log: DataFrame) -> DataFrame:
    """Loss, correct, predictions and batches per epoch."""
    return log.groupBy("epoch").agg(
        F.sum("loss").alias("total_loss"),
        F.sum("correct").alias("correct"),
        F.sum("total").alias("predictions"),
        F.count(F.lit(1)).alias("batches"),
    )


def epoch_accuracy(totals: DataFrame) -> DataFrame:
    """Adds the average loss and the accuracy, which is 0.0 without predictions."""
    return totals.withColumn("avg_loss", F.col("total_loss") / F.col("batches")).withColumn(
        "accuracy",
        F.when(F.col("predictions") > 0, F.col("correct") / F.col("predictions")).otherwise(F.lit(0.0)),
    )


def epoch_metrics(log: DataFrame, durations: list[tuple[int, float, int]], counts: dict) -> DataFrame:
    """One row per epoch; durations hold (epoch, learning rate, milliseconds)."""
    timed = log.sparkSession.createDataFrame(
        durations, "epoch int, learning_rate double, duration_ms bigint"
    )
    return (
        epoch_accuracy(batch_totals(log))
        .join(F.broadcast(timed), "epoch")
        .select(
            "epoch",
            F.round("learning_rate", 6).alias("learning_rate"),
            F.round("avg_loss", 4).alias("avg_loss"),
            F.round(F.col("accuracy") * 100, 2).alias("accuracy_pct"),
            "batches",
            "predictions",
            "duration_ms",
            F.lit(counts["shards"]).alias("shards"),
            F.col("batches").alias("snapshots"),
            F.lit(counts["lines"]).alias("lines"),
            F.lit(counts["out_of_range"]).alias("out_of_range"),
            F.lit(counts["partitions"]).alias("partitions"),
        )
    )


def gradient_stats(log: DataFrame) -> DataFrame:
    """Mean, maximum and minimum gradient per epoch, over the batches that recorded them."""
    return (
        log.where(F.col("grad_mean").isNotNull())
        .groupBy("epoch")
        .agg(
            F.avg("grad_mean").alias("grad_mean"),
            F.max("grad_max").alias("grad_max"),
            F.min("grad_min").alias("grad_min"),
            F.count(F.lit(1)).alias("recorded"),
        )
    )


def confusion(predictions: DataFrame) -> DataFrame:
    """label, prediction, n."""
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each class, from confusion counts."""
    classes = counts.select(
        "n", F.explode(F.array_distinct(F.array("label", "prediction"))).alias("class"), "label", "prediction"
    )
    hit = (F.col("label") == F.col("class")) & (F.col("prediction") == F.col("class"))
    per_class = classes.groupBy("class").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("hits"),
        F.sum(F.when((F.col("label") == F.col("class")) & ~hit, F.col("n")).otherwise(0)).alias("missed"),
        F.sum(F.when((F.col("prediction") == F.col("class")) & ~hit, F.col("n")).otherwise(0)).alias("wrong"),
    )
    precision = F.when(F.col("hits") + F.col("wrong") > 0, F.col("hits") / (F.col("hits") + F.col("wrong")))
    recall = F.when(F.col("hits") + F.col("missed") > 0, F.col("hits") / (F.col("hits") + F.col("missed")))
    scored = per_class.select(
        "class",
        (F.col("hits") + F.col("missed")).alias("support"),
        F.coalesce(precision, F.lit(0.0)).alias("precision"),
        F.coalesce(recall, F.lit(0.0)).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    return scored.withColumn(
        "f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0))
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: count, accuracy, and precision, recall and F1 weighted by class support."""
    counts = confusion(predictions)
    per_class = class_metrics(counts)

    def weighted(name: str):
        return (F.sum(F.col(name) * F.col("support")) / F.sum("support")).alias(name)

    # Weighted recall is the accuracy: hits over support, weighted by support.
    return per_class.agg(
        F.sum("support").alias("n"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    ).withColumn("accuracy", F.col("recall"))
