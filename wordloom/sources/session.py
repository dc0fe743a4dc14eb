"""Materialising intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_fallback: dict[str, str] = {}  # one folder for an application in local mode


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only in local mode, where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _fallback.get(spark.sparkContext.applicationId)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="wordloom-checkpoint-")
    return _fallback.setdefault(spark.sparkContext.applicationId, folder)


def stable(df: DataFrame) -> DataFrame:
    """df written once to the checkpoint folder; partitions and row order are fixed from here on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def saved(df: DataFrame) -> DataFrame:
    """df written once as Parquet to the checkpoint folder and read from there.

    Later reads prune columns and push filters down. Rows stay as they are, partitions may be cut otherwise.
    The files stay until the folder is cleared, as those of a checkpoint do without the cleaner setting.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/saved-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def widened(df: DataFrame, *keys: str) -> DataFrame:
    """df spread over the cluster's cores by its keys, if its files give fewer partitions than that.

    Tables of many splits are left as they are, so no large table is shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def task_limit(spark: SparkSession, given: int | None = None, waves: int = 4) -> int:
    """Tasks for work that is heavy for its bytes: a few for each core, unless given."""
    if given is not None:
        return given
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return waves * max(spark.sparkContext.defaultParallelism, shuffle)


def dense_ids(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Adds 0-based consecutive ids in the given order, without a one-partition window.

    Rows are range-sorted and written once; an id is the row's place in its partition plus the
    sizes of the partitions before it. Only one number per partition reaches the driver.
    """
    spark = df.sparkSession
    placed = stable(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted(placed.groupBy(part.alias("_part")).count().collect())
    offsets, before = [], start
    for number, rows in sizes:
        offsets.append((number, before))
        before += rows
    offset_table = spark.createDataFrame(offsets, "_part bigint, _before bigint")
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offset_table), "_part")
        .withColumn(name, F.col("_before") + local)
        .drop("_at", "_part", "_before")
    )
