"""The model as a table: layer, name, shape, block_id, values."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.config import ModelConfig
from wordloom.functions import draws
from wordloom.operators.network import layout, model_sizes, parameter_count

MODEL_SCHEMA = "epoch int, layer int, name string, shape array<int>, block_id int, values array<double>"


def check_size(sizes: list[int], limit: int) -> None:
    """The parameters are held by the driver and every task, so their size is bounded up front."""
    size = parameter_count(sizes) * 8
    if size > limit:
        raise ValueError(f"model of {size} bytes is over the limit of {limit}")


def initial_model(spark: SparkSession, cfg: ModelConfig, sizes: list[int] | None = None) -> DataFrame:
    """Seeded weights gauss(layer, i, j) * sqrt(2 / (fan_in + fan_out)), biases 0, in blocks."""
    sizes = sizes or model_sizes(cfg)
    check_size(sizes, cfg.max_model_bytes)
    tensors, ends, end = layout(sizes), [], 0
    for _, _, shape in tensors:
        ends.append(end := end + int(np.prod(shape)))

    def by_tensor(values: list[Column]) -> Column:
        chosen = values[-1]
        for value, stop in reversed(list(zip(values, ends[:-1]))):
            chosen = F.when(F.col("id") < stop, value).otherwise(chosen)
        return chosen

    place = spark.range(end).select(
        "id",
        by_tensor([F.lit(layer) for layer, _, _ in tensors]).alias("layer"),
        by_tensor([F.lit(name) for _, name, _ in tensors]).alias("name"),
        by_tensor([F.array(*[F.lit(n) for n in shape]) for _, _, shape in tensors]).alias("shape"),
        (F.col("id") - by_tensor([F.lit(start) for start in [0, *ends[:-1]]])).alias("at"),
    )
    fan_in, fan_out = F.get("shape", F.lit(0)), F.get("shape", F.lit(1))
    drawn = draws.gauss(
        draws.digest(cfg.seed, F.col("layer"), F.floor(F.col("at") / fan_out), F.col("at") % fan_out)
    ) * F.sqrt(F.lit(2.0) / (fan_in + fan_out))
    value = F.when(F.col("name") == "weight", drawn).otherwise(F.lit(0.0))
    rows = place.select(
        "layer",
        "name",
        "shape",
        F.floor(F.col("at") / cfg.block_width).cast("int").alias("block_id"),
        F.struct("at", value.alias("value")).alias("entry"),
    )
    return (
        rows.groupBy("layer", "name", "shape", "block_id")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        .select(F.lit(0).alias("epoch"), "layer", "name", "shape", "block_id", F.col("entries.value").alias("values"))
    )


def to_array(model: DataFrame, sizes: list[int]) -> np.ndarray:
    """The flat parameters of a model table. Their number is fixed by the configuration."""
    table = model.select("layer", "name", "shape", "block_id", "values").toArrow()
    # A layer's weight comes before its bias.
    table = table.sort_by([("layer", "ascending"), ("name", "descending"), ("block_id", "ascending")])
    places = list(zip(*(table[c].to_pylist() for c in ("layer", "name", "block_id"))))
    shapes = {(layer, name): tuple(s) for (layer, name, _), s in zip(places, table["shape"].to_pylist())}
    flat = table["values"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    expected = {(layer, name): shape for layer, name, shape in layout(sizes)}
    if shapes != expected or len(set(places)) != len(places) or flat.size != parameter_count(sizes):
        raise ValueError("model table does not fit the configured sizes")
    return flat


def split_blocks(sizes: list[int], width: int) -> list[tuple[int, str, list[int], int, int]]:
    """(layer, name, shape, block_id, length) of each block, in flat order."""
    return [
        (layer, name, list(shape), block, min(width, count - start))
        for layer, name, shape in layout(sizes)
        for count in [int(np.prod(shape))]
        for block, start in enumerate(range(0, count, width))
    ]


def to_table(spark: SparkSession, flat: np.ndarray, sizes: list[int], epoch: int, width: int) -> DataFrame:
    """A model table from flat parameters."""
    rows, at = [], 0
    for *place, length in split_blocks(sizes, width):
        rows.append((epoch, *place, flat[at : at + length].tolist()))
        at += length
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def save_model(model: DataFrame, path: str) -> None:
    model.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)
