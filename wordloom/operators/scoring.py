"""Batch prediction and loss with a trained model."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wordloom.config import ModelConfig
from wordloom.operators.arrow import list_rows, numbers
from wordloom.operators.model import check_size, to_array
from wordloom.operators.network import ContextFeatures, Network, as_outputs, log_softmax, model_sizes

# Rows scored at once: bounds the [rows, outputs] matrix of a task.
CHUNK = 2048


def predict(
    rows: DataFrame, model: DataFrame, cfg: ModelConfig, sizes: list[int] | None = None
) -> DataFrame:
    """Adds prediction, prob (of the prediction) and nll (of the label, if rows have one).

    Rows carry either `features` or a `context` from which features are computed in the task. A
    context that is not full is scored on zero features and has nll 0. Labels from the last output on are
    scored as that output. Narrow: rows stay in their partitions.
    """
    sizes = sizes or model_sizes(cfg)
    check_size(sizes, cfg.max_model_bytes)
    flat = to_array(model, sizes).astype(cfg.dtype)
    shared = rows.sparkSession.sparkContext.broadcast(flat)
    from_features, has_label = "features" in rows.columns, "label" in rows.columns
    schema = StructType.fromDDL("prediction bigint, prob double, nll double")
    out_schema = StructType(rows.schema.fields + schema.fields)

    def score(batches):
        net, featurize = Network(shared.value, sizes), ContextFeatures(cfg)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                if from_features:
                    x, full = list_rows(part.column("features"), sizes[0])
                else:
                    contexts, full = list_rows(part.column("context"), cfg.window_size)
                    x = featurize(contexts, full)
                logp = log_softmax(net.logits(x.astype(cfg.dtype)))
                best = logp.argmax(axis=1)
                at = np.arange(len(x))
                nll = pa.nulls(len(x), pa.float64())
                if has_label:
                    labels = numbers(part.column("label")).astype(np.int64)
                    picked = -logp[at, as_outputs(labels, sizes[-1])].astype(np.float64) * full
                    nll = pa.array(picked, pa.float64())
                new = [
                    pa.array(best.astype(np.int64)),
                    pa.array(np.exp(logp[at, best]).astype(np.float64)),
                    nll,
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *new], names=[*part.schema.names, *schema.names]
                )

    return rows.mapInArrow(score, out_schema)


def folded(scored: DataFrame, cfg: ModelConfig) -> DataFrame:
    """Labels as outputs: those beyond the first vocabulary_size are the last one."""
    return scored.withColumn("label", F.least("label", F.lit(cfg.vocabulary_size).cast("bigint")))


def loss(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Negative log-likelihood summed over the rows and divided by their number, per key or overall."""
    return scored.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("rows"), (F.sum("nll") / F.count(F.lit(1))).alias("loss")
    )
