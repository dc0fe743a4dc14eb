"""Distributed training: one sequential pass per shard, parameters averaged, epoch after epoch."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wordloom.config import ModelConfig
from wordloom.operators import metrics, scoring
from wordloom.operators.arrow import list_rows, numbers
from wordloom.operators.model import check_size, initial_model, split_blocks, to_array, to_table
from wordloom.operators.network import ContextFeatures, Trainer, as_outputs, dropout, model_sizes
from wordloom.operators.samples import shard_samples
from wordloom.sources.session import saved, stable

# One job writes both kinds of row of a pass, so that training runs once.
PASS_SCHEMA = (
    "kind string, shard int, batch_no bigint, loss double, correct bigint, total bigint, "
    "grad_mean double, grad_max double, grad_min double, "
    "layer int, name string, shape array<int>, block_id int, snapshots bigint, values array<double>"
)
PASS_TYPES = pa.schema(
    [
        ("kind", pa.string()),
        ("shard", pa.int32()),
        ("batch_no", pa.int64()),
        ("loss", pa.float64()),
        ("correct", pa.int64()),
        ("total", pa.int64()),
        ("grad_mean", pa.float64()),
        ("grad_max", pa.float64()),
        ("grad_min", pa.float64()),
        ("layer", pa.int32()),
        ("name", pa.string()),
        ("shape", pa.list_(pa.int32())),
        ("block_id", pa.int32()),
        ("snapshots", pa.int64()),
        ("values", pa.list_(pa.float64())),
    ]
)
GRADIENT_EVERY = 10
GROUPED_FROM = 64  # tasks: with fewer, their sums are shuffled as they are
LARGEST = 8  # the size of parameters for which sums on the grid are exact


def sum_grid(batches: int) -> float:
    """Step, as 1/grid, on which shards round their parameter sums.

    Numbers on one grid add exactly while the total stays below 2^53 steps, here for parameters up to
    8 in size. So the average does not depend on how shards meet in tasks, or in what order Spark adds.
    """
    return 2.0 ** max(0, 50 - int(batches).bit_length())


class ShardPass:
    """The pass of one shard: starts from the given parameters and walks its batches in order."""

    def __init__(
        self, flat: np.ndarray, sizes: list[int], cfg: ModelConfig, epoch: int, shard: int, scores: bool = True, steps: bool = True
    ):
        self.net, self.steps = Trainer(flat.astype(cfg.dtype), sizes) if steps else None, steps
        self.cfg, self.epoch, self.shard, self.scores = cfg, epoch, shard, scores
        self.sum = np.zeros(flat.size)
        self.batch_no, self.log = 0, []

    def step(self, x: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> None:
        """Score, update, predict on one batch. Scores and predictions are for the log alone, so they may be left out.

        A pass without steps counts the batch and leaves its arithmetic out.
        """
        if not self.steps:
            self.log.append(("batch", self.shard, self.batch_no, None, None, len(x), None, None, None))
            self.batch_no += 1
            return
        x, labels = x.astype(self.cfg.dtype), as_outputs(labels, self.net.sizes[-1])
        loss = self.net.loss(x, labels, mask) if self.scores else None
        key = [self.cfg.seed, self.epoch, self.shard, self.batch_no]
        keeps = dropout(len(x), self.net.sizes, self.cfg.drop_prob, key, self.cfg.dtype)
        grad = self.net.gradient(x, labels, mask, keeps)
        stats = (None, None, None)
        if self.batch_no % GRADIENT_EVERY == 0:
            stats = (float(grad.mean(dtype=np.float64)), float(grad.max()), float(grad.min()))
        self.net.adam(self.cfg.learning_rate(self.epoch), total=self.sum)
        correct = int((self.net.logits(x).argmax(axis=1) == labels).sum()) if self.scores else None
        self.log.append(("batch", self.shard, self.batch_no, loss, correct, len(x), *stats))
        self.batch_no += 1

    def log_batch(self) -> pa.RecordBatch:
        """The batch rows logged since the last call."""
        log, self.log = self.log, []
        return _record_batch(dict(zip(LOG_COLUMNS, zip(*log))), len(log))


def _params_batch(total: np.ndarray, snapshots: int, sizes: list[int], width: int) -> pa.RecordBatch:
    """The sum of the parameters after every batch of a task, in blocks."""
    *places, lengths = zip(*split_blocks(sizes, width))
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    columns = dict(zip(("layer", "name", "shape", "block_id"), places))
    rows = len(lengths)
    columns |= {"kind": ["params"] * rows, "snapshots": [snapshots] * rows}
    columns["values"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(total))
    return _record_batch(columns, rows)


LOG_COLUMNS = ("kind", "shard", "batch_no", "loss", "correct", "total", "grad_mean", "grad_max", "grad_min")


def _record_batch(columns: dict, rows: int) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in PASS_TYPES
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=PASS_TYPES)


def run_pass(
    sharded: DataFrame,
    flat: np.ndarray,
    cfg: ModelConfig,
    epoch: int,
    sizes: list[int],
    grid: float,
    scores: bool = True,
    steps: bool = True,
) -> DataFrame:
    """Batch rows and parameter-sum rows of one epoch. Every shard starts from the broadcast parameters.

    Without scores, loss and correct of the batch rows are null; two of five products of a step are for them. Without
    steps, the same walk only counts the rows of its batches: their gradients are null too, and there are no sums.
    """
    check_size(sizes, cfg.max_model_bytes)
    shared, flat_size = sharded.sparkSession.sparkContext.broadcast(flat), flat.size

    def walk(batches):
        featurize, current, held = ContextFeatures(cfg), None, []
        total, snapshots = np.zeros(flat_size), 0

        def take(everything: bool) -> None:
            """Steps through the held rows in whole batches; the rest waits for more rows."""
            nonlocal held
            x, labels, mask = (np.concatenate(part) for part in zip(*held))
            size = cfg.batch_size
            end = len(x) if everything else len(x) // size * size
            for at in range(0, end, size):
                stop = min(at + size, end)
                current.step(x[at:stop], labels[at:stop], mask[at:stop])
            held = [(x[end:], labels[end:], mask[end:])] if end < len(x) else []

        def finish() -> pa.RecordBatch:
            nonlocal total, snapshots
            if held:
                take(True)
            if not steps:
                return current.log_batch()
            if np.abs(current.sum).max() > LARGEST * current.batch_no:
                raise OverflowError(f"parameters over {LARGEST} in size: their sums would not be exact")
            total += np.rint(current.sum * grid) / grid
            snapshots += current.batch_no
            return current.log_batch()

        for batch in batches:
            shards = numbers(batch.column("shard"))
            # Without steps, of a batch only the number of its rows is asked.
            contexts = full = labels = shards
            if steps:
                contexts, full = list_rows(batch.column("context"), cfg.window_size)
                labels = numbers(batch.column("label"))
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if current is None or current.shard != shards[start]:
                    if current is not None:
                        yield finish()
                    current = ShardPass(shared.value, sizes, cfg, epoch, int(shards[start]), scores, steps)
                part = slice(start, end)
                x = featurize(contexts[part], full[part]) if steps else contexts[part]
                held.append((x, labels[part], full[part].astype(float)))
                take(False)
                if len(current.log) >= 5000:
                    yield current.log_batch()
        if current is not None:
            yield finish()
            if steps:
                yield _params_batch(total, snapshots, sizes, cfg.block_width)

    read = ["shard", "context", "label"] if steps else ["shard"]
    done = stable(sharded.select(*read).mapInArrow(walk, PASS_SCHEMA))
    shared.destroy()
    return done


def average_vectors(df: DataFrame, keys: list[str], values: str, weight: Column, width: int) -> DataFrame:
    """keys, n, values: for each key, the sum of its vectors divided by the sum of their weights.

    Element sums are plain aggregates, so each task sends one row per key however frequent the key.
    Vectors may be shorter than width.
    """
    sums = [F.sum(F.get(F.col(values), F.lit(i))).alias(f"_s{i}") for i in range(width)]
    total = df.groupBy(*keys).agg(F.sum(weight).alias("n"), *sums)
    mean = F.array_compact(F.array(*[F.col(f"_s{i}") / F.col("n") for i in range(width)]))
    return total.select(*keys, "n", mean.alias(values))


def grouped_tasks(params: DataFrame) -> DataFrame:
    """The sums of tasks, read in groups of about the square root of their number.

    Each task sends a whole set of parameters. A group adds up its tasks' sums before the shuffle, so that moves a set for
    each group, not for each task; sums on the grid are exact, so groups give the same bits.
    """
    tasks = params.rdd.getNumPartitions()
    return params.coalesce(max(1, math.isqrt(tasks - 1) + 1)) if tasks > GROUPED_FROM else params


def average_params(passed: DataFrame, epoch: int, width: int) -> DataFrame:
    """The model averaged over the snapshots after every batch of every shard."""
    params = grouped_tasks(passed.where(F.col("kind") == "params"))
    mean = average_vectors(params, ["layer", "name", "shape", "block_id"], "values", F.col("snapshots"), width)
    return mean.select(F.lit(epoch).alias("epoch"), "layer", "name", "shape", "block_id", "values")


def batch_rows(passed: DataFrame, epoch: int) -> DataFrame:
    """The per-batch log of a pass."""
    return passed.where(F.col("kind") == "batch").select(
        F.lit(epoch).alias("epoch"),
        "shard",
        "batch_no",
        "loss",
        "correct",
        "total",
        "grad_mean",
        "grad_max",
        "grad_min",
    )


@dataclass
class TrainResult:
    model: DataFrame
    batch_log: DataFrame
    epoch_metrics: DataFrame
    validation: DataFrame | None = None


def counted(samples: DataFrame, cfg: ModelConfig) -> tuple[DataFrame, dict]:
    """Samples written once, with their counts, which the shards depend on.

    The samples are counted while they are written, so they are made and read once. Labels beyond the first
    vocabulary_size train the last output; out_of_range counts them.
    """
    # Counted by the tasks that write them: those of a job's last stage count once, however often they are tried.
    seen = Observation()
    samples = saved(
        samples.select("doc_id", "line_no", "k", "context", "label").observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("label") >= cfg.vocabulary_size).alias("out_of_range"),
            F.count_if(F.col("k") == 0).alias("lines"),
        )
    )
    counts = seen.get
    num_shards = cfg.shards_for(counts["rows"])
    batches = counts["rows"] // cfg.batch_size + num_shards
    return samples, {**counts, "shards": num_shards, "grid": sum_grid(batches)}


def prepare(samples: DataFrame, cfg: ModelConfig) -> tuple[DataFrame, dict]:
    """Samples sharded and written once for all epochs, with their counts."""
    samples, counts = counted(samples, cfg)
    # A checkpoint keeps partitions as they are: each shard is whole in one of them.
    sharded = stable(shard_samples(samples, counts["shards"], cfg))
    return sharded, {**counts, "partitions": sharded.rdd.getNumPartitions()}


def train(
    samples: DataFrame,
    cfg: ModelConfig,
    epochs: int | None = None,
    model: DataFrame | None = None,
    held_out: DataFrame | None = None,
    after_epoch: Callable[..., None] | None = None,
    scores: bool = True,
) -> TrainResult:
    """Trains from `model` (a fresh one by default) and returns the model table, batch log and metrics.

    A given model goes on after its own epoch, with the rates and draws of the epochs that follow. held_out
    samples are scored after every epoch: validation has their metrics, by epoch. Adam starts anew in every shard and epoch. An epoch without samples keeps the model and has no
    metrics row. after_epoch, if given, gets the epoch and its model, log, metrics and validation as soon as it is done.
    scores=False leaves loss and accuracy out of log and metrics (null); the model is the same.
    Only parameters, whose size the configuration fixes, pass through the driver.
    """
    spark, sizes = samples.sparkSession, model_sizes(cfg)
    model = model if model is not None else initial_model(spark, cfg)
    flat = to_array(model, sizes)
    sharded, counts = prepare(samples, cfg)
    logs, durations, checks = [], [], []
    done = model.agg(F.max("epoch")).first()[0] or 0
    for epoch in range(done + 1, done + (cfg.epochs if epochs is None else epochs) + 1):
        if not counts["rows"]:
            break
        started = time.monotonic()
        passed = run_pass(sharded, flat, cfg, epoch, sizes, counts["grid"], scores)
        flat = to_array(average_params(passed, epoch, cfg.block_width), sizes)
        logs.append(batch_rows(passed, epoch))
        durations.append((epoch, cfg.learning_rate(epoch), int((time.monotonic() - started) * 1000)))
        if held_out is not None:
            scored = scoring.predict(held_out, to_table(spark, flat, sizes, epoch, cfg.block_width), cfg)
            # Written at once: one row, and the epoch's parameters need not stay with the tasks.
            checks.append(saved(metrics.evaluate(scoring.folded(scored, cfg)).withColumn("epoch", F.lit(epoch))))
        if after_epoch is not None:
            model = to_table(spark, flat, sizes, epoch, cfg.block_width)
            row = metrics.epoch_metrics(logs[-1], durations[-1:], counts)
            after_epoch(epoch, model=model, log=logs[-1], metrics=row, validation=checks[-1] if checks else None)
    log = logs[0] if logs else metrics.empty_log(spark)
    for more in logs[1:]:
        log = log.unionByName(more)
    return TrainResult(
        to_table(spark, flat, sizes, done + len(durations), cfg.block_width),
        log,
        metrics.epoch_metrics(log, durations, counts),
        reduce(DataFrame.unionByName, checks) if checks else None,
    )


def train_epoch(
    samples: DataFrame, cfg: ModelConfig, epoch: int = 1, model: DataFrame | None = None, scores: bool = True, steps: bool = True
) -> DataFrame:
    """The batch log of one pass over the samples; without scores, its loss and correct are null.

    The pass reads its shards as they are dealt: they are not written once more, as they are for several epochs.
    Without steps it says which batches the pass has, and no more: shard, batch_no and total.
    """
    sizes = model_sizes(cfg)
    flat = to_array(model if model is not None else initial_model(samples.sparkSession, cfg), sizes)
    samples, counts = counted(samples, cfg)
    sharded = shard_samples(samples, counts["shards"], cfg)
    return batch_rows(run_pass(sharded, flat, cfg, epoch, sizes, counts["grid"], scores, steps), epoch)
