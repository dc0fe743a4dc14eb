"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Limits:
    """Sizes below which a table may be broadcast. Beyond them every operator takes a shuffle path."""

    broadcast_rows: int = 2_000_000
    broadcast_bytes: int = 128 * 1024 * 1024
    # A key is "hot" when it holds at least 1/hot_keys of the rows, so at most hot_keys keys are hot.
    hot_keys: int = 20_000
    hot_key_bytes: int = 256


@dataclass(frozen=True)
class ModelConfig:
    # The default sizes, rates and seed a run must use to be comparable.
    vocabulary_size: int = 3000
    embedding_size: int = 32
    window_size: int = 1
    batch_size: int = 100
    num_predictions: int = 500
    epochs: int = 10
    seed: int = 42
    initial_rate: float = 0.005
    gamma: float = 0.9
    layer_size: int = 128
    drop_prob: float = 0.2
    temperature: float = 0.7
    # Attention with seeded query, key and value projections instead of the context itself.
    projected: bool = False

    # How training is spread. A shard is one sequential walk from the epoch's model; its size, not the
    # cluster, decides the result. num_shards=None derives the count from the data. A task walks one
    # or more shards and sends one sum of parameters; max_tasks=None follows the cluster's size.
    num_shards: int | None = None
    rows_per_shard: int = 10_000
    max_tasks: int | None = None
    block_width: int = 64
    dtype: str = "float32"
    max_model_bytes: int = 256 * 1024 * 1024
    limits: Limits = field(default_factory=Limits)

    @property
    def input_size(self) -> int:
        return self.embedding_size * self.window_size

    def learning_rate(self, epoch: int) -> float:
        """Rate of a 1-based epoch: exponential decay per epoch."""
        return self.initial_rate * self.gamma ** (epoch - 1)

    def shards_for(self, rows: int) -> int:
        """Shards for a sample count: one per rows_per_shard, so a shard never outgrows a task."""
        if self.num_shards is not None:
            return self.num_shards
        return max(1, -(-rows // self.rows_per_shard))
