"""Array expressions: softmax, encodings, attention, sampling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions import draws

# Spread of a token vector, base of the position angles.
EMBEDDING_SCALE = 0.1
ANGLE_BASE = 10000.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, also where body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dot(left: Column, right: Column) -> Column:
    return total(F.zip_with(left, right, lambda a, b: a * b))


def softmax(values: Column) -> Column:
    """exp(v) / sum(exp(v)), shifted by the maximum."""
    shifted = let(F.array_max(values), lambda top: F.transform(values, lambda v: F.exp(v - top)))
    return let(shifted, lambda e: let(total(e), lambda s: F.transform(e, lambda v: v / s)))


def scale_by_temperature(values: Column, temperature: float) -> Column:
    """Softmax of values / temperature. Values are probabilities or logits, as the caller chooses."""
    return softmax(F.transform(values, lambda v: v / F.lit(float(temperature))))


def sample_index(probs: Column, draw: Column) -> Column:
    """First index whose running sum reaches the draw; 0 when none does."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(-1).alias("hit"))

    def step(acc: Column, p: Column) -> Column:
        reached = acc["sum"] + p
        return F.struct(
            reached.alias("sum"),
            (acc["i"] + 1).alias("i"),
            F.when((acc["hit"] < 0) & (reached >= draw), acc["i"]).otherwise(acc["hit"]).alias("hit"),
        )

    return F.aggregate(probs, start, step, lambda acc: F.greatest(acc["hit"], F.lit(0)))


def token_vector(token: Column, size: int, seed: int) -> Column:
    """Gaussian vector of a token id, the same wherever the token occurs."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda d: let(draws.digest(seed, token, d), draws.gauss) * EMBEDDING_SCALE,
    )


def position_value(pos: Column, dim: Column, size: int) -> Column:
    """Sine on even dimensions, cosine on odd ones, of pos / base^(2*dim/size)."""
    angle = pos / F.pow(F.lit(ANGLE_BASE), (dim * 2) / F.lit(float(size)))
    return F.when(dim % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))


def position_vector(pos: int, size: int) -> Column:
    """The values of one position: a constant."""
    return F.array(*[position_value(F.lit(pos), F.lit(d), size) for d in range(size)])


def self_attention(rows: Column, size: int) -> Column:
    """softmax(X Xt / sqrt(size)) X over the positions of each row's matrix."""
    zero = F.array_repeat(F.lit(0.0), size)

    def attend(x: Column, query: Column) -> Column:
        scores = F.transform(x, lambda k: dot(query, k) / F.sqrt(F.lit(float(size))))
        weighted = F.zip_with(softmax(scores), x, lambda a, v: F.transform(v, lambda e: e * a))
        return F.aggregate(weighted, zero, lambda acc, v: F.zip_with(acc, v, lambda p, q: p + q))

    return let(rows, lambda x: F.transform(x, lambda q: attend(x, q)))
