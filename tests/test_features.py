from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.config import ModelConfig
from wordloom.functions import draws, vectors
from wordloom.operators import features, samples, vocab
from wordloom.operators.network import ContextFeatures, sample_rows, uniform_draws
from wordloom.sources.text import lines_in_memory

CFG = ModelConfig()


def contexts(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "i int, context array<bigint>")


def test_shape_of_one_token(spark):
    rows = features.embedding_matrix(contexts(spark, [[1], [3]]), CFG).collect()
    assert [np.shape(r["matrix"]) for r in rows] == [(1, 32), (1, 32)]


def test_token_vectors_are_repeatable_and_small(spark):
    rows = features.token_embeddings(spark.range(3000), CFG).collect()
    again = {r["id"]: r["vector"] for r in features.token_embeddings(spark.range(3000).repartition(7), CFG).collect()}
    assert all(again[r["id"]] == r["vector"] for r in rows)
    values = np.array([r["vector"] for r in rows])
    assert abs(values.mean()) < 0.002 and abs(values.std() - 0.1) < 0.002
    assert abs(np.corrcoef(values[:, 0], values[:, 1])[0, 1]) < 0.06


def test_positions(spark):
    encoding = vectors.position_vector(3, 8)
    got = spark.range(1).select(encoding.alias("e")).first()["e"]
    want = [f(3 / 10000 ** (2 * d / 8)) for d, f in enumerate([np.sin, np.cos] * 4)]
    np.testing.assert_allclose(got, want, rtol=1e-12)
    per_row = features.positional_encoding(spark.range(1).select(F.lit(3).alias("pos")), replace(CFG, embedding_size=8))
    np.testing.assert_allclose(per_row.first()["encoding"], want, rtol=1e-12)


def attention_by_numpy(x):
    x = np.array(x)
    scores = x @ x.T / np.sqrt(x.shape[1])
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    return weights / weights.sum(axis=1, keepdims=True) @ x


def test_attention(spark):
    x = [[1.0, 0.0, 2.0], [0.5, 1.0, -1.0]]
    rows = spark.createDataFrame([(x,), ([x[0]],)], "matrix array<array<double>>")
    got = features.attend(rows, 3).collect()
    np.testing.assert_allclose(got[0]["attended"], attention_by_numpy(x), rtol=1e-12)
    np.testing.assert_allclose(got[0]["features"], attention_by_numpy(x).reshape(-1), rtol=1e-12)
    np.testing.assert_allclose(got[1]["attended"], [x[0]], rtol=1e-12)


@pytest.mark.parametrize("width", [1, 2, 3, 16])
def test_batches_and_expressions_agree(spark, width):
    """Matrices and features made in batches, against the column expressions for vectors and attention."""
    cfg = replace(CFG, window_size=width)
    rng = np.random.default_rng(0)
    rows = [rng.integers(0, 6, width).tolist() for _ in range(50)] + [[]] + [[2] * (width - 1)]
    got = features.sample_features(contexts(spark, rows), cfg).orderBy("i").collect()
    full = np.array([len(r) == width for r in rows])
    padded = np.array([r + [0] * (width - len(r)) for r in rows]).reshape(len(rows), width)
    np.testing.assert_allclose([r["features"] for r in got], ContextFeatures(cfg)(padded, full), atol=1e-12)
    assert [r["mask"] for r in got] == full.astype(int).tolist()
    matrices = features.embedding_matrix(contexts(spark, rows), cfg).cache()
    found = matrices.select("i", F.posexplode("matrix").alias("pos", "row"), F.get("context", F.col("pos")).alias("id"))
    drawn = vectors.token_vector(F.col("id"), cfg.embedding_size, cfg.seed)
    for r in found.withColumn("vector", drawn).collect():
        want = np.array(r["vector"]) + ContextFeatures(cfg).positions[r["pos"]]
        np.testing.assert_allclose(r["row"], want, atol=1e-12)
    attended = features.attend(matrices.where(F.size("context") == width), cfg.embedding_size)
    want = {r["i"]: r["features"] for r in got}
    for r in attended.collect():
        np.testing.assert_allclose(r["features"], want[r["i"]], atol=1e-9)


def test_plans_do_not_grow_with_the_window(spark):
    sizes = set()
    for width in (1, 2, 4, 8):
        made = features.sample_features(contexts(spark, [[1] * width]), replace(CFG, window_size=width))
        sizes.add(made._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert len(sizes) == 1


def test_softmax_and_temperature(spark):
    p = [0.2, 0.5, 0.3]
    rows = spark.createDataFrame([(p,)], "p array<double>")
    soft, hot = rows.select(vectors.softmax(F.col("p")), vectors.scale_by_temperature(F.col("p"), 0.7)).first()
    e = np.exp(p)
    np.testing.assert_allclose(soft, e / e.sum(), rtol=1e-12)
    e = np.exp(np.array(p) / 0.7)
    np.testing.assert_allclose(hot, e / e.sum(), rtol=1e-12)


@pytest.mark.parametrize(
    "p, u, want", [([0.2, 0.5, 0.3], 0.19, 0), ([0.2, 0.5, 0.3], 0.7, 1), ([0.2, 0.5, 0.3], 0.99, 2), ([0.2, 0.5, 0.2], 0.95, 0)]
)
def test_sampling(spark, p, u, want):
    rows = spark.createDataFrame([(p, u)], "p array<double>, u double")
    assert rows.select(vectors.sample_index(F.col("p"), F.col("u"))).first()[0] == want


def test_draws_agree_between_engines(spark):
    rows = spark.range(200).select(draws.uniform(draws.digest(42, F.col("id"), F.lit(7)), 1).alias("u")).collect()
    np.testing.assert_array_equal([r["u"] for r in rows], uniform_draws([f"42:{n}:7" for n in range(200)]))


def test_sampling_frequencies():
    p = np.array([0.1, 0.6, 0.3])
    heat = np.exp(p / 0.7)
    u = uniform_draws([f"42:{n}:0" for n in range(20000)])
    picked = sample_rows(np.tile(p, (20000, 1)), u, 0.7)
    np.testing.assert_allclose(np.bincount(picked, minlength=3) / 20000, heat / heat.sum(), atol=0.015)
    logits = sample_rows(np.tile(np.log(p), (20000, 1)), u, 1.0, logits=True)
    np.testing.assert_allclose(np.bincount(logits, minlength=3) / 20000, p, atol=0.015)


@pytest.mark.parametrize("seed, size", [(42, 32), (-7, 130), (10**40, 3)])
def test_draws_of_many_keys_at_once(seed, size, monkeypatch):
    """Hashed by arrays or one by one, a key gives the same numbers."""
    from wordloom.operators import network

    numbers = np.array([0, 7, 42, -1, -93, 10**6, 2**63 - 1, -(2**63), *range(95, 130)])
    want = network.md5_words([f"{seed}:{t}:{d}" for t in numbers.tolist() for d in range(size)])[:, :3]
    monkeypatch.setattr(network, "FEW_KEYS", 0)
    monkeypatch.setattr(network, "MD5_KEYS", 100)
    np.testing.assert_array_equal(network.md5_of_numbers(seed, numbers, size), want)
    # Keys that fit one block are not hashed one by one.
    monkeypatch.setattr(network, "md5_words", None if size > 3 else network.md5_words)
    np.testing.assert_array_equal(network.md5_of_numbers(seed, numbers, size), want)


def test_reals_of_arrays_round_as_decimals_do(spark):
    """Ties away from zero, and the neighbours of ties, as F.round has them."""
    from wordloom.plans.registry import joined_reals, millionths

    ties = [(n + 0.5) / 1e6 for n in range(-40, 40)] + [0.5 / 2**k for k in range(30)]
    near = [float(np.nextafter(v, s)) for v in ties for s in (-9, 9)]
    values = [*ties, *near, 0.0, -0.0, 1234.5678915, -3e-7, *np.random.default_rng(1).normal(size=500).tolist()]
    rows = spark.createDataFrame([(values, v) for v in values], "all array<double>, one double")
    want = [r[0] for r in rows.select(millionths(F.col("one"))).collect()]
    assert rows.limit(1).select(joined_reals("all")).first()[0] == " ".join(map(str, want))
    plan = rows.select(joined_reals("all"))._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan


def test_rows_of_a_context_stand_side_by_side(spark):
    rows = spark.createDataFrame([(n, [n % 3]) for n in range(60)], "n bigint, context array<bigint>").coalesce(1)
    found = [r["context"][0] for r in features.sample_features(rows, ModelConfig()).collect()]
    assert found == sorted(found)


@pytest.mark.parametrize("width", [1, 3])
def test_joined_features_are_the_text_of_the_arrays(spark, width):
    """Text and arrays come from the same run of equal contexts; partial windows have zeros."""
    from wordloom.plans.registry import joined_reals

    cfg = ModelConfig(embedding_size=6, window_size=width)
    lines = lines_in_memory(spark, [" ".join("abacadbbcaab"[: n % 12]) for n in range(60)])
    rows = samples.training_samples(lines, vocab.fit_vocab(lines), width).select("doc_id", "line_no", "k", "context")
    arrays = features.sample_features(rows, cfg).withColumn("features", joined_reals("features"))
    text = features.sample_features(rows, cfg, joined=True)
    assert text.columns == arrays.columns and dict(text.dtypes)["features"] == "string"
    found = sorted(map(str, text.collect()))
    assert found == sorted(map(str, arrays.collect())) and any("mask=0" in r for r in found)
    # By context in each partition, in the order of arrays.
    for part in text.select("context").rdd.glom().collect():
        assert [r["context"] for r in part] == sorted(r["context"] for r in part)


def test_millionths_round_half_away_from_zero(spark):
    from wordloom.operators.arrow import joined_millionths
    from wordloom.plans.registry import joined_reals

    values = np.array([[0.5e-6, -0.5e-6, 1.5e-6, -1.5e-6], [2.4999995, -2.4999996, 0.0, -0.0], [1e6, -1e6, 0.1, -0.3]])
    table = spark.createDataFrame([(n, row) for n, row in enumerate(values.tolist())], "n int, v array<double>")
    want = [r["t"] for r in table.select("n", joined_reals("v").alias("t")).orderBy("n").collect()]
    assert joined_millionths(values).to_pylist() == want
    assert want[0].split() == ["1", "-1", "2", "-2"]
