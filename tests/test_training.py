from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.config import ModelConfig
from wordloom.operators import metrics, network, samples, scoring, training, vocab
from wordloom.operators.model import check_size, initial_model, load_model, save_model, to_array, to_table
from wordloom.operators.network import ContextFeatures, model_sizes, parameter_count
from wordloom.sources.text import lines_in_memory

SMALL = ModelConfig(
    vocabulary_size=12, embedding_size=8, layer_size=16, batch_size=10, num_shards=3, block_width=8, initial_rate=0.02
)
SIZES = model_sizes(SMALL)


@pytest.fixture(scope="module")
def rows(spark):
    lines = lines_in_memory(spark, [" ".join("abcdefghij"[n % 10 :]) for n in range(100)])
    return samples.training_samples(lines, vocab.fit_vocab(lines), 1).cache()


def test_initial_model(spark):
    flat = to_array(initial_model(spark, SMALL), SIZES)
    weights = flat[: 8 * 16]
    assert weights.std() == pytest.approx(np.sqrt(2 / 24), rel=0.2)
    assert not flat[8 * 16 : 8 * 16 + 16].any()
    again = to_array(initial_model(spark, replace(SMALL, block_width=64)), SIZES)
    np.testing.assert_array_equal(flat, again)


def test_save_and_load(spark, tmp_path):
    model = initial_model(spark, SMALL)
    save_model(model, str(tmp_path / "model"))
    loaded = load_model(spark, str(tmp_path / "model"))
    assert sorted(loaded.collect()) == sorted(model.collect())
    flat = to_array(loaded, SIZES)
    np.testing.assert_array_equal(to_array(to_table(spark, flat, SIZES, 1, 8), SIZES), flat)


def test_models_of_another_shape_are_refused(spark):
    model = initial_model(spark, SMALL)
    with pytest.raises(ValueError):
        to_array(model, [8, 16, 16, 14])
    with pytest.raises(ValueError):
        to_array(model.where("block_id != 1"), SIZES)
    with pytest.raises(ValueError):
        to_array(model.unionByName(model), SIZES)
    with pytest.raises(ValueError):
        check_size([32, 128, 10**9], SMALL.max_model_bytes)


def shard_by_hand(rows, shard, flat, epoch=1):
    """One shard's pass outside Spark, keeping every snapshot."""
    mine = samples.shard_samples(rows, SMALL.num_shards, SMALL).where(F.col("shard") == shard)
    mine = sorted(mine.collect(), key=lambda r: (r["doc_id"], r["line_no"], r["k"]))
    full = np.array([len(r["context"]) == 1 for r in mine])
    ids = np.array([r["context"][0] if r["context"] else 0 for r in mine])[:, None]
    labels, x = np.array([r["label"] for r in mine]), ContextFeatures(SMALL)(ids, full)
    walk, snapshots = training.ShardPass(flat, SIZES, SMALL, epoch, shard), []
    for at in range(0, len(mine), SMALL.batch_size):
        part = slice(at, at + SMALL.batch_size)
        walk.step(x[part], labels[part], full[part].astype(float))
        snapshots.append(walk.net.flat.astype(float))
    return walk, snapshots


def test_average_is_the_mean_of_all_snapshots(spark, rows):
    flat = to_array(initial_model(spark, SMALL), SIZES)
    sharded, counts = training.prepare(rows, SMALL)
    passed = training.run_pass(sharded, flat, SMALL, 1, SIZES, counts["grid"])
    mean = to_array(training.average_params(passed, 1, SMALL.block_width), SIZES)
    walks = [shard_by_hand(rows, shard, flat) for shard in range(3)]
    every = np.concatenate([s for _, s in walks])
    np.testing.assert_allclose(mean, every.mean(axis=0), atol=1e-6)
    log = training.batch_rows(passed, 1).orderBy("shard", "batch_no").collect()
    by_hand = [entry for walk, _ in walks for entry in walk.log]
    assert [(r["loss"], r["correct"], r["total"]) for r in log] == [entry[3:6] for entry in by_hand]
    assert counts["rows"] == sum(r["total"] for r in log) == rows.count()


def test_result_does_not_depend_on_partitions_or_arrow_batches(spark, rows):
    first = to_array(training.train(rows, SMALL, epochs=2).model, SIZES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        second = to_array(training.train(rows.repartition(9), SMALL, epochs=2).model, SIZES)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    np.testing.assert_array_equal(first, second)
    packed = training.train(rows, replace(SMALL, max_tasks=2), epochs=2)
    np.testing.assert_array_equal(first, to_array(packed.model, SIZES))


def test_sums_on_the_grid_are_exact():
    for batches in (10, 10**6, 10**11):
        grid = training.sum_grid(batches)
        assert 8 * batches * grid <= 2.0**53
    assert training.sum_grid(1000) >= 2.0**38


def test_loss_falls_and_metrics_add_up(rows):
    result = training.train(rows, SMALL, epochs=8)
    found = result.epoch_metrics.orderBy("epoch").collect()
    assert [r["epoch"] for r in found] == list(range(1, 9))
    assert found[-1]["avg_loss"] < found[0]["avg_loss"]
    assert found[-1]["accuracy_pct"] > found[0]["accuracy_pct"]
    log = result.batch_log.where("epoch = 8").collect()
    last = found[-1]
    assert last["batches"] == last["snapshots"] == len(log)
    assert last["predictions"] == sum(r["total"] for r in log) == rows.count()
    assert last["avg_loss"] == pytest.approx(sum(r["loss"] for r in log) / len(log), abs=1e-4)
    assert last["lines"] == 100 and last["out_of_range"] == 0 and last["shards"] == 3
    assert last["learning_rate"] == pytest.approx(0.02 * 0.9**7, abs=1e-6)


def test_gradient_stats_every_tenth_batch(rows):
    log = training.train(rows, replace(SMALL, num_shards=1), epochs=1).batch_log
    kept = [r["batch_no"] for r in log.where("grad_mean is not null").orderBy("batch_no").collect()]
    assert kept == list(range(0, log.count(), 10))
    stats = metrics.gradient_stats(log).first()
    assert stats["grad_min"] < stats["grad_mean"] < stats["grad_max"] and stats["recorded"] == len(kept)


def test_labels_beyond_the_vocabulary_train_the_last_output(spark, rows):
    few = replace(SMALL, vocabulary_size=4)
    trained = training.train(rows, few, epochs=6)
    found = trained.epoch_metrics.orderBy("epoch").collect()
    beyond = rows.where("label >= 4").count()
    assert beyond > 0 and found[0]["out_of_range"] == beyond
    assert found[0]["predictions"] == rows.count()
    folded = scoring.folded(scoring.predict(rows, trained.model, few), few)
    assert folded.agg(F.max("label")).first()[0] == 4
    assert folded.where("label = 4 and prediction = 4").count() > 0.8 * beyond
    assert folded.where("nll is null").count() == 0


def test_empty_epoch_keeps_the_model(spark, rows):
    result = training.train(rows.where("false"), SMALL, epochs=3)
    assert result.epoch_metrics.count() == 0 and result.batch_log.count() == 0
    np.testing.assert_array_equal(to_array(result.model, SIZES), to_array(initial_model(spark, SMALL), SIZES))


def test_training_goes_on_from_a_model(spark, rows):
    halves = training.train(rows, SMALL, epochs=1)
    more = training.train(rows, SMALL, epochs=1, model=halves.model)
    assert more.epoch_metrics.first()["avg_loss"] < halves.epoch_metrics.first()["avg_loss"]
    assert more.epoch_metrics.first()["epoch"] == 2 and more.model.first()["epoch"] == 2
    whole = training.train(rows, SMALL, epochs=2)
    np.testing.assert_array_equal(to_array(more.model, SIZES), to_array(whole.model, SIZES))
    second = whole.epoch_metrics.where("epoch = 2").drop("duration_ms").first()
    assert more.epoch_metrics.drop("duration_ms").first() == second


def test_validation_after_every_epoch(spark, rows):
    kept, held = rows.where("line_no < 80"), rows.where("line_no >= 80")
    trained = training.train(kept, SMALL, epochs=3, held_out=held)
    found = trained.validation.orderBy("epoch").collect()
    assert [r["epoch"] for r in found] == [1, 2, 3] and {r["n"] for r in found} == {held.count()}
    last = metrics.evaluate(scoring.folded(scoring.predict(held, trained.model, SMALL), SMALL)).first()
    assert found[-1]["accuracy"] == last["accuracy"]


def test_large_parameters_are_refused(spark, rows):
    sharded, counts = training.prepare(rows, SMALL)
    flat = np.full(parameter_count(SIZES), 9.0)
    with pytest.raises(Exception, match="over 8 in size"):
        training.run_pass(sharded, flat, SMALL, 1, SIZES, counts["grid"])


def test_average_vectors_by_hand(spark):
    vectors = spark.createDataFrame(
        [("a", 1, [1.0, 2.0]), ("a", 3, [3.0, 6.0]), ("b", 2, [4.0])], "k string, n bigint, v array<double>"
    )
    found = {r["k"]: (r["n"], r["v"]) for r in training.average_vectors(vectors, ["k"], "v", F.col("n"), 3).collect()}
    assert found == {"a": (4, [1.0, 2.0]), "b": (2, [2.0])}


def test_predict_and_evaluate(spark, rows):
    cfg = replace(SMALL, vocabulary_size=10)
    trained = training.train(rows, cfg, epochs=10)
    scored = scoring.predict(rows, trained.model, cfg).cache()
    assert scored.where("prob <= 0 or prob > 1").count() == 0
    assert scored.where("size(context) = 0 and nll != 0").count() == 0
    total = scoring.loss(scored).first()
    assert total["rows"] == rows.count()
    assert total["loss"] == pytest.approx(np.mean([r["nll"] for r in scored.collect()]))
    found = metrics.evaluate(scored).first()
    right = scored.where("label = prediction").count()
    assert found["n"] == rows.count() and found["accuracy"] == pytest.approx(right / rows.count())
    assert right / rows.count() > 0.3
    beyond = scoring.predict(rows.withColumn("label", F.lit(99).cast("bigint")), trained.model, cfg)
    assert beyond.where("nll is null").count() == 0


def test_features_and_contexts_score_alike(spark, rows):
    from wordloom.operators.features import sample_features

    model = initial_model(spark, SMALL)
    by_context = scoring.predict(rows, model, SMALL).select("doc_id", "line_no", "k", "prediction", F.round("prob", 5))
    by_features = scoring.predict(sample_features(rows, SMALL), model, SMALL).select(by_context.columns[0], "line_no", "k", "prediction", F.round("prob", 5))
    assert sorted(by_context.collect()) == sorted(by_features.collect())


def test_class_metrics_by_hand(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] * 1 + [(1, 1)] * 2 + [(1, 2)] * 2
    frame = spark.createDataFrame(pairs, "label int, prediction int")
    found = {r["class"]: r for r in metrics.class_metrics(metrics.confusion(frame)).collect()}
    assert (found[0]["support"], found[0]["precision"], found[0]["recall"]) == (4, 1.0, 0.75)
    assert (found[1]["support"], found[1]["precision"], found[1]["recall"]) == (4, 2 / 3, 0.5)
    assert (found[2]["support"], found[2]["precision"], found[2]["f1"]) == (0, 0.0, 0.0)
    assert metrics.evaluate(frame).first()["accuracy"] == 5 / 8


def test_accuracy_without_predictions(spark):
    log = spark.createDataFrame([(1, 0.0, 0, 0)], "epoch int, loss double, correct bigint, total bigint")
    assert metrics.epoch_accuracy(metrics.batch_totals(log)).first()["accuracy"] == 0.0


def test_parameter_count_of_small_model():
    assert parameter_count(SIZES) == 8 * 16 + 16 + 16 * 16 + 16 + 16 * 13 + 13


def test_sums_of_tasks_meet_in_groups(spark, rows, monkeypatch):
    cfg = replace(SMALL, num_shards=9, max_tasks=9)
    flat = to_array(initial_model(spark, cfg), SIZES)
    sharded, counts = training.prepare(rows, cfg)
    passed = training.run_pass(sharded, flat, cfg, 1, SIZES, counts["grid"])
    plain = to_array(training.average_params(passed, 1, cfg.block_width), SIZES)
    monkeypatch.setattr(training, "GROUPED_FROM", 4)
    params = passed.where(F.col("kind") == "params")
    assert training.grouped_tasks(params).rdd.getNumPartitions() == 3 < params.rdd.getNumPartitions() == 9
    np.testing.assert_array_equal(plain, to_array(training.average_params(passed, 1, cfg.block_width), SIZES))


def test_samples_are_counted_while_they_are_written(spark, rows):
    _, counts = training.prepare(rows, SMALL)
    want = rows.agg(F.count(F.lit(1)), F.count_if(F.col("label") >= SMALL.vocabulary_size), F.count_if(F.col("k") == 0)).first()
    assert (counts["rows"], counts["out_of_range"], counts["lines"]) == tuple(want)
    for none in (rows.limit(0), rows.where(F.lit(False))):
        _, counts = training.prepare(none, SMALL)
        assert (counts["rows"], counts["out_of_range"], counts["lines"]) == (0, 0, 0)


def test_without_scores_the_model_is_the_same(rows, monkeypatch):
    """Loss and correct are for the log alone: a run that does not show them does not work them out."""
    full = training.train(rows, SMALL, epochs=2)
    bare = training.train(rows, SMALL, epochs=2, scores=False)
    np.testing.assert_array_equal(to_array(full.model, SIZES), to_array(bare.model, SIZES))
    assert bare.batch_log.where("loss is not null or correct is not null").count() == 0
    left = ["epoch", "shard", "batch_no", "total", "grad_mean", "grad_max", "grad_min"]
    assert sorted(map(str, full.batch_log.select(left).collect())) == sorted(map(str, bare.batch_log.select(left).collect()))
    drop = ("duration_ms", "avg_loss", "accuracy_pct")
    assert sorted(full.epoch_metrics.drop(*drop).collect()) == sorted(bare.epoch_metrics.drop(*drop).collect())
    step = training.ShardPass(np.ones(parameter_count(SIZES)), SIZES, SMALL, 1, 0, scores=False)
    monkeypatch.setattr(step.net, "loss", None)
    monkeypatch.setattr(step.net, "logits", None)
    step.step(np.ones((3, 8)), np.arange(3), np.ones(3))
    assert step.log[0][3:6] == (None, None, 3)


def test_a_pass_without_steps_walks_the_same_batches(rows, monkeypatch):
    """The batches of a pass are listed without the arithmetic of its steps."""
    key = ["epoch", "shard", "batch_no", "total"]
    full, bare = training.train_epoch(rows, SMALL), training.train_epoch(rows, SMALL, steps=False)
    assert sorted(full.select(key).collect()) == sorted(bare.select(key).collect())
    assert bare.where("loss is not null or correct is not null or grad_mean is not null").count() == 0
    monkeypatch.setattr(training, "Trainer", None)
    walk = training.ShardPass(np.ones(parameter_count(SIZES)), SIZES, SMALL, 1, 0, steps=False)
    walk.step(np.ones((3, 1)), np.arange(3), np.ones(3))
    assert walk.log == [("batch", 0, 0, None, None, 3, None, None, None)]


def test_one_pass_does_not_write_its_shards(rows, monkeypatch):
    """Shards are written once for several epochs; a single pass reads them as they are dealt, to the same log."""
    written, stable = [], training.stable

    def seen(df):
        written.append(df.columns)
        return stable(df)

    monkeypatch.setattr(training, "stable", seen)
    log = training.train_epoch(rows, SMALL)
    assert len(written) == 1 and written[0][0] == "kind"
    several = training.train(rows, SMALL, epochs=2)
    assert len(written) == 4 and written[1][-1] == "shard"
    assert sorted(map(str, log.collect())) == sorted(map(str, several.batch_log.where("epoch = 1").collect()))


def test_a_pass_without_steps_reads_the_shards_alone(rows):
    """The shuffle that deals them need not move contexts and labels, which only steps use."""
    key = ["epoch", "shard", "batch_no", "total"]
    sharded, counts = training.prepare(rows, SMALL)
    flat = to_array(initial_model(rows.sparkSession, SMALL), SIZES)
    alone = training.run_pass(sharded.select("shard"), flat, SMALL, 1, SIZES, counts["grid"], steps=False)
    found = sorted(training.batch_rows(alone, 1).select(key).collect())
    assert found == sorted(training.train_epoch(rows, SMALL).select(key).collect()) and len(found) > 3


def test_token_vectors_are_kept_from_task_to_task(monkeypatch):
    ids, full = np.arange(40)[:, None], np.ones(40, dtype=bool)
    first = ContextFeatures(SMALL)(ids, full)
    monkeypatch.setattr(network, "md5_of_numbers", None)
    np.testing.assert_array_equal(first, ContextFeatures(SMALL)(ids, full))
    monkeypatch.undo()
    assert not np.array_equal(first, ContextFeatures(replace(SMALL, seed=7))(ids, full))
    np.testing.assert_array_equal(first, ContextFeatures(SMALL)(ids, full))
