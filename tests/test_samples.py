import pytest
from pyspark.sql import functions as F

from wordloom.config import ModelConfig
from wordloom.operators import samples, vocab
from wordloom.sources.text import lines_in_memory


def windows(spark, ids, width):
    rows = spark.createDataFrame([(0, 0, ids)], "doc_id bigint, line_no bigint, ids array<bigint>")
    found = samples.sliding_windows(rows, width).orderBy("k").collect()
    return [(r["context"], r["label"], r["is_partial"]) for r in found]


@pytest.mark.parametrize(
    "width, ids, want",
    [
        (1, [], []),
        (1, [5], [([], 5, True)]),
        (1, [5, 6], [([5], 6, False)]),
        (1, [5, 6, 7, 8], [([5], 6, False), ([6], 7, False), ([7], 8, False)]),
        (2, [5], [([], 5, True)]),
        (2, [5, 6], [([5], 6, True)]),
        (2, [5, 6, 7, 8], [([5, 6], 7, False), ([6, 7], 8, False)]),
    ],
)
def test_windows(spark, width, ids, want):
    assert windows(spark, ids, width) == want


def test_sample_counts_of_small_corpora(spark):
    lines = lines_in_memory(spark, ["rain falls on slate", "slate roofs", "", "moss"])
    table = vocab.fit_vocab(lines)
    words = ["rain", "falls", "on", "slate", "roofs", "", "moss"]
    assert {r["word"]: r["id"] for r in table.collect()} == {w: n for n, w in enumerate(words)}
    # Three windows, one window, and a partial one for each of the two lines of a single word.
    assert samples.training_samples(lines, table, 1).count() == 6
    assert samples.training_samples(lines, table, 3).count() == 4


@pytest.fixture(scope="module")
def rows(spark):
    lines = lines_in_memory(spark, [f"a b c d e{n}" for n in range(200)])
    return samples.training_samples(lines, vocab.fit_vocab(lines), 1)


def test_batches(rows):
    batched = samples.assign_batches(rows, 3, 50).cache()
    sizes = {(r["shard"], r["batch_no"]): r["count"] for r in batched.groupBy("shard", "batch_no").count().collect()}
    assert sum(sizes.values()) == 800 and {s for s, _ in sizes} == {0, 1, 2}
    for (shard, number), n in sizes.items():
        last = max(b for s, b in sizes if s == shard)
        assert n == 50 if number < last else 0 < n <= 50
    ordered = batched.where("shard = 0").orderBy("doc_id", "line_no", "k").collect()
    assert [r["batch_no"] for r in ordered] == sorted(r["batch_no"] for r in ordered)


def test_shards_fill_their_partitions(rows):
    cfg = ModelConfig()
    placed = samples.shard_samples(rows.repartition(5), 6, cfg)
    assert placed.rdd.getNumPartitions() == 6
    where = placed.select("shard", F.spark_partition_id().alias("part")).distinct().collect()
    assert len(where) == 6 and all(r["shard"] == r["part"] for r in where)
    packed = samples.shard_samples(rows, 6, ModelConfig(max_tasks=4))
    assert packed.rdd.getNumPartitions() == 4
    where = packed.select("shard", F.spark_partition_id().alias("part")).distinct().collect()
    assert len(where) == 6 and all(r["shard"] % 4 == r["part"] for r in where)


def test_shard_count_follows_the_data():
    cfg = ModelConfig(rows_per_shard=10)
    assert [cfg.shards_for(n) for n in (0, 1, 10, 11, 1000)] == [1, 1, 1, 2, 100]
    assert ModelConfig(num_shards=7).shards_for(1) == 7


def test_one_hot(spark):
    labels = spark.createDataFrame([(0,), (4,), (5,)], "label bigint")
    hot = [r["one_hot"].asDict() for r in samples.one_hot(labels, 5).collect()]
    assert hot == [
        {"size": 5, "indices": [0], "values": [1.0]},
        {"size": 5, "indices": [4], "values": [1.0]},
        {"size": 5, "indices": [], "values": []},
    ]


def test_places_of_windows_need_no_ids(spark, monkeypatch):
    """The keys of windows are those of sliding_windows, counted from the words alone."""
    lines = lines_in_memory(spark, ["a b c d", "a", "", "  ", None, " b a"])
    found = vocab.encode(lines, vocab.fit_vocab(lines))
    for width in (1, 3, 5):
        want = samples.sliding_windows(found, width).select("doc_id", "line_no", "k")
        assert sorted(samples.window_places(lines, width).collect()) == sorted(want.collect())
    plan = samples.window_places(lines, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_pass_has_few_tasks_of_bounded_size(spark):
    """Each task of a pass sends all parameters: shuffle partitions are not multiplied, and large runs get more tasks."""
    cores, cfg = spark.sparkContext.defaultParallelism, ModelConfig()
    assert samples.shard_tasks(spark, 5, cfg) == 5
    assert samples.shard_tasks(spark, 1_000, cfg) == 8 * cores
    assert samples.shard_tasks(spark, 100_000, cfg) == 2_000
    assert samples.shard_tasks(spark, 1_000, ModelConfig(max_tasks=3)) == 3
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert samples.shard_tasks(spark, 1_000, cfg) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
