import pytest
from pyspark.sql import functions as F

from wordloom.config import Limits
from wordloom.sources import session, sinks
from wordloom.sources.session import saved
from wordloom.sources.text import lines_from, read_lines, turn_key


def test_lines_of_a_table(spark):
    table = spark.createDataFrame([(7, "a\nb\n\n"), (8, ""), (9, "\n")], "id bigint, body string")
    found = lines_from(table, "id", "body").orderBy("doc_id", "line_no").collect()
    assert [tuple(r) for r in found] == [(7, 0, "a"), (7, 1, "b"), (8, 0, "")]


def test_turn_key(spark):
    turns = spark.createDataFrame([(2, 3), (2, 1000), (3, 0)], "conv_id bigint, turn bigint")
    assert sorted(r["k"] for r in turns.select(turn_key(turns).alias("k")).collect()) == [2005, 3002, 3003]
    for bad in (-1, None):
        wrong = spark.createDataFrame([(2, bad)], "conv_id bigint, turn bigint")
        with pytest.raises(Exception, match="does not fit"):
            wrong.select(turn_key(wrong).alias("k")).collect()


@pytest.mark.parametrize("copy", [None, False])
@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0)])
def test_files_over_many_partitions_keep_their_order(spark, tmp_path, limits, copy):
    want = []
    for number, name in enumerate(["a.txt", "b.txt", "c.txt"]):
        texts = [f"{name} line {n} " + "x" * (n % 50) for n in range(400 * (number + 1))]
        texts[5] = ""
        (tmp_path / name).write_text("\n".join(texts) + "\n\n" * (number == 2))
        want += [(number, n, text) for n, text in enumerate(texts)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = read_lines(spark, str(tmp_path), limits, copy)
        assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 5
        found = lines.orderBy("doc_id", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r) for r in found] == want


def test_line_ends_and_empty_files(spark, tmp_path):
    path = tmp_path / "one.txt"
    path.write_bytes(b"a\n\nb\rc\n\n\n")
    assert [r["line"] for r in read_lines(spark, str(path)).orderBy("line_no").collect()] == ["a", "", "b\rc"]
    (tmp_path / "empty.txt").write_bytes(b"")
    assert read_lines(spark, str(tmp_path / "empty.txt")).count() == 0
    (tmp_path / "blank.txt").write_bytes(b"\n\n\n")
    assert read_lines(spark, str(tmp_path / "blank.txt")).count() == 0


def test_numbering_without_a_copy(spark, tmp_path, monkeypatch):
    import gzip

    from wordloom.sources import text

    written = []
    monkeypatch.setattr(text, "saved", lambda df: written.append(df.columns) or saved(df))
    many = [f"{n} " + "y" * (n % 70) for n in range(3000)]
    (tmp_path / "plain.txt").write_text("\n".join(many))
    (tmp_path / "whole.txt.gz").write_bytes(gzip.compress("\n".join(many[::-1]).encode()))
    want = [(0, n, t) for n, t in enumerate(many)] + [(1, n, t) for n, t in enumerate(many[::-1])]
    for size in ("3000", "20000", "10000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = [tuple(r) for r in read_lines(spark, str(tmp_path), copy=False).collect()]
            assert sorted(found) == want
            lines = read_lines(spark, str(tmp_path), copy=False)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
            with pytest.raises(Exception, match="splits differ"):
                lines.collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Only tables of splits were written.
    assert written and all("line" not in columns for columns in written)
    read_lines(spark, str(tmp_path))
    assert any("line" in columns for columns in written)


def test_dense_ids(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(6)
    found = session.dense_ids(rows, ["v"], "n", start=5).collect()
    assert sorted((r["n"], r["v"]) for r in found) == [(v + 5, v) for v in range(1000)]


def test_checkpoint_folder_is_the_session_s(spark):
    assert session.checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_widened_only_if_narrow(spark):
    assert session.widened(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == 4
    wide = spark.range(0, 10, 1, 9)
    assert session.widened(wide, "id") is wide


def test_metrics_and_text_sinks(spark, tmp_path):
    metrics = spark.createDataFrame(
        [(2, 0.0045, 1.5, 33.3333, 3, 30, 12, 1, 3, 9, 0, 4), (1, 0.005, 2.0, 25.0, 3, 30, 12, 1, 3, 9, 0, 4)],
        "epoch int, learning_rate double, avg_loss double, accuracy_pct double, batches bigint, predictions bigint, "
        "duration_ms bigint, shards int, snapshots bigint, lines bigint, out_of_range bigint, partitions int",
    )
    folder = sinks.stamped(str(tmp_path / "{instant}" / "stats"), "now")
    assert "/now/" in folder
    sinks.write_metrics(metrics, folder)
    [part] = (tmp_path / "now" / "stats").glob("part-*")
    header, first, second = part.read_text().splitlines()
    assert header.startswith("epoch,learning_rate,avg_loss,accuracy_pct,batches,predictions,duration_ms,shards")
    assert first == "1,0.005000,2.0000,25.00,3,30,12,1,3,9,0,4" and second.startswith("2,0.004500,1.5000,33.33,")
    made = spark.createDataFrame([("x",), (None,)], "output string")
    sinks.write_generated(made, str(tmp_path / "text"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "text")).collect()] == ["x", ""]
    for run in ("r1", "r2"):
        sinks.append_run(made, str(tmp_path / "runs"), run)
    assert spark.read.parquet(str(tmp_path / "runs")).groupBy("run_id").count().count() == 2
