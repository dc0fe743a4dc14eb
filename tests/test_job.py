from dataclasses import replace

from wordloom.config import ModelConfig
from wordloom.operators.model import load_model, to_array
from wordloom.operators.vocab import load_vocab
from wordloom.operators.network import model_sizes, parameter_count
from wordloom.plans import job

TEXT = """old boats drift past the stone pier and rest
gulls drift past old boats and the pier
the stone pier and gulls rest
"""


def test_text_file_to_generated_text(spark, tmp_path):
    (tmp_path / "in.txt").write_text(TEXT * 4)
    cfg = ModelConfig(epochs=2)
    out = lambda name: str(tmp_path / "{instant}" / name)
    result = job.run(spark, str(tmp_path / "in.txt"), out("text"), out("stats"), ["old boats"], cfg, out("model"))
    folder = tmp_path / result.run_id
    [line] = [r["value"] for r in spark.read.text(str(folder / "text")).collect()]
    prefix = "Generated text: old boats -> "
    assert line.startswith(prefix) and "  " not in line.removeprefix(prefix)
    [part] = (folder / "stats").glob("part-*")
    assert [row.split(",")[0] for row in part.read_text().splitlines()] == ["epoch", "1", "2"]
    assert result.vocab.count() == 10
    checks = result.validation.orderBy("epoch").collect()
    assert [r["epoch"] for r in checks] == [1, 2] and checks[0]["n"] > 0
    [part] = (folder / "stats-validation").glob("part-*")
    assert part.read_text().startswith("epoch,n,accuracy") and len(part.read_text().splitlines()) == 3
    words = load_vocab(spark, str(folder / "model-vocab"))
    assert sorted(words.collect()) == sorted(result.vocab.select("word", "id").collect())
    assert to_array(load_model(spark, str(folder / "model")), model_sizes(cfg)).size == parameter_count(model_sizes(cfg))


def test_wider_windows(spark, tmp_path):
    (tmp_path / "in.txt").write_text(TEXT * 2)
    cfg = replace(ModelConfig(), epochs=1, window_size=3, num_predictions=5, vocabulary_size=20)
    result = job.run(spark, str(tmp_path / "in.txt"), str(tmp_path / "t"), str(tmp_path / "s"), ["pier", "the stone pier"], cfg)
    assert result.generated.where("output is not null").count() == 2


def test_a_saved_run_goes_on(spark, tmp_path):
    (tmp_path / "in.txt").write_text(TEXT * 3)
    out = lambda name: str(tmp_path / name)
    small = replace(ModelConfig(), layer_size=8, embedding_size=4, vocabulary_size=6, num_predictions=5)
    source = out("in.txt")
    job.run(spark, source, out("t"), out("s"), ["old"], replace(small, epochs=1), out("m1"))
    more = job.run(spark, source, out("t"), out("s"), ["old"], replace(small, epochs=1), out("m2"), out("m1"))
    whole = job.run(spark, source, out("t"), out("s"), ["old"], replace(small, epochs=2), out("m3"))
    sizes = model_sizes(small)
    assert (to_array(more.trained.model, sizes) == to_array(whole.trained.model, sizes)).all()
    assert more.trained.epoch_metrics.first()["epoch"] == 2


def test_a_killed_run_goes_on_behind_its_last_epoch(spark, tmp_path, monkeypatch):
    import pytest

    from wordloom.sources.runs import RunFolder

    (tmp_path / "in.txt").write_text(TEXT * 3)
    out = lambda name: str(tmp_path / name)
    cfg = replace(ModelConfig(), epochs=3, layer_size=8, embedding_size=4, vocabulary_size=6, num_predictions=5, initial_rate=0.01)
    whole = job.run(spark, out("in.txt"), out("t0"), out("s0"), ["old"], cfg, run_folder=out("whole"))

    class Killed(Exception):
        pass

    put = RunFolder.commit

    def commit(self, epoch, **tables):
        if epoch == 3:
            # Killed while the third epoch is written: its tables lie there, its manifest does not.
            tables["model"].write.parquet(f"{self.path}/epoch-3-half/model")
            raise Killed
        put(self, epoch, **tables)

    monkeypatch.setattr(RunFolder, "commit", commit)
    with pytest.raises(Killed):
        job.run(spark, out("in.txt"), out("t1"), out("s1"), ["old"], cfg, run_folder=out("cut"))
    monkeypatch.undo()
    folder = RunFolder(spark, out("cut"))
    assert [m["epoch"] for m in folder.epochs()] == [1, 2] and folder.config() == cfg
    assert folder.all_epochs("metrics").count() == 2
    # Another rate is given by mistake: the run's own counts.
    more = job.run(spark, out("in.txt"), out("t1"), out("s1"), ["old"], replace(cfg, initial_rate=0.5), run_folder=out("cut"))
    sizes = model_sizes(cfg)
    assert (to_array(more.trained.model, sizes) == to_array(whole.trained.model, sizes)).all()
    rows = lambda r: sorted(map(tuple, r.trained.epoch_metrics.drop("duration_ms").collect()))
    assert rows(more) == rows(whole) and len(rows(more)) == 3
    logs = lambda r: sorted(map(tuple, r.trained.batch_log.collect()), key=str)
    assert logs(more) == logs(whole)
    assert sorted(map(tuple, more.validation.collect())) == sorted(map(tuple, whole.validation.collect()))
    assert [r["output"] for r in more.generated.collect()] == [r["output"] for r in whole.generated.collect()]


def test_configuration_lies_beside_the_model(spark, tmp_path):
    from wordloom.sources.runs import load_config

    (tmp_path / "in.txt").write_text(TEXT)
    out = lambda name: str(tmp_path / name)
    cfg = replace(ModelConfig(), epochs=1, layer_size=8, embedding_size=4, vocabulary_size=6, num_predictions=2, gamma=0.7)
    job.run(spark, out("in.txt"), out("t"), out("s"), ["old"], cfg, out("m"))
    assert load_config(spark, out("m") + "-config.json") == cfg
    assert load_config(spark, out("none") + "-config.json") is None
    # The sizes come from the model's own configuration.
    more = job.run(spark, out("in.txt"), out("t"), out("s"), ["old"], replace(ModelConfig(), epochs=1, num_predictions=2), out("m2"), out("m"))
    assert load_config(spark, out("m2") + "-config.json") == cfg and more.trained.epoch_metrics.first()["epoch"] == 2
