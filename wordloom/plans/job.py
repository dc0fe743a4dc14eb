"""The whole job: text in, vocabulary, training, metrics, generated text out."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.config import ModelConfig
from wordloom.operators import corpus, generation, metrics, samples, scoring, training, vocab
from wordloom.operators.model import load_model, save_model
from wordloom.operators.vocab import load_vocab, save_vocab
from wordloom.sources import sinks
from wordloom.sources.runs import RunFolder, load_config, save_config
from wordloom.sources.session import saved
from wordloom.sources.text import read_lines

# Fixed value: the seed text of a run that names none.
DEFAULT_SEED_TEXT = "The little cat"


# Command-line names of the configuration's sizes and rates.
SETTINGS = {
    "epochs": "epochs",
    "window": "window_size",
    "length": "num_predictions",
    "vocabulary": "vocabulary_size",
    "embedding": "embedding_size",
    "hidden": "layer_size",
    "batch": "batch_size",
    "rate": "initial_rate",
    "decay": "gamma",
    "dropout": "drop_prob",
    "temperature": "temperature",
    "seed": "seed",
}


@dataclass
class JobResult:
    vocab: DataFrame
    trained: training.TrainResult
    validation: DataFrame
    generated: DataFrame
    run_id: str


def fit(
    lines: DataFrame,
    cfg: ModelConfig,
    known: DataFrame | None = None,
    model: DataFrame | None = None,
    folder: RunFolder | None = None,
) -> tuple[DataFrame, training.TrainResult, DataFrame]:
    """Vocabulary of all lines, a model trained on the training lines, metrics on the others after every epoch.

    A known vocabulary keeps its ids and is extended; a given model is trained further. A run's folder gets every epoch
    when it is done; if it has some already, the run goes on behind them, with its own vocabulary.
    """
    if folder is not None and folder.config() is not None:
        words, model = folder.vocab(), folder.model() or model
    else:
        words = saved(vocab.fit_vocab(lines) if known is None else vocab.extend_vocab(known, lines, cfg.limits))
        if folder is not None:
            folder.start(cfg, words)
    split = saved(samples.training_samples(lines, words, cfg.window_size, cfg.limits))
    bucketed = corpus.split_train(split, seed=cfg.seed)
    held_out = bucketed.where(~bucketed["is_train"]).drop("is_train")
    ahead = cfg.epochs - len(folder.epochs()) if folder else cfg.epochs
    trained = training.train(
        bucketed.where("is_train").drop("is_train"), cfg, max(ahead, 0), model, held_out, folder.commit if folder else None
    )
    validation = trained.validation
    if folder is not None and folder.epochs():
        trained.epoch_metrics, trained.batch_log = folder.all_epochs("metrics"), folder.all_epochs("log")
        validation = folder.all_epochs("validation")
    if validation is None:
        scored = scoring.folded(scoring.predict(held_out, trained.model, cfg), cfg)
        validation = metrics.evaluate(scored).withColumn("epoch", F.lit(0))
    return words, trained, saved(validation)


def run(
    spark: SparkSession,
    input_path: str,
    result_path: str,
    stats_path: str,
    seed_texts: list[str] | DataFrame = (DEFAULT_SEED_TEXT,),
    cfg: ModelConfig | None = None,
    model_path: str | None = None,
    resume_from: str | None = None,
    run_folder: str | None = None,
) -> JobResult:
    """Runs the job; "{instant}" in an output path becomes the run's start time.

    The folder of statistics gets the epoch metrics, and beside them, as "-validation", the metrics on held-out
    lines. model_path gets the model and, as "-vocab" and "-config.json", vocabulary and configuration; resume_from names
    such a model to go on from.
    run_folder gets every epoch as it is done, beside vocabulary and configuration. A job that was killed is started again
    with the same one and goes on behind its last epoch, by the configuration kept there but for the number of epochs.
    """
    cfg, run_id = cfg or ModelConfig(), sinks.run_stamp()
    folder = RunFolder(spark, run_folder) if run_folder else None
    begun = folder.config() if folder else None
    if begun is None and resume_from:
        begun = load_config(spark, f"{resume_from}-config.json")
    if begun is not None:
        # What a run goes on with is what it began with; how far it goes and what it generates may differ.
        cfg = replace(begun, epochs=cfg.epochs, num_predictions=cfg.num_predictions, temperature=cfg.temperature)
    lines = read_lines(spark, input_path, cfg.limits)
    known, model = (load_vocab(spark, f"{resume_from}-vocab"), load_model(spark, resume_from)) if resume_from else (None, None)
    words, trained, validation = fit(lines, cfg, known, model, folder)
    if isinstance(seed_texts, DataFrame):
        seeds = seed_texts
    else:
        seeds = spark.createDataFrame(list(enumerate(seed_texts)), "seed_row bigint, seed string")
    generated = saved(generation.generate(seeds, trained.model, words, cfg))
    sinks.write_metrics(trained.epoch_metrics, sinks.stamped(stats_path, run_id))
    sinks.write_generated(generated, sinks.stamped(result_path, run_id))
    sinks.write_validation(validation, sinks.stamped(stats_path, run_id) + "-validation")
    if model_path:
        save_model(trained.model, sinks.stamped(model_path, run_id))
        save_vocab(words, sinks.stamped(model_path, run_id) + "-vocab")
        save_config(spark, cfg, sinks.stamped(model_path, run_id) + "-config.json")
    return JobResult(words, trained, validation, generated, run_id)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("seed_text", nargs="?", default=DEFAULT_SEED_TEXT)
    parser.add_argument("input", help="text file or folder, any Hadoop path")
    parser.add_argument("result", help="output folder for generated text")
    parser.add_argument("stats", help="output folder for epoch metrics")
    for name, setting in SETTINGS.items():
        parser.add_argument(f"--{name}", type=type(getattr(ModelConfig, setting)), default=getattr(ModelConfig, setting))
    parser.add_argument("--model", help="output folder for the model table; vocabulary and configuration go beside it")
    parser.add_argument("--run-folder", help="folder that gets every epoch; a killed job goes on from it")
    parser.add_argument("--resume", help="folder of a saved model, with its vocabulary, to go on from")
    args = parser.parse_args(argv)
    cfg = ModelConfig(**{setting: getattr(args, name) for name, setting in SETTINGS.items()})
    spark = SparkSession.builder.appName("wordloom").getOrCreate()
    run(spark, args.input, args.result, args.stats, [args.seed_text], cfg, args.model, args.resume, args.run_folder)


if __name__ == "__main__":
    main()
