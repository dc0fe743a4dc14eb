"""A run's folder: configuration, vocabulary, and every finished epoch, each committed by a manifest.

An epoch's tables are written to a folder of their own first. The manifest that names it is one small file that is renamed
into place when all of them are there, so a job that is killed leaves whole epochs or nothing of one, and what it left half
written is never read. A later job on the same folder goes on behind the last manifest.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from wordloom.config import Limits, ModelConfig

TABLES = ("model", "log", "metrics", "validation")


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the class of its paths."""
    kind = spark._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark._jsc.hadoopConfiguration()), kind


def put_json(spark: SparkSession, path: str, content: dict, again: bool = False) -> None:
    """Writes a small file aside and renames it into place; one that is there already stays, unless again is set."""
    files, kind = _files(spark, path)
    target = kind(path)
    aside = kind(target.getParent(), f"_aside-{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    stream = files.create(aside, True)
    stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    stream.close()
    if again:
        files.delete(target, False)
    if not files.rename(aside, target):
        raise FileExistsError(f"{path} is there already")


def get_json(spark: SparkSession, path: str) -> dict | None:
    """The content of a small file; None if there is none."""
    files, kind = _files(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if files.exists(kind(path)) else None


def save_config(spark: SparkSession, cfg: ModelConfig, path: str) -> None:
    put_json(spark, path, asdict(cfg), again=True)


def as_config(found: dict) -> ModelConfig:
    return ModelConfig(**{**found, "limits": Limits(**found["limits"])})


def load_config(spark: SparkSession, path: str) -> ModelConfig | None:
    found = get_json(spark, path)
    return None if found is None else as_config(found)


class RunFolder:
    """path: any Hadoop path that the driver and the executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _get(self, name: str) -> dict | None:
        return get_json(self.spark, f"{self.path}/{name}")

    def start(self, cfg: ModelConfig, vocab: DataFrame) -> None:
        """Writes the vocabulary, then the configuration, whose file tells that the run has begun."""
        folder = f"vocab-{uuid.uuid4().hex}"
        vocab.select("word", "id").write.parquet(f"{self.path}/{folder}")
        put_json(self.spark, f"{self.path}/run.json", {"config": asdict(cfg), "vocab": folder})

    def config(self) -> ModelConfig | None:
        """The configuration the run began with; None if it has not begun."""
        found = self._get("run.json")
        return None if found is None else as_config(found["config"])

    def vocab(self) -> DataFrame:
        return self.spark.read.schema("word string, id bigint").parquet(f"{self.path}/{self._get('run.json')['vocab']}")

    def commit(self, epoch: int, **tables: DataFrame | None) -> None:
        """Writes the tables of an epoch and its manifest."""
        folder = f"epoch-{epoch}-{uuid.uuid4().hex}"
        there = {name: table for name, table in tables.items() if table is not None}
        if not set(there) <= set(TABLES):
            raise ValueError(f"unknown tables: {sorted(set(there) - set(TABLES))}")
        for name, table in there.items():
            table.write.parquet(f"{self.path}/{folder}/{name}")
        manifest = {"epoch": epoch, "folder": folder, "tables": sorted(there)}
        put_json(self.spark, f"{self.path}/epochs/{epoch:06d}.json", manifest)

    def epochs(self) -> list[dict]:
        """The manifests, in the order of their epochs."""
        files, kind = _files(self.spark, self.path)
        found = files.globStatus(kind(f"{self.path}/epochs/*.json")) or []
        names = sorted(f.getPath().getName() for f in found)
        return [self._get(f"epochs/{name}") for name in names]

    def table(self, manifest: dict, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{manifest['folder']}/{name}")

    def model(self) -> DataFrame | None:
        """The model after the last committed epoch."""
        epochs = self.epochs()
        return self.table(epochs[-1], "model") if epochs else None

    def all_epochs(self, name: str) -> DataFrame | None:
        """One table of all committed epochs."""
        parts = [self.table(m, name) for m in self.epochs() if name in m["tables"]]
        return reduce(DataFrame.unionByName, parts) if parts else None
