"""From raw documents to token ids: five stages, each written as Parquet before the next reads it.

1. quality_classifier: documents that the ordinal model of the labelled ones rejects go.
2. ngram_jaccard_join: one document of each class of near duplicates stays, that of the least id.
3. benchmark_decontamination: documents that hold a passage of the benchmark go.
4. secret_scans: credentials that look live are replaced by their kind; copied examples stay.
5. bpe: the token ids of every document, and the digest of the text they decode to. Of the documents' columns doc_id, lang
   and source stay.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import bpe, decontaminate, near, ordinal, secrets
from wordloom.sources.session import saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal.select_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, F.concat_ws("/", "source", "lang"), F.col("source"))


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), ("doc_id", "lang", "source"))
    return found.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe", bpe_ids),
]

# The fitted model of the first stage has no SQL form: the pipeline is tested stage by stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
