"""The query of each operator over the tables of a data folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    bpe, chat, collocations, decontaminate, html_text, near, ordinal, quality_rules, resample, secrets, substrings, url_rules, warc,
)
from wordloom.llm.oracles import ORACLES


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_spans(_table(spark, folder, "documents"), marks=False)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near.join_near(_table(spark, folder, "documents")).drop("digest")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.apply_rules(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang",
        *quality_rules.SCORES,
    )


def op5_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve(warc.captures(_table(spark, folder, "pages")))
    entry = F.transform("headers", lambda h: F.concat_ws("=", h["name"], h["value"]))
    return found.select(
        "record_id",
        "url",
        "date",
        F.coalesce("response_id", F.lit(-1).cast("bigint")).alias("response_id"),
        "state",
        F.coalesce(F.array_join(entry, ";"), F.lit("")).alias("headers"),
    )


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.main_text(_table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """A source is an owner, its documents of one language are a repository."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    found = secrets.find_secrets(docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    base = F.filter("spans", secrets.is_base)
    count = [secrets.count_of(F.col("spans"), name).alias(f"n_{name}") for name, *_ in secrets.BASE_KINDS]
    return found.select(
        "doc_id",
        *count,
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("bigint").alias("n_copied"),
    )


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal.grade_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    found = chat.read_back(chat.segments(rows))
    return found.withColumn("first_bad", F.coalesce("first_bad", F.lit(-1).cast("bigint")))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


URL_RULES = [
    url_rules.Rule("block", "net", "/"),
    url_rules.Rule("allow", "example.net", "/en/"),
    url_rules.Rule("block", "example.com", "/de/"),
    url_rules.Rule("allow", "org", "/fr/"),
]


def op13_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(_table(spark, folder, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_decontamination, op3_ngram_jaccard_join, op4_quality_rules, op5_warc_revisits, op6_html_extraction, op7_bpe, op8_secret_scans, op9_quality_classifier, op10_chat_formatting, op11_collocations, op12_importance_resampling, op13_url_filters)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return dict(QUERIES) | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    import corpus_pipeline

    return dict(ORACLES) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
