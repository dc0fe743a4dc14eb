"""Corpus statistics, split and tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import draws, places
from wordloom.functions.text import BLANKS, split_words
from wordloom.operators.arrow import first_words, slices


def corpus_stats(lines: DataFrame) -> DataFrame:
    """Line and word counts of a corpus in one pass; only partial sums are shuffled."""
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(F.size(split_words(F.col("line")))), F.lit(0)).alias("words"),
    )


def partition_count(df: DataFrame) -> DataFrame:
    """Partitions that hold rows, and the rows in them."""
    return (
        df.groupBy(F.spark_partition_id().alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("rows"))
    )


def split_train(lines: DataFrame, percent: int = 80, seed: int = 42) -> DataFrame:
    """Adds is_train from a hash of the line's key: the same lines under any partitioning."""
    bucket = draws.hash32(draws.digest(seed, F.col("doc_id"), F.col("line_no")), 1) % 100
    return lines.withColumn("is_train", bucket < percent)


def split_weighted(lines: DataFrame, weights: list[float], seed: int = 42, by_document: bool = True) -> DataFrame:
    """Adds part, the number of the weight that a line falls to, by where a hash lies among the cumulative weights.

    Parts have shares of their weights over the sum of all. Lines of one document stay together, unless by_document is
    off; either way a line's part is the same under any partitioning.
    """
    total = sum(weights)
    if total <= 0 or min(weights) < 0:
        raise ValueError(f"weights must not be negative, nor all be zero: {weights}")
    bounds = [int(sum(weights[: i + 1]) / total * 2**32) for i in range(len(weights) - 1)]
    key = [F.col("doc_id")] if by_document else [F.col("doc_id"), F.col("line_no")]
    place = draws.hash32(draws.digest(seed, *key), 1)
    part = F.lit(0)
    for bound in bounds:
        part = part + (place >= bound).cast("int")
    return lines.withColumn("part", part)


def tokenize(lines: DataFrame) -> DataFrame:
    """Lines with their words as an array."""
    return lines.withColumn("words", split_words(F.col("line")))


def explode_tokens(lines: DataFrame) -> DataFrame:
    """One row per word."""
    return lines.select(
        "doc_id", "line_no", F.posexplode(split_words(F.col("line"))).alias("pos", "word")
    )


def distinct_words(lines: DataFrame) -> DataFrame:
    """Each distinct word with the place it is first seen and its number of occurrences.

    A slice of lines sends one row for each of its words: the word's first place among them and its count. Those are
    taken together in hash maps before and after the shuffle, so a frequent word costs one row per task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "line"):
                word, line, pos, n = first_words(piece.column("line"), BLANKS)
                rows = pa.array(line)
                columns = [word, piece.column("doc_id").take(rows), piece.column("line_no").take(rows)]
                columns += [pa.array(pos, pa.int32()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "doc_id", "line_no", "pos", "n"])

    counted = lines.select("doc_id", "line_no", "line").mapInArrow(
        work, "word string, doc_id bigint, line_no bigint, pos int, n bigint"
    )
    # Every word once for each line, so min_by meets no tie.
    each = counted.select("word", places.place(F.col("doc_id"), F.col("line_no")).alias("_line"), "pos", "n")
    found = each.groupBy("word").agg(
        F.min("_line").alias("first"), F.min_by("pos", "_line").alias("pos"), F.sum("n").alias("n")
    )
    doc_id, line_no = places.parts(F.col("first"))
    return found.select("word", doc_id.alias("doc_id"), line_no.alias("line_no"), "pos", "n")
