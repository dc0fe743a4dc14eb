"""Corpora as line tables: doc_id, line_no, line. Order lives in the columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.config import Limits
from wordloom.functions.text import LINE_END, split_lines
from wordloom.sources.session import dense_ids, saved


def lines_from(df: DataFrame, key: Column | str, text: Column | str) -> DataFrame:
    """Lines of any table with a numeric key and a text column. Narrow: no shuffle."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.col(text) if isinstance(text, str) else text
    return df.select(
        key.cast("bigint").alias("doc_id"), F.posexplode(split_lines(text)).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def turn_key(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> Column:
    """One key for a (conversation, turn) pair: conv * width + turn, the width one more than the largest turn.

    However many turns a conversation has, no two share a key; a negative or null turn fails, as does a key
    beyond 64 bits.
    """
    width = (turns.agg(F.max(turn)).first()[0] or 0) + 1
    return F.when(F.col(turn) >= 0, F.col(conv) * width + F.col(turn)).otherwise(
        F.raise_error(F.lit("turn number does not fit the key"))
    )


def lines_in_memory(spark: SparkSession, texts: list[str]) -> DataFrame:
    """A corpus given as a list, one line per element."""
    rows = [(0, number, text) for number, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, line_no bigint, line string")


def _numbered_splits(raw: DataFrame) -> DataFrame:
    """split, at, line: the number of each line in its split, as a task reads the split in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, 0
        for batch in batches:
            split = batch.column("split").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(split)) + 1).tolist(), len(split)]
            at = np.empty(len(split), np.int64)
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if split[start] != current:
                    current, seen = split[start], 0
                at[start:end] = np.arange(seen, seen + end - start)
                seen += end - start
            yield pa.RecordBatch.from_arrays([batch.column("split"), pa.array(at), batch.column("line")], ["split", "at", "line"])

    return raw.select("split", "line").mapInArrow(work, "split bigint, at bigint, line string")


def _splits_stay(spark: SparkSession, size: int) -> bool:
    """Whether files of so many bytes are cut by the largest split size, however many cores the cluster has or gets.

    A smaller input is cut finer on a larger cluster, so two reads of it may have other splits.
    """
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return size >= 16 * limit * spark.sparkContext.defaultParallelism


def read_lines(spark: SparkSession, path: str, limits: Limits | None = None, copy: bool | None = None) -> DataFrame:
    """Text files (local, s3a or any Hadoop path) as lines: doc_id numbers the files in path order.

    Files are split for reading, so a line's number is its place in the split plus the lines of the file's earlier splits.
    A first pass counts the lines of each split, whose table is small; the lines are read again and numbered as they
    come. A file that was compressed as a whole is one split. A small input, whose splits depend on the cluster's cores, is
    written once between the passes instead (copy); a split that was not counted as it is read is refused.
    """
    limits = limits or Limits()
    files_of = spark.read.text(path, lineSep=LINE_END)
    text = files_of.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("split"),
    )
    if copy is None:
        # By the listing of the files; nothing is read for it.
        listed = files_of._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        copy = not _splits_stay(spark, int(str(listed)))
    marked = text.withColumn("at", F.monotonically_increasing_id())
    raw = saved(marked) if copy else marked
    splits = raw.groupBy("file", "block", "split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("at").alias("first_at"),
        F.max(F.when(F.col("line") != "", F.col("at"))).alias("last_text_at"),
    )
    splits = splits if copy else saved(splits)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    files = dense_ids(splits.select("file").distinct(), ["file"], "doc_id")
    placed = saved(
        splits.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).join(files, "file")
    )
    size = placed.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("file") + 48).alias("bytes")
    ).first()
    fits = size["rows"] <= limits.broadcast_rows and (size["bytes"] or 0) <= limits.broadcast_bytes
    if copy:
        # The copy keeps the ids of the pass that counted.
        rows = raw.select("split", "at", "line")
        place = F.col("at") - F.col("first_at")
    else:
        rows, place = _numbered_splits(text), F.col("at")
    known = placed.select("split", "doc_id", "before", "rows", "first_at")
    numbered = rows.join(F.broadcast(known) if fits else known, "split", "left").select(
        F.coalesce("doc_id", F.lit(-1).cast("bigint")).alias("doc_id"),
        (F.coalesce("before", F.lit(0).cast("bigint")) + place).alias("line_no"),
        "line",
        (place < F.col("rows")).alias("counted"),
    )
    # Empty lines after the last text of the whole corpus are dropped, inner ones stay.
    last = placed.agg(
        F.max(
            F.when(
                F.col("last_text_at").isNotNull(),
                F.struct("doc_id", (F.col("before") + F.col("last_text_at") - F.col("first_at")).alias("line_no")),
            )
        ).alias("last")
    ).first()["last"]
    if last is None:
        return numbered.where(F.lit(False)).drop("counted")
    kept = numbered.where(
        (F.col("doc_id") < last["doc_id"])
        | ((F.col("doc_id") == last["doc_id"]) & (F.col("line_no") <= last["line_no"]))
    )
    other = F.raise_error(F.lit("a file's splits differ from those that were counted")).cast("bigint")
    return kept.select("doc_id", F.when(F.col("counted"), F.col("line_no")).otherwise(other).alias("line_no"), "line")
