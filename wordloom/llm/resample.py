"""Target-distribution importance resampling: documents drawn by how their word n-grams are spread in a target text.

Separator newlines cut texts into lines. A slice of texts looks up each distinct line once: its n-grams' buckets, taken
as often as the line occurs, or their gains, added up to the line's weight. The n-grams that cross a line's end are
added separately. Counts of a slice are summed in its task before they are shuffled: a row per bucket and task.

A document's weight is the sum of its features' gains, floor(1000 * ln of (share in the target / share in the corpus)) by
bucket; a draw of the document (Gumbel noise from a digest of its id) is added, and the highest scores are drawn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.textbytes import Texts, pieces
from wordloom.sources.session import dense_ids, saved


@dataclass(frozen=True)
class Resampling:
    """words: of the longest feature. percent: share of the documents of least_words words or more that is drawn."""

    words: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024
    slice_bytes: int = 4 << 20


def _is_word() -> np.ndarray:
    """Bytes of words: digits, a-z, and all beyond ASCII. A-Z are lower-cased before."""
    known = np.zeros(256, bool)
    known[48:58] = known[97:123] = known[128:] = True
    return known


class Lines:
    """A slice of texts as lines: the distinct ones, their words, and which of them each text has in order."""

    def __init__(self, column: pa.Array):
        texts = Texts(column)
        self.n = texts.n
        data = texts.data
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        # A line ends behind its newline, or where its text ends.
        edge = np.zeros(len(data) + 1, bool)
        edge[1:] = data == 10
        edge[texts.at] = True
        cuts = np.flatnonzero(edge)
        self.text = np.searchsorted(texts.at, cuts[:-1], side="right") - 1
        offsets = pa.py_buffer(cuts.astype(np.int64))
        every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])
        coded = pc.dictionary_encode(every)
        self.line = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lines = Texts(coded.dictionary.cast(pa.large_binary()).view(pa.large_string()))
        solid = _is_word()[lines.data]
        before, after = np.zeros(len(solid), bool), np.zeros(len(solid), bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        inner = lines.at[(lines.at > 0) & (lines.at < len(solid))]
        before[inner], after[inner - 1] = False, False
        starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(lines.data[solid]))],
        )
        coded = pc.dictionary_encode(words)
        self.words = coded.dictionary.to_pylist()
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.owner = np.searchsorted(lines.at, starts, side="right") - 1  # the distinct line of each word
        self.lines = lines.n
        self.first = np.searchsorted(self.owner, np.arange(self.lines + 1))

    def buckets(self, runs: np.ndarray, buckets: int) -> np.ndarray:
        """Bucket of each run of words [n, words]: each distinct run is hashed once."""
        kinds, where = np.unique(runs, axis=0, return_inverse=True) if runs.shape[1] > 1 else np.unique(runs[:, 0], return_inverse=True)
        found = [
            zlib.crc32(b" ".join([self.words[w] for w in run])) if runs.shape[1] > 1 else zlib.crc32(self.words[run])
            for run in kinds.tolist()
        ]
        return np.array(found, np.int64)[where.reshape(-1)] % buckets if len(found) else np.zeros(0, np.int64)

    def inside(self, words: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(distinct line, bucket) of the features of each distinct line."""
        owners, found = [], []
        for length in range(1, words + 1):
            at = np.arange(max(len(self.word) - length + 1, 0))
            at = at[self.owner[at] == self.owner[at + length - 1]]
            owners.append(self.owner[at])
            found.append(self.buckets(self.word[at[:, None] + np.arange(length)], buckets))
        return np.concatenate(owners), np.concatenate(found)

    def across(self, words: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of the features that begin in one line of a text and end in a later one."""
        if words < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Of every line only its first and last words - 1 words can stand in such a feature.
        keep = words - 1
        count = np.diff(self.first)[self.line]
        ends = np.cumsum(count)
        near = np.arange(int(ends[-1]) if len(ends) else 0)
        occurrence = np.repeat(np.arange(len(self.line)), count)
        place = near - (ends - count)[occurrence]
        word, text = self.word[self.first[self.line[occurrence]] + place], self.text[occurrence]
        from_end = count[occurrence] - place
        owners, found = [], []
        for length in range(2, words + 1):
            at = np.flatnonzero(from_end < length)
            at = at[at + length - 1 < len(word)]
            at = at[(text[at] == text[at + length - 1]) & (occurrence[at] != occurrence[at + length - 1])]
            owners.append(text[at])
            found.append(self.buckets(word[at[:, None] + np.arange(length)], buckets))
        assert keep >= 1
        return np.concatenate(owners), np.concatenate(found)


def feature_counts(texts: DataFrame, resampling: Resampling) -> np.ndarray:
    """Features in each bucket over the text column of all rows. One row per bucket and task is shuffled, and `buckets`
    numbers reach the driver, whatever the input.
    """
    words, buckets = resampling.words, resampling.buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text", resampling.slice_bytes):
                lines = Lines(piece.column("text"))
                times = np.bincount(lines.line, minlength=lines.lines)
                owner, bucket = lines.inside(words, buckets)
                total += np.bincount(bucket, times[owner], minlength=buckets).astype(np.int64)
                total += np.bincount(lines.across(words, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    summed = texts.select("text").mapInArrow(work, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B)))) of every bucket, in doubles."""
    t, s, b = target.astype(float), source.astype(float), float(len(target))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, resampling: Resampling) -> DataFrame:
    """doc_id, n_features, weight and n_words of every document, each row by itself."""
    words = resampling.words
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", resampling.slice_bytes):
                lines, gain = Lines(piece.column("text")), shared.value
                owner, bucket = lines.inside(words, len(gain))
                # Weights and counts of a distinct line, once; then of a text, by its lines. Integers, so sums are exact.
                by_line = [np.bincount(owner, minlength=lines.lines), _sums(owner, gain[bucket], lines.lines)]
                cross, bucket = lines.across(words, len(gain))
                n = np.bincount(cross, minlength=lines.n) + _sums(lines.text, by_line[0][lines.line], lines.n)
                weight = _sums(cross, gain[bucket], lines.n) + _sums(lines.text, by_line[1][lines.line], lines.n)
                n_words = _sums(lines.text, np.diff(lines.first)[lines.line], lines.n)
                columns = [piece.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n, weight, n_words))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "weight", "n_words"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_features bigint, weight bigint, n_words bigint")


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of integers by ascending or any group, in integers."""
    out = np.zeros(n, np.int64)
    np.add.at(out, group, values)
    return out


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln((h + 0.5) / 2^32))), h being the first eight hex digits of sha256(`seed:doc_id`)."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, resampling: Resampling | None = None) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null for those that are not drawn.

    A null text has no words; a null doc_id is drawn as an empty one. Ties go to the smaller doc_id, then to the smaller
    weight and number of features, so rows that repeat a document are drawn one by one. Other columns are not read.
    Without documents there are no rows; an empty target has no features. A long text is a slice of its own.
    """
    resampling = resampling or Resampling()
    gain = gains(feature_counts(target, resampling), feature_counts(docs, resampling))
    scored = saved(weights(docs, gain, resampling).withColumn("score", F.col("weight") + noise(F.col("doc_id"), resampling.seed)))
    eligible = scored.where(F.col("n_words") >= resampling.least_words)
    drawn = eligible.count() * resampling.percent // 100
    names = ["doc_id", "n_features", "weight", "score"]
    ranked = dense_ids(eligible.select(*names, (-F.col("score")).alias("_low")), ["_low", "doc_id", "weight", "n_features"], "_i")
    rank = F.when(F.col("_i") < drawn, F.col("_i") + 1).cast("bigint").alias("rank")
    others = scored.where(F.col("n_words") < resampling.least_words).select(*names, F.lit(None).cast("bigint").alias("rank"))
    return ranked.select(*names, rank).unionByName(others)
