"""Words, lines and windows of many texts at once, as NumPy arrays over their UTF-8 bytes.

A word is a maximal run of bytes that are none of tab, line feed, vertical tab, form feed, carriage return
and space: `[^\\x20\\x09-\\x0D]+`. Words never span two texts. Hashes are polynomials of the bytes modulo
2^64, so the hash of any stretch is a difference of running sums; `mix` spreads their bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on every other."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and its inverse modulo 2^64 for i < n at least."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        up, down = np.full(size, U(base)), np.full(size, U(pow(base, -1, 1 << 64)))
        up[0] = down[0] = U(1)
        known = (np.cumprod(up, dtype=U), np.cumprod(down, dtype=U))
        if size <= SLICE_BYTES + (SLICE_BYTES >> 2):  # 20 MB for each base; those of a longer slice are not kept
            _POWERS[base] = known
    return known


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each stretch; equal bytes give equal hashes wherever they stand."""
    up, down = powers(BASES[which], len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * U(BASES[1]))


class Texts:
    """A slice of texts as bytes. data: all bytes; at[i]:at[i + 1] are those of text i."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        self.at = offsets - offsets[0]
        self.n = len(column)
        self._words: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    @property
    def blank(self) -> np.ndarray:
        return (self.data == 32) | ((self.data >= 9) & (self.data <= 13))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte for each text."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.at[1:]] - sums[self.at[:-1]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of every word."""
        if self._words is None:
            solid = ~self.blank
            before, after = np.zeros(len(solid), bool), np.zeros(len(solid), bool)
            before[1:], after[:-1] = solid[:-1], solid[1:]
            inner = self.at[(self.at > 0) & (self.at < len(solid))]
            before[inner], after[inner - 1] = False, False
            starts = np.flatnonzero(solid & ~before)
            ends = np.flatnonzero(solid & ~after) + 1
            self._words = starts, ends, np.searchsorted(self.at, starts, side="right") - 1
        return self._words

    def word_hashes(self, which: int = 0, data: np.ndarray | None = None) -> np.ndarray:
        starts, ends, _ = self.words()
        return stretch_hashes(self.data if data is None else data, starts, ends, which)

    def windows(self, width: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every window of so many words inside one text."""
        _, _, text = self.words()
        n = len(hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        first = np.flatnonzero(text[:n] == text[width - 1 :])
        return first, window_hash(hashes, width)[first]

    def characters(self) -> np.ndarray:
        """Number of code points before each byte, counted over all texts; one entry more than bytes."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=sums[1:])
        return sums


def window_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    total = np.zeros(n, U)
    for k in range(width):
        total = total * U(BASES[0] | 1) + hashes[k : k + n]
    return mix(total)


def pieces(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about limit bytes; a text that is longer is alone."""
    if not batch.num_rows:
        return
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += n
    yield batch.slice(start)


def map_texts(
    df: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """df through work, in slices of bounded bytes of the text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column):
                out = work(piece)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)
