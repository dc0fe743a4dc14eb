"""Arrow columns to NumPy, without a Python object per value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def list_rows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """([n, width] values, full): rows of another length are zero and not full."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    full = lengths == width
    out = np.zeros((len(column), width), dtype=flat.dtype)
    out[full] = flat[np.repeat(full, lengths)].reshape(-1, width)
    return out, full


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def as_lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from a matrix."""
    n, width = rows.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1), kind))


def joined_millionths(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as text: its values in millionths, rounded half away from zero, joined by spaces."""
    twice = (rows * 2e6).astype(np.int64)
    whole = (twice + np.fmod(twice, 2)) // 2
    return pc.binary_join(as_lists(whole, pa.int64()).cast(pa.list_(pa.string())), " ")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts, or lists at 8 bytes a value, have at most limit bytes; a longer one is alone."""
    cells = batch.column(column)
    lists = pa.types.is_list(cells.type)
    sizes = pc.multiply(pc.list_value_length(cells), 8) if lists else pc.binary_length(cells)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, in their order, in batches of some limit bytes of text, or of lists, but for the last one."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, limit):
            held.append(part)
            size += part.column(column).nbytes
            if size >= limit:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def coded(lists: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All values of a list column as places in their dictionary, and how many each list has; null is a value."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return pc.dictionary_encode(lists.flatten(), null_encoding="encode"), lengths


def cut_words(lines: pa.Array, blanks: str) -> pa.Array:
    """The words of each line: those of functions.text.split_words, whose white space is ASCII's, as Arrow's is."""
    trimmed = pc.ascii_rtrim(lines, blanks)
    only_blanks = pc.and_(pc.equal(trimmed, ""), pc.not_equal(lines, ""))
    return pc.ascii_split_whitespace(pc.if_else(only_blanks, pa.scalar(None, pa.string()), trimmed))


def split_lists(flat: pa.Array, lengths: np.ndarray) -> pa.Array:
    """A list column from its values and the number that each list has."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), flat)


def first_places(lines: pa.Array, blanks: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(word, line, pos) of every distinct word of all lines: where it stands first. Linear: a dictionary numbers its
    values as they first come, so a word comes first where the largest number so far grows."""
    found, lengths = coded(cut_words(lines, blanks))
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1)) if len(codes) else np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    line = np.searchsorted(ends, at, side="right")
    return found.dictionary, line, at - (ends - lengths)[line]


def first_words(lines: pa.Array, blanks: str) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(word, line, pos, n) of every word of each line: where it stands first in the line, and how often it does.

    Linear but for the sort of (line, word) numbers.
    """
    found, lengths = coded(cut_words(lines, blanks))
    word = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line = np.repeat(np.arange(len(lines), dtype=np.int64), lengths)
    pos = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key = line * max(len(found.dictionary), 1) + word
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0]) if len(key) else np.zeros(0, np.int64)
    at = order[heads]
    return found.dictionary.take(pa.array(word[at])), line[at], pos[at], np.diff(np.r_[heads, len(key)])
