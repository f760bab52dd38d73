"""Words of Arrow text columns, for operators whose tasks run numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in runs whose text has at most so many bytes, or single longer rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


_ALPHANUMERIC = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


def words_of(texts: pa.Array, lower: bool = False, apart: bytes = b"") -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: number of words per text, the words as codes, and the distinct words (bytes) by code.

    `lower` makes A-Z lower case. Signs in `apart` are words of their own where
    they end a word and stand behind an ASCII letter or digit.
    """
    each = objects(pc.fill_null(pc.cast(texts, pa.large_binary()), b""))
    joined = b"\n".join(each)
    data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(gap.view(np.int8), prepend=1, append=1))
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) + 1)
    upto = np.searchsorted(starts, text_ends)
    lengths = ends - starts
    if apart and len(starts):
        signs = np.isin(np.arange(256), np.frombuffer(apart, np.uint8))
        cut = signs[data[ends - 1]] & (lengths > 1) & _ALPHANUMERIC[data[np.maximum(ends - 2, 0)]]
        cuts = np.append(0, np.cumsum(cut))
        whole = lengths - cut
        lengths = np.ones(len(starts) + int(cuts[-1]), np.int64)
        lengths[np.arange(len(starts)) + cuts[:-1]] = whole
        upto = upto + cuts[upto]
    offsets = np.append(0, np.cumsum(lengths))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])])
    coded = words.dictionary_encode()
    return np.diff(upto, prepend=0), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def objects(values: pa.Array) -> list:
    """The values as Python objects; much faster than one scalar at a time."""
    return values.to_numpy(zero_copy_only=False).tolist()


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the given runs, one run after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)
