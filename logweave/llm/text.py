"""Whole-buffer views of an Arrow text column: bytes, words and word codes.

A word is a maximal run of bytes other than space and 0x09-0x0D. Null texts
count as empty. Everything here runs inside Spark's Arrow tasks, on slices of
a bounded number of bytes, so that memory doesn't follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that one slice holds at most (a longer single text is a slice of its own).
SLICE_BYTES = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           max_bytes: int = SLICE_BYTES, max_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches so that the text of each part stays within ``max_bytes``."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            stop = min(stop, at + max_rows)
            yield batch.slice(at, stop - at)
            at = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each text begins (one more at the end)."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def word_spans(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every word, in order."""
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = inside.copy()
    last = inside.copy()
    if len(raw):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = begins[1:-1]
        cut = cut[(cut > 0) & (cut < len(raw))]  # a word ends where its text ends
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(begins, start, side="right") - 1


def word_array(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words as one Arrow binary array."""
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    at = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=at[1:])
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(raw[inside])])


def word_codes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code for every word (or part of one, in order), and the distinct words by code."""
    coded = word_array(raw, start, end).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
