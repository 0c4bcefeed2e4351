"""Vectorised views of text columns: slices of bounded size, word spans, word codes.

Texts are handled as UTF-8 bytes. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
# Bytes of words where blanks are space, tab, line feed, vertical tab, form feed, carriage return.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, changed where a table already has such a column."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", budget: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that no piece has more than ``budget`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, base + budget, side="right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, and where each row begins (one more entry than rows)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0] : bounds[-1]], bounds - bounds[0]


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds; empty stretches give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def word_spans(
    data: np.ndarray, bounds: np.ndarray, word_byte: np.ndarray = NOT_BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the bounds of each row in the list of words."""
    inside = word_byte[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds, side="left")


def span_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte strings of spans that are in order and do not overlap."""
    marks = np.zeros(len(data) + 1, dtype=np.int8)
    marks[starts] += 1
    marks[ends] -= 1
    kept = data[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)] if len(data) else data
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))]
    )


def codes_of(values: pa.Array | np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Dense codes by first occurrence, and the distinct values."""
    if isinstance(values, np.ndarray):
        values = pa.array(values)
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; no other byte changes."""
    upper = (data >= 0x41) & (data <= 0x5A)
    return np.where(upper, data | 0x20, data).astype(np.uint8)
