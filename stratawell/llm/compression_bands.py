"""Quality rules from zstandard ratios, beside plain word counts.

A text that compresses far better than prose of its length repeats itself; one that hardly
compresses is noise or encoded data. What is usual depends on the length, so every length has its
own band, for the whole text and for chunks of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from stratawell.llm.words import codes_of, per_row, slices, span_strings, text_bytes, word_spans
from stratawell.session import spread

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3


@dataclass(frozen=True)
class Band:
    """Ratios (bytes before / after) that texts of up to ``max_bytes`` bytes may have."""

    max_bytes: float
    least: float
    most: float


@dataclass(frozen=True)
class Limits:
    whole: tuple[Band, ...] = (
        Band(200, 0.0, float("inf")),  # the frame of the format outweighs such a text
        Band(500, 1.05, 3.0),
        Band(2_000, 1.25, 4.0),
        Band(20_000, 1.4, 5.0),
        Band(float("inf"), 1.45, 6.5),
    )
    chunk: tuple[Band, ...] = (
        Band(200, 0.0, float("inf")),
        Band(500, 1.05, 3.0),
        Band(float("inf"), 1.25, 4.0),
    )
    chunk_bytes: int = 2048
    max_bad_percent: int = 40  # of the bytes, in chunks outside their band
    level: int = 3


def _within(sizes: np.ndarray, ratios: np.ndarray, bands: tuple[Band, ...]) -> np.ndarray:
    band = np.searchsorted([b.max_bytes for b in bands], sizes, side="left")
    least = np.array([b.least for b in bands])[band]
    most = np.array([b.most for b in bands])[band]
    return (ratios >= least) & (ratios <= most)


def word_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text."""
    data, bounds = text_bytes(texts)
    starts, ends, words = word_spans(data, bounds)
    n_rows, n_words = len(bounds) - 1, np.diff(words)
    letters = (data & 0xC0) != 0x80
    blank = np.ones(len(data), dtype=bool)
    for code in (0x20, *range(0x09, 0x0E)):
        blank &= data != code
    symbols = np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8))

    # Lines are cut at \n and at the ends of rows; they may be empty.
    breaks = np.flatnonzero(data == 0x0A)
    line_ends = np.sort(np.concatenate([breaks, bounds[1:]]))
    line_starts = np.sort(np.concatenate([breaks + 1, bounds[:-1]]))
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_row = np.searchsorted(bounds, line_starts, side="right") - 1
    line_code, _ = codes_of(span_strings(data, line_starts, line_ends))
    distinct = np.unique(line_code * n_rows + line_row)
    dup_lines = np.bincount(line_row, minlength=n_rows) - np.bincount(distinct % max(n_rows, 1), minlength=n_rows)

    row = np.repeat(np.arange(n_rows), n_words)
    repeated = np.zeros(n_rows, np.int64)
    if len(row) >= WINDOW:
        code, names = codes_of(span_strings(data, starts, ends))
        key = code
        for k in range(1, WINDOW):
            key, _ = codes_of(key[: len(code) - k] * len(names) + code[k:])
        same_row = row[: len(key)] == row[WINDOW - 1 :]
        at = np.flatnonzero(same_row)
        group, _ = codes_of(key[at] * n_rows + row[at])
        often = at[np.bincount(group)[group] >= 2] if len(at) else at
        hit = np.zeros(len(row), dtype=bool)
        for k in range(WINDOW):
            hit[often + k] = True
        repeated = per_row(hit, words)
    return {
        "n_words": n_words,
        "word_chars": per_row(letters & blank, bounds),
        "n_symbols": per_row(symbols, bounds),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
    }


def ratios(texts: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    """Ratio of the whole text, its verdict, and chunks and bytes outside their band."""
    data, bounds = text_bytes(texts)
    compressor = zstandard.ZstdCompressor(level=limits.level, write_checksum=False)
    sizes = np.diff(bounds)
    whole = np.zeros(len(sizes))
    n_chunks = -(-sizes // limits.chunk_bytes)
    chunk_row = np.repeat(np.arange(len(sizes)), n_chunks)
    chunk_sizes, chunk_ratios = np.zeros(len(chunk_row), np.int64), np.zeros(len(chunk_row))
    at, view = 0, memoryview(np.ascontiguousarray(data))
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if a == b:
            continue
        whole[i] = (b - a) / len(compressor.compress(view[a:b]))
        if b - a <= limits.chunk_bytes:
            chunk_sizes[at], chunk_ratios[at] = b - a, whole[i]
            at += 1
            continue
        for c in range(a, b, limits.chunk_bytes):
            d = min(c + limits.chunk_bytes, b)
            chunk_sizes[at], chunk_ratios[at] = d - c, (d - c) / len(compressor.compress(view[c:d]))
            at += 1
    bad = ~_within(chunk_sizes, chunk_ratios, limits.chunk)
    bad_bytes = np.bincount(chunk_row, weights=bad * chunk_sizes, minlength=len(sizes)).astype(np.int64)
    return {
        "n_bytes": sizes,
        "ratio": whole,
        "n_chunks": n_chunks,
        "n_bad_chunks": np.bincount(chunk_row, weights=bad, minlength=len(sizes)).astype(np.int64),
        "in_band": _within(sizes, whole, limits.whole) & (100 * bad_bytes <= limits.max_bad_percent * sizes),
    }


def compression_bands(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts, ratios and verdict of every row of ``docs`` (doc_id, text; other columns unused).

    One output row per input row, repeated rows included. A null or empty text has no words, a
    ratio of 0 and fails the base rules. Texts are compressed whole, whatever their length; memory
    per task is a slice of a few MB or one text.
    """

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(1)
            counts, found = word_counts(texts), ratios(texts, limits)
            n = counts["n_words"]
            failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
            columns = counts | {"base_failed": failed, "kept": ~failed & found["in_band"]} | found
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, columns.values())], names=["doc_id", *columns]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return spread(docs.select("doc_id", "text")).mapInArrow(
        rate,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, n_bytes long, ratio double, "
        "n_chunks long, n_bad_chunks long, in_band boolean",
    )
