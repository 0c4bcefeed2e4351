"""Burrows-Wheeler transform and common prefixes of a collection of strings, column by column.

Round r adds one symbol to every string, from its right end: all suffixes of r symbols enter the
sorted table at once. The table is two files, the symbols before the suffixes (the transform) and
the lengths of common prefixes of neighbours; each round reads them from front to back and writes
their successors. No suffix is ever compared with another.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np


class ColumnTable:
    """The two files of a round and those of the next; they hold one byte per suffix each.

    The four files stay open and are written over, for opening costs more than a short round.
    """

    def __init__(self, folder: str):
        names = ("symbols-0", "prefixes-0", "symbols-1", "prefixes-1")
        self.files = [open(os.path.join(folder, name), "w+b") for name in names]
        self.round = self.rows = 0

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for f in self.files[2 * (self.round % 2) :][:2]:
            f.seek(0)
            out.append(np.fromfile(f, np.uint8, self.rows))
        return out[0], out[1]

    def write(self, symbols: np.ndarray, prefixes: np.ndarray) -> None:
        self.round, self.rows = self.round + 1, len(symbols)
        for f, values in zip(self.files[2 * (self.round % 2) :], (symbols, prefixes)):
            f.seek(0)
            f.write(np.ascontiguousarray(values).data)
            f.flush()

    def close(self) -> None:
        for f in self.files:
            f.close()


def _merge(old: np.ndarray, at: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``new`` placed at the rows ``at`` (ascending, of the result) among the rows of ``old``."""
    out = np.empty(len(old) + len(new), old.dtype)
    free = np.ones(len(out), dtype=bool)
    free[at] = False
    out[at] = new
    out[free] = old
    return out


def transform(strings: list[bytes], cap: int = 200, folder: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, prefixes, dense alphabet) of the collection; prefixes are cut at ``cap`` (< 255).

    Rows are the suffixes of all strings in order; string j ends with an end mark that is smaller
    than any symbol and than the marks of later strings. Row i has the symbol before its suffix, 0
    for none, and the length of its common prefix with row i - 1.
    """
    m = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    alphabet, dense = np.unique(flat, return_inverse=True)
    if len(alphabet) > 254:
        raise ValueError("a collection may have 254 different bytes at most")
    dense = (dense + 1).astype(np.uint8)
    ends = np.cumsum(lengths)
    begins = ends - lengths

    def before(which: np.ndarray, size: int) -> np.ndarray:
        """The symbol before the suffix of ``size`` symbols."""
        at = ends[which] - size - 1
        ok = at >= begins[which]
        return np.where(ok, dense[np.where(ok, at, 0)] if len(dense) else 0, 0).astype(np.uint8)

    with tempfile.TemporaryDirectory(dir=folder) as own:
        table = ColumnTable(own)
        which, row = np.arange(m), np.arange(m)
        table.write(before(which, 0), np.zeros(m, np.uint8))
        for size in range(1, int(lengths.max(initial=0)) + 1):
            symbols, prefixes = table.read()
            live = lengths[which] >= size
            which, row = which[live], row[live]
            by_symbol = np.argsort(symbols, kind="stable")
            rank = np.empty(len(symbols), np.int64)
            rank[by_symbol] = np.arange(len(symbols))
            # The suffixes that begin with a symbol stand in the order of the rows that it precedes.
            finished = len(symbols) - np.count_nonzero(symbols)
            place = rank[row]
            new = place + m - finished
            order = np.argsort(place)
            which, row, place, new = which[order], row[order], place[order], new[order]
            symbol = symbols[row]

            def shared(first: np.ndarray, last: np.ndarray) -> np.ndarray:
                """1 + the least common prefix over rows first + 1 .. last, cut at the cap."""
                padded = np.append(prefixes, np.uint8(0))
                spans = np.empty(2 * len(first), np.int64)
                spans[0::2], spans[1::2] = first + 1, last + 1
                return np.minimum(np.minimum.reduceat(padded, spans)[0::2].astype(np.int64) + 1, cap)

            above = by_symbol[np.maximum(place - 1, 0)]
            has_above = (place > 0) & (symbols[above] == symbol)
            value = np.zeros(len(new), np.uint8)
            if has_above.any():
                # By row, so that the stretches between the asked ones add up to one pass at most.
                turn = np.flatnonzero(has_above)[np.argsort(row[has_above])]
                value[turn] = shared(above[turn], row[turn])
            below = by_symbol[np.minimum(place + 1, len(symbols) - 1)]
            known = np.ones(len(place), dtype=bool)
            known[:-1] = place[1:] != place[:-1] + 1
            has_below = (place + 1 < len(symbols)) & (symbols[below] == symbol) & known
            grown = _merge(prefixes, new, value)
            if has_below.any():
                turn = np.flatnonzero(has_below)[np.argsort(row[has_below])]
                grown[new[turn] + 1] = shared(row[turn], below[turn])
            table.write(_merge(symbols, new, before(which, size)), grown)
            row = new
        symbols, prefixes = table.read()
        table.close()
    return symbols, prefixes, alphabet


def repeated_starts(strings: list[bytes], least: int = 200, folder: str | None = None) -> list[np.ndarray]:
    """For each string, the offsets where a substring of ``least`` bytes starts that starts
    elsewhere too, in this string or another one."""
    m = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    symbols, prefixes, _ = transform(strings, least, folder)
    twice = prefixes >= least
    twice[:-1] |= prefixes[1:] >= least
    by_symbol = np.argsort(symbols, kind="stable")
    rank = np.empty(len(symbols), np.int64)
    rank[by_symbol] = np.arange(len(symbols))
    rank += m - (len(symbols) - np.count_nonzero(symbols))
    found = np.zeros((m, max(int(lengths.max(initial=0)) - least + 1, 0)), dtype=bool)
    which, row = np.arange(m), np.arange(m)
    # From the end marks, each step goes to the suffix that is one symbol longer.
    for size in range(1, int(lengths.max(initial=0)) + 1):
        live = lengths[which] >= size
        which, row = which[live], rank[row[live]]
        if size >= least:
            found[which, lengths[which] - size] = twice[row]
    return [np.flatnonzero(found[j]) for j in range(m)]
