"""Token ids of whole texts by a vocabulary file of the tokenizers library.

Texts repeat their words, so the library encodes each distinct piece once per task and the ids of
a text are gathered from the pieces. A text is cut into pieces only where the result is the same
as for the whole text: at blanks, and between ASCII letters (or Latin-1 letters), digits and
punctuation. No cut is made next to an apostrophe, a control character or any other character,
whose pieces go through the whole tokenizer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from stratawell.llm.words import codes_of, lower_ascii, span_strings, text_bytes, word_spans

LETTER, DIGIT, PUNCT, GLUE = 1, 2, 3, 4


def _classes() -> np.ndarray:
    kind = np.full(256, GLUE, np.uint8)
    kind[0x21:0x7F] = PUNCT
    kind[0x30:0x3A] = DIGIT
    kind[0x41:0x5B] = kind[0x61:0x7B] = LETTER
    kind[0x27] = GLUE
    return kind


CLASS = _classes()
PLAIN = frozenset(range(0x21, 0x7F)) - {0x27}


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return [table[b] for b in range(256)]


class PieceTokenizer:
    """Encodes columns of texts; the same ids as ``Tokenizer.encode`` on each whole text.

    The vocabulary must lower-case, drop white space and end its words, as word-level BPE files do.
    ``literal_specials`` treats the strings of special tokens as ordinary text.
    ``cache_pieces`` bounds the memory of a task; a full cache is emptied.
    """

    def __init__(self, path: str, literal_specials: bool = False, cache_pieces: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal_specials
        self.specials = [] if literal_specials else [
            t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.letters = _byte_letters()
        self.cache_pieces = cache_pieces
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    def _encode_piece(self, piece: bytes) -> list[int]:
        latin = piece.isascii()
        text = piece.decode("utf-8", "replace")
        if latin and PLAIN.issuperset(piece):
            return [t.id for t in self.tokenizer.model.tokenize(text)]
        if not latin and text.isalpha() and max(text) <= "\xff" and "\xaa" not in text and "\xba" not in text and "\xb5" not in text:
            spelled = "".join(self.letters[b] for b in text.lower().encode())
            return [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _remember(self, piece: bytes) -> int:
        ids, at = self._encode_piece(piece), len(self.known)
        self.known[piece] = at
        if at >= len(self.first):
            self.first, self.count = np.resize(self.first, 2 * at), np.resize(self.count, 2 * at)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[at], self.count[at] = self.used, len(ids)
        self.used += len(ids)
        return at

    def _pieces(self, data: np.ndarray, bounds: np.ndarray):
        kind = CLASS[data]
        latin = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
        kind[latin] = kind[latin + 1] = LETTER
        starts, ends, _ = word_spans(data, bounds)
        if not len(starts):
            return starts, ends, data
        left, right = kind[:-1], kind[1:]
        cut = (left != GLUE) & (right != GLUE) & ((left != right) | (left == DIGIT))
        whole = np.zeros(len(data) + 1, np.int8)
        whole[starts] += 1
        whole[ends] -= 1
        inside = np.cumsum(whole[:-1], dtype=np.int8).astype(bool)
        begins = whole[:-1] == 1
        begins[starts] = True
        cut &= inside[:-1] & inside[1:] & ~begins[1:]
        more = np.flatnonzero(cut) + 1
        starts, ends = np.sort(np.concatenate([starts, more])), np.sort(np.concatenate([ends, more]))
        # Case is folded here only in pieces where it cannot change how characters compose.
        rare = np.concatenate([[0], np.cumsum(kind == GLUE)])
        plain = rare[ends] == rare[starts]
        folded = lower_ascii(data)
        for a, b in zip(starts[~plain].tolist(), ends[~plain].tolist()):
            folded[a:b] = data[a:b]
        return starts, ends, folded

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the bounds of each text in it."""
        data, bounds = text_bytes(texts)
        starts, ends, folded = self._pieces(data, bounds)
        codes, pieces = codes_of(span_strings(folded, starts, ends))
        if len(self.known) + len(pieces) > self.cache_pieces:
            self._forget()
        known, at = self.known, np.empty(len(pieces), np.int64)
        for i, piece in enumerate(pieces.to_pylist()):
            found = known.get(piece)
            at[i] = self._remember(piece) if found is None else found
        which = at[codes] if len(codes) else codes
        counts = self.count[which]
        total = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat(self.first[which] - total[:-1], counts) + np.arange(total[-1])
        ids, rows = self.flat[take], total[np.searchsorted(starts, bounds)]
        blob = data.tobytes() if self.specials else b""
        if any(s in blob for s in self.specials):
            return self._with_specials(blob, bounds, ids, rows)
        return ids, rows

    def _with_specials(self, blob: bytes, bounds: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        parts = []
        for i in range(len(bounds) - 1):
            text = blob[bounds[i] : bounds[i + 1]]
            if any(s in text for s in self.specials):
                whole = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
                parts.append(np.array(whole.ids, np.uint32))
            else:
                parts.append(ids[rows[i] : rows[i + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each followed by the end id."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


