"""Toxicity of texts after undoing disguised spelling.

A word that may be disguised (digits and signs for letters, letters set apart, letters repeated)
is a lattice: every character may stand for several letters, for a separator or for a repetition.
A trigram model of letters, counted over all documents, and the costs of the channel give each
path a probability; Viterbi decoding takes the best. Words that are typical of toxic texts, counted
in labelled texts after the same treatment, then decide the score.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from stratawell.llm.words import codes_of, lower_ascii, slices, span_strings, text_bytes, word_spans
from stratawell.session import materialize, spread

# What a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
SEPARATORS = " .-_*~"
# Costs of the channel, in nats.
SIGN_COST, APART_COST, REPEAT_COST, KEEP_TWO_COST = 1.0, 0.4, 0.3, 1.2
EDGE_COST = 0.4  # of a separator that ends a word
TWICE_COST = 3.0  # of a letter doubled in disguise, where a text is changed: most doubled letters are meant
LETTERS = "abcdefghijklmnopqrstuvwxyz"
EDGE, OTHER, SYMBOLS = 0, 27, 28  # word edge, a-z as 1..26, any other letter

PREFIX = 5  # letters of the prefixes that count as features beside whole words
# Unbroken tokens with more runs of one character than this are encoded keys if their cheapest path
# costs more a run than letters drawn evenly.
LONG_RUNS, KEY_COST = 24, math.log(27)

_WORD = regex.compile(r"\p{L}+")
_EDGES = " \t.,;:!?\"'()[]{}*#%&<>/\\-_~=^`"
_STRIPPED = _EDGES + "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_SIGNS = regex.escape("".join(STANDS_FOR), special_only=True)
# Pieces of letters, signs and separators; those with a sign, a separator inside or a doubled letter may be disguised.
_PIECE = regex.compile(rf"[\p{{L}}{_SIGNS}.\-_*~\s]{{3,}}")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_HINT = regex.compile(rf"[{_SIGNS}]|\p{{L}}[.\-_*~\s]+\p{{L}}|(\p{{L}})\1", regex.IGNORECASE)
_BLANKS = re.compile(r"\s+")
# A link, or a mailbox or host name with a path: its parts are looked at one by one, since their separators are meant.
_ADDRESS = regex.compile(r"://|(?:@|^www\.)[^\s/@]*\.\p{L}{2,}/")
_PART = regex.compile(rf"[\p{{L}}{regex.escape(''.join(c for c in STANDS_FOR if c != '@'), special_only=True)}]{{3,}}")
_SEPARATOR = re.compile(r"[ .\-_*~]+")
INSIDE = range(4, 16)  # letters of typical words that are looked for anywhere in letters set apart


def disguises(token: str) -> list[tuple[int, int, str]]:
    """Start, end and text of the parts of a token that may be disguised words; other signs part them."""
    found = []
    for piece in (_PART if _ADDRESS.search(token) else _PIECE).finditer(token):
        core = piece.group().strip(_STRIPPED)
        if not _HINT.search(core):
            continue
        letters = sum(c.isalpha() for c in core)
        if letters >= 2 and 2 * letters >= sum(c in STANDS_FOR for c in core):
            at = piece.start() + piece.group().index(core)
            found.append((at, at + len(core), _BLANKS.sub(" ", core)))
    return found


def _symbol(c: str) -> int:
    at = ord(c) - 96
    return at if 1 <= at <= 26 else OTHER


@dataclass
class LetterModel:
    """Negative log probabilities of a letter after two others; the edge of a word is a letter."""

    cost: np.ndarray
    memo: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        self.flat = self.cost.ravel().tolist()

    def restore(self, shown: str) -> str:
        """The likeliest plain spelling of a disguised word, or of several set apart."""
        found = self.memo.get(shown)
        if found is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            found = self._restored(shown)
            if len(shown) <= 100:
                self.memo[shown] = found
        return found

    def _restored(self, shown: str) -> str:
        plain = shown.lower()
        if _SEPARATOR.search(plain):
            return self._cheapest(plain, True, TWICE_COST)[1]
        runs = sum(x != y for x, y in zip(plain, plain[1:])) + 1
        spent, text = self._cheapest(plain, twice=TWICE_COST)
        return shown if runs > LONG_RUNS and spent > KEY_COST * runs else text

    def keeps_doubled(self, plain: str, twice: float = REPEAT_COST) -> bool:
        """Whether the best path of a word of letters, doubled ones among them, is the word itself.

        Pairs with a letter between them are independent; pairs side by side and longer runs are
        left to the lattice.
        """
        cost, last = self.flat, -1
        for found in _DOUBLED.finditer(plain):
            i, j = found.span()
            if i == last or plain[j : j + 1] == plain[i]:
                return False
            a = _symbol(plain[i - 1]) if i else EDGE
            b, c = _symbol(plain[i]), _symbol(plain[j]) if j < len(plain) else EDGE
            row = (a * SYMBOLS + b) * SYMBOLS
            if cost[row + b] + cost[(b * SYMBOLS + b) * SYMBOLS + c] >= twice + cost[row + c]:
                return False
            last = j
        return True

    def _decode(self, shown: str) -> str:
        return self._cheapest(shown)[1]

    def _cheapest(self, shown: str, split: bool = False, twice: float = REPEAT_COST) -> tuple[float, str]:
        """Cost and spelling of the best path; with ``split`` a separator may end a word and stay.

        ``twice`` is the cost of taking a doubled letter for one.
        """
        cost = self.flat
        # Runs of one character: (character, length).
        runs: list[list] = []
        for c in shown:
            if runs and runs[-1][0] == c:
                runs[-1][1] += 1
            else:
                runs.append([c, 1])
        # State: the last two symbols; value: cost and the spelling so far, without what all share.
        beam: dict[tuple[int, int], tuple[float, str]] = {(EDGE, EDGE): (0.0, "")}
        shared: list[str] = []
        for c, n in runs:
            choices: list[tuple[float, str]] = []
            if c.isalpha():
                choices.append((twice if n == 2 else (n - 1) * REPEAT_COST, c))
                if n >= 2:
                    choices.append(((n - 2) * REPEAT_COST + (KEEP_TWO_COST if n > 2 else 0.0), c + c))
            else:
                for letter in STANDS_FOR.get(c, ""):
                    choices.append((SIGN_COST + (n - 1) * REPEAT_COST, letter))
                    if n >= 2:
                        choices.append((2 * SIGN_COST + (n - 2) * REPEAT_COST, letter * 2))
                if c in SEPARATORS or not choices:
                    choices.append((APART_COST, ""))
            grown: dict[tuple[int, int], tuple[float, str]] = {}
            for (x, y), (spent, text) in beam.items():
                for extra, letters in choices:
                    a, b, total = x, y, spent + extra
                    for letter in letters:
                        s = _symbol(letter)
                        total += cost[(a * SYMBOLS + b) * SYMBOLS + s]
                        a, b = b, s
                    known = grown.get((a, b))
                    if known is None or (total, text + letters) < known:
                        grown[(a, b)] = (total, text + letters)
                if split and c in SEPARATORS:
                    ended = (spent + EDGE_COST + (cost[(x * SYMBOLS + y) * SYMBOLS + EDGE] if y != EDGE else 0.0), text + c * n)
                    known = grown.get((EDGE, EDGE))
                    if known is None or ended < known:
                        grown[(EDGE, EDGE)] = ended
            beam = grown
            if len(next(iter(beam.values()))[1]) > 200:
                start = os.path.commonprefix([text for _, text in beam.values()])
                shared.append(start)
                beam = {at: (spent, text[len(start) :]) for at, (spent, text) in beam.items()}
        spent, text = min((spent + cost[(x * SYMBOLS + y) * SYMBOLS + EDGE] * (y != EDGE or not split), text) for (x, y), (spent, text) in beam.items())
        return spent, "".join(shared) + text


_DROPPED = 255
_SYMBOL_OF = np.zeros(256, np.uint8)
_SYMBOL_OF[np.frombuffer(LETTERS.encode(), np.uint8)] = np.arange(1, 27)
_SYMBOL_OF[np.frombuffer(LETTERS.upper().encode(), np.uint8)] = np.arange(1, 27)
_SYMBOL_OF[0x80:0xC0] = _DROPPED  # only the first byte of other characters counts
_SYMBOL_OF[0xC0:0xF5] = OTHER


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Trigrams of symbols in the words of some texts; a word has two edges before it and one after."""
    rows = texts.cast(pa.large_binary()).to_pylist()
    seen = _SYMBOL_OF[np.frombuffer(b" ".join([b" ", *(row or b"" for row in rows)]), np.uint8)]
    seen = seen[seen != _DROPPED].astype(np.int16)
    # The symbol before an edge does not matter: blanks in a row are one edge.
    first = seen[:-2] * (seen[1:-1] != EDGE)
    counts = np.bincount((first * SYMBOLS + seen[1:-1]) * SYMBOLS + seen[2:], minlength=SYMBOLS**3)
    counts[0] = 0  # edges only
    return counts


def fit_letters(docs: DataFrame, smoothing: float = 0.1) -> LetterModel:
    """Trigram costs of the letters within words, counted over all texts of ``docs``."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for part in slices(batches, budget=1 << 20):
            total += trigram_counts(part.column(0))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    summed = spread(docs.select("text")).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.full(SYMBOLS**3, smoothing)
    for row in summed.collect():  # at most SYMBOLS ** 3 cells
        counts[row["cell"]] += row["n"]
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pairs = counts.sum(axis=0)
    backed = 0.9 * counts / counts.sum(axis=2, keepdims=True) + 0.1 * (pairs / pairs.sum(axis=1, keepdims=True))[None]
    return LetterModel(-np.log(backed))


def token_features(token: str, letters: LetterModel, wanted: dict[str, float] | None = None) -> tuple[tuple[str, ...], bool]:
    """Words of a token and their prefixes, restored ones too; whether anything was restored.

    Letters set apart may be several words whose edges nothing shows, so ``wanted`` words of
    ``INSIDE`` letters are also found where the letter model sets other edges.
    """
    plain = token.strip(_EDGES).lower()
    if plain.isalpha() and (not _DOUBLED.search(plain) or letters.keeps_doubled(plain)):  # most tokens
        return ((plain, plain[:PREFIX] + "*") if len(plain) > PREFIX else (plain,)), False
    if plain.isalpha() and letters.keeps_doubled(plain, TWICE_COST):  # perhaps disguised, but not surely
        return tuple({w: 0 for x in (plain, letters._decode(plain)) for w in (x, x[:PREFIX] + "*" if len(x) > PREFIX else x)}), False
    words = set(_WORD.findall(token.lower()))
    restored = False
    for _, _, core in disguises(token):
        core = core.lower()
        plain = letters.restore(core)
        if plain != core:
            restored = True
            words.update(_WORD.findall(plain))
        if _DOUBLED.search(core) or _SEPARATOR.search(core):  # as one word without doubled letters too
            joined = letters._decode(core)
            words.update(_WORD.findall(joined))
            if wanted and all(len(x) == 1 for x in _SEPARATOR.split(core)):
                words.update(w for i in range(len(joined)) for n in INSIDE if (w := joined[i : i + n]) in wanted)
    return (*words, *{w[:PREFIX] + "*" for w in words if len(w) > PREFIX}), restored


_LETTER_BYTES = np.zeros(256, dtype=bool)
_LETTER_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class FeatureReader:
    """Features of columns of texts; each distinct token is looked at once per task."""

    def __init__(self, letters: LetterModel, wanted: dict[str, float] | None = None, cache: int = 400_000):
        self.letters, self.wanted, self.cache = letters, wanted, cache
        self.known: dict[bytes, tuple[tuple[str, ...], bool]] = {}

    def _look(self, token: bytes) -> tuple[tuple[str, ...], bool]:
        names, restored = token_features(token.decode("utf-8", "replace"), self.letters, self.wanted)
        if self.wanted is not None:
            names = tuple(n for n in names if n in self.wanted)
        return names, restored

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Distinct (row, feature) pairs, ordered by row; the features' names; words restored per row."""
        data, bounds = text_bytes(texts)
        starts, ends, words = word_spans(data, bounds)
        codes, tokens = codes_of(span_strings(data, starts, ends))
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(words))
        if len(self.known) > self.cache:
            self.known.clear()
        number: dict[str, int] = {}
        lists, restored = [], np.zeros(len(tokens), dtype=bool)
        for i, token in enumerate(tokens.to_pylist()):
            found = self.known.get(token)
            if found is None:
                found = self.known[token] = self._look(token)
            lists.append([number.setdefault(n, len(number)) for n in found[0]] if found[0] else found[0])
            restored[i] = found[1]
        counts = np.array([len(x) for x in lists], np.int64)
        flat = np.array([x for found in lists for x in found], np.int64)
        begins = np.cumsum(counts) - counts
        # Only tokens with features are unfolded.
        some = np.flatnonzero(counts[codes]) if len(codes) else codes
        n = counts[codes[some]]
        ends_at = np.cumsum(n)
        take = np.repeat(begins[codes[some]] - (ends_at - n), n) + np.arange(int(ends_at[-1]) if len(n) else 0)
        rows, features = np.repeat(row[some], n), flat[take] if len(flat) else take
        n_restored = np.bincount(row[restored[codes]], minlength=len(bounds) - 1) if len(codes) else np.zeros(len(bounds) - 1, np.int64)
        extra = list(self._apart(data, starts, ends, row))
        for at, text in extra:
            names, changed = token_features(text, self.letters, self.wanted)
            n_restored[at] += changed
            names = [n for n in names if self.wanted is None or n in self.wanted]
            rows = np.append(rows, np.full(len(names), at))
            features = np.append(features, np.array([number.setdefault(n, len(number)) for n in names], np.int64))
        pairs = np.unique(rows * max(len(number), 1) + features)
        return pairs // max(len(number), 1), pairs % max(len(number), 1), list(number), n_restored

    def _apart(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, str]]:
        """Runs of three or more code points with any blanks between them, and punctuation at most."""
        if not len(starts):
            return
        size, letter, head = ends - starts, _LETTER_BYTES, data[starts]
        wide = 1 + (head >= 0xC0) + (head >= 0xE0) + (head >= 0xF0)  # bytes of the first code point
        after = data[np.minimum(starts + wide, len(data) - 1)]
        single = (size == wide) | ((size > wide) & (size <= wide + 2) & ~letter[after] & ~letter[data[ends - 1]])
        joined = single[:-1] & single[1:] & (row[1:] == row[:-1])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], joined.astype(np.int8), [0]])))
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if 2 <= last - first:
                yield int(row[first]), data[starts[first] : ends[last]].tobytes().decode("utf-8", "replace")


_TOKEN = regex.compile(r"(?<!\S)(?:\S[^\s\p{L}\p{N}]{0,2}\s++){2,}\S(?![\p{L}\p{N}])|\S+")


def deobfuscate(docs: DataFrame, letters: LetterModel) -> DataFrame:
    """doc_id and the text with disguised words replaced by what they stand for; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(letters)  # SYMBOLS ** 3 numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value

        def plain(match) -> str:
            token, out, at = match.group(), [], 0
            for start, end, core in disguises(token):
                found = model.restore(core)
                if found != core.lower():
                    out += [token[at:start], found]
                    at = end
            return "".join([*out, token[at:]])

        for part in slices(batches, budget=2 << 20):
            texts = [None if t is None else _TOKEN.sub(plain, t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = dict(docs.dtypes)["doc_id"]
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, text string")


@dataclass(frozen=True)
class ToxicityModel:
    letters: LetterModel
    weights: dict[str, float]
    slope: float
    offset: float

    def evidence(self, rows: np.ndarray, features: np.ndarray, names: list[str], n_rows: int) -> np.ndarray:
        """log(1 + sum of the weights of the features of each row)."""
        weight = np.array([self.weights.get(n, 0.0) for n in names])
        total = np.bincount(rows, weights=weight[features], minlength=n_rows) if len(rows) else np.zeros(n_rows)
        return np.log1p(np.round(total, 6))

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * evidence, -30, 30)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, letters: LetterModel, sample: int = 40_000, max_words: int = 2000, least_gain: float = 20.0
) -> ToxicityModel:
    """Fit on the texts of ``docs`` whose doc_id is in ``labels`` (doc_id, toxic).

    ``sample`` bounds the labelled ids that are used: about so many, taken by a hash of the id. A
    word is typical if the log-likelihood ratio of its counts is over ``least_gain`` and it is more
    frequent in toxic texts; the ``max_words`` best are kept. An id that is labelled more than once
    is toxic if one of its labels says so. Without labels, or with one kind only, every score is
    the share of toxic labels (0.5 if there are none).
    """
    spark = docs.sparkSession
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(draw < sample / max(n_known, 1))
    shared = spark.sparkContext.broadcast(letters)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = FeatureReader(shared.value), {}
        for part in slices(batches, budget=2 << 20):
            toxic = pc.fill_null(pc.greater(part.column(1), 0), False).to_numpy(zero_copy_only=False).astype(np.int64)
            rows, features, names, _ = reader.read(part.column(0))
            both = np.bincount(2 * features + toxic[rows], minlength=2 * len(names)).reshape(-1, 2) if len(names) else []
            for name, (n0, n1) in [*zip(names, both), ("", (len(toxic) - toxic.sum(), toxic.sum()))]:  # "" counts texts
                tally = seen.setdefault(name, [0, 0])
                tally[0] += int(n0)
                tally[1] += int(n1)
            if len(seen) > 300_000:
                yield _tallies(seen)
                seen = {}
        yield _tallies(seen)

    # The sample is bounded, so it is sent to where the texts are.
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    tallies = labelled.mapInArrow(count, "word string, n0 long, n1 long").groupBy("word")
    # Written once, for it is read twice; one row per word of the sample.
    counts = materialize(tallies.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    whole = counts.where("word = ''").first()
    n0, n1 = (whole["n0"], whole["n1"]) if whole else (0, 0)
    if not n0 or not n1:
        share = (n1 + 0.5) / (n0 + n1 + 1)
        return ToxicityModel(letters, {}, 0.0, math.log(share / (1 - share)))
    a, b = F.col("n1"), F.col("n0")

    def gain(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    both = a + b
    ratio = 2 * (gain(a, both * (n1 / (n0 + n1))) + gain(b, both * (n0 / (n0 + n1))))
    typical = counts.where(f"word <> '' AND n1 * {n0} > n0 * {n1}").withColumn("gain", ratio).where(F.col("gain") > least_gain)
    best = typical.orderBy(F.desc("gain"), "word").limit(max_words).collect()
    weights = {r["word"]: math.log((r["n1"] + 0.5) / (n1 + 1)) - math.log((r["n0"] + 0.5) / (n0 + 1)) for r in best}
    draft = ToxicityModel(letters, weights, 1.0, 0.0)
    held = spark.sparkContext.broadcast(draft)

    def bins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        reader = FeatureReader(model.letters, model.weights)
        for part in slices(batches, budget=2 << 20):
            rows, features, names, _ = reader.read(part.column(0))
            x = model.evidence(rows, features, names, part.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.round(x, 1)), part.column(1)], names=["x", "toxic"])

    toxic_kind = dict(labels.dtypes)["toxic"]
    binned = labelled.mapInArrow(bins, f"x double, toxic {toxic_kind}").groupBy("x").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("k")
    )
    rows = binned.collect()  # tenths of log(1 + sum of at most max_words weights)
    slope, offset = _logistic(np.array([r["x"] for r in rows]), np.array([r["n"] for r in rows]), np.array([r["k"] for r in rows]))
    return ToxicityModel(letters, weights, slope, offset)


def _tallies(seen: dict[str, list[int]]) -> pa.RecordBatch:
    counts = list(seen.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64())],
        names=["word", "n0", "n1"],
    )


def _logistic(x: np.ndarray, n: np.ndarray, k: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Slope and offset of a logistic curve through k of n at x, by Newton steps."""
    basis, beta = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(basis @ beta, -30, 30)))
        slope = basis.T @ (k - n * p) - ridge * beta
        curve = (basis * (n * p * (1 - p))[:, None]).T @ basis + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted, n_restored, toxic_words of every row of ``docs`` (doc_id, text).

    A null or empty text has the score of a text without typical words. Only the text is used.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = FeatureReader(model.letters, model.weights)
        for part in slices(batches):
            n = part.num_rows
            rows, features, names, restored = reader.read(part.column(1))
            scores = model.scores(model.evidence(rows, features, names, n))
            hits = pa.array(names, pa.string()).take(pa.array(features))
            bounds = np.searchsorted(rows, np.arange(n + 1))
            typical = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), hits)
            found = pa.array(scores >= threshold).cast(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(scores), found, pa.array(restored), typical],
                names=["doc_id", "score", "predicted", "n_restored", "toxic_words"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return spread(docs.select("doc_id", "text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, n_restored long, toxic_words array<string>"
    )
