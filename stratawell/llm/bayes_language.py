"""Language identification: multinomial naive Bayes over hashed character n-grams.

The counts come from a bounded sample of labelled texts; the matrix of log probabilities
(buckets x languages) is broadcast, and batches are scored with sparse sums in numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratawell.llm.words import slices
from stratawell.session import spread

UNKNOWN = "und"
BLANK = 0x20
PIECE = 1 << 18  # characters worked on at once, for up to eight languages
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # float32, buckets x languages
    orders: tuple[int, ...]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _pieces(
    texts: list[str | None], orders: tuple[int, ...], n_langs: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """First row, characters, row bounds and number of characters of bounded stretches of the texts.

    Lower-case letters are code points, every other character is one blank. Each row gets a blank on
    either side, so that n-grams see the edges of words. A row longer than a piece comes in several;
    what a piece has beyond its number of characters only completes its last n-grams.
    """
    size = max(PIECE * 8 // max(n_langs, 8), 1 << 12)
    waiting: list[str] = []
    first = held = 0

    def coded(rows: list[str], owned: int) -> tuple[int, np.ndarray, np.ndarray, int]:
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in rows])]).astype(np.int64)
        flat = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)
        return first, np.where(_letters()[flat], flat, np.uint32(BLANK)), bounds, owned

    for i, text in enumerate(texts):
        text = f" {(text or '').lower()} "
        if waiting and held + len(text) > size:
            yield coded(waiting, held)
            waiting, held = [], 0
        if not waiting:
            first = i
        if len(text) <= size:
            waiting.append(text)
            held += len(text)
            continue
        for begin in range(0, len(text), size):
            yield coded([text[begin : begin + size + max(orders) - 1]], min(size, len(text) - begin))
    if waiting:
        yield coded(waiting, held)


def _grams(chars: np.ndarray, bounds: np.ndarray, owned: int, orders: tuple[int, ...], buckets: int):
    """Bucket and row of every n-gram that holds a letter, lies within one row and begins before ``owned``."""
    letter = chars != BLANK
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    code, held = chars.astype(np.uint64), letter.copy()
    for n in range(1, max(orders) + 1):
        if n > 1:
            size = len(chars) - n + 1
            if size <= 0:
                return
            code = code[:size] * np.uint64(0x100000001B3) + chars[n - 1 :]
            held = held[:size] | letter[n - 1 :]
        if n in orders:
            at = np.flatnonzero((held & (row[: len(code)] == row[n - 1 :]))[:owned])
            mixed = (code[at] ^ (code[at] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
            yield (mixed >> np.uint64(40)).astype(np.int64) % buckets, row[at]


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(
    labelled: DataFrame, orders: tuple[int, ...] = (1, 2, 3), buckets: int = 1 << 16,
    per_language: int = 3000, smoothing: float = 0.5, max_languages: int = 256,
) -> LanguageModel:
    """Fit on (doc_id, text, lang); rows with a null in lang or text teach nothing.

    ``per_language`` bounds the sample: of each language, about so many rows are taken by a hash
    of their id and text (all of them if there are fewer). ``max_languages`` bounds the matrix, which
    is broadcast: of more values of lang the most frequent are learnt, ties by name; the rest teach
    nothing. An empty table gives a model without languages, which answers ``und`` for every text.
    """
    spark = labelled.sparkSession
    known = labelled.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    frequent = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    sizes = {r["lang"]: r["n"] for r in frequent.collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageModel((), np.zeros((buckets, 0), np.float32), orders)
    share = spark.createDataFrame([(k, per_language / n) for k, n in sizes.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(share), "lang").where(draw < F.col("share")).select("lang", "text")
    index = {k: i for i, k in enumerate(languages)}
    cells = buckets * len(languages)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for part in slices(batches, budget=SLICE_BYTES):
            lang = np.array([index[x] for x in part.column(0).to_pylist()], np.int64)
            for first, chars, bounds, owned in _pieces(part.column(1).to_pylist(), orders, len(languages)):
                for bucket, row in _grams(chars, bounds, owned, orders, buckets):
                    cell, n = np.unique(bucket * len(languages) + lang[first + row], return_counts=True)
                    total[cell] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    counts = np.full(cells, smoothing)
    summed = sample.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = summed.toPandas()  # at most buckets x languages cells
    counts[got["cell"].to_numpy(np.int64)] += got["n"].to_numpy(np.float64)
    counts = counts.reshape(buckets, len(languages))
    return LanguageModel(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32), orders)


def score(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and posterior of each text.

    The posterior is tempered: log likelihoods are divided by the square root of the number of
    n-grams, since neighbouring n-grams are not independent. Ties go to the first language by name.
    """
    n_rows, n_langs = len(texts), len(model.languages)
    total, n_grams = np.zeros((n_rows, n_langs)), np.zeros(n_rows)
    for begin, chars, bounds, owned in _pieces(texts, model.orders, n_langs):
        for bucket, row in _grams(chars, bounds, owned, model.orders, len(model.weights)):
            if not len(row):
                continue
            # Rows of a sparse count matrix: entries are in row order, so each row is one stretch.
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            at = begin + row[first]
            total[at] += np.add.reduceat(model.weights[bucket], first, axis=0, dtype=np.float64)
            n_grams[at] += np.diff(np.concatenate([first, [len(row)]]))
    best = np.full(n_rows, -1)
    posterior = np.zeros(n_rows)
    if n_langs:
        scaled = total / np.sqrt(np.maximum(n_grams, 1))[:, None]
        likely = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        likely /= likely.sum(axis=1, keepdims=True)
        best = np.where(n_grams > 0, likely.argmax(axis=1), -1)
        posterior = np.where(n_grams > 0, likely.max(axis=1), 0.0)
    return [model.languages[i] if i >= 0 else UNKNOWN for i in best.tolist()], posterior


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``; only the text decides.

    A null text, or one without a letter, is ``und`` with score 0. Repeated rows are answered one
    by one. Texts are read whole; a task holds one slice of texts.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # buckets x languages floats, whatever the input

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, budget=SLICE_BYTES):
            names, posterior = score(part.column(1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(posterior)],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known with enough certainty.

    Only texts go to Python, and only verdicts come back.
    Rejected: null texts, texts without a letter, and posteriors below ``least``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def identified(text: pa.Array) -> pa.Array:
        out = [np.zeros(0, bool)]
        for part in slices([pa.RecordBatch.from_arrays([text], names=["text"])], budget=SLICE_BYTES):
            names, posterior = score(part.column(0).to_pylist(), shared.value)
            out.append((np.array(names, object) != UNKNOWN) & (posterior >= least))
        return pa.array(np.concatenate(out))

    return spread(docs).where(identified("text"))
