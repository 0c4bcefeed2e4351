"""Hard negatives by a branch-and-bound scan over vertically stored vectors.

Rows are stored in blocks, each dimension by itself with its least and greatest value. An anchor reads
a block's dimensions in descending order of its own magnitudes and keeps a bitmap of candidates: what
the unread dimensions can still add lies between sums of their extremes, and rows that can no longer
get among the best, or into a window of scores, leave the bitmap. Scores of the rest become exact when
the last dimension has been read.

The first scan finds an anchor's positives, the second, given their scores, its negatives.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratawell.session import materialize, spread

SCALE = 256
ANCHOR_EVERY, N_POSITIVES, N_NEGATIVES = 100, 5, 5
LEAST_PERCENT = 80  # of the positive's score
BLOCK_ROWS = 8192
BLOCK_BYTES = 8 << 20
ANCHOR_BYTES = 16 << 20  # of the vectors of one batch of anchors, which is broadcast
NO_ID = np.iinfo(np.int64).min  # stands for a null vec_id, the smallest

ROWS_DDL = "uid long, vec_id long, label long, vector array<long>"


# ---- rows that take part ---------------------------------------------------------------------------------


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers: floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def comparable_rows(embeddings: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label and integer vector of the rows that take part.

    Left out are rows with a null label or vector, with a null, NaN or infinite component, and those
    whose squared length reaches 2**62: their products with others need not fit 64 bits.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    length = F.aggregate(x, F.lit(0.0), lambda total, v: total + (v.cast("double") * scale) * (v.cast("double") * scale))
    known = embeddings.where(x.isNotNull() & label.isNotNull()).where(finite).where(length < float(2**62))
    return known.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), quantised(x, scale).alias("vector"))


# ---- blocks -----------------------------------------------------------------------------------------------


@dataclass
class Block:
    """Rows stored by dimension: ``columns`` is dimensions x rows."""

    uids: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def joined(parts: list[Block]) -> Block:
        if len(parts) == 1:
            return parts[0]
        return Block(
            *(np.concatenate([getattr(p, n) for p in parts]) for n in ("uids", "ids", "labels")),
            np.concatenate([p.columns for p in parts], axis=1),
            np.min([p.low for p in parts], axis=0), np.max([p.high for p in parts], axis=0),
        )


BLOCK_DDL = "dims int, n int, uids binary, ids binary, labels binary, columns array<binary>, low array<long>, high array<long>"


def _store(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, label, vector) as blocks; rows of different dimensions go to different blocks."""
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        vectors = batch.column(2)
        dims = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        starts = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
        ids = batch.column(0).fill_null(int(NO_ID)).to_numpy()
        labels = batch.column(1).to_numpy()
        for d in np.unique(dims).tolist():
            of = np.flatnonzero(dims == d)
            step = min(BLOCK_ROWS, max(1, BLOCK_BYTES // max(8 * d, 1)))
            for part in np.split(of, range(step, len(of), step)):
                columns = flat[starts[part][:, None] + np.arange(d)].T.reshape(d, len(part)).astype(np.int64)
                low, high = (f(axis=1) if d else np.zeros(0, np.int64) for f in (columns.min, columns.max))
                yield pa.RecordBatch.from_pylist([{
                    "dims": d, "n": len(part), "uids": (row + part).tobytes(), "ids": ids[part].tobytes(),
                    "labels": labels[part].tobytes(), "columns": [c.tobytes() for c in columns],
                    "low": low.tolist(), "high": high.tolist(),
                }], schema=pa.schema([
                    ("dims", pa.int32()), ("n", pa.int32()), ("uids", pa.binary()), ("ids", pa.binary()), ("labels", pa.binary()),
                    ("columns", pa.list_(pa.binary())), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())),
                ]))
        row += batch.num_rows


def _loaded(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    """Stored blocks; small ones of equal dimensions are put together."""
    waiting: dict[int, list[Block]] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            d, n = batch.column("dims")[i].as_py(), batch.column("n")[i].as_py()
            uids, ids, labels = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("uids", "ids", "labels"))
            columns = np.array([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("columns")[i].values]).reshape(d, n)
            low, high = (np.array(batch.column(c)[i].as_py(), np.int64) for c in ("low", "high"))
            parts = waiting.setdefault(d, [])
            parts.append(Block(uids, ids, labels, columns, low, high))
            total = sum(len(p.uids) for p in parts)
            if total >= BLOCK_ROWS or total * d * 8 >= BLOCK_BYTES:
                yield Block.joined(waiting.pop(d))
    for parts in waiting.values():
        yield Block.joined(parts)


def store_blocks(rows: DataFrame) -> DataFrame:
    return materialize(spread(rows).mapInArrow(_store, BLOCK_DDL))


# ---- the scan -----------------------------------------------------------------------------------------------


def narrowed(
    vector: np.ndarray, block: Block, alive: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``block`` that stay, and their exact products with ``vector``.

    ``alive`` is the bitmap to begin with; ``keep`` says from lower and upper bounds of the products
    which rows may still matter.
    """
    order = np.argsort(-np.abs(vector), kind="stable")
    v = vector[order]
    ends = v.astype(np.float64) * block.low[order], v.astype(np.float64) * block.high[order]
    # What the dimensions from k on add at least and at most; a little wider where doubles round.
    below = np.append(np.minimum(*ends)[::-1].cumsum()[::-1], 0.0)
    above = np.append(np.maximum(*ends)[::-1].cumsum()[::-1], 0.0)
    slack = float(np.maximum(*np.abs(ends)).sum()) * 1e-12
    at = np.flatnonzero(alive)
    columns = block.columns if len(at) > len(alive) // 2 else block.columns[:, at]
    if columns is block.columns:
        at = np.arange(len(alive))
    else:
        alive = np.ones(len(at), bool)
    partial = np.zeros(len(at), np.int64)
    checks = {len(v) * k // 8 for k in (2, 4, 5, 6, 7)}
    for k, d in enumerate(order.tolist()):
        if k in checks and len(at):
            alive = alive & keep(partial + (below[k] - slack), partial + (above[k] + slack))
            n = int(alive.sum())
            if 2 * n <= len(at):
                at, partial, columns = at[alive], partial[alive], columns[:, alive]
                alive = np.ones(n, bool)
        if v[k] == 0:
            break
        partial += v[k] * columns[d]
    return at[alive], partial[alive]


class Best:
    """The first few (score, id, uid) of each key: highest score, then smallest id."""

    def __init__(self, size: int):
        self.size = size
        self.kept: dict = {}

    def worst(self, key) -> float:
        """Scores below this one are of no use."""
        found = self.kept.get(key, ())
        return -found[-1][0] if len(found) == self.size else -np.inf

    def add(self, key, scores: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        if len(scores) > 4 * self.size:
            edge = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            few = scores >= edge
            scores, ids, uids = scores[few], ids[few], uids[few]
        first = np.lexsort((uids, ids, -scores))[: self.size]
        found = self.kept.setdefault(key, [])
        for i in first.tolist():
            insort(found, (-int(scores[i]), int(ids[i]), int(uids[i])))
        del found[self.size :]


def _fifth(values: np.ndarray, n: int) -> float:
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def find_positives(block: Block, i: int, uid: int, label: int, vector: np.ndarray, best: Best) -> None:
    """Add the block's best rows of the anchor's own label, itself left out."""
    alive = (block.labels == label) & (block.uids != uid)

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= best.worst(i)

    def keep_best(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= max(best.worst(i), _fifth(low, best.size))

    # Where the bitmap is not compacted, rows that have left it must not raise the bound.
    at, scores = narrowed(vector, block, alive, keep_best if 2 * alive.sum() <= len(alive) else keep)
    best.add(i, scores, block.ids[at], block.uids[at])


def windows_of(scores: list[int], percent: int) -> dict[int, int]:
    """Least score of the window of each positive score; a negative score has an empty window."""
    return {p: -(-percent * p // 100) for p in scores if p >= 0}


def find_negatives(block: Block, i: int, label: int, vector: np.ndarray, windows: dict[int, int], best: Best) -> None:
    """Add the block's best rows of other labels to the window of each positive score.

    Of several windows the lowest decides what may leave: its bound is the least of all, since rows
    that fill it and reach into another window count there too.
    """
    if not windows:
        return
    top, last = max(windows), min(windows)

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (low <= top) & (high >= max(windows[last], best.worst((i, last))))

    at, scores = narrowed(vector, block, block.labels != label, keep)
    for p, least in windows.items():
        inside = (scores <= p) & (scores >= max(least, best.worst((i, p))))
        if inside.any():
            best.add((i, p), scores[inside], block.ids[at[inside]], block.uids[at[inside]])


# ---- over all blocks ---------------------------------------------------------------------------------------------


def _anchor_rows(blocks: DataFrame, every: int) -> DataFrame:
    """(uid, vec_id, label, vector) of the rows whose vec_id is divisible by ``every``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _loaded(batches):
            at = np.flatnonzero((block.ids % every == 0) & (block.ids != NO_ID))
            vectors = [block.columns[:, k] for k in at.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.uids[at]), pa.array(block.ids[at]), pa.array(block.labels[at]), pa.array(vectors, pa.list_(pa.int64()))],
                names=["uid", "vec_id", "label", "vector"],
            )

    return blocks.mapInArrow(run, ROWS_DDL)


def _ranked(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mine(
    rows: DataFrame, every: int = ANCHOR_EVERY, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
    percent: int = LEAST_PERCENT, anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """Negatives of every anchor and positive of ``rows`` (vec_id, label, integer vector).

    Anchors come in batches of about ``anchor_bytes``; each batch is broadcast and all blocks are read
    by it twice, without a shuffle of vectors. A task sends the few best of each anchor at most. Rows
    of other dimensions than an anchor's are not compared with it. A null vec_id counts as the smallest
    and is no anchor. Rows that repeat an anchor's id are other rows, and anchors of their own. Without
    rows or anchors the result is empty.
    """
    spark = rows.sparkSession
    blocks = store_blocks(rows)
    anchors = materialize(_anchor_rows(spread(blocks), every))
    dims, n_anchors = blocks.agg(F.max("dims")).first()[0] or 0, anchors.count()
    per_batch = max(1, anchor_bytes // (8 * max(dims, 1) + 64))
    n_batches = max(1, -(-n_anchors // per_batch))
    names = ["anchor", "anchor_id", "positive_id", "positive_score", "slot", "score", "vec_id", "row"]
    kinds = "anchor long, anchor_id long, positive_id long, positive_score long, slot int, score long, vec_id long, row long"

    def table(cells: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*cells)) or [[] for _ in names]
        kind = {"slot": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array(c, kind.get(n, pa.int64())) for n, c in zip(names, columns)], names=names)

    out = None
    for k in range(n_batches):
        mine_only = anchors.where(F.pmod(F.xxhash64("uid"), F.lit(n_batches)) == k)
        batch = [(r.uid, r.vec_id, r.label, np.array(r.vector, np.int64)) for r in mine_only.collect()]
        shared = spark.sparkContext.broadcast(batch)

        def positives(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = Best(n_positives)
            for block in _loaded(batches):
                for i, (uid, _, label, vector) in enumerate(shared.value):
                    if len(vector) == len(block.columns):
                        find_positives(block, i, uid, label, vector, best)
            yield table([
                (shared.value[i][0], shared.value[i][1], None, None, 0, -s, a, u) for i, found in best.kept.items() for s, a, u in found
            ])

        found = _ranked(spread(blocks).mapInArrow(positives, kinds), ["anchor"], n_positives).select("anchor", "vec_id", "score", "rank")
        own: dict[int, list[tuple]] = {}
        for r in found.collect():  # a few per anchor of the batch
            own.setdefault(r.anchor, []).append((r.rank, r.vec_id, r.score))
        chosen = spark.sparkContext.broadcast(own)

        def negatives(batches: Iterable[pa.RecordBatch], shared=shared, chosen=chosen) -> Iterator[pa.RecordBatch]:
            best = Best(n_negatives)
            windows = [windows_of([s for _, _, s in chosen.value.get(a[0], ())], percent) for a in shared.value]
            for block in _loaded(batches):
                for i, (_, _, label, vector) in enumerate(shared.value):
                    if len(vector) == len(block.columns):
                        find_negatives(block, i, label, vector, windows[i], best)
            cells = []
            for i, (uid, vec_id, _, _) in enumerate(shared.value):
                for slot, positive, score in chosen.value.get(uid, ()):
                    cells += [(uid, vec_id, positive, score, slot, -s, a, u) for s, a, u in best.kept.get((i, score), ())]
            yield table(cells)

        part = materialize(_ranked(spread(blocks).mapInArrow(negatives, kinds), ["anchor", "slot"], n_negatives))
        out = part if out is None else out.unionByName(part)

    def named(column: str) -> Column:
        return F.nullif(F.col(column), F.lit(int(NO_ID)))

    return out.select(
        "anchor_id", named("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        named("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of ``embeddings`` (vec_id, label, embedding); see ``mine``.

    Rows whose vec_id is divisible by 7 move to the next of ten labels first: planted noise.
    """
    label, vec_id = F.col("label").cast("long"), F.col("vec_id").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(comparable_rows(embeddings, moved))
