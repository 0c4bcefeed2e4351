"""Removal of long substrings that start at two places or more, from sorted suffixes.

Only strings that can repeat are sorted. Every string of 200 bytes has a first least k-gram (by
hash), its anchor, which depends on the string alone, so equal strings have equal anchors wherever
they stand. Documents are cut into fragments, one per stretch of starts with the same anchor;
fragments of one k-gram form a group, and equal strings always meet in a group. Equal fragments
count once. Where a group has different fragments, each is cut by the distance of its starts from
the anchor, and pieces of one distance go on if another one shares the bytes that all their strings
have in common. The pieces of many groups form a collection whose Burrows-Wheeler transform and
common prefixes are built column by column.

A group of more fragments than one task should hold is dealt out by what its pieces have in common:
distance class and common bytes are a key of the shuffle, equal pieces count once, and a class that is
still too large is cut again into pieces of fewer distances, down to single strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratawell.llm.column_bwt import repeated_starts
from stratawell.llm.words import slices, text_bytes, unused
from stratawell.session import materialize, release, spread

LENGTH = 200
GRAM = 32  # a power of two
SLICE = 2 << 20
REACH = 43  # distances from the anchor that a piece spans
COLLECTION = 1500  # pieces sorted at a time
REACHES = (REACH, 8, 1)  # of the pieces that large groups are dealt out by
GROUP_LIMIT = 400  # different fragments of a group, or pieces of a class, that one task sorts together
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
PLACE_BITS = np.uint64(24)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(200).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Hashes:
    """64-bit hashes of any substring of some bytes, from running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        up = np.full(n + 1, BASE, np.uint64)
        up[0] = 1
        np.multiply.accumulate(up, out=up)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_byte_values()[data] * up[:n], dtype=np.uint64)])
        down = np.full(n + 1, INVERSE, np.uint64)
        down[0] = 1
        self.down = np.multiply.accumulate(down)

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        raw = (self.sums[last] - self.sums[first]) * self.down[first]
        return _mix(raw ^ _mix((last - first).astype(np.uint64)))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each stretch of ``width`` values."""
    got, have = values, 1
    while 2 * have <= width:
        got = np.minimum(got[: len(got) - have], got[have:])
        have *= 2
    return np.minimum(got[: len(got) - (width - have)], got[width - have :]) if have < width else got


def fragments(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The fragments of some documents laid end to end: group, content hash, row, first start
    within the row, number of starts, and the anchor's distance from the first start."""
    none = np.zeros(0, np.int64)
    empty = {"g": none, "f": none, "row": none, "first": none, "starts": none, "anchor": none}
    if len(data) < length:
        return empty
    grams = _Hashes(data)
    at = np.arange(len(data) - gram + 1)
    hashes = grams.of(at, at + gram)
    keys = ((hashes >> PLACE_BITS) << PLACE_BITS) | at.astype(np.uint64)
    least = _least(keys, length - gram + 1)
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + length <= bounds[row_of + 1])
    if not len(starts):
        return empty
    anchor, row = (least[starts] & np.uint64((1 << 24) - 1)).astype(np.int64), row_of[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    begin, end, at = starts[first], starts[last] + length, anchor[first]
    return {
        "g": hashes[at].view(np.int64), "f": grams.of(begin, end).view(np.int64), "row": row[first],
        "first": begin - bounds[row[first]], "starts": last - first + 1, "anchor": at - begin,
    }


def pieces(
    body: bytes, anchor: int, length: int = LENGTH, gram: int = GRAM, reach: int = REACH
) -> Iterator[tuple[int, bytes, int, bytes]]:
    """(distance class, bytes common to all its strings, first start, bytes) of a fragment."""
    last_start = len(body) - length
    for k, near in enumerate(range(0, length - gram + 1, reach)):
        far = min(near + reach - 1, length - gram)
        lo, hi = max(0, anchor - far), min(last_start, anchor - near)
        if lo <= hi:
            yield k, body[anchor - near : anchor - far + length], lo, body[lo : hi + length]


def _all_fragments(docs: DataFrame, length: int) -> DataFrame:
    """(id, mark, g, f, first, starts, anchor) of all documents; (id, mark) names a document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, budget=SLICE):
            data, bounds = text_bytes(part.column(2))
            # A text too long for one pass is cut; the pieces share all but one byte of a string.
            cuts = range(0, max(len(data), 1), 1 << 23) if part.num_rows == 1 else [0]
            for cut in cuts:
                if part.num_rows == 1:
                    piece = data[cut : cut + (1 << 23) + length - 1]
                    found = fragments(piece, np.array([0, len(piece)]), length)
                else:
                    found = fragments(data, bounds, length)
                take = pa.array(found.pop("row"))
                found["first"] = found["first"] + cut
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), *map(pa.array, found.values())],
                    names=["id", "mark", *found],
                )

    keyed = _keyed(docs.select("doc_id", "text")).select("id", "mark", "text")
    return keyed.mapInArrow(run, "id long, mark long, g long, f long, first long, starts long, anchor long")


def _keyed(docs: DataFrame) -> DataFrame:
    return spread(docs).select(
        "*", F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("id"), F.xxhash64("doc_id", "text").alias("mark")
    )


SPAN_DDL = "g long, f long, lo long, hi long"


class _Collection:
    """Pieces that wait to be sorted, and stretches (g, f, lo, hi) that are known to repeat."""

    def __init__(self, length: int):
        self.length = length
        self.done: list[tuple] = []
        self.waiting: list[tuple] = []

    def full(self) -> bool:
        return len(self.waiting) >= COLLECTION or len(self.done) >= 100 * COLLECTION

    def flush(self) -> pa.RecordBatch:
        """Sort what waits; pieces without a group are only compared with."""
        out, bodies = self.done, [w[3] for w in self.waiting]
        for (g, f, lo, _), at in zip(self.waiting, repeated_starts(bodies, self.length) if bodies else ()):
            if g is not None and len(at):
                breaks = np.flatnonzero(np.diff(at) > 1)
                for first, last in zip(at[np.append(0, breaks + 1)].tolist(), at[np.append(breaks, len(at) - 1)].tolist()):
                    out.append((g, f, lo + first, lo + last))
        self.done, self.waiting = [], []
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["g", "f", "lo", "hi"])


def _n_tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _sorted_groups(strings: DataFrame, length: int) -> DataFrame:
    """(g, f, lo, hi): stretches of starts that repeat, from whole groups of (g, f, copies, anchor, body)."""

    def look(group: list[tuple], to: _Collection) -> None:
        """Equal pieces are settled at once and count once in the collection."""
        classes: dict[tuple[int, bytes], dict[bytes, list]] = {}
        for g, f, copies, anchor, body in group:
            for k, core, lo, piece in pieces(body, anchor, length):
                classes.setdefault((k, core), {}).setdefault(piece, []).append((copies, g, f, lo))
        for found in classes.values():
            unsettled = False
            for piece, owners in found.items():
                if len(owners) > 1:
                    to.done += [(g, f, lo, lo + len(piece) - length) for copies, g, f, lo in owners if copies == 1]
                elif owners[0][0] == 1:
                    unsettled = True
            if unsettled and len(found) > 1:
                for piece, owners in found.items():
                    copies, g, f, lo = owners[0]
                    own = len(owners) == 1 and copies == 1
                    to.waiting.append((g, f, lo, piece) if own else (None, None, 0, piece))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, group = _Collection(length), []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if group and row[0] != group[0][0]:
                    look(group, to)
                    group = []
                    if to.full():
                        yield to.flush()
                group.append(row)
        look(group, to)
        yield to.flush()

    return strings.repartition(_n_tasks(strings), "g").sortWithinPartitions("g", "f").mapInArrow(run, SPAN_DDL)


def _sorted_classes(rows: DataFrame, length: int) -> DataFrame:
    """The same from classes (c, g, f, lo, body) of different pieces; those without g need no answer."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, last = _Collection(length), None
        for batch in batches:
            for c, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if c != last and to.full():
                    yield to.flush()
                last = c
                to.waiting.append(tuple(row))
        yield to.flush()

    return rows.repartition(_n_tasks(rows), "c").sortWithinPartitions("c").mapInArrow(run, SPAN_DDL)


def _dealt_out(strings: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """The same from groups too large for one task, of (g, f, copies, anchor, body), and what it reads.

    A class (c) is what pieces of one group and distance class have in common, p stands for the bytes
    of a piece. A piece with several owners repeats as a whole. The others are compared with the rest
    of their class, if it is of a size to sort, or else in finer pieces; of the finest, single strings,
    every class has one kind only.
    """
    spark = strings.sparkSession
    out, tables = spark.createDataFrame([], SPAN_DDL), []
    left = strings.select("g", "f", "copies", F.lit(0).cast("long").alias("lo"), "anchor", "body")
    for reach in REACHES:

        def cut(batches: Iterable[pa.RecordBatch], reach=reach) -> Iterator[pa.RecordBatch]:
            def made(rows: list[tuple]) -> pa.RecordBatch:
                kinds = (pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.binary())
                return pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(list(zip(*rows)) or [[]] * 8, kinds)],
                    names=["c", "p", "g", "f", "copies", "lo", "anchor", "body"],
                )

            rows = []
            for batch in batches:
                for g, f, copies, lo, anchor, body in zip(*(batch.column(i).to_pylist() for i in range(6))):
                    for k, core, at, piece in pieces(body, anchor, length, reach=reach):
                        c = hashlib.blake2b(b"%d %d " % (g, k) + core, digest_size=16).digest()
                        p = hashlib.blake2b(piece, digest_size=16).digest()
                        rows.append((c, p, g, f, copies, lo + at, anchor - at, piece))
                    if len(rows) >= 10 * COLLECTION:
                        yield made(rows)
                        rows = []
            yield made(rows)

        parts = materialize(
            left.mapInArrow(cut, "c binary, p binary, g long, f long, copies long, lo long, anchor long, body binary")
        )
        tables.append(parts)
        if parts.isEmpty():
            break
        kinds = materialize(
            parts.groupBy("c", "p").agg(
                F.count("*").alias("owners"), *[F.first(x).alias(x) for x in ("g", "f", "copies", "lo", "anchor", "body")]
            ).withColumn("open", (F.col("owners") == 1) & (F.col("copies") == 1))
        )
        tables.append(kinds)
        settled = kinds.where("owners > 1").select("c", "p")
        hi = F.col("lo") + F.octet_length("body") - length
        out = out.unionByName(parts.where("copies = 1").join(settled, ["c", "p"]).select("g", "f", "lo", hi.alias("hi")))
        sizes = kinds.groupBy("c").agg(F.count("*").alias("n"), F.count_if("open").alias("n_open")).where("n > 1 AND n_open > 0")
        sized = kinds.join(sizes, "c")
        asked = [F.when(F.col("open"), F.col(x)).alias(x) for x in ("g", "f")]
        few = sized.where(F.col("n") <= GROUP_LIMIT).select("c", *asked, "lo", "body")
        out = out.unionByName(_sorted_classes(few, length))
        answered = F.when(F.col("open"), 1).otherwise(2).cast("long").alias("copies")
        left = sized.where(F.col("n") > GROUP_LIMIT).select("g", "f", answered, "lo", "anchor", "body")
    return out, tables


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, mark, spans): the bytes of each document that strings repeated elsewhere cover.

    ``spans`` are (start, stop) in bytes, and may overlap. ``id`` is the doc_id, 0 for null, and
    ``mark`` a hash of doc_id and text. Repeated rows are documents of their own, so their texts
    count as repeated. Documents without repeats are absent.
    """
    cut = materialize(_all_fragments(docs, length))
    kinds = materialize(
        # Any of the equal fragments will do; the first of each task is one row's.
        cut.groupBy("g", "f").agg(
            F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("id", "mark", "first", "starts", "anchor")]
        )
    )
    groups = kinds.groupBy("g").agg(F.count("*").alias("n_kinds")).where("n_kinds > 1")
    compared = materialize(kinds.join(groups, "g").select("g", "f", "copies", "n_kinds", "id", "mark", "first", "starts", "anchor"))
    keyed = docs.where("text IS NOT NULL").select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.xxhash64("doc_id", "text").alias("mark"),
        F.col("text").cast("binary").alias("body"),
    )
    bodies = materialize(
        compared.hint("merge").join(keyed, ["id", "mark"]).select(
            "g", "f", "copies", "n_kinds", "anchor",
            F.substring("body", F.col("first").cast("int") + 1, (F.col("starts") + length - 1).cast("int")).alias("body"),
        ).dropDuplicates(["g", "f"])
    )
    release(compared)
    columns = ("g", "f", "copies", "anchor", "body")
    small = bodies.where(F.col("n_kinds") <= GROUP_LIMIT).select(*columns)
    large = bodies.where(F.col("n_kinds") > GROUP_LIMIT).select(*columns)
    whole = kinds.where("copies > 1").select("g", "f", F.lit(0).cast("long").alias("lo"), (F.col("starts") - 1).alias("hi"))
    dealt, tables = _dealt_out(large, length)
    found = materialize(whole.unionByName(_sorted_groups(small, length)).unionByName(dealt))
    release(kinds, bodies, *tables)
    spans = cut.select("id", "mark", "g", "f", "first").join(found, ["g", "f"]).select(
        "id", "mark", (F.col("first") + F.col("lo")).alias("start"), (F.col("first") + F.col("hi") + length).alias("stop")
    )
    once = spans.groupBy("id", "mark", "start").agg(F.max("stop").alias("stop"))
    return once.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _merged(spans: list[dict]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def _kept(text: bytes, runs: list[list[int]]) -> bytes:
    edges = [0, *(x for run in runs for x in run), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs`` (doc_id, text).

    A null text is empty. Spans are maximal removed runs; whole texts are treated, whatever their
    length.
    """
    found = repeated_spans(docs, length)
    joined = _keyed(docs.select("doc_id", "text")).join(found.hint("merge"), ["id", "mark"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
                text, runs = text or b"", _merged(spans or [])
                kept = _kept(text, runs)
                rows.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            sizes = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *sizes], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` without the repeated bytes, all other columns as they are.

    Characters that a cut splits go as a whole. ``n_chars``, if there is such a column, follows the
    text. A document of which nothing is left goes; one that was empty before stays.
    """
    own = unused(docs.columns, "id", "mark", "spans")
    found = repeated_spans(docs, length).toDF(*own)
    same = (F.coalesce(docs["doc_id"], F.lit(0)).cast("long") == found[own[0]]) & (F.xxhash64(docs["doc_id"], docs["text"]) == found[own[1]])
    joined = docs.join(found.hint("merge"), same, "left").drop(own[0], own[1])
    at, schema = docs.columns.index("text"), docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = batch.column(len(schema)).to_pylist(), batch.column(at)
            changed = [i for i, s in enumerate(spans) if s]
            values, gone = texts.to_pylist() if changed else None, np.zeros(batch.num_rows, dtype=bool)
            for i in changed:
                values[i] = _kept(values[i].encode(), _merged(spans[i])).decode("utf-8", "ignore")
                gone[i] = not values[i]
            out = batch.select(list(range(len(schema))))
            if changed:
                out = out.set_column(at, out.schema.field(at), pa.array(values, texts.type))
            yield out.filter(pa.array(~gone))

    kept = joined.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        kept = kept.withColumn("n_chars", F.char_length("text").cast(kind))
    return kept
