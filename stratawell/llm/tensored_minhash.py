"""Near-duplicate documents by tensored min-hashing, with links confirmed on full sets.

Two collections of ``width`` partial keys are computed, each key from ``depth`` min-hashes. Every
pair of a key of the first and a key of the second is the key of one table, so ``width`` squared
tables cost 2 x width x depth min-hashes instead of 2 x width^2 x depth. Two documents of
similarity s share no table with probability at most 2 (1 - s^depth)^width: 3 in 100,000 at 0.8
and the defaults below, less above.

Documents of equal sets are one class. Candidates are compared in three steps, each among classes
that are not connected yet: with the likeliest partner, with one leader of each bucket, and then
with every class of the bucket that is in another component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from stratawell.llm.links import components
from stratawell.llm.words import codes_of, lower_ascii, slices, span_strings, text_bytes, unused, word_spans
from stratawell.session import materialize, release, spread

WORD = np.uint64(0x9E3779B97F4A7C15)
SLICE = 2 << 20  # bytes of text that a task works on at a time
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Banding:
    shingle: int = 2
    percent: int = 80  # links have 100 * intersection >= percent * union
    depth: int = 3
    width: int = 14
    leaders: int = 3  # drawn leaders that a class is compared with
    seed: int = 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each text, and the bounds of each text.

    Words are lower-cased in A-Z and end at blanks. A text of fewer words than a shingle has its
    whole sequence as one shingle; a text without words has none.
    """
    data, bounds = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, words = word_spans(data, bounds)
    n_words, n_rows = np.diff(words), len(bounds) - 1
    codes, names = codes_of(span_strings(data, starts, ends))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names.to_pylist()), np.uint64, len(names))
    row = np.repeat(np.arange(n_rows), n_words)
    taken = np.minimum(n_words, size)  # words in each shingle of the row
    first = np.flatnonzero(np.arange(len(codes)) + taken[row] <= words[row + 1]) if len(codes) else np.zeros(0, np.int64)
    key, value = codes[first], _mix(hashes[codes[first]])
    for k in range(1, size):
        more = taken[row[first]] > k
        at = np.where(more, first + k, first)
        key, _ = codes_of(key * (len(names) + 1) + np.where(more, codes[at], len(names)))
        value = np.where(more, _mix(value * WORD + hashes[codes[at]] + OTHER), value)
    pair = key * n_rows + row[first]
    code, _ = codes_of(pair)
    once = np.zeros(len(code), dtype=bool)
    if len(code):
        new = np.concatenate([[-1], np.maximum.accumulate(code)])
        once = code > new[:-1]
    kept_rows = row[first][once]
    return value[once], np.searchsorted(kept_rows, np.arange(n_rows + 1))


def sketch(sets: np.ndarray, bounds: np.ndarray, plan: Banding) -> tuple[np.ndarray, np.ndarray]:
    """Partial keys of each set, first and second collection, as (rows, width) of int64."""
    draw = np.random.default_rng(plan.seed)
    n = 2 * plan.width * plan.depth
    factor = draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = draw.integers(0, 1 << 63, n, dtype=np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    keys = np.zeros((len(bounds) - 1, 2 * plan.width), np.uint64)
    for k in range(2 * plan.width):
        for d in range(plan.depth):
            i = k * plan.depth + d
            values = (sets ^ shift[i]) * factor[i]
            least = np.minimum.reduceat(values ^ (values >> np.uint64(32)), bounds[full]) if len(full) else sets[:0]
            keys[full, k] = _mix(keys[full, k] * WORD + least + np.uint64(i + 1))
    signed = keys.view(np.int64)
    return signed[:, : plan.width], signed[:, plan.width :]


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(matrix.reshape(-1)))


def _set_marks(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set, whatever its order."""
    marks = []
    for salt in (WORD, OTHER):
        total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(sets ^ salt), dtype=np.uint64)])
        marks.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return marks[0], marks[1]


def document_sets(docs: DataFrame, plan: Banding) -> DataFrame:
    """doc_id, n_shingles, the marks of the set, and both collections of partial keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, budget=SLICE):
            sets, bounds = shingle_sets(part.column(1), plan.shingle)
            u, v = sketch(sets, bounds, plan)
            s1, s2 = _set_marks(sets, bounds)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(bounds)), pa.array(s1), pa.array(s2), _lists(u), _lists(v)],
                names=["doc_id", "n_shingles", "s1", "s2", "u", "v"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return spread(docs.select("doc_id", "text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, u array<long>, v array<long>"
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), with what other ids they carry, whose full sets are similar enough."""
    kept = pairs.columns
    left = sets.select(F.col("cid").alias("a"), F.col("hashes").alias("set_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("hashes").alias("set_b"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(kept).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(left, "a").join(right, "b").select(*kept, "set_a", "set_b")
    return both.mapInArrow(compare, ", ".join(f"{c} long" for c in kept))


def _sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the similarity."""
    return pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))


def _likeliest(led: DataFrame, percent: int, most: int, *kept: str) -> DataFrame:
    """(a, b): for each class of (cid, n_a, other, n_b) the leaders it shares most tables with.

    ``kept`` are columns that the two classes fix in either order; they go along.
    """
    met = _sized(led, percent).groupBy("cid", "other").agg(F.count("*").alias("met"), *[F.first(c).alias(c) for c in kept])
    # At most one row per class and table.
    order = W.partitionBy("cid").orderBy(F.desc("met"), "other")
    best = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return best.select(F.least("cid", "other").alias("a"), F.greatest("cid", "other").alias("b"), *kept).distinct()


def _prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b, root_a, root_b) of different roots that may be similar, among ``members`` (cid, n, root), and what it reads.

    Shingles are ordered by the number of members that have them. A pair shares at least
    ``percent`` of the larger set, so it shares one of the first n - ceil(percent n / 100) + 1 of
    either set. Shingles of one member only come first and match nothing.
    """

    def unfold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, hashes in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(hashes.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), cid)), pa.array(values)], names=["cid", "h"])

    wanted = sets.select("cid", "hashes").join(members.select("cid"), "cid", "left_semi")
    shingles = materialize(wanted.mapInArrow(unfold, "cid long, h long"))
    often = shingles.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    order = W.partitionBy("cid").orderBy("df", "h")
    ranked = shingles.join(often, "h").select(
        "cid", "h", F.row_number().over(order).alias("rank"), F.count("*").over(W.partitionBy("cid")).alias("m")
    )
    first = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1 - (F.col("n") - F.col("m"))
    place = (F.col("rank") + F.col("n") - F.col("m")).alias("place")  # among all shingles of the set
    prefix = materialize(ranked.join(members, "cid").where(F.col("rank") <= first).select("h", "cid", "n", "root", place))
    left, right = (
        prefix.select("h", *[F.col(x).alias(y) for x, y in (("cid", side), ("n", f"n_{side}"), ("root", f"root_{side}"), ("place", f"place_{side}"))])
        for side in "ab"
    )
    # At the first shingle that two sets share, what is left of both must hold the rest of the overlap.
    most = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))
    return left.join(right, "h").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & enough).select("a", "b", "root_a", "root_b").distinct(), [shingles, prefix]


def _full_sets(docs: DataFrame, wanted: DataFrame, plan: Banding) -> DataFrame:
    """(cid, hashes) of the wanted classes (cid, doc, s1, s2), made anew from their texts."""
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    found = wanted.join(texts, wanted["doc"].eqNullSafe(texts["doc_id"])).select("cid", "s1", "s2", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, budget=SLICE):
            sets, bounds = shingle_sets(part.column(3), plan.shingle)
            s1, s2 = _set_marks(sets, bounds)
            # An id may stand for several texts; only the one of this class counts.
            own = (s1 == part.column(1).to_numpy()) & (s2 == part.column(2).to_numpy())
            flat = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(s1), [None, pa.py_buffer((8 * bounds).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(sets))]
            ).cast(pa.binary())
            out = pa.RecordBatch.from_arrays([part.column(0), flat], names=["cid", "hashes"])
            yield out.filter(pa.array(own))

    return found.mapInArrow(run, "cid long, hashes binary").dropDuplicates(["cid"])


def near_duplicates(docs: DataFrame, plan: Banding = Banding()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, group, and the set's marks, of every row of ``docs``.

    ``component_id`` is the smallest doc_id that links lead to, ``kept`` says that it is the row's
    own, ``group`` numbers the components. A text without words has the empty set and is linked
    with nothing; its group is null. Rows of equal sets are one class, so repeated rows and copies
    cost one comparison. A null doc_id is larger than any other. Only texts decide.
    """
    rows = materialize(document_sets(docs, plan))
    classes = materialize(
        rows.where("n_shingles > 0")
        .groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("u").alias("u"), F.first("v").alias("v"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    tables = (
        classes.select("cid", "n", F.posexplode("u").alias("i", "ku"), "v")
        .select("cid", "n", "i", "ku", F.posexplode("v").alias("j", "kv"))
        .select(F.xxhash64("i", "ku", "j", "kv").alias("key"), "cid", "n")
    )
    # Only buckets of several classes go on. Their keys are written first: the files of two shuffles of all tables
    # would else lie on disk at once.
    sizes = tables.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high"), F.count("*").alias("size"))
    shared = materialize(sizes.where("low < high").select("key", "size"))
    buckets = materialize(tables.join(shared, "key"))
    release(shared)

    # The class whose buckets are the fullest stands in the middle of its like.
    weights = materialize(buckets.groupBy("cid").agg(F.sum("size").alias("weight")))
    weighed = buckets.join(weights, "cid").select("key", "cid", "n", "weight")
    middle = materialize(weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("cid")).alias("minus"), "n")).alias("lead")))
    led = weighed.join(middle, "key").select(
        "cid", F.col("n").alias("n_a"), (-F.col("lead.minus")).alias("other"), F.col("lead.n").alias("n_b")
    )
    first = materialize(_likeliest(led.where("cid <> other"), plan.percent, 1))

    wanted = classes.join(weights, "cid", "left_semi").select("cid", "doc", "s1", "s2")
    sets = materialize(_full_sets(docs, wanted, plan))
    release(weights, middle)
    links = materialize(_confirmed(first, sets, plan.percent))
    roots = components(links)
    release(first, links)

    def mixed(state: DataFrame) -> DataFrame:
        """Buckets that still hold more than one component, with the component of each class."""
        named = buckets.join(state.withColumnRenamed("node", "cid"), "cid", "left").select(
            "key", "cid", "n", F.coalesce("root", "cid").alias("root")
        )
        split = named.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1")
        return materialize(named.join(split.select("key"), "key", "left_semi"))

    def with_more(roots: DataFrame, pairs: DataFrame) -> DataFrame:
        """The components once those of similar pairs are joined; links inside of them are not gone through again."""
        joined = _confirmed(pairs, sets, plan.percent).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        links = materialize(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(joined))
        found = components(links)
        release(links)
        return found

    left = mixed(roots)
    draws = left.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "cid").alias("draw"), "cid", "n", "root")).alias("lead"))
    led = left.join(draws, "key").where("root <> lead.root").select(
        "cid", F.col("n").alias("n_a"), F.col("lead.cid").alias("other"), F.col("lead.n").alias("n_b"),
        F.least("root", "lead.root").alias("root_a"), F.greatest("root", "lead.root").alias("root_b"),
    )
    roots = with_more(roots, _likeliest(led, plan.percent, plan.leaders, "root_a", "root_b"))

    rest = mixed(roots)
    members = materialize(rest.groupBy("cid").agg(F.first("n").alias("n"), F.first("root").alias("root")))
    pairs, tables = _prefix_pairs(members, sets, plan.percent)
    roots = with_more(roots, pairs)
    release(buckets, sets, left, rest, members, *tables)

    named = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "s1", "s2", "doc", F.coalesce("root", "cid").alias("group")
    )
    least = named.groupBy("group").agg(F.min("doc").alias("component_id"))
    named = named.join(least, "group").select("s1", "s2", "group", "component_id")
    nothing = rows.where("n_shingles = 0").select(
        "doc_id", "n_shingles", "s1", "s2", F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("component_id")
    )
    found = (
        rows.where("n_shingles > 0").select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"])
        .select("doc_id", "n_shingles", "s1", "s2", "group", "component_id").unionByName(nothing)
    )
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "group",
        "s1", "s2",
    )


def keep_one(docs: DataFrame, plan: Banding = Banding()) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without all but one of each group.

    The row whose doc_id is the smallest of its group stays. Texts without words stay. Of rows that
    repeat that doc_id with an equal set of shingles, one stays.
    """
    found = near_duplicates(docs, plan).where("n_shingles > 0")
    dropped = found.where("NOT kept").select("doc_id", "s1", "s2").distinct()
    # Rows carry the marks of their sets, so that an id with several texts is told apart.
    m1, m2 = unused(docs.columns, "s1", "s2")
    marked = _marked(docs, plan, m1, m2)

    def same(other: DataFrame):
        return marked["doc_id"].eqNullSafe(other["doc_id"]) & (marked[m1] == other["s1"]) & (marked[m2] == other["s2"])

    kept = marked.join(dropped.hint("merge"), same(dropped), "left_anti")
    twice = materialize(
        found.where("kept").groupBy("doc_id", "s1", "s2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    )
    if twice.isEmpty():
        return kept.drop(m1, m2)
    once = marked.join(twice, same(twice), "left_semi").dropDuplicates(["doc_id", m1, m2])
    return kept.join(twice, same(twice), "left_anti").unionByName(once).drop(m1, m2)


def _marked(docs: DataFrame, plan: Banding, m1: str, m2: str) -> DataFrame:
    """``docs`` with the marks of each row's set of shingles."""
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, budget=SLICE):
            s1, s2 = _set_marks(*shingle_sets(part.column(at), plan.shingle))
            yield part.append_column(m1, pa.array(s1)).append_column(m2, pa.array(s2))

    schema = T.StructType([*docs.schema.fields, T.StructField(m1, T.LongType()), T.StructField(m2, T.LongType())])
    return spread(docs).mapInArrow(run, schema)
