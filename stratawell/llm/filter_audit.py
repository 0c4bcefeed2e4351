"""What quality filters remove in every order, from counts per combination of failed filters.

Five filters judge every document; what any order of them keeps and removes follows from how many
documents fail which combination (a mask of five bits) in each part. Filter E, an exact repeat of a
document with a smaller id, is the only one that needs other documents. A counting Bloom sketch goes
first: tasks count hashed digests, the counters are merged, and a document one of whose counters is
1 is unique for certain. Only the others are shuffled, for the least id of each full text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stratawell.session import materialize

FILTERS = "ABCDE"
N_MASKS = 1 << len(FILTERS)
REPEAT = 1 << FILTERS.index("E")
BLANKS = "\t\n\x0b\x0c\r"

# ---- counting Bloom sketch -----------------------------------------------------------------------------

COUNTERS_PER_ROW = 8
SLICE_BITS = 20  # a slice of counters is merged by one task
MAX_COUNTER_BITS = 28  # of one sketch: 32 MB are broadcast, one bit a counter
# Odd factors of the multiply-shift hashes of the sketch.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
HEAVY_SHARE = 1024  # keys with at least one row in so many are joined by broadcast: no more than that


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Counters of each hash, one row per factor."""
    mixed = hashes.astype(np.uint64) * FACTORS[:, None]
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * FACTORS[0]) >> np.uint64(64 - bits)).astype(np.int64)


def counter_bits(n_rows: int) -> int:
    """Logarithm of the number of counters for so many rows, bounded on both sides."""
    wanted = max(1, n_rows * COUNTERS_PER_ROW - 1).bit_length()
    return min(max(wanted, SLICE_BITS), MAX_COUNTER_BITS)


def repeated_counters(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the counters that at least two rows of the column ``h`` have raised.

    Tasks send the counters of a batch, each with its count; a task per slice adds them up.
    """
    edge, size = 1 << min(SLICE_BITS, bits), 1 << bits

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = np.unique(_positions(batch.column(0).to_numpy(), bits), return_counts=True)
            cuts = np.searchsorted(at, np.arange(0, size + edge, edge))
            rows = [
                (i, (at[a:b] - i * edge).astype("<u4").tobytes(), np.minimum(n[a:b], 2).astype(np.uint8).tobytes())
                for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a
            ]
            if rows:
                part, where, times = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(where, pa.binary()), pa.array(times, pa.binary())],
                    names=["part", "at", "n"],
                )

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(edge, np.uint8)
        for at, n in zip(group["at"], group["n"]):
            where = np.frombuffer(at, "<u4")
            total[where] = np.minimum(total[where] + np.frombuffer(n, np.uint8), 2)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "bits": [np.packbits(total == 2).tobytes()]})

    partial = hashes.select("h").mapInArrow(count, "part int, at binary, n binary")
    merged = partial.groupBy("part").applyInPandas(merge, "part int, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for row in merged.toLocalIterator():  # one row per slice: as many bytes as the sketch has
        out[row["part"] * edge // 8 : (row["part"] + 1) * edge // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def clear_unique(rows: DataFrame, digest: str = "digest", max_bits: int = MAX_COUNTER_BITS) -> DataFrame:
    """``rows`` with a null digest where the sketch proves the digest to be unique.

    The others are possible repeats; every true repeat is among them. More rows than a sketch of
    2 ** ``max_bits`` counters can tell apart are taken in rounds, each over one class of hashes.
    The columns of ``rows`` are few and narrow: every round reads them once.
    """
    spark = rows.sparkSession
    n_rows = rows.count()
    rounds = -(-n_rows * COUNTERS_PER_ROW // (1 << max_bits)) or 1
    bits = min(counter_bits(-(-n_rows // rounds)), max_bits)
    columns = rows.columns
    hashed = rows.withColumn("h", F.xxhash64(digest))
    out = None
    for k in range(rounds):
        mine = hashed if rounds == 1 else hashed.where(F.pmod("h", F.lit(rounds)) == k)
        shared = spark.sparkContext.broadcast(repeated_counters(mine, bits))

        def probe(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = _positions(batch.column("h").to_numpy(), bits)
                seen = ((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
                kept = [
                    pc.if_else(pa.array(seen), batch.column(c), pa.scalar(None, batch.column(c).type)) if c == digest else batch.column(c)
                    for c in columns
                ]
                yield pa.RecordBatch.from_arrays(kept, names=columns)

        part = materialize(mine.mapInArrow(probe, rows.schema))
        out = part if out is None else out.unionByName(part)
    return out


# ---- filters ------------------------------------------------------------------------------------------------


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def own_mask(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of filters A to D, and the digest of the whole text."""
    base = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("words", _words(F.col("text")))
    n = F.size("words")
    fails = [
        n < 50,
        100 * F.size(F.array_distinct("words")) < 65 * n,
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 5 * F.length("text").cast("long"),
        F.col("text").rlike(r"[#$%&*|]"),
    ]
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return base.select("doc_id", "part", bits.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of all five filters, one row per row of ``docs`` (doc_id, text, source).

    Texts are read once; what is kept of them is narrow. Repeats are found by the SHA-256 digest of
    the whole text. The least ids of texts that many rows have are joined by broadcast (there are at
    most 1,024 texts with a 1,024th of all rows each), those of the others by shuffle, so that no
    task gets a large group of copies. A row without a doc_id repeats nothing, and nothing repeats
    it; of rows with one doc_id and one text none is smaller, so neither is removed for the other.
    """
    rows = clear_unique(materialize(own_mask(docs)))
    cleared = rows.where("digest IS NULL OR doc_id IS NULL").select("doc_id", "part", "mask")
    possible = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    heavy_from = max(2, rows.count() // HEAVY_SHARE)
    least = materialize(
        possible.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    )
    heavy = F.broadcast(least.where(F.col("n") >= heavy_from).select("digest", "least"))
    light = least.where(F.col("n") < heavy_from).select("digest", F.col("least").alias("least_light"))
    hit = possible.join(heavy, "digest", "left")
    repeats = F.when(F.col("doc_id") > F.col("least"), REPEAT).otherwise(0)
    of_heavy = hit.where("least IS NOT NULL").select("doc_id", "part", (F.col("mask") + repeats).alias("mask"))
    of_light = hit.where("least IS NULL").drop("least").join(light, "digest", "left")
    repeats = F.when(F.col("doc_id") > F.col("least_light"), REPEAT).otherwise(0)
    of_light = of_light.select("doc_id", "part", (F.col("mask") + repeats).alias("mask"))
    return cleared.unionByName(of_heavy).unionByName(of_light)


# ---- audit ---------------------------------------------------------------------------------------------------


def _orders() -> tuple[list[tuple[str, int]], np.ndarray, np.ndarray, np.ndarray]:
    """(order, step) of all rows of a part; for each, which masks are kept, removed and redundant."""
    rows, kept, removed, redundant = [], [], [], []
    mask = np.arange(N_MASKS)
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            fails = mask & bit > 0
            rows.append(("".join(order), step))
            removed.append(fails & (mask & before == 0))
            redundant.append(fails & (mask & before > 0))
            before |= bit
            kept.append(mask & before == 0)
    return rows, np.array(kept), np.array(removed), np.array(redundant)


def audit_rows(counts: pd.DataFrame) -> pd.DataFrame:
    """The 600 rows of one part from its counts: columns mask, n, good, toxic."""
    n, good, toxic = (np.bincount(counts["mask"], counts[c], N_MASKS).astype(np.int64) for c in ("n", "good", "toxic"))
    rows, kept, removed, redundant = _orders()
    out = pd.DataFrame(rows, columns=["filter_order", "step"])
    out["step"] = out["step"].astype("int32")
    out["kept"], out["removed"], out["redundant"] = kept @ n, removed @ n, redundant @ n
    letter = [order[step - 1] for order, step in rows]
    out["unique_fails"] = [int(n[1 << FILTERS.index(x)]) for x in letter]
    out["good_lost"], out["toxic_lost"] = removed @ good, removed @ toxic
    out["shapley"] = out["removed"].groupby(pd.Series(letter)).transform("sum")
    return out


AUDIT_DDL = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Additive counts by part and mask: documents, and those labelled good (quality 1) and toxic.

    Several labels of one document count once: it is good or toxic if any of them says so.
    """
    flags = materialize(masks(docs))
    said = labels.where("quality = 1 OR toxic = 1").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    zero = F.lit(0).cast("long")
    every = flags.groupBy("part", "mask").agg(F.count("*").alias("n")).select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    labelled = flags.join(said, "doc_id").groupBy("part", "mask").agg(
        F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    ).select("part", "mask", zero.alias("n"), "good", "toxic")
    return every.unionByName(labelled).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Effect of each filter in each of the 120 orders, per part (source).

    ``docs``: doc_id, text, source; ``labels``: doc_id, quality, toxic; other columns are left
    alone. A null text is an empty one, a null source the part "". Every row counts, repeated rows
    too. Counts of all parts of an empty table: no rows. A group of the last step has 32 rows at most.
    """

    def per_part(group: pd.DataFrame) -> pd.DataFrame:
        out = audit_rows(group)
        out.insert(0, "part", group["part"].iloc[0])
        return out

    return mask_counts(docs, labels).groupBy("part").applyInPandas(per_part, AUDIT_DDL)
