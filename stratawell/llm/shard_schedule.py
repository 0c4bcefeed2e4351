"""Sharding by longest processing time: whole groups, largest first, each to the least-loaded shard.

The order of groups by size is a distributed sort. What the heap needs of it is only how many groups
have each size: a group of a size differs from another of that size by nothing that counts. The heap
therefore runs over the distinct sizes, of which a corpus of T bytes has less than the square root of
2 T (their sum is at most T), and says which stretch of the sorted groups goes to which shard.
"""

from __future__ import annotations

from collections.abc import Iterable
from heapq import heapify, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stratawell.session import materialize

SHARDS = 16
LAW = "bytes"
ROW_BITS = 33  # below the partition number in monotonically_increasing_id
HEAVY_SHARE = 1024  # groups with at least one row in so many are joined by broadcast: no more than that
LONG_RUN = 64  # groups of one size from which the heap's moves are taken together

# ---- the schedule --------------------------------------------------------------------------------------


def run_moves(loads: list[int], size: int, count: int) -> list[int]:
    """Groups each shard gets when ``count`` groups of one size go to the least-loaded shard in turn.

    The shard's load before its j-th group is load + j * size; the heap pops these keys in order, so
    the moves are the ``count`` smallest keys, ties by shard.
    """

    def below(key: int) -> list[int]:
        return [max(0, -((load - key) // size)) for load in loads]

    low, high = min(loads), min(loads) + size * count + 1  # keys below low: 0, below high: count at least
    while high - low > 1:
        middle = (low + high) // 2
        if sum(below(middle)) <= count:
            low = middle
        else:
            high = middle
    moves = below(low)
    rest = count - sum(moves)
    for shard, load in enumerate(loads):
        if rest and load <= low and (low - load) % size == 0:
            moves[shard] += 1
            rest -= 1
    return moves


def schedule(sizes: Iterable[tuple[int, int]], n_shards: int) -> tuple[list[list[tuple[int, int]]], list[int]]:
    """(shard, groups) of each (size, count), largest size first, and the loads of the shards.

    Shards with the same load are taken in order of their number.
    """
    heap = [(0, shard) for shard in range(n_shards)]
    plan = []
    for size, count in sizes:
        if count < LONG_RUN:
            moves = dict.fromkeys(range(n_shards), 0)
            for _ in range(count):
                load, shard = heap[0]
                heapreplace(heap, (load + size, shard))
                moves[shard] += 1
            given = list(moves.items())
        else:
            loads = [0] * n_shards
            for load, shard in heap:
                loads[shard] = load
            given = list(enumerate(run_moves(loads, size, count)))
            heap = [(loads[shard] + n * size, shard) for shard, n in given]
            heapify(heap)
        plan.append([(shard, n) for shard, n in given if n])
    return plan, [load for load, _ in sorted(heap, key=lambda x: x[1])]


# ---- order without a task that sees all ------------------------------------------------------------------------


def positions(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 in the given total order.

    ``rows`` is read twice (the range shuffle samples it): a written table. The numbers come from
    places within the sorted partitions and their row counts, one number per partition.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", ROW_BITS)
    sizes = kept.groupBy(part.alias("_part")).count().toPandas().sort_values("_part")
    before = sizes["count"].cumsum() - sizes["count"]
    table = pd.DataFrame({"_part": sizes["_part"].astype("int64"), "_before": before.astype("int64")})
    offsets = spark.createDataFrame(table, "_part long, _before long")
    within = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = kept.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(name, F.col("_before") + within).drop("_part", "_before", "_id")


def _scheduled_groups(keyed: DataFrame, n_shards: int) -> DataFrame:
    """(key, n, shard) of every group of ``keyed`` (key, doc_id, size)."""
    spark = keyed.sparkSession
    groups = materialize(
        keyed.groupBy("key").agg(F.sum("size").alias("total"), F.min("doc_id").alias("lead"), F.count("*").alias("n"))
    )
    ordered = positions(groups, [F.col("total").desc(), F.col("lead").asc(), F.col("key").asc()], "at")
    counts = groups.groupBy("total").count().toPandas().sort_values("total", ascending=False)
    plan, _ = schedule(zip(counts["total"].tolist(), counts["count"].tolist()), n_shards)
    starts = (counts["count"].cumsum() - counts["count"]).tolist()
    table = pd.DataFrame({
        "total": counts["total"].astype("int64"),
        "ends": [(start + np.cumsum([n for _, n in given])).tolist() for start, given in zip(starts, plan)],
        "shards": [[shard for shard, _ in given] for given in plan],
    })
    rules = spark.createDataFrame(table, "total long, ends array<long>, shards array<int>")
    passed = F.size(F.filter("ends", lambda end: end <= F.col("at")))
    return ordered.join(rules, "total").select("key", "n", F.element_at("shards", passed + 1).alias("shard"))


def _with_shards(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``shard`` to rows with ``key``: large groups by broadcast, so that none lands in one task."""
    groups = materialize(groups)
    heavy_from = max(2, (groups.agg(F.sum("n")).first()[0] or 0) // HEAVY_SHARE)
    heavy = groups.where(F.col("n") >= heavy_from).select("key", "shard")
    light = groups.where(F.col("n") < heavy_from).select("key", "shard")
    hit = rows.join(F.broadcast(heavy), "key", "left")
    return hit.where("shard IS NOT NULL").unionByName(hit.where("shard IS NULL").drop("shard").join(light, "key"))


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _key(text: Column) -> Column:
    """Equal texts have one key; different texts that share a key by chance only stay together."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shard_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs`` (doc_id, text).

    Rows with equal texts stay together; a null text counts as an empty one, and both are one group.
    Groups go by the sum of their sizes, ties by their least doc_id. Slots count the rows of a shard
    by doc_id, nulls first; repeated rows have slots of their own. An empty table gives no rows.
    """
    text = F.col("text")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    keyed = materialize(docs.select("doc_id", _size(text).alias("size"), crc.alias("text_crc32"), _key(text).alias("key")))
    placed = materialize(_with_shards(keyed, _scheduled_groups(keyed, n_shards)))
    # The number of the row within its file keeps apart rows that repeat one id.
    numbered = positions(
        placed.withColumn("row", F.monotonically_increasing_id()), [F.col("shard"), F.col("doc_id"), F.col("row")], "at"
    )
    sizes = placed.groupBy("shard").count().toPandas().sort_values("shard")  # one row per shard
    starts = dict(zip(sizes["shard"].tolist(), (sizes["count"].cumsum() - sizes["count"]).tolist()))
    begin = F.coalesce(*[F.when(F.col("shard") == k, F.lit(v)) for k, v in starts.items()], F.lit(0))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("at") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, folder: str, n_shards: int = SHARDS) -> None:
    """Write ``docs`` with all columns below ``folder``, one subfolder ``shard=k`` per shard.

    Texts are shuffled once, in files of even size. A column named like one of the schedule's own
    (key, shard) is put aside while the rows are placed.
    """
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("own")
    text = F.col("text")
    keyed = docs.select("doc_id", _size(text).alias("size"), _key(text).alias("key"))
    placed = _with_shards(docs.select(own, _key(text).alias("key")), _scheduled_groups(materialize(keyed), n_shards))
    kept = [c for c in docs.columns if c.lower() != "shard"]
    flat = placed.select(*[F.col("own").getField(c).alias(c) for c in kept], "shard")
    flat.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(folder)
