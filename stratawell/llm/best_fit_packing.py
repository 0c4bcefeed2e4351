"""Best-fit packing of documents into bins of fixed capacity, under conflicts.

Two documents of one source, or of one cluster of duplicates, never share a bin. Bins are kept in
order of the room they have left; the search starts at the tightest bin that has room and goes on
to the next until one has no conflict, which the bins' bitmaps of sources and clusters tell.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

CAPACITY = 2048
SHARD_ITEMS = 2048
BIN_STRIDE = 1 << 24


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item, in the order given; lengths are 1 to ``capacity``.

    Sources and clusters are small numbers, below 0 for none. They are bits of the bins' bitmaps.
    """
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        s, c = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        at = bisect_left(room, (length, -1))
        while at < len(room) and (source_bits[room[at][1]] & s or cluster_bits[room[at][1]] & c):
            at += 1
        if at < len(room):
            left, number = room.pop(at)
        else:
            left, number = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[number] |= s
        cluster_bits[number] |= c
        placed.append((number, capacity - left))
        if left > length:
            insort(room, (left - length, number))
    return placed


def _local(values: pd.Series) -> list[int]:
    """Small numbers for the values, -1 for null; the most frequent first, so bitmaps stay short."""
    counts = values.value_counts()
    number = {v: i for i, v in enumerate(counts.index)}
    return [number.get(v, -1) for v in values]


def pack(docs: DataFrame, length: Column, source: Column, cluster: Column, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Pack the rows of ``docs``: doc_id, piece, length, bin_id, bin_offset, bin_free.

    ``length``, ``source`` and ``cluster`` are expressions over ``docs``. Rows are dealt into
    shards of about ``shard_items`` by a hash, whatever their source or cluster, and each shard is
    packed by itself, longest first; a task holds numbers of a shard, never texts. A document over
    the capacity is cut into pieces: full ones fill bins of their own, the rest is packed. A null
    source or cluster conflicts with nothing. A document of length 0 or null takes no room: its
    bin is null. Ties are settled by doc_id. Repeated rows are packed one by one; being of one
    cluster they land in different bins.
    """
    items = docs.select(
        "doc_id",
        F.coalesce(length, F.lit(0)).cast("long").alias("length"),
        source.cast("string").alias("source"),
        cluster.alias("cluster"),
        F.monotonically_increasing_id().alias("row"),
    )
    n_shards = max(1, -(-docs.count() // shard_items))
    kind = dict(docs.dtypes)["doc_id"]

    def one_shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "row"], ascending=[False, True, True], na_position="first")
        full, rest = group["length"] // capacity, group["length"] % capacity
        whole = group.loc[group.index.repeat(full)]
        pieces = whole.groupby(level=0).cumcount()
        filled = pd.DataFrame({
            "doc_id": whole["doc_id"], "piece": pieces, "length": capacity,
            "bin": range(len(whole)), "bin_offset": 0,
        })
        part = group.assign(piece=full, length=rest)
        part = part[part["length"] > 0].sort_values("length", ascending=False, kind="stable")
        placed = best_fit(part["length"].tolist(), _local(part["source"]), _local(part["cluster"]), capacity)
        part = part.assign(
            bin=[b + len(whole) for b, _ in placed], bin_offset=[o for _, o in placed]
        )[["doc_id", "piece", "length", "bin", "bin_offset"]]
        out = pd.concat([filled, part], ignore_index=True)
        used = out.groupby("bin")["length"].transform("sum")
        out["bin_id"] = out["bin"] + int(group["shard"].iloc[0]) * BIN_STRIDE
        out["bin_free"] = capacity - used
        out["bin_offset"] = out["bin_offset"].astype("int64")
        return out[["doc_id", "piece", "length", "bin_id", "bin_offset", "bin_free"]]

    schema = f"doc_id {kind}, piece long, length long, bin_id long, bin_offset long, bin_free long"
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row"), F.lit(n_shards)))
    packed = dealt.where("length > 0").groupBy("shard").applyInPandas(one_shard, schema)
    null = F.lit(None).cast("long")
    empty = items.where("length <= 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("length"),
        null.alias("bin_id"), null.alias("bin_offset"), null.alias("bin_free"),
    )
    return packed.unionByName(empty)


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def copy_cluster(text: Column) -> Column:
    """Texts that are equal but for case and blanks are of one cluster."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack documents (doc_id, text, source) by their number of words."""
    return pack(docs, n_words(F.col("text")), F.col("source"), copy_cluster(F.col("text")), capacity)
