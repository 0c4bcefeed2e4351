"""Token counts of flat token files that have no index.

A file is nothing but ids (little-endian u16), each document closed by the end id. Blocks of fixed
size are scanned for that id by themselves; a prefix scan over the blocks of a file then gives
each block the tokens left open before it and the number of documents closed before it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from stratawell.llm.files import TaskFile, opened
from stratawell.llm.tokens import PieceTokenizer, with_end
from stratawell.llm.words import slices
from stratawell.session import materialize, spread

WIDTH = 2
BLOCK_IDS = 4 << 20


def write_flat(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> DataFrame:
    """Write a flat file per partition; returns (part, ordinal, doc_id): which document is where.

    A null text has the end id only. The end id cannot come from a text: the strings of special
    tokens are encoded as ordinary text.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        file, ordinal = None, 0
        for piece in slices(batches):
            if file is None:
                tokenizer = PieceTokenizer(vocabulary, literal_specials=True)
                file = TaskFile(f"{folder}/part-{part:07d}.ids")
            ids, _ = with_end(*tokenizer.encode(piece.column(1)), end_id)
            if len(ids) and int(ids.max()) >= 1 << (8 * WIDTH):
                raise ValueError(f"ids do not fit {WIDTH} bytes")
            file.write(ids.astype(f"<u{WIDTH}").tobytes())
            n = piece.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part)), pa.array(np.arange(ordinal, ordinal + n)), piece.column(0)],
                names=["part", "ordinal", "doc_id"],
            )
            ordinal += n
        if file is not None:
            file.commit()

    kind = dict(docs.dtypes)["doc_id"]
    written = spread(docs.select("doc_id", "text")).mapInArrow(write, f"part long, ordinal long, doc_id {kind}")
    return materialize(written)


def _blocks(spark: SparkSession, folder: str, block_ids: int) -> DataFrame:
    """(part, block, first, n) of every file; a row per file on the driver, not per block."""
    from pyarrow import fs

    system, path = opened(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    sizes = [(int(f.base_name[5:12]), f.size // WIDTH) for f in found if f.base_name.endswith(".ids")]
    files = spark.createDataFrame(sizes, "part long, ids long")
    block = F.explode(F.sequence(F.lit(0), ((F.col("ids") - 1) / block_ids).cast("long"))).alias("block")
    return (
        files.where("ids > 0")
        .select("part", "ids", block)
        .select("part", "block", (F.col("block") * block_ids).alias("first"), "ids")
        .withColumn("n", F.least(F.lit(block_ids), F.col("ids") - F.col("first")))
        .drop("ids")
    )


def scan(spark: SparkSession, folder: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(part, ordinal, n_tokens) of every document in the flat files of ``folder``.

    ``n_tokens`` counts the ids before the end id. Ids after the last end id of a file belong to a
    document that was cut off; it is returned too. A block is read by one task and held in memory;
    a document may span any number of blocks.
    """
    blocks = _blocks(spark, folder, block_ids)
    n_tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = opened(f"{folder}/part-{row['part']:07d}.ids")
                with system.open_input_file(path) as f:
                    raw = f.read_at(WIDTH * row["n"], WIDTH * row["first"])
                at = np.flatnonzero(np.frombuffer(raw, f"<u{WIDTH}") == end_id) + row["first"]
                lists = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([row[k]], pa.int64()) for k in ("part", "block", "first", "n")), lists],
                    names=["part", "block", "first", "n", "ends"],
                )

    seen = materialize(
        blocks.repartition(n_tasks, "part", "block").mapInArrow(
            find, "part long, block long, first long, n long, ends array<long>"
        )
    )
    # The prefix scan works on one row per block; only those rows are ordered.
    before = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    summary = seen.select("part", "block", F.size("ends").alias("closed"), F.try_element_at("ends", F.lit(-1)).alias("last_end"))
    carried = summary.select(
        "part", "block",
        F.coalesce(F.sum("closed").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max("last_end").over(before), F.lit(-1)).alias("end_before"),
    )
    # Joined while it is one row per block; documents are unfolded afterwards, where they are read.
    placed = seen.select("part", "block", "ends").join(carried, ["part", "block"])
    ends = placed.select("part", "docs_before", "end_before", "ends", F.posexplode("ends").alias("k", "at"))
    previous = F.when(F.col("k") > 0, F.expr("ends[k - 1]")).otherwise(F.col("end_before"))
    closed = ends.select(
        "part", (F.col("docs_before") + F.col("k")).alias("ordinal"), (F.col("at") - previous - 1).alias("n_tokens")
    )
    open_end = (
        seen.groupBy("part")
        .agg(
            F.sum(F.size("ends")).alias("ordinal"),
            F.max(F.col("first") + F.col("n")).alias("ids"),
            F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))), F.lit(-1)).alias("last_end"),
        )
        .where("last_end < ids - 1")
        .select("part", "ordinal", (F.col("ids") - F.col("last_end") - 1).alias("n_tokens"))
    )
    return closed.unionByName(open_end)


def token_counts(docs: DataFrame, vocabulary: str, end_id: int, folder: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(doc_id, part, ordinal, n_tokens) of every row of ``docs`` (doc_id, text), counted in the files.

    Repeated rows are documents of their own. An empty table writes no file and gives no row.
    """
    places = write_flat(docs, vocabulary, end_id, folder)
    counts = scan(docs.sparkSession, folder, end_id, block_ids)
    # Unfolded rows look smaller to the optimizer than they are, so no side may be broadcast.
    return places.join(counts.hint("merge"), ["part", "ordinal"]).select("doc_id", "part", "ordinal", "n_tokens")
