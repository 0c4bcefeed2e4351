"""Micro-batch output that can be replayed: every batch owns one folder of its table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stratawell.operators.dedupe import latest_per_key


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch under its id; a replay of the batch replaces its own folder only."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")


def latest_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest value per key of an update stream."""
    rows = read_batches(spark, path)
    return latest_per_key(rows, keys, [F.desc("batch_id")], total_order=False).drop("batch_id")


def start(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    **trigger,
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(each_batch).trigger(**(trigger or {"availableNow": True})).start()
