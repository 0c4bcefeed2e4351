"""Windows that are written once, when they are closed, and a table of the rows that came too late.

Rows are first dealt into two folders, in time and late, by the greatest time of the batches before.
Windows over the first folder then never lose a row: the watermark of a stream over it cannot be ahead
of the one its rows were dealt by. What is in neither window nor late table does not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stratawell.storage import any_file, delete
from stratawell.streaming.kpis import read_landing
from stratawell.streaming.tables import start

LATE = "is_late"
CLOSING_TIME = "9999-01-01 00:00:00"


def start_dealing(
    stream: DataFrame, time: str, path: str, checkpoint: str, lateness: str = "1 hour", **trigger
) -> StreamingQuery:
    """Write rows to ``path``/rows, each batch in its folder, with late ones apart.

    A row is late if it is more than ``lateness`` behind the greatest time of earlier batches, or has
    no time. A batch is scanned and written once; a repeated batch replaces its own folder.
    """
    spark = stream.sparkSession

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        mark = _mark(spark, path, batch_id - 1)
        at = F.col(time).cast("timestamp")
        late = at.isNull()
        if mark is not None:
            late = late | (at < F.lit(mark) - F.expr(f"INTERVAL {lateness}"))
        seen = Observation()
        flagged = batch.withColumn(LATE, late).observe(seen, F.max(at.cast("string")).alias("last"))
        flagged.write.mode("overwrite").partitionBy(LATE).parquet(f"{path}/rows/batch_id={batch_id}")
        last = F.greatest(F.lit(seen.get["last"]).cast("timestamp"), F.lit(mark).cast("timestamp"))
        spark.range(1).select(last.alias("last")).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        delete(spark, f"{path}/marks/batch_id={batch_id - 2}")  # a repeated batch needs the last one only

    return start(stream, each_batch, checkpoint, **trigger)


def _mark(spark: SparkSession, path: str, batch_id: int):
    """The greatest time up to a batch: one row."""
    folder = f"{path}/marks/batch_id={batch_id}"
    return spark.read.parquet(folder).first()["last"] if any_file(spark, folder) else None


def rows_in_time(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """The rows that were in time, as a stream."""
    return read_landing(spark, f"{path}/rows/*/{LATE}=false/*.parquet", schema, files_per_trigger=files_per_trigger)


def late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that were late or had no time."""
    pattern = f"{path}/rows/*/{LATE}=true"
    if not any_file(spark, pattern):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(pattern)


def start_closed_windows(kpi: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append windows to Parquet files when the watermark has passed their end, each exactly once."""
    return (
        kpi.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def close_windows(spark: SparkSession, path: str, schema, time: str) -> None:
    """Let one row of the far future follow, so that the next run closes all windows.

    Its own window never closes. Whatever comes afterwards is late.
    """
    values = [
        F.lit(CLOSING_TIME).cast(f.dataType).alias(f.name) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    spark.range(1).select(*values).write.mode("overwrite").parquet(f"{path}/rows/closing/{LATE}=false")
    far = F.lit(CLOSING_TIME).cast("timestamp").alias("last")
    batches = [int(r[0]) for r in _batches(spark, path)]
    if batches:
        spark.range(1).select(far).write.mode("overwrite").parquet(f"{path}/marks/batch_id={max(batches)}")


def _batches(spark: SparkSession, path: str):
    """Numbers of the marks that are kept: two at most."""
    if not any_file(spark, f"{path}/marks/batch_id=*"):
        return []
    return spark.read.parquet(f"{path}/marks").select("batch_id").distinct().collect()
