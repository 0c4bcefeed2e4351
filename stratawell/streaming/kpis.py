"""Streaming KPIs and alerts; each equals its batch twin on the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stratawell.config import RULES, AlertRules
from stratawell.functions import kpis
from stratawell.streaming.tables import start, write_batch


def read_landing(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """Files as they land in a folder (or match a pattern)."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


# ---- windowed KPIs ------------------------------------------------------------------------------------


def windowed_kpi(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    width: str = "1 day",
    slide: str | None = None,
    lateness: str = "1 hour",
) -> DataFrame:
    """Aggregates per key and event-time window; rows later than ``lateness`` are dropped.

    Works on streams and, the lateness having no effect, on batches. Partial sums per task go
    into the state, so a busy key costs one row per task.
    """
    stamped = stream.withColumn("_time", F.col(time).cast("timestamp"))
    if stamped.isStreaming:
        stamped = stamped.withWatermark("_time", lateness)
    span = F.window("_time", width, slide) if slide else F.window("_time", width)
    return (
        stamped.groupBy(span.alias("_w"), *keys)
        .agg(*[a.alias(name) for name, a in aggregates.items()])
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *keys,
            *aggregates,
        )
    )


def window_drop(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    value: str,
    width: str = "24 hours",
    slide: str = "1 hour",
    lateness: str = "1 hour",
    rules: AlertRules = RULES,
) -> DataFrame:
    """Mean and last reading per key and sliding window, flagged where the last has dropped."""
    kpi = windowed_kpi(
        stream,
        time,
        keys,
        {"mean_value": F.avg(value), "last_value": F.max_by(value, "_time")},
        width,
        slide,
        lateness,
    )
    return kpi.withColumn("is_pressure_drop", kpis.pressure_drop("last_value", "mean_value", rules))


def start_windowed_kpi(kpi: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep a table of the current value of every window, open ones included."""
    return start(
        kpi, lambda df, batch: write_batch(df, path, batch), checkpoint, mode="update", **trigger
    )


# ---- alerts that need no history -------------------------------------------------------------------------


def production_alerts(df: DataFrame, rules: AlertRules = RULES) -> DataFrame:
    """Rows that break a rule on their own: zero output while running, invalid pressure."""
    judged = df.withColumns(
        {
            "is_zero_prod_uptime": kpis.zero_output_while_running(),
            "is_pressure_valid": kpis.pressure_valid(rules=rules),
        }
    )
    return judged.filter(F.col("is_zero_prod_uptime") | ~F.col("is_pressure_valid"))


def start_alerts(alerts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append alerts to Parquet files, each row exactly once."""
    return (
        alerts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# ---- timeliness -------------------------------------------------------------------------------------------------


def late_files(spark: SparkSession, path: str, due: Column) -> DataFrame:
    """Files below a folder with whether they arrived by ``due``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime")
    )
    return files.withColumn("on_time", F.col("modificationTime") <= due)
