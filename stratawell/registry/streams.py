"""Streaming queries, run to the end of the given data; oracles are their batch twins."""

from pyspark.sql import functions as F

from stratawell.config import Series
from stratawell.functions import kpis
from stratawell.operators.frames import Lag, Trailing
from stratawell.registry.base import query, r, rounded
from stratawell.registry.fixtures import table
from stratawell.session import scratch_path
from stratawell.streaming.kpis import (
    production_alerts,
    read_landing,
    start_alerts,
    start_windowed_kpi,
    window_drop,
    windowed_kpi,
)
from stratawell.streaming.closed import close_windows, rows_in_time, start_closed_windows, start_dealing
from stratawell.streaming.readings import measured_readings, start_reading_rules
from stratawell.streaming.tables import latest_state

READINGS = Series("user_id", "ts", ("event_id",))


def source(spark, sf, name):
    """A given table as a stream of files."""
    pattern = f"{sf}/{name[:-1]}[{name[-1]}].parquet"
    return read_landing(spark, pattern, table(spark, sf, name).schema)


def event_kpis(spark, sf, width, slide=None):
    out, checkpoint = scratch_path(spark, "kpi"), scratch_path(spark, "kpi-checkpoint")
    stream = windowed_kpi(
        source(spark, sf, "events"),
        "ts",
        ["event_type"],
        {"n_events": F.count(F.lit(1)), "total": F.sum("value"), "mean": F.avg("value")},
        width,
        slide,
        lateness="60 days",
    )
    start_windowed_kpi(stream, out, checkpoint).awaitTermination()
    return rounded(latest_state(spark, out, ["window_start", "event_type"]))


@query(
    "stream_daily_kpi",
    f"""SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, event_type,
               count(*) AS n_events, {r('sum(value)', 'total')}, {r('avg(value)', 'mean')}
        FROM events GROUP BY ALL""",
)
def stream_daily_kpi(spark, sf):
    return event_kpis(spark, sf, "1 day")


@query(
    "stream_sliding_kpi",
    f"""SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) - k * INTERVAL 6 HOUR
                 - (hour(ts) % 6) * INTERVAL 1 HOUR AS window_start,
               CAST(date_trunc('hour', ts) AS TIMESTAMP) - k * INTERVAL 6 HOUR
                 - (hour(ts) % 6) * INTERVAL 1 HOUR + INTERVAL 24 HOUR AS window_end,
               event_type, count(*) AS n_events, {r('sum(value)', 'total')}, {r('avg(value)', 'mean')}
        FROM events, unnest(range(0, 4)) AS s(k) GROUP BY ALL""",
)
def stream_sliding_kpi(spark, sf):
    return event_kpis(spark, sf, "24 hours", "6 hours")


@query(
    "stream_window_drop",
    f"""WITH w AS (
          SELECT event_type, value * 100 AS p, ts, CAST(date_trunc('hour', ts) AS TIMESTAMP)
                   - k * INTERVAL 6 HOUR - (hour(ts) % 6) * INTERVAL 1 HOUR AS window_start
          FROM events, unnest(range(0, 4)) AS s(k)),
        a AS (SELECT window_start, event_type, avg(p) AS mean_value, max_by(p, ts) AS last_value
              FROM w GROUP BY ALL)
        SELECT window_start, event_type, {r('mean_value')}, {r('last_value')},
               mean_value - last_value > 500 AS is_pressure_drop FROM a""",
)
def stream_window_drop(spark, sf):
    out, checkpoint = scratch_path(spark, "drop"), scratch_path(spark, "drop-checkpoint")
    readings = source(spark, sf, "events").withColumn("p", F.col("value") * 100)
    drops = window_drop(readings, "ts", ["event_type"], "p", "24 hours", "6 hours", "60 days")
    start_windowed_kpi(drops, out, checkpoint).awaitTermination()
    return rounded(latest_state(spark, out, ["window_start", "event_type"]).drop("window_end"))


@query(
    "stream_alerts",
    f"""WITH p AS (SELECT *, CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END AS oil,
                   CASE WHEN l_tax = 0 THEN -1 ELSE l_extendedprice / 100 END AS p FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, {r('oil', 'BORE_OIL_VOL')},
               {r('p', 'AVG_DOWNHOLE_PRESSURE')}, oil = 0 AND l_linenumber > 0 AS is_zero_prod_uptime,
               p BETWEEN 0 AND 10000 AS is_pressure_valid
        FROM p WHERE oil = 0 OR NOT p BETWEEN 0 AND 10000""",
)
def stream_alerts(spark, sf):
    out, checkpoint = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-checkpoint")
    rows = source(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0.0).alias("BORE_OIL_VOL"),
        F.col("l_linenumber").cast("double").alias("ON_STREAM_HRS"),
        F.when(F.col("l_tax") == 0, -1.0)
        .otherwise(F.col("l_extendedprice") / 100)
        .alias("AVG_DOWNHOLE_PRESSURE"),
    )
    start_alerts(production_alerts(rows), out, checkpoint).awaitTermination()
    return rounded(spark.read.parquet(out).drop("ON_STREAM_HRS"))


FILES_A_PART = 4


def landed_in_parts(spark, events):
    """Rows as a stream of three micro-batches, in time order, of several files each.

    Rows without a time come first.
    """
    landing = scratch_path(spark, "landing")
    edges = [F.lit(x).cast("timestamp_ntz") for x in ("2024-01-11", "2024-01-21")]
    part = F.when(F.col("ts") >= edges[1], 2).when(F.col("ts") >= edges[0], 1).otherwise(0)
    for n in range(3):
        events.filter(part == n).repartition(FILES_A_PART, "event_id").write.parquet(f"{landing}/part-{n}")
    return read_landing(spark, f"{landing}/*/*.parquet", events.schema, files_per_trigger=FILES_A_PART)


@query(
    "stream_state",
    f"""WITH f AS (
          SELECT event_id, user_id, value, lag(value, 1) OVER w AS lag1, lag(value, 2) OVER w AS lag2,
                 avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean_7
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        SELECT event_id, user_id, {r('lag1')}, {r('abs(value - lag1)', 'delta')}, {r('mean_7')},
               coalesce(value = lag1 AND lag1 = lag2, false) AS is_flatline FROM f""",
)
def stream_state(spark, sf):
    """Consecutive readings over three micro-batches of several files, written in time order."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    stream = landed_in_parts(spark, events)
    out, checkpoint = scratch_path(spark, "readings"), scratch_path(spark, "readings-checkpoint")
    measures = [Lag("value", "lag1", 1), Lag("value", "lag2", 2), Trailing("value", "mean_7", 7)]
    start_reading_rules(stream, measures, out, checkpoint, READINGS).awaitTermination()
    rows = measured_readings(spark, out)
    return rounded(
        rows.select(
            "event_id",
            "user_id",
            "lag1",
            kpis.change("value", "lag1").alias("delta"),
            "mean_7",
            kpis.flatline("value", "lag1", "lag2").alias("is_flatline"),
        )
    )


@query(
    "stream_closed_windows",
    f"""SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type,
               count(*) AS n_events, {r('sum(value)', 'total')}, {r('avg(value)', 'mean')}
        FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
)
def stream_closed_windows(spark, sf):
    """Daily windows, each written once when it is closed; a closing row ends the stream."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    dealt, out = scratch_path(spark, "dealt"), scratch_path(spark, "closed")
    start_dealing(landed_in_parts(spark, events), "ts", dealt, f"{dealt}-checkpoint").awaitTermination()
    for last in (False, True):
        if last:
            close_windows(spark, dealt, events.schema, "ts")
        kpi = windowed_kpi(
            rows_in_time(spark, dealt, events.schema, FILES_A_PART),
            "ts",
            ["event_type"],
            {"n_events": F.count(F.lit(1)), "total": F.sum("value"), "mean": F.avg("value")},
        )
        start_closed_windows(kpi, out, f"{out}-checkpoint").awaitTermination()
    return rounded(spark.read.parquet(out).drop("window_end"))
