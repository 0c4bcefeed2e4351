"""Row-frame measures over the daily series."""

from pyspark.sql import functions as F

from stratawell.config import Series
from stratawell.functions import kpis
from stratawell.operators.frames import (
    Lag,
    Lead,
    Overall,
    Running,
    Trailing,
    with_duration_mean,
    with_frames,
)
from stratawell.plans.gold import DAILY_MEASURES, FEATURE_MEASURES
from stratawell.registry.base import query, r, rounded, rs
from stratawell.registry.fixtures import (
    GOLD_SQL,
    SILVER_SQL,
    baseline_sql,
    lag_sql,
    lead_sql,
    running_sql,
    silver,
    trailing_sql,
)

P, O, G, W = "AVG_DOWNHOLE_PRESSURE", "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL"
WC, GOR = "water_cut_pct", "gas_oil_ratio"
KEYS = ("well_id", "DATEPRD")


def frames(spark, sf, measures, **options):
    base = silver(spark, sf).select(*KEYS, "WELL_BORE_CODE", P, O, G, W, WC, GOR)
    out = with_frames(base, measures, **options)
    return rounded(out.select(*KEYS, *[m.name for m in measures]))


def framed_sql(**columns):
    return f"WITH {SILVER_SQL} SELECT well_id, DATEPRD, " + ", ".join(
        r(expr, name) for name, expr in columns.items()
    ) + " FROM silver"


@query(
    "lag_features",
    framed_sql(
        pressure_lag1=lag_sql(P), pressure_lag2=lag_sql(P, 2), pressure_lag3=lag_sql(P, 3),
        pressure_lag7=lag_sql(P, 7), water_cut_lag1=lag_sql(WC), gor_lag1=lag_sql(GOR),
    ),
)
def lag_features(spark, sf):
    return frames(spark, sf, [m for m in FEATURE_MEASURES if isinstance(m, Lag)])


@query("lead_target", framed_sql(next_day_pressure=lead_sql(P)))
def lead_target(spark, sf):
    return frames(spark, sf, [Lead(P, "next_day_pressure")])


@query("partition_baseline", framed_sql(baseline_gor=baseline_sql(GOR)))
def partition_baseline(spark, sf):
    return frames(spark, sf, [Overall(GOR, "baseline_gor")])


@query(
    "expanding_baseline",
    framed_sql(
        baseline_gor=f"avg({GOR}) OVER (PARTITION BY well_id ORDER BY DATEPRD "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ),
)
def expanding_baseline(spark, sf):
    return frames(spark, sf, [Overall(GOR, "baseline_gor", expanding=True)])


@query(
    "rolling_7",
    framed_sql(
        oil_vol_7d_avg=trailing_sql("avg", O, 7), gas_vol_7d_avg=trailing_sql("avg", G, 7),
        wat_vol_7d_avg=trailing_sql("avg", W, 7), pressure_7d_avg=trailing_sql("avg", P, 7),
        water_cut_7d_avg=trailing_sql("avg", WC, 7), gor_7d_avg=trailing_sql("avg", GOR, 7),
    ),
)
def rolling_7(spark, sf):
    daily = [m for m in DAILY_MEASURES if isinstance(m, Trailing) and m.rows == 7]
    return frames(spark, sf, [*daily, Trailing(GOR, "gor_7d_avg", 7)])


@query(
    "rolling_30",
    framed_sql(
        oil_vol_30d_avg=trailing_sql("avg", O, 30), gas_vol_30d_avg=trailing_sql("avg", G, 30),
        pressure_30d_avg=trailing_sql("avg", P, 30), water_cut_30d_avg=trailing_sql("avg", WC, 30),
        gor_30d_avg=trailing_sql("avg", GOR, 30),
    ),
)
def rolling_30(spark, sf):
    daily = [m for m in DAILY_MEASURES if isinstance(m, Trailing) and m.rows == 30]
    return frames(spark, sf, [*daily, Trailing(GOR, "gor_30d_avg", 30)])


@query(
    "rolling_std_7",
    framed_sql(
        pressure_7d_std=trailing_sql("stddev_samp", P, 7),
        oil_vol_7d_std=trailing_sql("stddev_samp", O, 7),
    ),
)
def rolling_std_7(spark, sf):
    return frames(
        spark, sf, [m for m in FEATURE_MEASURES if isinstance(m, Trailing) and m.how == "stddev"]
    )


@query(
    "month_to_date",
    framed_sql(cum_oil_vol_monthly=running_sql(O, True), cum_gas_vol_monthly=running_sql(G, True)),
)
def month_to_date(spark, sf):
    return frames(spark, sf, [m for m in DAILY_MEASURES if isinstance(m, Running)])


@query("lifetime_cumulative", framed_sql(cum_oil_vol=running_sql(O), cum_gas_vol=running_sql(G)))
def lifetime_cumulative(spark, sf):
    return frames(spark, sf, [m for m in FEATURE_MEASURES if isinstance(m, Running)])


ALL_SQL = dict(
    pressure_lag7=lag_sql(P, 7), next_day_pressure=lead_sql(P), pressure_7d_avg=trailing_sql("avg", P, 7),
    oil_vol_30d_avg=trailing_sql("avg", O, 30), pressure_7d_std=trailing_sql("stddev_samp", P, 7),
    cum_oil_vol=running_sql(O), cum_gas_vol_monthly=running_sql(G, True), baseline_gor=baseline_sql(GOR),
)
ALL_MEASURES = [
    Lag(P, "pressure_lag7", 7), Lead(P, "next_day_pressure"), Trailing(P, "pressure_7d_avg", 7),
    Trailing(O, "oil_vol_30d_avg", 30), Trailing(P, "pressure_7d_std", 7, how="stddev"),
    Running(O, "cum_oil_vol"), Running(G, "cum_gas_vol_monthly", reset="month"),
    Overall(GOR, "baseline_gor"),
]


@query("block_frames", framed_sql(**ALL_SQL))
def block_frames(spark, sf):
    """The plan for entities too large for one task, forced on every entity."""
    return frames(spark, sf, ALL_MEASURES, strategy="blocks", max_rows=250)


@query(
    "flatline",
    f"""WITH {SILVER_SQL}, lagged AS (
          SELECT well_id, DATEPRD, ON_STREAM_HRS, {lag_sql('ON_STREAM_HRS')} AS a,
                 {lag_sql('ON_STREAM_HRS', 2)} AS b FROM silver)
        SELECT well_id, DATEPRD, coalesce(ON_STREAM_HRS = a AND a = b, false) AS is_flatline
        FROM lagged""",
)
def flatline(spark, sf):
    hours = "ON_STREAM_HRS"
    lagged = with_frames(
        silver(spark, sf).select(*KEYS, "WELL_BORE_CODE", hours),
        [Lag(hours, "lag1"), Lag(hours, "lag2", 2)],
    )
    return lagged.select(*KEYS, kpis.flatline(hours, "lag1", "lag2").alias("is_flatline"))


@query(
    "drop_vs_rolling",
    f"""WITH {SILVER_SQL}, m AS (
          SELECT well_id, DATEPRD, {P} AS p, avg({P}) OVER (PARTITION BY well_id ORDER BY DATEPRD
                 RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS mean_24h
          FROM silver)
        SELECT well_id, DATEPRD, {r('mean_24h')}, coalesce(mean_24h - p > 500, false) AS is_pressure_drop
        FROM m""",
)
def drop_vs_rolling(spark, sf):
    base = silver(spark, sf).select(*KEYS, P)
    mean = with_duration_mean(base, P, "mean_24h", 86_400)
    return rounded(
        mean.select(*KEYS, "mean_24h", kpis.pressure_drop(P, "mean_24h").alias("is_pressure_drop"))
    )


@query(
    "signed_delta",
    f"""WITH {SILVER_SQL}
        SELECT well_id, DATEPRD, {r(f'{P} - {lag_sql(P)}', 'pressure_delta')},
               {r(f'avg({P}) OVER (PARTITION BY well_id ORDER BY DATEPRD ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)', 'pressure_rolling_avg')}
        FROM silver""",
)
def signed_delta(spark, sf):
    base = silver(spark, sf).select(*KEYS, "WELL_BORE_CODE", P)
    out = with_frames(
        base,
        [Lag(P, "before"), Trailing(P, "pressure_rolling_avg", 7, include_current=False)],
    )
    return rounded(
        out.select(
            *KEYS, kpis.change(P, "before", signed=True).alias("pressure_delta"), "pressure_rolling_avg"
        )
    )


@query(
    "pressure_delta",
    f"WITH {GOLD_SQL} SELECT well_id, DATEPRD, {rs('pressure_delta_24h')} FROM gold",
)
def pressure_delta(spark, sf):
    base = silver(spark, sf).select(*KEYS, "WELL_BORE_CODE", P)
    lagged = with_frames(base, [Lag(P, "before")])
    return rounded(lagged.select(*KEYS, kpis.change(P, "before").alias("pressure_delta_24h")))


# Rows whose date is NULL come before all others, as one more day of their well.
UNDATED_SQL = f"""{SILVER_SQL}, part AS (
  SELECT well_id, CASE WHEN day(DATEPRD) = 13 THEN NULL ELSE DATEPRD END AS DATEPRD,
         strftime(DATEPRD, '%Y-%m-%d') AS WELL_BORE_CODE, BORE_OIL_VOL, {P} FROM silver)"""


def undated(spark, sf):
    day = F.col("DATEPRD")
    return silver(spark, sf).select(
        "well_id",
        F.when(F.dayofmonth(day) != 13, day).alias("DATEPRD"),
        day.cast("string").alias("WELL_BORE_CODE"),
        "BORE_OIL_VOL",
        P,
    )


@query(
    "block_frames_null_time",
    f"""WITH {UNDATED_SQL}
        SELECT well_id, WELL_BORE_CODE,
               {r('''sum(BORE_OIL_VOL) OVER (PARTITION BY well_id ORDER BY DATEPRD NULLS FIRST, WELL_BORE_CODE
                     ROWS UNBOUNDED PRECEDING)''', 'life')},
               {r('avg(BORE_OIL_VOL) OVER (PARTITION BY well_id)', 'overall')},
               {r('lag(BORE_OIL_VOL) OVER (PARTITION BY well_id ORDER BY DATEPRD NULLS FIRST, WELL_BORE_CODE)', 'before')}
        FROM part""",
)
def block_frames_null_time(spark, sf):
    """Blocks of large entities, with rows that have no date."""
    measures = [Running("BORE_OIL_VOL", "life"), Overall("BORE_OIL_VOL", "overall"), Lag("BORE_OIL_VOL", "before")]
    out = with_frames(undated(spark, sf), measures, strategy="blocks", max_rows=250)
    return rounded(out.select("well_id", "WELL_BORE_CODE", "life", "overall", "before"))


@query(
    "duration_mean_null_time",
    f"""WITH {UNDATED_SQL}
        SELECT well_id, WELL_BORE_CODE,
               {r(f'''CASE WHEN DATEPRD IS NOT NULL THEN avg({P}) OVER (PARTITION BY well_id ORDER BY DATEPRD
                     RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) END''', 'mean_7d')}
        FROM part""",
)
def duration_mean_null_time(spark, sf):
    """Means over seven days before each row; rows without a date stay, with none."""
    out = with_duration_mean(undated(spark, sf), P, "mean_7d", 7 * 86_400)
    return rounded(out.select("well_id", "WELL_BORE_CODE", "mean_7d"))


@query(
    "drop_hot_entity",
    """WITH e AS (SELECT event_id, floor(epoch(ts))::BIGINT AS s, value FROM events)
       SELECT event_id, round(avg(value) OVER (ORDER BY s RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) + 0.000001, 4)
              AS mean_24h FROM e""",
)
def drop_hot_entity(spark, sf):
    """All events as one entity, cut into blocks."""
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.lit("all").alias("e"), F.col("ts").cast("timestamp").alias("t"), "event_id", "value"
    )
    mean = with_duration_mean(
        events, "value", "mean_24h", 86_400, Series("e", "t", ("event_id",)), max_rows=2_000
    )
    return rounded(mean.select("event_id", "mean_24h"))
