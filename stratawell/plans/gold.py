"""Gold: daily KPIs with rolling measures and alert flags, and the model feature store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratawell.config import (
    FEATURE_BASE_COLUMNS,
    GOLD_BASE_COLUMNS,
    PRODUCTION,
    RULES,
    AlertRules,
    Series,
)
from stratawell.functions import kpis
from stratawell.operators.frames import Lag, Lead, Overall, Running, Trailing, with_frames

PRESSURE, OIL, GAS, WATER = (
    "AVG_DOWNHOLE_PRESSURE", "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL",
)

DAILY_MEASURES = (
    Lag(PRESSURE, "prev_pressure"),
    Lag("water_cut_pct", "prev_water_cut_pct"),
    Overall("gas_oil_ratio", "baseline_gor"),
    Trailing(OIL, "oil_vol_7d_avg", 7),
    Trailing(GAS, "gas_vol_7d_avg", 7),
    Trailing(WATER, "wat_vol_7d_avg", 7),
    Trailing(PRESSURE, "pressure_7d_avg", 7),
    Trailing("water_cut_pct", "water_cut_7d_avg", 7),
    Trailing(OIL, "oil_vol_30d_avg", 30),
    Trailing(GAS, "gas_vol_30d_avg", 30),
    Trailing(PRESSURE, "pressure_30d_avg", 30),
    Trailing("water_cut_pct", "water_cut_30d_avg", 30),
    Running(OIL, "cum_oil_vol_monthly", reset="month"),
    Running(GAS, "cum_gas_vol_monthly", reset="month"),
)
DAILY_HELPERS = ("prev_pressure", "prev_water_cut_pct", "baseline_gor")

FEATURE_MEASURES = (
    Lag(PRESSURE, "pressure_lag1", 1),
    Lag(PRESSURE, "pressure_lag2", 2),
    Lag(PRESSURE, "pressure_lag3", 3),
    Lag(PRESSURE, "pressure_lag7", 7),
    Lag("water_cut_pct", "water_cut_lag1"),
    Lag("gas_oil_ratio", "gor_lag1"),
    Trailing(PRESSURE, "pressure_7d_avg", 7),
    Trailing(OIL, "oil_vol_7d_avg", 7),
    Trailing("water_cut_pct", "water_cut_7d_avg", 7),
    Trailing("gas_oil_ratio", "gor_7d_avg", 7),
    Trailing(PRESSURE, "pressure_30d_avg", 30),
    Trailing(OIL, "oil_vol_30d_avg", 30),
    Trailing("water_cut_pct", "water_cut_30d_avg", 30),
    Trailing("gas_oil_ratio", "gor_30d_avg", 30),
    Trailing(PRESSURE, "pressure_7d_std", 7, how="stddev"),
    Trailing(OIL, "oil_vol_7d_std", 7, how="stddev"),
    Running(OIL, "cum_oil_vol"),
    Running(GAS, "cum_gas_vol"),
    Overall("gas_oil_ratio", "baseline_gor"),
    Lead(PRESSURE, "next_day_pressure"),
)


def alert_columns(df: DataFrame, rules: AlertRules = RULES) -> DataFrame:
    """Pressure change and the three anomaly flags, from the helper columns."""
    return df.withColumn(
        "pressure_delta_24h", kpis.change(PRESSURE, "prev_pressure")
    ).withColumns(
        {
            "is_anomaly_pressure": kpis.pressure_anomaly("pressure_delta_24h", rules),
            "is_water_cut_spike": kpis.water_cut_spike(
                "water_cut_pct", "prev_water_cut_pct", rules
            ),
            "is_gor_anomaly": kpis.gor_anomaly("gas_oil_ratio", "baseline_gor", rules),
        }
    )


def _baseline(measures, expanding: bool):
    return [
        Overall(m.column, m.name, expanding=True) if expanding and isinstance(m, Overall) else m
        for m in measures
    ]


def production_daily(
    silver: DataFrame,
    series: Series = PRODUCTION,
    rules: AlertRules = RULES,
    expanding_baseline: bool = False,
    processed_ts=None,
    **frames,
) -> DataFrame:
    """One row per silver row. ``expanding_baseline`` keeps the future out of the baseline."""
    base = silver.select(*GOLD_BASE_COLUMNS)
    measured = with_frames(base, _baseline(DAILY_MEASURES, expanding_baseline), series, **frames)
    return daily_rows(measured, rules, processed_ts)


def daily_rows(measured: DataFrame, rules: AlertRules = RULES, processed_ts=None) -> DataFrame:
    """Rows of the daily table from silver rows with ``DAILY_MEASURES``."""
    alerts = alert_columns(measured, rules)
    rolling = [m.name for m in DAILY_MEASURES if m.name not in DAILY_HELPERS]
    return alerts.select(
        *GOLD_BASE_COLUMNS,
        "pressure_delta_24h",
        *rolling,
        "is_anomaly_pressure",
        "is_water_cut_spike",
        "is_gor_anomaly",
        (F.current_timestamp() if processed_ts is None else processed_ts).alias("processed_ts"),
    )


def anomaly_summary(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("well_id", "date_year")
        .agg(
            F.count(F.lit(1)).alias("total_days"),
            kpis.as_count("is_anomaly_pressure").alias("pressure_anomalies"),
            kpis.as_count("is_water_cut_spike").alias("water_cut_spikes"),
            kpis.as_count("is_gor_anomaly").alias("gor_anomalies"),
            kpis.as_count("is_zero_prod_uptime").alias("zero_prod_days"),
            F.round(F.avg("pressure_30d_avg"), 1).alias("avg_pressure_30d"),
            F.round(F.avg("water_cut_30d_avg"), 2).alias("avg_water_cut_30d"),
        )
        .orderBy("well_id", "date_year")
    )


# ---- features ------------------------------------------------------------------------------------------


def trajectory_stats(stations: DataFrame) -> DataFrame:
    """Per well: depth, inclination and dog-leg figures over stations with a valid depth."""
    return (
        stations.filter("is_md_valid")
        .groupBy("well_id")
        .agg(
            F.max("md_m").alias("total_md_m"),
            F.max("tvd_m").alias("max_tvd_m"),
            F.avg(F.when(F.col("is_incl_valid"), F.col("incl_deg"))).alias("avg_incl_deg"),
            F.avg("dls_deg_per_30m").alias("avg_dls"),
            F.count(F.lit(1)).alias("n_survey_stations"),
        )
    )


def join_well_stats(df: DataFrame, stats: DataFrame, entity: str = "well_id") -> DataFrame:
    """Left join of per-well figures; how they travel is decided by their size at run time."""
    return df.join(stats, entity, "left")


def feature_store(
    silver: DataFrame,
    stations: DataFrame,
    series: Series = PRODUCTION,
    rules: AlertRules = RULES,
    expanding_baseline: bool = False,
    processed_ts=None,
    **frames,
) -> DataFrame:
    """Lag, rolling and cumulative features with the three model targets."""
    helper = [c for c in series.order if c not in FEATURE_BASE_COLUMNS and c in silver.columns]
    base = silver.select(*FEATURE_BASE_COLUMNS, *helper)
    measured = with_frames(base, _baseline(FEATURE_MEASURES, expanding_baseline), series, **frames)
    return feature_rows(measured, trajectory_stats(stations), series, rules, processed_ts)


def feature_anomaly(rules: AlertRules = RULES, baseline: str = "baseline_gor") -> Column:
    """The anomaly label of a feature row, given its entity's baseline."""
    return kpis.any_of(
        [
            kpis.pressure_anomaly(kpis.change(PRESSURE, "pressure_lag1"), rules),
            kpis.water_cut_spike("water_cut_pct", "water_cut_lag1", rules),
            kpis.gor_anomaly("gas_oil_ratio", baseline, rules),
        ]
    )


def feature_rows(
    measured: DataFrame, stats: DataFrame, series: Series = PRODUCTION, rules: AlertRules = RULES, processed_ts=None
) -> DataFrame:
    """Rows of the feature store from silver rows with ``FEATURE_MEASURES`` and per-well figures."""
    joined = join_well_stats(measured, stats, series.entity)
    delta = kpis.change(PRESSURE, "pressure_lag1")
    anomaly = feature_anomaly(rules)
    windowed = [
        m.name for m in FEATURE_MEASURES if m.name not in ("baseline_gor", "next_day_pressure")
    ]
    return joined.select(
        *FEATURE_BASE_COLUMNS,
        F.dayofweek(series.time).alias("day_of_week"),
        F.month(series.time).alias("month_num"),
        *windowed,
        delta.alias("pressure_delta_24h"),
        "total_md_m",
        "max_tvd_m",
        "avg_incl_deg",
        "avg_dls",
        "n_survey_stations",
        "next_day_pressure",
        kpis.efficiency().alias("rop_efficiency_score"),
        anomaly.alias("is_anomaly"),
        (F.current_timestamp() if processed_ts is None else processed_ts).alias("processed_ts"),
    )


def target_coverage(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("well_id")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count("next_day_pressure").alias("has_pressure_target"),
            F.count("rop_efficiency_score").alias("has_rop_target"),
            kpis.as_count("is_anomaly").alias("anomaly_count"),
            F.count("total_md_m").alias("has_trajectory"),
            F.round(F.avg("pressure_7d_avg"), 1).alias("avg_pressure_7d"),
            F.round(F.avg("water_cut_7d_avg"), 2).alias("avg_water_cut_7d"),
        )
        .orderBy("well_id")
    )
