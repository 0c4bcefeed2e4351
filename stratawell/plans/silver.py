"""Silver: typed, de-duplicated rows with ratio KPIs and validity flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratawell.config import RULES, SHEET_NUMERIC_COLUMNS, SHEET_TEXT_COLUMNS, AlertRules
from stratawell.functions import kpis
from stratawell.functions.parsing import to_day, to_number
from stratawell.operators.dedupe import latest_per_key
from stratawell.operators.nested import explode_stations, flatten_stations, station_flags

TYPED_ORDER = (
    "DATEPRD", "WELL_BORE_CODE", "NPD_WELL_BORE_CODE", "NPD_WELL_BORE_NAME", "NPD_FIELD_CODE",
    "NPD_FIELD_NAME", "NPD_FACILITY_CODE", "NPD_FACILITY_NAME", "ON_STREAM_HRS",
    "AVG_DOWNHOLE_PRESSURE", "AVG_DOWNHOLE_TEMPERATURE", "AVG_DP_TUBING", "AVG_ANNULUS_PRESS",
    "AVG_CHOKE_SIZE_P", "AVG_CHOKE_UOM", "AVG_WHP_P", "AVG_WHT_P", "DP_CHOKE_SIZE",
    "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL", "BORE_WI_VOL", "FLOW_KIND", "WELL_TYPE",
    "well_id", "date_year", "ingestion_ts", "source_system", "source_file",
)


def typed_production(bronze: DataFrame, day: str | None = None) -> DataFrame:
    """Text to dates and numbers; unreadable numbers become NULL. ``day`` is a column that holds the date already."""
    typed = {c: to_number(c) for c in SHEET_NUMERIC_COLUMNS if c in bronze.columns}
    return bronze.withColumns({"DATEPRD": to_day("DATEPRD") if day is None else F.col(day), **typed})


def production_kpis(df: DataFrame, rules: AlertRules = RULES) -> DataFrame:
    return df.withColumns(
        {
            "water_cut_pct": kpis.water_cut(),
            "gas_oil_ratio": kpis.gas_oil_ratio(),
            "is_zero_prod_uptime": kpis.zero_output_while_running(),
            "is_pressure_valid": kpis.pressure_valid(rules=rules),
        }
    )


def silver_production(
    bronze: DataFrame,
    wells: Sequence[str] | None = None,
    rules: AlertRules = RULES,
    flow_kind: str | None = None,
    raw_text_key: bool = False,
    oil_null_flag: bool = False,
    processed_ts=None,
) -> DataFrame:
    """Latest load per bore code and day, typed, with KPIs and flags.

    ``raw_text_key`` keys the date by its raw text instead of the parsed day. ``flow_kind``
    keeps only rows of that kind. ``oil_null_flag`` adds ``is_oil_null``. The ``dq_flag`` of routed rows
    stays.
    """
    # Rows without a date go with those whose date is unreadable: each condition on the text would make it once more.
    rows = bronze.dropna(subset=["WELL_BORE_CODE"])
    if wells is not None:
        rows = rows.filter(F.col("well_id").isin(list(wells)))
    if flow_kind is not None:
        rows = rows.filter(F.col("FLOW_KIND") == flow_kind)
    rows = rows.withColumn("_day", to_day("DATEPRD")).filter(F.col("_day").isNotNull())
    day_key = "DATEPRD" if raw_text_key else "_day"
    latest = latest_per_key(rows, ["WELL_BORE_CODE", day_key], [F.desc("ingestion_ts")])
    flags = [c for c in ("dq_flag",) if c in latest.columns]
    typed = typed_production(latest, "_day").select(*TYPED_ORDER, *flags)
    silver = production_kpis(typed, rules)
    if oil_null_flag:
        silver = silver.withColumn("is_oil_null", F.col("BORE_OIL_VOL").isNull())
    return silver.withColumn(
        "processed_ts", F.current_timestamp() if processed_ts is None else processed_ts
    )


def silver_trajectory(bronze: DataFrame, processed_ts=None) -> DataFrame:
    """One typed row per survey station."""
    documents = bronze.select(
        "trajectory_uid", "uid_well", "uid_wellbore", "trajectory_name", "name_well",
        "name_wellbore", "well_id", "source_path", "ingestion_ts", "trajectory_stations_json",
    )
    flat = station_flags(flatten_stations(explode_stations(documents)))
    lineage = ["source_path", "ingestion_ts"]
    return flat.select(
        *[c for c in flat.columns if c not in lineage],
        *lineage,
        (F.current_timestamp() if processed_ts is None else processed_ts).alias("processed_ts"),
    )


# ---- load checks -----------------------------------------------------------------------------------


def production_summary(silver: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows, means and flag counts per well and year; ``limit`` gives the first ones only."""
    summary = (
        silver.groupBy("well_id", "date_year")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.avg("water_cut_pct"), 2).alias("avg_water_cut_pct"),
            F.round(F.avg("gas_oil_ratio"), 4).alias("avg_gor"),
            kpis.as_count("is_zero_prod_uptime").alias("zero_prod_days"),
            kpis.as_count(~F.col("is_pressure_valid")).alias("invalid_pressure_rows"),
        )
        .orderBy("well_id", "date_year")
    )
    return summary if limit is None else summary.limit(limit)


def null_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: NULLs per column, named by ``columns`` (column -> output name)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n in columns.items()])


# NULL counts reported after the silver and the feature load.
SILVER_NULLS = {
    "DATEPRD": "null_date",
    "BORE_OIL_VOL": "null_oil_vol",
    "AVG_DOWNHOLE_PRESSURE": "null_pressure",
}
FEATURE_NULLS = {
    "pressure_lag1": "null_pressure_lag1",
    "pressure_7d_avg": "null_pressure_7d",
    "oil_vol_7d_avg": "null_oil_7d",
    "total_md_m": "null_total_md",
    "next_day_pressure": "null_pressure_target",
    "rop_efficiency_score": "null_rop_target",
}


def trajectory_summary(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("well_id")
        .agg(
            F.count_distinct("trajectory_uid").alias("trajectories"),
            F.count(F.lit(1)).alias("total_stations"),
            F.round(F.min("md_m"), 1).alias("min_md_m"),
            F.round(F.max("md_m"), 1).alias("max_md_m"),
            F.round(F.max("tvd_m"), 1).alias("max_tvd_m"),
            kpis.as_count(~F.col("is_md_valid")).alias("invalid_md"),
            kpis.as_count(~F.col("is_incl_valid")).alias("invalid_incl"),
            kpis.as_count(~F.col("is_azi_valid")).alias("invalid_azi"),
        )
        .orderBy("well_id")
    )
