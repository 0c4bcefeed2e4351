"""The quality suites of each layer. Names, columns and thresholds are fixed values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from stratawell.config import WELLS_IN_SCOPE
from stratawell.operators.quality import Suite, between, in_set, non_negative, not_null, row_count
from stratawell.operators.quarantine import RowRule

BRONZE_PRODUCTION = Suite(
    "bronze_production_suite",
    "bronze.raw_production",
    (
        row_count(),
        not_null("WELL_BORE_CODE", severity="CRITICAL"),
        not_null("DATEPRD", severity="CRITICAL"),
        in_set("well_id", WELLS_IN_SCOPE),
        non_negative("BORE_OIL_VOL"),
        not_null("ingestion_ts", 1.0),
        not_null("source_system", 1.0),
        not_null("source_file", 1.0),
    ),
)

SILVER_PRODUCTION = Suite(
    "silver_production_suite",
    "silver.cleaned_production",
    (
        row_count(),
        not_null("WELL_BORE_CODE", severity="CRITICAL"),
        not_null("DATEPRD", severity="CRITICAL"),
        in_set("well_id", WELLS_IN_SCOPE, severity="CRITICAL"),
        non_negative("BORE_OIL_VOL"),
        between("water_cut_pct", 0, 100),
        between("AVG_DOWNHOLE_PRESSURE", 0, 10000),
        non_negative("gas_oil_ratio"),
        not_null("is_pressure_valid"),
        not_null("is_zero_prod_uptime"),
    ),
)

SILVER_TRAJECTORY = Suite(
    "silver_witsml_suite",
    "silver.cleaned_trajectory",
    (
        row_count(),
        not_null("well_id", severity="CRITICAL"),
        in_set("well_id", WELLS_IN_SCOPE),
        non_negative("md_m"),
        between("incl_deg", 0, 180),
        between("azi_deg", 0, 360, severity="MEDIUM"),
        non_negative("tvd_m"),
        not_null("is_md_valid"),
    ),
)

GOLD_FEATURES = Suite(
    "gold_feature_suite",
    "gold.ml_feature_store",
    (
        row_count(),
        not_null("well_id", severity="CRITICAL"),
        not_null("DATEPRD", severity="CRITICAL"),
        non_negative("BORE_OIL_VOL"),
        not_null("pressure_lag1", 0.70),
        not_null("water_cut_lag1", 0.70),
        not_null("gor_lag1", 0.70),
        not_null("next_day_pressure", 0.70),
        not_null("is_anomaly", 0.90),
    ),
)

# Stricter checks the requirements describe beyond the daily suites.
SILVER_PRODUCTION_STRICT = Suite(
    "silver_production_strict",
    "silver.cleaned_production",
    (
        row_count(1, 100_000, "expect_table_row_count_between"),
        not_null("WELL_BORE_CODE", 1.0, severity="CRITICAL"),
        not_null("DATEPRD", 1.0, severity="CRITICAL"),
        between("AVG_DOWNHOLE_PRESSURE", 0, 10000, 0.99),
        non_negative("BORE_OIL_VOL", 0.99),
        between("ON_STREAM_HRS", 0, 24, 1.0),
        in_set("FLOW_KIND", ("production", "injection", "test"), severity="MEDIUM"),
    ),
)
SILVER_TRAJECTORY_STRICT = Suite(
    "silver_trajectory_strict",
    "silver.cleaned_trajectory",
    (between("md_m", 0, 10000, 1.0), between("incl_deg", 0, 180, 1.0)),
)
GOLD_FEATURES_STRICT = Suite(
    "gold_feature_strict",
    "gold.ml_feature_store",
    (row_count(3, None, "expect_table_row_count_min", severity="CRITICAL"),),
)

DAILY_SUITES = (BRONZE_PRODUCTION, SILVER_PRODUCTION, SILVER_TRAJECTORY, GOLD_FEATURES)
STRICT_SUITES = (SILVER_PRODUCTION_STRICT, SILVER_TRAJECTORY_STRICT, GOLD_FEATURES_STRICT)
SUITES = {s.name: s for s in (*DAILY_SUITES, *STRICT_SUITES)}


def select_suites(names: Iterable[str] | None = None) -> list[Suite]:
    """Suites by name, the daily ones by default; an unknown name is an error."""
    if names is None:
        return list(DAILY_SUITES)
    wanted = [n.strip() for n in names]
    unknown = [n for n in wanted if n not in SUITES]
    if unknown:
        raise ValueError(f"unknown suite(s): {unknown}; available: {list(SUITES)}")
    return [SUITES[n] for n in wanted]


def run_suites(tables: dict[str, DataFrame], names: Iterable[str] | None = None) -> DataFrame:
    """Evaluate suites, each over its table, into one row per suite."""
    parts = [s.evaluate(tables[s.table]) for s in select_suites(names)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def failures_on(results: DataFrame, day, severity: str | None = None) -> DataFrame:
    """Failed expectations of one day from the result history, with the severity they have now."""
    levels = [
        F.lit(x)
        for suite in SUITES.values()
        for e in suite.expectations
        for x in (f"{suite.name}/{e.name}", e.severity)
    ]
    listed = F.from_json(
        "expectations_json",
        "array<struct<name: string, passed: boolean, details: string, actual_value: double, "
        "threshold: double>>",
    )
    failed = (
        results.filter(F.to_date("run_ts") == F.lit(day))
        .select("run_ts", "suite_name", "table_name", F.inline(listed))
        .filter(~F.col("passed"))
        .withColumn(
            "severity", F.create_map(*levels)[F.concat_ws("/", "suite_name", "name")]
        )
    )
    return failed if severity is None else failed.filter(F.col("severity") == severity)


def production_rules() -> list[RowRule]:
    """Row rules of typed production data."""
    c = F.col
    return [
        RowRule("WELL_BORE_CODE is null", c("WELL_BORE_CODE").isNull(), "CRITICAL"),
        RowRule("DATEPRD is null", c("DATEPRD").isNull(), "CRITICAL"),
        RowRule("BORE_OIL_VOL negative", c("BORE_OIL_VOL") < 0, "HIGH"),
        RowRule(
            "AVG_DOWNHOLE_PRESSURE out of range",
            ~c("AVG_DOWNHOLE_PRESSURE").between(0, 10000),
            "HIGH",
        ),
        RowRule("ON_STREAM_HRS out of range", ~c("ON_STREAM_HRS").between(0, 24), "HIGH"),
        RowRule("BORE_OIL_VOL is null", c("BORE_OIL_VOL").isNull(), "MEDIUM"),
        RowRule(
            "FLOW_KIND not in set",
            ~c("FLOW_KIND").isin("production", "injection", "test"),
            "MEDIUM",
        ),
    ]
