"""Names, thresholds and column lists shared by all layers."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Series:
    """Keys of an entity time series; ``tie`` makes the row order total."""

    entity: str = "well_id"
    time: str = "DATEPRD"
    tie: tuple[str, ...] = ("WELL_BORE_CODE",)

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tie]


@dataclass(frozen=True)
class AlertRules:
    """Fixed thresholds of the quality and anomaly rules."""

    pressure_min: float = 0.0
    pressure_max: float = 10_000.0
    pressure_jump: float = 500.0
    water_cut_high: float = 80.0
    water_cut_low: float = 60.0
    gor_factor: float = 3.0


PRODUCTION = Series()
RULES = AlertRules()

# ---- fixed values: source layout and scope -------------------------------------------------

WELLS_IN_SCOPE = ("F-1", "F-11", "F-12")
ENTITY_PATTERN = "F-[0-9]+"
SHEET_DATE_FORMAT = "dd-MMM-yy"
LOG_NULL_VALUE = -999.25

# Order of the columns in the daily production sheet.
SHEET_COLUMNS = (
    "DATEPRD", "WELL_BORE_CODE", "NPD_WELL_BORE_CODE", "NPD_WELL_BORE_NAME",
    "NPD_FIELD_CODE", "NPD_FIELD_NAME", "NPD_FACILITY_CODE", "NPD_FACILITY_NAME",
    "ON_STREAM_HRS", "AVG_DOWNHOLE_PRESSURE", "AVG_DOWNHOLE_TEMPERATURE", "AVG_DP_TUBING",
    "AVG_ANNULUS_PRESS", "AVG_CHOKE_SIZE_P", "AVG_CHOKE_UOM", "AVG_WHP_P",
    "AVG_WHT_P", "DP_CHOKE_SIZE", "BORE_OIL_VOL", "BORE_GAS_VOL",
    "BORE_WAT_VOL", "BORE_WI_VOL", "FLOW_KIND", "WELL_TYPE",
)
SHEET_TEXT_COLUMNS = (
    "WELL_BORE_CODE", "NPD_WELL_BORE_CODE", "NPD_WELL_BORE_NAME", "NPD_FIELD_CODE",
    "NPD_FIELD_NAME", "NPD_FACILITY_CODE", "NPD_FACILITY_NAME", "AVG_CHOKE_UOM",
    "FLOW_KIND", "WELL_TYPE",
)
SHEET_NUMERIC_COLUMNS = tuple(
    c for c in SHEET_COLUMNS if c != "DATEPRD" and c not in SHEET_TEXT_COLUMNS
)

# Measurements of one survey station, and the flat column each becomes.
STATION_MEASURES = {
    "md": "md_m",
    "incl": "incl_deg",
    "azi": "azi_deg",
    "tvd": "tvd_m",
    "dispNs": "disp_ns_m",
    "dispEw": "disp_ew_m",
    "dls": "dls_deg_per_30m",
    "rateTurn": "rate_turn",
    "rateBuild": "rate_build",
}
STATION_DDL = "ARRAY<STRUCT<_uid: STRING, {}>>".format(
    ", ".join(f"{m}: STRUCT<_VALUE: STRING, _uom: STRING>" for m in STATION_MEASURES)
)

# Path fragment -> document type, first match wins.
DOCUMENT_ROUTES = (
    ("_wellInfo", "well_info"),
    ("_wellboreInfo", "wellbore_info"),
    ("/trajectory/", "trajectory"),
    ("/message/", "messages"),
    ("/bhaRun/", "bha"),
    ("/mudLog/", "mud_log"),
)

# ---- fixed values: columns of the daily table and of the models ------------------------------

GOLD_BASE_COLUMNS = (
    "DATEPRD", "well_id", "WELL_BORE_CODE", "date_year",
    "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL", "BORE_WI_VOL", "ON_STREAM_HRS",
    "AVG_DOWNHOLE_PRESSURE", "AVG_DOWNHOLE_TEMPERATURE", "AVG_ANNULUS_PRESS",
    "AVG_WHP_P", "AVG_WHT_P",
    "water_cut_pct", "gas_oil_ratio", "is_zero_prod_uptime", "is_pressure_valid",
)
FEATURE_BASE_COLUMNS = (
    "DATEPRD", "well_id", "WELL_BORE_CODE", "date_year",
    "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL", "ON_STREAM_HRS",
    "AVG_DOWNHOLE_PRESSURE", "AVG_DOWNHOLE_TEMPERATURE", "AVG_WHP_P", "AVG_ANNULUS_PRESS",
    "water_cut_pct", "gas_oil_ratio", "is_zero_prod_uptime",
)

PRESSURE_FEATURES = (
    "pressure_lag1", "pressure_lag2", "pressure_lag3", "pressure_lag7",
    "pressure_7d_avg", "pressure_30d_avg", "pressure_7d_std",
    "water_cut_pct", "gas_oil_ratio", "water_cut_lag1", "gor_lag1",
    "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL", "ON_STREAM_HRS",
    "AVG_WHP_P", "AVG_ANNULUS_PRESS",
    "day_of_week", "month_num",
    "total_md_m", "max_tvd_m", "cum_oil_vol",
)
EFFICIENCY_FEATURES = (
    "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL", "ON_STREAM_HRS",
    "AVG_DOWNHOLE_PRESSURE", "AVG_WHP_P", "AVG_ANNULUS_PRESS",
    "water_cut_pct", "gas_oil_ratio",
    "pressure_7d_avg", "oil_vol_7d_avg", "water_cut_7d_avg",
    "pressure_30d_avg", "oil_vol_30d_avg",
    "pressure_7d_std", "oil_vol_7d_std",
    "cum_oil_vol", "cum_gas_vol",
    "total_md_m", "max_tvd_m", "avg_incl_deg", "avg_dls",
    "day_of_week", "month_num",
)
ANOMALY_FEATURES = (
    "pressure_delta_24h", "water_cut_pct", "gas_oil_ratio",
    "pressure_7d_avg", "pressure_7d_std", "oil_vol_7d_avg", "water_cut_7d_avg",
    "BORE_OIL_VOL", "BORE_GAS_VOL", "ON_STREAM_HRS",
    "AVG_DOWNHOLE_PRESSURE", "AVG_WHP_P",
)
