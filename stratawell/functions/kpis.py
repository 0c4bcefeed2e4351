"""Ratio KPIs, validity flags, alert rules and labels as column expressions.

Flags are never NULL: a rule that cannot be decided counts as not met.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from stratawell.config import RULES, AlertRules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def as_count(condition: Column | str) -> Column:
    """Rows that meet a condition, as an aggregate."""
    return F.count_if(_col(condition))


def any_of(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


# ---- ratios -----------------------------------------------------------------------------------


def water_cut(oil="BORE_OIL_VOL", water="BORE_WAT_VOL") -> Column:
    liquid = _col(oil) + _col(water)
    return F.when(liquid > 0, _col(water) / liquid * 100.0)


def gas_oil_ratio(gas="BORE_GAS_VOL", oil="BORE_OIL_VOL") -> Column:
    return F.when(_col(oil) > 0, _col(gas) / _col(oil))


def efficiency(oil="BORE_OIL_VOL", hours="ON_STREAM_HRS", depth="total_md_m") -> Column:
    """Oil per running hour and kilometre of depth."""
    return F.when(
        (_col(hours) > 0) & (_col(depth) > 0), _col(oil) / _col(hours) / (_col(depth) / 1000.0)
    )


# ---- validity flags -----------------------------------------------------------------------------


def zero_output_while_running(oil="BORE_OIL_VOL", hours="ON_STREAM_HRS") -> Column:
    return flag((_col(oil) == 0) & (_col(hours) > 0))


def in_range(c: Column | str, low: float, high: float) -> Column:
    return flag(_col(c).between(low, high))


def pressure_valid(p="AVG_DOWNHOLE_PRESSURE", rules: AlertRules = RULES) -> Column:
    return in_range(p, rules.pressure_min, rules.pressure_max)


def at_least_zero(c: Column | str) -> Column:
    return flag(_col(c) >= 0)


# ---- alert rules ----------------------------------------------------------------------------------


def change(now: Column | str, before: Column | str, signed: bool = False) -> Column:
    """Difference to the previous reading; NULL when either is missing."""
    diff = _col(now) - _col(before)
    return diff if signed else F.abs(diff)


def pressure_anomaly(delta: Column | str, rules: AlertRules = RULES) -> Column:
    return flag(_col(delta) > rules.pressure_jump)


def water_cut_spike(now: Column | str, before: Column | str, rules: AlertRules = RULES) -> Column:
    return flag((_col(now) > rules.water_cut_high) & (_col(before) < rules.water_cut_low))


def gor_anomaly(gor: Column | str, baseline: Column | str, rules: AlertRules = RULES) -> Column:
    base = _col(baseline)
    return flag((base > 0) & (_col(gor) > base * rules.gor_factor))


def pressure_drop(p: Column | str, mean_before: Column | str, rules: AlertRules = RULES) -> Column:
    return flag(_col(mean_before) - _col(p) > rules.pressure_jump)


def flatline(now: Column | str, lag1: Column | str, lag2: Column | str) -> Column:
    """Three equal readings in a row."""
    return flag((_col(now) == _col(lag1)) & (_col(lag1) == _col(lag2)))


# ---- labels -----------------------------------------------------------------------------------------

ALERT_FLAGS = ("is_anomaly_pressure", "is_zero_prod_uptime", "is_water_cut_spike", "is_gor_anomaly")


def alert_count(flags=ALERT_FLAGS) -> Column:
    return reduce(lambda a, b: a + b, [_col(f).cast("int") for f in flags])


def alert_severity(
    pressure="is_anomaly_pressure",
    spike="is_water_cut_spike",
    gor="is_gor_anomaly",
    zero="is_zero_prod_uptime",
) -> Column:
    pressure, spike, gor, zero = map(_col, (pressure, spike, gor, zero))
    return (
        F.when(pressure & spike, "CRITICAL")
        .when(pressure | spike | gor, "HIGH")
        .when(zero, "MEDIUM")
        .otherwise("LOW")
    )


def outcome(predicted: Column | str, actual: Column | str, unmatched: str = "TRUE_NEG") -> Column:
    """Confusion label of a row; ``unmatched`` names rows without a prediction."""
    predicted, actual = _col(predicted), _col(actual)
    return (
        F.when(predicted.isNull(), unmatched)
        .when(predicted & actual, "TRUE_POS")
        .when(predicted & ~actual, "FALSE_POS")
        .when(~predicted & actual, "FALSE_NEG")
        .otherwise("TRUE_NEG")
    )
