"""Row rules: quarantine, flagging, and reconciliation between layers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM")  # most severe first


@dataclass(frozen=True)
class RowRule:
    """A row breaks the rule where ``broken`` is true."""

    reason: str
    broken: Column
    severity: str = "HIGH"


def apply_rules(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Add ``failure_reason`` (all broken rules), the worst ``severity`` and ``dq_flag``.

    Plain conditions only, so the rules stay inside generated code.
    """
    reasons = [F.when(r.broken, F.lit(r.reason)) for r in rules]
    worst = F.lit(None).cast("string")
    for level in reversed(SEVERITIES):
        at_level = [r.broken for r in rules if r.severity == level]
        if at_level:
            broken = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in at_level])
            worst = F.when(broken, level).otherwise(worst)
    return df.withColumns({"failure_reason": F.concat_ws("; ", *reasons), "severity": worst}).withColumn(
        "dq_flag", F.coalesce(F.col("severity") == "MEDIUM", F.lit(False))
    )


def holds_back(rules: Sequence[RowRule]) -> Column:
    """Whether a row goes to quarantine: a CRITICAL or HIGH rule is broken.

    A condition on ``severity`` would be pushed below it, and each rule then judged several times a row.
    """
    broken = [F.coalesce(r.broken, F.lit(False)) for r in rules if r.severity in ("CRITICAL", "HIGH")]
    return reduce(lambda a, b: a | b, broken, F.lit(False))


def split_rows(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """Rows that go on (clean, or flagged as MEDIUM) and rows to quarantine (CRITICAL, HIGH)."""
    held = holds_back(rules)
    kept = apply_rules(df.filter(~held), rules).drop("failure_reason", "severity")
    return kept, apply_rules(df.filter(held), rules)


def quarantine_rows(
    held: DataFrame, source_table: str, run_date: Column, entity: str = "well_id"
) -> DataFrame:
    """Held rows as quarantine records; the id depends only on the row and its table."""
    data = [c for c in held.columns if c not in ("failure_reason", "severity", "dq_flag")]
    row_data = F.to_json(F.struct(*data), {"ignoreNullFields": "false"})
    return held.select(
        F.sha2(F.concat_ws("|", F.lit(source_table), row_data), 256).alias("quarantine_id"),
        F.lit(source_table).alias("source_table"),
        run_date.cast("date").alias("run_date"),
        F.col(entity).alias("well_id"),
        row_data.alias("row_data"),
        "failure_reason",
        "severity",
        F.lit(False).alias("resolved"),
    )


def action_for(severity: Column | str) -> Column:
    """What a failure of each severity leads to."""
    s = F.col(severity) if isinstance(severity, str) else severity
    return (
        F.when(s == "CRITICAL", "block").when(s == "HIGH", "quarantine").when(s == "MEDIUM", "flag")
    )


# ---- reconciliation -------------------------------------------------------------------------------


def missing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have.

    Both sides are reduced to distinct keys before they meet, so a repeated key is shuffled once.
    """
    return (
        left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")
    )


def count_difference(
    source: DataFrame, target: DataFrame, name: str, tolerance: float
) -> DataFrame:
    """Row counts of two layers, their relative difference and whether it is within bounds."""
    n = F.count(F.lit(1))
    both = source.agg(n.alias("source_rows"), F.lit(0).cast("long").alias("target_rows")).unionAll(
        target.agg(F.lit(0).cast("long").alias("source_rows"), n.alias("target_rows"))
    )
    diff = F.abs(F.col("source_rows") - F.col("target_rows")) / F.nullif(
        F.col("source_rows"), F.lit(0)
    )
    return both.agg(
        F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")
    ).select(
        F.lit(name).alias("check_name"),
        "source_rows",
        "target_rows",
        F.round(diff, 6).alias("difference"),
        F.coalesce(diff < tolerance, F.col("source_rows") == F.col("target_rows")).alias("passed"),
    )
