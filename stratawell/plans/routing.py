"""Rows that break a rule on their way from bronze to silver, by severity.

CRITICAL and HIGH rows go to a quarantine table, MEDIUM ones go on with ``dq_flag``. A quarantined row
is known by a digest of its sheet columns alone, so that a row that is delivered or loaded again is not
stored twice. Once a record is resolved, the row passes at the next load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratawell.config import SHEET_COLUMNS
from stratawell.operators.quality import GateBlocked, failed_expectations
from stratawell.operators.quarantine import RowRule, action_for, apply_rules, holds_back, quarantine_rows
from stratawell.plans.silver import typed_production
from stratawell.plans.suites import production_rules
from stratawell.session import materialize
from stratawell.sinks.tables import Lake

QUARANTINE = "silver.quarantine"
SOURCE = "silver.cleaned_production"


def typed_beside_raw(bronze: DataFrame) -> DataFrame:
    """Typed rows, with the bronze row as it is in ``_raw``."""
    return typed_production(bronze.withColumn("_raw", F.struct(*[F.col(c) for c in bronze.columns])))


def judged_rows(typed: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    judged = apply_rules(typed, rules)
    return judged.select("_raw.*", "failure_reason", "severity", "dq_flag", action_for("severity").alias("action"))


def judged_production(bronze: DataFrame, rules: Sequence[RowRule] | None = None) -> DataFrame:
    """Bronze rows as they are, with failure_reason, severity, dq_flag and the action of each."""
    return judged_rows(typed_beside_raw(bronze), production_rules() if rules is None else rules)


def route_production(
    lake: Lake, bronze: DataFrame, run_date: Column, rules: Sequence[RowRule] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """(rows for silver, rows by action); new rows of the quarantine are stored on the way.

    A repeated run stores nothing, and records keep the date of the run that first held them.
    """
    rules = production_rules() if rules is None else rules
    typed, back = typed_beside_raw(bronze), holds_back(rules)
    judged, held, clean = (judged_rows(rows, rules) for rows in (typed, typed.filter(back), typed.filter(~back)))
    data = [c for c in SHEET_COLUMNS if c in bronze.columns] + ["well_id"]
    records = quarantine_rows(
        held.select(*data, "failure_reason", "severity", "dq_flag"), SOURCE, run_date
    ).dropDuplicates(["quarantine_id"])
    lake.create_if_missing(QUARANTINE, records.schema)
    known = lake.read(QUARANTINE)
    fresh = materialize(records.join(known.select("quarantine_id"), "quarantine_id", "left_anti"))
    if not fresh.isEmpty():
        lake.append(QUARANTINE, fresh)

    released = known.filter("resolved").select(F.col("quarantine_id").alias("_id")).distinct()
    row = F.to_json(F.struct(*data), {"ignoreNullFields": "false"})
    own = F.sha2(F.concat_ws("|", F.lit(SOURCE), row), 256)
    through = held.join(released, own == F.col("_id"), "left_semi")
    kept = clean.unionByName(through).drop("failure_reason", "severity", "action")
    by_action = judged.groupBy(F.coalesce("action", F.lit("pass")).alias("action")).count().collect()
    return kept, {r["action"]: r["count"] for r in by_action} | {"new": fresh.count()}


def resolve(lake: Lake, which: Column | str) -> int:
    """Mark quarantined records as resolved; returns how many were not before."""
    records = lake.read(QUARANTINE)
    chosen = (F.expr(which) if isinstance(which, str) else which) & ~F.col("resolved")
    n = records.filter(chosen).count()
    if n:
        marked = records.withColumn("resolved", F.col("resolved") | F.coalesce(chosen, F.lit(False)))
        lake.refresh(QUARANTINE, materialize(marked))
    return n


def block_on_critical(evaluated: DataFrame) -> None:
    """Raise if a CRITICAL expectation of the evaluated suites has failed."""
    failed = failed_expectations(evaluated, "CRITICAL").select("suite_name", "name").collect()  # a few at most
    if failed:
        names = ", ".join(sorted(f"{r['suite_name']}/{r['name']}" for r in failed))
        raise GateBlocked(f"critical expectations failed: {names}")
