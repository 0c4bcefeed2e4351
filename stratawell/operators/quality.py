"""Data-quality suites: every expectation of a suite is measured in one scan of its table.

An expectation names the counts it needs and how they turn into a verdict. A suite asks for all
counts in a single aggregation, whatever the number of expectations. Counts of parts of a table add
up and sketches of distinct values merge, so that parts measured once need not be read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

SUCCESS_SHARE = 0.95

RESULT_DDL = (
    "run_ts timestamp, suite_name string, table_name string, row_count bigint, "
    "n_expectations int, n_passed int, n_failed int, pass_rate double, "
    "suite_success boolean, expectations_json string"
)


@dataclass(frozen=True)
class Check:
    """``counts`` and ``sketches`` are aggregates; the other expressions read them and ``row_count``."""

    counts: dict[str, Column]
    passed: Column
    details: Column
    actual: Column
    sketches: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Expectation:
    """A named check; its expressions are built when a session exists."""

    name: str
    check: Callable[[], Check]
    threshold: float
    severity: str = "HIGH"


def _share(good: Column, total: Column) -> Column:
    return good.cast("double") / F.nullif(total, F.lit(0))


def row_count(
    low: int = 1, high: int | None = None, name="expect_table_row_count_positive", severity="CRITICAL"
) -> Expectation:
    def check() -> Check:
        n = F.col("row_count")
        return Check(
            {},
            n >= low if high is None else n.between(low, high),
            F.concat(F.format_number(n, 0), F.lit(" rows")),
            n.cast("double"),
        )

    return Expectation(name, check, float(low), severity)


def not_null(column: str, mostly: float = 0.95, severity="HIGH") -> Expectation:
    """Share of rows with a value; an empty table has a share of 0."""

    def check() -> Check:
        present, total = F.col(f"present_{column}"), F.col("row_count")
        rate = F.coalesce(_share(present, total), F.lit(0.0))
        return Check(
            {f"present_{column}": F.count(column)},
            rate >= mostly,
            F.format_string("%d of %d rows have a value (%.4f)", present, total, rate),
            F.round(rate, 4),
        )

    return Expectation(f"expect_{column}_not_null_mostly", check, mostly, severity)


def in_set(column: str, allowed: Sequence[str], severity="HIGH") -> Expectation:
    """No value outside the set; NULLs are not looked at."""

    def check() -> Check:
        bad = F.col(f"outside_{column}")
        return Check(
            {f"outside_{column}": F.count_if(~F.col(column).isin(list(allowed)))},
            bad == 0,
            F.concat(bad.cast("string"), F.lit(f" values are none of: {', '.join(allowed)}")),
            bad.cast("double"),
        )

    return Expectation(f"expect_{column}_in_set", check, 0.0, severity)


def _range_check(
    name: str, column: str, bad: Callable[[Column], Column], mostly, wanted: str, severity
) -> Expectation:
    """Share of present values that are not ``bad``; text is read as a number first."""

    def check() -> Check:
        some, wrong = F.col(f"some_{name}"), F.col(f"wrong_{name}")
        rate = F.lit(1.0) - _share(wrong, some)
        empty = some == 0
        return Check(
            {
                f"some_{name}": F.count(column),
                f"wrong_{name}": F.count_if(bad(F.col(column).try_cast("double"))),
            },
            empty | (rate >= mostly),
            F.when(empty, F.lit("no values to judge")).otherwise(
                F.format_string(f"%d of %d values are not {wanted} (%.4f are)", wrong, some, rate)
            ),
            F.round(rate, 4),
        )

    return Expectation(name, check, mostly, severity)


def non_negative(column: str, mostly: float = 0.95, severity="HIGH") -> Expectation:
    return _range_check(
        f"expect_{column}_non_negative",
        column,
        lambda v: v < 0,
        mostly,
        "at least 0",
        severity,
    )


def between(column: str, low, high, mostly: float = 0.95, severity="HIGH") -> Expectation:
    return _range_check(
        f"expect_{column}_between_{low}_{high}",
        column,
        lambda v: (v < low) | (v > high),
        mostly,
        f"within {low} to {high}",
        severity,
    )


def distinct_between(columns: Sequence[str], low: int, high: int | None = None, severity="HIGH") -> Expectation:
    """Number of distinct combinations of values, by a sketch that is off by some percent at most.

    NULL is a value here. The sketch has a few kilobytes whatever the size of the table.
    """
    name = "_".join(columns)

    def check() -> Check:
        n = F.hll_sketch_estimate(f"sketch_{name}")
        return Check(
            {},
            n >= low if high is None else n.between(low, high),
            F.format_string("about %d distinct", n),
            n.cast("double"),
            {f"sketch_{name}": F.hll_sketch_agg(F.xxhash64(*columns))},
        )

    return Expectation(f"expect_{name}_distinct_between", check, float(low), severity)


@dataclass(frozen=True)
class Suite:
    name: str
    table: str
    expectations: Sequence[Expectation] = field(default_factory=tuple)

    def _aggregates(self) -> tuple[dict[str, Column], dict[str, Column]]:
        checks = [e.check() for e in self.expectations]
        counts = {"row_count": F.count(F.lit(1))} | {k: c for check in checks for k, c in check.counts.items()}
        return counts, {k: c for check in checks for k, c in check.sketches.items()}

    def measure(self, df: DataFrame, *by: Column) -> DataFrame:
        """All counts and sketches in one scan, of the whole table or of each group."""
        counts, sketches = self._aggregates()
        return df.groupBy(*by).agg(*[c.alias(k) for k, c in (counts | sketches).items()])

    def merge(self, states: DataFrame) -> DataFrame:
        """The measures of a table from those of its parts."""
        counts, sketches = self._aggregates()
        return states.agg(
            *[F.coalesce(F.sum(k), F.lit(0)).cast("long").alias(k) for k in counts],
            *[F.hll_union_agg(k).alias(k) for k in sketches],
        )

    def evaluate(self, df: DataFrame) -> DataFrame:
        """One row: the row count and an array with the verdict of each expectation."""
        return self.judge(self.measure(df))

    def judge(self, measured: DataFrame) -> DataFrame:
        """The verdicts from one row of measures."""
        checks = [(e, e.check()) for e in self.expectations]
        verdicts = F.array(
            *[
                F.struct(
                    F.lit(e.name).alias("name"),
                    F.coalesce(check.passed, F.lit(False)).alias("passed"),
                    check.details.alias("details"),
                    check.actual.alias("actual_value"),
                    F.lit(e.threshold).alias("threshold"),
                    F.lit(e.severity).alias("severity"),
                )
                for e, check in checks
            ]
        )
        return measured.select(
            F.lit(self.name).alias("suite_name"),
            F.lit(self.table).alias("table_name"),
            "row_count",
            verdicts.alias("expectations"),
        )


def expectation_rows(evaluated: DataFrame) -> DataFrame:
    """One row per expectation."""
    return evaluated.select(
        "suite_name", "table_name", "row_count", F.inline("expectations")
    )


def suite_rows(evaluated: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """One row per suite, shaped like the result history."""
    verdicts = F.col("expectations")
    n = F.size(verdicts)
    good = F.size(F.filter(verdicts, lambda e: e["passed"]))
    rate = F.when(n > 0, good / n).otherwise(F.lit(0.0))
    listed = F.transform(
        verdicts,
        lambda e: F.struct(
            e["name"].alias("name"),
            e["passed"].alias("passed"),
            e["details"].alias("details"),
            e["actual_value"].alias("actual_value"),
            e["threshold"].alias("threshold"),
        ),
    )
    return evaluated.select(
        (F.current_timestamp() if run_ts is None else run_ts).alias("run_ts"),
        "suite_name",
        "table_name",
        "row_count",
        n.alias("n_expectations"),
        good.alias("n_passed"),
        (n - good).alias("n_failed"),
        F.round(rate, 6).alias("pass_rate"),
        (rate >= SUCCESS_SHARE).alias("suite_success"),
        F.to_json(listed, {"ignoreNullFields": "false"}).alias("expectations_json"),
    )


def failed_expectations(evaluated: DataFrame, severity: str | None = None) -> DataFrame:
    rows = expectation_rows(evaluated).filter(~F.col("passed"))
    return rows if severity is None else rows.filter(F.col("severity") == severity)


def alert_levels(evaluated: DataFrame, quarantined_share: Column | float = 0.0) -> DataFrame:
    """Alert level of each suite, the most severe rule first."""
    share = quarantined_share if isinstance(quarantined_share, Column) else F.lit(quarantined_share)
    verdicts = F.col("expectations")
    rate = F.size(F.filter(verdicts, lambda e: e["passed"])) / F.size(verdicts)
    critical = F.exists(verdicts, lambda e: ~e["passed"] & (e["severity"] == "CRITICAL"))
    return evaluated.select(
        "suite_name",
        F.round(rate, 6).alias("pass_rate"),
        F.when(critical, "CRITICAL")
        .when((rate < 0.90) | (share > 0.05), "HIGH")
        .when(rate < 0.95, "WARNING")
        .otherwise("OK")
        .alias("alert_level"),
    )


# ---- gate ---------------------------------------------------------------------------------------


class GateBlocked(RuntimeError):
    """Raised when a check of the gate is not true."""


def gate_checks(production: DataFrame, trajectory: DataFrame) -> DataFrame:
    """The five fixed checks before gold, one aggregate per table; NULL counts as failed."""
    n = F.count(F.lit(1))

    def percent(condition: Column) -> Column:
        return F.count_if(condition) * 100.0 / F.nullif(n, F.lit(0))

    wc = F.col("water_cut_pct")
    checks = {
        "silver_prod_row_count": n > 100,
        "silver_prod_dateprd_null": percent(F.col("DATEPRD").isNull()) < 5,
        "silver_prod_well_null": percent(F.col("well_id").isNull()) < 5,
        "silver_prod_water_cut_range": percent((wc < 0) | (wc > 100)) < 10,
    }
    return _check_rows(production, checks).unionByName(
        _check_rows(trajectory, {"silver_traj_row_count": n > 0})
    )


def _check_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(k) for k, c in checks.items()]).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("check_name"),
                        F.coalesce(F.col(k), F.lit(False)).alias("passed"),
                    )
                    for k in checks
                ]
            )
        )
    )


def enforce_gate(checks: DataFrame) -> None:
    failed = [r["check_name"] for r in checks.filter(~F.col("passed")).collect()]
    if failed:
        raise GateBlocked("gate blocked, failed checks: " + ", ".join(sorted(failed)))
