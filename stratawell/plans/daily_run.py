"""The daily chain: sources, bronze, silver, quality gate, gold, scoring, serving, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stratawell.config import WELLS_IN_SCOPE
from stratawell.ml import scoring, training
from stratawell.operators import quality
from stratawell.operators.quality import enforce_gate, gate_checks
from stratawell.plans import bronze, gold, incremental, quality_states, routing, serving, silver, suites
from stratawell.plans.reconcile import block_serving, mark_stored, marked_refresh
from stratawell.session import materialize
from stratawell.sinks.tables import Lake
from stratawell.sources.production import count_source_files, read_csv_sheet, read_workbooks
from stratawell.sources.trajectory import read_trajectories, split_unreadable

DAY_KEYS = ["well_id", "DATEPRD"]
YEAR = ["date_year"]


@dataclass(frozen=True)
class Sources:
    """Where the raw files are; ``sheet_format`` is ``xlsx`` or ``csv``."""

    production: str
    surveys: str
    sheet_format: str = "xlsx"
    wells: Sequence[str] = WELLS_IN_SCOPE


@dataclass
class DayResult:
    rows: dict[str, int] = field(default_factory=dict)
    years: dict[str, set[int]] = field(default_factory=dict)  # of gold, written again
    scoring: dict | None = None
    skipped: dict[str, str] = field(default_factory=dict)


def load_bronze(lake: Lake, sources: Sources) -> dict[str, int]:
    spark = lake.spark
    if count_source_files(spark, sources.production) == 0:
        raise FileNotFoundError(f"no files below {sources.production}")
    read = read_workbooks if sources.sheet_format == "xlsx" else read_csv_sheet
    sheet = read(spark, sources.production)
    # Written once: the readable and the unreadable ones are stored apart.
    found = materialize(read_trajectories(spark, sources.surveys, sources.wells))
    documents, unreadable = split_unreadable(found)
    return {
        "bronze.unreadable_surveys": lake.refresh("bronze.unreadable_surveys", unreadable),
        "bronze.raw_production": marked_refresh(
            lake, "bronze.raw_production", bronze.bronze_production(sheet, sources.wells),
            partition_by=YEAR, cluster_by=["well_id"],
        ),
        "bronze.raw_witsml_trajectory": marked_refresh(
            lake, "bronze.raw_witsml_trajectory", bronze.bronze_trajectory(documents),
            cluster_by=["well_id"], rows=F.json_array_length("trajectory_stations_json"),
        ),
    }


def load_silver(lake: Lake, route: bool = False, run_date=None) -> dict[str, int]:
    """Typed tables; with ``route``, rows that break a rule go to quarantine instead."""
    rows, routed = lake.read("bronze.raw_production"), {}
    if route:
        at = F.current_date() if run_date is None else F.lit(run_date).cast("date")
        rows, actions = routing.route_production(lake, rows, at)
        routed = {routing.QUARANTINE: actions["new"]}
    production = silver.silver_production(rows)
    stations = silver.silver_trajectory(lake.read("bronze.raw_witsml_trajectory"))
    return routed | {
        "silver.cleaned_production": marked_refresh(
            lake, "silver.cleaned_production", production, DAY_KEYS, YEAR, DAY_KEYS
        ),
        "silver.cleaned_trajectory": marked_refresh(
            lake, "silver.cleaned_trajectory", stations, cluster_by=["well_id", "md_m"]
        ),
    }


def run_quality(lake: Lake, names: Sequence[str] | None = None) -> DataFrame:
    """Run suites over stored tables and append to the result history.

    Only partitions with new files are read.
    """
    parts = [quality_states.evaluate_stored(lake, s)[0] for s in suites.select_suites(names)]
    evaluated = reduce(DataFrame.unionByName, parts)
    rows = quality.suite_rows(evaluated)
    lake.append("silver.dq_results", rows)
    return evaluated


def check_gate(lake: Lake) -> None:
    """Raise unless silver passes the fixed checks."""
    enforce_gate(
        gate_checks(lake.read("silver.cleaned_production"), lake.read("silver.cleaned_trajectory"))
    )


def load_gold(lake: Lake) -> dict[str, int]:
    """Both gold tables from all of silver, and the totals that later changes build on."""
    production = lake.read("silver.cleaned_production")
    stations = lake.read("silver.cleaned_trajectory")
    rows = {
        "gold.production_daily": marked_refresh(
            lake, "gold.production_daily", gold.production_daily(production), DAY_KEYS, YEAR, DAY_KEYS
        ),
        "gold.ml_feature_store": lake.refresh(
            "gold.ml_feature_store", gold.feature_store(production, stations), YEAR, DAY_KEYS
        ),
    }
    incremental.build_totals(lake)
    return rows


def train_models(
    lake: Lake, only: str | None = None, split_mode: str = "time", params: dict | None = None
) -> dict[str, training.Trained]:
    """Train, store and record the models (or one of them) on the stored feature store."""
    features = lake.read("gold.ml_feature_store")
    trained = {}
    for key, spec in training.MODELS.items():
        if only not in (None, key):
            continue
        own = (params or {}).get(key)
        if spec.estimator is None:
            trained[key] = training.train_anomaly(features, spec, own)
        else:
            trained[key] = training.train_regressor(features, spec, split_mode, own)
        training.save_model(lake, trained[key])
    return trained


def load_serving(lake: Lake) -> tuple[dict[str, int], dict[str, str]]:
    """Serving copies; predictions are optional and reported where missing."""
    daily = serving.serving_copy(serving.serving_production(lake.read("gold.production_daily")))
    rows = {"serving.production_daily": lake.refresh("serving.production_daily", daily)}
    skipped = {}
    predictions = lake.read_if_present("gold.ml_predictions")
    if predictions is None:
        skipped["serving.ml_predictions"] = "gold.ml_predictions does not exist yet"
    else:
        copy = serving.serving_copy(serving.serving_predictions(predictions))
        rows["serving.ml_predictions"] = lake.refresh("serving.ml_predictions", copy)
    serving.register_views(
        lake.read("serving.production_daily"), lake.read_if_present("serving.ml_predictions")
    )
    return rows, skipped


def daily_report(lake: Lake, as_of=None) -> tuple[DataFrame, DataFrame | None]:
    predictions = lake.read_if_present("gold.ml_predictions")
    return (
        serving.weekly_report(lake.read("gold.production_daily"), as_of),
        None if predictions is None else serving.recent_anomalies(predictions, as_of),
    )


def run_day(lake: Lake, sources: Sources, as_of=None, days: int = 30, full: bool = False, route: bool = False) -> DayResult:
    """The whole chain; a failed gate stops it before gold.

    The first run computes gold from all of silver, later ones write the years that changes reach;
    ``full`` computes all again. ``route`` sends bad rows to quarantine and lets a failed CRITICAL
    expectation of silver stop the chain too.
    """
    result = DayResult()
    result.rows |= load_bronze(lake, sources)
    result.rows |= load_silver(lake, route, as_of)
    check_gate(lake)
    if route:
        routing.block_on_critical(quality_states.evaluate_stored(lake, suites.SILVER_PRODUCTION)[0])
    if full or not lake.exists(incremental.TOTALS):
        result.rows |= load_gold(lake)
    else:
        result.years = incremental.sync_gold(lake)
        if result.years:
            mark_stored(lake, "gold.production_daily", DAY_KEYS)
    block_serving(lake)
    run_quality(lake)
    if any(training.versions(lake, m.name) for m in training.MODELS.values()):
        result.scoring = scoring.score_recent(lake, days, as_of)
        result.skipped |= result.scoring["skipped"]
    else:
        result.skipped["scoring"] = "no trained models"
    rows, skipped = load_serving(lake)
    result.rows |= rows
    result.skipped |= skipped
    return result
