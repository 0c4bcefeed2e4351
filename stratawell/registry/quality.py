"""Quality suites, gate, uniqueness, reconciliation, quarantine and alert levels."""

from pyspark.sql import functions as F

from stratawell.operators import quality, quarantine
from stratawell.operators.dedupe import key_uniqueness
from stratawell.plans import quality_states, reconcile, routing, suites
from stratawell.plans.bronze import bronze_trajectory
from stratawell.registry.base import query
from stratawell.registry.clean import CLEAN_SQL, bronze, clean
from stratawell.registry.fixtures import RAW_SQL, SILVER_SQL, STATIONS_SQL, silver, table, trajectory_documents
from stratawell.registry.gold import FEATURES_SQL, features, gold, stations
from stratawell.session import scratch_path
from stratawell.sinks.tables import Lake

ALLOWED = ("F-1", "F-11", "F-12")


# ---- oracle text: one row per expectation -----------------------------------------------------------


def row_sql(name, passed, details, actual, threshold):
    return (
        f"SELECT '{name}' AS name, coalesce({passed}, false) AS passed, {details} AS details, "
        f"CAST({actual} AS DOUBLE) AS actual_value, CAST({threshold} AS DOUBLE) AS threshold FROM t"
    )


def count_sql():
    return row_sql(
        "expect_table_row_count_positive", "count(*) > 0",
        "format('{:,}', count(*)) || ' rows'", "count(*)", 1,
    )


def present_sql(column, mostly=0.95):
    rate = f"coalesce(count({column}) / nullif(count(*), 0), 0)"
    return row_sql(
        f"expect_{column}_not_null_mostly", f"{rate} >= {mostly}",
        f"printf('%d of %d rows have a value (%.4f)', count({column}), count(*), {rate})",
        f"round({rate}, 4)", mostly,
    )


def set_sql(column, allowed=ALLOWED):
    bad = f"count(*) FILTER (WHERE {column} NOT IN {allowed})"
    return row_sql(
        f"expect_{column}_in_set", f"{bad} = 0",
        f"{bad} || ' values are none of: {', '.join(allowed)}'", bad, 0,
    )


def range_sql(name, column, condition, wanted, mostly=0.95):
    bad = f"count(*) FILTER (WHERE {condition})"
    rate = f"(1.0::DOUBLE - {bad}::DOUBLE / nullif(count({column}), 0))"
    return row_sql(
        name, f"count({column}) = 0 OR {rate} >= {mostly}",
        f"CASE WHEN count({column}) = 0 THEN 'no values to judge' ELSE "
        f"printf('%d of %d values are not {wanted} (%.4f are)', {bad}, count({column}), {rate}) END",
        f"round({rate}, 4)", mostly,
    )


def positive_sql(column, mostly=0.95):
    return range_sql(f"expect_{column}_non_negative", column, f"{column} < 0", "at least 0", mostly)


def between_sql(column, low, high, mostly=0.95):
    return range_sql(
        f"expect_{column}_between_{low}_{high}", column, f"{column} < {low} OR {column} > {high}",
        f"within {low} to {high}", mostly,
    )


def suite_sql(source, *rows):
    return f"WITH {source} " + " UNION ALL ".join(rows)


def expectations(suite, df):
    return quality.expectation_rows(suite.evaluate(df)).select(
        "name", "passed", "details", "actual_value", "threshold"
    )


BRONZE_TABLE_SQL = (
    RAW_SQL
    + """, t AS (
  SELECT WELL_BORE_CODE, CASE WHEN no_date THEN NULL ELSE 'text' END AS DATEPRD,
         coalesce(well_id, CASE WHEN WELL_BORE_CODE IS NOT NULL THEN '' END) AS well_id, BORE_OIL_VOL,
         load_no AS ingestion_ts, 'x' AS source_system, source_file
  FROM raw WHERE NOT is_header AND NOT no_date)"""
)
BRONZE_ROWS = [
    count_sql(), present_sql("WELL_BORE_CODE"), present_sql("DATEPRD"), set_sql("well_id"),
    positive_sql("BORE_OIL_VOL"), present_sql("ingestion_ts", 1.0),
    present_sql("source_system", 1.0), present_sql("source_file", 1.0),
]
SILVER_ROWS = [
    count_sql(), present_sql("WELL_BORE_CODE"), present_sql("DATEPRD"), set_sql("well_id"),
    positive_sql("BORE_OIL_VOL"), between_sql("water_cut_pct", 0, 100),
    between_sql("AVG_DOWNHOLE_PRESSURE", 0, 10000), positive_sql("gas_oil_ratio"),
    present_sql("is_pressure_valid"), present_sql("is_zero_prod_uptime"),
]
SILVER_TABLE_SQL = CLEAN_SQL + ", t AS (SELECT * REPLACE (coalesce(well_id, '') AS well_id) FROM kpi)"


@query("dq_suite_bronze", suite_sql(BRONZE_TABLE_SQL, *BRONZE_ROWS))
def dq_suite_bronze(spark, sf):
    return expectations(suites.BRONZE_PRODUCTION, bronze(spark, sf))


@query("dq_suite_silver", suite_sql(SILVER_TABLE_SQL, *SILVER_ROWS))
def dq_suite_silver(spark, sf):
    return expectations(suites.SILVER_PRODUCTION, clean(spark, sf))


@query(
    "dq_suite_trajectory",
    suite_sql(
        STATIONS_SQL + ", t AS (SELECT * FROM survey)",
        count_sql(), present_sql("well_id"), set_sql("well_id"), positive_sql("md_m"),
        between_sql("incl_deg", 0, 180), between_sql("azi_deg", 0, 360), positive_sql("tvd_m"),
        present_sql("is_md_valid"),
    ),
)
def dq_suite_trajectory(spark, sf):
    return expectations(suites.SILVER_TRAJECTORY, stations(spark, sf))


@query(
    "dq_suite_gold",
    suite_sql(
        FEATURES_SQL + ", t AS (SELECT * FROM features)",
        count_sql(), present_sql("well_id"), present_sql("DATEPRD"), positive_sql("BORE_OIL_VOL"),
        present_sql("pressure_lag1", 0.70), present_sql("water_cut_lag1", 0.70),
        present_sql("gor_lag1", 0.70), present_sql("next_day_pressure", 0.70),
        present_sql("is_anomaly", 0.90),
    ),
)
def dq_suite_gold(spark, sf):
    return expectations(suites.GOLD_FEATURES, features(spark, sf))


TRAJECTORY_ROWS = [
    count_sql(), present_sql("well_id"), set_sql("well_id"), positive_sql("md_m"),
    between_sql("incl_deg", 0, 180), between_sql("azi_deg", 0, 360), positive_sql("tvd_m"),
    present_sql("is_md_valid"),
]
GOLD_ROWS = [
    count_sql(), present_sql("well_id"), present_sql("DATEPRD"), positive_sql("BORE_OIL_VOL"),
    present_sql("pressure_lag1", 0.70), present_sql("water_cut_lag1", 0.70),
    present_sql("gor_lag1", 0.70), present_sql("next_day_pressure", 0.70),
    present_sql("is_anomaly", 0.90),
]
STRICT_PRODUCTION_ROWS = [
    row_sql(
        "expect_table_row_count_between", "count(*) BETWEEN 1 AND 100000",
        "format('{:,}', count(*)) || ' rows'", "count(*)", 1,
    ),
    present_sql("WELL_BORE_CODE", 1.0), present_sql("DATEPRD", 1.0),
    between_sql("AVG_DOWNHOLE_PRESSURE", 0, 10000, 0.99), positive_sql("BORE_OIL_VOL", 0.99),
    between_sql("ON_STREAM_HRS", 0, 24, 1.0), set_sql("FLOW_KIND", ("production", "injection", "test")),
]
STRICT_TRAJECTORY_ROWS = [between_sql("md_m", 0, 10000, 1.0), between_sql("incl_deg", 0, 180, 1.0)]
STRICT_GOLD_ROWS = [
    row_sql(
        "expect_table_row_count_min", "count(*) >= 3", "format('{:,}', count(*)) || ' rows'", "count(*)", 3
    )
]


def history_sql(source, suite, rows):
    """The result row of one suite."""
    return f"""SELECT * FROM (WITH {source}, e AS ({' UNION ALL '.join(rows)})
        SELECT '{suite.name}' AS suite_name, '{suite.table}' AS table_name,
               (SELECT count(*) FROM t) AS row_count, CAST(count(*) AS INTEGER) AS n_expectations,
               CAST(count(*) FILTER (WHERE passed) AS INTEGER) AS n_passed,
               CAST(count(*) FILTER (WHERE NOT passed) AS INTEGER) AS n_failed,
               round(count(*) FILTER (WHERE passed) / count(*), 6) AS pass_rate,
               count(*) FILTER (WHERE passed) / count(*) >= 0.95 AS suite_success
        FROM e)"""


SURVEY_TABLE_SQL = STATIONS_SQL + ", t AS (SELECT * FROM survey)"
FEATURE_TABLE_SQL = FEATURES_SQL + ", t AS (SELECT * FROM features)"


def quality_tables(spark, sf):
    return {
        "bronze.raw_production": bronze(spark, sf),
        "silver.cleaned_production": clean(spark, sf),
        "silver.cleaned_trajectory": stations(spark, sf),
        "gold.ml_feature_store": features(spark, sf),
    }


@query(
    "dq_results",
    " UNION ALL ".join(
        history_sql(source, suite, rows)
        for source, suite, rows in (
            (BRONZE_TABLE_SQL, suites.BRONZE_PRODUCTION, BRONZE_ROWS),
            (SILVER_TABLE_SQL, suites.SILVER_PRODUCTION, SILVER_ROWS),
            (SURVEY_TABLE_SQL, suites.SILVER_TRAJECTORY, TRAJECTORY_ROWS),
            (FEATURE_TABLE_SQL, suites.GOLD_FEATURES, GOLD_ROWS),
        )
    ),
)
def dq_results(spark, sf):
    """All daily suites, each over its whole table."""
    evaluated = suites.run_suites(quality_tables(spark, sf))
    return quality.suite_rows(evaluated).drop("run_ts", "expectations_json")


def strict_sql(source, suite, rows):
    return f"SELECT * FROM (WITH {source} SELECT '{suite.name}' AS suite_name, * FROM ({' UNION ALL '.join(rows)}))"


@query(
    "dq_strict",
    " UNION ALL ".join(
        strict_sql(source, suite, rows)
        for source, suite, rows in (
            (SILVER_TABLE_SQL, suites.SILVER_PRODUCTION_STRICT, STRICT_PRODUCTION_ROWS),
            (SURVEY_TABLE_SQL, suites.SILVER_TRAJECTORY_STRICT, STRICT_TRAJECTORY_ROWS),
            (FEATURE_TABLE_SQL, suites.GOLD_FEATURES_STRICT, STRICT_GOLD_ROWS),
        )
    ),
)
def dq_strict(spark, sf):
    evaluated = suites.run_suites(quality_tables(spark, sf), [s.name for s in suites.STRICT_SUITES])
    return quality.expectation_rows(evaluated).drop("table_name", "row_count", "severity")


@query(
    "dq_incremental",
    suite_sql(SILVER_SQL + ", t AS (SELECT *, 'production' AS FLOW_KIND FROM silver)", *SILVER_ROWS),
)
def dq_incremental(spark, sf):
    """Years arrive in two loads and one is written again; only changed years are measured each time."""
    lake = Lake(spark, scratch_path(spark, "quality"))
    name, rows = suites.SILVER_PRODUCTION.table, silver(spark, sf)
    lake.refresh(name, rows.filter("date_year < 1996"), ["date_year"], ["well_id"])
    quality_states.evaluate_stored(lake, suites.SILVER_PRODUCTION)
    wrong = rows.filter("date_year >= 1996").withColumn("BORE_OIL_VOL", -F.col("BORE_OIL_VOL"))
    lake.overwrite_partitions(name, wrong, "date_year", ["well_id"])
    quality_states.evaluate_stored(lake, suites.SILVER_PRODUCTION)
    lake.overwrite_partitions(name, rows.filter("date_year >= 1996"), "date_year", ["well_id"])
    evaluated, _ = quality_states.evaluate_stored(lake, suites.SILVER_PRODUCTION)
    return quality.expectation_rows(evaluated).select("name", "passed", "details", "actual_value", "threshold")


@query(
    "dq_gate",
    f"""WITH {SILVER_SQL}, {STATIONS_SQL}
        SELECT 'silver_prod_row_count' AS check_name, count(*) > 100 AS passed FROM silver
        UNION ALL SELECT 'silver_prod_dateprd_null',
          count(*) FILTER (WHERE DATEPRD IS NULL) * 100.0 / count(*) < 5 FROM silver
        UNION ALL SELECT 'silver_prod_well_null',
          count(*) FILTER (WHERE well_id IS NULL) * 100.0 / count(*) < 5 FROM silver
        UNION ALL SELECT 'silver_prod_water_cut_range',
          count(*) FILTER (WHERE water_cut_pct < 0 OR water_cut_pct > 100) * 100.0 / count(*) < 10 FROM silver
        UNION ALL SELECT 'silver_traj_row_count', count(*) > 0 FROM survey""",
)
def dq_gate(spark, sf):
    return quality.gate_checks(silver(spark, sf), stations(spark, sf))


@query(
    "dq_unique",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
              CAST(sum(n - 1) AS BIGINT) AS n_surplus, count(*) FILTER (WHERE n > 1) AS n_repeated_keys
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def dq_unique(spark, sf):
    return key_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "reconcile_counts",
    f"""WITH {CLEAN_SQL}, c AS (
          SELECT (SELECT count(*) FROM raw WHERE NOT is_header AND NOT no_date) AS source_rows,
                 (SELECT count(*) FROM kpi) AS target_rows)
        SELECT 'bronze_vs_silver_production' AS check_name, source_rows, target_rows,
               round(abs(source_rows - target_rows) / source_rows, 6) AS difference,
               abs(source_rows - target_rows) / source_rows < 0.01 AS passed FROM c""",
)
def reconcile_counts(spark, sf):
    return quarantine.count_difference(
        bronze(spark, sf), clean(spark, sf), "bronze_vs_silver_production", 0.01
    )


@query(
    "reconcile_missing",
    "SELECT o_orderkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def reconcile_missing(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    return quarantine.missing_keys(orders, lines, ["k"])


LOST_DAY = "1996-05-20"


@query(
    "reconcile_gold",
    f"""WITH {SILVER_SQL} SELECT well_id, DATEPRD FROM silver WHERE DATEPRD = DATE '{LOST_DAY}'""",
)
def reconcile_gold(spark, sf):
    """Keys of silver that gold lacks; a day was lost on the way."""
    lake = Lake(spark, scratch_path(spark, "reconcile"))
    kept = gold(spark, sf).filter(F.col("DATEPRD") != F.lit(LOST_DAY).cast("date"))
    reconcile.marked_refresh(lake, "silver.cleaned_production", silver(spark, sf), reconcile.KEYS, ["date_year"])
    reconcile.marked_refresh(lake, "gold.production_daily", kept, reconcile.KEYS, ["date_year"])
    return reconcile.missing_in_gold(lake)


@query(
    "reconcile_trajectory",
    f"""WITH {STATIONS_SQL}, {SILVER_SQL}, c AS (
          SELECT 'bronze_vs_silver_trajectory' AS check_name, count(*) AS source_rows,
                 count(*) FILTER (WHERE md_m >= 100) AS target_rows FROM survey),
        k AS (SELECT 'silver_vs_gold_keys' AS check_name, count(*) AS source_rows, count(*) AS target_rows FROM silver)
        SELECT *, round(abs(source_rows - target_rows) / source_rows, 6) AS difference,
               abs(source_rows - target_rows) / source_rows < 0.05 AS passed FROM c
        UNION ALL SELECT *, 0.0, true FROM k""",
)
def reconcile_trajectory(spark, sf):
    """Stations in the documents of bronze and in silver, from which shallow ones were lost; gold keys."""
    lake = Lake(spark, scratch_path(spark, "reconcile"))
    docs = bronze_trajectory(trajectory_documents(spark, sf))
    reconcile.marked_refresh(
        lake, "bronze.raw_witsml_trajectory", docs, rows=F.json_array_length("trajectory_stations_json")
    )
    reconcile.marked_refresh(lake, "silver.cleaned_trajectory", stations(spark, sf).filter("md_m >= 100"))
    reconcile.marked_refresh(lake, "silver.cleaned_production", silver(spark, sf), reconcile.KEYS, ["date_year"])
    reconcile.marked_refresh(lake, "gold.production_daily", gold(spark, sf), reconcile.KEYS, ["date_year"])
    return reconcile.reconcile(lake)


# ---- quarantine ----------------------------------------------------------------------------------------


def typed_raw(spark, sf):
    """Typed rows before de-duplication, bad ones included."""
    from stratawell.plans.silver import production_kpis, typed_production

    rows = bronze(spark, sf)
    return production_kpis(typed_production(rows)).withColumn(
        "load_no", F.unix_seconds("ingestion_ts")
    )


JUDGED_SQL = (
    RAW_SQL
    + """, judged AS (
  SELECT *, WELL_BORE_CODE IS NULL AS r1, DATEPRD IS NULL AS r2,
         coalesce(AVG_DOWNHOLE_PRESSURE NOT BETWEEN 0 AND 10000, false) AS r3
  FROM raw WHERE NOT is_header AND NOT no_date)"""
)


@query(
    "quarantine",
    f"""WITH {JUDGED_SQL}
        SELECT load_no, 'silver.cleaned_production' AS source_table,
               coalesce(well_id, CASE WHEN WELL_BORE_CODE IS NOT NULL THEN '' END) AS well_id,
               array_to_string(list_filter([CASE WHEN r1 THEN 'WELL_BORE_CODE is null' END,
                 CASE WHEN r2 THEN 'DATEPRD is null' END,
                 CASE WHEN r3 THEN 'AVG_DOWNHOLE_PRESSURE out of range' END],
                 lambda x: x IS NOT NULL), '; ') AS failure_reason,
               CASE WHEN r1 OR r2 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, false AS resolved
        FROM judged WHERE r1 OR r2 OR r3""",
)
def quarantine_query(spark, sf):
    _, held = quarantine.split_rows(typed_raw(spark, sf), suites.production_rules())
    records = quarantine.quarantine_rows(held, "silver.cleaned_production", F.lit(None))
    return records.select(
        F.get_json_object("row_data", "$.load_no").cast("bigint").alias("load_no"),
        "source_table", "well_id", "failure_reason", "severity", "resolved",
    )


@query(
    "dq_quarantine_table",
    f"""WITH {JUDGED_SQL}
        SELECT array_to_string(list_filter([CASE WHEN r1 THEN 'WELL_BORE_CODE is null' END,
                 CASE WHEN r2 THEN 'DATEPRD is null' END,
                 CASE WHEN r3 THEN 'AVG_DOWNHOLE_PRESSURE out of range' END],
                 lambda x: x IS NOT NULL), '; ') AS failure_reason,
               CASE WHEN r1 OR r2 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, DATE '2024-05-01' AS run_date,
               count(DISTINCT (WELL_BORE_CODE, DATEPRD, ON_STREAM_HRS, AVG_DOWNHOLE_PRESSURE,
                 AVG_DOWNHOLE_TEMPERATURE, BORE_OIL_VOL, BORE_GAS_VOL, BORE_WAT_VOL, FLOW_KIND)) AS n_rows,
               (SELECT count(*) FROM judged WHERE NOT (r1 OR r2 OR r3)) AS n_kept
        FROM judged WHERE r1 OR r2 OR r3 GROUP BY ALL""",
)
def dq_quarantine_table(spark, sf):
    """Routed twice: the second run, a day later and with later loads of the same rows, adds nothing."""
    lake, rows = Lake(spark, scratch_path(spark, "routing")), bronze(spark, sf)
    routing.route_production(lake, rows, F.lit("2024-05-01").cast("date"))
    later = rows.withColumn("ingestion_ts", F.col("ingestion_ts") + F.expr("INTERVAL 1 DAY"))
    kept, _ = routing.route_production(lake, later, F.lit("2024-05-02").cast("date"))
    found = lake.read(routing.QUARANTINE).groupBy("failure_reason", "severity", "run_date")
    return found.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_kept", F.lit(kept.count()).cast("long"))


@query(
    "rows_after_quarantine",
    f"""WITH {JUDGED_SQL}
        SELECT coalesce(well_id, '') AS well_id, count(*) AS n_rows, 0 AS n_flagged
        FROM judged WHERE NOT (r1 OR r2 OR r3) GROUP BY ALL""",
)
def rows_after_quarantine(spark, sf):
    kept, _ = quarantine.split_rows(typed_raw(spark, sf), suites.production_rules())
    return kept.groupBy("well_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("dq_flag").cast("int").alias("n_flagged")
    )


@query(
    "alert_level",
    f"""WITH {SILVER_TABLE_SQL}, e AS ({' UNION ALL '.join(SILVER_ROWS)}),
        p AS (SELECT count(*) FILTER (WHERE passed) / count(*) AS rate,
                     bool_or(NOT passed AND name IN ('expect_table_row_count_positive',
                       'expect_WELL_BORE_CODE_not_null_mostly', 'expect_DATEPRD_not_null_mostly',
                       'expect_well_id_in_set')) AS critical FROM e)
        SELECT 'silver_production_suite' AS suite_name, round(rate, 6) AS pass_rate,
               CASE WHEN critical THEN 'CRITICAL' WHEN rate < 0.9 THEN 'HIGH'
                    WHEN rate < 0.95 THEN 'WARNING' ELSE 'OK' END AS alert_level FROM p""",
)
def alert_level(spark, sf):
    return quality.alert_levels(suites.SILVER_PRODUCTION.evaluate(clean(spark, sf)))


@query(
    "failed_critical",
    f"""WITH {SILVER_TABLE_SQL}, e AS ({' UNION ALL '.join(SILVER_ROWS)})
        SELECT name, details FROM e WHERE NOT passed AND name = 'expect_well_id_in_set'""",
)
def failed_critical(spark, sf):
    evaluated = suites.SILVER_PRODUCTION.evaluate(clean(spark, sf))
    return quality.failed_expectations(evaluated, "CRITICAL").select("name", "details")


@query(
    "failed_critical_history",
    f"""WITH {SILVER_TABLE_SQL}, e AS ({' UNION ALL '.join(SILVER_ROWS)})
        SELECT 'silver_production_suite' AS suite_name, name, details FROM e
        WHERE NOT passed AND name = 'expect_well_id_in_set'""",
)
def failed_critical_history(spark, sf):
    """From the stored results of two days, what failed on the second at the severest level."""
    lake = Lake(spark, scratch_path(spark, "history"))
    for day, rows in (("2024-05-01", silver(spark, sf).withColumn("well_id", F.lit("F-1"))), ("2024-05-02", clean(spark, sf))):
        evaluated = suites.SILVER_PRODUCTION.evaluate(rows)
        lake.append("silver.dq_results", quality.suite_rows(evaluated, F.lit(day).cast("timestamp")))
    failed = suites.failures_on(lake.read("silver.dq_results"), "2024-05-02", "CRITICAL")
    return failed.select("suite_name", "name", "details")
