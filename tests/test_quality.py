"""Suites, gate, result rows, alert levels and quarantine."""

import json

import pytest
from pyspark.sql import functions as F

from stratawell.operators import quality as q
from stratawell.operators.quarantine import RowRule, action_for, quarantine_rows, split_rows
from stratawell.plans import quality_states, suites
from stratawell.session import materialize as q_materialized
from stratawell.sinks.tables import Lake


def evaluate(df, *expectations):
    rows = q.expectation_rows(q.Suite("s", "t", expectations).evaluate(df)).collect()
    return {r["name"]: r for r in rows}


def test_not_null_and_row_count(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (4,)], "a int")
    got = evaluate(df, q.row_count(), q.not_null("a", 0.75))
    assert got["expect_table_row_count_positive"]["details"] == "4 rows"
    r = got["expect_a_not_null_mostly"]
    assert (r["passed"], r["actual_value"], r["details"]) == (True, 0.75, "3 of 4 rows have a value (0.7500)")
    assert not evaluate(df, q.not_null("a", 0.76))["expect_a_not_null_mostly"]["passed"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, w string")
    got = evaluate(
        df, q.row_count(), q.not_null("a"), q.in_set("w", ["x"]), q.non_negative("a"), q.between("a", 0, 1)
    )
    passed = {n: r["passed"] for n, r in got.items()}
    assert passed == {
        "expect_table_row_count_positive": False,
        "expect_a_not_null_mostly": False,
        "expect_w_in_set": True,
        "expect_a_non_negative": True,
        "expect_a_between_0_1": True,
    }
    assert got["expect_a_non_negative"]["details"] == "no values to judge"
    assert got["expect_a_not_null_mostly"]["actual_value"] == 0.0


def test_sets_and_ranges(spark):
    df = spark.createDataFrame(
        [("x", "-1"), ("y", "5"), (None, None), ("x", "abc")], "w string, v string"
    )
    got = evaluate(df, q.in_set("w", ["x"]), q.non_negative("v", 0.6), q.between("v", 0, 4, 0.3))
    assert not got["expect_w_in_set"]["passed"]
    assert got["expect_w_in_set"]["details"] == "1 values are none of: x"
    assert got["expect_v_non_negative"]["passed"]
    assert got["expect_v_non_negative"]["details"] == "1 of 3 values are not at least 0 (0.6667 are)"
    assert got["expect_v_between_0_4"]["actual_value"] == 0.3333


def test_one_scan_per_suite(spark, tiny):
    df = spark.read.parquet(f"{tiny}/lineitem.parquet")
    suite = q.Suite("s", "t", tuple(q.not_null(c) for c in df.columns))
    plan = suite.evaluate(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_suite_rows(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    suite = q.Suite("s", "t", (q.row_count(), q.not_null("a"), q.not_null("b")))
    r = q.suite_rows(suite.evaluate(df)).first()
    assert (r["n_expectations"], r["n_passed"], r["n_failed"]) == (3, 2, 1)
    assert r["pass_rate"] == 0.666667 and r["suite_success"] is False and r["run_ts"] is not None
    listed = json.loads(r["expectations_json"])
    assert [set(e) for e in listed] == [{"name", "passed", "details", "actual_value", "threshold"}] * 3
    assert spark.createDataFrame([], q.RESULT_DDL).columns == q.suite_rows(suite.evaluate(df)).columns


def test_suite_sizes_and_selection():
    assert {n: len(s.expectations) for n, s in suites.SUITES.items()} == {
        "bronze_production_suite": 8,
        "silver_production_suite": 10,
        "silver_witsml_suite": 8,
        "gold_feature_suite": 9,
        "silver_production_strict": 7,
        "silver_trajectory_strict": 2,
        "gold_feature_strict": 1,
    }
    assert [s.name for s in suites.select_suites()] == list(suites.SUITES)[:4]
    assert suites.select_suites(["gold_feature_strict"]) == [suites.GOLD_FEATURES_STRICT]
    assert [s.name for s in suites.select_suites([" gold_feature_suite "])] == ["gold_feature_suite"]
    with pytest.raises(ValueError, match="unknown"):
        suites.select_suites(["nope"])


PROD = "DATEPRD date, well_id string, water_cut_pct double"


def gate(spark, n, bad_water=0, traj=1):
    prod = spark.range(n).select(
        F.current_date().alias("DATEPRD"),
        F.lit("F-1").alias("well_id"),
        F.when(F.col("id") < bad_water, 101.0).otherwise(50.0).alias("water_cut_pct"),
    )
    return q.gate_checks(prod, spark.range(traj))


def test_gate(spark):
    q.enforce_gate(gate(spark, 101))
    with pytest.raises(q.GateBlocked, match="silver_prod_row_count"):
        q.enforce_gate(gate(spark, 100))
    with pytest.raises(q.GateBlocked, match="silver_prod_water_cut_range"):
        q.enforce_gate(gate(spark, 200, bad_water=20))
    q.enforce_gate(gate(spark, 200, bad_water=19))
    with pytest.raises(q.GateBlocked, match="silver_traj_row_count"):
        q.enforce_gate(gate(spark, 200, traj=0))


def test_gate_on_empty_table_fails_without_error(spark):
    checks = {r["check_name"]: r["passed"] for r in gate(spark, 0).collect()}
    assert len(checks) == 5 and [n for n, ok in checks.items() if ok] == ["silver_traj_row_count"]


def test_alert_levels(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")

    def level(*expectations, share=0.0):
        return q.alert_levels(q.Suite("s", "t", expectations).evaluate(df), share).first()["alert_level"]

    good, bad = q.not_null("a"), q.not_null("b")
    assert level(good) == "OK"
    assert level(good, share=0.06) == "HIGH"
    assert level(good, bad) == "HIGH"
    true = q.Check({}, F.lit(True), F.lit(""), F.lit(1.0))
    wide = [q.Expectation(f"g{i}", lambda: true, 1.0) for i in range(13)]
    assert level(*wide, bad) == "WARNING"
    assert level(*wide, q.not_null("b", severity="CRITICAL")) == "CRITICAL"
    critical = q.Suite("s", "t", (good, q.not_null("b", severity="CRITICAL"))).evaluate(df)
    assert [r["name"] for r in q.failed_expectations(critical, "CRITICAL").collect()] == [
        "expect_b_not_null_mostly"
    ]


def test_quarantine(spark):
    rows = [("w", 1.0), (None, 1.0), ("w", -1.0), (None, -1.0), ("w", None)]
    df = spark.createDataFrame(rows, "well_id string, v double")
    rules = [
        RowRule("no well", F.col("well_id").isNull(), "CRITICAL"),
        RowRule("negative", F.col("v") < 0, "HIGH"),
        RowRule("missing", F.col("v").isNull(), "MEDIUM"),
    ]
    kept, held = split_rows(df, rules)
    assert sorted((r["v"] is None, r["dq_flag"]) for r in kept.collect()) == [(False, False), (True, True)]
    records = quarantine_rows(held, "silver.t", F.lit("2024-01-01")).collect()
    assert sorted((r["severity"], r["failure_reason"]) for r in records) == [
        ("CRITICAL", "no well"), ("CRITICAL", "no well; negative"), ("HIGH", "negative"),
    ]
    again = quarantine_rows(held.repartition(3), "silver.t", F.lit("2024-01-01")).collect()
    assert {r["quarantine_id"] for r in again} == {r["quarantine_id"] for r in records}
    assert json.loads(records[0]["row_data"]).keys() == {"well_id", "v"}
    assert kept.count() + held.count() == df.count()


def test_actions(spark):
    df = spark.createDataFrame([("CRITICAL",), ("HIGH",), ("MEDIUM",), (None,)], "s string")
    assert [r[0] for r in df.select(action_for("s")).collect()] == ["block", "quarantine", "flag", None]


def test_failures_of_a_day(spark):
    df = spark.createDataFrame(
        [(None, None, "F-2", "1")] * 3,
        "WELL_BORE_CODE string, DATEPRD string, well_id string, BORE_OIL_VOL string",
    ).withColumns({c: F.lit("x") for c in ("ingestion_ts", "source_system", "source_file")})
    evaluated = suites.run_suites({"bronze.raw_production": df}, ["bronze_production_suite"])
    history = q.suite_rows(evaluated, F.timestamp_seconds(F.lit(1_700_000_000)))
    got = suites.failures_on(history, "2023-11-14", "CRITICAL").collect()
    assert sorted(r["name"] for r in got) == [
        "expect_DATEPRD_not_null_mostly", "expect_WELL_BORE_CODE_not_null_mostly",
    ]
    assert suites.failures_on(history, "2023-11-14").count() == 3
    assert suites.failures_on(history, "2023-11-15").count() == 0


def test_states_follow_the_files_of_a_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    suite = q.Suite("s", "silver.t", (q.row_count(), q.not_null("v"), q.non_negative("v"), q.distinct_between(["k"], 1, 60)))

    def rows(year, ids, v="id"):
        df = spark.range(*ids).selectExpr("id AS k", f"CAST({v} AS double) AS v")
        return df.withColumn("date_year", F.lit(year).cast("int"))

    def run():
        verdicts, measured = quality_states.evaluate_stored(lake, suite)
        return {r["name"]: r["actual_value"] for r in q.expectation_rows(verdicts).collect()}, measured

    lake.refresh("silver.t", rows(2020, (0, 10)).unionByName(rows(2021, (5, 25))), ["date_year"])
    got, measured = run()
    assert measured == {"2020", "2021"} and got["expect_table_row_count_positive"] == 30
    assert got["expect_k_distinct_between"] == 25
    assert run() == (got, set())
    # What has been measured is not read again: a state that says otherwise stays.
    states = lake.read(quality_states.state_table(suite))
    moved = states.withColumn("row_count", F.when(F.col("part") == "2020", 1000).otherwise(F.col("row_count")).cast("long"))
    lake.refresh(quality_states.state_table(suite), q_materialized(moved))
    lake.overwrite_partitions("silver.t", rows(2022, (0, 4), "-1").unionByName(rows(None, (0, 2), "NULL")), "date_year")
    got, measured = run()
    assert measured == {"2022", quality_states.NO_VALUE} and got["expect_table_row_count_positive"] == 1026
    assert got["expect_v_non_negative"] == round(1 - 4 / 34, 4)
    lake.drop_partition("silver.t", "date_year", 2022)
    got, measured = run()
    assert measured == set() and got["expect_v_non_negative"] == 1.0
    wider = q.Suite("s", "silver.t", (*suite.expectations, q.not_null("k")))
    verdicts, measured = quality_states.evaluate_stored(lake, wider)
    assert measured == {"2020", "2021", quality_states.NO_VALUE}
    assert q.expectation_rows(verdicts).filter("name like '%row_count%'").first()["actual_value"] == 32


def test_states_of_a_table_without_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    suite = q.Suite("s", "silver.t", (q.row_count(),))
    for n in (3, 5):
        lake.refresh("silver.t", spark.range(n))
        verdicts, measured = quality_states.evaluate_stored(lake, suite)
        assert measured == {""} and verdicts.first()["row_count"] == n
