"""Rows are held back by a condition that judges every rule once."""

from pyspark.sql import functions as F

from stratawell.operators.quarantine import RowRule, apply_rules, holds_back, split_rows
from stratawell.plans import routing
from stratawell.sinks.tables import Lake


def test_held_as_the_severity_says(spark):
    rows = spark.range(30).withColumn("x", F.when(F.col("id") % 7 != 3, F.col("id") - 5))
    rules = [
        RowRule("x null", F.col("x").isNull(), "CRITICAL"), RowRule("x negative", F.col("x") < 0, "HIGH"),
        RowRule("x large", F.col("x") > 20, "MEDIUM"), RowRule("even", F.lit(None).cast("boolean"), "HIGH"),
    ]
    judged = apply_rules(rows.withColumn("held", holds_back(rules)), rules)
    assert judged.filter(F.col("held") != F.coalesce(F.col("severity").isin("CRITICAL", "HIGH"), F.lit(False))).isEmpty()
    kept, held = split_rows(rows, rules)
    assert (kept.count(), held.count()) == (30 - 8, 8)
    assert holds_back([]) is not None and split_rows(rows, [])[0].count() == 30


def test_dates_are_parsed_once_in_the_filter(spark, tmp_path):
    from stratawell.registry.clean import bronze

    kept, _ = routing.route_production(Lake(spark, str(tmp_path)), bronze(spark, "/root/testdata/sf0.001"), F.lit("2024-05-01").cast("date"))
    plan = kept.select("well_id")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "_raw" not in line]
    assert filters and all(line.count("gettimestamp") <= 2 for line in filters)
