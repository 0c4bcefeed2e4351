"""Parsing, ratios, flags and labels on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stratawell.functions import kpis
from stratawell.functions.parsing import entity_key, to_day, to_number, without_sentinel


def values(spark, ddl, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


def test_numbers(spark):
    got = values(
        spark, "v string", [("1.5",), ("",), ("abc",), ("1,5",), (None,), ("-3",), ("NaN",)],
        to_number("v"),
    )
    assert got[:6] == [1.5, None, None, None, None, -3.0]
    assert math.isnan(got[6])


@pytest.mark.parametrize(
    "text, day",
    [
        ("07-Apr-14", dt.date(2014, 4, 7)),
        ("07-APR-14", dt.date(2014, 4, 7)),
        ("07-apr-14", dt.date(2014, 4, 7)),
        ("31-Feb-14", None),
        ("2014-04-07", None),
        ("DATEPRD", None),
        (None, None),
    ],
)
def test_days(spark, text, day):
    assert values(spark, "v string", [(text,)], to_day("v")) == [day]


def test_entity_key(spark):
    got = values(
        spark, "v string", [("NO 15/9-F-11 H",), ("F-1 C",), ("no match",), (None,)], entity_key("v")
    )
    assert got == ["F-11", "F-1", "", None]


def test_sentinel(spark):
    assert values(spark, "v double", [(-999.25,), (0.0,), (None,)], without_sentinel("v")) == [
        None, 0.0, None,
    ]


def test_ratios(spark):
    rows = [(1.0, 3.0, 10.0), (0.0, 0.0, 5.0), (None, 1.0, 1.0), (2.0, None, None)]
    df = spark.createDataFrame(rows, "o double, w double, g double")
    got = df.select(kpis.water_cut("o", "w"), kpis.gas_oil_ratio("g", "o")).collect()
    assert [tuple(r) for r in got] == [(75.0, 10.0), (None, None), (None, None), (None, None)]


def test_validity_flags(spark):
    p = [-1.0, 0.0, 10000.0, 10001.0, None, float("nan")]
    assert values(spark, "p double", [(x,) for x in p], kpis.pressure_valid("p")) == [
        False, True, True, False, False, False,
    ]
    rows = [(0.0, 5.0), (0.0, 0.0), (1.0, 5.0), (None, 5.0), (0.0, None)]
    got = values(spark, "o double, h double", rows, kpis.zero_output_while_running("o", "h"))
    assert got == [True, False, False, False, False]


def test_alert_rules(spark):
    df = spark.createDataFrame(
        [(600.0, 90.0, 50.0, 31.0, 10.0), (500.0, 80.0, 60.0, 30.0, 10.0), (None, None, 10.0, None, 0.0)],
        "d double, wc double, prev double, gor double, base double",
    )
    got = df.select(
        kpis.pressure_anomaly("d"), kpis.water_cut_spike("wc", "prev"), kpis.gor_anomaly("gor", "base")
    ).collect()
    assert [tuple(r) for r in got] == [(True, True, True), (False, False, False), (False, False, False)]


def test_severity_and_count(spark):
    rows = [
        (True, False, True, False), (True, False, False, False), (False, False, False, True),
        (False, True, False, False), (False, False, False, False),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{f} boolean" for f in kpis.ALERT_FLAGS))
    got = df.select(kpis.alert_severity(), kpis.alert_count()).collect()
    assert [tuple(r) for r in got] == [
        ("CRITICAL", 2), ("HIGH", 1), ("HIGH", 1), ("MEDIUM", 1), ("LOW", 0),
    ]


def test_outcome(spark):
    rows = [(True, True), (True, False), (False, True), (False, False), (None, True)]
    df = spark.createDataFrame(rows, "p boolean, a boolean")
    got = [r[0] for r in df.select(kpis.outcome("p", "a")).collect()]
    assert got == ["TRUE_POS", "FALSE_POS", "FALSE_NEG", "TRUE_NEG", "TRUE_NEG"]
    assert df.select(kpis.outcome("p", "a", "NO_PRED")).collect()[4][0] == "NO_PRED"


def test_efficiency_guards(spark):
    rows = [(10.0, 5.0, 2000.0), (10.0, 0.0, 2000.0), (10.0, 5.0, None), (10.0, 5.0, 0.0)]
    got = values(spark, "o double, h double, d double", rows, kpis.efficiency("o", "h", "d"))
    assert got == [1.0, None, None, None]


def test_flatline_and_drop(spark):
    rows = [(1.0, 1.0, 1.0), (1.0, 1.0, 2.0), (1.0, 1.0, None)]
    assert values(spark, "a double, b double, c double", rows, kpis.flatline("a", "b", "c")) == [
        True, False, False,
    ]
    got = values(spark, "p double, m double", [(100.0, 601.0), (100.0, 600.0), (100.0, None)],
                 kpis.pressure_drop("p", "m"))
    assert got == [True, False, False]


def test_as_count_ignores_null(spark):
    df = spark.createDataFrame([(True,), (None,), (False,)], "f boolean")
    assert df.agg(kpis.as_count("f"), kpis.as_count(~F.col("f"))).first()[:] == (1, 1)
