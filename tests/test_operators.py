"""De-duplication, medians, splits, nested stations, reconciliation."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from stratawell.operators.dedupe import key_uniqueness, latest_per_key, repeated_keys
from stratawell.operators.medians import column_medians, impute_with
from stratawell.operators.nested import explode_stations, flatten_stations, station_flags
from stratawell.operators.quarantine import count_difference, missing_keys
from stratawell.operators.splits import split_by_entity_time, split_by_position, split_by_time


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z"), ("b", 5, "w"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, ts int, v string")
    once = latest_per_key(df, ["k"], [F.desc("ts")])
    got = {r["k"]: r["v"] for r in once.collect()}
    assert got["a"] == "y" and got["b"] in "zw" and got[None] == "n"
    assert latest_per_key(once, ["k"], [F.desc("ts")]).count() == 3
    again = latest_per_key(df.repartition(3), ["k"], [F.desc("ts")])
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_rank_is_limited_before_the_shuffle(spark, tiny):
    df = spark.read.parquet(f"{tiny}/lineitem.parquet")
    plan = latest_per_key(df, ["l_orderkey"], [F.desc("l_shipdate")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_uniqueness(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    assert key_uniqueness(df, ["k"]).first()[:] == (4, 2, 2, 1)
    assert [tuple(r) for r in repeated_keys(df, ["k"]).collect()] == [(1, 3)]
    assert key_uniqueness(df.limit(0), ["k"]).first()[:] == (0, 0, 0, 0)


@pytest.mark.parametrize("slice_rows", [3, 50, 100_000])
def test_bracketed_medians(spark, slice_rows):
    rng = random.Random(slice_rows)
    n = 3001
    columns = {
        "uniform": [rng.uniform(-5, 5) for _ in range(n)],
        "skewed": [rng.expovariate(1) ** 4 for _ in range(n)],
        "ties": [float(rng.choice([0, 0, 0, 1, 2])) for _ in range(n)],
        "two": [float(i % 2) for i in range(n - 1)] + [None],
        "holes": [rng.gauss(0, 1) if rng.random() < 0.4 else None for _ in range(n)],
        "run_below": [1.0] * (n // 2) + [1 + rng.random() for _ in range(n - n // 2)],
        "run_above": [rng.random() for _ in range(n // 2 + 1)] + [1.0] * (n - n // 2 - 1),
        "between_runs": [0.0] * (n // 2) + [8.0] * (n // 2) + [None],
        "empty": [None] * n,
    }
    df = spark.createDataFrame(
        list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)
    )
    got = column_medians(df, list(columns), small_rows=0, slice_rows=slice_rows)
    for c, values in columns.items():
        present = [v for v in values if v is not None]
        want = statistics.median(present) if present else None
        assert got[c] == (want if want is None else pytest.approx(want)), c


def test_impute(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    medians = column_medians(df, ["a", "b"])
    assert medians == {"a": 2.0, "b": None}
    assert [tuple(r) for r in impute_with(df, medians).collect()] == [(1.0, None), (2.0, None), (3.0, None)]


def day_rows(n, entities):
    return [(f"e{i % entities}", dt.date(2020, 1, 1) + dt.timedelta(days=i // entities)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 7, 101])
def test_split_by_position(spark, n):
    df = spark.createDataFrame(day_rows(n, 3), "well_id string, DATEPRD date").repartition(3)
    train, test = split_by_position(df, ["well_id", "DATEPRD"])
    ordered = sorted(day_rows(n, 3))
    cut = int(0.8 * n)
    assert sorted(map(tuple, train.collect())) == ordered[:cut]
    assert sorted(map(tuple, test.collect())) == ordered[cut:]


def test_split_by_time(spark):
    df = spark.createDataFrame(day_rows(100, 2), "well_id string, DATEPRD date")
    train, test = split_by_time(df)
    assert train.count() == 80 and test.count() == 20
    assert train.agg(F.max("DATEPRD")).first()[0] < test.agg(F.min("DATEPRD")).first()[0]
    marked = split_by_entity_time(df)
    assert marked.groupBy("well_id").agg(F.count_if("is_test")).collect()[0][1] == 10


def test_stations(spark):
    one = '{"_uid":"s1","md":{"_VALUE":"10","_uom":"m"},"extra":1}'
    many = (
        '[{"_uid":"s2","md":{"_VALUE":"-1","_uom":"m"},"incl":{"_VALUE":"181"},"azi":{"_VALUE":"361"}},'
        '{"_uid":"s3","md":{"_VALUE":"deep"},"incl":{"_VALUE":180},"azi":{"_VALUE":"0"}}]'
    )
    rows = [("a", one), ("b", many), ("c", None), ("d", "null"), ("e", "[]"), ("f", "not json")]
    df = spark.createDataFrame(rows, "well_id string, trajectory_stations_json string")
    flat = station_flags(flatten_stations(explode_stations(df)))
    got = {r["station_uid"]: r for r in flat.collect() if r["station_uid"]}
    assert set(got) == {"s1", "s2", "s3"}
    assert got["s1"]["md_m"] == 10.0 and got["s1"]["is_md_valid"] and got["s1"]["md_uom"] == "m"
    assert not got["s1"]["is_incl_valid"]  # missing counts as not valid
    assert not (got["s2"]["is_md_valid"] or got["s2"]["is_incl_valid"] or got["s2"]["is_azi_valid"])
    assert got["s3"]["md_m"] is None and got["s3"]["is_incl_valid"] and got["s3"]["is_azi_valid"]
    assert {r["well_id"] for r in flat.filter("station_uid is null").collect()} <= {"f"}


def test_reconciliation(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    assert [tuple(r) for r in missing_keys(left, right, ["k"]).collect()] == [(2,)]
    row = count_difference(left, right, "c", 0.01).first()
    assert (row["source_rows"], row["target_rows"], row["passed"]) == (3, 1, False)
    same = count_difference(left.limit(0), right.limit(0), "c", 0.01).first()
    assert same["passed"] and same["difference"] is None


@pytest.mark.parametrize("seed", range(4))
def test_bracket_arithmetic(seed):
    """Narrowing at any two values keeps or settles the middle (no Spark needed)."""
    from stratawell.operators.medians import _Bracket

    rng = random.Random(seed)
    for _ in range(300):
        values = sorted(float(rng.randint(0, 6)) for _ in range(rng.randint(1, 30)))
        n = len(values)
        want = (values[(n - 1) // 2], values[n // 2])
        b = _Bracket("v", n, n)
        for _ in range(6):
            if b.done:
                break
            inside = [v for v in values if (b.low is None or v > b.low) and (b.high is None or v < b.high)]
            assert len(inside) == b.size
            if not inside:
                break
            low, high = sorted((rng.choice(inside), rng.choice(inside)))
            b.cut(
                low, high, inside.count(low), sum(low < v < high for v in inside),
                inside.count(high) if high > low else 0, sum(v < low for v in inside),
            )
        if b.first is not None:
            assert b.first == want[0]
        if b.second is not None:
            assert b.second == want[1]
