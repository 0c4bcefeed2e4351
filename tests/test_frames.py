"""Row frames: plain and blocked plans against a plain Python loop."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings, strategies as st

from stratawell.config import Series
from stratawell.operators import frames
from stratawell.operators.frames import (
    Lag,
    Lead,
    Overall,
    Running,
    Trailing,
    with_duration_mean,
    with_frames,
)
from stratawell.session import checked_broadcast, row_bound

SERIES = Series("e", "t", ("k",))
MEASURES = [
    Lag("v", "lag1"), Lag("v", "lag7", 7), Lead("v", "lead1"), Lead("v", "lead3", 3),
    Trailing("v", "mean7", 7), Trailing("v", "std7", 7, how="stddev"), Trailing("v", "mean30", 30),
    Trailing("v", "before7", 7, include_current=False),
    Running("v", "life"), Running("v", "month", reset="month"),
    Overall("v", "all"), Overall("v", "upto", expanding=True),
]
DDL = "e string, t date, k int, v double"


def mean(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


def total(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) if xs else None


def deviation(xs):
    xs = [x for x in xs if x is not None]
    return statistics.stdev(xs) if len(xs) > 1 else None


def expected(rows):
    out = {}
    for e in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == e], key=lambda r: r[1:3])
        v = [r[3] for r in own]
        for i, r in enumerate(own):
            month = [x[3] for x in own[: i + 1] if (x[1].year, x[1].month) == (r[1].year, r[1].month)]
            at = lambda j: v[j] if 0 <= j < len(v) else None
            out[r[:3]] = (
                at(i - 1), at(i - 7), at(i + 1), at(i + 3),
                mean(v[max(0, i - 6) : i + 1]), deviation(v[max(0, i - 6) : i + 1]),
                mean(v[max(0, i - 29) : i + 1]), mean(v[max(0, i - 7) : i]),
                total(v[: i + 1]), total(month), mean(v), mean(v[: i + 1]),
            )
    return out


def check(spark, rows, **options):
    df = with_frames(spark.createDataFrame(rows, DDL), MEASURES, SERIES, **options)
    got = {(r["e"], r["t"], r["k"]): tuple(r[m.name] for m in MEASURES) for r in df.collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for key, values in want.items():
        for m, a, b in zip(MEASURES, got[key], values):
            same = a is b if a is None or b is None else abs(a - b) <= 1e-9 * (1 + abs(b))
            assert same, (key, m, a, b)


def make(seed, entities, n, gap=3, ties=3):
    rng = random.Random(seed)
    rows = []
    for e in range(entities):
        day, k = dt.date(2020, 1, 1), 0
        for _ in range(n if e else n * 4):  # the first entity holds a large share
            if rng.random() > 1 / ties:
                day += dt.timedelta(days=rng.randint(1, gap))
            k += 1
            rows.append((f"e{e}", day, k, None if rng.random() < 0.15 else round(rng.uniform(-9, 9), 2)))
    rng.shuffle(rows)
    return rows


def test_plain(spark):
    check(spark, make(1, 3, 40), strategy="plain")


@pytest.mark.parametrize("max_rows", [1, 5, 17, 60, 1000])
def test_blocks_equal_loop(spark, max_rows):
    check(spark, make(2, 3, 40), strategy="blocks", max_rows=max_rows)


def test_blocks_with_joined_layout(spark, monkeypatch):
    """Beyond the broadcast bound the layout is joined; results do not change."""
    monkeypatch.setattr(frames, "checked_broadcast", lambda layout: layout)
    check(spark, make(3, 2, 50), strategy="blocks", max_rows=12)


def test_auto_uses_blocks_for_a_large_entity(spark):
    rows = make(4, 3, 30)
    df = spark.createDataFrame(rows, DDL)
    plan = with_frames(df, MEASURES, SERIES, max_rows=50)._jdf.queryExecution().toString()
    assert "_context" in plan
    check(spark, rows, max_rows=50)
    plan = with_frames(df, MEASURES, SERIES, max_rows=10_000)._jdf.queryExecution().toString()
    assert "_context" not in plan


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), max_rows=st.integers(1, 40), gap=st.integers(1, 60))
def test_blocks_property(spark, seed, max_rows, gap):
    check(spark, make(seed, 2, 20, gap), strategy="blocks", max_rows=max_rows)


def test_hot_day_is_cut_by_hour(spark):
    """All rows on one day: narrower buckets are found and the frames stay whole."""
    start = dt.datetime(2024, 5, 1)
    rows = [("a", start + dt.timedelta(seconds=37 * i), i, float(i % 11)) for i in range(2000)]
    df = spark.createDataFrame(rows, "e string, t timestamp, k int, v double")
    measures = [Lag("v", "lag1"), Trailing("v", "mean7", 7), Running("v", "life")]
    assert frames._fitting_profile(df, measures, SERIES, 1_000)[0] == "hour"
    bucket, profile = frames._fitting_profile(df, measures, SERIES, 150)
    assert bucket == "minute" and profile is not None
    assert frames._fitting_profile(df, measures, SERIES, 5_000) == ("month", None)
    got = with_frames(df, measures, SERIES, max_rows=150).orderBy("k").collect()
    v = [r[3] for r in rows]
    assert [r["lag1"] for r in got] == [None, *v[:-1]]
    assert [r["mean7"] for r in got] == pytest.approx([mean(v[max(0, i - 6) : i + 1]) for i in range(len(v))])
    assert [r["life"] for r in got] == pytest.approx([sum(v[: i + 1]) for i in range(len(v))])


def test_duration_mean(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = sorted(
        {("e%d" % rng.randint(0, 2), start + dt.timedelta(hours=rng.randint(0, 24 * 100))) for _ in range(600)}
    )
    rows = [(e, t, 0, rng.uniform(0, 100)) for e, t in rows]
    df = spark.createDataFrame(rows, "e string, t timestamp, k int, v double")
    for options in ({}, {"max_rows": 8}, {"max_rows": 50, "strategy": "blocks"}):
        out = with_duration_mean(df, "v", "m", 86_400, SERIES, **options)
        got = {(r["e"], r["t"]): r["m"] for r in out.collect()}
        assert len(got) == len(rows)
        for e, t, _, _ in rows:
            want = mean(
                [v for e2, t2, _, v in rows if e2 == e and dt.timedelta(0) < t - t2 <= dt.timedelta(days=1)]
            )
            assert got[(e, t)] == pytest.approx(want)


@pytest.mark.parametrize("odd", [math.nan, -math.inf, 1e18])
def test_duration_mean_forgets_odd_readings(spark, odd):
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(hours=i), i, odd if i in (3, 5) else i % 7 + 0.1) for i in range(200)]
    df = spark.createDataFrame(rows, "e string, t timestamp, k int, v double")
    for options in ({"strategy": "plain"}, {"max_rows": 8, "strategy": "blocks"}):
        got = {r["k"]: r["m"] for r in with_duration_mean(df, "v", "m", 86_400, SERIES, **options).collect()}
        assert len(got) == 200 and got[0] is None
        for i in range(1, 200):
            want = mean([r[3] for r in rows[max(0, i - 24) : i]])
            assert got[i] == pytest.approx(want, rel=1e-12, nan_ok=True)


def test_single_row_and_empty(spark):
    check(spark, [("a", dt.date(2020, 1, 1), 1, 2.0)], strategy="blocks", max_rows=1)
    empty = spark.createDataFrame([], DDL)
    assert with_frames(empty, MEASURES, SERIES, strategy="blocks").count() == 0


def test_compressed_entity_takes_blocks(spark, tmp_path):
    """Rows decide, not the size of files: one entity in a few KB of Parquet."""
    path = str(tmp_path / "one")
    spark.range(0, 5000, 1, 1).selectExpr("'a' AS e", "timestamp_seconds(id) AS t", "0 AS k", "1.0D AS v").write.parquet(path)
    df = spark.read.parquet(path)
    assert row_bound(df) == 5000 and row_bound(df.filter("v > 0").select("e", "t", "k", "v")) == 5000
    assert row_bound(df.join(df.select("e"), "e")) is None
    plan = with_frames(df, [Running("v", "s")], SERIES, max_rows=1000)._jdf.queryExecution().toString()
    assert "_context" in plan
    assert "_context" not in with_frames(df, [Running("v", "s")], SERIES, max_rows=5000)._jdf.queryExecution().toString()
    assert "broadcast" not in checked_broadcast(df, max_rows=100)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in checked_broadcast(df)._jdf.queryExecution().logical().toString().lower()


def test_routes_agree_on_types_and_rows_without_time(spark):
    rows = [("a", None if i % 10 == 0 else dt.datetime(2024, 1, 1 + i % 28), i, i) for i in range(200)]
    df = spark.createDataFrame(rows, "e string, t timestamp, k int, v int")
    measures = [Running("v", "run"), Running("v", "month", reset="month"), Overall("v", "all"), Overall("v", "far", True), Lag("v", "l")]
    plain = with_frames(df, measures, SERIES, strategy="plain")
    blocks = with_frames(df, measures, SERIES, strategy="blocks", max_rows=30)
    assert plain.schema == blocks.schema
    by_k = lambda out: {r["k"]: r for r in out.collect()}
    a, b = by_k(plain), by_k(blocks)
    assert len(a) == len(b) == 200
    for k in a:
        assert a[k]["run"] == b[k]["run"] and a[k]["month"] == b[k]["month"] and a[k]["l"] == b[k]["l"]
        assert a[k]["all"] == pytest.approx(b[k]["all"]) and a[k]["far"] == pytest.approx(b[k]["far"])


def test_duration_mean_keeps_rows_without_time(spark):
    rows = [("a", None if i % 10 == 0 else dt.datetime(2024, 1, 1, i % 24), i, float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "e string, t timestamp, k int, v double")
    got = {r["k"]: r["m"] for r in with_duration_mean(df, "v", "m", 86_400, SERIES).collect()}
    assert len(got) == 50 and all(got[k] is None for k in range(0, 50, 10))


def test_many_small_entities_take_one_range_frame(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("e"), F.col("id") % 10).alias("e"),
        F.when(F.col("id") % 37 != 0, F.timestamp_seconds(F.col("id") * 7_000)).alias("t"),
        F.col("id").alias("k"),
        (F.col("id") % 13).cast("double").alias("v"),
    )
    series = Series("e", "t", ("k",))
    out = with_duration_mean(rows, "v", "m", 86_400, series, max_rows=50)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    got, wanted = (
        {r["k"]: r["m"] for r in d.collect()}
        for d in (out, with_duration_mean(rows, "v", "m", 86_400, series, max_rows=50, strategy="blocks"))
    )
    assert got.keys() == wanted.keys() and len(got) == 400
    assert all(got[k] == pytest.approx(wanted[k]) for k in got)
