"""Streams against their batch twins, with late rows and restarts."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratawell.config import Series
from stratawell.operators.frames import Lag, Trailing, with_frames
from stratawell.streaming import closed, kpis, readings
from stratawell.streaming.tables import latest_state

DDL = "e string, t timestamp, k int, v double"
SERIES = Series("e", "t", ("k",))
DAY = dt.datetime(2024, 1, 1)


class Landing:
    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0

    def drop(self, *rows):
        self.n += 1
        self.spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(f"{self.root}/part-{self.n}")

    def stream(self):
        schema = self.spark.createDataFrame([], DDL).schema
        return kpis.read_landing(self.spark, f"{self.root}/*/*.parquet", schema, files_per_trigger=1)


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, str(tmp_path / "landing"))


def at(hours, e="a", v=1.0, k=0):
    return (e, DAY + dt.timedelta(hours=hours), k, v)



def daily(df, lateness):
    return kpis.windowed_kpi(df, "t", ["e"], {"n": F.count(F.lit(1)), "total": F.sum("v")}, lateness=lateness)


def test_windowed_kpi_equals_batch(spark, landing, tmp_path):
    parts = [[at(1), at(5, "b", 2.0)], [at(30), at(2, v=4.0)], [at(80, v=3.0)]]
    for part in parts:
        landing.drop(*part)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    kpis.start_windowed_kpi(daily(landing.stream(), "2 days"), out, check).awaitTermination()
    got = latest_state(spark, out, ["window_start", "e"])
    batch = daily(spark.createDataFrame([r for p in parts for r in p], DDL), "2 days")
    assert sorted(map(tuple, got.select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_rows_past_the_watermark_are_dropped(spark, landing, tmp_path):
    landing.drop(at(1))
    landing.drop(at(100))
    landing.drop(at(101))
    landing.drop(at(2, v=9.0), at(102))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    kpis.start_windowed_kpi(daily(landing.stream(), "1 hour"), out, check).awaitTermination()
    state = {r["window_start"]: r["total"] for r in latest_state(spark, out, ["window_start", "e"]).collect()}
    assert state[DAY] == 1.0


def test_restart_goes_on_where_it_stopped(spark, landing, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for hour in (1, 2, 30):
        landing.drop(at(hour))
        kpis.start_windowed_kpi(daily(landing.stream(), "10 days"), out, check).awaitTermination()
    got = sorted(r["n"] for r in latest_state(spark, out, ["window_start", "e"]).collect())
    assert got == [1, 2]


MEASURES = [Lag("v", "lag1"), Lag("v", "lag2", 2), Trailing("v", "mean3", 3)]


def test_reading_rules_equal_batch_and_keep_late_rows(spark, landing, tmp_path):
    parts = [
        [at(h, e, float(h % 5)) for h in range(0, 20) for e in "ab"],
        [at(h, e, float(h % 7)) for h in range(20, 23) for e in "abc"],
        [at(h, "a", float(h % 3)) for h in range(23, 60)],
    ]
    for part in parts:
        landing.drop(*part)
    landing.drop(at(5.5, "a", 77.0), at(60, "a", 1.0))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    readings.start_reading_rules(landing.stream(), MEASURES, out, check, SERIES).awaitTermination()
    got = readings.measured_readings(spark, out)
    on_time = [r for p in parts for r in p] + [at(60, "a", 1.0)]
    batch = with_frames(spark.createDataFrame(on_time, DDL), MEASURES, SERIES)
    assert sorted(map(tuple, got.select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    late = readings.late_readings(spark, out).collect()
    assert [(r["v"], r["e"]) for r in late] == [(77.0, "a")]


def test_alerts_are_appended_once(spark, tmp_path):
    ddl = "id int, BORE_OIL_VOL double, ON_STREAM_HRS double, AVG_DOWNHOLE_PRESSURE double"
    root, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = [(1, 0.0, 5.0, 10.0), (2, 1.0, 5.0, 10.0), (3, 1.0, 5.0, -1.0), (4, None, None, 10.0)]
    for i in range(2):
        batch = [(r[0] + 10 * i, *r[1:]) for r in rows]
        spark.createDataFrame(batch, ddl).coalesce(1).write.parquet(f"{root}/part-{i}")
        schema = spark.createDataFrame([], ddl).schema
        stream = kpis.read_landing(spark, f"{root}/*/*.parquet", schema)
        kpis.start_alerts(kpis.production_alerts(stream), out, check).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 3, 11, 13]


def closed_windows(spark, dealt, out):
    schema = spark.createDataFrame([], DDL).schema
    kpi = daily(closed.rows_in_time(spark, dealt, schema, files_per_trigger=1), "1 hour")
    closed.start_closed_windows(kpi, out, f"{out}-check").awaitTermination()
    return sorted((r["window_start"], r["e"], r["n"], r["total"]) for r in spark.read.parquet(out).collect())


def test_closed_windows_and_late_rows_hold_every_row_once(spark, landing, tmp_path):
    dealt, out = str(tmp_path / "dealt"), str(tmp_path / "out")
    schema = spark.createDataFrame([], DDL).schema
    parts = [[at(1), at(23.5, "b", 2.0)], [at(23.2), at(30), at(22.0, v=9.0), at(29, "b")], [at(80, v=3.0), ("a", None, 1, 4.0)], [at(29.5)]]
    for part in parts:
        landing.drop(*part)
    closed.start_dealing(landing.stream(), "t", dealt, f"{dealt}-check").awaitTermination()
    late = sorted(r["v"] for r in closed.late_rows(spark, dealt, schema).collect())
    assert late == [1.0, 4.0, 9.0]
    first = closed_windows(spark, dealt, out)
    assert (DAY, "a", 2, 2.0) in first and (DAY + dt.timedelta(days=3), "a", 1, 3.0) not in first
    n_files = len(spark.read.parquet(out).inputFiles())
    assert closed_windows(spark, dealt, out) == first and len(spark.read.parquet(out).inputFiles()) == n_files
    closed.close_windows(spark, dealt, schema, "t")
    got = closed_windows(spark, dealt, out)
    day = dt.timedelta(days=1)
    assert got == [(DAY, "a", 2, 2.0), (DAY, "b", 1, 2.0), (DAY + day, "a", 1, 1.0), (DAY + day, "b", 1, 1.0), (DAY + 3 * day, "a", 1, 3.0)]
    landing.drop(at(500))
    closed.start_dealing(landing.stream(), "t", dealt, f"{dealt}-check").awaitTermination()
    assert closed.late_rows(spark, dealt, schema).count() == 4  # the stream was closed


def test_silent_entities_lose_their_state(spark, landing, tmp_path):
    import time

    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run(idle):
        readings.start_reading_rules(landing.stream(), MEASURES, out, check, SERIES, idle_seconds=idle).awaitTermination()

    landing.drop(at(1), at(2, v=2.0))
    run(1)
    time.sleep(2)
    landing.drop(at(3, "b"))
    run(1)  # the timer of a goes off with this batch
    landing.drop(at(4), at(4, "b", 7.0))
    run(1)
    got = {(r["e"], r["t"]): r["lag1"] for r in readings.measured_readings(spark, out).collect()}
    assert got[("a", DAY + dt.timedelta(hours=2))] == 1.0 and got[("a", DAY + dt.timedelta(hours=4))] is None


def test_measures_of_a_stretch_equal_window_frames(spark):
    values = [1.0, None, 4.0, 4.0, -2.0, None, None, None, 8.5, 3.0]
    rows = [("a", DAY + dt.timedelta(hours=i), i, v) for i, v in enumerate(values)]
    measures = [Lag("v", "l", 3), *[Trailing("v", h, 3, how=h) for h in ("avg", "sum", "min", "max", "stddev")], Trailing("v", "x", 2, include_current=False)]
    batch = with_frames(spark.createDataFrame(rows, DDL), measures, SERIES, strategy="plain").orderBy("t").collect()
    series = pd.Series(values, dtype="float64").to_numpy()
    for m in measures:
        found = [None if v != v else round(v, 9) for v in readings.measured(series, m).tolist()]
        assert found == [None if r[m.name] is None else round(r[m.name], 9) for r in batch], m
