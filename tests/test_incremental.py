"""Gold tables that follow changes of silver: equal to a full computation, other years untouched."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratawell.plans import gold, incremental
from stratawell.plans.silver import production_kpis
from stratawell.sinks.tables import Lake

MEASURED = (
    "BORE_OIL_VOL", "BORE_GAS_VOL", "BORE_WAT_VOL", "ON_STREAM_HRS", "AVG_DOWNHOLE_PRESSURE",
    "AVG_DOWNHOLE_TEMPERATURE", "AVG_ANNULUS_PRESS", "AVG_WHP_P", "AVG_WHT_P", "BORE_WI_VOL",
)
RAW = "well_id string, WELL_BORE_CODE string, DATEPRD date, date_year int, " + ", ".join(f"{c} double" for c in MEASURED)


def raw_rows(wells=("F-1", "F-11", "F-12"), first=dt.date(2018, 11, 1), days=900, step=3):
    draw = random.Random(4)
    out = []
    for w in wells:
        for k in range(0, days, step):
            if draw.random() < 0.2:
                continue
            day = first + dt.timedelta(k)
            values = [draw.choice([None, draw.uniform(0, 900), draw.uniform(0, 90)]) for _ in MEASURED]
            out.append((w, f"WB {w}", day, day.year, *values))
    return out


def silver_of(spark, rows):
    return production_kpis(spark.createDataFrame(rows, RAW))


def stations_of(spark, depth=1000.0):
    rows = [("F-1", depth, 500.0, 10.0, 1.5, True, True), ("F-11", 700.0, 400.0, 12.0, None, True, False)]
    return spark.createDataFrame(
        rows, "well_id string, md_m double, tvd_m double, incl_deg double, dls_deg_per_30m double, is_md_valid boolean, is_incl_valid boolean"
    )


def write_all(lake, silver, stations):
    lake.refresh(incremental.SILVER, silver, ["date_year"], ["well_id", "DATEPRD"])
    lake.refresh(incremental.STATIONS, stations)
    lake.refresh("gold.production_daily", gold.production_daily(lake.read(incremental.SILVER)), ["date_year"])
    features = gold.feature_store(lake.read(incremental.SILVER), lake.read(incremental.STATIONS))
    lake.refresh("gold.ml_feature_store", features, ["date_year"])
    incremental.build_totals(lake)


def plain(df):
    def shown(v):
        return round(v, 6) if isinstance(v, float) else v

    columns = sorted(c for c in df.columns if c != "processed_ts")
    return sorted((tuple(shown(v) for v in r) for r in df.select(*columns).collect()), key=str)


def assert_in_line(lake):
    silver, stations = lake.read(incremental.SILVER), lake.read(incremental.STATIONS)
    assert plain(lake.read("gold.production_daily")) == plain(gold.production_daily(silver))
    assert plain(lake.read("gold.ml_feature_store")) == plain(gold.feature_store(silver, stations))


def files(lake, table):
    spark = lake.spark
    rows = lake.read(table).select("date_year", F.input_file_name().alias("f")).distinct().collect()
    return {(r.date_year, r.f) for r in rows}


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    write_all(lake, silver_of(spark, raw_rows()), stations_of(spark))
    return lake


def changed_rows(rows, day, how):
    return [how(r) if r[2] == day else r for r in rows]


def test_a_corrected_day(spark, lake):
    rows = raw_rows()
    day = next(r[2] for r in rows if r[2] > dt.date(2020, 6, 1))
    before = files(lake, "gold.production_daily"), files(lake, "gold.ml_feature_store")
    day_rows = [(*r[:4], 5.0, 9.0, *r[6:]) for r in rows if r[2] == day] + [("F-99", "WB F-99", day, day.year, *[1.0] * len(MEASURED))]
    written = incremental.backfill_day(lake, silver_of(spark, day_rows), day.isoformat())
    assert_in_line(lake)
    daily, features = written["gold.production_daily"], written["gold.ml_feature_store"]
    assert 2020 in daily and {2020, 2021} <= features and 2018 not in features
    for table, old, years in zip(("gold.production_daily", "gold.ml_feature_store"), before, (daily, features)):
        now = files(lake, table)
        assert {f for f in old if f[0] not in years} == {f for f in now if f[0] not in years}
        assert any(f[0] not in years for f in now)
    assert incremental.backfill_day(lake, silver_of(spark, day_rows), day.isoformat()) == {}


def test_a_day_that_goes_and_a_late_one(spark, lake):
    rows = raw_rows()
    day = max(r[2] for r in rows if r[2].year == 2019)
    incremental.backfill_day(lake, silver_of(spark, []), day.isoformat())
    assert_in_line(lake)
    late = ("F-1", "WB F-1", dt.date(2017, 2, 3), 2017, *[2.0] * len(MEASURED))
    kept = [r for r in rows if r[2] != day] + [late]
    lake.refresh(incremental.SILVER, silver_of(spark, kept), ["date_year"], ["well_id", "DATEPRD"])
    incremental.sync_gold(lake)
    assert_in_line(lake)


def test_a_baseline_that_moves_flips_old_flags(spark, tmp_path):
    """One huge ratio in 2020 lifts the baseline; a row of 2018 is no anomaly any more."""
    ratio = {dt.date(2018, 12, 10): 40.0}
    rows = [
        ("F-1", "WB", first, first.year, 1.0, ratio.get(first, 10.0), *[None] * 8)
        for first in (dt.date(2018, 12, 1) + dt.timedelta(k) for k in range(0, 800, 9))
    ]
    lake = Lake(spark, str(tmp_path / "lake"))
    write_all(lake, silver_of(spark, rows), stations_of(spark))
    flagged = lake.read("gold.production_daily").filter("is_gor_anomaly").collect()
    assert [r.DATEPRD for r in flagged] == [dt.date(2018, 12, 10)]
    day = rows[-3][2]
    written = incremental.backfill_day(lake, silver_of(spark, [(*rows[-3][:5], 5000.0, *rows[-3][6:])]), day.isoformat())
    assert written["gold.production_daily"] == {2018, day.year}
    assert_in_line(lake)


def test_new_surveys_reach_the_features_only(spark, lake):
    lake.refresh(incremental.STATIONS, stations_of(spark, 2000.0))
    written = incremental.sync_gold(lake)
    assert written["gold.production_daily"] == set() and {2018, 2019, 2020, 2021} <= written["gold.ml_feature_store"]
    assert_in_line(lake)


def test_a_run_that_failed_is_repeated(spark, lake, monkeypatch):
    rows = raw_rows()
    day = rows[40][2]
    day_rows = silver_of(spark, [(*r[:4], 77.0, *r[5:]) for r in rows if r[2] == day])
    broken = incremental.GoldTable("gold.missing", incremental.FEATURES.measures, incremental.FEATURES.rows, "x", incremental.FEATURES.flag_now)
    incremental.replace_day(lake, day_rows, day.isoformat())
    with pytest.raises(Exception):
        incremental.sync_gold(lake, tables=(incremental.DAILY, broken))
    incremental.sync_gold(lake)
    assert_in_line(lake)


def test_a_lake_of_one_gold_table_needs_no_surveys(spark, tmp_path):
    lake, only = Lake(spark, str(tmp_path)), [incremental.DAILY]
    rows = raw_rows(wells=("F-1",), days=90)
    lake.refresh(incremental.SILVER, silver_of(spark, rows), ["date_year"], ["well_id", "DATEPRD"])
    lake.refresh("gold.production_daily", gold.production_daily(lake.read(incremental.SILVER)), ["date_year"])
    incremental.build_totals(lake, only)
    day = rows[3][2]
    fixed = [(*rows[3][:4], *[1.0 for _ in MEASURED])]
    written = incremental.backfill_day(lake, silver_of(spark, fixed), day.isoformat(), tables=only)
    assert set(written) == {"gold.production_daily"} and day.year in written["gold.production_daily"]
    assert not lake.exists(incremental.STATS)
    assert plain(lake.read("gold.production_daily")) == plain(gold.production_daily(lake.read(incremental.SILVER)))
    assert incremental.backfill_day(lake, silver_of(spark, fixed), day.isoformat(), tables=only) == {}
