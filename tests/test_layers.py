"""Files to bronze, silver, gold, serving: sources, sinks and the daily chain on small files."""

import datetime as dt
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratawell.config import SHEET_COLUMNS
from stratawell.ml import scoring, training
from stratawell.operators import quality as q
from stratawell.operators.quality import GateBlocked
from stratawell.plans import daily_run, routing, serving
from stratawell.plans.bronze import bronze_production, bronze_trajectory
from stratawell.plans.silver import silver_production, silver_trajectory
from stratawell.registry.files import workbook
from stratawell.sinks.tables import Lake
from stratawell.sources.production import count_source_files, read_csv_sheet, read_workbooks
from stratawell.sources.trajectory import read_documents, read_trajectories, route_documents, split_unreadable
from stratawell.sources.welllogs import logs_long, logs_wide, parse_logs, read_log_lines, read_logs
from stratawell.streaming.kpis import late_files

AT = {name: i for i, name in enumerate(SHEET_COLUMNS)}


def sheet_row(**values):
    row = [None] * len(SHEET_COLUMNS)
    for name, value in values.items():
        row[AT[name]] = value
    return row


HEADER = list(SHEET_COLUMNS)
CASES = [
    HEADER,
    sheet_row(DATEPRD="01-Jan-14", WELL_BORE_CODE="WB F-1 C", ON_STREAM_HRS="24", BORE_OIL_VOL="0", BORE_WAT_VOL="0", AVG_DOWNHOLE_PRESSURE="0"),
    sheet_row(DATEPRD="02-JAN-14", WELL_BORE_CODE="WB F-1 C", ON_STREAM_HRS="24", BORE_OIL_VOL="10", BORE_WAT_VOL="30", BORE_GAS_VOL="100", AVG_DOWNHOLE_PRESSURE="10001"),
    sheet_row(DATEPRD="03-jan-14", WELL_BORE_CODE="WB F-11 H", BORE_OIL_VOL="abc", AVG_DOWNHOLE_PRESSURE="1,5"),
    sheet_row(DATEPRD="bad", WELL_BORE_CODE="WB F-1 C"),
    sheet_row(DATEPRD=None, WELL_BORE_CODE="WB F-1 C"),
    sheet_row(DATEPRD="04-Jan-14", WELL_BORE_CODE=None),
    sheet_row(DATEPRD="04-Jan-14", WELL_BORE_CODE="no match"),
    sheet_row(DATEPRD="04-Jan-14", WELL_BORE_CODE="WB F-99 H"),
]


def write_book(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(workbook(rows))


def test_workbook_to_silver(spark, tmp_path):
    write_book(tmp_path / "book.xlsx", CASES)
    (tmp_path / "notes.txt").write_text("not a workbook")
    assert count_source_files(spark, str(tmp_path)) == 2
    sheet = read_workbooks(spark, str(tmp_path))
    assert sheet.count() == len(CASES)
    bronze = bronze_production(sheet)
    got = {(r["DATEPRD"], r["well_id"], r["date_year"]) for r in bronze.collect()}
    assert got == {
        ("01-Jan-14", "F-1", 2014), ("02-JAN-14", "F-1", 2014), ("03-jan-14", "F-11", 2014), ("bad", "F-1", None),
    }
    assert len(bronze.columns) == 29
    silver = silver_production(bronze)
    assert len(silver.columns) == 34
    rows = {r["DATEPRD"]: r for r in silver.collect()}
    assert set(rows) == {dt.date(2014, 1, 1), dt.date(2014, 1, 2), dt.date(2014, 1, 3)}
    first, second, third = (rows[d] for d in sorted(rows))
    assert first["is_zero_prod_uptime"] and first["is_pressure_valid"] and first["water_cut_pct"] is None
    assert (second["water_cut_pct"], second["gas_oil_ratio"], second["is_pressure_valid"]) == (75.0, 10.0, False)
    assert third["BORE_OIL_VOL"] is None and not third["is_pressure_valid"]


def test_workbook_shared_strings_numbers_and_dates(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    write_book(tmp_path / "a.xlsx", [])
    with zipfile.ZipFile(tmp_path / "a.xlsx") as book:
        parts = {n: book.read(n) for n in book.namelist()}
    parts["xl/worksheets/sheet1.xml"] = (
        f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" s="1"><v>41640</v></c>'
        '<c r="B1" t="s"><v>0</v></c><c r="I1"><v>24.5</v></c></row></sheetData></worksheet>'
    ).encode()
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{main}"><si><r><t>WB </t></r><r><t>F-1</t></r></si></sst>'.encode()
    parts["xl/styles.xml"] = (
        f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="15"/></cellXfs></styleSheet>'
    ).encode()
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        for n, data in parts.items():
            book.writestr(n, data)
    r = read_workbooks(spark, str(tmp_path)).first()
    assert (r["_c0"], r["_c1"], r["_c2"], r["_c8"]) == ("01-Jan-14", "WB F-1", None, "24.5")


def test_csv_twin(spark, tmp_path):
    lines = [",".join("" if v is None else f'"{v}"' for v in row) for row in CASES]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    bronze = bronze_production(read_csv_sheet(spark, str(tmp_path)))
    assert bronze.count() == 4 and bronze.first()["source_file"].endswith("s.csv")


def test_duplicates_keep_the_latest_load(spark):
    ddl = ", ".join(f"_c{i} string" for i in range(24)) + ", source_file string, at timestamp"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)

    def row(oil, at, date="01-Jan-14"):
        return (*sheet_row(DATEPRD=date, WELL_BORE_CODE="F-1", BORE_OIL_VOL=oil), "f", at)

    rows = [row("1", t1), row("2", t2), row("3", t1, "01-JAN-14"), row("7", t1, "02-Jan-14"), row("8", t1, "02-Jan-14")]
    bronze = bronze_production(spark.createDataFrame(rows, ddl), ingestion_ts=F.col("at"))
    got = sorted((r["DATEPRD"].day, r["BORE_OIL_VOL"]) for r in silver_production(bronze).collect())
    assert got[0] == (1, 2.0) and len(got) == 2 and got[1][1] in (7.0, 8.0)
    assert silver_production(bronze, raw_text_key=True).count() == 3


# ---- surveys ------------------------------------------------------------------------------------------


def station(uid, **measures):
    return f'<trajectoryStation uid="{uid}">' + "".join(
        f'<{m} uom="m">{v}</{m}>' for m, v in measures.items()
    ) + "</trajectoryStation>"


def survey(uid, *stations):
    return (
        f'<trajectorys><trajectory uid="{uid}" uidWell="w" uidWellbore="b"><nameWell>n</nameWell>'
        f"<nameWellbore>nb</nameWellbore><name>t {uid}</name><other>1</other>{''.join(stations)}"
        "</trajectory></trajectorys>"
    )


def write_surveys(root):
    files = {
        "Norway-F-1 A/1/trajectory/1.xml": survey("a", station("s1", md=10, incl=5, azi=361)),
        "Norway-F-1 A/2/trajectory/1.xml": survey("b", station("s2", md=-1), station("s3", md="x", tvd=3)),
        "Norway-f-11/1/trajectory/1.xml": survey("c"),
        "Norway-F-11/2/trajectory/1.xml": survey("d", station("s4", md=2000, dls=1), station("s5", md=1)),
        "Norway-F-11/log/trajectory/1.xml": survey("no", station("x", md=1)),
        "Norway-F-12.old/1/trajectory/1.xml": survey("no", station("x", md=1)),
        "Norway-F-99/1/trajectory/1.xml": survey("no", station("x", md=1)),
        "Norway-F-1 A/1/message/1.xml": "<messages><message uid='m'><name>m</name></message></messages>",
        "Norway-F-1 A/_wellInfo/1.xml": "<wells><well uid='w1'><commonData><sourceName>src</sourceName></commonData></well></wells>",
    }
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def test_surveys(spark, tmp_path):
    write_surveys(tmp_path)
    bronze = bronze_trajectory(read_trajectories(spark, str(tmp_path)))
    got = {(r["trajectory_uid"], r["well_id"]) for r in bronze.collect()}
    assert got == {("a", "F-1"), ("b", "F-1"), ("c", "F-11"), ("d", "F-11")}
    assert len(bronze.columns) == 11
    assert all(r["source_path"].endswith("/trajectory/") for r in bronze.collect())
    silver = silver_trajectory(bronze)
    assert len(silver.columns) == 24
    rows = {r["station_uid"]: r for r in silver.collect()}
    assert set(rows) == {"s1", "s2", "s3", "s4", "s5"}
    assert rows["s1"]["md_m"] == 10.0 and not rows["s1"]["is_azi_valid"]
    assert not rows["s2"]["is_md_valid"] and rows["s3"]["md_m"] is None and rows["s3"]["tvd_m"] == 3.0


def test_stations_without_the_detour_by_text(spark, tmp_path):
    write_surveys(tmp_path)
    found = read_trajectories(spark, str(tmp_path))
    never = F.lit(None).cast("timestamp")
    by_text, direct = (
        silver_trajectory(bronze_trajectory(found, ingestion_ts=never, as_text=t), processed_ts=never) for t in (True, False)
    )
    assert direct.schema == by_text.schema
    assert direct.count() == 5 and direct.exceptAll(by_text).isEmpty()


def test_routing_and_flattening(spark, tmp_path):
    write_surveys(tmp_path)
    kinds = {r["path"].split("/")[-2]: r["doc_type"] for r in route_documents(spark, str(tmp_path)).collect()}
    assert (kinds["trajectory"], kinds["message"], kinds["_wellInfo"]) == ("trajectory", "messages", "well_info")
    flat = read_documents(
        spark,
        {"messages": f"{tmp_path}/*/1/message/*", "trajectory": f"{tmp_path}/*/1/trajectory/*"},
        extra=["nameWell"],
    )
    rows = {(r["doc_type"], r["uid"]): r for r in flat.collect()}
    assert rows["messages", "m"]["name"] == "m" and rows["messages", "m"]["nameWell"] is None
    assert rows["trajectory", "a"]["nameWell"] == "n" and rows["trajectory", "a"]["dTimCreation"] is None
    files = late_files(spark, str(tmp_path), F.current_timestamp())
    assert files.filter(~F.col("on_time")).count() == 0


def test_logs(spark, tmp_path):
    (tmp_path / "a.las").write_text(
        "~Version\n VERS. 2.0 : v\n~Well\n# comment\n NULL. -999.25 : null\n WELL. F-1 C : well\n LTYP. MWD : type\n"
        "~Curve\n DEPT.M : depth\n ROP .M/H : rate\n~Ascii\n 1.0 5.5\n\n 2.0 -999.25\n"
    )
    parsed = parse_logs(read_logs(spark, str(tmp_path)))
    wide = sorted(tuple(r)[3:] for r in logs_wide(parsed, ("DEPT", "ROP", "ECD")).collect())
    assert wide == [(0, 1.0, 5.5, None), (1, 2.0, None, None)]
    first = logs_long(parsed).first()
    assert (first["well_name"], first["log_type"]) == ("F-1 C", "MWD")
    assert logs_long(parsed).count() == 4


# ---- tables ----------------------------------------------------------------------------------------------


def lake_rows(lake, table="t"):
    return sorted(tuple(r) for r in lake.read(table).select("k", "d", "v").collect())


def dated(spark, *rows):
    df = spark.createDataFrame([(k, dt.date.fromisoformat(d), v) for k, d, v in rows], "k string, d date, v int")
    return df.withColumn("date_year", F.year("d"))


def test_refresh_counts_and_survives_failure(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = dated(spark, ("a", "2020-01-01", 1), ("b", "2021-01-01", 2))
    assert lake.refresh("t", df, ["date_year"], ["k"]) == 2
    broken = df.withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        lake.refresh("t", broken, ["date_year"], ["k"])
    assert len(lake_rows(lake)) == 2
    assert lake.refresh("t", df.filter("k = 'a'"), ["date_year"], ["k"]) == 1
    assert len(lake_rows(lake)) == 1


def test_reload_from(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.refresh(
        "t",
        dated(spark, ("a", "2019-05-01", 1), ("a", "2020-01-01", 2), ("a", "2020-06-01", 3), ("a", "2021-01-01", 4)),
        ["date_year"],
    )
    batch = dated(spark, ("a", "2020-03-01", 30), ("b", "2020-07-01", 40))
    for _ in range(2):
        lake.reload_from("t", batch, "d")
    d = dt.date
    assert lake_rows(lake) == [
        ("a", d(2019, 5, 1), 1), ("a", d(2020, 1, 1), 2), ("a", d(2020, 3, 1), 30), ("b", d(2020, 7, 1), 40),
    ]
    lake.reload_from("t", batch.limit(0), "d")
    assert len(lake_rows(lake)) == 4
    lake.reload_from("fresh", batch, "d")
    assert len(lake_rows(lake, "fresh")) == 2


def test_upsert_and_retention(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    batch = dated(spark, ("a", "2020-01-01", 1), ("a", "2020-01-01", 5), ("b", "2019-01-01", 2))
    lake.upsert("t", batch, ["k", "d"], [F.desc("v")])
    lake.upsert("t", dated(spark, ("a", "2020-01-01", 3), ("c", "2020-02-01", 9)), ["k", "d"], [F.desc("v")])
    assert [(k, v) for k, _, v in lake_rows(lake)] == [("a", 3), ("b", 2), ("c", 9)]
    assert lake.retain_years("t", 1, 2020) == [2019]
    assert [k for k, _, _ in lake_rows(lake)] == ["a", "c"]


def test_create_and_append(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.create_if_missing("x.y", "k string")
    assert lake.read("x.y").count() == 0 and lake.read_if_present("nope") is None
    lake.append("x.y", spark.createDataFrame([("a",)], "k string"))
    lake.create_if_missing("x.y", "k string")
    assert lake.read("x.y").count() == 1


# ---- the daily chain ---------------------------------------------------------------------------------------


def production_rows(days=60):
    rows = [HEADER]
    for w in ("F-1", "F-11", "F-12"):
        for i in range(days):
            day = dt.date(2014, 1, 1) + dt.timedelta(days=i)
            jump = 700 if i % 20 == 10 else 0
            rows.append(
                sheet_row(
                    DATEPRD=day.strftime("%d-%b-%y"), WELL_BORE_CODE=f"WB {w} H", ON_STREAM_HRS="24",
                    AVG_DOWNHOLE_PRESSURE=str(200 + i % 7 + jump), AVG_WHP_P=str(i % 5),
                    BORE_OIL_VOL=str(i % 13), BORE_GAS_VOL=str(i * 10), BORE_WAT_VOL=str(i % 3),
                    FLOW_KIND="production",
                )
            )
    return rows


def test_daily_chain(spark, tmp_path):
    write_book(tmp_path / "in" / "prod" / "book.xlsx", production_rows())
    write_surveys(tmp_path / "in" / "surveys")
    sources = daily_run.Sources(str(tmp_path / "in" / "prod"), str(tmp_path / "in" / "surveys"))
    lake = Lake(spark, str(tmp_path / "lake"))
    as_of = dt.date(2014, 3, 1)

    day = daily_run.run_day(lake, sources, as_of)
    assert day.rows["silver.cleaned_production"] == 180 and day.rows["gold.ml_feature_store"] == 180
    assert day.rows["silver.cleaned_trajectory"] == 5
    assert day.skipped.keys() == {"scoring", "serving.ml_predictions"}
    assert len(lake.read("gold.production_daily").columns) == 34
    assert len(lake.read("gold.ml_feature_store").columns) == 45  # with the bore code
    assert len(lake.read("serving.production_daily").columns) == 27
    assert spark.table("vw_anomaly_alerts").count() > 0

    few = {"pressure": {"maxIter": 3}, "drilling": {"numTrees": 3}, "anomaly": {"trees": 20}}
    trained = daily_run.train_models(lake, params=few)
    assert trained.keys() == {"pressure", "drilling", "anomaly"}
    daily_run.train_models(lake, only="pressure", params=few)
    assert training.versions(lake, "pressure_prediction") == [1, 2]
    assert lake.read("ml.model_runs").count() == 4

    for _ in range(2):  # the second run replaces the predictions of the first
        day = daily_run.run_day(lake, sources, as_of)
    assert day.scoring["total"] == 3 * 31 and day.skipped == {}
    predictions = lake.read("gold.ml_predictions")
    assert predictions.count() == 93
    assert predictions.filter("pred_next_day_pressure is null").count() == 0
    assert day.scoring["flagged"] == predictions.filter("pred_is_anomaly = 1").count()
    assert len(lake.read("serving.ml_predictions").columns) == 9  # with the bore code
    assert spark.table("vw_ml_predictions").count() == 180
    report, anomalies = daily_run.daily_report(lake, as_of)
    assert report.count() == 3 and anomalies.first()[0] >= 0
    assert lake.read("silver.dq_results").groupBy("suite_name").count().first()["count"] == 3

    # A model that cannot be read is skipped, and its column is NULL.
    for file in (tmp_path / "lake/models/drilling_efficiency/v=1/metadata").glob("*"):
        file.write_text("broken")
    day = daily_run.run_day(lake, sources, as_of)
    assert day.skipped.keys() == {"drilling"}
    assert lake.read("gold.ml_predictions").filter("pred_rop_efficiency_score is not null").count() == 0


def test_routed_chain(spark, tmp_path):
    rows = production_rows()
    at = {name: i for i, name in enumerate(SHEET_COLUMNS)}
    bad = list(rows[5])
    bad[at["AVG_DOWNHOLE_PRESSURE"]] = "99999"
    nameless = list(rows[7])
    nameless[at["BORE_OIL_VOL"]], flagged = "-5", list(rows[9])
    flagged[at["FLOW_KIND"]] = "odd"
    book = [*rows[:5], bad, rows[6], nameless, rows[8], flagged, *rows[10:]]
    write_book(tmp_path / "prod" / "book.xlsx", book)
    write_surveys(tmp_path / "surveys")
    sources = daily_run.Sources(str(tmp_path / "prod"), str(tmp_path / "surveys"))
    lake = Lake(spark, str(tmp_path / "lake"))
    daily_run.load_bronze(lake, sources)
    for day, new in ((dt.date(2014, 3, 1), 2), (dt.date(2014, 3, 2), 0)):
        assert daily_run.load_silver(lake, True, day)[routing.QUARANTINE] == new
        silver = lake.read("silver.cleaned_production")
        assert silver.count() == len(rows) - 1 - 2 and silver.filter("dq_flag").count() == 1
    held = lake.read(routing.QUARANTINE)
    assert {(r.severity, str(r.run_date)) for r in held.collect()} == {("HIGH", "2014-03-01")}
    assert routing.resolve(lake, "failure_reason like 'AVG_DOWNHOLE_PRESSURE%'") == 1
    assert routing.resolve(lake, "failure_reason like 'AVG_DOWNHOLE_PRESSURE%'") == 0
    daily_run.load_silver(lake, True, dt.date(2014, 3, 3))
    silver = lake.read("silver.cleaned_production")
    assert silver.count() == len(rows) - 1 - 1 and silver.filter("AVG_DOWNHOLE_PRESSURE > 99998").count() == 1


def test_critical_expectations_block(spark):
    df = spark.createDataFrame([(None,)], "a int")
    suite = q.Suite("s", "t", (q.not_null("a", severity="CRITICAL"), q.not_null("a", 0.5)))
    with pytest.raises(GateBlocked, match="s/expect_a_not_null_mostly"):
        routing.block_on_critical(suite.evaluate(df))
    routing.block_on_critical(q.Suite("s", "t", (q.row_count(severity="CRITICAL"),)).evaluate(df))


def test_gate_stops_the_chain(spark, tmp_path):
    write_book(tmp_path / "prod" / "book.xlsx", production_rows(days=10))
    write_surveys(tmp_path / "surveys")
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(GateBlocked, match="silver_prod_row_count"):
        daily_run.run_day(lake, daily_run.Sources(str(tmp_path / "prod"), str(tmp_path / "surveys")))
    assert not lake.exists("gold.production_daily")


def test_logs_in_small_splits(spark, tmp_path):
    head = "~V\r\n VERS. 2.0 : v\r\n~W\r\n WELL. F-1 : well\r\n LTYP. time : type\r\n~C\r\n DEPT.M : d\r\n ROP.M : r\r\n"
    data = "".join(f"{i} {i * 2}\r\n" + ("# note\r\n\r\n" if i % 50 == 0 else "") for i in range(900))
    (tmp_path / "a.las").write_text(head + "~A DEPT ROP\r\n" + data)
    (tmp_path / "b.las").write_text(head)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        rows = logs_wide(read_log_lines(spark, str(tmp_path)), ("DEPT", "ROP", "GR_CAL"))
        got = sorted((r.step, r.DEPT, r.ROP, r.GR_CAL, r.well_name, r.log_type) for r in rows.collect())
        assert read_log_lines(spark, str(tmp_path)).count() == 900
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, float(i), 2.0 * i, None, "F-1", "time") for i in range(900)]


def test_unreadable_surveys_are_kept_apart(spark, tmp_path):
    write_surveys(tmp_path)
    folder = next(tmp_path.glob("*/[0-9]*/trajectory"))
    (folder / "broken.xml").write_text("<trajectorys><trajectory><name>x</name>")
    readable, broken = split_unreadable(read_trajectories(spark, str(tmp_path)).cache())
    assert broken.count() == 1 and readable.count() > 0


def test_two_bores_of_one_day_meet_their_own_predictions(spark):
    day = dt.date(2020, 1, 1)
    daily = spark.createDataFrame(
        [("F-1", "A", day, 100.0, True), ("F-1", "B", day, 200.0, False), ("F-1", "C", day, 300.0, False)],
        "well_id string, WELL_BORE_CODE string, DATEPRD date, AVG_DOWNHOLE_PRESSURE double, is_anomaly_pressure boolean",
    )
    scored = spark.createDataFrame(
        [("F-1", "A", day, 101.0, None, 1, 0.5, None), ("F-1", "B", day, 205.0, None, 0, 0.1, None)],
        scoring.PREDICTION_DDL,
    )
    view = serving.predictions_vs_actuals(daily, serving.serving_predictions(scored))
    got = sorted((r.actual_pressure, r.pressure_abs_error, r.prediction_result) for r in view.collect())
    assert [g[:2] for g in got] == [(100.0, 1.0), (200.0, 5.0), (300.0, None)] and got[0][2] == "TRUE_POS"
    by_day = serving.serving_predictions(scored.drop("WELL_BORE_CODE").limit(1))
    assert serving.predictions_vs_actuals(daily, by_day).count() == 3


def test_report_windows(spark):
    df = spark.createDataFrame(
        [("F-1", dt.date(2024, 1, d), d % 2) for d in range(1, 11)],
        "well_id string, DATEPRD date, pred_is_anomaly int",
    )
    as_of = dt.date(2024, 1, 10)
    assert serving.last_days(df, 7, as_of).count() == 8
    assert serving.recent_anomalies(df, as_of).first()[0] == 1
    assert serving.recent_anomalies(df.limit(0), as_of).first()[0] == 0


def test_xml_files_are_compressed_and_one_a_folder(spark, tmp_path):
    from stratawell.registry.files import write_xml

    docs = spark.range(0, 400, 1, 8).select(F.col("id").alias("_uid"), F.concat(F.lit("F-"), F.col("id") % 5).alias("folder"))
    write_xml(docs, str(tmp_path / "x"), "folder")
    files = list((tmp_path / "x").glob("*/part-*"))
    assert len(files) == 5 and all(f.name.endswith(".gz") for f in files)
    back = spark.read.format("xml").option("rowTag", "trajectory").schema("_uid long").load(str(tmp_path / "x"))
    assert sorted(r["_uid"] for r in back.collect()) == list(range(400))


def test_page_files_are_written_by_several_tasks(spark, tiny, monkeypatch):
    from stratawell.registry import files

    written = []

    def remembered(spark, root):
        written.extend(f.name.split("-")[1] for f in Path(root).rglob("part-*"))
        return route_documents(spark, root)

    monkeypatch.setattr(files, "route_documents", remembered)
    assert files.route_files(spark, tiny).count() == len(written) > 0
    assert len(set(written)) > 1
