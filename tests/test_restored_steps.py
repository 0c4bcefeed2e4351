"""Steps that must run on the way, and input that no task may hold as a whole."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratawell.registry import files, gold

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """A few line items: two of equal keys, one without a well, one without a kind."""
    folder = str(tmp_path_factory.mktemp("lines"))
    rows = [
        (o, p, s, n, float(o * 3), o * 100.5, 0.05, 0.02, flag, "O")
        for o, p, s, n, flag in (
            (3, 1, 8, 1, "N"), (1, 2, 16, 2, "N"), (2, 3, 8, 3, "N"), (2, 3, 16, 3, "N"),
            (5, 1, 9, 2, "R"), (4, 1, 9, 5, "R"), (6, 1, None, 1, "N"), (7, 1, 9, 1, None),
        )
    ]
    day = F.lit("1996-05-20").cast("timestamp_ntz")
    frame = spark.createDataFrame(rows, LINES.rsplit(",", 1)[0]).withColumn("l_shipdate", day)
    frame.write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_stations_pass_through_json_text(spark, lines):
    """Bronze keeps stations as text; silver parses them."""
    plan = gold.station_explode(spark, lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan
    assert gold.station_explode(spark, lines).filter("well_id IS NOT NULL").count() == 2 + 3 + 1 + 1 + 3 + 3 + 2


def test_large_logs_are_sorted_not_gathered(spark, lines, tmp_path, monkeypatch):
    def gather(*_):
        raise AssertionError("a whole log in one row")

    monkeypatch.setattr(files.F, "collect_list", gather)
    files.large_logs(spark, lines, str(tmp_path / "logs"))
    written = {p.parent.name: p.read_text() for p in Path(tmp_path / "logs").glob("*/*.txt")}
    assert set(written) == {"log=F-0-N", "log=F-1-R", "log=N", "log=F-1"}
    header, data = written["log=F-0-N"].split("~A\n# data\n")
    assert header.startswith("~VERSION") and " WELL.  F-0 : well\n" in header
    assert data == "1  3.0  100.50\n2  6.0  201.00\n2  6.0  201.00\n3  -999.25  301.50\n"
    assert written["log=F-1-R"].endswith("# data\n4  12.0  402.00\n5  15.0  502.50\n")
    assert not written["log=N"].strip() and not written["log=F-1"].strip()
