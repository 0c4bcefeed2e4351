"""Sections of well logs, and where their headers are read."""

from stratawell.registry.files import SPLITS, split_bytes
from stratawell.sources.welllogs import logs_wide, parse_logs

LOG = "~VERSION\r\n VERS. 2.0 : v\r\n~Well\r\n~Curve info\r\n# c\r\n DEPT.M : d\r\n\r\n GR.API : g\r\n~A  DEPT GR\r\n1 2\r\n#x\r\n3\r\n"


def logs(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "source_path string, text string")


def test_empty_section_does_not_take_the_next_one(spark):
    parsed = parse_logs(logs(spark, LOG, "~A\n", "", None))
    assert [tuple(r) for r in parsed.select("source_path", "well_name", "curves", "step", "values").collect()] == [
        ("0", None, ["DEPT", "GR"], 0, ["1", "2"]), ("0", None, ["DEPT", "GR"], 1, ["3"])
    ]
    wide = logs_wide(parsed, ("GR", "DEPT", "ECD"))
    assert [tuple(r)[4:] for r in wide.orderBy("step").collect()] == [(2.0, 1.0, None), (None, 3.0, None)]


def test_headers_are_read_below_the_lines(spark):
    plan = parse_logs(logs(spark, LOG))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate posexplode")
    assert "WELL" not in above and "WELL" in below


def test_splits_grow_with_the_logs(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.las").write_bytes(b"1 2 3 4\n" * (4 << 20))
    size = split_bytes(spark, str(tmp_path))
    assert 2 * size <= 32 << 20 and 3 * (32 << 20) / size <= SPLITS + 3
    (tmp_path / "0.las").write_bytes(b"1 2\n")
    assert split_bytes(spark, str(tmp_path / "0.las")) == 16 << 10
