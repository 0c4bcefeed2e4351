"""The driver contract."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).parent.parent


def test_oracles_need_no_session():
    code = "import __spark_entry__ as e; print(len(e.oracle_sql()), len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    oracles, queries = map(int, done.stdout.split())
    assert 0 < oracles <= queries


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "alert_severity" in df.columns
