"""Quality of growing tables: each partition is measured once, as long as its files stay the same.

Beside a table lies one row of counts and sketches per partition, with a fingerprint of the partition's
files. A run measures the partitions whose files differ, adds up all rows and judges the sum. Files are
never changed in place, so their names tell a partition's content.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import DataFrame, functions as F

from stratawell.operators.quality import Suite
from stratawell.session import materialize
from stratawell.sinks.tables import Lake

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how a NULL is written in a path


def fingerprints(df: DataFrame, partition: str | None) -> dict[str, str]:
    """Digest of the file names of each partition of a stored table, from its listing; no rows are read."""
    files = defaultdict(list)
    pattern = re.compile(rf"/{re.escape(partition)}=([^/]*)/") if partition else None
    for path in df.inputFiles():
        found = pattern.search(path) if pattern else None
        files[found.group(1) if found else ""].append(path.rsplit("/", 1)[-1])
    return {value: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for value, names in files.items()}


def state_table(suite: Suite) -> str:
    return f"quality.{suite.name}"


def evaluate_stored(lake: Lake, suite: Suite, partition: str | None = "date_year") -> tuple[DataFrame, set[str]]:
    """The suite's verdicts over its stored table, and the partitions that were measured for them.

    A table without the partition column counts as one partition. States of a suite whose measures have
    changed are built anew.
    """
    spark = lake.spark
    rows = lake.read(suite.table)
    if partition not in rows.columns:
        partition = None
    now = fingerprints(rows, partition)
    value = F.coalesce(F.col(partition).cast("string"), F.lit(NO_VALUE)) if partition else F.lit("")
    schema = suite.measure(rows.limit(0), value.alias("part")).schema
    stored = lake.read_if_present(state_table(suite))
    if stored is not None and set(stored.columns) != {*schema.names, "files"}:
        stored = None
    known = {} if stored is None else {r["part"]: r["files"] for r in stored.select("part", "files").collect()}
    stale = {v for v, files in now.items() if known.get(v) != files}
    gone = set(known) - set(now)
    if stale or gone or stored is None:
        prints = spark.createDataFrame(sorted(now.items()), "part string, files string")
        fresh = suite.measure(rows.filter(value.isin(sorted(stale))), value.alias("part"))
        fresh = fresh.join(F.broadcast(prints), "part")  # one row per partition
        if stored is not None:
            kept = stored.filter(~F.col("part").isin(sorted(stale | gone)))
            fresh = kept.unionByName(fresh.select(*kept.columns))
        lake.refresh(state_table(suite), materialize(fresh))
        stored = lake.read(state_table(suite))
    return suite.judge(suite.merge(stored)), stale
