"""The processor asks the store twice a key and call, and sorts missing values first."""

import pandas as pd
from pyspark.sql import types as T

from stratawell.config import Series
from stratawell.operators.frames import Lag, Trailing
from stratawell.streaming.readings import LastReadings


class Store:
    """A handle that has list state with a lifetime, and nothing else."""

    def __init__(self):
        self.rows, self.calls = [], []

    def getListState(self, name, kind, ttlDurationMs=None):
        self.ttl = ttlDurationMs
        return self

    def get(self):
        self.calls.append("get")
        return iter(self.rows)

    def put(self, rows):
        self.calls.append("put")
        self.rows = rows


def test_two_calls_a_key():
    fields = [T.StructField("t", T.DoubleType()), T.StructField("n", T.StringType()), T.StructField("v", T.DoubleType())]
    measures = [Lag("v", "l", 1), Trailing("v", "m", 2)]
    rules = LastReadings(measures, Series("e", "t", ("n",)), T.StructType(fields), ["e", "t", "n", "v"], 60)
    store = Store()
    rules.init(store)

    def call(*rows):
        frame = pd.DataFrame([("a", pd.to_datetime(t), n, v) for t, n, v in rows], columns=["e", "t", "n", "v"])
        out = pd.concat(list(rules.handleInputRows(("a",), iter([frame]), None)))
        return [tuple(None if pd.isna(x) else x for x in r) for r in out[["n", "v", "l", "m", "is_late"]].itertuples(index=False)]

    assert call(("2024-01-02", "y", 4.0), ("2024-01-02", None, 2.0), (None, "x", 1.0)) == [
        ("x", 1.0, None, 1.0, False), (None, 2.0, 1.0, 1.5, False), ("y", 4.0, 2.0, 3.0, False)
    ]
    assert call(("2024-01-01", "z", 9.0), ("2024-01-02", None, 8.0), ("2024-01-03", None, None)) == [
        (None, None, 4.0, 4.0, False), ("z", 9.0, None, None, True), (None, 8.0, None, None, True)
    ]
    assert store.calls == ["get", "put"] * 2 and store.ttl == 60_000
