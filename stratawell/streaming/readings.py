"""Rules over consecutive readings, with the last readings of each entity kept as state.

A micro-batch reads and writes the state of the entities it has readings of, whatever the number of
all entities; the store keeps changes only. An entity that stays silent for long loses its state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stratawell.config import Series
from stratawell.operators.frames import Lag, Measure, Trailing

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # State that ends by the clock asks for one batch after the other; it goes with batches that have data.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
LATE = "is_late"
IDLE_SECONDS = 90 * 86_400


# ---- measures over a stretch of readings ------------------------------------------------------------------


def _windows(values: np.ndarray, rows: int) -> np.ndarray:
    """The ``rows`` values up to each one; missing ones before the first are NaN."""
    padded = np.concatenate([np.full(rows - 1, np.nan), values])
    return np.lib.stride_tricks.sliding_window_view(padded, rows)


def measured(values: np.ndarray, m: Measure) -> np.ndarray:
    """A lag or trailing aggregate of consecutive readings; NaN stands for no value."""
    if isinstance(m, Lag):
        return np.concatenate([np.full(min(m.rows, len(values)), np.nan), values[: max(len(values) - m.rows, 0)]])
    if not m.include_current:
        values = np.concatenate([[np.nan], values])[: len(values)]
    seen = _windows(values, m.rows)
    there = ~np.isnan(seen)
    n, zeroed = there.sum(axis=1), np.where(there, seen, 0.0)
    some = n > 0
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = zeroed.sum(axis=1) / n
        match m.how:
            case "avg":
                return np.where(some, mean, np.nan)
            case "sum":
                return np.where(some, zeroed.sum(axis=1), np.nan)
            case "min":
                return np.where(some, np.where(there, seen, np.inf).min(axis=1), np.nan)
            case "max":
                return np.where(some, np.where(there, seen, -np.inf).max(axis=1), np.nan)
            case "stddev":
                spread = np.where(there, seen - mean[:, None], 0.0) ** 2
                return np.where(n > 1, np.sqrt(spread.sum(axis=1) / (n - 1)), np.nan)
    raise ValueError(f"unknown aggregate {m.how}")


def _before(order: Sequence[np.ndarray], edge: Sequence) -> np.ndarray:
    """Rows that come before ``edge`` in the order of the columns, missing values first."""
    less, equal = np.zeros(len(order[0]), bool), np.ones(len(order[0]), bool)
    for values, e in zip(order, edge):
        missing = pd.isna(values)
        if pd.isna(e):
            here, same = np.zeros(len(values), bool), missing
        else:
            # Missing values of an object column cannot be compared.
            there = np.where(missing, e, values)
            here, same = missing | (there < e), ~missing & (there == e)
        less |= equal & here.astype(bool)
        equal &= same.astype(bool)
    return less


def _ranks(values: np.ndarray) -> np.ndarray:
    """Numbers that sort like ``values``, missing ones first."""
    if values.dtype.kind in "iub":
        return values
    missing = pd.isna(values)
    ranks = np.zeros(len(values), np.int64)
    ranks[~missing] = np.unique(values[~missing], return_inverse=True)[1] + 1
    return ranks


# ---- the processor -------------------------------------------------------------------------------------------


class LastReadings(StatefulProcessor):
    """Measures the readings of a micro-batch together with the last ones of earlier batches.

    Readings that come before the last one of an earlier batch are late: they pass without measures
    and leave the state alone. A micro-batch's readings of one entity are sorted in memory; the source
    bounds the size of a micro-batch. Missing values are NaN here, so NaN readings count as missing.
    """

    def __init__(self, measures: Sequence[Measure], series: Series, tail: T.StructType, columns: Sequence[str], idle: int | None):
        self.measures, self.series, self.tail_type, self.columns = list(measures), series, tail, list(columns)
        self.values = [f.name for f in tail.fields][len(series.order):]
        self.reach = max(m.rows for m in measures)
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Each write of the state starts its time anew. Timers would cost three more calls to the store a key.
        self.tail = handle.getListState("tail", self.tail_type, None if self.idle is None else 1000 * self.idle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A call handles few rows as a rule: arrays, since a frame costs more than all of its rows here.
        parts = list(rows)
        new = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        order = [new[c].to_numpy() for c in self.series.order]
        at = self.series.order.index(self.series.time)
        # Times as microseconds: state rows then have one type, with and without a time zone.
        stamp = order[at].astype("datetime64[us]")
        order[at] = np.where(np.isnat(stamp), np.nan, stamp.astype("int64").astype("float64"))
        kept = list(self.tail.get())
        late = _before(order, kept[-1][: len(order)]) if kept else np.zeros(len(new), bool)
        ranked = np.lexsort([_ranks(x) for x in reversed(order)])
        on_time, behind = ranked[~late[ranked]], np.flatnonzero(late)
        out = {c: new[c].to_numpy()[np.concatenate([on_time, behind])] for c in self.columns}
        n, n_late = len(on_time), len(behind)
        both = {}
        for i, v in enumerate(self.values):
            source = v if v in new else v.removeprefix("v_")
            old = [np.nan if r[len(order) + i] is None else r[len(order) + i] for r in kept]
            both[v] = np.concatenate([np.array(old, "float64"), new[source].to_numpy("float64", na_value=np.nan)[on_time]])
        for m in self.measures:
            column = m.column if m.column in both else f"v_{m.column}"
            found = measured(both[column], m)[len(kept) :]
            out[m.name] = np.concatenate([found, np.full(n_late, np.nan)])
        out[LATE] = np.arange(n + n_late) >= n
        if n:
            kinds = [f.dataType for f in self.tail_type.fields]
            fresh = on_time[-self.reach :]
            last = zip(*[x[fresh] for x in order], *[both[v][len(kept) + n - len(fresh) :] for v in self.values])
            added = [tuple(_as(v, k) for v, k in zip(row, kinds)) for row in last]
            self.tail.put([*(tuple(r) for r in kept), *added][-self.reach :])
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def _as(value, kind: T.DataType):
    if pd.isna(value):
        return None
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        return int(value)
    return float(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def reading_rules(
    stream: DataFrame, measures: Sequence[Measure], series: Series, idle_seconds: int | None = IDLE_SECONDS
) -> DataFrame:
    """``stream`` with a double column per measure (lags and trailing aggregates) and ``is_late``.

    State of an entity goes after ``idle_seconds`` without a reading by the clock; None keeps it.
    """
    if not all(isinstance(m, (Lag, Trailing)) for m in measures):
        raise ValueError("only lags and trailing aggregates can be followed reading by reading")
    values = list(dict.fromkeys(m.column for m in measures))
    types = {f.name: f.dataType for f in stream.schema.fields}
    tail = T.StructType(
        [T.StructField(c, T.DoubleType() if c == series.time else types[c]) for c in series.order]
        + [T.StructField(f"v_{c}" if c in series.order else c, T.DoubleType()) for c in values]
    )
    columns = stream.columns
    out = T.StructType(
        [*stream.schema.fields, *[T.StructField(m.name, T.DoubleType()) for m in measures], T.StructField(LATE, T.BooleanType())]
    )
    processor = LastReadings(measures, series, tail, columns, idle_seconds)
    return stream.groupBy(series.entity).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="ProcessingTime" if idle_seconds else "None"
    )


def start_reading_rules(
    stream: DataFrame,
    measures: Sequence[Measure],
    path: str,
    checkpoint: str,
    series: Series,
    idle_seconds: int | None = IDLE_SECONDS,
    **trigger,
) -> StreamingQuery:
    """Append measured readings to Parquet files, late ones in a partition of their own; none is lost."""
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        return (
            reading_rules(stream, measures, series, idle_seconds)
            .writeStream.format("parquet")
            .partitionBy(LATE)
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _readings(spark: SparkSession, path: str, late: bool) -> DataFrame:
    # A folder named after a flag is read back as text.
    return spark.read.parquet(path).filter(F.col(LATE).cast("boolean") == late).drop(LATE)


def measured_readings(spark: SparkSession, path: str) -> DataFrame:
    return _readings(spark, path, False)


def late_readings(spark: SparkSession, path: str) -> DataFrame:
    return _readings(spark, path, True)
