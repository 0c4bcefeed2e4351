"""Row-frame measures over entity series, safe when one entity holds a large share of the rows.

A plain window puts each entity in one task. That is the best plan while every entity is small,
and it is used then. Beyond ``max_rows`` rows an entity is cut into blocks along time:

1. rows are counted (and summed) per entity and calendar bucket; this shrinks on the map side;
2. over that small table the buckets of a large entity are joined up into blocks, and for every
   bucket the blocks are found whose first (last) rows look back (ahead) into it;
3. each row goes to its own block and, as context, to the blocks that need it; all frames are
   then computed per block in a single shuffle, and the context rows are dropped.

The result equals the plain window for any frame of a fixed number of rows, for running sums
and for whole-entity means.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratawell.config import PRODUCTION, Series
from stratawell.session import checked_broadcast, materialize, row_bound

MAX_ENTITY_ROWS = 2_000_000
BUCKETS = ("month", "day", "hour", "minute", "second")  # calendar buckets, widest first
BUCKETS_PER_BLOCK = 10


@dataclass(frozen=True)
class Lag:
    column: str
    name: str
    rows: int = 1


@dataclass(frozen=True)
class Lead:
    column: str
    name: str
    rows: int = 1


@dataclass(frozen=True)
class Trailing:
    """Aggregate over the current row and the rows before it, ``rows`` in all."""

    column: str
    name: str
    rows: int
    how: str = "avg"
    include_current: bool = True


@dataclass(frozen=True)
class Running:
    """Sum from the start of the series, or of the calendar period ``reset``, to the row."""

    column: str
    name: str
    reset: str | None = None


@dataclass(frozen=True)
class Overall:
    """Mean over the whole entity; ``expanding`` uses only rows up to the current one."""

    column: str
    name: str
    expanding: bool = False


Measure = Lag | Lead | Trailing | Running | Overall

AGGREGATES = {"avg": F.avg, "stddev": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}


def with_frames(
    df: DataFrame,
    measures: Sequence[Measure],
    series: Series = PRODUCTION,
    max_rows: int = MAX_ENTITY_ROWS,
    strategy: str = "auto",
) -> DataFrame:
    """Add one column per measure.

    ``strategy``: ``plain``, ``blocks``, or ``auto`` (plain when the input or every entity has at
    most ``max_rows`` rows, else blocks). Both give the same types and values, also for rows
    without a time, which come first.
    """
    if strategy == "plain":
        return _plain(df, measures, series)
    bound = row_bound(df) if strategy == "auto" else None
    if bound is not None and bound <= max_rows:
        return _plain(df, measures, series)
    bucket, profile = _fitting_profile(df, measures, series, max_rows)
    if profile is None and strategy == "auto":
        return _plain(df, measures, series)
    if profile is None:
        profile = _bucket_profile(df, measures, series, bucket)
    return _blocked(df, measures, series, profile, max_rows, bucket)


def _fitting_profile(
    df: DataFrame, measures: Sequence[Measure], series: Series, max_rows: int
) -> tuple[str, DataFrame | None]:
    """Bucket width and profile of the large entities; no profile where there are none.

    A bucket is the grain of blocks and of their context, so it should hold a small part of
    ``max_rows``. Widths are tried from months down; a series of dates ends at days. Only large
    entities are profiled again.
    """
    e = series.entity
    rows = df
    for bucket in _widths(df, measures, series):
        # A few bytes per entity and bucket; kept, so that the scan behind it runs once.
        profile = materialize(_bucket_profile(rows, measures, series, bucket))
        large = profile.groupBy(e).agg(F.sum("_n").alias("_total"), F.max("_n").alias("_peak"))
        large = large.filter(F.col("_total") > max_rows)
        if large.isEmpty():
            return bucket, None
        if large.filter(F.col("_peak") > max_rows / BUCKETS_PER_BLOCK).isEmpty():
            break
        # At most one row per ``max_rows`` rows of input.
        rows = df.join(large.select(e), e, "left_semi")
    return bucket, profile


def _widths(df: DataFrame, measures: Sequence[Measure], series: Series) -> list[str]:
    """Calendar widths that fit the type of the time column and nest in all reset periods."""
    nested = all(m.reset in (None, "month", "quarter", "year") for m in measures if isinstance(m, Running))
    first = 0 if nested else 1
    last = 2 if dict(df.dtypes)[series.time] == "date" else len(BUCKETS)
    return list(BUCKETS[first:last])


# ---- one task per entity ------------------------------------------------------------------------


def _plain(df: DataFrame, measures: Sequence[Measure], series: Series) -> DataFrame:
    return df.withColumns({m.name: _over(m, [series.entity], series) for m in measures})


def _over(m: Measure, partition: list, series: Series, value: Column | None = None) -> Column:
    """Window expression of a measure within one partition of the series."""
    x = F.col(m.column) if value is None else value
    ordered = Window.partitionBy(*partition).orderBy(*series.order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    match m:
        case Lag():
            return F.lag(x, m.rows).over(ordered)
        case Lead():
            return F.lead(x, m.rows).over(ordered)
        case Trailing():
            last = 0 if m.include_current else -1
            return AGGREGATES[m.how](x).over(ordered.rowsBetween(last - m.rows + 1, last))
        case Running(reset=None):
            return F.sum(x).over(so_far)
        case Running():
            period = F.date_trunc(m.reset, F.col(series.time))
            return F.sum(x).over(
                Window.partitionBy(*partition, period)
                .orderBy(*series.order)
                .rowsBetween(Window.unboundedPreceding, 0)
            )
        case Overall(expanding=True):
            return F.avg(x).over(so_far)
        case Overall():
            return F.avg(x).over(Window.partitionBy(*partition))


# ---- blocks along time ----------------------------------------------------------------------------


def _reach(measures: Sequence[Measure]) -> tuple[int, int]:
    """Rows a frame may look back and ahead."""
    back = [m.rows for m in measures if isinstance(m, (Lag, Trailing))]
    ahead = [m.rows for m in measures if isinstance(m, Lead)]
    return max(back, default=0), max(ahead, default=0)


def _summed(measures: Sequence[Measure]) -> list[str]:
    """Columns whose totals per bucket are needed."""
    return sorted({m.column for m in measures if isinstance(m, (Running, Overall))})


def _bucket_of(series: Series, bucket: str) -> Column:
    return F.date_trunc(bucket, F.col(series.time))


def _bucket_profile(df, measures, series: Series, bucket: str) -> DataFrame:
    """Row count and column totals per entity and calendar bucket."""
    sums = [
        agg
        for c in _summed(measures)
        for agg in (F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_c_{c}"))
    ]
    return df.groupBy(series.entity, _bucket_of(series, bucket).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"), *sums
    )


def _layout(profile: DataFrame, measures, series: Series, max_rows: int) -> DataFrame:
    """Block, context targets and carried sums of every bucket of the large entities."""
    e = series.entity
    back, ahead = _reach(measures)
    whole = Window.partitionBy(e)
    timed = whole.orderBy("_bucket")
    before = timed.rowsBetween(Window.unboundedPreceding, -1)

    t = (
        profile.withColumn("_total", F.sum("_n").over(whole))
        .filter(F.col("_total") > max_rows)
        .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_end", F.col("_first") + F.col("_n"))
        .withColumn("_block", F.floor(F.col("_first") / F.lit(max_rows)))
        .withColumn("_opens", F.lead("_block").over(timed))
        .withColumn("_closes", F.lag("_block").over(timed))
    )
    # A block that starts right after row r looks back at the buckets that end after r - back;
    # one that ends right before row r looks ahead at those that start before r + ahead.
    opens = F.when(F.col("_opens") != F.col("_block"), F.col("_opens"))
    closes = F.when(F.col("_closes") != F.col("_block"), F.col("_closes"))
    targets = []
    if back:
        near = whole.orderBy("_end").rangeBetween(0, back - 1)
        targets.append(F.collect_set(opens).over(near))
    if ahead:
        near = whole.orderBy("_first").rangeBetween(-(ahead - 1), 0)
        targets.append(F.collect_set(closes).over(near))
    context = reduce(F.array_union, targets) if targets else F.array().cast("array<bigint>")
    t = t.withColumn("_context", context)

    carried = []
    for m in measures:
        c = m.column
        if isinstance(m, Overall):
            span = before if m.expanding else whole
            t = t.withColumn(f"_os_{m.name}", F.sum(f"_s_{c}").over(span)).withColumn(
                f"_oc_{m.name}", F.sum(f"_c_{c}").over(span)
            )
            if m.expanding:
                start = Window.partitionBy(e, "_block").orderBy("_bucket")
                t = t.withColumn(f"_os_{m.name}", F.first(f"_os_{m.name}").over(start))
                t = t.withColumn(f"_oc_{m.name}", F.first(f"_oc_{m.name}").over(start))
            carried += [f"_os_{m.name}", f"_oc_{m.name}"]
        elif isinstance(m, Running):
            keys = [e] if m.reset is None else [e, F.date_trunc(m.reset, F.col("_bucket"))]
            so_far = (
                Window.partitionBy(*keys)
                .orderBy("_bucket")
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            start = Window.partitionBy(*keys, "_block").orderBy("_bucket")
            t = t.withColumn(f"_r_{m.name}", F.sum(f"_s_{c}").over(so_far)).withColumn(
                f"_r_{m.name}", F.first(f"_r_{m.name}").over(start)
            )
            carried.append(f"_r_{m.name}")
    return t.select(e, "_bucket", "_block", "_context", *carried)


def _blocked(df, measures, series: Series, profile, max_rows: int, bucket: str) -> DataFrame:
    e = series.entity
    layout = _layout(profile, measures, series, max_rows)
    layout = checked_broadcast(
        layout.withColumnsRenamed({e: "_entity", "_bucket": "_from"})
    )
    no_context = F.array().cast("array<bigint>")
    timed = df.withColumn("_bucket", _bucket_of(series, bucket))
    here = timed[e].eqNullSafe(layout["_entity"]) & timed["_bucket"].eqNullSafe(layout["_from"])
    placed = (
        timed.join(layout, here, "left")
        .withColumn("_block", F.coalesce("_block", F.lit(0)))
        .withColumn(
            "_to", F.explode(F.concat(F.array("_block"), F.coalesce("_context", no_context)))
        )
        .withColumn("_own", F.col("_to") == F.col("_block"))
    )
    block = [e, "_to"]
    types = _plain(df, measures, series).schema
    types = {m.name: types[m.name].dataType for m in measures}
    out = {}
    for m in measures:
        own = F.when(F.col("_own"), F.col(m.column))
        match m:
            case Running():
                inside = _over(m, block, series, own)
                base = F.col(f"_r_{m.name}")
                kind = types[m.name]
                zero = F.lit(0).cast(kind)
                both = F.coalesce(inside, zero) + F.coalesce(base.cast(kind), zero)
                out[m.name] = F.when(inside.isNotNull() | base.isNotNull(), both.cast(kind))
            case Overall():
                span = Window.partitionBy(*block)
                if m.expanding:
                    span = span.orderBy(*series.order).rowsBetween(Window.unboundedPreceding, 0)
                total = F.coalesce(F.col(f"_os_{m.name}"), F.lit(0.0))
                n = F.coalesce(F.col(f"_oc_{m.name}"), F.lit(0))
                if m.expanding:
                    total = total + F.coalesce(F.sum(own).over(span), F.lit(0.0))
                    n = n + F.count(own).over(span)
                    mean = F.when(n > 0, total / n)
                else:
                    mean = F.coalesce(F.when(n > 0, total / n), F.avg(own).over(span))
                out[m.name] = mean.cast(types[m.name])
            case _:
                out[m.name] = _over(m, block, series)
    kept = [F.col(c) for c in df.columns] + [F.col(m.name) for m in measures]
    return placed.withColumns(out).filter("_own").select(*kept)


# ---- frames of a fixed duration --------------------------------------------------------------------


MAX_PART_ROWS = 2_000  # of an entity within one duration: what a range frame reads for a row


def _few_a_part(df: DataFrame, entity: str, at: Column, seconds: int, max_rows: int) -> bool:
    """Whether every entity is small and has few rows per duration; counts are made in the tasks."""
    largest = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if largest <= MAX_PART_ROWS or largest > max_rows:
        return largest <= min(MAX_PART_ROWS, max_rows)
    parts = df.filter(at.isNotNull()).groupBy(entity, F.floor(at / seconds).alias("_part"))
    most = parts.agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return (most or 0) <= MAX_PART_ROWS


def with_duration_mean(
    df: DataFrame,
    column: str,
    name: str,
    seconds: int,
    series: Series = PRODUCTION,
    max_rows: int = MAX_ENTITY_ROWS,
    strategy: str = "auto",
) -> DataFrame:
    """Mean over the ``seconds`` before each row, the row's own second left out.

    Time is cut into parts of ``seconds``. What a row looks back on is the end of one part and the
    beginning of the next, so its mean comes from a running sum backwards over the one and forwards
    over the other. Nothing is subtracted: only readings within the duration enter, NaN, infinities
    and rounding errors of others do not. ``with_frames`` splits parts with many rows. What is of the
    same second is added up first. A row without a time keeps its place with a NULL mean.

    While all entities are small and no part has many rows, a window of that range is enough.
    """
    e = series.entity
    at = F.unix_seconds(F.col(series.time).cast("timestamp"))
    value = F.col(column).cast("double")
    if strategy == "auto":
        bound = row_bound(df)
        if bound is None or bound > max_rows:
            df = materialize(df)  # counted and read again
    if strategy == "range" or (strategy == "auto" and _few_a_part(df, e, at, seconds, max_rows)):
        frame = Window.partitionBy(e).orderBy(at).rangeBetween(-seconds, -1)
        return df.withColumn(name, F.when(at.isNotNull(), F.avg(value).over(frame)))
    moments = (
        df.filter(at.isNotNull())
        .groupBy(F.col(e).alias("_e"), at.alias("_s"))
        .agg(F.sum(value).alias("_v"), F.count(value).alias("_n"))
    )
    since = F.pmod(F.col("_s"), F.lit(seconds).cast("bigint"))
    begin = F.col("_s") - since
    turned = begin + F.lit(seconds - 1) - since

    def entry(back: bool, begin, when, asks: bool):
        # Forwards, what is of the second itself comes after its question; backwards, before it.
        return F.struct(
            F.lit(back).alias("back"), begin.alias("begin"), F.timestamp_seconds(when).alias("at"),
            F.lit(asks).alias("asks"), F.lit(asks == back).alias("last"),
        )

    entries = F.explode(
        F.array(
            entry(False, begin, F.col("_s"), False),
            entry(False, begin, F.col("_s"), True),
            entry(True, begin, turned, False),
            entry(True, begin - F.lit(seconds), turned - F.lit(seconds), True),
        )
    )
    placed = moments.withColumn("_x", entries).select(
        "_e", "_s", F.struct("_e", "_x.back", "_x.begin").alias("_part"), F.col("_x.at").alias("_at"),
        F.col("_x.last").alias("_last"), F.col("_x.asks").alias("_asks"),
        F.when(~F.col("_x.asks"), F.col("_v")).alias("_v"), F.when(~F.col("_x.asks"), F.col("_n")).alias("_n"),
    )
    summed = with_frames(
        placed,
        [Running("_v", "_sum"), Running("_n", "_count")],
        Series(entity="_part", time="_at", tie=("_last",)),
        max_rows,
        strategy,
    ).filter("_asks")
    means = summed.groupBy("_e", "_s").agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count")).select(
        F.col("_e").alias("_f"), F.col("_s").alias("_t"), F.when(F.col("_count") > 0, F.col("_sum") / F.col("_count")).alias("_mean")
    )
    own = F.struct(*[F.col(c) for c in df.columns])
    rows = df.select(F.col(e).alias("_e"), at.alias("_s"), own.alias("_row"))
    same = rows["_e"].eqNullSafe(means["_f"]) & (rows["_s"] == means["_t"])
    return rows.join(means, same, "left").select("_row.*", F.col("_mean").alias(name))
