"""Correcting one past day without recomputing the whole history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from stratawell.config import PRODUCTION, Series
from stratawell.operators.frames import Lag, Lead, Measure, Trailing, with_frames
from stratawell.session import materialize
from stratawell.sinks.tables import Lake


def backfill(
    lake: Lake,
    source: str,
    target: str,
    day_rows: DataFrame,
    day: str,
    measures: Sequence[Measure],
    series: Series = PRODUCTION,
    partition: str = "date_year",
) -> None:
    """Replace one day of ``source`` and refresh the rows of ``target`` whose frames see it.

    ``measures`` have to be row frames of fixed length. A frame of k rows can reach the day from
    at most k rows later, and needs the k rows before those: per entity that is a stretch of 2k
    rows around the day, found by ranking rows within it.
    """
    if not all(isinstance(m, (Lag, Lead, Trailing)) for m in measures):
        raise ValueError("only frames of a fixed number of rows can be backfilled in part")
    reach = max(m.rows for m in measures)
    at = F.lit(day).cast("date")
    year = int(day[:4])
    e, t = series.entity, series.time
    cluster = [e, *series.order]

    kept = lake.read(source).filter((F.col(partition) == year) & (F.col(t) != at))
    lake.replace_partition(
        source, kept.unionByName(day_rows.select(*kept.columns)), partition, year, cluster
    )

    rows = lake.read(source)
    # Rank filters are applied before the shuffle, so an entity sends only the rows near the day.
    before = Window.partitionBy(e).orderBy(*[F.desc(c) for c in series.order])
    after = Window.partitionBy(e).orderBy(*series.order)
    earlier = rows.filter(F.col(t) < at).withColumn("_k", F.row_number().over(before))
    later = rows.filter(F.col(t) > at).withColumn("_k", F.row_number().over(after))
    ahead = max((m.rows for m in measures if isinstance(m, Lead)), default=0)
    stretch = (
        earlier.filter(F.col("_k") <= 2 * reach)
        .withColumn("_due", F.col("_k") <= ahead)
        .unionByName(rows.filter(F.col(t) == at).withColumns({"_k": F.lit(0), "_due": F.lit(True)}))
        .unionByName(
            later.filter(F.col("_k") <= 2 * reach).withColumn("_due", F.col("_k") <= reach)
        )
    )
    fresh = materialize(with_frames(stretch.drop("_k"), measures, series).filter("_due").drop("_due"))

    keys = [e, *series.order]
    years = lake.years(fresh, partition) | {year}
    old = lake.read(target).filter(F.col(partition).isin(list(years)))
    others = old.filter(F.col(t) != at).join(fresh.select(*keys), keys, "left_anti")
    # Written before the first of these years is replaced, since it reads all of them.
    merged = materialize(others.unionByName(fresh.select(*old.columns)))
    for y in sorted(years):
        lake.replace_partition(target, merged.filter(F.col(partition) == y), partition, y, cluster)
