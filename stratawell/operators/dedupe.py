"""Keeping one row per key, and finding keys that repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], total_order: bool = True
) -> DataFrame:
    """Keep the first row of each key under ``newest_first``.

    The rank filter lets Spark drop all but one row per key before the shuffle, so a key that
    holds a large share of the rows costs one row per input task. A hash of the whole row breaks
    the remaining ties, which makes reruns give the same rows.
    """
    order = list(newest_first)
    if total_order:
        order.append(F.xxhash64(*[F.col(c) for c in df.columns]).asc())
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys, rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_surplus"),
        F.count_if(F.col("_n") > 1).alias("n_repeated_keys"),
    )
