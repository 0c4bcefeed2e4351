"""Bronze: raw rows with lineage columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratawell.config import SHEET_COLUMNS, STATION_DDL, WELLS_IN_SCOPE
from stratawell.functions.parsing import entity_key, to_day
from stratawell.operators.nested import stations_to_json
from stratawell.sources.production import POSITIONS

HEADER_MARK = SHEET_COLUMNS[0]


def bronze_production(
    sheet: DataFrame,
    wells: Sequence[str] | None = WELLS_IN_SCOPE,
    source_system: str = "production_sheet",
    ingestion_ts=None,
) -> DataFrame:
    """Positional text rows to named text columns; header rows and other wells are left out."""
    named = sheet.filter(F.col("_c0") != HEADER_MARK).select(
        *[F.col(p).alias(c) for p, c in zip(POSITIONS, SHEET_COLUMNS)],
        "source_file",
        *[c for c in sheet.columns if c not in (*POSITIONS, "source_file")],
    )
    keyed = named.withColumn("well_id", entity_key("WELL_BORE_CODE"))
    if wells is not None:
        keyed = keyed.filter(F.col("well_id").isin(list(wells)))
    return keyed.select(
        *SHEET_COLUMNS,
        "well_id",
        F.year(to_day("DATEPRD")).alias("date_year"),
        (F.current_timestamp() if ingestion_ts is None else ingestion_ts).alias("ingestion_ts"),
        F.lit(source_system).alias("source_system"),
        "source_file",
    )


def bronze_trajectory(
    documents: DataFrame, source_system: str = "survey_trajectory", ingestion_ts=None, as_text: bool = True
) -> DataFrame:
    """One row per trajectory document; the stations are kept as JSON text.

    Without ``as_text`` they stay an array under the same name: a chain that does not store this
    layer need not write text to parse it again.
    """
    stations = stations_to_json("trajectoryStation") if as_text else F.col("trajectoryStation").cast(STATION_DDL)
    return documents.select(
        F.col("_uid").alias("trajectory_uid"),
        F.col("_uidWell").alias("uid_well"),
        F.col("_uidWellbore").alias("uid_wellbore"),
        F.col("name").alias("trajectory_name"),
        F.col("nameWell").alias("name_well"),
        F.col("nameWellbore").alias("name_wellbore"),
        stations.alias("trajectory_stations_json"),
        "well_id",
        "source_path",
        (F.current_timestamp() if ingestion_ts is None else ingestion_ts).alias("ingestion_ts"),
        F.lit(source_system).alias("source_system"),
    )


def rows_per_well_year(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Row counts of wells and years, as a load check; ``limit`` gives the first ones only."""
    counts = (
        df.groupBy("well_id", "date_year")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("well_id", "date_year")
    )
    return counts if limit is None else counts.limit(limit)
