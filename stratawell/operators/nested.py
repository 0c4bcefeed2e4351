"""Survey documents: nested station arrays to flat, typed rows and back to JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratawell.config import STATION_DDL, STATION_MEASURES
from stratawell.functions import kpis
from stratawell.functions.parsing import to_number


def stations_to_json(stations: Column | str) -> Column:
    return F.to_json(stations)


def parse_stations(text: Column | str) -> Column:
    """JSON text to an array of stations.

    A document with a single station may hold an object instead of an array; it becomes an array
    of one. Unknown fields are ignored, missing ones and unreadable text give NULL.
    """
    return F.from_json(text, STATION_DDL)


def explode_stations(df: DataFrame, json_column: str = "trajectory_stations_json") -> DataFrame:
    """One row per station in a ``station`` column; documents without stations vanish.

    The column holds JSON text, or the stations as an array where they were never stored as text.
    """
    # The outer form keeps Spark from adding its own emptiness filter, which would parse every
    # document a second time; NULL, 'null' and empty documents give a NULL station, dropped here.
    others = [c for c in df.columns if c != json_column]
    text = dict(df.dtypes)[json_column] == "string"
    stations = parse_stations(F.col(json_column)) if text else F.col(json_column)
    return df.select(*others, F.explode_outer(stations).alias("station")).filter(F.col("station").isNotNull())


def flatten_stations(df: DataFrame) -> DataFrame:
    """Typed measurement columns in place of the ``station`` struct."""
    others = [c for c in df.columns if c != "station"]
    measures = [
        to_number(F.col(f"station.{m}._VALUE")).alias(name) for m, name in STATION_MEASURES.items()
    ]
    return df.select(
        *others,
        F.col("station._uid").alias("station_uid"),
        measures[0],
        F.col("station.md._uom").alias("md_uom"),
        *measures[1:],
    )


def station_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_md_valid": kpis.at_least_zero("md_m"),
            "is_incl_valid": kpis.in_range("incl_deg", 0, 180),
            "is_azi_valid": kpis.in_range("azi_deg", 0, 360),
        }
    )


def measure_struct(value: Column, unit: str) -> Column:
    """A measurement as it stands in a document: text value with its unit."""
    return F.struct(value.cast("string").alias("_VALUE"), F.lit(unit).alias("_uom"))
