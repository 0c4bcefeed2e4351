"""Well-log text files (LAS): header values and curve data, with Spark expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stratawell.config import LOG_NULL_VALUE
from stratawell.functions.parsing import to_number, without_sentinel
from stratawell.sinks.tables import Lake

# Curves the drilling model reads.
COMMON_CURVES = ("DEPT", "RPM", "SWOB", "TFLO", "SPPA", "GR_CAL", "ECD", "ROP")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path and text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text")
    )


def _sections(text: Column) -> Column:
    """The sections of a log, each from the letter after its mark on."""
    return F.split(F.concat(F.lit("\n"), text), "\n~")


def _section(sections: Column, letter: str) -> Column:
    return F.get(F.filter(sections, lambda s: F.startswith(s, F.lit(letter))), F.lit(0))


# Patterns are matched on whole sections: a split into lines costs more than all of them. ``_B`` is a blank in a line.
_B = r"[^\S\n]"


def _header_value(section: Column, mnemonic: str) -> Column:
    found = F.regexp_extract_all(section, F.lit(rf"(?md)^{_B}*{mnemonic}{_B}*\.\S*{_B}+(.*?){_B}*:"), 1)
    return F.get(found, F.lit(0))


def _header_columns() -> list[Column]:
    """Well, log type, missing value and curve names from the header sections ``_well`` and ``_curves``."""
    missing = to_number(_header_value(F.col("_well"), "NULL"))
    # Each line but comments and blank ones has a name, if an empty one; the first is the section's heading.
    name = rf"(?md)^(?!{_B}*(?:#|$))(?:{_B}*([^\s.]+){_B}*\.)?"
    return [
        _header_value(F.col("_well"), "WELL").alias("well_name"),
        _header_value(F.col("_well"), "LTYP").alias("log_type"),
        F.coalesce(missing, F.lit(LOG_NULL_VALUE)).alias("null_value"),
        F.slice(F.regexp_extract_all("_curves", F.lit(name), 1), 2, 1 << 30).alias("curves"),
    ]


def _values(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(r"\S+"), 0)


def parse_logs(files: DataFrame) -> DataFrame:
    """One row per file and depth step: well, log type, and a map from curve to text value."""
    sections = files.select("source_path", _sections(F.col("text")).alias("_sections"))
    lines = F.slice(F.split(_section(F.col("_sections"), "A"), "\n"), 2, 1 << 30)
    split = sections.select(
        "source_path",
        _section(F.col("_sections"), "W").alias("_well"),
        _section(F.col("_sections"), "C").alias("_curves"),
        F.filter(lines, lambda line: ~line.rlike(r"^\s*(#|$)")).alias("_data"),
    )
    # Headers are read before the lines are dealt out: once a file, not once a line.
    headed = split.select("source_path", *_header_columns(), "_data")
    steps = headed.select(*[c for c in headed.columns if c != "_data"], F.posexplode("_data").alias("step", "line"))
    return steps.withColumn("values", _values(F.col("line"))).drop("line")


def logs_long(parsed: DataFrame) -> DataFrame:
    """(file, well, step, depth, curve, value); the first curve is the depth."""
    depth = to_number(F.get("values", F.lit(0)))
    rows = parsed.select(
        "source_path",
        "well_name",
        "log_type",
        "step",
        depth.alias("depth"),
        "null_value",
        F.explode(F.arrays_zip("curves", "values")).alias("c"),
    )
    value = to_number(F.col("c.values"))
    missing = (value == LOG_NULL_VALUE) | (value == F.col("null_value"))
    return rows.select(
        "source_path",
        "well_name",
        "log_type",
        "step",
        "depth",
        F.col("c.curves").alias("curve"),
        F.when(~missing, value).alias("value"),
    ).filter(F.col("curve").isNotNull())


def logs_wide(parsed: DataFrame, curves: Sequence[str] = COMMON_CURVES) -> DataFrame:
    """One column per curve; a curve the file lacks is NULL. No shuffle."""
    def text(curve: str) -> Column:
        """A line's value of a curve; names have a value at their own place, or none."""
        return F.get("values", F.array_position("curves", curve).cast("int") - 1)

    return parsed.select(
        "source_path",
        "well_name",
        "log_type",
        "step",
        *[
            F.nullif(without_sentinel(to_number(text(c))), F.col("null_value")).alias(c)
            for c in curves
        ],
    )


# ---- large logs, read by many tasks ------------------------------------------------------------------------

DATA_MARK = r"^~A"


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Data lines of all logs below ``path``: source_path, well_name, log_type, null_value, curves, step, values.

    Files are split like any text: a line knows its file and where the split that it was read from
    begins. The lines of a split are in order, so the line counts of the splits, one row each, tell a
    line's place in its file, and with it whether it stands in the header or in the data. Only the few
    header lines of a file are gathered. A file without a data section has no rows.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("source_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("value").alias("line"),
        )
        .filter(~F.col("line").rlike(r"^\s*(#|$)"))
        .withColumn("_at", F.monotonically_increasing_id())
    )
    splits = lines.groupBy("source_path", "_block").agg(
        F.min("_at").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(F.col("line").rlike(DATA_MARK), F.col("_at"))).alias("_mark"),
    )
    earlier = Window.partitionBy("source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source_path")
    based = splits.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
    layout = based.withColumn("_mark", F.min(F.col("_mark") + F.col("_base")).over(whole)).filter("_mark IS NOT NULL")
    placed = lines.join(layout.select("source_path", "_block", "_base", "_mark"), ["source_path", "_block"])
    placed = placed.withColumn("_place", F.col("_at") + F.col("_base"))

    ordered = F.array_sort(F.collect_list(F.struct("_place", "line")))
    text = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    headers = (
        placed.filter(F.col("_place") < F.col("_mark"))
        .groupBy("source_path")
        .agg(text.alias("_text"))
        .withColumn("_sections", _sections(F.col("_text")))
        .withColumn("_well", _section(F.col("_sections"), "W"))
        .withColumn("_curves", _section(F.col("_sections"), "C"))
        .select("source_path", *_header_columns())
    )
    data = placed.filter((F.col("_place") > F.col("_mark")) & ~F.startswith("line", F.lit("~")))
    return data.join(headers, "source_path").select(
        *headers.columns,
        (F.col("_place") - F.col("_mark") - 1).cast("int").alias("step"),
        _values(F.col("line")).alias("values"),
    )


def write_log_table(lake: Lake, table: str, rows: DataFrame, curves: Sequence[str] = COMMON_CURVES) -> int:
    """Store logs as a table by well and log type, one column per curve; returns the row count."""
    return lake.refresh(table, logs_wide(rows, curves), ["well_name", "log_type"], ["source_path", "step"])
