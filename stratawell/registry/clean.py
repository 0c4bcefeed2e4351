"""Cleaning: de-duplication, tolerant casts, dates, keys, ratios, flags, raw-to-silver."""

from pyspark.sql import functions as F

from stratawell.config import WELLS_IN_SCOPE
from stratawell.functions.parsing import entity_key, to_day, to_number
from stratawell.operators.dedupe import latest_per_key
from stratawell.plans.bronze import bronze_production, rows_per_well_year
from stratawell.plans.silver import production_summary, silver_production
from stratawell.registry.base import plain_r, query, rounded, rs
from stratawell.registry.fixtures import (
    RAW_SQL,
    SILVER_SQL,
    daily,
    raw_sheet,
    silver,
    table,
)

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(
    "dedupe_latest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
         FROM lineitem) WHERE rn = 1""",
)
def dedupe_latest(spark, sf):
    rows = table(spark, sf, "lineitem")
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
    return latest_per_key(rows, LINE_KEY, order).select(
        *LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice"
    )


@query(
    "tolerant_cast",
    f"""WITH {RAW_SQL}
        SELECT load_no, {rs('AVG_DOWNHOLE_PRESSURE', 'ON_STREAM_HRS', 'BORE_GAS_VOL')} FROM raw""",
)
def tolerant_cast(spark, sf):
    sheet = raw_sheet(spark, sf)
    return rounded(
        sheet.select(
            F.unix_seconds("loaded_ts").alias("load_no"),
            to_number("_c9").alias("AVG_DOWNHOLE_PRESSURE"),
            to_number("_c8").alias("ON_STREAM_HRS"),
            to_number("_c19").alias("BORE_GAS_VOL"),
        )
    )


@query(
    "date_parse_reject",
    f"""WITH {RAW_SQL}
        SELECT DATEPRD, CAST(year(DATEPRD) AS INTEGER) AS date_year, count(*) AS n_rows
        FROM raw WHERE NOT is_header AND DATEPRD IS NOT NULL GROUP BY ALL""",
)
def date_parse_reject(spark, sf):
    parsed = raw_sheet(spark, sf).select(to_day("_c0").alias("DATEPRD"))
    return (
        parsed.filter(F.col("DATEPRD").isNotNull())
        .groupBy("DATEPRD", F.year("DATEPRD").alias("date_year"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "entity_key_extract",
    """SELECT s_suppkey AS id, s_name AS name, regexp_extract(s_name, '#[0-9]+', 0) AS entity
       FROM supplier
       UNION ALL SELECT p_partkey, p_name, regexp_extract(p_name, '#[0-9]+', 0) FROM part
       UNION ALL SELECT c_custkey, c_name, regexp_extract(c_name, '#[0-9]+', 0) FROM customer""",
)
def entity_key_extract(spark, sf):
    names = (
        table(spark, sf, "supplier")
        .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
        .unionAll(table(spark, sf, "part").select("p_partkey", "p_name"))
        .unionAll(table(spark, sf, "customer").select("c_custkey", "c_name"))
    )
    return names.withColumn("entity", entity_key("name", "#[0-9]+"))


@query("ratio_kpis", f"WITH {SILVER_SQL} SELECT well_id, DATEPRD, {rs('water_cut_pct', 'gas_oil_ratio')} FROM silver")
def ratio_kpis(spark, sf):
    return rounded(silver(spark, sf).select("well_id", "DATEPRD", "water_cut_pct", "gas_oil_ratio"))


@query(
    "quality_flags",
    f"WITH {SILVER_SQL} SELECT well_id, DATEPRD, is_zero_prod_uptime, is_pressure_valid FROM silver",
)
def quality_flags(spark, sf):
    return silver(spark, sf).select("well_id", "DATEPRD", "is_zero_prod_uptime", "is_pressure_valid")


@query(
    "scope_filter",
    f"""WITH {SILVER_SQL} SELECT well_id, DATEPRD, {rs('BORE_OIL_VOL', 'BORE_GAS_VOL')} FROM silver
        WHERE well_id IN ('F-1', 'F-11', 'F-12')""",
)
def scope_filter(spark, sf):
    return rounded(
        daily(spark, sf)
        .filter(F.col("well_id").isin(*WELLS_IN_SCOPE))
        .select("well_id", "DATEPRD", "BORE_OIL_VOL", "BORE_GAS_VOL")
    )


# ---- raw rows to bronze and silver ----------------------------------------------------------------


def bronze(spark, sf, wells=None):
    sheet = raw_sheet(spark, sf)
    return bronze_production(sheet, wells, ingestion_ts=F.col("loaded_ts"))


def clean(spark, sf, **options):
    return silver_production(bronze(spark, sf), processed_ts=F.lit(None).cast("timestamp"), **options)


@query(
    "bronze_production",
    f"""WITH {RAW_SQL}
        SELECT load_no, coalesce(WELL_BORE_CODE, '') AS WELL_BORE_CODE, well_id,
               CAST(year(DATEPRD) AS INTEGER) AS date_year, source_file
        FROM raw WHERE NOT is_header AND NOT no_date AND well_id IN ('F-1', 'F-11', 'F-12')""",
)
def bronze_rows(spark, sf):
    return bronze(spark, sf, WELLS_IN_SCOPE).select(
        F.unix_seconds("ingestion_ts").alias("load_no"),
        "WELL_BORE_CODE",
        "well_id",
        "date_year",
        "source_file",
    )


CLEAN_SQL = (
    RAW_SQL
    + """,
clean AS (
  SELECT * FROM (
    SELECT *, CAST(year(DATEPRD) AS INTEGER) AS date_year,
           row_number() OVER (PARTITION BY WELL_BORE_CODE, DATEPRD ORDER BY load_no DESC) AS rn
    FROM raw WHERE NOT is_header AND DATEPRD IS NOT NULL AND WELL_BORE_CODE IS NOT NULL)
  WHERE rn = 1
),
kpi AS (
  SELECT *, CASE WHEN BORE_OIL_VOL + BORE_WAT_VOL > 0
                 THEN BORE_WAT_VOL / (BORE_OIL_VOL + BORE_WAT_VOL) * 100.0 END AS water_cut_pct,
         CASE WHEN BORE_OIL_VOL > 0 THEN BORE_GAS_VOL / BORE_OIL_VOL END AS gas_oil_ratio,
         coalesce(BORE_OIL_VOL = 0 AND ON_STREAM_HRS > 0, false) AS is_zero_prod_uptime,
         coalesce(AVG_DOWNHOLE_PRESSURE BETWEEN 0 AND 10000, false) AS is_pressure_valid
  FROM clean
)"""
)


@query(
    "silver_production",
    f"""WITH {CLEAN_SQL}
        SELECT DATEPRD, WELL_BORE_CODE, coalesce(well_id, '') AS well_id, date_year, load_no,
               {rs('AVG_DOWNHOLE_PRESSURE', 'ON_STREAM_HRS', 'BORE_OIL_VOL', 'BORE_GAS_VOL')},
               {rs('BORE_WAT_VOL', 'water_cut_pct', 'gas_oil_ratio')},
               is_zero_prod_uptime, is_pressure_valid, FLOW_KIND
        FROM kpi""",
)
def silver_rows(spark, sf):
    return rounded(
        clean(spark, sf)
        .withColumn("load_no", F.unix_seconds("ingestion_ts"))
        .select(
            "DATEPRD", "WELL_BORE_CODE", "well_id", "date_year", "load_no",
            "AVG_DOWNHOLE_PRESSURE", "ON_STREAM_HRS", "BORE_OIL_VOL", "BORE_GAS_VOL",
            "BORE_WAT_VOL", "water_cut_pct", "gas_oil_ratio",
            "is_zero_prod_uptime", "is_pressure_valid", "FLOW_KIND",
        )
    )


@query(
    "flow_kind_filter",
    f"""WITH {RAW_SQL}
        SELECT well_id, count(*) AS n_rows,
               count(*) FILTER (WHERE BORE_OIL_VOL IS NULL) AS n_oil_null
        FROM (SELECT DISTINCT ON (WELL_BORE_CODE, DATEPRD) coalesce(well_id, '') AS well_id,
                     BORE_OIL_VOL
              FROM raw WHERE NOT is_header AND DATEPRD IS NOT NULL
                         AND WELL_BORE_CODE IS NOT NULL AND FLOW_KIND = 'production'
              ORDER BY WELL_BORE_CODE, DATEPRD, load_no DESC)
        GROUP BY well_id""",
)
def flow_kind_filter(spark, sf):
    kept = clean(spark, sf, flow_kind="production", oil_null_flag=True)
    return kept.groupBy("well_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_oil_null").alias("n_oil_null")
    )


@query(
    "counts_by_year",
    f"""WITH {RAW_SQL}
        SELECT well_id, CAST(year(DATEPRD) AS INTEGER) AS date_year, count(*) AS row_count
        FROM raw WHERE NOT is_header AND NOT no_date AND well_id IS NOT NULL GROUP BY ALL""",
)
def counts_by_year(spark, sf):
    return rows_per_well_year(bronze(spark, sf, None).filter(F.length("well_id") > 0))


@query(
    "counts_by_year_first_30",
    f"""WITH {RAW_SQL}
        SELECT well_id, CAST(year(DATEPRD) AS INTEGER) AS date_year, count(*) AS row_count
        FROM raw WHERE NOT is_header AND NOT no_date AND well_id IN ('F-1', 'F-11', 'F-12')
        GROUP BY ALL ORDER BY well_id, date_year NULLS FIRST LIMIT 30""",
)
def counts_by_year_first_30(spark, sf):
    """The console report: the first 30 counts of the wells in scope."""
    return rows_per_well_year(bronze(spark, sf, WELLS_IN_SCOPE), limit=30)


@query(
    "silver_summary",
    f"""WITH {SILVER_SQL}
        SELECT well_id, date_year, count(*) AS rows,
               {plain_r('avg(water_cut_pct)', 'avg_water_cut_pct', 2)},
               {plain_r('avg(gas_oil_ratio)', 'avg_gor', 4)},
               count(*) FILTER (WHERE is_zero_prod_uptime) AS zero_prod_days,
               count(*) FILTER (WHERE NOT is_pressure_valid) AS invalid_pressure_rows
        FROM silver GROUP BY ALL""",
)
def silver_summary(spark, sf):
    return production_summary(silver(spark, sf))
