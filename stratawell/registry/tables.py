"""Table writes, each compared with a pure query of what the table must hold afterwards."""

from pyspark.sql import functions as F

from stratawell.registry.base import query, r, rounded, rs
from stratawell.registry.fixtures import SILVER_SQL, silver, table
from stratawell.session import scratch_path
from stratawell.sinks.tables import Lake

COLUMNS = ("well_id", "DATEPRD", "WELL_BORE_CODE", "date_year", "BORE_OIL_VOL", "BORE_GAS_VOL")
CLUSTER = ["well_id", "DATEPRD"]
PICK = f"well_id, DATEPRD, WELL_BORE_CODE, date_year, {rs('BORE_OIL_VOL', 'BORE_GAS_VOL')}"


def lake_with_silver(spark, sf, rows=None):
    lake = Lake(spark, scratch_path(spark, "tables"))
    rows = silver(spark, sf).select(*COLUMNS) if rows is None else rows
    written = lake.refresh("silver.production", rows, ["date_year"], CLUSTER)
    return lake, written


def content(lake):
    return rounded(lake.read("silver.production").select(*COLUMNS))


@query(
    "full_refresh",
    f"""WITH {SILVER_SQL} SELECT {PICK}, (SELECT count(*) FROM silver) AS n_written FROM silver""",
)
def full_refresh(spark, sf):
    """Written twice: the second write replaces the first; the count comes from the write."""
    lake, _ = lake_with_silver(spark, sf)
    rows = silver(spark, sf).select(*COLUMNS)
    n = lake.refresh("silver.production", rows, ["date_year"], CLUSTER)
    return content(lake).withColumn("n_written", F.lit(n).cast("long"))


@query("recluster", f"WITH {SILVER_SQL} SELECT {PICK} FROM silver")
def recluster(spark, sf):
    lake, _ = lake_with_silver(spark, sf)
    lake.recluster("silver.production", ["date_year"], CLUSTER)
    return content(lake)


@query(
    "window_reload",
    f"""WITH {SILVER_SQL}, first AS (
          SELECT min(DATEPRD) AS edge FROM silver
          WHERE DATEPRD >= DATE '2000-07-01' AND date_year = 2000 AND BORE_OIL_VOL > 0)
        SELECT well_id, DATEPRD, WELL_BORE_CODE, date_year, {r('BORE_OIL_VOL')},
               {r("CASE WHEN DATEPRD >= edge THEN BORE_GAS_VOL * 2 ELSE BORE_GAS_VOL END", 'BORE_GAS_VOL')}
        FROM silver, first WHERE DATEPRD < edge OR (date_year = 2000 AND BORE_OIL_VOL > 0)""",
)
def window_reload(spark, sf):
    """A batch from mid-2000 on, reloaded twice; later years of the old table go."""
    lake, _ = lake_with_silver(spark, sf)
    batch = (
        silver(spark, sf)
        .select(*COLUMNS)
        .filter(
            (F.col("DATEPRD") >= F.lit("2000-07-01").cast("date"))
            & (F.col("date_year") == 2000)
            & (F.col("BORE_OIL_VOL") > 0)
        )
        .withColumn("BORE_GAS_VOL", F.col("BORE_GAS_VOL") * 2)
    )
    for _ in range(2):
        lake.reload_from("silver.production", batch, "DATEPRD", cluster_by=CLUSTER)
    return content(lake)


@query(
    "upsert_latest",
    f"""WITH {SILVER_SQL}
        SELECT well_id, DATEPRD, WELL_BORE_CODE, date_year, {r('BORE_OIL_VOL')},
               {r('CASE WHEN date_year = 1999 AND BORE_OIL_VOL > 0 THEN -BORE_GAS_VOL ELSE BORE_GAS_VOL END', 'BORE_GAS_VOL')}
        FROM silver
        UNION ALL
        SELECT well_id || 'x', DATEPRD, WELL_BORE_CODE || 'x', date_year, {r('BORE_OIL_VOL')},
               {r('-BORE_GAS_VOL', 'BORE_GAS_VOL')}
        FROM silver WHERE date_year = 1999 AND BORE_OIL_VOL > 0""",
)
def upsert_latest(spark, sf):
    """Updates and inserts of one year; the other years are not rewritten."""
    lake, _ = lake_with_silver(spark, sf)
    changed = (
        silver(spark, sf)
        .select(*COLUMNS)
        .filter((F.col("date_year") == 1999) & (F.col("BORE_OIL_VOL") > 0))
        .withColumn("BORE_GAS_VOL", -F.col("BORE_GAS_VOL"))
    )
    added = changed.withColumns(
        {
            "well_id": F.concat("well_id", F.lit("x")),
            "WELL_BORE_CODE": F.concat("WELL_BORE_CODE", F.lit("x")),
        }
    )
    lake.upsert(
        "silver.production",
        changed.unionByName(added),
        ["DATEPRD", "WELL_BORE_CODE"],
        [F.desc("BORE_GAS_VOL")],
        cluster_by=CLUSTER,
    )
    return content(lake)


# Every 13th of a month has no date; such rows are told apart by their bore code.
UNDATED_SQL = f"""{SILVER_SQL}, part AS (
  SELECT well_id, CASE WHEN day(DATEPRD) = 13 THEN NULL ELSE DATEPRD END AS DATEPRD,
         WELL_BORE_CODE || strftime(DATEPRD, ' %Y-%m-%d') AS WELL_BORE_CODE,
         CASE WHEN day(DATEPRD) = 13 THEN NULL ELSE date_year END AS date_year, BORE_OIL_VOL, BORE_GAS_VOL
  FROM silver)"""


def undated(spark, sf):
    day = F.col("DATEPRD")
    dated = F.dayofmonth(day) != 13
    return silver(spark, sf).select(
        "well_id",
        F.when(dated, day).alias("DATEPRD"),
        F.concat_ws(" ", "WELL_BORE_CODE", day.cast("string")).alias("WELL_BORE_CODE"),
        F.when(dated, F.col("date_year")).alias("date_year"),
        "BORE_OIL_VOL",
        "BORE_GAS_VOL",
    )


@query(
    "upsert_null_year",
    f"""WITH {UNDATED_SQL}
        SELECT well_id, DATEPRD, WELL_BORE_CODE, date_year, {r('BORE_OIL_VOL')},
               {r('CASE WHEN date_year IS NULL AND BORE_OIL_VOL > 0 THEN -BORE_GAS_VOL ELSE BORE_GAS_VOL END', 'BORE_GAS_VOL')}
        FROM part""",
)
def upsert_null_year(spark, sf):
    """A batch without years changes its rows and leaves the other rows without a year."""
    lake, _ = lake_with_silver(spark, sf, undated(spark, sf))
    batch = undated(spark, sf).filter("date_year IS NULL AND BORE_OIL_VOL > 0")
    batch = batch.withColumn("BORE_GAS_VOL", -F.col("BORE_GAS_VOL"))
    for _ in range(2):
        lake.upsert("silver.production", batch, ["WELL_BORE_CODE"], [F.desc("BORE_GAS_VOL")], cluster_by=CLUSTER)
    return content(lake)


@query(
    "reload_null_date",
    f"""WITH {UNDATED_SQL}
        SELECT well_id, DATEPRD, WELL_BORE_CODE, date_year, {rs('BORE_OIL_VOL', 'BORE_GAS_VOL')} FROM part
        WHERE coalesce(date_year, 0) < 2000
        UNION ALL
        SELECT well_id, DATEPRD, WELL_BORE_CODE, date_year, {r('BORE_OIL_VOL')}, {r('-BORE_GAS_VOL', 'BORE_GAS_VOL')}
        FROM part WHERE coalesce(date_year, 2000) = 2000 AND BORE_OIL_VOL > 0""",
)
def reload_null_date(spark, sf):
    """A batch of 2000 with undated rows, loaded twice: stored undated rows stay, new ones come once."""
    lake, _ = lake_with_silver(spark, sf, undated(spark, sf))
    batch = undated(spark, sf).filter("coalesce(date_year, 2000) = 2000 AND BORE_OIL_VOL > 0")
    batch = batch.withColumn("BORE_GAS_VOL", -F.col("BORE_GAS_VOL")).drop("date_year")
    for _ in range(2):
        lake.reload_from("silver.production", batch, "DATEPRD", cluster_by=CLUSTER)
    return content(lake)


@query(
    "append_history",
    """SELECT o_orderstatus AS status, count(*) * 2 AS n_rows FROM orders GROUP BY 1""",
)
def append_history(spark, sf):
    """An append-only table, created empty, appended to twice."""
    lake = Lake(spark, scratch_path(spark, "tables"))
    lake.create_if_missing("history.runs", "status string, key bigint")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key")
    )
    for _ in range(2):
        lake.create_if_missing("history.runs", "status string, key bigint")
        lake.append("history.runs", rows)
    return lake.read("history.runs").groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "retention",
    f"""WITH {SILVER_SQL} SELECT {PICK} FROM silver
        WHERE date_year > (SELECT max(date_year) FROM silver) - 3""",
)
def retention(spark, sf):
    lake, _ = lake_with_silver(spark, sf)
    newest = lake.read("silver.production").agg(F.max("date_year")).first()[0]
    lake.retain_years("silver.production", 3, newest)
    return content(lake)


@query(
    "backfill_day",
    f"""WITH {SILVER_SQL}, changed AS (
          SELECT * REPLACE (CASE WHEN DATEPRD = DATE '1998-06-15' THEN BORE_OIL_VOL + 10
                            ELSE BORE_OIL_VOL END AS BORE_OIL_VOL) FROM silver)
        SELECT well_id, DATEPRD, WELL_BORE_CODE, {rs('BORE_OIL_VOL')},
               {r('''avg(BORE_OIL_VOL) OVER (PARTITION BY well_id ORDER BY DATEPRD
                     ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)''', 'oil_vol_30d_avg')} FROM changed""",
)
def backfill_day(spark, sf):
    """One day is corrected in the source table; only rows whose frames see it are recomputed."""
    from stratawell.operators.frames import Trailing, with_frames
    from stratawell.plans.backfill import backfill

    keep = ("well_id", "DATEPRD", "WELL_BORE_CODE", "date_year", "BORE_OIL_VOL")
    measure = [Trailing("BORE_OIL_VOL", "oil_vol_30d_avg", 30)]
    lake, _ = lake_with_silver(spark, sf, silver(spark, sf).select(*keep))
    lake.refresh(
        "gold.rolling", with_frames(lake.read("silver.production"), measure), ["date_year"], CLUSTER
    )
    day = F.lit("1998-06-15").cast("date")
    corrected = (
        silver(spark, sf)
        .select(*keep)
        .filter(F.col("DATEPRD") == day)
        .withColumn("BORE_OIL_VOL", F.col("BORE_OIL_VOL") + 10)
    )
    backfill(lake, "silver.production", "gold.rolling", corrected, "1998-06-15", measure)
    return rounded(
        lake.read("gold.rolling").select(
            "well_id", "DATEPRD", "WELL_BORE_CODE", "BORE_OIL_VOL", "oil_vol_30d_avg"
        )
    )
