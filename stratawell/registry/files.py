"""File formats: the given tables written out as source files, or shaped like them, and read back."""

import io
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from stratawell.plans.bronze import bronze_production, bronze_trajectory
from stratawell.plans.silver import silver_trajectory
from stratawell.registry.base import query, r, rounded
from stratawell.registry.fixtures import RAW_SQL, STATIONS_SQL, raw_sheet, spread_lines, table, trajectory_documents
from stratawell.session import scratch_path, spread
from stratawell.sinks.tables import Lake
from stratawell.sources.folders import write_files
from stratawell.sources.production import POSITIONS, count_source_files, decode_workbooks, read_csv_sheet
from stratawell.sources.trajectory import read_trajectories, route_document, route_documents, write_documents
from stratawell.sources.welllogs import logs_long, logs_wide, parse_logs, read_log_lines, write_log_table


def workbook(rows) -> bytes:
    """A minimal workbook with one sheet of text cells."""
    cells = []
    for n, row in enumerate(rows, 1):
        cells.append(f'<row r="{n}">')
        for i, value in enumerate(row):
            if value is not None:
                name = chr(65 + i)  # at most 24 columns
                cells.append(
                    f'<c r="{name}{n}" t="inlineStr"><is><t>{escape(str(value))}</t></is></c>'
                )
        cells.append("</row>")
    return book("".join(cells).encode())


def book(rows: bytes) -> bytes:
    """A workbook around the row elements of its only sheet."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    docs = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
        archive.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{docs}"><sheets>'
            '<sheet name="Daily" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        archive.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{docs}/worksheet" '
            'Target="worksheets/sheet1.xml"/></Relationships>',
        )
        archive.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{main}"><sheetData>'.encode() + rows + b"</sheetData></worksheet>",
        )
    return out.getvalue()


def row_elements(batch: pa.RecordBatch) -> bytes:
    """The rows of a batch as row elements with text cells, column by column."""
    at = pa.array(range(1, batch.num_rows + 1)).cast(pa.string())
    cells = []
    for i, values in enumerate(batch.columns):
        if values.null_count == len(values):
            continue
        for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            values = pc.replace_substring(values, plain, escaped)
        cell = pc.binary_join_element_wise(f'<c r="{chr(65 + i)}', at, '" t="inlineStr"><is><t>', values, "</t></is></c>", "")
        cells.append(pc.fill_null(cell, ""))
    rows = pc.binary_join_element_wise('<row r="', at, '">', *cells, "</row>", "")
    return "".join(rows.to_pylist()).encode()


def to_workbooks(sheet):
    """Each Arrow batch of rows as one workbook, so no workbook grows with the data."""

    def encode(batches):
        for n, batch in enumerate(batches):
            content = pa.array([book(row_elements(batch))], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([f"book-{n}.xlsx"]), content], names=["path", "content"])

    return sheet.select(*POSITIONS).mapInArrow(encode, "path string, content binary")


BRONZE_COUNT_SQL = f"""WITH {RAW_SQL}
    SELECT well_id, CAST(year(DATEPRD) AS INTEGER) AS date_year, count(*) AS n_rows,
           {r('sum(BORE_GAS_VOL)', 'gas')}
    FROM raw WHERE NOT is_header AND NOT no_date AND well_id IS NOT NULL GROUP BY ALL"""


def bronze_counts(sheet):
    rows = bronze_production(sheet, None).filter(F.length("well_id") > 0)
    gas = F.sum(F.col("BORE_GAS_VOL").try_cast("double"))
    return rounded(
        rows.groupBy("well_id", "date_year").agg(
            F.count(F.lit(1)).alias("n_rows"), gas.alias("gas")
        )
    )


@query("xlsx_production", BRONZE_COUNT_SQL)
def xlsx_production(spark, sf):
    return bronze_counts(decode_workbooks(to_workbooks(raw_sheet(spark, sf))))


@query("csv_production", BRONZE_COUNT_SQL)
def csv_production(spark, sf):
    path = scratch_path(spark, "sheet")
    raw_sheet(spark, sf).select(*POSITIONS).write.csv(path)
    return bronze_counts(read_csv_sheet(spark, path))


def write_xml(docs, path, *folders):
    """Documents as compressed files: tags and units are most of their text.

    A folder is written by one task, or by few if it is large; else each task leaves a file in every folder.
    """
    if folders:
        docs = docs.hint("rebalance", *[F.col(c) for c in folders])
    files = docs.write.format("xml").option("rootTag", "trajectorys").option("rowTag", "trajectory")
    files.option("compression", "gzip").partitionBy(*folders).save(path)


@query(
    "xml_trajectory",
    f"""WITH {STATIONS_SQL}
        SELECT well_id, trajectory_uid, station_uid, {r('md_m')}, {r('azi_deg')}, {r('dls_deg_per_30m')},
               is_md_valid, is_incl_valid, is_azi_valid FROM survey""",
)
def xml_trajectory(spark, sf):
    """All documents as XML files in well folders."""
    root = scratch_path(spark, "surveys")
    docs = trajectory_documents(spark, sf)
    placed = docs.select(
        *[c for c in docs.columns if c not in ("well_id", "source_path")],
        F.concat(F.lit("Norway-"), F.col("well_id"), F.lit(" main")).alias("folder"),
    )
    write_xml(placed, f"{root}/1/trajectory", "folder")
    found = read_trajectories(
        spark,
        f"{root}/1/trajectory",
        wells=None,
        pattern="*/*",
        layout=r"/([^/.]+)/[^/]+$",
    )
    flat = silver_trajectory(bronze_trajectory(found))
    return rounded(
        flat.select(
            "well_id", "trajectory_uid", "station_uid", "md_m", "azi_deg", "dls_deg_per_30m",
            "is_md_valid", "is_incl_valid", "is_azi_valid",
        )
    )


def log_files(spark, sf):
    """One log of one to three depth steps per line item."""
    step = F.transform(
        F.sequence(F.lit(1), F.col("l_linenumber") % 3 + 1),
        lambda i: F.concat_ws(
            "  ",
            (i * 10 + F.col("l_linenumber")).cast("string"),
            F.when(F.col("l_linenumber") == 1, "-999.25").otherwise(
                F.col("l_quantity").cast("string")
            ),
            (F.col("l_extendedprice") * i).cast("decimal(18,2)").cast("string"),
        ),
    )
    text = F.concat(
        F.lit("~VERSION INFORMATION\n VERS.  2.0 : format\n WRAP.  NO : one line per step\n"),
        F.lit("~WELL INFORMATION\n# mnemonic\n NULL.  -999.25 : missing\n WELL.  F-"),
        F.col("l_suppkey"),
        F.lit(" : well\n~CURVE INFORMATION\n DEPT.M : depth\n ROP.M/H : rate\n GR_CAL.API : gamma\n~A\n"),
        F.array_join(step, "\n"),
        F.lit("\n"),
    )
    uid = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return spread_lines(spark, sf).select(uid.alias("source_path"), text.alias("text"))


LOGS_SQL = """logs AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS source_path,
         'F-' || l_suppkey AS well_name, CAST(i - 1 AS INTEGER) AS step,
         CAST(i * 10 + l_linenumber AS DOUBLE) AS dept,
         CASE WHEN l_linenumber <> 1 THEN l_quantity END AS rop,
         CAST(CAST(l_extendedprice * i AS DECIMAL(18,2)) AS DOUBLE) AS gr
  FROM lineitem, unnest(range(1, l_linenumber % 3 + 2)) AS s(i))"""


@query(
    "las_logs",
    f"""WITH {LOGS_SQL}
        SELECT source_path, well_name, step, {r('dept', 'DEPT')}, {r('rop', 'ROP')}, {r('gr', 'GR_CAL')},
               CAST(NULL AS DOUBLE) AS ECD FROM logs""",
)
def las_logs(spark, sf):
    wide = logs_wide(parse_logs(log_files(spark, sf)), ("DEPT", "ROP", "GR_CAL", "ECD"))
    return rounded(wide.drop("log_type"))


@query(
    "las_logs_long",
    f"""WITH {LOGS_SQL}, long AS (
          SELECT well_name, 'DEPT' AS curve, dept AS value FROM logs
          UNION ALL SELECT well_name, 'ROP', rop FROM logs
          UNION ALL SELECT well_name, 'GR_CAL', gr FROM logs)
        SELECT well_name, curve, count(*) AS n_steps, count(value) AS n_values, {r('avg(value)', 'mean')}
        FROM long GROUP BY ALL""",
)
def las_logs_long(spark, sf):
    long = logs_long(parse_logs(log_files(spark, sf)))
    return rounded(
        long.groupBy("well_name", "curve").agg(
            F.count(F.lit(1)).alias("n_steps"),
            F.count("value").alias("n_values"),
            F.avg("value").alias("mean"),
        )
    )


def large_logs(spark, sf, folder):
    """A few logs of many lines on disk: one per well (eight) and kind, in the order of the line items."""
    well = F.concat(F.lit("F-"), F.col("l_suppkey") % 8)
    line = F.concat_ws(
        "  ",
        F.col("l_orderkey").cast("string"),
        F.when(F.col("l_linenumber") == 1, "-999.25").otherwise(F.col("l_quantity").cast("string")),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
    )
    header = F.concat(
        F.lit("~VERSION INFORMATION\n VERS.  2.0 : format\n~WELL INFORMATION\n# mnemonic\n NULL.  -999.25 : missing\n WELL.  "),
        F.col("well"), F.lit(" : well\n LTYP.  "), F.col("l_returnflag"),
        F.lit(" : type\n~CURVE INFORMATION\n DEPT.M : depth\n ROP.M/H : rate\n GR_CAL.API : gamma\n~A\n# data"),
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "line"]
    lines = table(spark, sf, "lineitem").select(well.alias("well"), "l_returnflag", *order[:3], line.alias("line"))
    log = F.concat_ws("-", "well", "l_returnflag").alias("log")
    # Without a well or a kind there is no header, so no data section either: such a log is empty.
    headers = lines.select("well", "l_returnflag").distinct().select(log, F.coalesce(header, F.lit("")).alias("line"))
    data = lines.filter(F.col("well").isNotNull() & F.col("l_returnflag").isNotNull()).select(log, *order)
    # A log is one file, so one task writes it; sorting spills, where gathering its lines into one row does not.
    rows = headers.withColumn("_first", F.lit(True)).unionByName(data.withColumn("_first", F.lit(False)), allowMissingColumns=True)
    placed = rows.repartition("log").sortWithinPartitions("log", F.desc("_first"), *order)
    placed.select("log", F.col("line").alias("value")).write.partitionBy("log").text(folder)


SPLITS = 256


def split_bytes(spark, path):
    """Bytes of a split, so that the files below ``path`` have several splits each, and not many more than ``SPLITS``."""
    listed = spark.read.format("binaryFile").load(path).agg(F.sum("length"), F.max("length")).first()
    total, longest = listed
    return max(16 << 10, min(total // SPLITS, longest // 2, 128 << 20))


@query(
    "las_table",
    f"""SELECT 'F-' || (l_suppkey % 8) AS well_name, l_returnflag AS log_type,
               CAST(row_number() OVER (PARTITION BY l_suppkey % 8, l_returnflag
                    ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS INTEGER) AS step,
               CAST(l_orderkey AS DOUBLE) AS "DEPT",
               {r("CASE WHEN l_linenumber <> 1 THEN l_quantity END", '"ROP"')},
               {r('CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE)', '"GR_CAL"')} FROM lineitem""",
)
def las_table(spark, sf):
    """Logs on disk, each read in several splits, stored by well and log type.

    Splits grow with the logs, up to Spark's own size: small splits of large logs would only send more task results.
    """
    folder, lake = scratch_path(spark, "logs"), Lake(spark, scratch_path(spark, "log-lake"))
    large_logs(spark, sf, folder)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(split_bytes(spark, f"{folder}/*")))
    try:
        write_log_table(lake, "bronze.well_logs", read_log_lines(spark, f"{folder}/*"), ("DEPT", "ROP", "GR_CAL"))
    finally:
        spark.conf.set(name, before)
    stored = lake.read("bronze.well_logs").select("well_name", "log_type", "step", "DEPT", "ROP", "GR_CAL")
    return rounded(stored)


@query(
    "route_docs",
    """SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'well_info' WHEN 1 THEN 'wellbore_info'
              WHEN 2 THEN 'trajectory' WHEN 3 THEN 'messages' WHEN 4 THEN 'bha'
              WHEN 5 THEN 'mud_log' ELSE 'other' END AS doc_type FROM pages""",
)
def route_docs(spark, sf):
    parts = F.array(
        *[F.lit(p) for p in ("_wellInfo", "_wellboreInfo", "trajectory", "message", "bhaRun", "mudLog", "log")]
    )
    path = F.concat(F.col("url"), F.lit("/"), F.get(parts, (F.col("page_id") % 7).cast("int")), F.lit("/1.xml"))
    return table(spark, sf, "pages").select("page_id", route_document(path).alias("doc_type"))


@query(
    "route_files",
    """SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'well_info' WHEN 1 THEN 'wellbore_info'
              WHEN 2 THEN 'trajectory' WHEN 3 THEN 'messages' WHEN 4 THEN 'bha'
              WHEN 5 THEN 'mud_log' ELSE 'other' END AS doc_type FROM pages""",
)
def route_files(spark, sf):
    """A file for each page, in folders of several depths, some below underscore folders."""
    root = scratch_path(spark, "documents")
    names = ("_wellInfo", "_wellboreInfo", "trajectory", "message", "bhaRun", "mudLog", "log")
    # Each page is a file of its own: one task would create them one by one.
    pages = spread(table(spark, sf, "pages"))
    above = F.get(F.array(*[F.lit(a) for a in ("a", "a/b/c/d", "a/_u/c")]), (F.floor(F.col("page_id") / 7) % 3).cast("int"))
    kind = F.get(F.array(*[F.lit(n) for n in names]), (F.col("page_id") % 7).cast("int"))
    # One file per page, under its own folder.
    placed = pages.select(
        F.concat(above, F.lit("/"), kind).alias("folder"),
        F.col("page_id").alias("n"),
        F.concat(F.lit("page "), F.col("page_id")).alias("value"),
    )
    write_files(placed.filter("folder IS NOT NULL"), root)
    found = route_documents(spark, root)
    page = F.regexp_extract("path", r"/n=([0-9]+)/[^/]+$", 1).cast("long")
    return found.select(page.alias("page_id"), "doc_type")


NAMES = ("_wellInfo", "_wellboreInfo", "trajectory", "message", "bhaRun", "mudLog", "log")
TAGS = ("well", "wellbore", "trajectory", "message", "bhaRun", "mudLog", "log")


def documents_on_disk(spark, sf, root):
    """One XML file per page, in the folder of its type; some are cut short, some hold another element."""
    pages = spread(table(spark, sf, "pages"))
    kind = (F.col("page_id") % 7).cast("int")
    own = F.get(F.array(*[F.lit(t) for t in TAGS]), kind)
    tag = F.when(F.col("page_id") % 13 == 5, "unknown").otherwise(own)
    name = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<name>n"), F.col("page_id"), F.lit("</name>"))).otherwise("")
    text = F.concat(
        F.lit('<?xml version="1.0"?><docs><'), tag, F.lit(' uid="u'), F.col("page_id"), F.lit('">'), name,
        F.lit("<commonData><sourceName>s"), F.col("page_id") % 5, F.lit("</sourceName></commonData></"), tag, F.lit("></docs>"),
    )
    cut = F.when(F.col("page_id") % 11 == 3, F.substring(text, 1, 40)).otherwise(text)
    folder = F.concat(F.lit("field/"), F.get(F.array(*[F.lit(f) for f in NAMES]), kind))
    placed = pages.select(folder.alias("folder"), F.col("page_id").alias("n"), cut.alias("value"))
    write_files(placed.filter("folder IS NOT NULL"), root)


@query(
    "documents_table",
    """WITH p AS (
          SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'well_info' WHEN 1 THEN 'wellbore_info'
                   WHEN 2 THEN 'trajectory' WHEN 3 THEN 'messages' WHEN 4 THEN 'bha'
                   WHEN 5 THEN 'mud_log' ELSE 'other' END AS doc_type,
                 page_id % 11 = 3 AS cut, page_id % 13 = 5 AS unknown FROM pages)
        SELECT page_id, doc_type,
               CASE WHEN doc_type = 'other' THEN 'no document type' WHEN cut THEN 'not readable as XML'
                    WHEN unknown THEN 'no element of its type' END AS reason,
               CASE WHEN doc_type <> 'other' AND NOT cut AND NOT unknown THEN 'u' || page_id END AS uid,
               CASE WHEN doc_type <> 'other' AND NOT cut AND NOT unknown AND page_id % 2 = 0 THEN 'n' || page_id END AS name,
               CASE WHEN doc_type <> 'other' AND NOT cut AND NOT unknown THEN 's' || (page_id % 5) END AS "sourceName"
        FROM p""",
)
def documents_table(spark, sf):
    """All documents in one pass: stored by type, rejected ones in a table of their own."""
    root, lake = scratch_path(spark, "all-documents"), Lake(spark, scratch_path(spark, "documents-lake"))
    documents_on_disk(spark, sf, root)
    write_documents(lake, root)
    page = F.regexp_extract("source_path", r"/n=([0-9]+)/[^/]+$", 1).cast("long").alias("page_id")
    none = F.lit(None).cast("string")
    good = lake.read("bronze.documents").select(page, "doc_type", none.alias("reason"), "uid", "name", "sourceName")
    bad = lake.read("bronze.rejected_documents").select(
        page, "doc_type", "reason", *[none.alias(c) for c in ("uid", "name", "sourceName")]
    )
    return good.unionByName(bad)


FOLDERS = {"1": "Norway-F-1 main", "2": "field_F-11_x", "3": "F-12", "4": "Norway-F-99"}


@query(
    "survey_layout",
    f"""WITH {STATIONS_SQL}
        SELECT CASE left(trajectory_uid, 1) WHEN '1' THEN 'F-1' WHEN '3' THEN 'F-12' END AS well_id,
               count(DISTINCT trajectory_uid) AS n_documents
        FROM survey WHERE left(trajectory_uid, 1) IN ('1', '3') GROUP BY ALL""",
)
def survey_layout(spark, sf):
    """Documents found by the default folder layout; only folders that name a well in scope count."""
    root = scratch_path(spark, "layout")
    docs = trajectory_documents(spark, sf)
    for first, folder in FOLDERS.items():
        chosen = docs.filter(F.startswith("_uid", F.lit(first))).drop("well_id", "source_path")
        write_xml(chosen, f"{root}/{folder}/{first}/trajectory")
    return read_trajectories(spark, root).groupBy("well_id").agg(F.countDistinct("_uid").alias("n_documents"))


@query("source_files", "SELECT count(*) AS n_files FROM nation")
def source_files(spark, sf):
    """One file per nation below a folder, counted without reading them."""
    root = scratch_path(spark, "reachable")
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("n"))
    nations.write.partitionBy("n").text(root)
    return spark.range(1).select(F.lit(count_source_files(spark, f"{root}/*/part-*")).cast("long").alias("n_files"))
