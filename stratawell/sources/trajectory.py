"""Survey documents (XML): discovery by path, one multi-path scan, type routing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratawell.config import DOCUMENT_ROUTES, ENTITY_PATTERN, STATION_DDL, WELLS_IN_SCOPE
from stratawell.session import materialize
from stratawell.sinks.tables import Lake
from stratawell.sources.folders import list_files, local_path, read_files
from stratawell.storage import any_file

TRAJECTORY_DDL = (
    "_uid STRING, _uidWell STRING, _uidWellbore STRING, name STRING, nameWell STRING, "
    f"nameWellbore STRING, trajectoryStation {STATION_DDL}"
)
CORRUPT = "_corrupt_record"
LAYOUT = r"/([^/.]+)/[0-9]+/trajectory/[^/]+$"

# Tags every document type shares, and the element one document stands in.
UNIVERSAL_TAGS = ("name", "dTimCreation", "dTimLastChange", "priv_dTimReceived", "sourceName")
DOCUMENT_ROW_TAGS = {
    "well_info": "well",
    "wellbore_info": "wellbore",
    "trajectory": "trajectory",
    "messages": "message",
    "bha": "bhaRun",
    "mud_log": "mudLog",
}


def file_path() -> Column:
    """Path of the file a row was read from, escapes resolved."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def well_of_folder(folder: Column, wells: Sequence[str] | None = WELLS_IN_SCOPE) -> Column:
    """First well whose name stands as a word in the folder name, whatever its case.

    Without a list, any name of the well pattern counts.
    """
    if wells is None:
        name = F.regexp_extract(folder, rf"(?i)\b{ENTITY_PATTERN}\b", 0)
        return F.nullif(F.upper(name), F.lit(""))
    found = F.lit(None).cast("string")
    for well in reversed(list(wells)):
        found = F.when(folder.rlike(rf"(?i)\b{well}\b"), well).otherwise(found)
    return found


def read_trajectories(
    spark: SparkSession,
    root: str,
    wells: Sequence[str] | None = WELLS_IN_SCOPE,
    pattern: str = "*/[0-9]*/trajectory/*",
    layout: str = LAYOUT,
) -> DataFrame:
    """Trajectory documents below ``root/<well folder>/<number>/trajectory/``.

    One scan over all matching files; well and wellbore come from the path. The explicit schema
    makes the stations an array even where a document has only one. ``pattern`` and ``layout``
    describe other folder structures; the first group of ``layout`` is the well folder.
    """
    docs = (
        spark.read.format("xml")
        .option("rowTag", "trajectory")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(f"{TRAJECTORY_DDL}, {CORRUPT} STRING")
        .load(f"{root.rstrip('/')}/{pattern}")
        .withColumn("_path", file_path())
    )
    return (
        docs.filter(F.col("_path").rlike(layout))
        .withColumn("well_id", well_of_folder(F.regexp_extract("_path", layout, 1), wells))
        .filter(F.col("well_id").isNotNull())
        .withColumn("source_path", F.regexp_extract("_path", r"^(.*/)[^/]+$", 1))
    )


def route_document(path: Column) -> Column:
    """Document type by path fragment."""
    kind = F.lit("other")
    for fragment, name in reversed(DOCUMENT_ROUTES):
        kind = F.when(F.contains(path, F.lit(fragment)), name).otherwise(kind)
    return kind


def underscore_folders(spark: SparkSession, base: str) -> list[str]:
    """Patterns of what lies in folders whose name starts with an underscore, one per depth.

    A recursive read of such a folder passes over the ones below it, which have patterns of their
    own, so every file is found once.
    """
    patterns, depth = [], 0
    while any_file(spark, f"{base}/{'*/' * depth}*"):
        inside = f"{base}/{'*/' * depth}_*/[!_.]*"
        if any_file(spark, inside):
            patterns.append(inside)
        depth += 1
    return patterns


def route_documents(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` with their type; contents are not read.

    Spark passes over folders whose name starts with an underscore, such as those of the well
    and wellbore documents, so these are named by pattern where tasks cannot list the folder.
    """
    base = root.rstrip("/")
    if any_file(spark, base) and (folder := local_path(spark, base)):
        files = list_files(spark, folder).select(
            F.concat(F.lit("file:"), "path").alias("path"),
            F.timestamp_millis("modified").alias("modificationTime"),
            "length",
        )
        return files.withColumn("doc_type", route_document(F.col("path")))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.load([base, *underscore_folders(spark, base)]).select(
        "path", "modificationTime", "length"
    )
    return files.withColumn("doc_type", route_document(F.col("path")))


def read_documents(
    spark: SparkSession, paths: dict[str, str], extra: Sequence[str] = ()
) -> DataFrame:
    """Documents of several types as flat rows; a tag a document lacks is NULL.

    ``paths`` maps a document type to where its files are. Universal tags may stand in the
    document itself or in its ``commonData`` part.
    """
    tags = [*UNIVERSAL_TAGS, *extra]
    fields = ", ".join(f"{t} STRING" for t in tags)
    schema = f"_uid STRING, {fields}, commonData STRUCT<{fields.replace(' STRING', ': STRING')}>"
    parts = [
        spark.read.format("xml")
        .option("rowTag", DOCUMENT_ROW_TAGS[kind])
        .schema(schema)
        .load(path)
        .select(
            F.lit(kind).alias("doc_type"),
            file_path().alias("source_path"),
            F.col("_uid").alias("uid"),
            *[F.coalesce(F.col(t), F.col(f"commonData.{t}")).alias(t) for t in tags],
        )
        for kind, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---- all documents in one pass --------------------------------------------------------------------------------


def _documents_schema(tags: Sequence[str]) -> str:
    """What the root element of any document may hold: rows of each type, all with the same fields."""
    fields = [f"{t}: STRING" for t in tags]
    row = f"STRUCT<_uid: STRING, {', '.join(fields)}, commonData: STRUCT<{', '.join(fields)}>>"
    return ", ".join([*[f"{tag} ARRAY<{row}>" for tag in DOCUMENT_ROW_TAGS.values()], f"{CORRUPT} STRING"])


def read_routed_documents(spark: SparkSession, root: str, extra: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(documents, rejected): every file below ``root``, routed by its path and parsed by its type.

    Documents are flat rows: doc_type, source_path, uid and the tags; one that a document lacks is
    NULL, and it may stand in the document itself or in its ``commonData``. Rejected are files that
    are no XML, have no type, or hold no element of their type, each with its reason. Files are read
    once and no text is kept.
    """
    base = root.rstrip("/")
    tags = [*UNIVERSAL_TAGS, *extra]
    if any_file(spark, base) and (folder := local_path(spark, base)):
        files = read_files(list_files(spark, folder)).select(
            F.concat(F.lit("file:"), "path").alias("source_path"), F.col("content").cast("string").alias("_text")
        )
    else:
        files = (
            spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
            .text([base, *underscore_folders(spark, base)])
            .select(file_path().alias("source_path"), F.col("value").alias("_text"))
        )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = files.select(
        "source_path",
        route_document(F.col("source_path")).alias("doc_type"),
        F.from_xml("_text", _documents_schema(tags), options).alias("_xml"),
    )
    rows = F.lit(None).cast(f"{parsed.select('_xml.*').dtypes[0][1]}")
    for kind, tag in DOCUMENT_ROW_TAGS.items():
        rows = F.when(F.col("doc_type") == kind, F.col(f"_xml.{tag}")).otherwise(rows)
    broken = F.col("_xml").isNull() | F.col(f"_xml.{CORRUPT}").isNotNull()
    reason = (
        F.when(F.col("doc_type") == "other", "no document type")
        .when(broken, "not readable as XML")
        .when(F.coalesce(F.size("_rows"), F.lit(-1)) < 1, "no element of its type")
    )
    judged = materialize(parsed.withColumn("_rows", rows).select("source_path", "doc_type", "_rows", reason.alias("reason")))
    flat = judged.filter("reason IS NULL").select("doc_type", "source_path", F.explode("_rows").alias("_row"))
    documents = flat.select(
        "doc_type", "source_path", F.col("_row._uid").alias("uid"),
        *[F.coalesce(F.col(f"_row.{t}"), F.col(f"_row.commonData.{t}")).alias(t) for t in tags],
    )
    return documents, judged.filter("reason IS NOT NULL").select("source_path", "doc_type", "reason")


def write_documents(lake: Lake, root: str, extra: Sequence[str] = ()) -> dict[str, int]:
    """Store all documents by type, and those that were rejected; returns the row counts."""
    documents, rejected = read_routed_documents(lake.spark, root, extra)
    return {
        "bronze.documents": lake.refresh("bronze.documents", documents, ["doc_type"], ["source_path"]),
        "bronze.rejected_documents": lake.refresh("bronze.rejected_documents", rejected),
    }


def split_unreadable(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trajectory documents that could be read, and path and text of those that could not."""
    broken = F.col(CORRUPT).isNotNull()
    return documents.filter(~broken), documents.filter(broken).select("well_id", "source_path", CORRUPT)
