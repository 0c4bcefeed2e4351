"""Session settings, scratch space and the size checks behind broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratawell.storage import delete

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "stratawell", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every layer relies on; ``conf`` overrides (dots as ``__``)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: the cluster's checkpoint folder.

    Only a local session may do without one; executors of a cluster would each write to their own
    disk, and reads would come back incomplete.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not folder and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="stratawell-"))
    return (folder or context.getCheckpointDir()).rstrip("/")


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{_run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder."""
    delete(spark, _run_dir(spark))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write go with its end, not when the driver happens to collect garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Cut lineage with a written table in the shared folder.

    A lost executor then costs no recomputation. Unlike a checkpoint, which computes its input
    twice, this is one pass, and later readers get column pruning and a known size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=compression)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.scratch = path
    return kept


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again, so that scratch does not pile up."""
    for table in tables:
        path = table.__dict__.get("scratch")
        if path:
            delete(table.sparkSession, path)


def estimated_bytes(df: DataFrame) -> int | None:
    """Size Catalyst expects from file sizes alone; no job runs. None if it cannot tell."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def row_bound(df: DataFrame) -> int | None:
    """An upper bound of the rows of ``df`` from the footers of its files; None if there is none.

    It holds for plans that only read, filter, group and rank Parquet files. Where rows can be
    multiplied (joins, explodes, unions of one file with itself) nothing is said.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if any(word in plan for word in ("Join", "Generate", "Expand", "Union", "MapIn", "FlatMap")):
        return None
    files = df.inputFiles()
    if not files or not all(f.endswith(".parquet") for f in files):
        return None
    return df.sparkSession.read.parquet(*files).count()


def checked_broadcast(
    df: DataFrame, max_rows: int | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark a table for broadcast if its counted rows and its bytes are within bounds.

    The table is written first, so that it is computed once; beyond the bounds the join is left
    to Spark.
    """
    bound = BROADCAST_ROWS if max_rows is None else max_rows
    kept = materialize(df)
    size = estimated_bytes(kept)
    fits = size is not None and size <= max_bytes and kept.count() <= bound
    return F.broadcast(kept) if fits else kept


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly per-row work on input of few partitions.

    Files of a single row group cannot be split, so a small input would be worked on by one task.
    Input with enough partitions is left alone.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
