"""Many small files in a folder that all tasks see: listed, read and written by tasks.

The driver would list such files one folder at a time, and a Spark write moves each of them when it
commits. Both take milliseconds a file on one machine, whatever the size of the cluster.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratawell.session import materialize
from stratawell.storage import file_system, hadoop_path

ENTRIES = pa.schema([("path", pa.string()), ("modified", pa.int64()), ("length", pa.int64())])
TEXTS = pa.schema([("path", pa.string()), ("content", pa.binary())])
ROWS, BYTES = 10_000, 16 << 20  # of a batch that goes back to Spark


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder on a mounted file system; None for other file systems and for patterns."""
    target = hadoop_path(spark, path)
    fs = file_system(spark, target)
    if fs.getUri().getScheme() != "file" or any(c in path for c in "*?[{"):
        return None
    return fs.makeQualified(target).toUri().getPath().rstrip("/")


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; an item of bytes counts with its length."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= ROWS or size >= BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _passed_over(name: str) -> bool:
    """Files that Spark passes over, as it does empty ones."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _entries(folders: Iterator[str]) -> Iterator[tuple]:
    """Files with time and length, folders without; those whose name starts with an underscore count."""
    for folder in folders:
        with os.scandir(folder) as entries:
            for entry in entries:
                if entry.is_dir():
                    if not entry.name.startswith("."):
                        yield entry.path, None, None
                elif not _passed_over(entry.name):
                    found = entry.stat()
                    if found.st_size:
                        yield entry.path, found.st_mtime_ns // 1_000_000, found.st_size


def _texts(paths: Iterator[str]) -> Iterator[tuple]:
    for path in paths:
        with pa.input_stream(path) as file:  # decompressed by its ending
            yield path, file.read()


def _over(df: DataFrame, make, schema: pa.Schema, ddl: str) -> DataFrame:
    """``make`` over the only column of ``df``, dealt out to all cores."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(make(v for b in batches for v in b.column(0).to_pylist()), schema)

    return df.repartition(df.sparkSession.sparkContext.defaultParallelism).mapInArrow(work, ddl)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, length) of all files below a plain path, a level of folders at a time."""
    level, found = spark.createDataFrame([(folder,)], "path string"), None
    while found is None or not level.isEmpty():
        listed = materialize(_over(level, _entries, ENTRIES, "path string, modified long, length long"))
        files = listed.filter("length IS NOT NULL")
        found = files if found is None else found.unionByName(files)
        level = listed.filter("length IS NULL").select("path")
    return found


def read_files(files: DataFrame) -> DataFrame:
    """(path, content) of listed files."""
    return _over(files.select("path"), _texts, TEXTS, "path string, content binary")


def write_files(df: DataFrame, root: str) -> None:
    """Each row of (folder, n, value) as a text file of its own, ``root/folder/n=<n>/part-<task>-<row>``.

    A repeated task writes the same files again.
    """
    base = local_path(df.sparkSession, root)
    if base is None:
        df.write.partitionBy("folder", "n").text(root)
        return

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for folder, n, value in zip(*(batch.column(c).to_pylist() for c in ("folder", "n", "value"))):
                os.makedirs(f"{base}/{folder}/n={n}", exist_ok=True)
                with open(f"{base}/{folder}/n={n}/part-{task:05d}-{row}.txt", "w", encoding="utf-8", newline="") as file:
                    file.write("\n" if value is None else f"{value}\n")
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    os.makedirs(base, exist_ok=True)
    df.select("folder", "n", "value").mapInArrow(written, "n long").agg(F.sum("n")).collect()  # one row
