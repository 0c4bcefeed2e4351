"""Paths on whatever file system the session uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything."""
    path = hadoop_path(spark, pattern)
    return bool(file_system(spark, path).globStatus(path))


def file_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of what stands in a folder; none if there is no such folder."""
    path = hadoop_path(spark, folder)
    fs = file_system(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()


def delete(spark: SparkSession, path: str) -> None:
    target = hadoop_path(spark, path)
    file_system(spark, target).delete(target, True)


def swap(spark: SparkSession, staging: str, target: str) -> None:
    """Put a finished folder in the place of another; the old one goes last.

    A rename that a file system refuses is an error, and the old folder is put back.
    """
    new, old = hadoop_path(spark, staging), hadoop_path(spark, target)
    retired = hadoop_path(spark, target + "__old")
    fs = file_system(spark, old)
    fs.mkdirs(old.getParent())
    had_old = fs.exists(old)
    if had_old:
        fs.delete(retired, True)
        if not fs.rename(old, retired):
            raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, old):
        if had_old and not fs.rename(retired, old):
            raise OSError(f"cannot move {staging} to {target}; the old table is at {target}__old")
        raise OSError(f"cannot move {staging} to {target}")
    fs.delete(retired, True)
