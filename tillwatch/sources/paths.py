"""Looks at paths on whatever file system they live."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _status(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _status(spark, path)
    return files.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, target = _status(spark, path)
    return files.exists(target) and files.getFileStatus(target).isDirectory()


def signature(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(time of change, files, bytes) of a file or folder: differs once a table is written anew or grows."""
    files, target = _status(spark, path)
    held = files.getContentSummary(target)
    return files.getFileStatus(target).getModificationTime(), held.getFileCount(), held.getLength()


def inbox_root(spark: SparkSession, pattern: str) -> str:
    """The folder before the first glob sign of a path, with scheme and a slash at the end."""
    parts = pattern.rstrip("/").split("/")
    plain = next((i for i, part in enumerate(parts) if set(part) & set("*?[{")), len(parts))
    files, target = _status(spark, "/".join(parts[:plain]) or "/")
    return files.makeQualified(target).toUri().toString().rstrip("/") + "/"


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    files, target = _status(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    files, target = _status(spark, path)
    files.delete(target, True)


def read_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A Parquet table, empty when nothing has been written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)
