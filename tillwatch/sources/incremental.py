"""Load only the files that no earlier run has loaded."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.sources.paths import inbox_root, read_table
from tillwatch.sources.transactions import transaction_csv_stream

MANIFEST_DDL = "file_name STRING, loaded_at TIMESTAMP"


def _relative(root: str) -> Column:
    """Where a file lies below the inbox. Scheme and slashes of file paths vary, so the root's path is cut off."""
    path = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z0-9]+:/*", "/")
    tail = "/" + re.sub("^[a-z0-9]+:/*", "", root)
    return F.substring(path, F.lit(len(tail) + 1), F.length(path))


def list_files(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """``file_name, path, bytes`` of the inbox's files; contents are not read.

    ``folder`` may hold globs. ``file_name`` is the path below the part before them, so files of equal
    names in different folders are different files.
    """
    name = _relative(inbox_root(spark, folder))
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
            .select(name.alias("file_name"), "path", F.col("length").alias("bytes")))


def not_loaded(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose name is not in the manifest."""
    return files.join(manifest.select("file_name"), "file_name", "left_anti")


def ingest_new_files(spark: SparkSession, folder: str, manifest_path: str, table_path: str,
                     pattern: str = "*.txt", comment: str | None = "#", files_per_batch: int = 1000) -> int:
    """Append the rows of new files to ``table_path``, note the files, and return the rows added.

    The inbox is a stream of files that runs until all that has arrived is taken, ``files_per_batch`` at a time;
    the stream's log (``<manifest>_checkpoint``) knows the files. Files noted in the manifest are skipped as well,
    so a lost log does no harm. Rows carry ``source_file`` and go to a partition of that name which is
    overwritten, so a batch that runs again does not double rows. A file without rows is not noted.
    """
    name, added = _relative(inbox_root(spark, folder)), []
    stream = (transaction_csv_stream(spark, folder, pattern, comment, files_per_batch).withColumn("source_file", name))

    def take(batch: DataFrame, batch_id: int) -> None:
        known = read_table(spark, manifest_path, MANIFEST_DDL).select(F.col("file_name").alias("source_file"))
        batch = batch.join(known, "source_file", "left_anti").select(*batch.columns).persist()
        try:
            added.append(batch.count())
            (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_file").parquet(table_path))
            (batch.select(F.col("source_file").alias("file_name")).distinct().withColumn("loaded_at", F.current_timestamp())
             .write.mode("append").parquet(manifest_path))
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{manifest_path.rstrip('/')}_checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(added)
