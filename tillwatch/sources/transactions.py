"""Transaction files and the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwatch.schema import TRANSACTION_DDL


def read_transactions_csv(spark: SparkSession, path: str | list[str], comment: str | None = "#",
                          partitions: int | None = None) -> DataFrame:
    """Headerless CSV with a fixed schema; a cell or tail that does not parse is NULL.

    ``path`` may hold globs. ``partitions`` asks for a shuffle to that many partitions; by
    default the scan's own splits are kept.
    """
    reader = spark.read.schema(TRANSACTION_DDL).option("header", "false").option("mode", "PERMISSIVE")
    if comment:
        reader = reader.option("comment", comment)
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


def transaction_csv_stream(spark: SparkSession, path: str, pattern: str, comment: str | None = "#",
                           files_per_batch: int = 1000) -> DataFrame:
    """The same files as a stream, however old a file is when it arrives."""
    reader = (spark.readStream.schema(TRANSACTION_DDL).option("header", "false").option("mode", "PERMISSIVE")
              .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", "36500d"))
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_clean(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write Parquet/snappy and return the table's number of rows, which the file footers hold.

    (An ``Observation`` would count while writing, but a session that has used one can no longer
    run the ML curve evaluators: their closures drag the session along.)
    """
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows, for a look."""
    return df.limit(rows)
