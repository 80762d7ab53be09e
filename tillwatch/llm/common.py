"""Shared by the operators: tables in the shared folder, Arrow batches as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder in ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage without depending on any executor's disk.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``most`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.diff(text_offsets(batch.column(column))))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, done + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def text_offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    at = np.frombuffer(array.buffers()[1], kind, len(array) + 1, array.offset * kind().itemsize)
    return at.astype(np.int64)


def bytes_of(array: pa.Array) -> list[bytes]:
    """UTF-8 of each row; a null is empty."""
    return array.cast(pa.binary()).fill_null(b"").to_pylist()


def matrix(array: pa.Array, dim: int, dtype=np.float64) -> np.ndarray:
    """A list column whose rows all have ``dim`` numbers as a matrix."""
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(dtype)


def lists(flat: np.ndarray, sizes, kind: pa.DataType) -> pa.Array:
    """A list column from its numbers in a row and the length of each list."""
    at = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, kind))
