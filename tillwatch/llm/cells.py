"""Compare rows within groups of any size: groups become cells of bounded size.

A group above ``limit`` rows is cut into blocks by a hash of the row id. Rows to be compared with
each other meet in one cell per pair of blocks; queries meet the rows of each block. No pair of rows
is ever written: a cell is worked on as arrays in one task, and only what the caller's kernel keeps
(links that span a component, sums, the nearest rows) leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups above this many rows are cut into blocks.
BLOCK_ROWS = 4096
#: In a search, where only the queries are repeated for each block, blocks are smaller.
SEARCH_ROWS = 1024
#: Hot groups whose table may be broadcast. ``total`` rows have ``total / limit`` hot groups at most.
MAX_HOT = 100_000


def hot_groups(rows: DataFrame, total: int, limit: int = BLOCK_ROWS) -> DataFrame:
    """(grp, n_blocks) of groups above ``limit`` rows; to be broadcast where ``total`` bounds their number, else
    joined as Spark sees fit."""
    counts = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    hot = (counts.filter(F.col("n") > limit)
           .select("grp", F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("n_blocks")))
    return F.broadcast(hot) if total // limit <= MAX_HOT else hot


def pair_cells(rows: DataFrame, row_id: str, total: int, limit: int = BLOCK_ROWS) -> DataFrame:
    """Each row once per cell of its group: adds ``cell`` and ``side``.

    ``side`` is 0 for all rows of a cell whose rows are compared with each other, and 1 or 2 where
    only rows of different sides are. Two rows of a group share exactly one cell that compares them.
    """
    cut = (rows.join(hot_groups(rows, total, limit), "grp", "left")
           .withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1))))
    cut = cut.withColumn("own", F.pmod(F.xxhash64(F.col(row_id), F.lit(7)), F.col("n_blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    return (cut.withColumn("side", F.when(F.col("own") == F.col("other"), 0)
                           .when(F.col("own") < F.col("other"), 1).otherwise(2))
            .withColumn("cell", F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")))
            .drop("grp", "own", "other", "n_blocks"))


def search_cells(queries: DataFrame, query_id: str, rows: DataFrame, row_id: str, n_queries: int,
                 n_rows: int, limit: int = SEARCH_ROWS) -> tuple[DataFrame, DataFrame]:
    """Queries and rows of a group side by side: adds ``cell``.

    A group with many rows, many queries or both is cut into blocks on either side; each block of queries
    meets each block of rows in one cell.
    """
    cut_rows = hot_groups(rows, n_rows, limit)
    cut_queries = hot_groups(queries, n_queries, limit).withColumnRenamed("n_blocks", "q_blocks")

    def side(table: DataFrame, own: str, own_id: str, other: str) -> DataFrame:
        cut = (table.join(cut_rows, "grp", "left").join(cut_queries, "grp", "left")
               .withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
               .withColumn("q_blocks", F.coalesce("q_blocks", F.lit(1))))
        mine = F.pmod(F.xxhash64(F.col(own_id), F.lit(7)), F.col(own)).cast("int")
        cut = cut.withColumn("mine", mine).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        pair = ("mine", "theirs") if own == "n_blocks" else ("theirs", "mine")
        return (cut.withColumn("cell", F.xxhash64("grp", *pair))
                .drop("grp", "n_blocks", "q_blocks", "mine", "theirs"))

    return side(queries, "q_blocks", query_id, "n_blocks"), side(rows, "n_blocks", row_id, "q_blocks")


def dealt(rows: DataFrame, *then: str) -> DataFrame:
    """Rows of a cell side by side in one task."""
    return rows.repartition("cell").sortWithinPartitions("cell", *then)


def whole_cells(batches: Iterator[pa.RecordBatch], rows: int = 1 << 14) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole cells, about ``rows`` rows each."""
    kept: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        n += batch.num_rows
        if n >= rows:
            joined = pa.Table.from_batches(kept)
            cell = joined.column("cell").to_numpy()
            end = int(np.searchsorted(cell, cell[-1], side="left"))
            if end:
                yield joined.slice(0, end).combine_chunks()
            kept, n = joined.slice(end).to_batches(), len(joined) - end
    if n:
        yield pa.Table.from_batches(kept).combine_chunks()


def runs(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    return start, np.diff(np.append(start, len(cell)))


def small_pairs(start: np.ndarray, size: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within runs of 2 to ``most`` rows, by distance, as index arrays."""
    chosen = (size > 1) & (size <= most)
    start, size = start[chosen], size[chosen]
    for gap in range(1, int(size.max(initial=1))):
        long = size > gap
        count = size[long] - gap
        first = np.repeat(start[long] - np.cumsum(count) + count, count) + np.arange(count.sum())
        yield first, first + gap


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of ``n`` nodes reaches by the links (a, b)."""
    root = np.arange(n)
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    return root
