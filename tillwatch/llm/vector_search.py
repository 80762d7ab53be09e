"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact distances at the end.

Every row is indexed in each table. A query visits its own bucket and perturbed ones, those first whose
walls are nearest; what the tables find is merged and ranked by exact cosine. How many buckets a query
visits is fitted once per index: for a bounded sample of queries the true neighbours are found by a scan of
all rows in blocks, and so many probes are taken that ``recall`` of them is reached.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.cells import dealt, runs, search_cells, whole_cells
from tillwatch.llm.common import matrix, stored
from tillwatch.llm.pstable import PStable, cosine, lengths, numbers, same_vector, units, usable


@dataclass(frozen=True)
class Search:
    """``hashes``: per table, None: grows with the logarithm of the rows; ``sample``: queries for the fit."""

    k: int = 5
    tables: int = 8
    hashes: int | None = None
    width: float = 2.0
    recall: float = 0.97
    sample: int = 128
    most_probes: int = 512
    most_tables: int = 32
    seed: int = 42


RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def _nearest(part: pa.Table, dim: int, k: int):
    """Of one table of whole cells: (query, vec_id, score), the k + 1 best ids of each query and cell."""
    cell, kind = part.column("cell").to_numpy(), part.column("kind").to_numpy()
    row_id = part.column("row_id").to_numpy()
    vectors = matrix(part.column("vec").combine_chunks(), dim)
    unit = units(vectors)
    ids = part.column("ids").to_pylist()
    for start, size in zip(*runs(cell)):
        n = int(np.count_nonzero(kind[start:start + size] == 0))
        rows = np.arange(start + n, start + size)
        if not n or not len(rows):
            continue
        for q0 in range(start, start + n, 256):
            asked = np.arange(q0, min(q0 + 256, start + n))
            near = unit[asked] @ unit[rows].T
            if len(rows) > k + 1:
                least = np.partition(near, len(rows) - k - 1, axis=1)[:, len(rows) - k - 1] - 1e-9
                i, j = np.nonzero(near >= least[:, None])
            else:
                i, j = (x.ravel() for x in np.indices(near.shape))
            score = cosine(vectors[asked[i]], vectors[rows[j]])
            for q in range(len(asked)):
                own = np.flatnonzero(i == q)
                found = sorted((-score[o], v) for o in own for v in ids[rows[j[o]]])[:k + 1]
                for s, v in found:
                    yield int(row_id[asked[q]]), v, -s


def _search(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, dim: int, k: int) -> DataFrame:
    """(query, vec_id, score) of queries (grp, row_id, vec) among rows (grp, row_id, vec, ids)."""
    asked, there = search_cells(queries, "row_id", rows, "row_id", n_queries, n_rows)
    both = (asked.select("cell", F.lit(0).alias("kind"), "row_id", "vec", F.array().cast("array<bigint>").alias("ids"))
            .unionByName(there.select("cell", F.lit(1).alias("kind"), "row_id", "vec", "ids")))

    def work(batches):
        for part in whole_cells(batches):
            found = list(_nearest(part, dim, k))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))],
                    ["query", "vec_id", "score"])

    found = dealt(both, "kind").mapInArrow(work, "query bigint, vec_id bigint, score double")
    found = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")


def scan(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, dim: int, k: int) -> DataFrame:
    """The same by comparing the queries with all rows, in blocks."""
    one = F.lit(0).cast("bigint").alias("grp")
    return _search(queries.select(one, "row_id", "vec"), rows.select(one, "row_id", "vec", "ids"),
                   n_queries, n_rows, dim, k)


def _fit(index: PStable, queries: DataFrame, rows: DataFrame, n_rows: int, spec: Search) -> int | None:
    """Probes per table that find ``recall`` of the true neighbours of a sample of the queries; None where
    that takes more than ``most_probes``."""
    sample = stored(queries.orderBy(F.xxhash64("row_id", F.lit(5)), "row_id").limit(spec.sample), "ann-sample")
    asked = {r["row_id"]: np.array(r["vec"], float) for r in sample.collect()}
    true = scan(sample, rows, len(asked), n_rows, index.dim, spec.k).collect()
    wanted = rows.filter(F.col("row_id").isin(sorted({r["vec_id"] for r in true})))
    vec = {r["row_id"]: np.array(r["vec"], float) for r in wanted.collect()}
    pairs: dict[int, list[int]] = {}
    for r in true:
        if r["vec_id"] in vec and r["vec_id"] != r["query"]:
            pairs.setdefault(r["query"], []).append(r["vec_id"])
    visits = []
    for query, near in pairs.items():
        place = index.places(units(asked[query][None]))[0]
        slots = np.floor(index.places(units(np.stack([vec[v] for v in near]))))
        first = np.full(len(near), spec.most_probes)
        for t in range(index.tables):
            order = {s.tobytes(): i for i, s in enumerate(index.perturbed(place[t], spec.most_probes))}
            first = np.minimum(first, [order.get(s[t].tobytes(), spec.most_probes) for s in slots])
        visits += first.tolist()
    if not visits:
        return 1
    wanted = int(np.quantile(visits, spec.recall, method="higher")) + 1
    return wanted if wanted <= spec.most_probes else None


def _indexed(rows: DataFrame, index: PStable, kind: str) -> DataFrame:
    def work(batches):
        for batch in batches:
            grp = index.buckets(units(matrix(batch.column("vec"), index.dim)))
            take = pa.array(np.repeat(np.arange(batch.num_rows), index.tables))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grp.ravel()), *(batch.column(c).take(take) for c in ("row_id", "vec", "ids"))],
                ["grp", "row_id", "vec", "ids"])

    return rows.select("row_id", "vec", "ids").mapInArrow(
        work, f"grp bigint, row_id bigint, vec array<{kind}>, ids array<bigint>")


def _probes(queries: DataFrame, index: PStable, n_probes: int, kind: str) -> DataFrame:
    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                places = index.places(units(matrix(part.column("vec"), index.dim)))
                grp, row = [], []
                for i, place in enumerate(places):
                    for t in range(index.tables):
                        slots = np.array(list(index.perturbed(place[t], n_probes)))
                        full = np.zeros((len(slots), index.tables, index.hashes))
                        full[:, t] = slots
                        grp.append(index.number(full)[:, t])
                        row += [i] * len(slots)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grp)), *(part.column(c).take(take) for c in ("row_id", "vec"))],
                    ["grp", "row_id", "vec"])

    return queries.select("row_id", "vec").mapInArrow(work, f"grp bigint, row_id bigint, vec array<{kind}>")


def nearest_neighbours(vectors: DataFrame, is_query, spec: Search = Search(), vec_id: str = "vec_id",
                       embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that ``is_query`` chooses.

    Nearness is the cosine in double precision of the original vectors; ties go to the smaller id; a row is
    never its own neighbour. Vectors that are NULL, empty, zero, or hold NULL or non-finite numbers take no part,
    neither do rows without an id; vectors of different lengths are not compared. Rows of one id and vector
    count once. Equal vectors are one entry of the index, with the k + 1 smallest ids, which is all a result can
    need: a large group of copies is not searched copy by copy. A query that found fewer than ``k`` rows is
    compared with all of them. Where ``most_probes`` per table do not reach the recall, tables are doubled, up to
    ``most_tables``, and beyond that all queries are compared with all rows, in blocks.
    """
    spark = vectors.sparkSession
    kind = numbers(vectors, embedding)
    rows = (vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast(f"array<{kind}>").alias("vec"))
            .filter(F.col("vec_id").isNotNull() & usable("vec")))
    found = [_nearest_of(rows.filter(F.size("vec") == dim), dim, kind, is_query, spec) for dim in lengths(rows, "vec")]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], RESULT)


def _nearest_of(rows: DataFrame, dim: int, kind: str, is_query, spec: Search) -> DataFrame:
    """The same for usable vectors (vec_id, vec) of one length."""
    spark = rows.sparkSession
    rows = rows.select("vec_id", "vec", *same_vector("vec")).dropDuplicates(["vec_id", "h1", "h2"])
    alike = Window.partitionBy("h1", "h2").orderBy("vec_id")
    entries = stored(rows.withColumn("n", F.row_number().over(alike)).filter(F.col("n") <= spec.k + 1)
                     .groupBy("h1", "h2").agg(F.min("vec_id").alias("row_id"), F.first("vec").alias("vec"),
                                              F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-entries")
    asked = stored(rows.filter(is_query).select("vec_id", "h1", "h2")
                   .join(entries.select("h1", "h2", "row_id"), ["h1", "h2"])
                   .select(F.col("vec_id").alias("query_id"), F.col("row_id").alias("query")), "ann-asked")
    queries = stored(entries.join(asked.select(F.col("query").alias("row_id")).distinct(), "row_id", "left_semi")
                     .select("row_id", "vec"), "ann-queries")
    n_rows, n_queries = entries.count(), queries.count()
    if not n_queries:
        return spark.createDataFrame([], RESULT)
    hashes = spec.hashes or max(2, round(0.4 * math.log2(n_rows)))
    tables, n_probes = spec.tables, None
    while n_probes is None and tables <= spec.most_tables:
        index = PStable(dim, tables, hashes, spec.width, spec.seed)
        n_probes = _fit(index, queries, entries, n_rows, spec)
        tables *= 2
    if n_probes is None:
        found = scan(queries, entries, n_queries, n_rows, dim, spec.k)
    else:
        found = _search(_probes(queries, index, n_probes, kind), _indexed(entries, index, kind), n_queries * index.tables * n_probes,
                        n_rows * index.tables, dim, spec.k)
    found = stored(found, "ann-found")
    n_ids = rows.select("vec_id").distinct().limit(spec.k + 2).count()
    few = (queries.join(found.groupBy("query").agg(F.count(F.lit(1)).alias("n")), F.col("row_id") == F.col("query"), "left")
           .filter(F.coalesce("n", F.lit(0)) < min(spec.k + 1, n_ids)).select("row_id", "vec"))
    few = stored(few, "ann-few")
    n_few = few.count()
    if n_few:
        again = scan(few, entries, n_few, n_rows, dim, spec.k)
        found = found.join(few, F.col("query") == F.col("row_id"), "left_anti").unionByName(again)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(found, "query").filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= spec.k)
            .select("query_id", "rank", "vec_id", "score"))
