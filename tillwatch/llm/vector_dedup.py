"""Embedding near-duplicates: p-stable buckets in several tables, exact cosine within them."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.cells import dealt, pair_cells, roots, runs, small_pairs, whole_cells
from tillwatch.llm.common import matrix, stored
from tillwatch.llm.components import connected
from tillwatch.llm.pstable import PStable, cosine, lengths, numbers, same_vector, tables_for, units, usable


@dataclass(frozen=True)
class NearVectors:
    """``found``: probability that two vectors just at ``cosine`` share a bucket; nearer ones do more often."""

    cosine: float = 0.93
    found: float = 0.995
    hashes: int | None = None
    width: float = 2.0
    seed: int = 42


def _pairs(cell, side, unit, least):
    """Index pairs of rows of a cell that may be compared and are near enough by the matrix product."""
    start, size = runs(cell)
    for a, b in small_pairs(start, size, 32):
        kept = ((side[a] == 0) | (side[a] != side[b])) & ((unit[a] * unit[b]).sum(1) >= least)
        if kept.any():
            yield a[kept], b[kept]
    for s, n in zip(start[size > 32], size[size > 32]):
        rows = np.arange(s, s + n)
        whole = side[s] == 0
        left, right = (rows, rows) if whole else (rows[side[rows] == 1], rows[side[rows] == 2])
        for k in range(0, len(left), 256):
            part = left[k:k + 256]
            i, j = np.nonzero(unit[part] @ unit[right].T >= least)
            a, b = part[i], right[j]
            kept = a < b if whole else np.ones(len(a), bool)
            for c in range(0, np.count_nonzero(kept), 1 << 16):
                yield a[kept][c:c + (1 << 16)], b[kept][c:c + (1 << 16)]


def vector_links(entries: DataFrame, index: PStable, n_entries: int, spec: NearVectors, kind: str) -> DataFrame:
    """From entries (row_id, label, weight, vec) rows (a, b, n).

    With ``b``: a link; those returned span the components. Without: ``a`` has links to ``n`` vectors more.
    A pair is counted in the first table whose bucket it shares and in the one cell that compares it.
    """
    def spread(batches):
        for batch in batches:
            grp = index.buckets(units(matrix(batch.column("vec"), index.dim)))
            label = pd.util.hash_array(batch.column("label").to_numpy(zero_copy_only=False).astype(object))
            with np.errstate(over="ignore"):
                grp = grp ^ (label.astype(np.int64) * np.int64(-7046029254386353131))[:, None]
            take = pa.array(np.repeat(np.arange(batch.num_rows), index.tables))
            made = np.tile(np.arange(index.tables, dtype=np.int32), batch.num_rows)
            names = ["row_id", "label", "weight", "vec"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grp.ravel()), pa.array(made), *(batch.column(c).take(take) for c in names)], ["grp", "tab", *names])

    def work(batches):
        for part in whole_cells(batches):
            cell, side, tab, weight, row_id = (part.column(c).to_numpy() for c in ("cell", "side", "tab", "weight", "row_id"))
            label = np.asarray(part.column("label").combine_chunks().dictionary_encode().indices)
            vectors = matrix(part.column("vec").combine_chunks(), index.dim)
            unit = units(vectors)
            nodes, node = np.unique(row_id, return_inverse=True)
            more, a_s, b_s = np.zeros(len(nodes), np.int64), [], []
            for a, b in _pairs(cell, side, unit, spec.cosine - 1e-9):
                kept = (label[a] == label[b]) & (tab[a] == tab[b]) & (cosine(vectors[a], vectors[b]) >= spec.cosine)
                a, b = a[kept], b[kept]
                if not len(a):
                    continue
                used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                number = index.buckets(unit[used])
                shared = number[at[:len(a)]] == number[at[len(a):]]
                first = (shared.argmax(1) == tab[a]) & shared.any(1)
                np.add.at(more, node[a[first]], weight[b[first]])
                np.add.at(more, node[b[first]], weight[a[first]])
                spanned = roots(len(nodes), node[a], node[b])
                tied = np.flatnonzero(spanned != np.arange(len(nodes)))
                a_s.append(tied)
                b_s.append(spanned[tied])
            some = np.flatnonzero(more)
            if not len(some) and not a_s:
                continue
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_s, b_s))
            spanned = roots(len(nodes), a, b)
            tied = np.flatnonzero(spanned != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([nodes[some], nodes[tied]])),
                pa.array(np.concatenate([np.zeros(len(some), np.int64), nodes[spanned[tied]]]),
                         mask=np.arange(len(some) + len(tied)) < len(some)),
                pa.array(np.concatenate([more[some], np.zeros(len(tied), np.int64)]))], ["a", "b", "n"])

    rows = entries.mapInArrow(
        spread, f"grp bigint, tab int, row_id bigint, label string, weight bigint, vec array<{kind}>")
    cells = pair_cells(rows, "row_id", n_entries * index.tables)
    return dealt(cells.select("cell", "side", "tab", "row_id", "label", "weight", "vec")).mapInArrow(
        work, "a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, spec: NearVectors = NearVectors(), vec_id: str = "vec_id",
                 embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``.

    Rows of equal, not NULL label, of whatever type, link when the cosine of their vectors, in double precision,
    reaches ``spec.cosine`` and they share a bucket. Vectors that are NULL, empty, zero, or hold NULL or non-finite
    numbers link with nothing, neither do rows without an id; vectors of different lengths do not link. Equal
    vectors of a label are one entry with a weight; links are counted in cells of bounded size and never written out.
    """
    kind = numbers(vectors, embedding)
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast(f"array<{kind}>").alias("vec"),
                          F.col(label).cast("string").alias("label"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vec")
    rows = rows.withColumn("good", good).select("vec_id", "vec", "label", "good", *same_vector("label", "vec"))
    entries = stored(rows.filter("good").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("row_id"), F.first("label").alias("label"), F.count(F.lit(1)).alias("weight"),
        F.first("vec").alias("vec")), "vector-entries")
    links = vectors.sparkSession.createDataFrame([], "a bigint, b bigint, n bigint")
    for dim in lengths(entries, "vec"):
        # one row of two entries may be the smallest id of both: number the entries by their own hash
        named = entries.filter(F.size("vec") == dim).select(F.col("h1").alias("row_id"), "label", "weight", "vec")
        n = named.count()
        hashes = spec.hashes or max(2, round(0.5 * math.log2(n)))
        tables = tables_for(math.sqrt(2 - 2 * spec.cosine), spec.width, hashes, spec.found)
        found = vector_links(named, PStable(dim, tables, hashes, spec.width, spec.seed), n, spec, kind)
        links = links.unionByName(stored(found, "vector-links"))
    counts = links.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("more"))
    reach = connected(links.filter("b IS NOT NULL"), "a", "b", "vector-components")
    known = (entries.select("h1", "h2", "row_id", "weight").join(counts, F.col("h1") == F.col("a"), "left")
             .join(reach, F.col("h1") == F.col("node"), "left")
             .select("h1", "h2", "row_id", "weight", "more", F.coalesce("component", "h1").alias("component")))
    known = stored(known, "vector-known")
    least = known.groupBy("component").agg(F.min("row_id").alias("component_id"))
    known = known.join(least, "component").select(
        "h1", "h2", (F.col("weight") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.filter("good").join(known, ["h1", "h2"], "left")
    alone = rows.filter(~F.col("good")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                               F.col("vec_id").alias("component_id"))
    return (linked.select("vec_id", "n_links", "component_id").unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
