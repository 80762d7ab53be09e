"""Ranked lexical search: the best documents for each of many items, by exact integer scores.

Items come in blocks whose vocabulary has a bound and is broadcast. One pass over the texts keeps, per
document, its term count and the counts of the block's terms; that table gives the totals and the document
frequencies. In a second pass each task multiplies dense tiles in float64: item weights (items x
terms) times document impacts (terms x documents). A tile has only the terms that its documents hold, and so
few that no partial sum reaches 2^53; products are therefore exact, and are added up as 64-bit integers. Each
task keeps the best documents per item, ties included, and only those leave it.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import bytes_of, lists, slices, stored
from tillwatch.session import scratch_path
from tillwatch.sources.paths import remove

#: Pairs of item and term in one block: the bound of what is broadcast (some 50 MB).
BLOCK_PAIRS = 1 << 20
#: Items, documents and terms of a tile.
TILE_ITEMS, TILE_DOCS, TILE_TERMS = 256, 512, 2048
#: An impact is below this, whatever the counts.
IMPACT = 10 ** 6
#: Lists of best documents are merged in so many lanes per item first.
LANES = 64
#: Bytes of a text that are split at once.
PART = 4 << 20

_CASE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CUT = bytes(i for i in range(128) if not chr(i).isalnum())
#: A-Z lowered; other ASCII bytes than letters and digits become blanks. Bytes of longer characters stay.
_TERMS = bytes(32 if i in _CUT else _CASE[i] for i in range(256))


def term_counts(text: bytes) -> Counter:
    """Terms of a UTF-8 text and how often each occurs. Long texts are split part by part, at blanks."""
    if len(text) <= PART:
        return Counter(text.translate(_TERMS).split())
    counts, start = Counter(), 0
    while start < len(text):
        part = text[start:start + PART].translate(_TERMS)
        start += len(part)
        while start < len(text) and part[-1:] != b" ":
            more = text[start:start + PART].translate(_TERMS)
            cut = more.find(b" ") + 1 or len(more)
            part += more[:cut]
            start += cut
        counts.update(part.split())
    return counts


@dataclass(frozen=True)
class Block:
    """Items of a block: ids, and the terms of each as places in ``terms``."""

    items: pa.Array
    starts: np.ndarray
    places: np.ndarray
    terms: list[bytes]


def item_blocks(items: DataFrame, item_id: str, text: str):
    """Items in blocks of at most BLOCK_PAIRS (item, term) pairs, or a single item above that.

    Rows of one id, NULL included, are one item with the terms of all of them.
    """
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = items.schema[item_id].dataType

    def work(batches):
        for batch in slices(batches, "text"):
            found = [sorted(term_counts(t)) for t in bytes_of(batch.column("text"))]
            flat = pa.array([term for one in found for term in one], pa.binary())
            sizes = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.ListArray.from_arrays(sizes, flat)], ["item_id", "terms"])

    split = rows.mapInArrow(work, T.StructType([T.StructField("item_id", kind), T.StructField("terms", T.ArrayType(T.BinaryType()))]))
    one = stored(split.select("item_id", F.explode("terms").alias("term")).groupBy("item_id")
                 .agg(F.collect_set("term").alias("terms")), "search-items")
    ids, terms, pairs = [], [], 0

    def block() -> Block:
        places = {term: i for i, term in enumerate(sorted(set().union(*terms)))}
        flat = np.array([places[t] for one_item in terms for t in one_item], np.int64)
        return Block(pa.array(ids), np.cumsum([0, *map(len, terms)]), flat, list(places))

    for row in one.orderBy("item_id").toLocalIterator():
        if ids and pairs + len(row["terms"]) > BLOCK_PAIRS:
            yield block()
            ids, terms, pairs = [], [], 0
        ids.append(row["item_id"])
        terms.append([bytes(t) for t in row["terms"]])
        pairs += len(row["terms"])
    if ids:
        yield block()


def _counted(docs: DataFrame, terms) -> DataFrame:
    """(doc_id, n, places, tf): each document's term count and its counts of the block's terms."""
    def work(batches):
        place = {term: i for i, term in enumerate(terms.value)}
        for batch in slices(batches, "text"):
            n, sizes, places, tf = [], [], [], []
            for text in bytes_of(batch.column("text")):
                counts = term_counts(text)
                hits = counts.keys() & place.keys()
                n.append(counts.total())
                sizes.append(len(hits))
                places += map(place.__getitem__, hits)
                tf += map(counts.__getitem__, hits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), lists(np.array(places, np.int32), sizes, pa.int32()),
                 lists(np.array(tf, np.int64), sizes, pa.int64())], ["doc_id", "n", "places", "tf"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {kind}, n bigint, places array<int>, tf array<bigint>")


class Best:
    """The ``top`` best documents of each item so far: by score, then by id, rows without id last."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.kept = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """``scores``: items from number ``first`` on x documents. Ties at the limit all stay until sorted."""
        least = self.least[first:first + len(scores)]
        if scores.shape[1] > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, 1)[:, -self.top])
        item, doc = np.nonzero(scores >= least[:, None])
        if len(item):
            new = (item + first, scores[item, doc], ids[doc], no_id[doc])
            self.kept = [np.concatenate(x) for x in zip(self.kept, new)]
            if len(self.kept[0]) > 4 * self.top * len(self.least) + 100_000:
                self.cut()

    def cut(self) -> None:
        item, score, ids, no_id = self.kept
        order = np.lexsort((ids, no_id, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        chosen = order[rank < self.top]
        self.kept = [x[chosen] for x in self.kept]
        last = rank == self.top - 1
        self.least[item[last]] = score[order][last]


def tile_scores(block: Block, weights: np.ndarray, impacts: np.ndarray, rows: np.ndarray, places: np.ndarray, n_docs: int):
    """(first item, scores) of each tile of items with ``n_docs`` documents, whose (row, term) impacts are given."""
    used, column = np.unique(places, return_inverse=True)
    heaviest = int(weights[used].max(initial=1)) or 1
    width = max(1, min(TILE_TERMS, ((1 << 53) - 1) // (heaviest * IMPACT)))
    slot = np.full(len(weights), -1)
    slot[used] = np.arange(len(used))
    tiles = []
    for start in range(0, len(used), width):
        here = (column >= start) & (column < start + width)
        dense = np.zeros((min(width, len(used) - start), n_docs))
        dense[column[here] - start, rows[here]] = impacts[here]
        tiles.append(dense)
    for first in range(0, len(block.starts) - 1, TILE_ITEMS):
        last = min(first + TILE_ITEMS, len(block.starts) - 1)
        mine = block.places[block.starts[first]:block.starts[last]]
        item = np.repeat(np.arange(last - first), np.diff(block.starts[first:last + 1]))
        at = slot[mine]
        scores = np.zeros((last - first, n_docs), np.int64)
        for k, dense in enumerate(tiles):
            here = (at >= k * width) & (at < k * width + len(dense))
            if here.any():
                compact = np.zeros((last - first, len(dense)))
                compact[item[here], at[here] - k * width] = weights[mine[here]]
                scores += (compact @ dense).astype(np.int64)
        yield first, scores


def _search(counted: DataFrame, shared, n: int, total: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each item within a task."""
    def work(batches):
        block, weights = shared.value
        best = Best(len(block.starts) - 1, top)
        for whole in batches:
            for start in range(0, whole.num_rows, TILE_DOCS):
                batch = whole.slice(start, TILE_DOCS)
                m = 50 + 50 * batch.column("n").to_numpy() * n // total
                places, tf = batch.column("places"), batch.column("tf").flatten().to_numpy()
                rows = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
                places = places.flatten().to_numpy()
                impacts = 1_000_000_000 * tf // (1000 * tf + 20 * m[rows])
                ids = batch.column("doc_id")
                for first, scores in tile_scores(block, weights, impacts, rows, places, batch.num_rows):
                    best.add(first, scores, ids.fill_null(0).to_numpy().astype(np.int64), np.asarray(ids.is_null()))
        best.cut()
        item, score, ids, no_id = best.kept
        yield pa.RecordBatch.from_arrays([block.items.take(pa.array(item)), pa.array(ids, mask=no_id), pa.array(score)],
                                         ["item_id", "doc_id", "score"])

    kind = {pa.string(): "string"}.get(shared.value[0].items.type, "bigint")
    return counted.select("doc_id", "n", "places", "tf").mapInArrow(work, f"item_id {kind}, doc_id bigint, score bigint")


def _best_of(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 50, doc_id: str = "doc_id", item_id: str = "item_id",
                  text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents with the highest score above 0 for each item.

    Terms are runs of ASCII letters and digits (A-Z lowered) and of all characters beyond ASCII. Scores
    are integers; equal ones go by ascending id, NULL ids last. Every row of ``docs`` is a document, repeated rows
    too; ids are integers. A NULL or empty text has no terms. Rows of ``items`` with the same id are one
    item. An item without terms, or whose terms no document holds, has no rows; so has any item if ``docs`` is empty.
    """
    spark = docs.sparkSession
    corpus = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                         F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    found = None
    for block in item_blocks(items, item_id, text):
        terms = spark.sparkContext.broadcast(block.terms)
        path = scratch_path(spark, "search-counts")
        table = _counted(corpus, terms)
        table.write.parquet(path)
        counted = spark.read.schema(table.schema).parquet(path)
        n, total = counted.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n:
            break
        df = np.zeros(len(block.terms), np.int64)
        for place, held in counted.select(F.explode("places").alias("place")).groupBy("place").count().collect():
            df[place] = held
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * held + 1))) for held in df.tolist()], np.int64)
        shared = spark.sparkContext.broadcast((block, weights))
        best = _search(counted, shared, n, total, top).withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(LANES)))
        best = stored(_best_of(best, ["item_id", "lane"], top).drop("rank", "lane"), "search-best")
        remove(spark, path)
        found = best if found is None else found.unionByName(best)
    if found is None:
        kind = items.schema[item_id].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    out = _best_of(found, ["item_id"], top)
    return out.select(F.col("item_id").cast(items.schema[item_id].dataType).alias("item_id"), "rank", "doc_id", "score")
