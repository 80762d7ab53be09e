"""SimHash near-duplicates through an inverted index on byte positions of the fingerprint.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so at
least 5 (position, byte) postings are shared. With two halves of four positions each, 5 shared
positions put 3 into one half: the index is kept on the 4 + 4 triples of positions within a half, whose
postings are short, and every pair that reaches the guaranteed count meets in one of them. There the
shared positional bytes of the pair are tallied, pairs below 5 go, the rest is verified by its bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.cells import dealt, pair_cells, roots, runs, small_pairs, whole_cells
from tillwatch.llm.common import fresh, slices, stored
from tillwatch.llm.components import connected

MAX_BITS = 3
#: Bytes two fingerprints share at least when they differ in MAX_BITS bits.
MIN_SHARED = 8 - MAX_BITS
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
_CHUNK = 1 << 16


def _word_chunks(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; each chunk repeats the last ``overlap`` words."""
    words: list[bytes] = []
    while True:
        got = text.split(None, _CHUNK)
        text = got.pop() if len(got) > _CHUNK else b""
        words = words[len(words) - overlap:] + got if overlap else got
        yield words
        if not text:
            return


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """64 bits, each set where over half of the shingle hashes have it; 0 for a text without words."""
    ones, n = np.zeros(64, np.int64), 0
    for words in _word_chunks(text.lower(), size - 1):
        if len(words) >= size:
            shingles = [b" ".join(s) for s in zip(*(words[i:] for i in range(size)))]
        elif n == 0 and words:
            shingles = [b" ".join(words)]
        else:
            continue
        hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` without its text, with ``fp`` (the 64 bits as a signed long).

    A NULL text counts as empty. Each text is worked on whole, in chunks of words, in its own row.
    """
    name = fresh(docs, "fp")
    rows = docs.withColumnRenamed(text, "text") if text != "text" else docs
    rest = [c for c in rows.columns if c != "text"]
    fields = [f.simpleString().split(":", 1) for f in rows.select(*rest).schema.fields]
    schema = ", ".join(f"`{n}` {t}" for n, t in fields) + f", `{name}` bigint"

    def work(batches):
        for batch in slices(batches, "text"):
            found = [fingerprint((t or "").encode(), size, seed) for t in batch.column("text").to_pylist()]
            made = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), made], names=[*rest, name])

    rows = rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    return rows.select(*rest, "text").mapInArrow(work, schema)


def postings(prints: DataFrame) -> DataFrame:
    """(grp, fp): one row per position triple; ``grp`` holds the triple and its three bytes."""
    keys = []
    for i, triple in enumerate(TRIPLES):
        mask = sum(0xFF << 8 * (7 - p) for p in triple)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed))))
    return prints.select(F.explode(F.array(*keys)).alias("grp"), "fp")


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Count filter, then the exact test: which pairs share MIN_SHARED bytes and differ in MAX_BITS bits."""
    odd = np.bitwise_xor(a, b)
    shared = (odd.view(np.uint8).reshape(*odd.shape, 8) == 0).sum(-1)
    kept = shared >= MIN_SHARED
    kept[kept] = np.bitwise_count(odd[kept]) <= MAX_BITS
    return kept


def _pairs(cell, side, fp) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    start, size = runs(cell)
    for a, b in small_pairs(start, size, 64):
        kept = near(fp[a], fp[b]) & ((side[a] == 0) | (side[a] != side[b]))
        yield a[kept], b[kept]
    for s, n in zip(start[size > 64], size[size > 64]):
        rows = np.arange(s, s + n)
        left = rows if side[s] == 0 else rows[side[rows] == 1]
        right = rows if side[s] == 0 else rows[side[rows] == 2]
        for k in range(0, len(left), 256):
            part = left[k:k + 256]
            i, j = np.nonzero(near(*np.broadcast_arrays(fp[part][:, None], fp[right][None, :])))
            yield part[i], right[j]


def fingerprint_links(prints: DataFrame, limit: int = 4096) -> DataFrame:
    """(a, b): links between distinct fingerprints that span the same components as all links do.

    ``prints`` has one row per distinct ``fp``. Equal fingerprints are one node, so a large group of
    exact copies costs nothing here; a large posting is cut into cells.
    """
    index = postings(prints)
    total = prints.count() * len(TRIPLES)

    def work(batches):
        for part in whole_cells(batches):
            cell = part.column("cell").to_numpy()
            side = part.column("side").to_numpy()
            values, node = np.unique(part.column("fp").to_numpy(), return_inverse=True)
            fp = np.ascontiguousarray(values[node]).view(np.uint64)
            found = [(node[a], node[b]) for a, b in _pairs(cell, side, fp) if len(a)]
            if not found:
                continue
            root = roots(len(values), *(np.concatenate(x) for x in zip(*found)))
            tied = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(values[tied]), pa.array(values[root[tied]])], ["a", "b"])

    cells = pair_cells(index, "fp", total, limit)
    return dealt(cells.select("cell", "side", "fp")).mapInArrow(work, "a bigint, b bigint").distinct()


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, seed: int = 42,
                   limit: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Fingerprints within 3 bits are linked; ``component_id`` is the smallest id reachable. A NULL or
    empty text has fingerprint zero and is linked like any other. Repeated rows stay as they are; a NULL
    id keeps its row and gets the id of its component, which is NULL only if no member has one.
    """
    prints = stored(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                 "text", size, seed), "fingerprints")
    linked, first = _components(prints, limit)
    linked = linked.join(first, "component").select("fp", "component_id")
    return (prints.join(linked, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def _components(prints: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(fp, component) of each fingerprint, and (component, component_id): the smallest id of each component."""
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    reach = connected(fingerprint_links(classes.select("fp"), limit), "a", "b", "simhash")
    joined = classes.join(reach, classes.fp == reach.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    first = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return joined.select("fp", "component"), first


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, seed: int = 42,
             limit: int = 4096) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id.

    Rows without an id stay. Where the smallest id of a group is repeated in it, one of its rows stays
    (smallest by content); an id that stands in several groups may stay in each.
    """
    own = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), own.alias("content"))
    prints = stored(fingerprints(rows, "text", size, seed), "fingerprints")
    linked, _ = _components(prints.select("fp", "doc_id"), limit)
    # the smallest row of each fingerprint comes first, so no shuffle carries a large group
    least = prints.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min(F.struct("doc_id", "content")).alias("least"))
    best = least.join(linked, "fp").groupBy("component").agg(F.min("least").alias("least")).select("least.*").distinct()
    mark, number = fresh(docs, "content"), fresh(docs, "copy")
    chosen = best.select(F.col("doc_id").alias(fresh(docs, "chosen")), F.col("content").alias(fresh(docs, "chosen_content")))
    marked = docs.withColumn(mark, own)
    same = [marked[doc_id] == chosen[chosen.columns[0]], marked[mark] == chosen[chosen.columns[1]]]
    one = Window.partitionBy(doc_id, mark).orderBy(mark)
    kept = marked.join(chosen, same, "left_semi").withColumn(number, F.row_number().over(one))
    kept = kept.filter(F.col(number) == 1).drop(number, mark)
    return kept.unionByName(docs.filter(F.col(doc_id).isNull()))
