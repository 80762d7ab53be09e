"""Euclidean p-stable hashing of vectors scaled to length 1, shared by search and near-duplicates.

A hash function is floor((a.x + b) / width) with normal ``a`` and uniform ``b``; a table joins several of
them into one bucket number.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def collision(distance: float, width: float) -> float:
    """Probability that one hash function puts two points of this distance into the same slot."""
    if distance <= 0:
        return 1.0
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(distance: float, width: float, hashes: int, found: float) -> int:
    """Tables needed so that points of this distance share a bucket with probability ``found``."""
    together = collision(distance, width) ** hashes
    return max(1, math.ceil(math.log(1 - found) / math.log(1 - together))) if together < 1 else 1


@dataclass(frozen=True)
class PStable:
    dim: int
    tables: int
    hashes: int
    width: float
    seed: int = 42

    @cached_property
    def _drawn(self):
        draw = np.random.default_rng(self.seed)
        n = self.tables * self.hashes
        return (draw.normal(size=(self.dim, n)), draw.uniform(0, self.width, n),
                draw.integers(1, 1 << 62, (self.tables, self.hashes), np.int64) * 2 + 1,
                draw.integers(1, 1 << 62, self.tables, np.int64))

    def places(self, unit: np.ndarray) -> np.ndarray:
        """(n, tables, hashes): where each vector falls, in slots."""
        a, b, _, _ = self._drawn
        return ((unit @ a + b) / self.width).reshape(-1, self.tables, self.hashes)

    def number(self, slots: np.ndarray) -> np.ndarray:
        """Bucket numbers (..., tables) of slots (..., tables, hashes)."""
        _, _, odd, offset = self._drawn
        with np.errstate(over="ignore"):
            return (slots.astype(np.int64) * odd).sum(-1) + offset

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        return self.number(np.floor(self.places(unit)))

    def perturbed(self, place: np.ndarray, most: int) -> Iterator[np.ndarray]:
        """Slots of one table in estimated success order: the own one, then by squared distance to walls.

        Sets of single steps are grown from the nearest wall by the two moves of query-directed probing
        (shift the last step, append the next one); a set that moves one function both ways is skipped.
        """
        slot = np.floor(place)
        yield slot
        part = place - slot
        n = len(part)
        walls = sorted([(part[i] ** 2, i, -1.0) for i in range(n)] + [((1 - part[i]) ** 2, i, 1.0) for i in range(n)])
        heap, made = [(walls[0][0], (0,))], 1
        while heap and made < most:
            cost, steps = heapq.heappop(heap)
            last = steps[-1]
            if last + 1 < len(walls):
                more = walls[last + 1][0]
                heapq.heappush(heap, (cost - walls[last][0] + more, steps[:-1] + (last + 1,)))
                heapq.heappush(heap, (cost + more, steps + (last + 1,)))
            moved = [walls[s][1] for s in steps]
            if len(set(moved)) == len(moved):
                out = slot.copy()
                for s in steps:
                    out[walls[s][1]] += walls[s][2]
                made += 1
                yield out


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; the same two vectors give the same number in any batch."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def numbers(df: DataFrame, embedding: str) -> str:
    """Type in which the vectors are kept: their own for float, double for any other number."""
    return "float" if df.schema[embedding].dataType.elementType == T.FloatType() else "double"


def lengths(df: DataFrame, embedding: str) -> list[int]:
    """The lengths that occur. Vectors of one length are a space of their own: no cosine joins two lengths."""
    found = df.filter(F.col(embedding).isNotNull()).select(F.size(embedding)).distinct().collect()
    return sorted(r[0] for r in found if r[0])


def usable(embedding: str) -> Column:
    """Vectors of finite numbers that are not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    column = F.col(embedding)
    return F.coalesce(F.forall(column, finite) & F.exists(column, lambda x: x != 0), F.lit(False))


def same_vector(*columns: str) -> list[Column]:
    """128 bits that stand for equal values of the columns."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(1), *columns).alias("h2")]
