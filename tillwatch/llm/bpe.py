"""Byte-level BPE: encode texts by a rank file and decode ids.

Each match of the split pattern is merged on its own. A segment tree over its byte positions keeps the
smallest (rank, position) of all live neighbour pairs, so its root is the leftmost pair of minimum rank. A
merge joins two live neighbours and updates the three leaves it touches, logarithmic work each. Many
short pieces are merged at once: one tree per piece, as rows of numpy arrays. Every text is one row of the
table and is encoded whole in its task; nothing is shuffled.
"""

from __future__ import annotations

import base64
from array import array
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import fresh, lists, slices

NONE = np.iinfo(np.int64).max
#: Pieces above so many bytes are merged one by one.
SHORT = 64
#: So many pieces a worker process remembers.
REMEMBERED = 200_000
#: Bytes of text worked on at once.
AT_ONCE = 1 << 20


class Vocabulary:
    """Token bytes by id, and the rank of each pair of tokens that forms a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            entries = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in entries}
        self.token = [b""] * (max(self.rank.values()) + 2)
        keys, ranks = array("q"), array("q")
        for token, rank in self.rank.items():
            self.token[rank] = token
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        order = np.argsort(np.asarray(keys))
        self.keys, self.ranks = np.asarray(keys)[order], np.asarray(ranks)[order]
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int64)

    def decode(self, flat: np.ndarray, sizes) -> list[bytes]:
        """Bytes of each run of ids; ids that are no token give none."""
        known = np.where((flat < 0) | (flat >= len(self.token)), len(self.token) - 1, flat).tolist()
        ends = np.cumsum(np.asarray(sizes, np.int64)).tolist()
        return [b"".join(map(self.token.__getitem__, known[e - n:e])) for e, n in zip(ends, sizes)]

    @cached_property
    def pairs(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist()))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank per pair of token ids, NONE where the two form no token."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_long(piece: bytes, words: Vocabulary) -> list[int]:
    """One piece of any length."""
    n = len(piece)
    width = 1 << max(1, n - 1).bit_length()
    token = words.byte[np.frombuffer(piece, np.uint8)]
    leaves = np.full(width, NONE, np.int64)
    ranks = words.pair_ranks(token[:-1], token[1:])
    there = np.flatnonzero(ranks != NONE)
    leaves[there] = ranks[there] * width + there
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).min(1))
    levels = [level.tolist() for level in levels]
    token = token.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(at: int, value: int) -> None:
        for level in levels:
            level[at] = value
            if at ^ 1 < len(level):
                value = min(value, level[at ^ 1])
            at >>= 1

    def leaf(left: int) -> None:
        right = after[left]
        rank = words.pairs.get(token[left] << 32 | token[right]) if right < n else None
        put(left, NONE if rank is None else rank * width + left)

    while (best := levels[-1][0]) != NONE:
        left = best % width
        right = after[left]
        token[left] = best // width
        after[left] = after[right]
        if after[right] < n:
            before[after[right]] = left
        put(right, NONE)
        leaf(left)
        if before[left] >= 0:
            leaf(before[left])
    ids, at = [], 0
    while at < n:
        ids.append(token[at])
        at = after[at]
    return ids


def merge_short(pieces: list[bytes], words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of at most SHORT bytes, all at once: row i of each array belongs to piece i.

    Returns the ids of all pieces in a row and how many each has.
    """
    size = np.array([len(p) for p in pieces])
    width = 1 << max(1, int(size.max()) - 1).bit_length()
    at = np.arange(width)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
    token = words.byte[raw]
    after = np.broadcast_to(at + 1, token.shape).copy()
    before = np.broadcast_to(at - 1, token.shape).copy()
    live = np.ones(token.shape, bool)
    tree = np.full((len(pieces), 2 * width), NONE, np.int64)
    ranks = words.pair_ranks(token[:, :-1], token[:, 1:])
    there = (ranks != NONE) & (at[1:] < size[:, None])
    tree[:, width:2 * width - 1][there] = (ranks * width + at[:-1])[there]
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    def put(rows, places, values):
        node = places + width
        tree[rows, node] = values
        while node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def leaves(rows, left):
        right = after[rows, left]
        inside = right < size[rows]
        rank = words.pair_ranks(token[rows, left], token[rows, np.minimum(right, width - 1)])
        return np.where(inside & (rank != NONE), np.where(inside, rank, 0) % (1 << 40) * width + left, NONE)

    rows = np.arange(len(pieces))
    while len(rows := rows[tree[rows, 1] != NONE]):
        best = tree[rows, 1]
        left, right = best % width, after[rows, best % width]
        token[rows, left] = best // width
        live[rows, right] = False
        follow = after[rows, right]
        after[rows, left] = follow
        more = follow < size[rows]
        before[rows[more], follow[more]] = left[more]
        put(rows, right, NONE)
        put(rows, left, leaves(rows, left))
        lead = before[rows, left]
        some = lead >= 0
        if some.any():
            put(rows[some], lead[some], leaves(rows[some], lead[some]))
    live &= at < size[:, None]
    return token[live], live.sum(1)


def merge(pieces: list[bytes], words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, ids, sizes): ids of all pieces in a row, in the given order, and how many each has.

    A piece that is a token as a whole is that token.
    """
    groups: dict[int, list[int]] = {}
    order, flat, sizes = [], [], []
    for i, piece in enumerate(pieces):
        n = len(piece)
        if n > SHORT or piece in words.rank:
            ids = [words.rank[piece]] if piece in words.rank else merge_long(piece, words)
            order.append(np.array([i]))
            flat.append(np.array(ids))
            sizes.append(np.array([len(ids)]))
        else:
            groups.setdefault((n - 1).bit_length(), []).append(i)
    for chosen in groups.values():
        for k in range(0, len(chosen), 1 << 13):
            part = chosen[k:k + (1 << 13)]
            ids, size = merge_short([pieces[i] for i in part], words)
            order.append(np.array(part))
            flat.append(ids)
            sizes.append(size)
    return tuple(np.concatenate(x) for x in (order, flat, sizes))


class Encoder:
    """Encodes texts one after another and remembers the ids of pieces."""

    def __init__(self, path: str, pattern: str):
        self.words = vocabulary(path)
        self.pattern = regex.compile(pattern)
        self.place: dict[str, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.bank = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _learn(self, pieces: list[str]) -> None:
        order, ids, sizes = merge([p.encode() for p in pieces], self.words)
        number, used = len(self.place), self.used + len(ids)
        while number + len(order) > len(self.start):
            self.start, self.size = (np.resize(x, 2 * len(x)) for x in (self.start, self.size))
        while used > len(self.bank):
            self.bank = np.resize(self.bank, 2 * len(self.bank))
        self.bank[self.used:used] = ids
        self.size[number:number + len(order)] = sizes
        self.start[number:number + len(order)] = self.used + np.cumsum(sizes) - sizes
        self.place.update(zip(map(pieces.__getitem__, order.tolist()), range(number, number + len(order))))
        self.used = used

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and how many each has. Beyond REMEMBERED, new pieces are forgotten."""
        new = [p for p in set(pieces) if p not in self.place]
        used = self.used
        if new:
            self._learn(new)
        number = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        size = self.size[number]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.bank[np.repeat(self.start[number] - ends + size, size) + np.arange(total)]
        if len(self.place) > REMEMBERED or self.used > 16 * REMEMBERED:
            for piece in new:
                del self.place[piece]
            self.used = used
        return ids, size

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts in a row, and how many each text has. Bounded batches of texts, please."""
        pieces, counts = [], []
        for text in texts:
            if len(text) > 1 << 22:
                return self._one_by_one(texts)
            found = self.pattern.findall(text)
            pieces += found
            counts.append(len(found))
        ids, size = self._ids(pieces)
        ends = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]).tolist()

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        parts, sizes = [], []
        for text in texts:
            found, n = (m.group() for m in self.pattern.finditer(text)), 0
            while pieces := list(islice(found, 1 << 17)):
                parts.append(self._ids(pieces)[0])
                n += len(parts[-1])
            sizes.append(n)
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), sizes


@lru_cache(maxsize=1)
def encoder_of(path: str, pattern: str) -> Encoder:
    """One per worker process, whatever number of tasks it runs."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "tokens",
           decoded: str | None = None) -> DataFrame:
    """Replace ``text`` by ``into``, the ids (array<int>) of the whole text without special tokens.

    ``path`` names a rank file that every executor can open. With ``decoded``, a column of that name gets the
    bytes that the ids decode to, in the same pass. A NULL text counts as empty: no ids. All other columns and
    all rows stay; a new column gets an underscore where there is one of its name.
    """
    kept = docs.drop(text)
    rest = kept.columns
    into = fresh(kept, into)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + [f"`{into}` array<int>"]
    names = [*rest, into]
    if decoded:
        decoded = fresh(kept, decoded)
        kinds.append(f"`{decoded}` binary")
        names.append(decoded)
    source = fresh(kept, "text")

    def work(batches):
        encoder = encoder_of(path, pattern)
        for batch in slices(batches, source, AT_ONCE):
            ids, sizes = encoder.encode(batch.column(source).to_pylist())
            made = [lists(ids, sizes, pa.int32())]
            if decoded:
                made.append(pa.array(encoder.words.decode(ids, sizes), pa.binary()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *made], names=names)

    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(source)
    return docs.select(*[F.col(f"`{c}`") for c in rest], whole).mapInArrow(work, ", ".join(kinds))


def decode(frame: DataFrame, path: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """Add ``into``, the bytes (binary) that the ids stand for. NULL ids, and ids without a token, give none."""
    into = fresh(frame, into)
    rest = frame.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields] + [f"`{into}` binary"])

    def work(batches):
        words = vocabulary(path)
        for batch in batches:
            column = batch.column(tokens)
            flat = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            made = words.decode(flat, column.value_lengths().fill_null(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*rest, into])

    return frame.mapInArrow(work, schema)


def digests(frame: DataFrame, tokens: str = "tokens", decoded: str = "decoded") -> DataFrame:
    """Add n_tokens and the SHA-256 of the comma-joined ids and of the decoded bytes, and drop both."""
    joined = F.array_join(F.col(tokens).cast("array<string>"), ",")
    return (frame.withColumn("n_tokens", F.size(tokens).cast("bigint"))
            .withColumn("ids_sha256", F.sha2(joined, 256))
            .withColumn("decoded_sha256", F.sha2(F.col(decoded), 256)).drop(tokens, decoded))
