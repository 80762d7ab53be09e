"""Merkle manifest of a table: one tree per group, one tree over the groups, a proof for every row.

A row's rank within its group, written in digits, is its place in the tree. Rows are dealt to blocks of
``fan ** digits`` consecutive ranks, and within a block the digit columns are grouped away one after another,
lowest first: each step nests the structs of its children and hashes them. All steps of a block run in one
task after a single shuffle, and no block is larger than that. The block roots are the rows of the next,
shorter table, and so on. Going down again, nested transforms turn each block into the steps of its
rows and explode them; steps from above meet a block by a union and a grouping. Proofs need no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import fresh, stored
from tillwatch.operators.ordered import ranked

#: Digits of the rank, and so levels of the tree, within one block: 256 rows with two children per node.
DIGITS = 8


def digest(values: list[Column]) -> Column:
    """SHA-256 of the values in a row: ``-`` for NULL, else byte count, colon, value as text."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def _height(n: Column, fan: int) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    powers = [p for p in (fan ** i for i in range(63)) if p < 1 << 63]
    return F.size(F.filter(F.array(*[F.lit(p).cast("bigint") for p in powers]), lambda p: p < n))


def _blocks(rows: DataFrame, group: list[str], fan: int, digits: int, depth: int) -> DataFrame:
    """(group, block, height, node): the nested structs of each block. ``rows``: group, pos, height, node."""
    names = [f"_d{i}" for i in range(digits)]
    table = rows.select(*group, F.expr(f"pos div {fan ** digits}L").alias("block"), "height", "node",
                        *[F.expr(f"cast((pos div {fan ** i}L) % {fan} as int)").alias(d) for i, d in enumerate(names)])
    table = table.repartition(*group, "block")
    for i, digit in enumerate(names):
        nested = table.groupBy(*group, "block", *names[:i:-1]).agg(
            F.max("height").alias("height"), F.array_sort(F.collect_list(F.struct(F.col(digit).alias("d"), "node"))).alias("kids"))
        inside = F.col("height") > depth * digits + i
        joined = F.array_join(F.transform("kids", lambda k: k["node"]["h"]), "")
        h = F.when(inside, F.sha2(joined, 256)).otherwise(F.col("kids")[0]["node"]["h"])
        table = nested.withColumn("node", F.struct(h.alias("h"), "kids")).drop("kids")
    return table


def _paths(node: Column, level: int, below: int, steps: Column) -> Column:
    """(item, steps) of all rows below ``node``, whose own way to the root is ``steps``; ``below``: levels below the block."""
    if level < 0:
        return F.array(F.struct(node["item"].alias("item"), steps.alias("steps")))
    inside = F.col("height") > below + level
    hashes = F.transform(node["kids"], lambda k: k["node"]["h"])

    def told(k: Column, at: Column) -> Column:
        own = F.struct(F.array_join(F.slice(hashes, 1, at), "").alias("l"),
                       F.array_join(F.slice(hashes, at + 2, F.size(hashes)), "").alias("r"))
        here = F.when(inside, F.array(own)).otherwise(F.array().cast(_STEPS))
        return F.struct(k["node"].alias("node"), F.concat(here, steps).alias("steps"))

    kids = F.transform(node["kids"], told)
    return F.flatten(F.transform(kids, lambda k: _paths(k["node"], level - 1, below, k["steps"])))


_STEPS = "array<struct<l: string, r: string>>"


def _meet(blocks: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """Each block with what ``above`` says of it: a union and a grouping. Both have one row per key."""
    both = blocks.unionByName(above, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns if c not in keys])


def _tree(rows: DataFrame, group: list[str], fan: int, digits: int, top) -> DataFrame:
    """(group, item, root..., steps) of each row of ``rows`` (group, _rank, _n, node).

    ``top`` gets (group, h), the roots of all groups, and returns (group, what to tell the rows, steps above).
    """
    table = rows.select(*group, F.col("_rank").alias("pos"), _height(F.col("_n"), fan).alias("height"), "node")
    tallest = table.agg(F.max("height")).first()[0] or 0
    depths = []
    for depth in range(max(1, -(-tallest // digits))):
        depths.append(stored(_blocks(table, group, fan, digits, depth), f"manifest-blocks-{depth}"))
        table = depths[-1].select(*group, F.col("block").alias("pos"), "height",
                                  F.struct(F.col("node.h").alias("h"), F.struct("block").alias("item")).alias("node"))
    told = top(depths[-1].select(*group, F.col("node.h").alias("h")))
    extra = [c for c in told.columns if c not in (*group, "steps")]
    above = told.withColumn("block", F.lit(0).cast("bigint"))
    for depth in reversed(range(len(depths))):
        met = _meet(depths[depth], above, [*group, "block"])
        paths = met.select(*group, *extra, F.explode(_paths(F.col("node"), digits - 1, depth * digits, F.col("steps"))).alias("path"))
        above = paths.select(*group, *extra, "path.item", "path.steps")
        if depth:
            above = above.withColumn("block", F.col("item.block")).drop("item")
    return above


def manifest(docs: DataFrame, columns: list[str], doc_id: str = "doc_id", group: str = "lang", fan: int = 2,
             digits: int = DIGITS, carry: list[str] = ()) -> DataFrame:
    """(doc_id, leaf, subroot, root, steps, carried columns) for each row of ``docs``.

    A leaf is the digest of ``columns``. Leaves of equal ``group`` (NULL is a group) ascend by ``doc_id``, then
    by leaf; NULL ids come first. Runs of ``fan`` nodes, the last run perhaps of one, are hashed level by level
    until one node remains, the subroot; the subroots, in the order of the groups, form the same tree, whose
    last node is the root. A lone node is its own root. ``steps`` goes from the leaf to the root: the digests
    left (``l``) and right (``r``) of the row's own in each run. Equal rows each have a leaf and a place. An
    empty table gives no rows. Other columns do not matter; carried ones get an underscore where they clash.
    """
    leaves = docs.select(F.col(f"`{group}`").alias("_group"), F.col(f"`{doc_id}`").alias("_id"),
                         digest([F.col(f"`{c}`") for c in columns]).alias("_leaf"),
                         *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)])
    carried = [f"_c{i}" for i in range(len(carry))]
    rows = ranked(stored(leaves, "manifest-leaves"), ["_group"], ["_id", "_leaf"]).withColumn(
        "node", F.struct(F.col("_leaf").alias("h"), F.struct("_id", "_leaf", *carried).alias("item")))

    def root_of_groups(subroots: DataFrame) -> DataFrame:
        ordered = ranked(stored(subroots, "manifest-subroots"), [], ["_group"])
        nodes = ordered.withColumn("node", F.struct("h", F.struct("_group", F.col("h").alias("subroot")).alias("item")))
        told = _tree(nodes, [], fan, digits, lambda root: root.select(F.col("h").alias("root"), F.array().cast(_STEPS).alias("steps")))
        return stored(told.select("item._group", "item.subroot", "root", "steps"), "manifest-groups")

    proofs = _tree(rows, ["_group"], fan, digits, root_of_groups)
    out = proofs.select(F.col("item._id").alias(doc_id), F.col("item._leaf").alias("leaf"), "subroot", "root", "steps",
                        *[F.col(f"item.{c}").alias(c) for c in carried])
    for c, name in zip(carried, carry):
        out = out.withColumnRenamed(c, fresh(out, name))
    return out


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the steps of a proof lead to."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings of a proof, from the leaf's level to the root, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["l"], s["r"])), ""), 256)
