"""Shards from a hierarchical weighted hash tree (regions, racks, shards).

Every node of the tree has the weight of the shards below it.  A row goes down the tree: on
each level every child draws ``-ln(u) / weight`` with ``u`` hashed from the id and the
child, and the smallest draw wins.  So a child gets rows in proportion to its weight, a
draw depends on nothing but id, child and weight, and a change of one weight moves rows only
into or out of that child.

Law ``key``: the id and the shard count decide.  The first ``shards`` shards fill the racks
of the given regions; a shard added later is a region of its own.  The draws of the other
regions stay as they are, so every row that moves goes into the new shard.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cabflow.llm.common import text_of

#: Rows of one shard that are numbered together.
SLICE_ROWS = 100_000


@dataclass(frozen=True)
class Node:
    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def _inner(name: str, children: Sequence[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def tree(shards: int, added: int = 0, regions: int = 2, racks: int = 3, weights: Sequence[float] | None = None) -> Node:
    """The tree of ``shards`` shards dealt over regions and racks, and ``added`` new ones.

    ``weights`` are those of all shards, by number; 1 each by default.
    """
    weights = weights or [1.0] * (shards + added)
    leaf = lambda s: Node(f"shard-{s}", weights[s], shard=s)
    per_region = math.ceil(shards / regions)
    per_rack = math.ceil(per_region / racks)
    top = []
    for r, first in enumerate(range(0, shards, per_region)):
        last = min(first + per_region, shards)
        below = [
            _inner(f"rack-{r}-{i}", [leaf(s) for s in range(start, min(start + per_rack, last))])
            for i, start in enumerate(range(first, last, per_rack))
        ]
        top.append(_inner(f"region-{r}", below))
    for s in range(shards, shards + added):
        top.append(_inner(f"region-of-{s}", [_inner(f"rack-of-{s}", [leaf(s)])]))
    return _inner("root", top)


def _draw(key: Column, node: Node) -> Column:
    """An exponential draw with the node's weight as rate, from the id and the node's name."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11)
    return -F.log((bits + 0.5) / float(1 << 53)) / node.weight


def place(df: DataFrame, key: str, root: Node, out: str) -> DataFrame:
    """Adds the shard of each row, going down the tree one level after the other."""
    at, nodes = f"_{out}", [root]
    df = df.withColumn(at, F.lit(0))
    while any(n.shard is None for n in nodes):
        below: list[Node] = []
        choice = F.lit(None).cast("int")
        for i, node in enumerate(nodes):
            # A leaf that is reached early stays.
            children = [c for c in node.children if c.weight > 0] or [node]
            draws = [
                F.struct(_draw(F.col(key), c).alias("draw"), F.lit(len(below) + j).alias("node"))
                for j, c in enumerate(children)
            ]
            best = F.array_min(F.array(*draws))["node"] if len(children) > 1 else F.lit(len(below))
            choice = F.when(F.col(at) == i, best).otherwise(choice)
            below += children
        df, nodes = df.withColumn(at, choice), below
    numbers = F.array(*[F.lit(n.shard) for n in nodes])
    return df.withColumn(out, F.get(numbers, F.col(at))).drop(at)


def shard(docs: DataFrame, shards: int = 24, added: int = 1, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Size, checksum, shard, place within the shard and grown shard of every row.

    A null id is a key of its own (one shard takes such rows), a null text counts as empty.
    Repeated ids share a shard and take neighbouring slots by checksum and size; rows equal
    in all of these may take each other's slot.  Slots follow a hash of the id: the rows of
    a shard are cut into slices of about ``slice_rows``, counted, and only the rows of one
    slice are sorted together.
    """
    text = text_of()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        F.col("doc_id"),
        key.alias("key"),
        (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        # Slices by hash are even, whatever the ids are.
        F.shiftrightunsigned(F.xxhash64(key, F.lit("slot")), 1).alias("order_hash"),
    )
    rows = place(rows, "key", tree(shards), "shard")
    rows = place(rows, "key", tree(shards, added), "grown_shard")
    total = docs.count()
    slices = max(1, math.ceil(total / shards / slice_rows))
    rows = rows.withColumn("slice", F.floor(F.col("order_hash") / F.lit(float(1 << 63)) * slices).cast("int"))
    before = W.partitionBy("shard").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    within = W.partitionBy("shard", "slice").orderBy("order_hash", "doc_id", "text_crc32", "size")
    slot = (F.col("start") + F.row_number().over(within) - 1).cast("bigint")
    return (
        rows.join(starts, ["shard", "slice"])
        .withColumn("slot", slot)
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    )
