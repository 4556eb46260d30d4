"""Connected components of an edge table: blocks of edges are contracted by themselves, and alternating stars join the blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import drop, save

#: Edges of a block that one task contracts (some 16 MB, and some 100 MB of work space).
BLOCK = 1_000_000


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some edges, and the smallest node that each reaches over them."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(above := root[root], root):
            root = above


def contract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of a block → each node, and the smallest one that it reaches inside the block."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if parts:
        node, root = roots(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "component"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) → (node, component): the smallest node that is reachable.

    Every round first contracts blocks of ``BLOCK`` edges in a task each: the edges of a block become stars.
    Where all edges fit one block, that ends it. Else it turns the neighbours of a node to its smallest
    neighbour, once over the larger and once over the smaller ones, so that long chains halve and a large group
    ends as one star; only aggregates and equi-joins run there, and no group is gathered. Nodes without an edge to
    another one can be missing; an empty table gives an empty one. Null nodes are ignored.
    """
    now = edges if hasattr(edges, "_saved_at") else save(edges.select("a", "b"), "edges")  # coalesce below must not reach into a plan
    now, mark = now.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")), None
    for _ in range(max_rounds):
        blocks = -(-now.count() // BLOCK)
        stars = save(now.coalesce(max(blocks, 1)).mapInArrow(contract_rows, "node long, component long"), "components")
        if blocks <= 1:
            return stars
        after = save(_small_star(_large_star(stars.where("node <> component").toDF("u", "v"))), "edges")
        drop(stars)
        seen = _mark(after)
        if seen == mark:
            nodes = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.unionByName(after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        now, mark = after, seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    turned = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
