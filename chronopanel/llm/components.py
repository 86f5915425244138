"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Every step is a minimum over neighbours, combined before the shuffle, and a join with those minima; a node with very many neighbours is
split by adaptive execution. Lineage is cut after each round. A graph of few edges is one task's work, without rounds: each round leaves its plans
and stages in the driver's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 60
#: Edges up to which one task finds the components (16 MB).
FEW = 1 << 20


def roots(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index of each of n nodes, by hooking and pointer jumping."""
    parent = np.arange(n) if parent is None else parent
    while True:
        ra, rb = parent[a], parent[b]
        live = ra != rb
        if not live.any():
            return parent
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (parent != (up := parent[parent])).any():
            parent = up


def _at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cols = [[batch.column(k).to_numpy(zero_copy_only=False) for k in range(2)] for batch in batches]
    if not cols:
        return
    u, v = (np.concatenate(c) for c in zip(*cols, strict=True))
    nodes = np.unique(np.concatenate([u, v]))
    root = nodes[roots(len(nodes), np.searchsorted(nodes, u), np.searchsorted(nodes, v))]
    for at in range(0, len(nodes), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)], pa.int64()) for x in (nodes, root)], names=["node", "root"])


def components(edges: DataFrame, src: str = "a", dst: str = "b", few: int = FEW) -> DataFrame:
    """(node, root) of every node that has an edge to another one; root is the smallest node that it reaches."""
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    if e.count() <= few:
        return e.select(F.col("u").cast("long"), F.col("v").cast("long")).coalesce(1).mapInArrow(_at_once, "node long, root long")
    last = None
    for _ in range(MAX_ROUNDS):
        # large star: every larger neighbour of u is hung under the smallest node near u
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u, and u itself, are hung under the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = now
    raise RuntimeError("components did not settle")
