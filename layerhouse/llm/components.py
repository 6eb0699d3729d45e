"""Connected components of a graph given as an edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from layerhouse.llm.common import saved, work_dir

BLOCK = 1 << 18


class Joined:
    """Which nodes are connected so far; the smallest node of a component stands for it."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def join(self, a: int, b: int) -> bool:
        """False if the two were connected before."""
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[max(a, b)] = min(a, b)
        return a != b


def _contracted(batches):
    """Links every node of a block of edges to the smallest node that the block connects it with."""

    def stars(us, vs):
        joined = Joined()
        for u, v in zip(np.concatenate(us).tolist(), np.concatenate(vs).tolist()):
            joined.join(u, v)
        pairs = [(x, r) for x in list(joined.root) if (r := joined.find(x)) != x]
        return pa.record_batch([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

    us, vs, held = [], [], 0
    for batch in batches:
        us.append(batch.column(0).to_numpy(zero_copy_only=False))
        vs.append(batch.column(1).to_numpy(zero_copy_only=False))
        held += len(batch)
        if held >= BLOCK:
            yield stars(us, vs)
            us, vs, held = [], [], 0
    if held:
        yield stars(us, vs)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One alternating star step on rows (u, v) with u > v.

    Large: neighbours above a node are linked to the smallest node of its neighbourhood. Small:
    the same for the neighbours below it and the node itself. The smallest neighbour is an
    aggregate that is joined back, so no task holds the neighbourhood of a hub.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        least = least.select("u", F.least("u", "m").alias("m"))
        return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    linked = near.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v")))


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table in the shared folder, and their number and sum of hashes, observed while writing."""
    seen = Observation()
    path = work_dir(edges.sparkSession, "links")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    edges.observe(seen, F.count("*").alias("n"), mark.alias("mark")).write.option("compression", "zstd").parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), (seen.get["n"], seen.get["mark"])


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (u long, v long): root is the smallest node reachable.

    Alternating large-star and small-star steps until a round changes nothing, which takes a number of
    rounds that grows with the logarithm of the longest chain at most: each task first replaces the edges it reads,
    in blocks, by stars, so short chains and small graphs are done at once. Each round is written to the shared
    folder. Self links, repeated links and links with a null end are ignored; no link, no row.

    The links are written first: where they come from a Python operator, a task would run it and the contraction at once,
    with two Python workers for each core, and Spark keeps them all, each with what it has loaded.
    """
    edges = edges.filter("u <> v").select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    edges = saved(edges, "edges")
    current, mark = _written(edges.mapInArrow(_contracted, "u long, v long").distinct())
    while mark[0]:
        before = mark
        step = _star(_star(current.mapInArrow(_contracted, "u long, v long"), True), False)
        current, mark = _written(step.distinct())
        if mark == before:
            break
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
