"""Connected components of links between numbered nodes, each named by its smallest node.

Large-star and small-star steps in turn: every node's larger neighbours are linked to its smallest
one, then its smaller neighbours are. The links end up as stars around the smallest node of each
component after a number of rounds that grows with the logarithm of the nodes. A round is joins
and minima; no neighbour lists are gathered, so a node with very many links is no large group.
Each round is written to the shared folder, which cuts the lineage, and replaces the one before. ``FEW`` links or fewer are less
work than the rounds' overhead: one task joins them, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import discard, scratch, stored


#: Links (two numbers each) that one task joins; more go through the rounds.
FEW = 10_000


def _in_one_task(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(n: int) -> int:
            while above.setdefault(n, n) != n:
                above[n] = n = above[above[n]]
            return n

        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
                a, b = top(a), top(b)
                above[max(a, b)] = min(a, b)
        nodes = list(above)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([top(n) for n in nodes], pa.int64())], ["node", "component"])

    one = links.filter("a <> b").select("a", "b").coalesce(1)
    return stored(one.mapInArrow(run, "node long, component long"), "components")


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each link with the smallest of u's neighbours."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = F.least("u", "m")
    return _least(both).filter("v > u").select(F.col("v").alias("u"), m.alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` lead from the larger to the smaller node."""
    return _least(links).select(F.inline(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        F.struct(F.col("u"), F.col("m").alias("v"))))).filter("u <> v").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Every node leads to one other, which leads nowhere."""
    ends = links.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))))
    found = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return found.filter("out > 1 OR out = 1 AND into = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have a link, as a stored table.

    ``links`` has two number columns, a and b, and is read more than once.
    """
    if links.count() <= FEW:
        return _in_one_task(links)
    with scratch() as keep:
        now = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        while True:
            larger = stored(_large_star(now), "links")
            before, now = now, stored(_small_star(larger), "links")
            discard(before, larger)
            if _are_stars(now):
                break
        return keep(stored(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
            now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components"))
