"""Connected components by alternating large and small stars.

Each round joins every node to the least of its neighbourhood (Kiveris et al.,
"Connected components in MapReduce and beyond"). Rounds grow with the logarithm of
the graph, long chains included. Minima are combined before the shuffle; the edge
list of a round is written to the shared folder, so lineage and size estimates stay
small and a lost executor loses nothing. A round is several jobs whatever its size, and
the driver keeps plans and code of each; graphs below a bound that the caller names are
solved by one task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ends of edges and, for each, the least end that it reaches."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    root, i, j = np.arange(len(nodes)), at[: len(a)], at[len(a) :]
    while len(i):
        x, y = root[i], root[j]
        i, j, x, y = (v[x != y] for v in (i, j, x, y))
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root = up
    return nodes, nodes[root]


def _in_one_task(ends: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if x.num_rows]
        if held:
            nodes, least = least_reached(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["node", "component"])

    return ends.select(F.col("a").cast("long"), F.col("b").cast("long")).coalesce(1).mapInArrow(run, "node long, component long")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, at_once: int = 0) -> DataFrame:
    """(node, component): for every node of an edge, the least node that it reaches.

    Edges have no direction; loops, repeated edges and edges with a null end add
    nothing but, for a loop, its node. An empty input gives no rows. At most
    ``at_once`` edges of integers are solved by one task, more of them in rounds.
    """
    if at_once:
        direct = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("a"), F.col(dst).alias("b"))
        if direct.count() <= at_once:
            return _in_one_task(direct)
    ends = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    ends = materialize(ends.distinct(), "cc-edges")
    now, seen = ends.where("a <> b"), None
    for _ in range(max_rounds):
        after = materialize(_small_star(_large_star(now)), "cc-round")
        state = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen is not None:
            discard(now)
        now = after
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    heads = now.select("b").unionByName(ends.where("a = b").select("b")).distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    tails = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return tails.unionByName(heads.join(tails.select("node"), "node", "left_anti"))
