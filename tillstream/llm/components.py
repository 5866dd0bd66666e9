"""Connected components: contraction inside each task, then alternating stars, with a written table per round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.arrays import shuffles_dropped
from tillstream.session import scratch_folder

TASK_EDGES = 1_000_000
BATCH_ROWS = 100_000


def written(df: DataFrame, folder: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder."""
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Hook the neighbours of each node to the least node around it: the larger ones, or the smaller ones and itself."""
    if large:
        edges = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hooked = edges.join(least, "a").where(F.col("b") > F.col("a") if large else F.lit(True))
    hooked = hooked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        hooked = hooked.unionAll(least.select("a", F.col("m").alias("b")))
    return hooked.where(F.col("a") != F.col("b")).distinct()


def forest(edges: DataFrame) -> DataFrame:
    """The components of each partition's edges alone: an edge from every node to the least one it reaches there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        for batch in batches:
            for side, column in zip(sides, batch.columns, strict=True):
                side.append(column.to_numpy(zero_copy_only=False))
        a, b = map(np.concatenate, sides)
        nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
        root = least_reached(places[: len(a)], places[len(a):], len(nodes))
        other = np.flatnonzero(root != np.arange(len(nodes)))
        for at in range(0, len(other), BATCH_ROWS):
            some = other[at:at + BATCH_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[root[some]])], ["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def least_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of n nodes reaches by the edges (a, b): hook roots to smaller ones, then jump."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def components(edges: DataFrame, most: int = TASK_EDGES) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its least node.

    Each round first joins what is connected inside a task (of at most about ``most`` edges), which leaves no more edges than
    nodes, then lets the tasks' results meet by a star round. With few enough edges the first step is all.
    """
    spark: SparkSession = edges.sparkSession
    folder = scratch_folder(spark, "components")
    edges = written(edges.where(F.col("a") != F.col("b")), f"{folder}/0")
    before, k = None, 0
    while True:
        k += 1
        state = fingerprint(edges)
        tasks = -(-state[0] // most)
        if state == before or not tasks:
            break
        before = state
        dealt = edges.coalesce(1) if tasks == 1 else edges.repartition(tasks, "b")
        edges = written(forest(dealt), f"{folder}/{k}-forest")
        if tasks == 1:
            break
        edges = written(star(star(edges, large=True), large=False), f"{folder}/{k}")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionAll(found.select(F.col("component").alias("node"), "component").distinct())


def fingerprint(edges: DataFrame) -> tuple:
    """Row count and order-free hash; equal when a round changed nothing."""
    # ANSI sums fail on overflow: 63-bit hashes are added as decimals.
    spread = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*").alias("n"), spread.alias("h")).first())
