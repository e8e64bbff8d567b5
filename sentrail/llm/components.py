"""Connected components of a graph given as a table of links: block-wise spanning forests, then star steps.

Each task first replaces the links that it holds, a block at a time, by a spanning forest: every node of the
block on the least node of its part. What is left has at most one link per node and block. Forests of up to
``task_links`` links in all are joined in one task, which holds no more than that; larger ones go through
alternating large-star and small-star steps until nothing moves, each written before the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sentrail.session import scratch_path

#: links that one task contracts at a time (about 100 bytes of memory each)
BLOCK_LINKS = 1_000_000


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its part) for every node of the links that is not the least itself."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        high, low = np.maximum(root[one], root[two]), np.minimum(root[one], root[two])
        apart = high != low
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _forest(links: DataFrame, block: int) -> DataFrame:
    """Links (a, b) replaced by spanning forests of blocks. Narrow: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def made() -> Iterator[pa.RecordBatch]:
            node, least = contract(*(np.concatenate(side) for side in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(least)], names=["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(name).to_numpy(zero_copy_only=False) for name in ("a", "b")))
            size += batch.num_rows
            if size >= block:
                yield from made()
                held, size = [], 0
        if size:
            yield from made()

    return links.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, "a long, b long")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (large) or smaller (small) neighbours on its least neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b <= a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select("b", "m").union(least.select(F.col("a").alias("b"), "m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b")


def _written(links: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The links, written, with their number and the sum of their hashes as the write counted them."""
    seen = Observation()
    path = scratch_path(links.sparkSession, "links")
    counted = links.observe(seen, F.count("*").alias("n"), F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0)).alias("mark"))
    counted.write.parquet(path)
    return links.sparkSession.read.schema("a long, b long").parquet(path), (seen.get["n"], seen.get["mark"])


def components(links: DataFrame, task_links: int = BLOCK_LINKS, block: int = BLOCK_LINKS) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b) with another one; the component is its smallest node.

    Rounds of star steps grow as the logarithm of a component's size; a node with many links is split by the
    adaptive join and the map-side minimum.
    """
    links, mark = _written(_forest(links.filter("a <> b"), block))
    while mark[0] > task_links:
        before = mark
        links, mark = _written(_star(_star(links, True), False).distinct())
        if mark == before:
            break
    else:
        links = _forest(links.coalesce(1), max(1, task_links))
    both = links.selectExpr("a as node", "b as component").union(links.selectExpr("b as node", "b as component"))
    return both.groupBy("node").agg(F.min("component").alias("component"))
