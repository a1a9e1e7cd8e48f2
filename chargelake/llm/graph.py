"""Connected components of an edge table, in a few rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chargelake.staging import staged

EDGES_PER_TASK = 1 << 18


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (x, y) with x < y that connect the same nodes; those of one partition become stars around their least node."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(node):
            while (above := parent.setdefault(node, node)) != node:
                parent[node] = parent[above]
                node = parent[node]
            return node

        def flushed() -> pa.RecordBatch:
            pairs = [(root(node), node) for node in list(parent) if root(node) != node]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*pairs, strict=True), kinds, strict=True)] if pairs else [pa.array([], kind) for kind in kinds]
            parent.clear()
            return pa.RecordBatch.from_arrays(columns, names=["x", "y"])

        kinds = None
        for batch in batches:
            kinds = [column.type for column in batch.columns]
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high = sorted((root(x), root(y)))
                parent[high] = low
            if len(parent) > 2 * EDGES_PER_TASK:
                yield flushed()
        if parent:
            yield flushed()

    return edges.select("x", "y").mapInArrow(stars, edges.select("x", "y").schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of ``edges`` (x, y) can reach.

    Rounds of three steps until nothing changes: every node hands its larger neighbours to its least neighbour, then its
    smaller ones, and each partition contracts what it holds. A step on all edges is one aggregate and one join on the
    node, which can be split where a node is hot. Contraction uses as many tasks as the edges need; where that is one,
    the first pass has found the components. Nodes without an edge to another node are left out.

    ``edges`` should be cheap to read twice.
    """
    tasks = -(-edges.count() // EDGES_PER_TASK)
    state, before = staged(contracted(edges.coalesce(max(tasks, 1))), "edges"), None
    while tasks > 1:
        both = state.unionAll(state.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        larger = both.filter("y > x").join(least, "x").select(F.col("m").alias("x"), "y").filter("x <> y")
        least = larger.groupBy("y").agg(F.min("x").alias("m"))
        other = F.when(F.col("x") == F.col("m"), F.col("y")).otherwise(F.col("x"))
        smaller = larger.join(least, "y").select(F.col("m").alias("x"), other.alias("y")).filter("x <> y")
        state = staged(contracted(smaller.coalesce(tasks)), "edges")
        now = tuple(state.distinct().agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return state.groupBy(F.col("y").alias("node")).agg(F.min("x").alias("label")).unionAll(
        state.select(F.col("x").alias("node"), F.col("x").alias("label")).distinct())
