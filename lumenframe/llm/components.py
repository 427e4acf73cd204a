"""Connected components of links, by union-find in partitions and contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_small, materialize


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of every node of a partition's links; root is the least node that they reach."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while up[top] != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["node", "root"])


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) from materialized links (a, b): each node that has a link, and the least node it can reach.

    Each partition of links finds the roots of its own nodes. A node's label is the least of its
    roots; where partitions disagree, their roots are linked, and these fewer links are dealt with in
    the same way until there are none. A partition holds its own nodes only.
    """
    stars = materialize(links.select("a", "b").mapInArrow(_stars, "node long, root long"), "stars")
    least = materialize(stars.groupBy("node").agg(F.min("root").alias("least"), F.max("root").alias("most")), "least")
    split = least.filter("least < most")
    if split.isEmpty():
        return least.select("node", F.col("least").alias("component"))
    # Most nodes have one root; only those with several make links.
    between = materialize(stars.join(split.select("node", "least"), "node").filter("root <> least").select(F.col("root").alias("a"), F.col("least").alias("b")).distinct(), "contracted")
    above = connected_components(between).withColumnsRenamed({"node": "root", "component": "top"})
    # A root that no split node has is its component's label, unless its own label is less.
    return join_small(least, materialize(above, "above"), least["least"] == F.col("root")).select("node", F.coalesce("top", "least").alias("component"))
