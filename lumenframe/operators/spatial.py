"""Spatial connected components, and the peaks that channels agree on."""

from __future__ import annotations

from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import join_salted, written


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of links (a, b): the least node that each can reach, by rounds of contraction.

    In a round every node takes the least of its neighbours and itself as its label; links between
    labels are what is left to contract, and links inside a label are gone. Written each round, so
    a plan never grows. Labels are joined with salts, as one node may have very many links.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    labels = written(edges.select("a").union(edges.select("b")).toDF("node").distinct().withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        least = written(both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("up")), "parents")
        # A node's label may have taken a label itself: follow it once more.
        step = least.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jump = written(join_salted(least, step, ["up"]).select("node", F.coalesce("top", "up").alias("to")), "jumps")
        labels = written(join_salted(labels, jump.withColumnRenamed("node", "component"), ["component"]).select("node", F.coalesce("to", "component").alias("component")), "labels")
        moved = edges
        for end in ("a", "b"):
            moved = join_salted(moved, jump.withColumnRenamed("node", end), [end]).withColumn(end, F.coalesce("to", end)).drop("to")
        edges = written(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    return labels


#: Cells on a side of a tile, whose links are contracted in one task.
TILE = 64


def near_cells(points: DataFrame, radius: float) -> tuple[DataFrame, DataFrame]:
    """Cells (field_i, cy, cx, head) of points (field_i, point_i, y, x), and links (field_i, cy, cx, a, b) of the heads of cells that hold points within the radius.

    Cells have a diagonal of one radius, so all points of a cell belong together and its least one, the head,
    stands for them. Points in one place are one. Places of neighbouring cells are compared by an
    equi-join on the cell; of two cells one link is kept. So what is left to connect has a row a cell, not a row a point.
    """
    side = radius / sqrt(2)
    cell = [F.floor(F.col("y") / side).alias("cy"), F.floor(F.col("x") / side).alias("cx")]
    places = written(points.groupBy("field_i", "y", "x").agg(F.min("point_i").alias("point_i")).select("*", *cell), "places")
    cells = written(places.groupBy("field_i", "cy", "cx").agg(F.min("point_i").alias("head")), "cells")
    # Half of the cells that a radius reaches: the others come from the other side.
    ways = [(dy, dx) for dy in range(-2, 3) for dx in range(-2, 3) if (dy, dx) > (0, 0) and (abs(dy), abs(dx)) != (2, 2)]
    sent = places.withColumn("way", F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ways))))
    sent = sent.select("field_i", F.col("y").alias("ay"), F.col("x").alias("ax"), F.col("cy").alias("from_cy"), F.col("cx").alias("from_cx"), (F.col("cy") + F.col("way.dy")).alias("cy"), (F.col("cx") + F.col("way.dx")).alias("cx"))
    apart = (F.col("ay") - F.col("y")) * (F.col("ay") - F.col("y")) + (F.col("ax") - F.col("x")) * (F.col("ax") - F.col("x"))
    met = sent.join(places, ["field_i", "cy", "cx"]).filter(apart <= radius * radius).select("field_i", "cy", "cx", "from_cy", "from_cx").distinct()
    to = met.join(cells.withColumnRenamed("head", "b"), ["field_i", "cy", "cx"])
    back = cells.select("field_i", F.col("cy").alias("from_cy"), F.col("cx").alias("from_cx"), F.col("head").alias("a"))
    return cells, to.join(back, ["field_i", "from_cy", "from_cx"]).select("field_i", "cy", "cx", "a", "b")


def contracted(links: pa.Table) -> pa.Table:
    """(node, root): the least node that each node of links (a, b) reaches through them."""
    nodes, at = np.unique(np.concatenate([links.column("a").to_numpy(), links.column("b").to_numpy()]), return_inverse=True)
    a, b = at[: links.num_rows], at[links.num_rows :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (root[a], root[b], a, b):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == root).all():
            return pa.table({"node": nodes, "root": nodes[root]})
        root = new


def connected_cells(cells: DataFrame, links: DataFrame) -> DataFrame:
    """(field_i, cy, cx, component): cells with the least head that theirs is connected with.

    Links are contracted in tiles of TILE cells a side first, so a task holds a tile at most; what goes
    on is links between the roots of tiles, which only the links across their edges and the nodes that two tiles share make.
    """
    tile = [F.floor(F.col("cy") / TILE).alias("ty"), F.floor(F.col("cx") / TILE).alias("tx")]
    roots = written(links.select("field_i", *tile, F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).groupBy("field_i", "ty", "tx").applyInArrow(contracted, "node long, root long"), "tile-roots")
    # A node that lies in several tiles links their roots.
    least = written(roots.groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("most")), "node-roots")
    across = roots.join(least.filter("root <> most").select("node", F.col("root").alias("a")), "node").select("a", F.col("root").alias("b"))
    found = connected(across)
    named = join_salted(least.select("node", "root"), found.withColumnRenamed("node", "root"), ["root"])
    return cells.join(named.select(F.col("node").alias("head"), F.coalesce("component", "root").alias("_to")), "head", "left").select("field_i", "cy", "cx", F.coalesce("_to", "head").alias("component"))


def reconciled(peaks: DataFrame, radius: float) -> DataFrame:
    """(field_i, peak_i, y, x, n_channels, ambiguous) of peaks (field_i, channel_i, point_i, y, x) that lie together.

    Peaks of all channels within a radius are one patch, peak_i its least point. A patch with two peaks
    of one channel is ambiguous: which of them belongs to the others can't be told. y and x are means over its peaks.
    """
    rows = written(peaks.select("field_i", "channel_i", "point_i", "y", "x"), "peaks")
    side = radius / sqrt(2)
    # Sums by cell and channel first: a patch of very many peaks is no large group.
    by = rows.groupBy("field_i", F.floor(F.col("y") / side).alias("cy"), F.floor(F.col("x") / side).alias("cx"), "channel_i").agg(F.count("*").alias("n"), F.sum("y").alias("y"), F.sum("x").alias("x"))
    whole = rows.filter("field_i is not null and y is not null and x is not null")
    named = by.join(connected_cells(*near_cells(whole, radius)), ["field_i", "cy", "cx"]).drop("cy", "cx").withColumnRenamed("component", "peak_i")
    # A peak without a place lies near no other.
    lone = rows.filter("field_i is null or y is null or x is null").select("field_i", "channel_i", F.lit(1).cast("long").alias("n"), "y", "x", F.col("point_i").alias("peak_i"))
    named = named.unionByName(lone)
    by_channel = named.groupBy("field_i", "peak_i", "channel_i").agg(F.sum("n").alias("n"), F.sum("y").alias("y"), F.sum("x").alias("x"))
    return by_channel.groupBy("field_i", "peak_i").agg((F.sum("y") / F.sum("n")).alias("y"), (F.sum("x") / F.sum("n")).alias("x"), F.count("*").alias("n_channels"), (F.max("n") > 1).alias("ambiguous"))
