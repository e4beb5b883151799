"""Connected components of edges between longs, on a task's arrays and on a table."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.session import stage

#: Places that the edges of one node are dealt to when they are joined.
SPREAD = 8


def array_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges, and the least node that each reaches."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        while not np.array_equal(hop := new[new], new):  # follow labels to their ends
            new = hop
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _starred(edges: DataFrame, up: bool) -> DataFrame:
    """Each node's neighbours are hung on the least of them: those above it (`up`), or itself and those below it."""
    if up:
        arcs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arcs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = arcs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    # A hub may hold a large part of all edges: its edges are dealt to SPREAD places, and so is its one row.
    salted = arcs.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(SPREAD)).cast("int"))
    copies = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    hung = salted.join(copies, ["a", "s"])
    if up:
        return hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    own = least.select("a", F.col("m").alias("b"))
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).filter("a != b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, root (the least node that it reaches), for every node of an edge (a, b).

    Large-star and small-star steps in turn until nothing changes; no neighbour list is ever gathered, and the table
    is written between rounds.
    """
    now = stage(edges.select("a", "b").filter("a != b").distinct(), name)
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        now = stage(_starred(_starred(now, True), False), name)
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
