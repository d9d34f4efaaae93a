"""Connected components of a link table by contraction, without collecting links or components anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import checkpointed, saved

#: Links (two longs each) that one task finishes at most; more are contracted by all tasks until so few are left.
LOCAL_LINKS = 500_000


def _ranked(node: str, turn: int) -> Column:
    """A node with its rank in this round's random order."""
    return F.struct(F.xxhash64(node, F.lit(turn)).alias("rank"), F.col(node).alias("node"))


def smallest_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node that each can reach: labels hook on to smaller ones and jump to their labels' labels."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (a, b):
            np.minimum.at(new, label[end], low)
            np.minimum.at(new, end, low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _finished(edges: DataFrame) -> DataFrame:
    """node, component of at most LOCAL_LINKS links, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if ends:
            found = smallest_labels(*(np.concatenate(x) for x in zip(*ends, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["node", "component"])

    return edges.select("a", "b").coalesce(1).mapInArrow(run, "node long, component long")


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node, itself included) for every end of links(a, b).

    Each round maps a node to the first one, in an order drawn anew, among its neighbours' neighbours, and contracts
    the links by that map; the image of a connected graph is connected. A star collapses in one round, a path to
    about a third of its nodes, so rounds grow with the logarithm of the nodes whatever the ids are. A hub's links
    meet in map-side minima and in joins that can be split. Null ends and self-links carry no information. Rounds end when
    LOCAL_LINKS links are left: one task, of bounded size, labels the rest.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    edges = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels, turn = None, 0
    while edges.count() > LOCAL_LINKS:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(_ranked("b", turn)).alias("m")).select("a", F.least("m", _ranked("a", turn)).alias("m"))
        far = both.join(near.select(F.col("a").alias("b"), "m"), "b").groupBy("a").agg(F.min("m").alias("m"))
        step = checkpointed(far.select("a", F.col("m.node").alias("root")))
        if labels is None:
            labels = step.select(F.col("a").alias("node"), "root")
        else:
            moved = step.select(F.col("a").alias("root"), F.col("root").alias("next"))
            labels = checkpointed(labels.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        x, y = step.select("a", F.col("root").alias("x")), step.select(F.col("a").alias("b"), F.col("root").alias("y"))
        contracted = edges.join(x, "a").join(y, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b")
        edges = checkpointed(contracted.distinct())
        turn += 1
    rest = _finished(edges)
    if labels is None:
        return saved(rest)
    ended = labels.join(rest.select(F.col("node").alias("root"), F.col("component").alias("last")), "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    smallest = ended.groupBy("root").agg(F.min("node").alias("component"))
    return checkpointed(ended.join(smallest, "root").select("node", "component"))
