"""Connected components of a distributed edge list, by contraction inside tasks.

Every task contracts the edges it holds to one pointer per node, towards the smallest node it can
reach there. Pointers are then dealt out by the node that points, so that all pointers of a node
meet and contract again, until each node has a single one. What remains is a forest; its pointers
are followed by doubling. A task holds its share of the pointers only. A node that very many
point to is never a key of the contraction, and where pointers are followed, it is one node among those that are
pointed to; what points to it is joined by a join that splits hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.keyed_join import attach
from .common import staged

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("met", pa.bool_())])


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) of every node of the edges."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        for ends in (x, y):
            np.minimum.at(new, label[ends], least)
            np.minimum.at(new, ends, least)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def pointers(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers of the nodes that reach a smaller one."""
    nodes, least = contracted(a, b)
    moved = nodes != least
    return nodes[moved], least[moved]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pointers of a task's edges; ``met`` where a node came with several, so that they must meet again."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    a, b = (np.concatenate(x) for x in zip(*held))
    edges = np.unique(np.stack([a, b], 1), axis=0)
    several = len(np.unique(edges[:, 0])) < len(edges)
    nodes, least = pointers(edges[:, 0], edges[:, 1])
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least), pa.array(np.full(len(nodes), several))], schema=_EDGE)


def labels(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (two bigint columns): the smallest node it can reach.

    Edges from a node to itself say nothing. An empty list gives an empty result.
    """
    ddl = "a bigint, b bigint, met boolean"
    state = edges.toDF("a", "b").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = staged(state.mapInArrow(_contract, ddl), "pointers")
    while True:
        state = staged(state.select("a", "b").repartition("a").mapInArrow(_contract, ddl), "pointers")
        if state.filter("met").isEmpty():
            break
    forest = state.select("a", "b")
    while True:
        # nodes that are pointed to and point on themselves, once each: a root that very many point to is not among them
        ahead = forest.select(F.col("a").alias("_at"), F.col("b").alias("_next"))
        onward = forest.select("b").distinct().join(ahead, F.col("b") == F.col("_at")).select("b", "_next")
        onward = staged(onward, "pointers")
        if onward.isEmpty():
            break
        moved = attach(forest, onward, ["b"])
        forest = staged(moved.select("a", F.coalesce("_next", "b").alias("b")), "pointers")
    roots = forest.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return forest.toDF("node", "label").union(roots)
