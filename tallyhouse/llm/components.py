"""Connected components of a table of links, without gathering links anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import write_through

_LINKS_AT_A_TIME = 500_000


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every node that is not itself the smallest."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)].tolist(), places[len(a) :].tolist()
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(left, right):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(nodes))], np.int64)
    moved = roots != np.arange(len(nodes))
    return nodes[moved], nodes[roots[moved]]


def _folded(links: DataFrame) -> DataFrame:
    """Links (a, b) with b < a: every task merges its own into stars, piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_a, held_b, held = [], [], 0
        for batch in batches:
            held_a.append(batch.column(0).to_numpy())
            held_b.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held >= _LINKS_AT_A_TIME:
                node, root = union_find(np.concatenate(held_a), np.concatenate(held_b))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])
                held_a, held_b, held = [], [], 0
        if held:
            node, root = union_find(np.concatenate(held_a), np.concatenate(held_b))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def component_labels(links: DataFrame) -> DataFrame:
    """doc_id and the smallest id reachable, for every id of ``links`` (a, b) that is not it.

    Union-find inside each task folds its links into stars; between tasks, every node
    names its smallest neighbour and hands all others on to it (small star), then
    neighbours meet at the smallest one (large star), until nothing changes. Minima are
    combined in the tasks before the shuffle and the join back is an ordinary one, so a
    node of very many links is no single group. Each round's links are a written table.
    """
    stars = write_through(_folded(links.where("a <> b")))
    while True:
        # Large star: larger neighbours of a node move to its smallest neighbour.
        ways = stars.union(stars.select("b", "a"))
        low = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = ways.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # Small star: smaller neighbours of a node meet at the smallest of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))))
            .alias("link")
        ).select("link.*").where("a <> b").distinct()
        made = write_through(small)
        # Done when every node has one link and no target has a link itself.
        several = made.groupBy("a").count().where("count > 1").select("a")
        deeper = made.select(F.col("b").alias("a")).distinct().join(made.select("a").distinct(), "a", "left_semi")
        stars = made
        if several.union(deeper).isEmpty():
            return made.select(F.col("a").alias("doc_id"), F.col("b").alias("component"))
