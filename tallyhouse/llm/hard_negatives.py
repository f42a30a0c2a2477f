"""Hard negatives by bounds along spanning trees of the anchors.

Anchors are dealt into tiles of bounded size. In each tile a spanning tree joins them by
short edges: a least tree for each label, whose first anchors hang from the tile's first one.
For a row x with a known score at a parent anchor p, the score at its child c lies within

    score(p, x) - |c - p| |x|  and  score(p, x) + |c - p| |x|,

and a row with bounds at the parent has wider ones at the child. Only rows whose bounds
overlap the window that an anchor asks for are scored themselves, which makes their bounds
exact again for the anchors below. Rows are dealt into shards, and each (tile, shard) cell is
one such walk down the tree; the short lists of the cells are merged by row number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.top_k import best_rows, products, scaled, usable
from tallyhouse.session import write_through

# Sizes that bound the memory of a cell; both tables are copied about equally often with them.
TILE_ANCHORS = 8192
SHARD_ROWS = 8192
# Above this share of overlapping rows one product with the whole shard is cheaper.
_DENSE = 0.25
_EXACT = 1 << 53


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros to ``width``; empty for no rows."""
    out = np.zeros((len(column), width))
    if len(column):
        lists = column.combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def _width(table: pa.Table) -> int:
    return max(1, pa.compute.max(pa.compute.list_value_length(table.column("vector"))).as_py() or 1)


def spanning_tree(vectors: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): visiting order, each one's parent (-1: none) and its distance to it.

    Every label's vectors form a least spanning tree, grown from the first one by its
    nearest outsider; the first ones of the other labels hang from the first of all.
    """
    order, parent, edge = [], np.full(len(vectors), -1), np.zeros(len(vectors))
    for label in np.unique(labels):
        left = np.nonzero(labels == label)[0]
        node, left = left[0], left[1:]
        if order:
            parent[node], edge[node] = order[0], np.linalg.norm(vectors[node] - vectors[order[0]])
        order.append(node)
        nearest, near = np.full(len(left), node), np.full(len(left), np.inf)
        while len(left):
            away = np.linalg.norm(vectors[left] - vectors[node], axis=1)
            closer = away < near
            near[closer], nearest[closer] = away[closer], node
            pick = int(near.argmin())
            node = left[pick]
            parent[node], edge[node] = nearest[pick], near[pick]
            order.append(node)
            left, near, nearest = (np.delete(one, pick) for one in (left, near, nearest))
    return np.array(order, np.int64), parent, edge


def _tree_of(table: pa.Table) -> pa.Table:
    """The anchors of a tile in visiting order, with ``place``, ``parent`` (a place) and ``edge``."""
    table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")])
    vectors = _matrix(table.column("vector"), _width(table))
    order, parent, edge = spanning_tree(vectors, table.column("label").to_numpy())
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    above = np.where(parent[order] < 0, -1, place[parent[order]])
    table = table.take(pa.array(order))
    for name, values in (("place", np.arange(len(order))), ("parent", above)):
        table = table.append_column(name, pa.array(values, pa.int64()))
    return table.append_column("edge", pa.array(edge[order], pa.float64()))


class Bounds:
    """Scores of a shard's rows at one anchor: lower and upper bounds, equal where known."""

    def __init__(self, shard: Shard, anchor: np.ndarray, parent: Bounds | None, edge: float):
        self.shard, self.anchor = shard, anchor
        if parent is None:
            self.low = self.high = shard.matrix @ anchor
        else:
            # Scores are whole numbers; the slack outweighs the rounding of edge and norm.
            reach = edge * shard.norms * (1 + 1e-9) + 0.5
            self.low, self.high = parent.low - reach, parent.high + reach

    def settle(self, rows: np.ndarray) -> None:
        """Make the bounds of ``rows`` (a mask) exact."""
        rows = rows & (self.low < self.high)
        count = int(np.count_nonzero(rows))
        if count > _DENSE * len(rows):
            self.low = self.high = self.shard.matrix @ self.anchor
        elif count:
            scores = self.shard.matrix[rows] @ self.anchor
            self.low, self.high = self.low.copy(), self.high.copy()
            self.low[rows] = self.high[rows] = scores
        self.shard.scored += len(rows) if count > _DENSE * len(rows) else count


class Shard:
    """Rows of a shard; ``scored`` counts the products made below the trees' roots."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ids, self.labels, self.matrix = ids, labels, matrix
        self.norms = np.linalg.norm(matrix, axis=1)
        self.scored = 0


def walk(shard: Shard, anchors: np.ndarray, parents: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, Bounds]]:
    """(anchor, bounds) for every anchor, parents first; the visitor may settle rows.

    Parents stand before their children. The largest branch of an anchor is left for last, so
    that bounds are held for a logarithmic number of anchors only.
    """
    sizes = np.ones(len(parents), np.int64)
    children: list[list[int]] = [[] for _ in parents]
    for node in range(len(parents) - 1, -1, -1):
        if parents[node] >= 0:
            sizes[parents[node]] += sizes[node]
            children[parents[node]].append(node)
    pending = [(int(node), None) for node in np.nonzero(parents < 0)[0][::-1]]
    while pending:
        node, above = pending.pop()
        bounds = Bounds(shard, anchors[node], above, edges[node])
        above = None
        yield node, bounds
        pending += [(child, bounds) for child in sorted(children[node], key=lambda c: -sizes[c])]


def nearest_of_label(shard: Shard, own: int, bounds: Bounds, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best rows but ``own``: the window opens at the k-th best known."""
    mask = shard.ids != own
    if np.count_nonzero(mask) > k:
        seeds = np.zeros(len(mask), bool)
        hopes = np.where(mask, bounds.high, -np.inf)
        seeds[np.argpartition(-hopes, k - 1)[:k]] = True
        bounds.settle(seeds)
        mask = mask & (bounds.high >= bounds.low[seeds].min())
    bounds.settle(mask)
    rows = np.nonzero(mask)[0]
    return _best(shard.ids[rows], bounds.low[rows], k)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order].astype(np.int64)


def in_windows(
    shard: Shard, label: int, bounds: Bounds, positives: list[int], low: int, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the positive, ids, scores): the ``k`` best other-label rows of each window."""
    windows = [(-(-low * score // 100), score) for score in positives]
    other = shard.labels != label
    asked = np.zeros(len(other), bool)
    for least, most in windows:
        asked |= other & (bounds.high >= least) & (bounds.low <= most)
    bounds.settle(asked)
    rows = np.nonzero(asked)[0]
    ids, scores = shard.ids[rows], bounds.low[rows]
    for place, (least, most) in enumerate(windows):
        fits = (scores >= least) & (scores <= most)
        if fits.any():
            yield place, *_best(ids[fits], scores[fits], k)


def _parts(table: pa.Table) -> tuple[pa.Table, Shard, np.ndarray, bool]:
    """Anchors in visiting order, the shard, the anchors' matrix, and whether doubles are exact."""
    anchors = table.filter(table.column("is_anchor")).sort_by("place")
    rows = table.filter(pa.compute.invert(table.column("is_anchor"))).sort_by("vec_id")
    width = _width(table)
    shard = Shard(rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("vector"), width))
    vectors = _matrix(anchors.column("vector"), width)
    most = np.abs(vectors).max(initial=0) * np.abs(shard.matrix).max(initial=0) * width
    return anchors, shard, vectors, bool(most < _EXACT / 4)


def _concat(lists: list[list[np.ndarray]], schema: pa.Schema) -> pa.Table:
    if not lists:
        return schema.empty_table()
    return pa.table([np.concatenate([one[i] for one in lists]) for i in range(len(schema))], schema=schema)


def _positive_cell(k: int) -> Callable[[pa.Table], pa.Table]:
    schema = pa.schema([(name, pa.int64()) for name in ("anchor_id", "vec_id", "score")])

    def run(table: pa.Table) -> pa.Table:
        anchors, shard, vectors, exact = _parts(table)
        if not len(anchors) or not len(shard.ids):
            return schema.empty_table()
        owners, found = anchors.column("vec_id").to_numpy(), []
        if exact:
            # One label's anchors: the first one is their root here.
            start = anchors.column("place")[0].as_py()
            parents = np.maximum(anchors.column("parent").to_numpy() - start, -1)
            visits = walk(shard, vectors, parents, anchors.column("edge").to_numpy())
            lists = ((owners[node], *nearest_of_label(shard, owners[node], bounds, k)) for node, bounds in visits)
        else:
            lists = (_plain_positives(shard, own, vector, k) for own, vector in zip(owners, vectors))
        for own, ids, scores in lists:
            found.append([np.full(len(ids), own), ids, scores])
        return _concat(found, schema)

    return run


def _plain_positives(shard: Shard, own: int, vector: np.ndarray, k: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Without bounds, for components too large for exact doubles."""
    mask = shard.ids != own
    scores = products(vector[None], shard.matrix[mask])
    _, column = best_rows(scores, k)
    return own, shard.ids[mask][column], scores[0, column]


def _negative_cell(low: int, k: int) -> Callable[[pa.Table], pa.Table]:
    schema = pa.schema([(name, pa.int64()) for name in ("anchor_id", "place", "negative_id", "negative_score")])

    def run(table: pa.Table) -> pa.Table:
        anchors, shard, vectors, exact = _parts(table)
        if not len(anchors) or not len(shard.ids):
            return schema.empty_table()
        owners, labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
        wanted, found = anchors.column("positives").to_pylist(), []
        if exact:
            visits = walk(shard, vectors, anchors.column("parent").to_numpy(), anchors.column("edge").to_numpy())
        else:
            visits = ((node, _Known(products(vector[None], shard.matrix)[0])) for node, vector in enumerate(vectors))
        for node, bounds in visits:
            for place, ids, scores in in_windows(shard, labels[node], bounds, wanted[node] or [], low, k):
                found.append([np.full(len(ids), owners[node]), np.full(len(ids), place), ids, scores])
        return _concat(found, schema)

    return run


class _Known:
    """Bounds whose scores are all known."""

    def __init__(self, scores: np.ndarray):
        self.low = self.high = scores

    def settle(self, rows: np.ndarray) -> None:
        pass


def _merged(lists: DataFrame, group: list[str], vec_id: str, score: str, k: int) -> DataFrame:
    """The ``k`` best of each group's lists; the limit is applied in the tasks before the shuffle too."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), vec_id)
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    tile_anchors: int = TILE_ANCHORS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Vectors become integers floor(256 * x); a score is an inner product. Anchors are the rows
    whose id ``every`` divides. An anchor's positives are its best other rows of the same
    label, and each positive's negatives the best rows of other labels that score between
    ``low`` percent of the positive's score and that score; ties go to the smaller id.
    Rows without an id, a label or a vector, or with a null or non-finite component, take no
    part; missing components of shorter vectors count as 0. Rows that repeat an id are
    candidates each, but not for their own id's positives; as an anchor an id asks once, with its
    smallest vector. Anchors without a positive or a negative give no rows. Products beyond 64 bits stop at
    the nearest 64-bit value.
    """
    kind = F.col(label) if isinstance(label, str) else label
    good = vectors.where(usable(vector) & F.col(vec_id).isNotNull() & kind.isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), kind.cast("long").alias("label"), scaled(vector).alias("vector")
    )
    asks = good.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("one"))
    asks = asks.select("vec_id", "one.label", "one.vector")
    shards = max(1, -(-good.count() // shard_rows))
    tiles = max(1, -(-asks.count() // tile_anchors))
    tiled = asks.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)))
    kinds = "vec_id long, label long, vector array<double>, tile long"
    trees = write_through(
        tiled.groupBy("tile").applyInArrow(_tree_of, kinds + ", place long, parent long, edge double")
    )
    # Hashes spread repeated ids as well.
    shard = F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id() % 64), F.lit(shards))
    rows = good.withColumn("shard", shard).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("tile"),
        F.lit(False).alias("is_anchor"),
    )

    def cells(anchors: DataFrame) -> DataFrame:
        everywhere = anchors.select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
            F.lit(True).alias("is_anchor"),
        )
        return rows.unionByName(everywhere, allowMissingColumns=True)

    close = cells(trees).groupBy("label", "tile", "shard").applyInArrow(
        _positive_cell(positives), "anchor_id long, vec_id long, score long"
    )
    chosen = write_through(_merged(close, ["anchor_id"], "vec_id", "score", positives).select(
        "anchor_id", (F.col("rank") - 1).cast("long").alias("place"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    ))
    # At most ``positives`` scores of each anchor, best first.
    lists = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list("positive_score"), asc=False).alias("positives")
    )
    found = cells(trees.join(lists, "vec_id", "left")).groupBy("tile", "shard").applyInArrow(
        _negative_cell(low, negatives), "anchor_id long, place long, negative_id long, negative_score long"
    )
    best = _merged(found, ["anchor_id", "place"], "negative_id", "negative_score", negatives)
    return best.join(chosen, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def shifted_label(vec_id: str = "vec_id", label: str = "label") -> Column:
    """The label, moved on to the next of ten where 7 divides the id."""
    return F.when(F.col(vec_id) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
