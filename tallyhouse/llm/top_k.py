"""Exact top-k inner products: tiled matrix products and merged lists.

Vectors become integers floor(256 * x). Rows are dealt into shards and queries into
tiles, of bounded sizes; each (tile, shard) cell is one matrix product from which only
the k best per query go on, and those lists are merged shard group by shard group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import write_through

SHARD_ROWS = 8192
TILE_ROWS = 1024
# Lists merged at a time.
FAN = 16
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


def scaled(vector: str) -> Column:
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))


def usable(vector: str) -> Column:
    """Not null, and all components present and finite."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros to ``width``."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products; outside 64 bits they stop at the nearest 64-bit value."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if most < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    left, right = whole(queries).reshape(queries.shape), whole(rows).reshape(rows.shape)
    return np.clip(left.dot(right.T), -_LONG - 1, _LONG).astype(np.int64)


def best_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest of each row; ties go to the smaller column."""
    count = scores.shape[1]
    if count > k:
        limit = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        row, column = np.nonzero(scores >= limit)
    else:
        row, column = np.nonzero(np.ones_like(scores, bool))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _cell(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("shard", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        asks = table.filter(table.column("is_query"))
        rows = table.filter(pa.compute.invert(table.column("is_query")))
        if not asks.num_rows or not rows.num_rows:
            return schema.empty_table()
        width = max(1, pa.compute.max(pa.compute.list_value_length(table.column("vector"))).as_py())
        query_ids, vec_ids = asks.column("vec_id").to_numpy(), rows.column("vec_id").to_numpy()
        matrix, found = _matrix(rows.column("vector"), width), []
        all_queries = _matrix(asks.column("vector"), width)
        for start in range(0, len(query_ids), 128):  # bounds the product held at once
            scores = products(all_queries[start : start + 128], matrix)
            part = query_ids[start : start + 128]
            # One's own row leaves by falling behind k others.
            own = int((vec_ids[None, :] == part[:, None]).sum(axis=1).max())
            row, column = best_rows(scores, k + own)
            other = part[row] != vec_ids[column]
            row, column = row[other], column[other]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, column = row[place < k], column[place < k]
            found.append((part[row], vec_ids[column], scores[row, column]))
        ids, others, values = (np.concatenate([one[i] for one in found]) for i in range(3))
        shard = np.full(len(ids), table.column("shard")[0].as_py(), np.int64)
        return pa.table([ids, shard, others, values], schema=schema)

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id ``every`` divides.

    All rows are searched but those that carry the query's own id. Vectors that are null or
    hold nulls or non-finite components take no part, nor do rows without an id; missing
    components of shorter vectors count as 0. Rows that repeat an id are candidates
    each; as a query an id asks once, with its smallest vector. An empty table gives no rows.
    """
    good = vectors.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), scaled(vector).alias("vector")
    )
    asks = good.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    shards = max(1, -(-good.count() // SHARD_ROWS))
    tiles = max(1, -(-asks.count() // TILE_ROWS))
    # Hashes spread repeated ids as well.
    shard = F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id() % 64), F.lit(shards))
    rows = good.select(
        "vec_id", "vector", F.lit(False).alias("is_query"), shard.alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("tile"),
    )
    tile = F.pmod(F.xxhash64("vec_id"), F.lit(tiles))
    tiled = asks.select(
        "vec_id", "vector", F.lit(True).alias("is_query"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), tile.alias("tile"),
    )
    lists = rows.unionByName(tiled).groupBy("tile", "shard").applyInArrow(
        _cell(k), "query_id long, shard long, vec_id long, score long"
    )
    if shards > FAN:
        lists = write_through(lists)
    while True:
        shards = -(-shards // FAN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN))
        order = Window.partitionBy("query_id", "shard").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if shards <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
