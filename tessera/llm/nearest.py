"""Nearest neighbours by tiles of quantised products (operator 10).

Queries are taken in blocks of bounded size, each sent to every task. A task meets its candidates in
blocks too: both sides are quantised to int8, one matrix product gives all distances of the tile, and
the quantisation errors of both vectors bound how far a distance may be off. Only pairs whose lower
bound is within the k-th upper bound, or the k-th distance found so far, are computed again on the
original vectors in double precision and offered to the query's heap. No true neighbour is lost.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.batches import slices
from tessera.session import scratch_path

#: Queries sent to the tasks at a time, on average; with vectors of 1,024 doubles, 16 MB.
QUERY_BLOCK = 2048
#: Bytes of candidates in a tile.
TILE_BYTES = 1 << 20
#: Partial results of a query are merged in so many groups before the last merge.
MERGES = 64


def quantised(rows: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Int8 values, their scale, the squared lengths of what they stand for, and each row's error."""
    scale = float(np.abs(rows).max()) / 127 or 1.0
    small = np.rint(rows / scale).astype(np.int8)
    back = small.astype(np.float64) * scale
    return small, scale, np.einsum("ij,ij->i", back, back), np.sqrt(np.einsum("ij,ij->i", rows - back, rows - back))


def exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    gap = queries - rows
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


class Heaps:
    """The k nearest of each query so far, and the tiles that feed them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.small, self.scale, self.square, self.error = quantised(vectors)
        # Sums of products of int8 values are exact in float32 up to 2 ** 24.
        self.wide = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]

    def offer(self, ids: np.ndarray, rows: np.ndarray) -> None:
        small, scale, square, error = quantised(rows)
        product = self.small.astype(self.wide) @ small.astype(self.wide).T
        apart = self.square[:, None] + square[None, :] - 2 * self.scale * scale * product.astype(np.float64)
        apart = np.sqrt(np.maximum(apart, 0))
        slack = self.error[:, None] + error[None, :] + 1e-6 * (1 + np.sqrt(self.square)[:, None] + np.sqrt(square)[None, :])
        upper = apart + slack
        upper[self.ids[:, None] == ids[None, :]] = math.inf
        if len(ids) > self.k:
            limit = np.partition(upper, self.k - 1, axis=1)[:, self.k - 1]
        else:
            limit = np.full(len(self.ids), math.inf)
        held = np.array([-h[0][0] if len(h) == self.k else math.inf for h in self.heaps])
        limit = np.minimum(limit, held)
        q, c = np.nonzero((apart - slack <= limit[:, None]) & (upper < math.inf))
        for at, other, score in zip(q.tolist(), ids[c].tolist(), exact(self.vectors[q], rows[c]).tolist()):
            heap, entry = self.heaps[at], (-score, -other)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)

    def found(self) -> Iterator[tuple[int, int, float]]:
        for query, heap in zip(self.ids.tolist(), self.heaps):
            for score, other in heap:
                yield query, -other, -score


def by_width(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrices of the rows of each vector length."""
    widths = np.asarray(vectors.value_lengths())
    flat, starts = np.asarray(vectors.flatten(), dtype=np.float64), np.concatenate(([0], np.cumsum(widths)[:-1]))
    keys = np.asarray(ids)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        yield keys[at], flat[starts[at][:, None] + np.arange(width)]


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part."""
    return (
        table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .where(F.col("id").isNotNull() & (F.size("vector") > 0))
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)))
        .where(F.exists("vector", lambda x: x != 0))
    )


def nearest(table: DataFrame, every: int, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row whose id is divisible by ``every``.

    Nearness is the Euclidean distance in double precision, ties go to the smaller id; rows of the
    query's id are no candidates, and only vectors of the query's length are. Rows with a null id and
    vectors that are null, empty, zero or hold null or non-finite components take no part. Of
    repeated rows of a query id the smallest vector asks; repeated candidates are all candidates.
    An empty table gives an empty result. Other columns are not read.
    """
    spark = table.sparkSession
    rows = usable(table, key, vector)
    asking = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = -(-asking.count() // QUERY_BLOCK)
    schema = "query_id long, vec_id long, score double"
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    path = scratch_path(spark, "nearest")
    for block in range(blocks):
        mine = asking.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        held = [
            (ids, matrix)
            for part in mine.combine_chunks().to_batches()
            for ids, matrix in by_width(part.column(0), part.column(1))
        ]
        sent = spark.sparkContext.broadcast(held)

        def tiles(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            heaps = {matrix.shape[1]: Heaps(ids, matrix, k) for ids, matrix in sent.value}
            for part in slices(batches, TILE_BYTES):
                for ids, matrix in by_width(part.column(0), part.column(1)):
                    if matrix.shape[1] in heaps:
                        heaps[matrix.shape[1]].offer(ids, matrix)
            found = [row for h in heaps.values() for row in h.found()]
            columns = list(zip(*found)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"]
            )

        near = rows.mapInArrow(tiles, schema).withColumn("part", F.spark_partition_id() % MERGES)
        for group in (["query_id", "part"], ["query_id"]):
            order = Window.partitionBy(*group).orderBy("score", "vec_id")
            near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        near.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        sent.unpersist()
    return spark.read.schema("query_id long, rank int, vec_id long, score double").parquet(path)


SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""
