"""Nearest neighbours by blocks: int8 product tiles bound the distances, survivors are measured exactly.

Queries go out in blocks of bounded size; each task runs a block against its share of all vectors. Vectors are rounded
to int8 with a scale of their own; the product of two rounded blocks is exact in float32, and with the norms of
the rounding errors it gives a lower and an upper bound for every distance. A vector whose lower bound is above the k-th
smallest upper bound, or above a query's k-th best so far, can't be among the nearest. The others are measured in double
precision, component after component, and kept in heaps, which meet per query at the end.

Vectors that are null, empty, zero or hold null or non-finite components take no part; a query is compared with vectors
of its own length. Every row is a candidate, so repeated rows stand in results as often; rows with the query's own id never
do, and of several query rows with one id the smallest vector asks. A null id asks nothing and answers as the
largest id. Equal distances go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.session import stage

QUERY_BLOCK, TILE_ROWS = 4096, 4096
#: Products of int8 components sum exactly in float32 up to this many of them.
_EXACT_TERMS = 1 << 10
_NO_ID = (1 << 63) - 1


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector``: vectors that may take part, as doubles."""
    vector = F.col("embedding").cast("array<double>")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return plain.filter(finite & F.exists("vector", lambda x: x != 0))


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the norms of the rounded vectors and of the rounding errors."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    small = np.rint(x / scale[:, None])
    back = small * scale[:, None]
    return small.astype(np.int8), scale, np.sqrt((back**2).sum(axis=1)), np.sqrt(((x - back) ** 2).sum(axis=1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for low in range(0, a.shape[1], _EXACT_TERMS):
        part = slice(low, low + _EXACT_TERMS)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def exact_distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, squares added in component order."""
    total = np.zeros(len(vectors))
    for d in range(len(query)):
        gap = vectors[:, d] - query[d]
        total += gap * gap
    return np.sqrt(total)


class Heaps:
    """The k nearest so far of each query of a block; the worst stands at a heap's top."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.small, self.scale, self.norm, self.error = _rounded(vectors)
        self.heaps: list[list] = [[] for _ in ids]
        self.worst = np.full(len(ids), np.inf)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        small, scale, norm, error = _rounded(vectors)
        cross = _products(self.small, small) * (self.scale[:, None] * scale[None, :])
        near = np.sqrt(np.maximum(self.norm[:, None] ** 2 + norm[None, :] ** 2 - 2 * cross, 0))
        # the norms above are rounded in double precision; this is far more than that costs
        slack = self.error[:, None] + error[None, :] + 1e-7 * (self.norm[:, None] + norm[None, :])
        upper, lower = near + slack, near - slack
        own = self.ids[:, None] == ids[None, :]
        upper[own] = np.inf
        bound = self.worst
        if len(ids) > self.k:
            bound = np.minimum(bound, np.partition(upper, self.k - 1, axis=1)[:, self.k - 1])
        for q, c in _by_query((lower <= bound[:, None]) & ~own):
            distances = exact_distances(self.vectors[q], vectors[c])
            if len(c) > self.k:
                keep = np.lexsort((ids[c], distances))[: self.k]
                c, distances = c[keep], distances[keep]
            heap = self.heaps[q]
            for d, i in zip(distances.tolist(), ids[c].tolist()):
                entry = (-d, -i)
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.worst[q] = -heap[0][0]

    def rows(self) -> pd.DataFrame:
        out = [(q, -i, -d) for q, heap in zip(self.ids.tolist(), self.heaps) for d, i in heap]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _by_query(mask: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for q in np.flatnonzero(mask.any(axis=1)):
        yield int(q), np.flatnonzero(mask[q])


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, one pair for each vector length."""
    column = batch.column("vector")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    ids = batch.column("vec_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        yield ids[rows], flat[starts[rows, None] + np.arange(width)]


def nearest(vectors: DataFrame, asks: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest of every row for which ``asks`` (on ``vec_id``) is true."""
    candidates = usable(vectors)
    queries = stage(
        candidates.filter(asks).filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries"
    )
    widths = queries.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).collect()
    schema = "query_id long, vec_id long, score double"
    found = vectors.sparkSession.createDataFrame([], schema)
    for width, n in sorted((row["width"], row["n"]) for row in widths):
        # as many hash blocks that none is much larger than QUERY_BLOCK
        blocks = math.ceil(n / QUERY_BLOCK * 1.2)
        for block in range(blocks):
            mine = queries.filter((F.size("vector") == width) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block))
            found = found.union(_search_block(candidates.filter(F.size("vector") == width), mine.toPandas(), k, schema))

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(k, zip(group["score"], group["vec_id"]))
        return pd.DataFrame(
            {
                "query_id": [group["query_id"].iloc[0]] * len(best),
                "rank": range(1, len(best) + 1),
                "vec_id": [i for _, i in best],
                "score": [d for d, _ in best],
            }
        )

    merged = found.groupBy("query_id").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")
    return merged.withColumn("vec_id", F.when(F.col("vec_id") != _NO_ID, F.col("vec_id")))


def _search_block(candidates: DataFrame, queries: pd.DataFrame, k: int, schema: str) -> DataFrame:
    shared = candidates.sparkSession.sparkContext.broadcast(
        (queries["vec_id"].to_numpy(), np.stack(queries["vector"].to_list()) if len(queries) else None)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        if matrix is None:
            return
        heaps = [Heaps(ids[i : i + 512], matrix[i : i + 512], k) for i in range(0, len(ids), 512)]
        for batch in batches:
            for low in range(0, batch.num_rows, TILE_ROWS):
                for found, vectors in _matrices(batch.slice(low, TILE_ROWS)):
                    for heap in heaps:
                        heap.offer(found, vectors)
        for heap in heaps:
            yield pa.RecordBatch.from_pandas(heap.rows().astype({"query_id": "int64", "vec_id": "int64", "score": "float64"}), preserve_index=False)

    return candidates.mapInArrow(search, schema)
