"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors are dealt into blocks of bounded size by a hash of their ID, queries into
chunks. Every block meets every chunk in a task, which holds the block's rows sorted
by each dimension. A query reads its lists from the end that its sign prefers, in
growing steps, scores what it has not seen yet, and stops when the sum of the values
at which the lists stand, an upper bound for all unseen rows, cannot beat its k-th
score. Each block gives its best k, so the best k of all blocks are exact.

Queries are a stated share of the rows, so their number and the work grow with the
table; both sides of a task are bounded by parameters.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block, and queries of a chunk, about.
BLOCK_ROWS = 8192
CHUNK_ROWS = 4096
#: First step down the lists; steps double.
STEP = 16


def quantised(vector: Column, scale: int) -> Column:
    """Components as floor(scale * x), x as double; null if one is null or not finite."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    floored = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), floored)


class Block:
    """Rows of a block with their lists, sorted by each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        # Smaller IDs first, and of rows with one ID the smallest vector only.
        keys = [rows[:, j] for j in range(rows.shape[1] - 1, -1, -1)]
        order = np.lexsort([*keys, ids])
        ids, rows = ids[order], rows[order]
        first = np.concatenate([[True], ids[1:] != ids[:-1]])
        self.ids, self.rows = ids[first], rows[first]
        self.n, self.d = self.rows.shape
        self.lists = np.argsort(self.rows, axis=0, kind="stable").T  # ascending
        self.sorted = np.take_along_axis(self.rows, self.lists.T, axis=0).T
        self.floats = self.rows.astype(np.float64)
        self.largest = int(np.abs(self.rows).max()) if self.rows.size else 0

    def scores(self, places: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products, in floating point where that is exact."""
        if self.largest * int(np.abs(query).max(initial=0)) * max(self.d, 1) < 2**53:
            return (self.floats[places] @ query.astype(np.float64)).astype(np.int64)
        return self.rows[places] @ query

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best k rows, ties by ID, the query's own left out."""
        seen = self.ids == query_id
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        best = np.empty(0, dtype=np.int64)
        scores = np.empty(0, dtype=np.int64)
        depth, step = 0, STEP
        while depth < self.n:
            end = min(self.n, depth + step)
            found = np.zeros(self.n, dtype=bool)
            found[self.lists[up, depth:end].ravel()] = True
            found[self.lists[down, self.n - end : self.n - depth].ravel()] = True
            if not len(up) and not len(down):
                found[:] = True  # a query of zeros scores 0 with every row
                end = self.n
            new = np.flatnonzero(found & ~seen)
            seen[new] = True
            best = np.concatenate([best, new])
            scores = np.concatenate([scores, self.scores(new, query)])
            keep = np.lexsort([self.ids[best], -scores])[:k]
            best, scores = best[keep], scores[keep]
            bound = int(self.sorted[up, end - 1] @ query[up]) + int(
                self.sorted[down, self.n - end] @ query[down]
            )
            if len(best) == k and bound < scores[-1]:
                break
            depth, step = end, 2 * step
        return best, scores


def matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), dtype=np.int64).reshape(len(values), -1)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The k rows of highest score for each query: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``; rows that ``is_query`` holds for are
    queries. Components become integers, and a score is their exact inner product (64
    bits; no overflow as long as it is below 2**63). Rows with a null ID or vector, or
    a component that is null or not finite, take no part. Scores exist between vectors
    of one length only. Equal scores go to the smaller ID. Rows of one ID count once,
    by the smallest vector. Fewer than k candidates give as many rows; a table without
    queries or candidates gives none.
    """
    rows = vectors.where("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        quantised(F.col("embedding"), scale).alias("v"),
        is_query.alias("is_query"),
    ).where("v IS NOT NULL")
    rows = rows.withColumn("d", F.size("v"))
    queries = rows.where("is_query").groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = queries.withColumn("d", F.size("v"))
    n, n_queries = rows.agg(F.count("*"), F.count_if("is_query")).first()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-n_queries // chunk_rows))

    def dealt(name: str, number: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int").alias(name)

    def every(name: str, number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias(name)

    left = rows.select("d", "vec_id", "v", dealt("block", blocks), every("chunk", chunks))
    right = queries.select("d", "vec_id", "v", dealt("chunk", chunks), every("block", blocks))

    def meet(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(block) and len(asked):
            index = Block(block["vec_id"].to_numpy(np.int64), matrix(block["v"]))
            for query_id, query in zip(asked["vec_id"], matrix(asked["v"]), strict=True):
                best, scores = index.search(query_id, query, k)
                found.append(
                    pd.DataFrame(
                        {"query_id": query_id, "vec_id": index.ids[best], "score": scores}
                    )
                )
        if not found:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        return pd.concat(found)

    keys = ("d", "block", "chunk")
    partial = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(meet, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = """WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
    AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""
