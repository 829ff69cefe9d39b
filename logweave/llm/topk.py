"""Exact top-k search by inner product: Fagin's threshold algorithm.

Components become whole numbers, floor(scale * x). Candidates are dealt into
blocks by a hash of their id, queries into blocks too, and each pair of blocks
is a task. In a task every dimension's list is sorted once. For a query the
lists are read from their good ends, a few entries of each at a time; every new
candidate is scored in full. The bound is the score of a candidate that has, in
every dimension, the value the list has come to. The task stops on a query as
soon as the bound cannot beat (nor tie with) its kth score. The best of all
blocks are the result.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows without id. Vectors are compared with those
of their own length only. Ties go to the smaller vec_id. A query never finds its
own row; every other row is a candidate, repeated ones and those of the same id
too, and a repeated query is answered for each of its rows. With fewer than k
candidates all are returned. Components so large that a score might not fit a
long are an error. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.storage import staged

SCALE = 256
#: Rows of a block of candidates and of queries, and the bytes that either may have: as every candidate is
#: copied for each block of queries, these are large, and a block of long vectors has fewer rows.
CANDIDATES, QUERIES, BLOCK_BYTES = 4096, 16384, 32 << 20
#: List entries read of each dimension in the first step; the next steps double it.
STEP = 8


def best_of(lists: np.ndarray, values: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of one query's best in a block, by the threshold algorithm; ``own`` is its own place there, or -1.

    ``lists[r, d]`` is the row of the r-th smallest value ``values[r, d]`` of dimension d.
    """
    n = len(ids)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    seen = np.zeros(n, bool)
    kept, scores = np.zeros(0, np.int64), np.zeros(0, query.dtype)
    depth, step = 0, STEP
    while depth < n:
        stop = min(n, depth + step)
        fresh = np.zeros(n, bool)
        fresh[lists[n - stop:n - depth, up]] = True
        fresh[lists[depth:stop, down]] = True
        if stop == n:
            fresh[:] = True
        fresh &= ~seen
        seen |= fresh
        rows = np.flatnonzero(fresh)
        rows = rows[rows != own]
        kept, scores = np.concatenate([kept, rows]), np.concatenate([scores, vectors[rows] @ query])
        best = np.lexsort((ids[kept], -scores))[:k]
        kept, scores = kept[best], scores[best]
        bound = values[n - stop, up] @ query[up] + values[stop - 1, down] @ query[down]
        if len(kept) == k and scores[-1] > bound:
            break
        depth, step = stop, step * 2
    return ids[kept], scores


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best among all other rows of ``vectors`` (vec_id, embedding)."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~bad)
    rows = rows.select("vec_id", F.transform("embedding", lambda v: F.floor(v.cast("double") * scale)).alias("v"), is_query.alias("query"))
    table = staged(rows.withColumn("dims", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    n, q, dims = table.agg(F.count("*"), F.count_if("query"), F.coalesce(F.max("dims"), F.lit(1))).first()
    fit = max(1, BLOCK_BYTES // (8 * dims))
    blocks, query_blocks = max(1, math.ceil(n / min(CANDIDATES, fit))), max(1, math.ceil(q / min(QUERIES, fit)))

    def dealt(df: DataFrame, own: int, others: int, name: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64("row"), F.lit(own).cast("long")).alias(name)
        every = F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))
        return df.select("vec_id", "row", "v", "dims", "query", place, F.explode(every).alias(other))

    candidates = dealt(table.withColumn("query", F.lit(False)), blocks, query_blocks, "block", "queries")
    asked = dealt(table.where("query"), query_blocks, blocks, "queries", "block")

    def searched(group: pa.Table) -> pa.Table:
        dims = group.column("dims")[0].as_py()
        ask = group.column("query").to_numpy()
        matrix, ids, number = _matrix(group.column("v"), dims), group.column("vec_id").to_numpy(), group.column("row").to_numpy()
        # doubles hold sums below 2^53 exactly, and multiply faster
        largest = max(1, -int(matrix.min(initial=0)), int(matrix.max(initial=0)))
        if largest * largest * dims >= 1 << 63:
            raise ValueError(f"{dims} components of up to {largest} may give scores beyond a long")
        if largest * largest * dims < 1 << 53:
            matrix = matrix.astype(np.float64)
        base, base_ids, base_rows = matrix[~ask], ids[~ask], number[~ask]
        by_row = base_rows.argsort()
        lists = base.argsort(axis=0, kind="stable")
        values = np.take_along_axis(base, lists, 0)
        out_query, out_row, out_id, out_score = [], [], [], []
        for own, row, query in zip(ids[ask].tolist(), number[ask].tolist(), matrix[ask], strict=True):
            at = np.searchsorted(base_rows, row, sorter=by_row)
            here = int(by_row[at]) if at < len(by_row) and base_rows[by_row[at]] == row else -1
            got, scores = best_of(lists, values, base, base_ids, query, here, k)
            out_query += [own] * len(got)
            out_row += [row] * len(got)
            out_id.append(got)
            out_score.append(scores.astype(np.int64))
        return pa.table({"query_id": pa.array(out_query, pa.int64()), "row": pa.array(out_row, pa.int64()), "vec_id": pa.array(np.concatenate([np.zeros(0, np.int64), *out_id])),
                         "score": pa.array(np.concatenate([np.zeros(0, np.int64), *out_score]))})

    found = candidates.unionByName(asked).groupBy("dims", "block", "queries").applyInArrow(searched, "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH whole AS (SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.row <> q.row AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
