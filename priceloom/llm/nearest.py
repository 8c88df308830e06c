"""Nearest vectors by inner product: a block matrix join in int8 with bounds.

Queries and candidates are dealt into blocks; every (query block, candidate
block) pair is one tile, a task's unit of work.  A tile multiplies int8
codes (exactly: the products fit a float's mantissa) and bounds the error of
each product.  Only pairs whose upper bound reaches the k-th best lower
bound are recomputed in double precision on the original vectors; a heap
keeps a query's best of the tile, and the tiles' bests are merged by rank.
Equal vectors of a block are multiplied once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096
_FOUND = "query_id bigint, vec_id bigint, score double"


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes (held as float32), scale and L1 norm of the codes, by row."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None])
    return q.astype(np.float32), scale, np.abs(q).sum(axis=1)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, summed in the
    order of the components, so that equal vectors give equal scores."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    t = t.combine_chunks()
    ids = t["vec_id"].to_numpy()
    flat = pa.concat_arrays(t["vector"].chunks).flatten().to_numpy() if t.num_rows else np.zeros(0)
    return ids, flat.reshape(len(ids), -1)


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, vector, score) of each query's k best in the block, own row left out."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    _, first, group = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(),
                                return_index=True, return_inverse=True)
    by_group = np.argsort(group, kind="stable")  # ids ascend within a group
    bounds = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(first)))])
    apart = vectors[first]
    qc, qs, q1 = _codes(queries)
    vc, vs, v1 = _codes(apart)
    dims = queries.shape[1]
    out = []
    for at in range(0, len(queries), 256):
        rows = slice(at, at + 256)
        scale = qs[rows, None] * vs[None, :]
        near = (qc[rows] @ vc.T).astype(np.float64) * scale
        err = scale * (0.5 * (q1[rows, None] + v1[None, :]) + dims / 4) * (1 + 1e-9)
        low = near - err
        if low.shape[1] > k + 1:  # one more than k: a query's own row doesn't count
            least = -np.partition(-low, k, axis=1)[:, k]
        else:
            least = np.full(len(low), -np.inf)
        q, v = np.nonzero(near + err >= least[:, None])
        score = inner(queries[rows][q], apart[v])
        cuts = np.searchsorted(q, np.arange(len(low) + 1))
        for i in range(len(low)):
            own = int(query_ids[at + i])
            heap = ((-float(score[j]), int(c)) for j in range(cuts[i], cuts[i + 1])
                    for c in ids[by_group[bounds[v[j]]:min(bounds[v[j]] + k + 1, bounds[v[j] + 1])]] if int(c) != own)
            out += [(own, c, -s) for s, c in heapq.nsmallest(k, heap)]
    return out


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vector of the rows that take part, once per id."""
    x = F.col("vector")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
    rows = rows.where(~F.exists(x, bad) & F.exists(x, lambda v: v != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nearest(table: DataFrame, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible
    by ``query_every``, its k nearest other vectors; ties to smaller ids.

    Rows with a null id, a null, zero or empty vector, or null or non-finite
    components take no part; of rows that repeat an id the smallest vector
    counts; vectors of another length than most (ties: the longer) take no
    part.  An empty table gives an empty result."""
    rows = usable(table, id_col, vector_col)
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.pmod("vec_id", F.lit(query_every)) == 0).alias("q")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dims, n, asked = sizes[0]["d"], sizes[0]["n"], sizes[0]["q"]
    qb, cb = max(1, -(-asked // query_block)), max(1, -(-n // candidate_block))
    rows = rows.where(F.size("vector") == dims)
    block = lambda many: F.pmod(F.xxhash64("vec_id"), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    asks = rows.where(F.pmod("vec_id", F.lit(query_every)) == 0).select(block(qb).alias("qb"), every(cb).alias("cb"), "vec_id", "vector")
    held = rows.select(every(qb).alias("qb"), block(cb).alias("cb"), "vec_id", "vector")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = tile(*_matrix(left), *_matrix(right), k)
        q, v, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    best = asks.groupBy("qb", "cb").cogroup(held.groupBy("qb", "cb")).applyInArrow(run, _FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
