"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation over integer vectors.

Queries and candidates are cut into blocks; each pair of blocks is a group of its own, so that no task or driver holds
either side whole. In a group the components are the terms: for each term, the queries with a weight scatter weight
times posting into a dense array of scores. A partition then selects the group's best for each query, and the few
best of all groups are merged by a ranked window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES, QUERIES, ROWS = 1024, 2048, 64


def quantised(col: str = "embedding") -> Column:
    return F.transform(F.col(col), lambda x: F.floor(x.cast("double") * 256).cast("long"))


def sound(col: str = "embedding") -> Column:
    """Neither null nor with a component that is null or not finite."""
    return F.col(col).isNotNull() & F.forall(F.col(col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    arrays = column.combine_chunks()
    if isinstance(arrays, pa.ChunkedArray):
        arrays = pa.concat_arrays(arrays.chunks)
    lens = np.diff(arrays.offsets.to_numpy())
    out = np.zeros((len(lens), width), np.int64)
    if lens.size and lens.min() == width:
        return arrays.flatten().to_numpy().reshape(-1, width)
    for i, v in enumerate(arrays.to_pylist()):
        out[i, : len(v)] = v
    return out


def accumulate(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Scores [queries, candidates]: term by term, weights of the queries that have the term times its postings."""
    acc = np.zeros((len(q), len(x)), np.int64)
    postings = np.ascontiguousarray(x.T)
    for term in range(q.shape[1]):
        rows = np.flatnonzero(q[:, term])
        if len(rows) == len(q):
            acc += np.multiply.outer(q[:, term], postings[term])
        elif len(rows):
            acc[rows] += np.multiply.outer(q[rows, term], postings[term])
    return acc


def select_best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row that is a query.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no part. Components that
    one vector lacks count as zero. Rows are told apart, not ids: a repeated row is a candidate of its own, also for
    its equal, and a query row that occurs twice has its k results twice. Ties go to the smaller id. Other columns play
    no part. Raises OverflowError where a score could leave 64 bits.
    """
    rows = vectors.filter(sound() & F.col("vec_id").isNotNull()).select("vec_id", quantised().alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x).cast("double")))
    n, nq, top, longest = rows.agg(F.count(F.lit(1)), F.count_if(F.col("q")), F.max(largest), F.max(F.size("v"))).first()
    if top and longest * top * top >= 2.0**63:
        raise OverflowError("inner products could exceed 64 bits")
    nc, nb = -(-n // CANDIDATES) or 1, -(-nq // QUERIES) or 1
    # equal rows are one with a count, so that a row's own copy can be left out by number
    rows = rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times"), F.count_if("q").alias("asked"))
    block = lambda c, at, m: F.pmod(F.xxhash64("vec_id", "v", F.lit(at)), F.lit(m)).alias(c)
    every = lambda c, m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(c)
    own = F.xxhash64("vec_id", "v").alias("own")
    candidates = rows.select("vec_id", "v", "times", own, block("c", 1, nc), every("b", nb))
    queries = rows.filter("asked > 0").select("vec_id", "v", "asked", own, block("b", 2, nb), every("c", nc))

    def search(q: pa.Table, x: pa.Table) -> pa.Table:
        out = {"query_id": [], "own": [], "asked": [], "vec_id": [], "score": [], "times": []}
        if q.num_rows and x.num_rows:
            width = max((len(v) for t in (q, x) for v in t.column("v")), default=0)
            qv, xv = _matrix(q.column("v"), width), _matrix(x.column("v"), width)
            qi, qo, asked = (q.column(c).to_numpy() for c in ("vec_id", "own", "asked"))
            xi, xo, times = (x.column(c).to_numpy() for c in ("vec_id", "own", "times"))
            for lo in range(0, len(qv), ROWS):
                for i, scores in enumerate(accumulate(qv[lo : lo + ROWS], xv), lo):
                    same = (xo == qo[i]) & (xi == qi[i])
                    left = times - same
                    at = np.flatnonzero(left > 0)
                    best = at[select_best(scores[at], xi[at], k)]
                    out["query_id"].append(np.full(len(best), qi[i]))
                    out["own"].append(np.full(len(best), qo[i]))
                    out["asked"].append(np.full(len(best), asked[i]))
                    out["vec_id"].append(xi[best])
                    out["score"].append(scores[best])
                    out["times"].append(np.minimum(left[best], k))
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in out.items()})

    kind = "query_id long, own long, asked long, vec_id long, score long, times long"
    part = queries.groupBy("b", "c").cogroup(candidates.groupBy("b", "c")).applyInArrow(search, kind)
    part = part.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    order = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")
    best = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    best = best.withColumn("asked", F.explode(F.sequence(F.lit(1).cast("long"), "asked")))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
