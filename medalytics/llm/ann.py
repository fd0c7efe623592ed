"""Nearest neighbours by inner product: int8 product tiles with error bounds, exact scores, heaps."""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage
from .vectors import block, blocks_of, matrix, spread, usable


def quantised(rows: np.ndarray):
    """int8 rows, their scales, the norms of scaled rows, and the norms of what the rounding loses."""
    scale = np.abs(rows).max(axis=1) / 127
    scale = np.where(scale > 0, scale, np.finfo(float).tiny)
    whole = np.clip(np.rint(rows / scale[:, None]), -127, 127)
    near = whole * scale[:, None]
    return whole.astype(np.int8), scale, np.linalg.norm(near, axis=1), np.linalg.norm(rows - near, axis=1)


def exact(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs in double precision, summed in the order of the dimensions."""
    total = np.zeros(len(i))
    for d in range(left.shape[1]):
        total += left[i, d] * right[j, d]
    return total


def tile(q_ids, queries, c_ids, candidates, k: int, strip: int = 256):
    """The k best candidates of each query in one tile as (query, candidate, score), exact.

    For rows x = s q + r, with int8 q and the loss r, the product differs from the scaled int8 product
    by at most |sq||r'| + |r||s'q'| + |r||r'|. A pair is scored in double only if its upper bound reaches
    the k-th best lower bound. Of equal vectors only the k + 1 smallest ids can be among the best.
    """
    order = np.lexsort((c_ids, *candidates.T[::-1]))
    c_ids, candidates = c_ids[order], candidates[order]
    new = np.r_[True, (candidates[1:] != candidates[:-1]).any(axis=1)]
    first = np.flatnonzero(new)
    rank = np.arange(len(c_ids)) - first[np.cumsum(new) - 1]
    c_ids, candidates = c_ids[rank <= k], candidates[rank <= k]

    cq, cs, cn, cr = quantised(candidates)
    whole = np.float32 if queries.shape[1] * 127**2 < 1 << 24 else np.float64  # sums of products stay exact
    cq = cq.astype(whole).T
    found = []
    for at in range(0, len(q_ids), strip):
        rows, ids = queries[at : at + strip], q_ids[at : at + strip]
        qq, qs, qn, qr = quantised(rows)
        score = (qq.astype(whole) @ cq).astype(np.float64) * qs[:, None] * cs
        bound = (qn[:, None] * cr + qr[:, None] * cn + qr[:, None] * cr) * (1 + 1e-6) + np.abs(score) * 1e-12
        own = ids[:, None] == c_ids
        lower = np.where(own, -np.inf, score - bound)
        limit = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] >= k else np.full(len(ids), -np.inf)
        i, j = np.nonzero(~(score + bound < limit[:, None]) & ~own)
        value = exact(rows, candidates, i, j)
        best = np.lexsort((c_ids[j], -value, i))
        i, j, value = i[best], j[best], value[best]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        found.append((ids[i[keep]], c_ids[j[keep]], value[keep]))
    return [np.concatenate(x) for x in zip(*found)]


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, query_rows: int = 4096, candidate_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where `is_query` holds, the k rows of the largest inner product.

    Candidates are all rows of another id; ties go to the smaller id; with fewer than k all are returned.
    Vectors that are null, empty, zero or hold null or non-finite numbers take no part, nor do null ids.
    Repeated rows of one id and vector count once. Vectors of another length are not compared. Other
    columns are not read.

    Query blocks meet candidate blocks in tiles of bounded size; each tile sends on at most k rows per
    query, and those of a query are merged in a heap of k, one query at a time.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).filter(F.col("id").isNotNull() & usable(F.col("vec")))
    rows = stage(rows.distinct().select("id", "vec", F.size("vec").alias("dim")), "vectors")
    asked = rows.filter(is_query(F.col("id")))
    q_blocks, c_blocks = blocks_of(asked.count(), query_rows), blocks_of(rows.count(), candidate_rows)
    left = spread(asked.withColumn("qb", block("id", q_blocks)), "cb", c_blocks)
    right = spread(rows.withColumn("cb", block("id", c_blocks)), "qb", q_blocks)

    def best(q, c):
        if not len(q) or not len(c):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        found = tile(q.column("id").to_numpy(), matrix(q.column("vec")), c.column("id").to_numpy(), matrix(c.column("vec")), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    keys = ["qb", "cb", "dim"]
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "query_id long, vec_id long, score double")

    def ranked(batches):
        heap, current = [], None

        def done():
            best = sorted({(-s, -v) for s, v in heap})
            return [(current, r + 1, v, -s) for r, (s, v) in enumerate(best)]

        for batch in batches:
            out = []
            for query, vec, score in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
                if query != current:
                    out += done() if heap else []
                    heap, current = [], query
                item = (score, -vec)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
            yield _batch(out)
        if heap:
            yield _batch(done())

    merged = partial.repartition("query_id").sortWithinPartitions("query_id")
    return merged.mapInArrow(ranked, "query_id long, rank int, vec_id long, score double")


def _batch(rows):
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "rank", "vec_id", "score"])
