"""Nearest neighbours by a block matrix join with int8 products.

Queries and candidates are dealt into blocks by a hash of their ids, and every pair of blocks
is a tile. In a tile, vectors are quantised to int8 and one integer product estimates all
inner products; a bound on the rounding error tells which pairs can still be among the k
best. Only those are computed again from the original vectors in double precision and kept
in a heap of k for each query; the heaps of all tiles merge into the result. Bounds hold for
every pair, so that the result is the exact one. Identical vectors of a tile are multiplied once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_ROWS = 4096  # rows of a candidate block, about
QUERY_ROWS = 1024  # rows of a query block, about
OUT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(_id, _v) of the rows that take part: an id, and a vector of finite components that are not all zero."""
    v = F.col(vec_col).cast("array<double>")
    out = vectors.select(F.col(id_col).cast("long").alias("_id"), v.alias("_v")).where("_id IS NOT NULL AND _v IS NOT NULL")
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return out.where(fine & F.exists("_v", lambda x: x != 0))


def _classes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of v and, for each row, which of them it is."""
    raw = np.ascontiguousarray(v).view(np.dtype((np.void, v.shape[1] * 8))).ravel()
    _, first, inverse = np.unique(raw, return_index=True, return_inverse=True)
    return v[first], inverse.ravel()


def _quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scale of each, sum of absolute components, largest rounding error of a component)."""
    scale = np.abs(v).max(1) / 127
    scale[scale == 0] = np.finfo(float).tiny
    q = np.clip(np.rint(v / scale[:, None]), -127, 127).astype(np.int8)
    return q, scale, np.abs(v).sum(1), np.abs(v - q * scale[:, None]).max(1)


def tile_topk(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple]:
    """(query id, id, score) of each query's k best in this tile, itself excluded, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    distinct, member = _classes(vectors)
    by_class = np.argsort(member, kind="stable")  # ids of a class in ascending order
    starts = np.concatenate([[0], np.cumsum(np.bincount(member))])
    asked, which = _classes(queries)
    cq, cs, cl, ce = _quantised(distinct)
    qq, qs, ql, qe = _quantised(asked)
    # int8 products of this width are exact in float32, up to 1040 components; beyond that in float64
    kind = np.float32 if queries.shape[1] <= 1000 else np.float64
    about = (qq.astype(kind) @ cq.astype(kind).T).astype(float) * qs[:, None] * cs[None, :]
    # |x.y - x'.y'| <= |x - x'|.|y| + |x'|.|y - y'|, sums bounded by the largest error times the sum of components
    slack = qe[:, None] * cl[None, :] + ce[None, :] * (ql + queries.shape[1] * qe)[:, None]
    slack = slack * (1 + 1e-9) + 1e-300
    low = about - slack
    n = low.shape[1]
    # the class of the query itself may lose one member, so k + 1 classes give k candidates at least
    floor = np.partition(low, n - k - 1, axis=1)[:, n - k - 1] if n > k + 1 else np.full(len(low), -np.inf)
    out, by_query = [], [[] for _ in range(len(asked))]
    for i, q in zip(query_ids.tolist(), which.tolist(), strict=True):
        by_query[q].append(i)
    for q, owners in enumerate(by_query):
        alive = np.flatnonzero(about[q] + slack[q] >= floor[q])
        exact = np.cumsum(distinct[alive] * asked[q], axis=1)[:, -1]  # summed component by component, as a plain loop does
        entries = []
        for c, s in zip(alive.tolist(), exact.tolist(), strict=True):
            entries += [(-s, int(i)) for i in ids[by_class[starts[c] : min(starts[c] + k + 1, starts[c + 1])]]]
        best = heapq.nsmallest(k + 1, entries)
        for i in owners:
            out += [(i, v, -s) for s, v in [e for e in best if e[1] != i][:k]]
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            candidate_rows: int = CANDIDATE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product for each row where is_query holds.

    Null ids, and vectors that are null, empty, zero or not finite, take no part; vectors only meet
    others of their length. A query's own id is never among its results. Rows that repeat an id and
    vector count once. No queries or no candidates give no rows.
    """
    rows = usable(vectors, id_col, vec_col).dropDuplicates(["_id", "_v"])
    counts = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    c_blocks = max(1, -(-counts["n"] // candidate_rows))
    q_blocks = max(1, -(-counts["q"] // query_rows))
    ids = vectors.select(F.col(id_col).cast("long").alias("_qid")).where(is_query).distinct()
    asked = rows.join(ids, rows["_id"] == ids["_qid"], "left_semi")

    def block(n, seed):
        return F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(n)).cast("int")

    width = F.size("_v").alias("_w")
    left = asked.select("_id", "_v", width, block(q_blocks, 1).alias("_qb"), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("_cb"))
    right = rows.select(
        F.col("_id").alias("_cid"), F.col("_v").alias("_cv"), F.size("_v").alias("_cw"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("_cqb"), block(c_blocks, 2).alias("_ccb")
    )

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            found = tile_topk(a["_id"].to_numpy(), np.stack(a["_v"].to_numpy()), b["_cid"].to_numpy(), np.stack(b["_cv"].to_numpy()), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = left.groupBy("_w", "_qb", "_cb").cogroup(right.groupBy("_cw", "_cqb", "_ccb")).applyInPandas(tile, OUT)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(w).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
          FROM good q, good c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20
"""
