"""Exact k nearest neighbours between kinds, in blocks, and the mutual graph made of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2048  # rows of a block, about
RANKS = "src_id long, tgt_id long, src_kind int, tgt_kind int, cosine double"


def _first(scores: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by name; only what reaches the k-th score is sorted."""
    near = np.flatnonzero(scores >= np.partition(scores, -k)[-k]) if len(scores) > k else np.arange(len(scores))
    return near[np.lexsort((names[near], -scores[near]))][:k]


def _tile(a: pd.DataFrame, b: pd.DataFrame, limits: dict[tuple[int, int], tuple[int, float]]) -> pd.DataFrame:
    """The best k of this tile for each row of a, by cosine, then id; rows of one source never meet."""
    out = []
    if len(a) and len(b):
        va, vb = (np.stack(x.to_numpy()).astype(float) for x in (a["v"], b["tv"]))
        va, vb = va / np.linalg.norm(va, axis=1, keepdims=True), vb / np.linalg.norm(vb, axis=1, keepdims=True)
        b_id, b_source = b["tid"].to_numpy(), b["tsource"].to_numpy()
        k, least = limits[int(a["kind"].iloc[0]), int(b["tkind"].iloc[0])]
        cos = va @ vb.T
        for i, (row_id, source) in enumerate(zip(a["id"].tolist(), a["source"].tolist(), strict=True)):
            ok = np.flatnonzero((cos[i] >= least) & (b_source != source) & (b_id != row_id))
            for j in ok[_first(cos[i][ok], b_id[ok], k)]:
                out.append((row_id, b_id[j], float(cos[i, j])))
    made = pd.DataFrame(out, columns=["src_id", "tgt_id", "cosine"])
    return made.assign(src_kind=a["kind"].iloc[0] if len(a) else 0, tgt_kind=b["tkind"].iloc[0] if len(b) else 0)[["src_id", "tgt_id", "src_kind", "tgt_kind", "cosine"]]


def _dealt(rows: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their block, number of blocks of each kind)."""
    sizes = rows.groupBy("kind").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.lit(1)).cast("int").alias("blocks"))
    part = F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")
    return rows.join(sizes, "kind").withColumn("own", part), sizes


def candidates(sources: DataFrame, targets: DataFrame, limits: dict[tuple[int, int], tuple[int, float]], block: int = BLOCK, wanted: DataFrame | None = None) -> DataFrame:
    """RANKS rows: the best of every tile of a block of sources and one of targets (id, source, kind, v).

    With `wanted` (id, tgt_kind), a source row meets only these kinds. A task holds two blocks,
    whatever the size of a kind.
    """
    pairs = sources.sparkSession.createDataFrame([(a, b) for a, b in limits], "pk int, pt int")
    own, sizes = _dealt(sources, block)
    other, other_sizes = _dealt(targets, block)
    blocks = other_sizes.select(F.col("kind").alias("pt"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("rb"))
    left = own.join(pairs, own["kind"] == pairs["pk"]).join(blocks, "pt").select("id", "source", "kind", "v", "pt", F.col("own").alias("lb"), "rb")
    if wanted is not None:
        asked = wanted.select(F.col("id").alias("_wid"), F.col("tgt_kind").alias("_wk"))
        left = left.join(asked, (left["id"] == asked["_wid"]) & (left["pt"] == asked["_wk"]), "left_semi")
    blocks = sizes.select(F.col("kind").alias("qk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("tlb"))
    right = other.select(F.col("id").alias("tid"), F.col("source").alias("tsource"), F.col("kind").alias("tkind"), F.col("v").alias("tv"), F.col("own").alias("trb"))
    right = right.join(pairs.select(F.col("pk").alias("qk"), F.col("pt").alias("tkind")), "tkind").join(blocks, "qk").select("tid", "tsource", "tkind", "tv", "trb", "qk", "tlb")
    return left.groupBy("kind", "pt", "lb", "rb").cogroup(right.groupBy("qk", "tkind", "tlb", "trb")).applyInPandas(lambda a, b: _tile(a, b, limits), RANKS)


def ranked(found: DataFrame, limits: dict[tuple[int, int], tuple[int, float]]) -> DataFrame:
    """The k best of each source row and target kind with their rank: by cosine (not rounded), then id."""
    w = Window.partitionBy("src_id", "tgt_kind").orderBy(F.desc("cosine"), "tgt_id")
    most = F.create_map(*[x for (a, b), (k, _) in limits.items() for x in (F.lit(f"{a}:{b}"), F.lit(k))])
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= most[F.concat_ws(":", "src_kind", "tgt_kind")])


def rank_lists(rows: DataFrame, limits: dict[tuple[int, int], tuple[int, float]], block: int = BLOCK) -> DataFrame:
    """(src_id, tgt_id, src_kind, tgt_kind, cosine, rank) for rows (id, source, kind, v); rows of one source never meet.

    limits: (k, least cosine) of each ordered pair of kinds.
    """
    return ranked(candidates(rows, rows, limits, block), limits)


def mutual_edges(ranks: DataFrame) -> DataFrame:
    """(src_id, tgt_id, pair_kind, cosine): pairs that rank each other, once, the smaller kind (then id) first."""
    first = (F.col("src_kind") < F.col("tgt_kind")) | ((F.col("src_kind") == F.col("tgt_kind")) & (F.col("src_id") < F.col("tgt_id")))
    back = ranks.select(F.col("src_id").alias("tgt_id"), F.col("tgt_id").alias("src_id"))
    out = ranks.where(first).join(back, ["src_id", "tgt_id"], "left_semi")
    return out.select("src_id", "tgt_id", F.concat_ws(":", "src_kind", "tgt_kind").alias("pair_kind"), F.round("cosine", 6).alias("cosine"))


def edge_report(edges: DataFrame) -> DataFrame:
    return edges.groupBy("pair_kind").agg(
        F.count(F.lit(1)).alias("edges"), F.round(F.min("cosine"), 6).alias("least"), F.round(F.avg("cosine"), 6).alias("mean"), F.round(F.max("cosine"), 6).alias("most")
    )


def degrees(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src_id", "tgt_id")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def both_ways(edges: DataFrame) -> DataFrame:
    """(node, other, weight, kind): each edge from both ends; a self loop once."""
    out = edges.select(F.col("src_id").alias("node"), F.col("tgt_id").alias("other"), F.col("cosine").alias("weight"), F.col("pair_kind").alias("kind"))
    back = edges.where("src_id <> tgt_id").select(F.col("tgt_id").alias("node"), F.col("src_id").alias("other"), F.col("cosine").alias("weight"), F.col("pair_kind").alias("kind"))
    return out.unionByName(back)


def neighbours(edges: DataFrame, k: int, kinds: list[str] | None = None) -> DataFrame:
    """The k heaviest neighbours of every node, ties by kind and id."""
    all_ways = both_ways(edges if kinds is None else edges.where(F.col("pair_kind").isin(kinds)))
    w = Window.partitionBy("node").orderBy(F.desc("weight"), "kind", "other")
    return all_ways.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def top_k(queries: DataFrame, rows: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """(query_id, id, score, rank): the k rows (id, v) of largest cosine for each query (query_id, qv), ties by id."""
    n, m = (max(1, -(-df.count() // block)) for df in (queries, rows))

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            va, vb = (np.stack(x.to_numpy()).astype(float) for x in (a["qv"], b["v"]))
            cos = (va / np.linalg.norm(va, axis=1, keepdims=True)) @ (vb / np.linalg.norm(vb, axis=1, keepdims=True)).T
            found = b["id"].to_numpy()
            for i, q in enumerate(a["query_id"].tolist()):
                out += [(q, found[j], float(cos[i, j])) for j in _first(cos[i], found, k)]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    left = queries.select("query_id", "qv", F.pmod(F.xxhash64("query_id"), F.lit(n)).cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("b"))
    right = rows.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("c"), F.pmod(F.xxhash64("id"), F.lit(m)).cast("int").alias("d"))
    found = left.groupBy("a", "b").cogroup(right.groupBy("c", "d")).applyInPandas(tile, "query_id long, id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
