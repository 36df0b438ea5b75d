"""Conflict-constrained best-fit packing of documents into bins of bounded length.

Documents are dealt over shards by a hash of their rows; a shard packs its rows, longest
first, in one task. Open bins stand in order of residual room, each with a bitmap of the
sources and one of the duplicate clusters it holds. For a row, the search starts at the
tightest bin with room enough and goes on to successors until one holds neither the row's
source nor its cluster; if none is left, a bin opens. Lengths over the capacity are cut:
full pieces fill bins of their own and the rest is packed like any row.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ROWS = 2048  # rows of a shard, about
OUT = "_id long, piece int, offset long, length long, bin_id string, bin_used long"


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """Bin number of each row, rows taken as they come; each length is at most the capacity.

    sources and clusters are small integers; -1 conflicts with nothing.
    """
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held_sources, held_clusters, out = [], [], []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        sbit, cbit = (1 << s if s >= 0 else 0), (1 << c if c >= 0 else 0)
        at = bisect_left(open_bins, (n, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (held_sources[b] & sbit or held_clusters[b] & cbit):
                break
            at += 1
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            room, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[b] |= sbit
        held_clusters[b] |= cbit
        if room > n:
            insort(open_bins, (room - n, b))
        out.append(b)
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", source_col: str = "source", cluster_col: str = "cluster",
         capacity: int = 2048, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, piece, offset, length, bin_id, bin_used): every row of docs in pieces of at most `capacity`, each in one bin.

    No bin holds two rows of one source or of one cluster; null sources and clusters conflict with
    nothing. Null and negative lengths count as 0 (one empty piece); ties are taken by id, null ids
    last. Rows that repeat are packed each. Other columns of docs are not read.
    """
    n = docs.count()
    shards = max(1, -(-n // shard_rows))
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(0)), F.lit(0)).alias("_n"),
        F.xxhash64(F.col(source_col)).alias("_s"), F.col(source_col).isNull().alias("_sn"),
        F.xxhash64(F.col(cluster_col)).alias("_c"), F.col(cluster_col).isNull().alias("_cn"),
        F.pmod(F.xxhash64(id_col, length_col, source_col, cluster_col, F.lit(7)), F.lit(shards)).cast("int").alias("_shard"),
    )

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        tail = pdf["_n"] % capacity
        tail = tail.where((tail > 0) | (pdf["_n"] == 0), 0)
        pdf = pdf.assign(_tail=tail).sort_values(["_tail", "_id", "_n", "_c"], ascending=[False, True, True, True], na_position="last", kind="stable")
        sources = np.where(pdf["_sn"], -1, pd.factorize(pdf["_s"])[0]).tolist()
        clusters = np.where(pdf["_cn"], -1, pd.factorize(pdf["_c"])[0]).tolist()
        name, out, open_rows = pdf["_shard"].iloc[0], [], []
        for i, total, rest, s, c in zip(pdf["_id"].tolist(), pdf["_n"].tolist(), pdf["_tail"].tolist(), sources, clusters, strict=True):
            full = total // capacity
            for k in range(full):
                out.append((i, k, k * capacity, capacity, f"{name}-f{len(out)}", capacity))
            if rest or not total:
                open_rows.append((i, full, full * capacity, rest, s, c))
        bins = best_fit([r[3] for r in open_rows], [r[4] for r in open_rows], [r[5] for r in open_rows], capacity)
        used = np.bincount(bins, [r[3] for r in open_rows]).astype(int).tolist() if bins else []
        out += [(*r[:4], f"{name}-{b}", used[b]) for r, b in zip(open_rows, bins, strict=True)]
        made = pd.DataFrame(out, columns=["_id", "piece", "offset", "length", "bin_id", "bin_used"])
        return made.astype({"_id": "Int64"})

    return rows.groupBy("_shard").applyInPandas(shard, OUT).withColumnRenamed("_id", id_col)


def words(text):
    """Number of words, runs of anything but ASCII white space; null text has none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("long")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("n_tokens"), F.sha2(text, 256).alias("cluster"))
    return pack(rows)
