"""A written index of k-nearest-neighbour lists that follows changes of its rows.

The index keeps the lists and a fingerprint of each row that they were made of. Reading it drops
nothing silently: rows whose fingerprint has moved are reported. A refresh compares fingerprints
and touches only what the change reaches:

- rows that changed or are new meet all targets of their kinds;
- all other rows meet the changed targets only, and keep what is left of their lists;
- a full list that lost members, and whose place the new candidates cannot prove filled, meets
  the targets of that one kind again. A candidate proves its place if it is at least as good as
  the worst member of the old list: all that the list had left out is worse than that.

The result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.operators import diff, knn
from lodestack.sources.tables import read_folders, rewrite_folders, stored

LISTS = "src_id long, tgt_id long, src_kind int, tgt_kind int, cosine double, rank int, bucket int"
PRINTS = "id long, print string"
BUCKETS = 64  # folders of an index; a refresh writes those again that hold a changed list


def prints(rows: DataFrame) -> DataFrame:
    """(id, print): what the lists of a row depend on."""
    return rows.select("id", diff.fingerprint(F.col("source"), F.col("kind"), F.array_join(F.transform("v", lambda x: x.cast("string")), ",")).alias("print"))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("src_id"), F.lit(buckets)).cast("int").alias("bucket")


def write(rows: DataFrame, limits: dict, path: str, block: int = knn.BLOCK, buckets: int = BUCKETS) -> None:
    """A full build of the index of rows (id, source, kind, v) at `path`."""
    lists = knn.rank_lists(rows, limits, block).select("src_id", "tgt_id", "src_kind", "tgt_kind", "cosine", "rank", _bucket(buckets))
    lists.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/lists")
    prints(rows).write.mode("overwrite").parquet(f"{path}/prints")


def lists(spark, path: str) -> DataFrame:
    return read_folders(spark, f"{path}/lists", LISTS, "src_id")


def stale(rows: DataFrame, path: str) -> DataFrame:
    """(id, change): rows that were added, updated or deleted since the index was written."""
    return diff.keyed_diff(rows.sparkSession.read.schema(PRINTS).parquet(f"{path}/prints"), prints(rows), "id", "print")


def lists_now(rows: DataFrame, limits: dict, path: str, block: int = knn.BLOCK) -> tuple[DataFrame, DataFrame]:
    """(lists of the rows as they are, source rows whose lists may differ from the written ones)."""
    spark = rows.sparkSession
    change = stored(stale(rows, path))
    moved = change.where("change <> 'deleted'").select("id")
    old = lists(spark, path).drop("bucket")
    gone = change.select("id")
    same = rows.join(gone, "id", "left_anti")
    own = old.join(gone.withColumnRenamed("id", "src_id"), "src_id", "left_anti")
    kept = own.join(gone.withColumnRenamed("id", "tgt_id"), "tgt_id", "left_anti")
    lost = own.join(gone.withColumnRenamed("id", "tgt_id"), "tgt_id", "left_semi").select("src_id", "tgt_kind").distinct()
    new = stored(knn.candidates(same, rows.join(moved, "id", "left_semi"), limits, block))
    merged = stored(knn.ranked(kept.drop("rank").unionByName(new), limits))
    # lists that were full and lost a member: complete only if as many as before are no worse than the old last one
    full = F.create_map(*[x for (a, b), (k, _) in limits.items() for x in (F.lit(f"{a}:{b}"), F.lit(k))])[F.concat_ws(":", "src_kind", "tgt_kind")]
    last = own.where(F.col("rank") == full).join(lost, ["src_id", "tgt_kind"], "left_semi").select("src_id", "tgt_kind", F.col("rank").alias("_k"), F.col("cosine").alias("_c"), F.col("tgt_id").alias("_t"))
    proven = last.join(merged.select("src_id", "tgt_kind", "cosine", "tgt_id"), ["src_id", "tgt_kind"], "left")
    no_worse = F.count_if((F.col("cosine") > F.col("_c")) | ((F.col("cosine") == F.col("_c")) & (F.col("tgt_id") <= F.col("_t"))))
    open_lists = proven.groupBy("src_id", "tgt_kind", "_k").agg(no_worse.alias("_n")).where("_n < _k").select(F.col("src_id").alias("id"), "tgt_kind")
    pairs = spark.createDataFrame([(a, b) for a, b in limits], "kind int, tgt_kind int")
    again = stored(rows.join(moved, "id", "left_semi").join(pairs, "kind").select("id", "tgt_kind").unionByName(open_lists).distinct())
    # deleted targets take part in no tile; only the source rows that ask are dealt to blocks
    asking = rows.join(again.select("id").distinct(), "id", "left_semi")
    fresh = knn.ranked(knn.candidates(asking, rows, limits, block, again), limits)
    closed = merged.join(again.withColumnRenamed("id", "src_id"), ["src_id", "tgt_kind"], "left_anti")
    touched = again.select(F.col("id").alias("src_id")).union(lost.select("src_id")).union(new.select("src_id")).union(gone.select(F.col("id").alias("src_id"))).distinct()
    return closed.unionByName(fresh), touched


def refresh(rows: DataFrame, limits: dict, path: str, block: int = knn.BLOCK, buckets: int = BUCKETS) -> None:
    """Bring the index at `path` to the state of `rows`; only folders with a list that may differ are written again."""
    spark = rows.sparkSession
    now, touched = lists_now(rows, limits, path, block)
    folders = stored(touched.select(_bucket(buckets)).distinct())
    result = now.select("src_id", "tgt_id", "src_kind", "tgt_kind", "cosine", "rank", _bucket(buckets)).join(F.broadcast(folders), "bucket", "left_semi")  # at most `buckets` rows
    rewrite_folders(result, folders, f"{path}/lists", "bucket")
    stored(prints(rows)).write.mode("overwrite").parquet(f"{path}/prints")


def edges(rows: DataFrame, path: str) -> DataFrame:
    """Mutual edges of an index, without rows that are stale; `stale` tells which these are."""
    gone = stored(stale(rows, path).select("id"))
    fresh = lists(rows.sparkSession, path)
    for end in ("src_id", "tgt_id"):
        fresh = fresh.join(gone.withColumnRenamed("id", end), end, "left_anti")
    return knn.mutual_edges(fresh)
