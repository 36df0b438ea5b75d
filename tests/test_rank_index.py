"""A refreshed index against a full build, and what it computes and writes."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lodestack.operators import knn, rank_index
from lodestack.sources.tables import scratch

LIMITS = {(0, 0): (3, -1.0), (0, 1): (2, -1.0), (1, 0): (4, 0.1), (1, 1): (3, 0.0)}
SCHEMA = "id long, source long, kind int, v array<double>"


def made(rng, ids):
    return [(i, i % 7, i % 2, [rng.gauss(0, 1) for _ in range(5)]) for i in ids]


def as_set(lists):
    return {(r.src_id, r.tgt_id, r.src_kind, r.tgt_kind, round(r.cosine, 10), r["rank"]) for r in lists.collect()}


@pytest.mark.parametrize("share", [0.05, 0.6])
def test_refresh_equals_a_full_build(spark, share):
    rng = random.Random(int(share * 100))
    old = made(rng, range(90))
    n = int(share * 40)
    moved, gone = set(rng.sample(range(90), n)), set(rng.sample(range(90), n // 2))
    new = [r if r[0] not in moved else (r[0], r[1], r[2], [rng.gauss(0, 1) for _ in range(5)]) for r in old if r[0] not in gone] + made(rng, range(100, 100 + n))
    before, now = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    at = scratch(spark)
    rank_index.write(before, LIMITS, at, block=20, buckets=8)
    assert {r.id for r in rank_index.stale(now, at).collect()} == moved | gone | {r[0] for r in new if r[0] >= 100}
    assert as_set(rank_index.edges(now, at).withColumns({"rank": F.lit(0), "src_kind": F.lit(0), "tgt_kind": F.lit(0)})) == as_set(
        knn.mutual_edges(rank_index.lists(spark, at).where(~F.col("src_id").isin(list(moved | gone) or [-1]) & ~F.col("tgt_id").isin(list(moved | gone) or [-1]))).withColumns(
            {"rank": F.lit(0), "src_kind": F.lit(0), "tgt_kind": F.lit(0)}
        )
    )
    rank_index.refresh(now, LIMITS, at, block=20, buckets=8)
    assert as_set(rank_index.lists(spark, at)) == as_set(knn.rank_lists(now, LIMITS, block=1000))
    assert rank_index.stale(now, at).count() == 0


def test_a_small_change_computes_and_writes_little(spark, monkeypatch):
    rng = random.Random(1)
    # far groups: a change in one reaches no list of another
    old = [(i, i, i % 30, [float(i % 30 == j) + rng.gauss(0, 0.01) for j in range(30)]) for i in range(240)]
    limits = {(k, k): (2, 0.5) for k in range(30)}
    at = scratch(spark)
    rank_index.write(spark.createDataFrame(old, SCHEMA), limits, at, block=50, buckets=64)
    files = {p: os.stat(os.path.join(r, p)).st_mtime_ns for r, _, f in os.walk(f"{at}/lists") for p in f if p.endswith(".parquet")}
    now = [r if r[0] != 31 else (31, 31, 1, old[31][3][::-1]) for r in old]
    sizes = []
    plain = knn.candidates
    monkeypatch.setattr(knn, "candidates", lambda a, b, *rest: sizes.append((a.count(), b.count())) or plain(a, b, *rest))
    rank_index.refresh(spark.createDataFrame(now, SCHEMA), limits, at, block=50, buckets=64)
    assert sizes[0] == (239, 1) and sizes[1][0] <= 9  # all rows meet the changed one; it and the rows that lost it meet all
    after = {p for r, _, f in os.walk(f"{at}/lists") for p in f if p.endswith(".parquet")}
    assert len(files.keys() & after) > len(files) * 0.6
    assert as_set(rank_index.lists(spark, at)) == as_set(plain(spark.createDataFrame(now, SCHEMA), spark.createDataFrame(now, SCHEMA), limits).transform(lambda f: knn.ranked(f, limits)))
