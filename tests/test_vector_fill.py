"""Filling of vectors with embedders that fail, and look-ups under a contract."""

import math

import pytest
from pyspark.sql import functions as F

from lodestack.operators import vector_fill as vf
from lodestack.sources.tables import scratch

ROWS = "vector_hash string, text string"


@pytest.fixture
def moody():
    """Fails in every way, by the words of its texts."""

    def embed(texts):
        if any("raise" in t for t in texts):
            raise OSError("down")
        if any("count" in t for t in texts):
            return [[1.0, 2.0]] * (len(texts) + 1)
        return [[1.0] if "short" in t else [math.nan, 1.0] if "nan" in t else None if "none" in t else [float(len(t)), 0.5] for t in texts]

    return embed


def test_failures_are_rows_and_a_second_run_adds_nothing(spark, moody):
    texts = ["good", "raise this", "a count", "short", "nan", "none", "", None, "fine", "good again"]
    rows = spark.createDataFrame([(f"h{i}", t) for i, t in enumerate(texts)] + [("h0", "good")], ROWS).coalesce(1)
    at = scratch(spark)
    got = {r.vector_hash: (r.how, r.failure) for r in vf.fill(rows, at, moody, "m", 2, size=3).collect()}
    want = ["", "error", "count", "dimension", "not_finite", "dimension", "empty", "empty", "", ""]
    assert got == {f"h{i}": ("failed" if f else "embedded", f) for i, f in enumerate(want)}
    held = spark.read.schema(vf.CACHE).parquet(at)
    assert {r.vector_hash: r.v for r in held.collect()} == {"h0": [4.0, 0.5], "h8": [4.0, 0.5], "h9": [10.0, 0.5]}
    again = {r.vector_hash: r.how for r in vf.fill(rows, at, moody, "m", 2).collect()}
    assert again == {h: "failed" if f == "failed" else "reused" for h, (f, _) in got.items()}
    assert spark.read.schema(vf.CACHE).parquet(at).count() == 3
    other = {r.how for r in vf.fill(rows.where("text = 'good'"), at, moody, "other model", 2).collect()}
    assert other == {"embedded"}


def test_lookup_wants_contract_and_digest(spark):
    cache = spark.createDataFrame([("a", "m", 2, [1.0, 2.0]), ("b", "m", 2, [3.0, 4.0]), ("c", "m2", 2, [5.0, 6.0]), ("d", "m", 2, [7.0])], "vector_hash string, model string, dim int, v array<double>")
    cache = cache.withColumn("checksum", F.when(F.col("vector_hash") == "b", "bad").otherwise(vf.checksum(F.col("v"))))
    cache = cache.unionByName(cache.where("vector_hash = 'a'").withColumn("checksum", F.lit("bad")))
    asked = spark.createDataFrame([(h, "m", 2) for h in "abcde"], "vector_hash string, model string, dim int")
    got = {r.vector_hash: (r.state, r.v) for r in vf.lookup(asked, cache).collect()}
    assert got == {"a": ("hit", [1.0, 2.0]), "b": ("corrupt", None), "c": ("miss", None), "d": ("corrupt", None), "e": ("miss", None)}


def test_nothing_to_fill(spark, moody):
    assert vf.fill(spark.createDataFrame([], ROWS), scratch(spark), moody, "m", 2).count() == 0
