"""Vectors of records: what a cache holds, and filling in what it lacks.

A cache row is (vector_hash, model, dim, checksum, v): the hash of the text, the contract it was made
under, and a digest of the vector. Records find a vector only under their own contract and only
if its digest is right. Missing texts are embedded once each, in batches, by any function of a
list of texts; what breaks the contract becomes a failure row instead of ending the job.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.sources.tables import exists, stored

CACHE = "vector_hash string, model string, dim int, checksum string, v array<double>"
MADE = "vector_hash string, v array<double>, failure string"
BATCH = 64  # texts that an embedder gets at once


def checksum(v: Column) -> Column:
    """Digest of a vector, by its components in millionths."""
    return F.md5(F.array_join(F.transform(v, lambda x: F.round(x.cast("double") * 1000000).cast("long").cast("string")), ","))


def lookup(records: DataFrame, cache: DataFrame) -> DataFrame:
    """`records` (vector_hash, model, dim) with v and state: hit, corrupt (digest or length is wrong) or miss.

    Several rows of a cache for one contract count once, a right one first.
    """
    right = (checksum(F.col("v")) == F.col("checksum")) & (F.size("v") == F.col("dim"))
    best = cache.groupBy("vector_hash", "model", "dim").agg(F.max(F.struct(F.coalesce(right, F.lit(False)).alias("right"), F.col("v"))).alias("_c"))
    found = records.join(best, ["vector_hash", "model", "dim"], "left")
    state = F.when(F.col("_c").isNull(), "miss").when(F.col("_c.right"), "hit").otherwise("corrupt")
    return found.select(*records.columns, F.when(F.col("_c.right"), F.col("_c.v")).alias("v"), state.alias("state"))


def embedded(texts: DataFrame, embed: Callable[[list[str]], list], dim: int, size: int = BATCH) -> DataFrame:
    """MADE rows of (vector_hash, text): `embed` gets up to `size` texts and returns a vector for each.

    Empty and null texts are not sent (empty). A batch that raises, or returns another number of
    vectors, is tried again text by text, so that one text does not fail its neighbours; what
    still fails has failure error or count. Vectors of another length (dimension) and with
    components that are not finite (not_finite) fail alone.
    """

    def tried(batch: list[str]) -> list[tuple[list | None, str]]:
        try:
            got = embed(batch)
        except Exception:  # whatever a provider raises is a failure row, not the end of the job
            return [(None, "error")] * len(batch)
        return [(v, "") for v in got] if len(got) == len(batch) else [(None, "count")] * len(batch)

    def checked(v: list | None, failure: str) -> tuple[list | None, str | None]:
        if failure:
            return None, failure
        if v is None or len(v) != dim:
            return None, "dimension"
        v = [float(x) for x in v]
        return (v, None) if all(map(math.isfinite, v)) else (None, "not_finite")

    def run(batches):
        for rows in batches:
            hashes, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            out = {i: (None, "empty") for i, t in enumerate(texts) if not t}
            sent = [i for i, t in enumerate(texts) if t]
            for at in range(0, len(sent), size):
                part = sent[at : at + size]
                got = tried([texts[i] for i in part])
                if len(part) > 1 and any(f for _, f in got):
                    got = [tried([texts[i]])[0] for i in part]
                out |= {i: checked(v, f) for i, (v, f) in zip(part, got, strict=True)}
            v, failure = zip(*(out[i] for i in range(len(texts))), strict=True) if texts else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.string()), pa.array(v, pa.list_(pa.float64())), pa.array(failure, pa.string())], ["vector_hash", "v", "failure"])

    return texts.select("vector_hash", "text").mapInArrow(run, MADE)


def fill(records: DataFrame, path: str, embed: Callable[[list[str]], list], model: str, dim: int, size: int = BATCH) -> DataFrame:
    """Embed what the cache at `path` lacks for records (vector_hash, text), write it there, and return (vector_hash, how, failure).

    how: reused, embedded or failed. Each missing hash is embedded once; a second run finds all that
    was embedded and tries failures again. Vectors are appended in one job that is committed as a whole.
    """
    spark = records.sparkSession
    cache = spark.read.schema(CACHE).parquet(path) if exists(spark, path) else spark.createDataFrame([], CACHE)
    asked = records.groupBy("vector_hash").agg(F.first("text").alias("text"), F.lit(model).alias("model"), F.lit(dim).alias("dim"))
    state = stored(lookup(asked, cache).select("vector_hash", "text", "state"))
    made = stored(embedded(state.where("state <> 'hit'"), embed, dim, size))  # embedded once, whatever is done with it
    fine = made.where("failure IS NULL").select("vector_hash", F.lit(model).alias("model"), F.lit(dim).alias("dim"), checksum(F.col("v")).alias("checksum"), "v")
    fine.write.mode("append").parquet(path)
    how = F.when(F.col("failure").isNull(), "embedded").otherwise("failed")
    reused = state.where("state = 'hit'").select("vector_hash", F.lit("reused").alias("how"), F.lit("").alias("failure"))
    return reused.unionByName(made.select("vector_hash", how.alias("how"), F.coalesce("failure", F.lit("")).alias("failure")))


def hash_embedder(dim: int = 8) -> Callable[[list[str]], list]:
    """A deterministic stand-in for a model: components from the SHA-256 of a text, in four-digit groups."""

    def embed(texts: list[str]) -> list:
        from hashlib import sha256

        out = []
        for t in texts:
            h = sha256(t.encode()).hexdigest()
            out.append([int(h[4 * i : 4 * i + 4], 16) / 32768 - 1 for i in range(dim)])
        return out

    return embed
