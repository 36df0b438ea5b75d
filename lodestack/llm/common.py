"""What several operators share: written intermediate tables and packed payloads."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder for cut lineage: spark.checkpoint.dir; where that is unset, a new local one, on a local master only (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-lodestack-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back, so that lost executors cost no recomputation of its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestack-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`docs` without the rows that found (_gid, _gh, kept: id, hash of the text, row of it) drops; of rows that repeat a kept id and text one stays."""
    found = written(found)
    text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))

    def met(keys: DataFrame, how: str) -> DataFrame:
        return docs.join(keys, docs[id_col].eqNullSafe(F.col("_gid")) & (text == F.col("_gh")), how)

    again = written(found.where("kept").groupBy("_gid", "_gh").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").drop("_rows"))
    once = met(found.where(~F.col("kept")).select("_gid", "_gh").union(again), "left_anti")
    repeated = met(again, "left_semi").withColumn("_gh", text).dropDuplicates([id_col, "_gh"]).drop("_gh")
    return once.unionByName(repeated)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any kind as one compressed payload; unpack() needs the same kinds again."""
    heads = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    raw = heads + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    n = int.from_bytes(payload[:8], "little")
    raw = pa.decompress(payload[8:], decompressed_size=n, codec="zstd", asbytes=True)
    sizes = np.frombuffer(raw, "<i8", len(kinds))
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(raw, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def sizes_of(column: pa.Array) -> list[int]:
    """Bytes of each text; null counts 0."""
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def groups_of(sizes: list[int], most: int):
    """Slices of consecutive rows whose sizes add up to about `most`, at least one row each."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))
