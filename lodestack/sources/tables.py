"""Reading the given tables and the corpus views made of them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_path(doc_id: Column) -> Column:
    """A relative path for each document, spread over the folders of a corpus."""
    name = F.concat(F.lit("doc-"), doc_id.cast("string"), F.lit(".md"))
    folder = F.element_at(
        F.array(*[F.lit(x) for x in ("raw/clip/2401/", "raw/clip/2402/", "concepts/", "queries/", "entities/", "comparisons/", "_meta/", "notes/")]),
        (doc_id % 8 + 1).cast("int"),
    )
    return F.concat(folder, name)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a path and a title line for each."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.withColumn("path", doc_path(F.col("doc_id")))


def conversations_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, path, markdown): one document for each conversation, a `## role` section for each turn."""
    turns = read(spark, sf_dir, "conversations")
    part = F.concat(F.lit("## "), F.col("role"), F.lit("\n"), F.col("text"))
    parts = F.array_sort(F.collect_list(F.struct(F.col("turn"), part.alias("part"))))
    joined = F.array_join(F.transform(parts, lambda p: p["part"]), "\n")
    out = turns.groupBy("conv_id").agg(joined.alias("markdown"))
    return out.withColumn("path", F.concat(F.lit("raw/clip/2401/conv-"), F.col("conv_id").cast("string"), F.lit(".md")))


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset, a temporary one, on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-lodestack-")
    return f"{base.rstrip('/')}/lodestack-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written to a scratch folder and read back, for results that several later steps read."""
    at = scratch(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def rewrite_folders(rows: DataFrame, folders: DataFrame, path: str, part: str) -> None:
    """Write `rows` over those folders of a table that `folders` lists; all others stay as they are.

    rows: the whole content of these folders. Each of them also gets a row of nulls, which read_folders
    leaves out, since a folder without new files would keep its old ones. What is written replaces a
    folder only when all of it is there, so that rows may come from the same table.
    """
    rows = rows.unionByName(folders.select(*[F.col(part) if f.name == part else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]))
    rows.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def read_folders(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path).where(F.col(key).isNotNull())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
