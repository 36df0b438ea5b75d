"""Knowledge-graph records: chunks, entities, relationships, edges, and their hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.functions import ids, text


def chunks(docs: DataFrame) -> DataFrame:
    """(chunk_id, content, sources, last_source) for docs (source_id, content, ord): one chunk for each content.

    The last occurrence gives the source; all sources are kept, sorted. Contents are cleaned first
    and empty ones dropped.
    """
    rows = docs.select("source_id", text.sanitised(F.col("content")).alias("content"), "ord").where("content <> ''")
    return rows.groupBy("content").agg(F.sort_array(F.collect_set("source_id")).alias("sources"), F.max_by("source_id", "ord").alias("last_source")).withColumn("chunk_id", ids.md5_id(F.col("content"), "chunk-"))


def last_wins(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def resolved(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """rows with the chunk of their source_id, UNKNOWN where there is none; mapping is (source_id, chunk_id)."""
    return rows.join(mapping, "source_id", "left").withColumn("chunk_id", F.coalesce("chunk_id", F.lit("UNKNOWN")))


def source_map(made: DataFrame) -> DataFrame:
    return made.select(F.explode("sources").alias("source_id"), "chunk_id").groupBy("source_id").agg(F.max("chunk_id").alias("chunk_id"))
