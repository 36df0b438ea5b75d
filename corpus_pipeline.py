"""Cleaning of the documents table in five stages: quality, exact copies, near copies, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import exact_dedup, line_quality, ngram_join, packing, pii
from lodestack.llm.common import written

KEEP_SCORE = 0.7  # least quality score of a document that stays
CAPACITY = 2048  # words of a bin


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, fitted on the labelled ones, does not reject. Columns stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~line_quality.held_out())
    model = line_quality.fit_documents(docs, labels)
    return line_quality.score(docs, model, out_col="_quality").where(F.col("_quality") >= KEEP_SCORE).drop("_quality")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the document of the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by n-gram similarity of 0.8 or more, that of the smallest id."""
    return ngram_join.drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked; n_chars follows where a text changed."""
    text = F.col("text")
    out = pii.mask_pii(docs.withColumn("_before", text))
    changed = ~text.eqNullSafe(F.col("_before"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("_before")


def bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, offset, length, bin_id, bin_used): every document in bins of CAPACITY words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", packing.words(F.col("text")).alias("n_tokens"), F.sha2(text, 256).alias("cluster"))
    return packing.pack(rows, capacity=CAPACITY)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", bins),
]

ORACLE_SQL = None  # the classifier and best fit cannot be written in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
