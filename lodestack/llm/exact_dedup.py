"""Exact dedup by deterministic block naming, with DataFrame functions only.

Texts are cut into fixed-size byte blocks. Distinct blocks are sorted and numbered, so a
block's name is an integer that stands for its whole content. Adjacent names are paired,
distinct pairs are sorted and numbered again, and so on until one name is left for each
text: two texts have the same name (and number of blocks) exactly if they are identical.
A block whose hash occurs once cannot occur in another text, so its text needs no name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import one_of_each, written


def _blocks(texts: DataFrame, size: int) -> DataFrame:
    raw = F.col("_t").cast("binary")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("_t") / size)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(raw, i * size + 1, F.lit(size)))
    return texts.select("_id", "_h", count.alias("_n"), F.posexplode(cut).alias("_i", "_block"))


def _numbered(rows: DataFrame, *key: str) -> DataFrame:
    """Distinct keys, sorted, each with an integer name; written, so that names never change.

    The order is that of a 64-bit hash, then of the key: ranges are found on samples of the hash,
    so that no blocks go to the driver.
    """
    distinct = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_order", F.xxhash64(*key))
    ordered = distinct.repartitionByRange("_order").sortWithinPartitions("_order", *key)
    return written(ordered.select(*key, F.monotonically_increasing_id().alias("_name")))


def _same(left: DataFrame, right: DataFrame, *key: str) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & left[k].eqNullSafe(right[k])
    return out


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8192) -> DataFrame:
    """One row (_id, _h, _n, _name) for each text that may have copies; equal (_n, _name) means equal text.

    _h is xxhash64 of the text: with the id it tells rows apart that repeat an id.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    blocks = _blocks(texts.withColumn("_h", F.xxhash64("_t")), block_bytes).withColumn("_bh", F.xxhash64("_block"))
    shared = written(blocks.groupBy("_bh").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_bh"))
    rows = written(blocks.join(shared, "_bh", "left_semi"))
    whole = rows.groupBy("_id", "_h").agg(F.countDistinct("_i").alias("_got"), F.first("_n").alias("_n")).where("_got = _n")
    whole = whole.select(F.col("_id").alias("_wid"), F.col("_h").alias("_wh"))
    rows = rows.join(whole, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_h") == F.col("_wh")), "left_semi")
    rows = rows.select("_id", "_h", "_n", "_i", "_block")
    names = _numbered(rows, "_block")
    level = written(rows.join(names, "_block").select("_id", "_h", "_n", "_i", "_name"))
    most = level.agg(F.max("_n")).first()[0] or 1
    width = 1
    done = level.where("_n = 1").select("_id", "_h", "_n", "_name")
    while width < most:
        width *= 2
        half = F.expr("_i % 2 = 0")
        pairs = level.where(F.col("_n") > width // 2).groupBy("_id", "_h", "_n", F.expr("_i div 2").cast("int").alias("_i")).agg(
            F.max(F.when(half, F.col("_name"))).alias("_a"), F.coalesce(F.max(F.when(~half, F.col("_name"))), F.lit(-1)).alias("_b")
        )
        names = _numbered(pairs, "_a", "_b")
        level = written(pairs.join(names, ["_a", "_b"]).select("_id", "_h", "_n", "_i", "_name"))
        done = done.unionByName(level.where((F.col("_n") > width // 2) & (F.col("_n") <= width)).select("_id", "_h", "_n", "_name"))
    return done.dropDuplicates(["_id", "_h", "_n", "_name"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8192, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of `docs`: the id, keep_id, group_size, kept and the `extra` columns made of its row.

    Of identical texts the row with the largest id stays. Null texts count as empty; a null id
    loses against any other. Rows that repeat both id and text are one document written twice:
    both count in group_size and share `kept`. Other columns of docs are not read, so their
    names cannot clash. Empty input gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"), *[c.alias(k) for k, c in (extra or {}).items()])
    ident = written(identities(docs, id_col, text_col, block_bytes)).select(
        F.col("_id").alias("_iid"), F.col("_h").alias("_ih"), "_n", "_name"
    )
    on = F.col("_id").eqNullSafe(F.col("_iid")) & (F.col("_h") == F.col("_ih"))
    groups = rows.select("_id", "_h").join(ident, on).groupBy("_n", "_name").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
    # written, so that the join below can split a hot group over tasks
    out = rows.join(ident, on, "left").join(written(groups), ["_n", "_name"], "left")
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return out.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), *(extra or {}),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each text, the one that exact_dedup() keeps; all columns stay.

    Where the kept id and text stand in several rows, any one of them stays.
    """
    text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = exact_dedup(docs, id_col, text_col, extra={"_gh": text}).where("group_size > 1")
    return one_of_each(docs, found.select(F.col(id_col).alias("_gid"), "_gh", "kept"), id_col, text_col)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs, extra={"text_sha256": F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)})


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
