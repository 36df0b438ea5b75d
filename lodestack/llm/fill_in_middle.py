"""Fill-in-the-middle transformation by regular expressions with counted quantifiers.

A unit is one code point. `regexp_count` gives the number of units of a text; two cuts are
drawn from a hash of the document's id, and a pattern made for the row, `\\A(unit{a}+)(unit{m}+)(unit*+)\\z`,
captures prefix, middle and suffix in one match, whose replacement is the rearranged text.
Possessive quantifiers never go back, so that a match is one walk over the text. All steps are
Spark expressions over one row: no shuffle, and no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 90  # of 100 documents, those that are rearranged
SPM = 20  # of 100 of these, those whose suffix comes first
UNIT = "(?s:.)"  # a code point, line ends included
RUN = 256  # units that are counted together


def units(text: Column) -> Column:
    """Number of code points: whole runs of RUN units are counted as one match, then what these leave."""
    runs = F.regexp_count(text, F.lit(f"{UNIT}{{{RUN}}}+")).cast("long")
    return runs * RUN + F.regexp_count(F.regexp_replace(text, f"{UNIT}{{{RUN}}}+", ""), F.lit(UNIT))


def draw(id_col: str, n: int) -> Column:
    """The n-th (from 1) 8-digit group of the hash of an id, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * n - 7, 8), 16, 10).cast("long")


def _layouts() -> tuple[str, str]:
    """Replacements of a match of (prefix)(middle)(suffix): prefix first, and suffix first."""
    return f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM) -> DataFrame:
    """`docs` with fim_n, fim_form (plain, psm, spm), fim_prefix, fim_middle (code points; null if plain) and fim_text.

    Null texts count as empty; empty texts and those that hold a marker stay plain. A null id draws
    as an empty one. Equal rows give equal results; columns of these names are replaced, all others stay.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.contains("_fim_t", F.lit(PREFIX)) | F.contains("_fim_t", F.lit(SUFFIX)) | F.contains("_fim_t", F.lit(MIDDLE))
    plain = (F.col("_fim_t") == "") | marked | (draw(id_col, 3) % 100 >= rate)
    one, two = draw(id_col, 1) % (F.col("fim_n") + 1), draw(id_col, 2) % (F.col("fim_n") + 1)
    pattern = F.format_string(r"\A(%1$s{%2$d}+)(%1$s{%3$d}+)(%1$s*+)\z", F.lit(UNIT), F.col("fim_prefix"), F.col("fim_middle"))
    psm_first, spm_first = _layouts()
    layout = F.when(F.col("fim_form") == "spm", spm_first).otherwise(psm_first)
    is_plain = F.col("fim_form") == "plain"
    out = docs.withColumn("_fim_t", text).withColumn("fim_n", units(F.col("_fim_t")))
    out = out.withColumn("fim_form", F.when(plain, "plain").when(draw(id_col, 4) % 100 < spm, "spm").otherwise("psm"))
    out = out.withColumn("fim_prefix", F.when(~is_plain, F.least(one, two))).withColumn("fim_middle", F.when(~is_plain, F.greatest(one, two) - F.least(one, two)))
    return out.withColumn("fim_text", F.when(is_plain, F.col("_fim_t")).otherwise(F.regexp_replace("_fim_t", pattern, layout))).drop("_fim_t")


def restored(text: Column, form: Column) -> Column:
    """The text before the transformation, from what it returned; a text without markers has exactly one reading."""
    first = F.regexp_replace(text, rf"\A{PREFIX}((?s:.)*?){SUFFIX}((?s:.)*?){MIDDLE}((?s:.)*+)\z", "$1$3$2")
    second = F.regexp_replace(text, rf"\A{SUFFIX}((?s:.)*?){PREFIX}((?s:.)*?){MIDDLE}((?s:.)*+)\z", "$2$3$1")
    return F.when(form == "psm", first).when(form == "spm", second).otherwise(text)


def query(spark, sf_dir: str) -> DataFrame:
    out = transform(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("fim_n").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix").alias("prefix_chars"), F.col("fim_middle").alias("middle_chars"),
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"), F.sha2(restored(F.col("fim_text"), F.col("fim_form")).cast("binary"), 256).alias("restored_sha256"),
    )


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
g AS (SELECT *, length(t) AS n, ('0x' || substr(h, 1, 8))::UBIGINT::BIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT::BIGINT AS h2,
      ('0x' || substr(h, 17, 8))::UBIGINT::BIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain'
           WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
         ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""
