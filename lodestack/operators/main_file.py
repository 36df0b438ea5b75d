"""The main file of a TeX project, by what its files hold and how they are named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of main and of supporting files, weights of signals, limits of usable files.
MAIN_NAME = r"(?:^|/)(?:main|paper|article|ms|manuscript)\.tex$|_main\.tex$|(?:^|/)main_[^/]*$|/main"
SUPPORT_NAME = "defs|macro|preamble|supplement|appendix"
SECTION, INCLUDE = r"\\(?:section|subsection|subsubsection)\*?\{", r"\\(?:input|include)\s*\{"
DOCUMENT, MAKETITLE = r"\\begin\{document\}", r"\\maketitle"
ABSTRACT, TITLE = r"(?i)\\begin\{abstract\}|\\abstract\b", r"\\title\s*(?:\[[^\]]*\]\s*)?\{\s*[^\s{}]"
PROSE_MOST, PROSE_UNIT, PROSE_LEAST, SCORE_LEAST = 20000, 80, 120, 120
WEIGHTS = {"document": 100, "abstract": 80, "maketitle": 20, "title": 20}
# what is no prose: comments, environments, commands with their first arguments, signs
NO_PROSE = (r"%.*", r"\\begin\{[^{}]+\}|\\end\{[^{}]+\}", r"\\[A-Za-z]+\*?(?:\[[^\]]*\])?(?:\{[^{}]*\})?", r"[^A-Za-z0-9一-鿿]+")
POOLS = ("preferred_main", "non_support", "all_usable")


def prose_length(tex: Column) -> Column:
    for pattern in NO_PROSE:
        tex = F.regexp_replace(tex, pattern, " ")
    return F.least(F.length(F.trim(tex)), F.lit(PROSE_MOST))


def signals(files: DataFrame) -> DataFrame:
    """files (project, path, tex) with prose, sections, includes, markers, roles of names, score and whether a file can be the main one."""
    tex, low = F.coalesce("tex", F.lit("")), F.lower("path")
    told = F.struct(
        prose_length(tex).alias("prose"), F.regexp_count(tex, F.lit(SECTION)).alias("sections"), F.regexp_count(tex, F.lit(INCLUDE)).alias("includes"),
        tex.rlike(DOCUMENT).alias("document"), tex.rlike(ABSTRACT).alias("abstract"), tex.rlike(MAKETITLE).alias("maketitle"), tex.rlike(TITLE).alias("title"),
        low.rlike(MAIN_NAME).alias("main_name"), low.rlike(SUPPORT_NAME).alias("support"),
    )
    # generated, so that later tests read the signals and do not find them anew
    rows = files.select("project", "path", F.inline(F.array(told)))
    score = F.floor(F.col("prose") / PROSE_UNIT) + F.col("sections") * 20 + F.col("includes") * 15
    for name, weight in WEIGHTS.items():
        score = score + F.col(name).cast("int") * weight
    body = (F.col("prose") >= PROSE_LEAST) & (F.col("document") | F.col("abstract") | (F.col("sections") >= 2))
    wrapper = F.col("main_name") & (F.col("includes") > 0) & (F.col("document") | F.col("title"))
    rows = rows.withColumn("score", score.cast("long")).withColumn("usable", (body & ((F.col("score") >= SCORE_LEAST) | F.col("main_name"))) | wrapper)
    like = F.col("main_name") | F.col("document") | F.col("abstract") | F.col("title")
    return rows.withColumn("pool", F.when(F.col("support"), 2).when(like, 0).otherwise(1))


def main_files(files: DataFrame) -> DataFrame:
    """(project, path, score, prose, pool, usable_files): the main file of each project that has a usable one.

    Files that look like a main one and not like a supporting one go first, then others that do not
    support, then all; within these the largest score, the most prose, the smallest path. Null texts
    are empty; of rows that repeat a path the best one counts.
    """
    usable = signals(files.where("project IS NOT NULL AND path IS NOT NULL")).where("usable")
    order = F.struct("pool", (-F.col("score")).alias("s"), (-F.col("prose")).alias("p"), "path")
    best = usable.groupBy("project").agg(F.min_by(F.struct("path", "score", "prose", "pool"), order).alias("b"), F.count(F.lit(1)).alias("usable_files"))
    name = F.element_at(F.array(*[F.lit(p) for p in POOLS]), F.col("b.pool") + 1)
    return best.select("project", "b.path", "b.score", "b.prose", name.alias("pool"), "usable_files")
