"""The relevance planner: candidates of several routes become an ordered, bounded choice of evidence.

All steps are partitioned by query. Selection looks sequential, but each test reads only what
was accepted of the candidate's own source, so that it is a small fold for each (query, source)
followed by one global order; groups are bounded by the candidate budget of a query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAMILIES = ("navigation", "section", "lexical")
WEIGHTS = {"local": 0.15, "source": 0.05, "terms": 0.50, "quality": 0.30}
SECTION_QUALITY = {"methodology": 1.0, "results": 1.0, "claims": 1.0, "summary": 0.95, "abstract": 0.85, "questions": 0.75, "future": 0.75}
PROSE = ("raw_section", "raw.section", "compiled_chunk")


def family_order(family: Column) -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), family)


def candidate_budget(top_k: Column) -> Column:
    """Candidates of a query that are looked at: five a hit, between 40 and 200."""
    return F.least(F.lit(200), F.greatest(F.lit(40), 5 * top_k)).cast("int")


def scope_budget(top_k: Column) -> Column:
    """Sources of a query that are looked at: three a hit, 20 at least, within the candidate budget."""
    return F.least(candidate_budget(top_k), F.greatest(F.lit(20), 3 * top_k)).cast("int")


def route_ranks(candidates: DataFrame) -> DataFrame:
    """Rank within (query, family): score descending with what is no finite number last, then type and id."""
    score = F.when(F.isnan("raw_score") | (F.abs("raw_score") == float("inf")), None).otherwise(F.col("raw_score"))
    w = Window.partitionBy("query_id", "route_family").orderBy(score.desc_nulls_last(), "record_type", "record_id")
    return candidates.withColumn("raw_score", score).withColumn("route_rank", F.row_number().over(w).cast("int"))


def merged(candidates: DataFrame) -> DataFrame:
    """One row for each (query, type, id): best rank and largest score of each family, union of routes, a representative."""
    keys = ["query_id", "record_type", "record_id"]
    fine = candidates.where("coalesce(record_type, '') <> '' AND coalesce(record_id, '') <> ''")
    per = fine.groupBy(*keys, "route_family").agg(F.min("route_rank").alias("rank"), F.max("raw_score").alias("score"))
    per = per.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("route_family", "rank")))).alias("route_ranks"), F.min("rank").alias("route_rank"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("score").isNotNull(), F.struct("route_family", "score"))))).alias("raw_scores"),
    )
    order = F.struct("route_rank", family_order(F.col("route_family")).alias("f"), "source_path", "source_id", "content_hash")
    keep = [c for c in candidates.columns if c not in {*keys, "route_family", "route_rank", "raw_score"}]
    best = fine.groupBy(*keys).agg(F.min_by(F.struct(*keep), order).alias("r"), F.array_sort(F.collect_set("route_family")).alias("routes"))
    return best.select(*keys, "r.*", "routes").join(per, keys)


def canonical_sources(rows: DataFrame) -> DataFrame:
    """Adds source_key: raw notes, sections and method atoms of one stem share the path of the raw note, if any candidate has it."""
    stem = F.when(F.col("source_id").startswith("raw_clip:"), F.substr("source_id", F.lit(10))).when(
        F.col("source_id").rlike("^(raw_section|method):[^:]+:"), F.split("source_id", ":")[1])
    key = F.regexp_replace(F.lower(stem), "[^a-z0-9]+", "")
    rows = rows.withColumn("_stem", stem).withColumn("_stem_key", key)
    raw = rows.where("_stem IS NOT NULL AND source_path LIKE 'raw/clip/%'").groupBy("query_id", "_stem_key").agg(F.max_by("source_path", F.struct("record_type", "record_id")).alias("_raw"))
    dated = F.when(F.col("_stem").rlike("^[0-9]{4}"), F.concat(F.lit("raw/clip/"), F.substring("_stem", 1, 4), F.lit("/"), F.col("_stem"), F.lit(".md")))
    source = F.coalesce(F.when(F.col("_stem").isNotNull(), F.coalesce("_raw", dated)), F.nullif("source_path", F.lit("")), F.nullif("source_id", F.lit("")), "record_id")
    return rows.join(raw, ["query_id", "_stem_key"], "left").withColumn("source_key", source).drop("_stem", "_stem_key", "_raw")


def evidence_class(rows: DataFrame) -> DataFrame:
    """Adds is_primary, quality and evidence_kind; evidence_kind is null where a row is no evidence."""
    kind = F.nullif(F.coalesce("section_kind", F.lit("")), F.lit("none"))
    quality = F.lit(0.9)
    for k, q in SECTION_QUALITY.items():
        quality = F.when(kind == k, q).otherwise(quality)
    cases = [
        ((F.col("source_role") == "meta_map") | F.col("source_path").startswith("_meta/"), False, F.lit(0.4), "map"),
        ((F.col("record_type") == "section") & (F.col("source_kind") == "raw"), True, quality, "raw_section"),
        (F.col("span_kind") == "raw.section", True, quality, "raw.section"),
        (F.col("span_kind") == "table.row", True, F.lit(1.0), "table.row"),
        ((F.col("record_type") == "chunk") & (F.col("source_kind") == "compiled"), True, F.lit(0.7), "compiled_chunk"),
        (F.col("span_kind").isin("doc.heading", "heading"), False, F.lit(0.5), "heading"),
        (F.col("span_kind") == "map.row", False, F.lit(0.4), "map_row"),
        (F.col("record_type") == "entity", False, F.lit(0.2), "entity"),
        (F.col("record_type") == "relationship", False, F.lit(0.2), "relationship"),
    ]
    out = F.when(F.lit(False), F.struct(F.lit(True).alias("p"), F.lit(0.0).alias("q"), F.lit("").alias("k")))
    for test, primary, q, name in cases:
        out = out.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(primary).alias("p"), q.cast("double").alias("q"), F.lit(name).alias("k")))
    return rows.withColumn("_c", out).withColumns({"is_primary": F.col("_c.p"), "quality": F.col("_c.q"), "evidence_kind": F.col("_c.k")}).drop("_c")


def source_scope(rows: DataFrame, limit: Column) -> DataFrame:
    """(query_id, source_key, source_score, source_rank): the best value of each family, the top one whole, others by a quarter."""
    per = rows.select("query_id", "source_key", "top_k", F.explode("route_ranks").alias("family", "rank")).groupBy("query_id", "source_key", "top_k", "family").agg(F.max(1.0 / F.col("rank")).alias("v"))
    per = per.groupBy("query_id", "source_key", "top_k").agg(F.round(F.max("v") + 0.25 * (F.sum("v") - F.max("v")), 9).alias("source_score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("source_score"), "source_key")
    return per.withColumn("source_rank", F.row_number().over(w).cast("int")).where(F.col("source_rank") <= limit).drop("top_k")


def scored(rows: DataFrame, coverage: Column) -> DataFrame:
    """Adds score; exact headings become primary. rows hold source_rank, route_rank, quality; coverage is the share of terms found."""
    total = WEIGHTS["local"] / F.col("route_rank") + WEIGHTS["source"] / F.col("source_rank") + WEIGHTS["terms"] * F.col("coverage") + WEIGHTS["quality"] * F.col("quality")
    exact = (F.col("evidence_kind") == "heading") & (F.col("coverage") >= 0.75) & (F.round(F.col("coverage") * F.col("n_terms")) >= 3)
    return rows.withColumn("coverage", coverage).withColumn("score", F.round(total, 9)).withColumn("is_primary", F.col("is_primary") | exact)


def order_columns() -> list:
    return [F.desc("score"), F.asc("source_rank"), F.asc("source_key"), F.asc("start_line"), F.asc("record_id")]


def deduplicated(rows: DataFrame) -> DataFrame:
    """One row for each (query, source, hash): primary before others, then the evidence order."""
    w = Window.partitionBy("query_id", "source_key", "evidence_hash").orderBy(F.desc("is_primary"), *order_columns())
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _fold(cards: Column) -> Column:
    """Stage of every card of one (query, source): 0 taken at once, 1-3 deferred classes, -1 left out; both tiers in turn.

    A source gives at most three cards, two of them prose, one of each group; deferred cards refill
    in the order prose, compiled chunk, repeated group. Cards come primary first, in evidence order.
    """
    return _tier(cards, False, _tier(cards, True, None))["log"]


def _tier(cards: Column, tier: bool, before: Column | None) -> Column:
    """State of one source after its primary cards (tier) or the others, going on from `before`."""
    mine = F.filter(cards, lambda c: c["is_primary"] == F.lit(tier))
    raw = F.exists(mine, lambda c: c["kind"].isin("raw_section", "raw.section"))
    shape = "struct<n:int,prose:int,groups:array<string>,log:array<struct<id:string,stage:int>>,late:array<struct<id:string,cls:int,prose:boolean,pos:int>>>"
    start = F.struct(
        F.lit(0).alias("n") if before is None else before["n"].alias("n"), F.lit(0).alias("prose") if before is None else before["prose"].alias("prose"),
        F.array().cast("array<string>").alias("groups") if before is None else before["groups"].alias("groups"),
        F.array().cast("array<struct<id:string,stage:int>>").alias("log") if before is None else before["log"].alias("log"),
        F.array().cast("array<struct<id:string,cls:int,prose:boolean,pos:int>>").alias("late"),
    ).cast(shape)

    def step(acc, c):
        prose = c["kind"].isin(*PROSE)
        cls = F.when((c["kind"] == "compiled_chunk") & raw, 2).when(F.array_contains(acc["groups"], c["grp"]), 3).when(prose & (acc["prose"] >= 2), 1).otherwise(0)
        take = F.struct(
            (acc["n"] + 1).alias("n"), (acc["prose"] + prose.cast("int")).alias("prose"), F.array_append(acc["groups"], c["grp"]).alias("groups"),
            F.array_append(acc["log"], F.struct(c["id"].alias("id"), F.lit(0 if tier else 4).alias("stage"))).alias("log"), acc["late"].alias("late"),
        ).cast(shape)
        defer = F.struct(acc["n"].alias("n"), acc["prose"].alias("prose"), acc["groups"].alias("groups"), acc["log"].alias("log"),
                         F.array_append(acc["late"], F.struct(c["id"].alias("id"), cls.alias("cls"), prose.alias("prose"), F.size(acc["late"]).alias("pos"))).alias("late")).cast(shape)
        return F.when(acc["n"] >= 3, acc).when(cls == 0, take).otherwise(defer)

    taken = F.aggregate(mine, start, step)
    late = F.array_sort(F.transform(taken["late"], lambda x: F.struct(x["cls"].alias("cls"), x["pos"].alias("pos"), x["id"].alias("id"), x["prose"].alias("prose"))))

    def refill(acc, x):
        more = F.struct(
            (acc["n"] + 1).alias("n"), (acc["prose"] + x["prose"].cast("int")).alias("prose"), acc["groups"].alias("groups"),
            F.array_append(acc["log"], F.struct(x["id"].alias("id"), (x["cls"] + F.lit(0 if tier else 4)).alias("stage"))).alias("log"), acc["late"].alias("late"),
        ).cast(shape)
        return F.when(acc["n"] >= 3, acc).otherwise(more)

    return F.aggregate(late, taken, refill)


def select_focused(rows: DataFrame) -> DataFrame:
    """rows (deduplicated, with top_k) that the focused rules choose, with `position` from 1."""
    w = Window.partitionBy("query_id").orderBy(*order_columns())
    rows = rows.withColumn("_pos", F.row_number().over(w))
    card = F.struct("_pos", F.concat_ws(":", "record_type", "record_id").alias("id"), "is_primary", F.col("evidence_kind").alias("kind"), F.col("evidence_group").alias("grp"))
    logs = rows.groupBy("query_id", "source_key").agg(F.array_sort(F.collect_list(card)).alias("cards"))
    logs = logs.select("query_id", "source_key", F.explode(_fold(F.col("cards"))).alias("l")).select("query_id", "source_key", F.col("l.id").alias("_id"), F.col("l.stage").alias("_stage"))
    chosen = rows.withColumn("_id", F.concat_ws(":", "record_type", "record_id")).join(logs, ["query_id", "source_key", "_id"])
    w = Window.partitionBy("query_id").orderBy("_stage", "_pos")
    return chosen.withColumn("position", F.row_number().over(w).cast("int")).where(F.col("position") <= F.col("top_k")).drop("_pos", "_id", "_stage")


def select_coverage(rows: DataFrame) -> DataFrame:
    """One card of each source in order of first appearance (its summary if there is one), then up to two a source; primary first."""
    w = Window.partitionBy("query_id").orderBy(*order_columns())
    by = Window.partitionBy("query_id", "source_key")
    rows = rows.withColumn("_pos", F.row_number().over(w)).withColumn("_any", F.max("is_primary").over(by))
    tier = F.when(F.col("is_primary"), 0).otherwise(1)
    # the tier in which a source first appears gives its representative
    rows = rows.withColumn("_tier", tier).withColumn("_first_tier", F.min("_tier").over(by))
    own = Window.partitionBy("query_id", "source_key", "_tier")
    rows = rows.withColumn("_first", F.min("_pos").over(own))
    rep = F.row_number().over(own.orderBy(F.desc(F.col("evidence_group") == "section:summary"), "_pos")) == 1
    rows = rows.withColumn("_rep", rep & (F.col("_tier") == F.col("_first_tier")))
    fill = F.row_number().over(by.orderBy(F.desc("_rep"), "_tier", "_pos"))
    rows = rows.withColumn("_fill", fill).where("_fill <= 2")
    stage = F.col("_tier") * 2 + F.when(F.col("_rep"), 0).otherwise(1)
    w = Window.partitionBy("query_id").orderBy(stage, F.when(F.col("_rep"), F.col("_first")).otherwise(F.col("_pos")))
    out = rows.withColumn("position", F.row_number().over(w).cast("int")).where(F.col("position") <= F.col("top_k"))
    return out.drop("_pos", "_any", "_tier", "_first_tier", "_first", "_rep", "_fill")
