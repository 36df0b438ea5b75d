"""Registered queries of the relevance planner, over candidates that the three routes find for benchmark texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.functions import ids, text
from lodestack.operators import planner
from lodestack.plans.columns import CID, DOCS
from lodestack.plans.search import BM25, SQL as SEARCH, VEC, bm25, filtered_search, vector_topk
from lodestack.sources.tables import corpus, read, stored

SQL: dict = {}
TOP_K = 6


def facts(spark, d):
    """What the planner needs of each document besides its text."""
    c = corpus(spark, d).join(read(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").cast("int").alias("label")), "doc_id", "left")
    code = F.coalesce(F.col("label"), F.lit(0))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("none", "summary", "abstract", "motivation", "methodology", "results", "future", "limitations", "questions", "other")]), code + 1)
    return c.select(
        "doc_id", F.when(F.col("lang") == "en", "chunk").when(F.col("lang") == "fr", "entity").when(F.col("lang") == "de", "section").otherwise("span").alias("record_type"),
        F.concat(F.lit("r"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("record_id"), F.col("path").alias("source_path"), ids.canonical_id(F.col("path")).alias("source_id"),
        F.col("source").alias("folder"), F.md5("text").alias("content_hash"), F.when(F.col("lang") == "en", "compiled").otherwise("raw").alias("source_kind"), kind.alias("section_kind"),
        ids.role_of_path(F.col("path")).alias("source_role"), F.when(F.col("lang") == "es", F.when(F.col("doc_id") % 2 == 0, "table.row").otherwise("doc.heading")).otherwise("").alias("span_kind"),
        (F.col("doc_id") % 7).cast("int").alias("start_line"),
    )


def candidates(spark, d):
    parts = [("lexical", bm25(spark, d)), ("navigation", vector_topk(spark, d)), ("section", filtered_search(spark, d))]
    rows = None
    for family, hits in parts:
        part = hits.select("query_id", "doc_id", F.lit(family).alias("route_family"), F.col("score").alias("raw_score"))
        rows = part if rows is None else rows.unionByName(part)
    # written first: a join that knows how few the candidates are leaves the facts of all documents where they stand
    return stored(rows).join(facts(spark, d), "doc_id").withColumn("top_k", F.lit(TOP_K))


FACTS = DOCS.replace("WITH d AS", "d AS") + f""", fx AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'chunk' WHEN 'fr' THEN 'entity' WHEN 'de' THEN 'section' ELSE 'span' END AS record_type,
 concat('r', lpad(doc_id::VARCHAR,9,'0')) AS record_id, path AS source_path, {CID} AS source_id, md5(text) AS content_hash, CASE lang WHEN 'en' THEN 'compiled' ELSE 'raw' END AS source_kind,
 ['none','summary','abstract','motivation','methodology','results','future','limitations','questions','other'][coalesce(label,0)+1] AS section_kind,
 CASE split_part(path,'/',1) WHEN '_meta' THEN 'meta_map' WHEN 'raw' THEN 'raw' WHEN 'notes' THEN 'unknown' ELSE 'compiled' END AS source_role,
 CASE WHEN lang = 'es' THEN CASE WHEN doc_id % 2 = 0 THEN 'table.row' ELSE 'doc.heading' END ELSE '' END AS span_kind, doc_id % 7 AS start_line, text, source AS folder FROM d LEFT JOIN embeddings ON vec_id = doc_id)"""
SEC = "sec AS (" + SEARCH["i06_vector_search"].replace("WITH qv AS", "WITH qv2 AS").replace("FROM qv,", "FROM qv2,").replace("(qv.e", "(qv2.e") + ")"
CAND = f"""WITH {BM25}, {VEC}, {SEC}, {FACTS}, cand AS (SELECT query_id, doc_id, route_family, raw_score, record_type, record_id, source_path, source_id, content_hash, source_kind, section_kind, source_role, span_kind, start_line FROM
 (SELECT query_id, doc_id, 'lexical' AS route_family, score AS raw_score FROM bm UNION ALL SELECT query_id, doc_id, 'navigation', score FROM vr UNION ALL SELECT query_id, doc_id, 'section', score FROM sec) JOIN fx USING (doc_id)),
 rk AS (SELECT *, row_number() OVER (PARTITION BY query_id, route_family ORDER BY raw_score DESC, record_type, record_id)::INTEGER AS route_rank FROM cand),
 mg AS (SELECT query_id, record_type, record_id, min(route_rank) AS route_rank, count(*) AS families, string_agg(concat(route_family,'=',route_rank), ',' ORDER BY route_family) AS ranks FROM rk GROUP BY ALL),
 ks AS (SELECT *, CASE WHEN source_id LIKE 'raw_clip:%' THEN source_path ELSE source_path END AS source_key FROM mg JOIN fx USING (record_type, record_id)),
 cl AS (SELECT *, CASE WHEN source_role = 'meta_map' THEN 'map' WHEN record_type = 'section' THEN 'raw_section' WHEN span_kind = 'table.row' THEN 'table.row' WHEN record_type = 'chunk' THEN 'compiled_chunk' WHEN span_kind = 'doc.heading' THEN 'heading' WHEN record_type = 'entity' THEN 'entity' END AS evidence_kind,
  CASE WHEN source_role = 'meta_map' THEN 0.4 WHEN record_type = 'section' THEN CASE WHEN section_kind IN ('methodology','results') THEN 1.0 WHEN section_kind = 'summary' THEN 0.95 WHEN section_kind = 'abstract' THEN 0.85 WHEN section_kind IN ('questions','future') THEN 0.75 ELSE 0.9 END
   WHEN span_kind = 'table.row' THEN 1.0 WHEN record_type = 'chunk' THEN 0.7 WHEN span_kind = 'doc.heading' THEN 0.5 WHEN record_type = 'entity' THEN 0.2 END::DOUBLE AS quality FROM ks),
 sv AS (SELECT query_id, source_key, rk.route_family, max(1.0::DOUBLE/rk.route_rank) AS v FROM cl JOIN rk USING (query_id, record_type, record_id) WHERE evidence_kind IS NOT NULL GROUP BY ALL),
 sc0 AS (SELECT query_id, source_key, round(max(v) + 0.25*(sum(v)-max(v)), 9) AS source_score FROM sv GROUP BY ALL),
 scope AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY source_score DESC, source_key)::INTEGER AS source_rank FROM sc0 QUALIFY source_rank <= 20)"""


def ranked(spark, d):
    return stored(planner.route_ranks(candidates(spark, d)))


def rank_rows(spark, d):
    return ranked(spark, d).select("query_id", "route_family", "record_id", "route_rank")


SQL["e01_route_rank"] = CAND + " SELECT query_id, route_family, record_id, route_rank FROM rk"


def merged(spark, d):
    return stored(planner.canonical_sources(planner.merged(ranked(spark, d))))


def merge_rows(spark, d):
    pairs = F.transform(F.map_entries("route_ranks"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return merged(spark, d).select("query_id", "record_type", "record_id", "route_rank", F.size("routes").cast("long").alias("families"), F.array_join(F.array_sort(pairs), ",").alias("ranks"))


SQL["d08_candidate_merge"] = CAND + " SELECT query_id, record_type, record_id, route_rank, families, ranks FROM mg"


def source_rows(spark, d):
    return merged(spark, d).select("query_id", "record_id", "source_key")


SQL["c18_canonical_source"] = CAND + " SELECT query_id, record_id, source_key FROM ks"


def classed(spark, d):
    return planner.evidence_class(merged(spark, d))


def class_rows(spark, d):
    return classed(spark, d).select("query_id", "record_id", F.coalesce("evidence_kind", F.lit("none")).alias("evidence_kind"), F.coalesce("quality", F.lit(0.0)).alias("quality"))


SQL["b13_evidence_class"] = CAND + " SELECT query_id, record_id, coalesce(evidence_kind,'none') AS evidence_kind, coalesce(quality,0.0)::DOUBLE AS quality FROM cl"


def scope(spark, d, rows=None):
    rows = classed(spark, d) if rows is None else rows
    return planner.source_scope(rows.where("evidence_kind IS NOT NULL"), planner.scope_budget(F.col("top_k")))


for _n in ("d09_source_score", "e02_source_scope"):
    SQL[_n] = CAND + " SELECT query_id, source_key, source_score, source_rank FROM scope"


def evidence(spark, d, rows=None):
    """Scored evidence inside the source scope."""
    rows = classed(spark, d) if rows is None else rows
    rows = rows.where("evidence_kind IS NOT NULL").join(scope(spark, d, rows).select("query_id", "source_key", "source_rank"), ["query_id", "source_key"])
    terms = read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), text.scoring_terms(text.query_terms(F.col("text"))).alias("terms"))
    docs = read(spark, d, "documents").select(F.concat(F.lit("r"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("record_id"), "text")
    # written first, as in candidates(): texts are not shuffled to meet a bounded number of rows a query
    rows = stored(rows.join(terms, "query_id")).join(docs, "record_id").withColumn("n_terms", F.size("terms"))
    share = text.term_coverage(F.col("text"), F.col("terms"), F.when(F.col("evidence_kind") == "table.row", F.col("n_terms")).otherwise(1))
    group = F.when(F.col("section_kind") != "none", F.concat(F.lit("section:"), F.col("section_kind"))).otherwise(F.concat(F.lit("hash:"), F.col("content_hash")))
    out = planner.scored(rows.withColumn("_share", share).drop("text", "terms"), F.col("_share")).drop("_share")
    return stored(out.withColumn("evidence_hash", F.col("content_hash")).withColumn("evidence_group", group))


TERMS = "(SELECT list(t ORDER BY p) FROM (SELECT t, min(p) AS p FROM (SELECT unnest(x) AS t, unnest(range(1, len(x)+1)) AS p FROM (SELECT list_transform(regexp_extract_all(b.text,'[A-Za-z0-9]+'), lambda s: lower(s)) AS x)) WHERE length(t) >= 2 GROUP BY t ORDER BY p LIMIT 32))"
STOP = "['" + "','".join(text.STOPWORDS) + "']"
EV = CAND + f""", tm AS (SELECT query_id, CASE WHEN len(f) > 0 THEN f ELSE t END AS terms FROM (SELECT *, list_filter(t, lambda s: NOT list_contains({STOP}, s)) AS f FROM (SELECT item_id AS query_id, {TERMS} AS t FROM benchmark b))),
 ev AS (SELECT cl.*, source_rank, len(list_filter(terms, lambda s: contains(lower(text), s)))::DOUBLE / len(terms) AS coverage, len(terms) AS n_terms FROM cl JOIN scope USING (query_id, source_key) JOIN tm USING (query_id) WHERE evidence_kind IS NOT NULL),
 es AS (SELECT *, round(0.15/route_rank + 0.05/source_rank + 0.5*coverage + 0.3*quality, 9) AS score, evidence_kind IN ('raw_section','table.row','compiled_chunk') OR (evidence_kind = 'heading' AND coverage >= 0.75 AND round(coverage*n_terms) >= 3) AS is_primary,
  CASE WHEN section_kind <> 'none' THEN concat('section:', section_kind) ELSE concat('hash:', content_hash) END AS evidence_group FROM ev),
 dd AS (SELECT * FROM es QUALIFY row_number() OVER (PARTITION BY query_id, source_key, content_hash ORDER BY is_primary DESC, score DESC, source_rank, source_key, start_line, record_id) = 1)"""


def score_rows(spark, d):
    return evidence(spark, d).select("query_id", "record_id", "score", "is_primary", F.round("coverage", 6).alias("coverage"))


SQL["i09_relevance_score"] = EV + " SELECT query_id, record_id, score, is_primary, round(coverage,6) AS coverage FROM es"


def order_rows(spark, d):
    w = Window.partitionBy("query_id").orderBy(*planner.order_columns())
    return planner.deduplicated(evidence(spark, d)).withColumn("place", F.row_number().over(w).cast("int")).select("query_id", "record_id", "place")


for _n in ("e04_evidence_order", "d10_evidence_dedupe"):
    SQL[_n] = EV + " SELECT query_id, record_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, source_rank, source_key, start_line, record_id)::INTEGER AS place FROM dd"


def shared_sources(spark, d):
    """Classed candidates whose source is that of their document, so that sources have many records."""
    return classed(spark, d).withColumn("source_key", F.coalesce("folder", F.lit("")))


def shared_evidence(spark, d):
    return stored(planner.deduplicated(evidence(spark, d, stored(shared_sources(spark, d)))))


CHOICE = ("query_id", "position", "record_type", "record_id", "source_key", "score")


def focused(spark, d):
    """At most three cards of a source, two of them prose, one of each group; over sources of many records."""
    return planner.select_focused(shared_evidence(spark, d)).select(*CHOICE)


def coverage(spark, d):
    """A card of each source, its summary if there is one, then a second one; over sources of many records."""
    return planner.select_coverage(shared_evidence(spark, d)).select(*CHOICE)


KEY = "CASE WHEN source_id LIKE 'raw_clip:%' THEN source_path ELSE source_path END AS source_key"
SHARED = EV.replace(KEY, "coalesce(folder, '') AS source_key").replace("WITH ", "WITH RECURSIVE ", 1) + ", o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, source_rank, source_key, start_line, record_id) AS pos, NOT is_primary AS tier FROM dd)"
# cards of a source in turn; after the cards of each tier a step that refills from those put off
FOCUSED = """, raw AS (SELECT *, bool_or(evidence_kind = 'raw_section') OVER (PARTITION BY query_id, source_key, tier) AS raw FROM o),
 steps AS (SELECT *, row_number() OVER (PARTITION BY query_id, source_key ORDER BY tier, refill, pos) AS i FROM (SELECT query_id, source_key, tier, false AS refill, pos, evidence_kind AS kind, evidence_group AS grp, raw FROM raw
  UNION ALL SELECT DISTINCT query_id, source_key, x.tier, true, 0, '', '', false FROM o, (VALUES (false), (true)) x(tier))),
 fold(query_id, source_key, i, n, prose, groups, log, late) AS (
  SELECT DISTINCT query_id, source_key, 0::BIGINT, 0::BIGINT, 0::BIGINT, []::VARCHAR[], []::STRUCT(stage INTEGER, pos BIGINT)[], []::STRUCT(cls INTEGER, pos BIGINT, p BOOLEAN)[] FROM o
  UNION ALL SELECT query_id, source_key, i, CASE WHEN refill THEN n + len(more) WHEN take THEN n + 1 ELSE n END, prose + CASE WHEN refill THEN len(list_filter(more, lambda x: x.p)) WHEN take AND p THEN 1 ELSE 0 END,
   CASE WHEN take THEN list_append(groups, grp) ELSE groups END,
   CASE WHEN refill THEN list_concat(log, list_transform(more, lambda x: {'stage': (x.cls + CASE WHEN tier THEN 4 ELSE 0 END)::INTEGER, 'pos': x.pos})) WHEN take THEN list_append(log, {'stage': CASE WHEN tier THEN 4 ELSE 0 END::INTEGER, 'pos': pos}) ELSE log END,
   CASE WHEN refill THEN []::STRUCT(cls INTEGER, pos BIGINT, p BOOLEAN)[] WHEN n < 3 AND NOT take THEN list_append(late, {'cls': cls, 'pos': pos, 'p': p}) ELSE late END
  FROM (SELECT *, NOT refill AND n < 3 AND cls = 0 AS take, list_slice(list_sort(late), 1, 3 - n) AS more FROM (
   SELECT s.*, n, prose, groups, log, late, kind IN ('raw_section', 'compiled_chunk') AS p, CASE WHEN kind = 'compiled_chunk' AND raw THEN 2 WHEN list_contains(groups, grp) THEN 3 WHEN kind IN ('raw_section', 'compiled_chunk') AND prose >= 2 THEN 1 ELSE 0 END::INTEGER AS cls
   FROM fold f JOIN steps s ON s.query_id = f.query_id AND s.source_key = f.source_key AND s.i = f.i + 1))),
 fin AS (SELECT query_id, source_key, unnest(log) AS l FROM fold QUALIFY row_number() OVER (PARTITION BY query_id, source_key ORDER BY i DESC) = 1),
 focus AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY l.stage, l.pos)::INTEGER AS position FROM fin)"""
COVERAGE = """, s AS (SELECT query_id, source_key, list({'tier': tier, 'pos': pos, 'summary': evidence_group = 'section:summary'} ORDER BY tier, pos) AS cards FROM o GROUP BY ALL),
 t AS (SELECT query_id, source_key, list_filter(cards, lambda c: c.tier = cards[1].tier) AS mine, cards FROM s),
 u AS (SELECT query_id, source_key, mine[1].tier AS tier, mine[1].pos AS entry, coalesce(list_filter(mine, lambda c: c.summary)[1].pos, mine[1].pos) AS rep, cards FROM t),
 v AS (SELECT query_id, source_key, tier, 0 AS phase, entry AS place, rep AS pos FROM u UNION ALL
  SELECT query_id, source_key, c.tier, 1, c.pos, c.pos FROM (SELECT *, list_filter(cards, lambda c: c.pos <> rep)[1] AS c FROM u) WHERE c IS NOT NULL),
 cover AS (SELECT query_id, source_key, pos, row_number() OVER (PARTITION BY query_id ORDER BY tier, phase, place)::INTEGER AS position FROM v)"""
FOCUS = f"SELECT query_id, position, record_type, record_id, source_key, score FROM (SELECT query_id, source_key, l.pos AS pos, position FROM focus) JOIN o USING (query_id, source_key, pos) WHERE position <= {TOP_K}"
COVER = f"SELECT query_id, position, record_type, record_id, source_key, score FROM cover JOIN o USING (query_id, source_key, pos) WHERE position <= {TOP_K}"
SQL["e05_focused_selection"] = f"{SHARED}{FOCUSED} {FOCUS}"
SQL["e06_coverage_selection"] = f"{SHARED}{COVERAGE} {COVER}"


def planned(spark, d):
    """Selections of both goals from the same evidence, which is scored once; over sources of many records."""
    unique = shared_evidence(spark, d)
    sides = [pick(unique).withColumn("goal", F.lit(goal)).select("goal", *CHOICE) for goal, pick in (("focused", planner.select_focused), ("coverage", planner.select_coverage))]
    return sides[0].unionByName(sides[1])


SQL["i10_planner"] = f"{SHARED}{FOCUSED}{COVERAGE} SELECT 'focused' AS goal, * FROM ({FOCUS}) UNION ALL SELECT 'coverage', * FROM ({COVER})"
# by their own paths every source of these tables has one document, so that the best primary ones are taken, then the best others
PICK = EV + f" SELECT query_id, position, record_type, record_id, source_key, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY is_primary DESC, score DESC, source_rank, source_key, start_line, record_id)::INTEGER AS position FROM dd) WHERE position <= {TOP_K}"


def decisions(spark, d):
    """Every candidate's fate: selected, duplicate, quota or cutoff, ineligible, outside scope; at most the candidate budget a query."""
    ids_ = ["query_id", "record_type", "record_id"]
    every = classed(spark, d)
    scored = evidence(spark, d, every)
    unique = planner.deduplicated(scored)
    chosen = planner.select_focused(unique).select(*ids_, F.lit("selected").alias("_s"))
    everything = every.select(*ids_, F.col("evidence_kind").isNull().alias("_bad"))
    in_scope, kept = scored.select(*ids_, F.lit(True).alias("_in")), unique.select(*ids_, F.lit(True).alias("_kept"))
    rows = everything.join(in_scope, ids_, "left").join(kept, ids_, "left").join(chosen, ids_, "left")
    reason = F.when(F.col("_s").isNotNull(), "selected").when(F.col("_bad"), "ineligible_evidence").when(F.col("_in").isNull(), "outside_source_scope").when(F.col("_kept").isNull(), "duplicate_evidence").otherwise("ranking_cutoff")
    place = F.array_position(F.array(*[F.lit(x) for x in ("selected", "duplicate_evidence", "ranking_cutoff", "ineligible_evidence", "outside_source_scope")]), reason)
    w = Window.partitionBy("query_id").orderBy(place, "record_type", "record_id")
    return rows.withColumn("reason", reason).withColumn("_n", F.row_number().over(w)).where("_n <= 40").groupBy("query_id", "reason").agg(F.count(F.lit(1)).alias("n"))


SQL["e07_decision_log"] = EV + f""", pk AS (SELECT query_id, record_type, record_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY is_primary DESC, score DESC, source_rank, source_key, start_line, record_id) AS p FROM dd) WHERE p <= {TOP_K}),
 rs AS (SELECT query_id, record_type, record_id, CASE WHEN (query_id, record_id) IN (SELECT query_id, record_id FROM pk) THEN 'selected' WHEN evidence_kind IS NULL THEN 'ineligible_evidence' WHEN (query_id, record_id) NOT IN (SELECT query_id, record_id FROM es) THEN 'outside_source_scope'
  WHEN (query_id, record_id) NOT IN (SELECT query_id, record_id FROM dd) THEN 'duplicate_evidence' ELSE 'ranking_cutoff' END AS reason FROM cl)
 SELECT query_id, reason, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY list_position(['selected','duplicate_evidence','ranking_cutoff','ineligible_evidence','outside_source_scope'], reason), record_type, record_id) AS p FROM rs) WHERE p <= 40 GROUP BY ALL"""


def full_query(spark, d):
    """Selected evidence with its text, up to 400 characters, and the trace of its query."""
    every = classed(spark, d)
    hits = planner.select_focused(planner.deduplicated(evidence(spark, d, every)))
    trace = every.groupBy("query_id").agg(F.count(F.lit(1)).alias("merged"))
    docs = read(spark, d, "documents").select(F.concat(F.lit("r"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("record_id"), F.substring("text", 1, 400).alias("block"))
    return hits.join(docs, "record_id").join(trace, "query_id").select("query_id", "position", "record_id", "source_key", "block", "merged")


SQL["i11_full_query"] = PICK.replace(" SELECT query_id, position, record_type, record_id, source_key, score FROM (SELECT", " SELECT query_id, position, record_id, source_key, left(text,400) AS block, merged FROM (SELECT").replace("FROM dd) WHERE", "FROM dd) JOIN (SELECT query_id, count(*) AS merged FROM mg GROUP BY 1) USING (query_id) WHERE")

QUERIES = {
    "e01_route_rank": rank_rows, "d08_candidate_merge": merge_rows, "c18_canonical_source": source_rows, "b13_evidence_class": class_rows, "d09_source_score": scope, "e02_source_scope": scope,
    "i09_relevance_score": score_rows, "e04_evidence_order": order_rows, "d10_evidence_dedupe": order_rows, "e05_focused_selection": focused, "e06_coverage_selection": coverage, "i10_planner": planned,
    "e07_decision_log": decisions, "i11_full_query": full_query,
}
