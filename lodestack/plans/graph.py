"""Registered queries of the similarity graph and of link graphs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.functions import vectors
from lodestack.operators import knn
from lodestack.operators import rank_index as index
from lodestack.sources.tables import read, scratch, stored

SQL: dict = {}
# kinds are labels; the thresholds suit the given vectors, whose cosines within a label stay below 0.5
LIMITS = {(k, k): (5, 0.2) for k in range(10)} | {(0, 1): (3, 0.22), (1, 0): (3, 0.22), (2, 3): (3, 0.22), (3, 2): (3, 0.22)}


def rows(spark, d):
    e = read(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), (F.col("vec_id") % 50).alias("source"), F.col("label").cast("int").alias("kind"), F.col("embedding").cast("array<double>").alias("v")).where(vectors.valid(F.col("v")))


def ranks(spark, d):
    return knn.rank_lists(rows(spark, d), LIMITS)


def rank_query(spark, d):
    return ranks(spark, d).select("src_id", "tgt_id", "src_kind", "tgt_kind", F.round("cosine", 6).alias("cosine"), "rank")


RANKS = """n AS (SELECT vec_id AS id, vec_id % 50 AS source, label::INTEGER AS kind, embedding::DOUBLE[] AS v FROM embeddings),
lim AS (SELECT range::INTEGER AS a, range::INTEGER AS b, 5 AS k, 0.2::DOUBLE AS m FROM range(10) UNION ALL SELECT * FROM (VALUES (0,1,3,0.22::DOUBLE),(1,0,3,0.22::DOUBLE),(2,3,3,0.22::DOUBLE),(3,2,3,0.22::DOUBLE))),
pr AS (SELECT x.id AS src_id, y.id AS tgt_id, x.kind AS src_kind, y.kind AS tgt_kind, k, m, list_cosine_similarity(x.v, y.v) AS c FROM n x JOIN lim ON lim.a = x.kind JOIN n y ON y.kind = lim.b AND y.source <> x.source AND y.id <> x.id),
rk AS (SELECT src_id, tgt_id, src_kind, tgt_kind, c AS cosine, rank FROM (SELECT *, row_number() OVER (PARTITION BY src_id, tgt_kind ORDER BY c DESC, tgt_id)::INTEGER AS rank FROM pr WHERE c >= m) WHERE rank <= k)"""
EDGES = RANKS + """, ed AS (SELECT src_id, tgt_id, concat(src_kind, ':', tgt_kind) AS pair_kind, round(cosine, 6) AS cosine FROM rk r WHERE (src_kind < tgt_kind OR (src_kind = tgt_kind AND src_id < tgt_id))
 AND EXISTS (SELECT 1 FROM rk b WHERE b.src_id = r.tgt_id AND b.tgt_id = r.src_id))"""
for _n in ("c19_knn_join", "e03_knn_rank"):
    SQL[_n] = f"WITH {RANKS} SELECT src_id, tgt_id, src_kind, tgt_kind, round(cosine,6) AS cosine, rank FROM rk"


def edges(spark, d):
    return knn.mutual_edges(ranks(spark, d))


for _n in ("c20_mutual_filter", "i19_mutual_graph", "f04_edge_order"):
    SQL[_n] = f"WITH {EDGES} SELECT src_id, tgt_id, pair_kind, cosine FROM ed"


def ordered_edges(spark, d):
    return edges(spark, d).orderBy("pair_kind", F.desc("cosine"), "src_id", "tgt_id")


def report(spark, d):
    return knn.edge_report(edges(spark, d))


SQL["d11_edge_report"] = f"WITH {EDGES} SELECT pair_kind, count(*) AS edges, round(min(cosine),6) AS least, round(avg(cosine),6) AS mean, round(max(cosine),6) AS most FROM ed GROUP BY 1"


def hubs(spark, d):
    return knn.degrees(edges(spark, d)).orderBy(F.desc("degree"), "node").limit(20)


SQL["f05_top_hubs"] = f"WITH {EDGES} SELECT node, count(*) AS degree FROM (SELECT src_id AS node FROM ed UNION ALL SELECT tgt_id FROM ed) GROUP BY 1 ORDER BY degree DESC, node LIMIT 20"


def families(spark, d):
    return ranks(spark, d).groupBy(F.concat_ws(":", "src_kind", "tgt_kind").alias("family")).agg(F.count(F.lit(1)).alias("rows"))


SQL["d12_index_summary"] = f"WITH {RANKS} SELECT concat(src_kind,':',tgt_kind) AS family, count(*) AS rows FROM rk GROUP BY 1"


def union_ways(spark, d):
    return knn.both_ways(edges(spark, d))


WAYS = EDGES + ", nb AS (SELECT src_id AS node, tgt_id AS other, cosine AS weight, pair_kind AS kind FROM ed UNION ALL SELECT tgt_id, src_id, cosine, pair_kind FROM ed WHERE src_id <> tgt_id)"
SQL["g05_both_ways"] = f"WITH {WAYS} SELECT * FROM nb"


def near(spark, d):
    return knn.neighbours(edges(spark, d), 3)


SQL["j01_neighbours"] = f"WITH {WAYS} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, kind, other)::INTEGER AS rank FROM nb) WHERE rank <= 3"


def expansion(spark, d):
    """Neighbours of seed rows along edges of some kinds."""
    seeds = read(spark, d, "embeddings").where("vec_id % 5 = 0").select(F.col("vec_id").alias("node"))
    return knn.neighbours(edges(spark, d), 4, [f"{k}:{k}" for k in range(5)]).join(seeds, "node", "left_semi")


SQL["c11_neighbour_expansion"] = f"WITH {WAYS} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, kind, other)::INTEGER AS rank FROM nb WHERE kind IN ('0:0','1:1','2:2','3:3','4:4')) WHERE rank <= 4 AND node % 5 = 0"


def selected(spark, d):
    return edges(spark, d).where(F.col("pair_kind").isin("0:0", "0:1")).withColumn("review", F.lit("selected"))


SQL["b10_pair_kind_selection"] = f"WITH {EDGES} SELECT *, 'selected' AS review FROM ed WHERE pair_kind IN ('0:0','0:1')"


def edge_text(spark, d):
    e = edges(spark, d)
    return e.select("src_id", "tgt_id", F.concat(F.col("src_id").cast("string"), F.lit(" SEMANTIC_SECTION_NEIGHBOR "), F.col("tgt_id").cast("string"), F.lit("; cosine="), F.format_string("%.6f", "cosine")).alias("description"))


SQL["h35_edge_text"] = f"WITH {EDGES} SELECT src_id, tgt_id, concat(src_id, ' SEMANTIC_SECTION_NEIGHBOR ', tgt_id, '; cosine=', printf('%.6f', cosine)) AS description FROM ed"


def digit(i: int):
    """A digit of a vector's first component: which rows were otherwise when the index was written."""
    return F.floor(F.abs(F.col("v")[0]) * 10000) % 40 == i


def refreshed_index(spark, d):
    """An index written of older rows, brought to the present: some vectors were reversed then, some rows are new, some are gone."""
    every = rows(spark, d)
    before = every.where(~digit(9)).withColumn("v", F.when(digit(7), F.reverse("v")).otherwise(F.col("v")))
    now = every.where(~digit(11))
    at = scratch(spark)
    index.write(before, LIMITS, at)
    change = stored(index.stale(now, at))
    index.refresh(now, LIMITS, at)
    done = index.lists(spark, at).select("src_id", "tgt_id", "src_kind", "tgt_kind", F.round("cosine", 6).alias("cosine"), "rank")
    return done.join(change.select(F.col("id").alias("src_id"), "change"), "src_id", "left").na.fill("kept", ["change"])


DIGIT = "floor(abs(embedding[1]::DOUBLE) * 10000)::BIGINT % 40"
SQL["i20_rank_index"] = f"""WITH {RANKS.replace('FROM embeddings)', f'FROM embeddings WHERE {DIGIT} <> 11)', 1)}
 SELECT src_id, tgt_id, src_kind, tgt_kind, round(cosine,6) AS cosine, rank, CASE {DIGIT} WHEN 9 THEN 'added' WHEN 7 THEN 'updated' ELSE 'kept' END AS change FROM rk JOIN embeddings ON vec_id = src_id"""


def links(spark, d):
    """(page_id, target, ord): links of pages, without fragments."""
    p = read(spark, d, "pages")
    found = F.regexp_extract_all("html", F.lit('href="([^"#]+)'), F.lit(1))
    return p.select("page_id", F.posexplode(found).alias("ord", "target"))


LINKS = """l AS (SELECT page_id, unnest(x) AS target, unnest(range(0, len(x))) AS ord FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"#]+)', 1) AS x FROM pages))"""


def broken(spark, d):
    """Targets that no page answers to (by the path of its url)."""
    have = read(spark, d, "pages").select(F.regexp_extract("url", r"^https?://[^/?#]+(/[^?#]*)", 1).alias("target")).distinct()
    return links(spark, d).join(have, "target", "left_anti").groupBy("target").agg(F.countDistinct("page_id").alias("pages"))


SQL["c10_broken_links"] = f"WITH {LINKS} SELECT target, count(DISTINCT page_id) AS pages FROM l WHERE target NOT IN (SELECT regexp_extract(url,'^https?://[^/?#]+(/[^?#]*)',1) FROM pages) GROUP BY 1"


QUERIES = {
    "c19_knn_join": rank_query, "e03_knn_rank": rank_query, "c20_mutual_filter": edges, "i19_mutual_graph": edges, "f04_edge_order": ordered_edges, "d11_edge_report": report,
    "f05_top_hubs": hubs, "d12_index_summary": families, "g05_both_ways": union_ways, "j01_neighbours": near, "c11_neighbour_expansion": expansion, "b10_pair_kind_selection": selected,
    "h35_edge_text": edge_text, "i20_rank_index": refreshed_index, "c10_broken_links": broken
}
