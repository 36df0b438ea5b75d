"""Registered queries of retrieval: term search, vector search, fusion, evaluation against passages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.operators import knn, search
from lodestack.plans.columns import DOCS
from lodestack.sources.tables import corpus, read, stored

SQL: dict = {}


def _queries(spark, d):
    """Benchmark texts as queries; their own vectors are those of the same number."""
    return read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _vectors(spark, d):
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("int").alias("kind"))


def _query_vectors(spark, d):
    q = read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"))
    return q.join(_vectors(spark, d).select(F.col("id").alias("query_id"), F.col("v").alias("qv")), "query_id")


def seen(spark, d):
    """What documents hold of the queries' terms and of the passages, for what needs both: their texts are read once."""
    terms = search.query_token_rows(_queries(spark, d))
    return search.scan(read(spark, d, "documents"), terms, read(spark, d, "benchmark").select(F.col("text").alias("passage")))


def bm25(spark, d, rows=None):
    """All of a query's first eight terms must be in a document."""
    return search.bm25(read(spark, d, "documents"), _queries(spark, d), rows=rows)


TOK = "list_transform(regexp_extract_all(text,'[0-9A-Za-z_一-鿿]+'), lambda w: lower(w))"
BM25 = f"""q AS (SELECT item_id AS query_id, unnest(list_distinct(list_slice({TOK},1,8))) AS term FROM benchmark),
dt AS (SELECT doc_id, {TOK} AS w FROM documents), len AS (SELECT doc_id, len(w) AS l FROM dt), tot AS (SELECT count(*) n, avg(l) a FROM len),
post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM dt) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
sc AS (SELECT post.doc_id, post.term, ln(1+(n-df+0.5)/(df+0.5))*tf*2.2/(tf+1.2*(0.25+0.75*l/a)) AS w FROM post JOIN df USING (term) JOIN len USING (doc_id), tot),
need AS (SELECT query_id, count(*) AS need FROM q GROUP BY 1),
hit AS (SELECT query_id, doc_id, count(*) AS got, sum(w) AS score FROM q JOIN sc USING (term) GROUP BY ALL),
bm AS (SELECT * FROM (SELECT query_id, doc_id, round(score,6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score,9) DESC, doc_id)::INTEGER AS rank FROM hit JOIN need USING (query_id) WHERE got = need) WHERE rank <= 40)"""
SQL["i04_bm25"] = SQL["f03_lexical_topk"] = f"WITH {BM25} SELECT * FROM bm"


def vector_topk(spark, d, k=40):
    return knn.top_k(_query_vectors(spark, d), _vectors(spark, d), k).select("query_id", F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


VEC = """qv AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS e FROM benchmark JOIN embeddings ON vec_id = item_id),
vs AS (SELECT query_id, vec_id AS doc_id, list_cosine_similarity(qv.e, embeddings.embedding::DOUBLE[]) AS c FROM qv, embeddings),
vr AS (SELECT * FROM (SELECT query_id, doc_id, round(c,6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(c,12) DESC, doc_id)::INTEGER AS rank FROM vs) WHERE rank <= 40)"""
SQL["f02_vector_topk"] = f"WITH {VEC} SELECT * FROM vr"


def filtered_search(spark, d):
    """Vector search among the records of some kinds only; the filter comes before scoring."""
    rows = _vectors(spark, d).where(F.col("kind").isin(1, 4, 6))
    return knn.top_k(_query_vectors(spark, d), rows, 10).select("query_id", F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


SQL["i06_vector_search"] = """WITH qv AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS e FROM benchmark JOIN embeddings ON vec_id = item_id)
SELECT query_id, doc_id, round(c,6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, doc_id)::INTEGER AS rank FROM
 (SELECT query_id, vec_id AS doc_id, list_cosine_similarity(qv.e, embeddings.embedding::DOUBLE[]) AS c FROM qv, embeddings WHERE label IN (1,4,6))) WHERE rank <= 10"""


def hybrid(spark, d, rows=None):
    """Vector and term legs of 40 fused by reciprocal rank."""
    return search.fused(bm25(spark, d, rows), vector_topk(spark, d))


RRF = """u AS (SELECT query_id, doc_id, rank FROM bm UNION ALL SELECT query_id, doc_id, rank FROM vr),
f AS (SELECT query_id, doc_id, round(sum(1.0::DOUBLE/(60+rank)),9) AS score FROM u GROUP BY ALL),
fr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM f) WHERE rank <= 20)"""
SQL["i07_hybrid_search"] = f"WITH {BM25}, {VEC}, {RRF} SELECT * FROM fr"


def route_union(spark, d):
    """The candidates of all routes in one table, each with its family."""
    lex = bm25(spark, d).withColumn("route", F.lit("lexical"))
    nav = vector_topk(spark, d).withColumn("route", F.lit("navigation"))
    sec = filtered_search(spark, d).withColumn("route", F.lit("section"))
    return lex.unionByName(nav).unionByName(sec).groupBy("query_id", "route").agg(F.count(F.lit(1)).alias("candidates"), F.max("rank").alias("last_rank"))


SQL["g06_route_union"] = SQL["i08_route_collection"] = f"""WITH {BM25}, {VEC}, sec AS ({SQL["i06_vector_search"].replace("WITH qv AS", "WITH qv2 AS").replace("FROM qv,", "FROM qv2,").replace("(qv.e", "(qv2.e")})
SELECT query_id, route, count(*) AS candidates, max(rank) AS last_rank FROM (SELECT query_id, rank, 'lexical' AS route FROM bm UNION ALL SELECT query_id, rank, 'navigation' FROM vr UNION ALL SELECT query_id, rank, 'section' FROM sec) GROUP BY ALL"""


# The tables hold neither paths with words nor questions for formulas or numbers: words of the texts stand for them.
ASKED = ((" is ", " formula "), (" to ", " 10 "), (" la ", " 1,234 "))


def like_docs(spark, d):
    """Documents as rows of fields: the path ends with the first word of the text, rows of tables are told by their pipes."""
    t = F.coalesce("text", F.lit(""))
    stem = F.lower(F.regexp_extract(t, "([A-Za-z]+)", 1))
    path = F.concat(F.regexp_extract("path", "^.*/", 0), stem, F.lit(".md"))
    return corpus(spark, d).select("doc_id", t.alias("text"), path.alias("path"), "source", F.when(F.contains(t, F.lit(" | ")), "table.row").otherwise("text").alias("kind"))


def like_search(spark, d):
    """Substring search: anchors propose, all terms rank, short results are topped up from all fields."""
    query = F.col("query")
    for pattern, word in ASKED:
        query = F.regexp_replace(query, pattern, word)
    return search.like_fallback(like_docs(spark, d), _queries(spark, d).withColumn("query", query))


def _like_sql() -> str:
    query = "text"
    for pattern, word in ASKED:
        query = f"regexp_replace({query}, '{pattern}', '{word}', 'g')"
    plain = "regexp_replace(regexp_replace({}, '([0-9])(?:,|\\{{,\\}})([0-9]{{3}})', '\\1\\2', 'g'), '([0-9])(?:,|\\{{,\\}})([0-9]{{3}})', '\\1\\2', 'g')".replace("\\\\", "\\")
    return rf"""{DOCS}, c AS (SELECT doc_id, coalesce(text, '') AS t, source, concat(regexp_extract(path, '^.*/', 0), lower(regexp_extract(coalesce(text, ''), '([A-Za-z]+)', 1)), '.md') AS path,
 CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table.row' ELSE 'text' END AS kind FROM d),
w AS (SELECT *, lower({plain.format('t')}) AS low FROM c),
q0 AS (SELECT item_id AS query_id, {query} AS query FROM benchmark),
q1 AS (SELECT query_id, regexp_matches(query, '(?i)\b(?:formula|equation)\b|公式') AS intent, list_slice({TOK.replace('text', plain.format('query'))}, 1, 8) AS t0 FROM q0),
q2 AS (SELECT query_id, any_value(intent) AS intent, term, min(p) AS p FROM (SELECT query_id, intent, unnest(t0) AS term, unnest(range(1, len(t0) + 1)) AS p FROM q1) GROUP BY query_id, term),
q3 AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS size, row_number() OVER (PARTITION BY query_id ORDER BY length(term) DESC, p) AS a FROM q2),
q4 AS (SELECT *, a <= 4 OR (regexp_matches(term, '[0-9]') AND row_number() OVER (PARTITION BY query_id, a <= 4, regexp_matches(term, '[0-9]') ORDER BY p) <= 2) AS anchor, length(term) >= 3 AND NOT regexp_full_match(term, '[0-9]+') AS wordy FROM q3),
m AS (SELECT query_id, doc_id, w.path, kind, intent, size, term, anchor, wordy, contains(low, term) AS in_text, contains(lower(w.path), term) AS in_path, contains(lower(source), term) AS in_source FROM q4, w WHERE contains(low, term) OR contains(lower(w.path), term) OR contains(lower(source), term)),
r AS (SELECT query_id, doc_id, path, kind, intent, sum(CASE WHEN in_text THEN CASE WHEN regexp_full_match(term, '[0-9]+') THEN size ELSE 1 END ELSE 0 END)::BIGINT AS matches,
 sum(CASE WHEN in_path AND wordy THEN CASE WHEN intent THEN length(term) ELSE 1 END ELSE 0 END)::BIGINT AS path_score, bool_or(anchor AND in_text) OR bool_or(intent AND wordy AND in_path) AS ok FROM m GROUP BY ALL),
f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY (intent AND kind = 'table.row') DESC, CASE WHEN intent THEN path_score ELSE 0 END DESC, matches + path_score DESC, matches DESC, path, doc_id)::INTEGER AS rank FROM r WHERE ok),
g AS (SELECT query_id, count(*) AS n FROM f WHERE rank <= 20 GROUP BY 1),
o AS (SELECT r.query_id, r.doc_id, (coalesce(n, 0) + row_number() OVER (PARTITION BY r.query_id ORDER BY r.path, r.doc_id))::INTEGER AS rank FROM r LEFT JOIN g USING (query_id) WHERE coalesce(n, 0) < 20 AND NOT ok)
SELECT query_id, doc_id, matches, path_score, 'anchors' AS stage, rank FROM f WHERE rank <= 20 UNION ALL SELECT query_id, doc_id, 0::BIGINT, 0::BIGINT, 'any', rank FROM o WHERE rank <= 20"""


SQL["i05_like_fallback"] = _like_sql()


def posting_lookup(spark, d):
    """Postings of query terms joined with their documents."""
    asked = search.query_token_rows(_queries(spark, d)).select("term").distinct()
    words = read(spark, d, "documents").select("doc_id", "lang", F.explode(F.array_distinct(search.tokens(F.col("text")))).alias("term"))
    return words.join(asked, "term", "left_semi").groupBy("term", "lang").agg(F.count(F.lit(1)).alias("docs"))


SQL["c07_posting_lookup"] = f"""SELECT term, lang, count(*) AS docs FROM (SELECT doc_id, lang, unnest(list_distinct({TOK})) AS term FROM documents)
WHERE term IN (SELECT unnest(list_slice({TOK},1,8)) FROM benchmark) GROUP BY ALL"""


def self_nearest(spark, d):
    """Sampled vectors must find themselves first."""
    rows = _vectors(spark, d)
    asked = rows.where(F.col("id") % 10 == 0).select(F.col("id").alias("query_id"), F.col("v").alias("qv"))
    return knn.top_k(asked, rows, 1).select("query_id", (F.col("id") == F.col("query_id")).alias("found"), F.round("score", 6).alias("score"))


SQL["i16_self_nearest"] = "SELECT vec_id AS query_id, true AS found, 1.0::DOUBLE AS score FROM embeddings WHERE vec_id % 10 = 0"


def expected(spark, d, rows=None):
    """(query_id, doc_id): documents that hold a benchmark passage."""
    items = read(spark, d, "benchmark").select("item_id", F.col("text").alias("passage"))
    return search.passages(read(spark, d, "documents"), items, rows).select(F.col("item_id").alias("query_id"), "doc_id")


def evidence(spark, d):
    """Passages and, apart from them, their sentences of one or two words, with the documents that hold them."""
    items = read(spark, d, "benchmark").select("item_id", "text")
    short = items.select("item_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(1)))).alias("passage"))
    every = items.select("item_id", F.col("text").alias("passage")).unionByName(short)
    return search.passages(read(spark, d, "documents"), every).select(F.col("item_id").alias("query_id"), F.md5("passage").alias("passage"), "doc_id")


SENTENCE = r"[.\n] ?([A-Z][a-z]+(?: [a-z]+)?)[.]"
SQL["c14_evidence_match"] = f"""WITH s AS (SELECT item_id, text AS p FROM benchmark UNION SELECT item_id, unnest(regexp_extract_all(text, '{SENTENCE}', 1)) FROM benchmark)
SELECT item_id AS query_id, md5(p) AS passage, doc_id FROM s JOIN documents d ON contains(d.text, p)"""
EXP = "x AS (SELECT item_id AS query_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


def recall(spark, d, hits=None, rows=None):
    """Share of a query's expected documents among its hits; 1 where none is expected."""
    rows = seen(spark, d) if rows is None else rows
    hits, want = (hybrid(spark, d, rows) if hits is None else hits).select("query_id", "doc_id", "rank"), expected(spark, d, rows)
    n = want.join(hits, ["query_id", "doc_id"], "left").groupBy("query_id").agg(F.count(F.lit(1)).alias("want"), F.count("rank").alias("got"), F.min("rank").alias("first_rank"))
    out = _queries(spark, d).select("query_id").join(n, "query_id", "left")
    return out.select("query_id", F.coalesce(F.col("got") / F.col("want"), F.lit(1.0)).alias("recall"), F.coalesce("first_rank", F.lit(0)).cast("int").alias("first_rank"))


SQL["l02_recall"] = SQL["e08_first_rank"] = f"""WITH {BM25}, {VEC}, {RRF}, {EXP} SELECT item_id AS query_id, coalesce(r, 1.0)::DOUBLE AS recall, coalesce(f,0)::INTEGER AS first_rank FROM benchmark LEFT JOIN
 (SELECT x.query_id, count(fr.rank)/count(*) AS r, min(fr.rank) AS f FROM x LEFT JOIN fr ON fr.query_id = x.query_id AND fr.doc_id = x.doc_id GROUP BY 1) y ON y.query_id = item_id"""


def blocks(spark, d, hits=None):
    """Selected hits as context blocks: text up to each query's share of the character budget."""
    hits = (hybrid(spark, d) if hits is None else hits).select("query_id", "doc_id", "rank", "score")
    per = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    share = F.least(F.lit(1200), F.floor(F.lit(524288) / per)).cast("int")
    cards = hits.withColumn("share", share)
    return cards.join(read(spark, d, "documents").select("doc_id", "text", "source"), "doc_id").select(
        "query_id", "rank", "doc_id", "source", F.expr("substring(text, 1, share)").alias("block"), (F.length("text") > F.col("share")).alias("cut"))


SQL["c06_hydrate"] = SQL["i13_context"] = f"""WITH {BM25}, {VEC}, {RRF} SELECT query_id, rank, doc_id, source, left(text, 1200) AS block, length(text) > 1200 AS cut FROM fr JOIN documents USING (doc_id)"""


def budgeted(spark, d):
    """The hits of all queries as one response: each block gets its share of the character budget, 1200 at most."""
    hits = stored(hybrid(spark, d).select("query_id", "doc_id", "rank"))
    cards = hits.crossJoin(hits.agg(F.least(F.lit(1200), F.floor(F.lit(524288) / F.count(F.lit(1)))).cast("int").alias("share")))  # one row
    docs = read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return cards.join(docs, "doc_id").select("query_id", "rank", "doc_id", "share", F.expr("substring(text, 1, share)").alias("block"), (F.length("text") > F.col("share")).alias("cut"))


SQL["f08_block_budget"] = f"""WITH {BM25}, {VEC}, {RRF}, s AS (SELECT least(1200, 524288 // count(*))::INTEGER AS share FROM fr)
SELECT query_id, rank, doc_id, share, left(coalesce(text, ''), share) AS block, length(coalesce(text, '')) > share AS cut FROM fr JOIN documents USING (doc_id), s"""


def response_scores(spark, d):
    """Per query: recall, duplicate rate of sources, characters, and the class of the first failing rule."""
    rows = seen(spark, d)
    hits = stored(hybrid(spark, d, rows))
    b = blocks(spark, d, hits)
    shape = b.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks"), F.countDistinct("source").alias("sources"), F.sum(F.length("block")).alias("chars"))
    out = recall(spark, d, hits, rows).join(shape, "query_id", "left").na.fill(0)
    dup = F.round(F.when(F.col("blocks") > 0, (F.col("blocks") - F.col("sources")) / F.col("blocks")).otherwise(0.0), 6)
    fail = F.when(F.col("blocks") == 0, "no_blocks").when(F.col("recall") < 1, "visible_evidence").when(F.col("sources") < 2, "few_sources").otherwise("")
    return out.select("query_id", F.round("recall", 6).alias("recall"), "blocks", "sources", "chars", dup.alias("duplicate_rate"), fail.alias("failure"), (fail == "").alias("passed"))


SQL["l03_response_score"] = SQL["l04_failure_class"] = f"""WITH {BM25}, {VEC}, {RRF}, {EXP},
rc AS (SELECT item_id AS query_id, coalesce(r, 1.0)::DOUBLE AS recall FROM benchmark LEFT JOIN (SELECT x.query_id, count(fr.rank)/count(*) AS r FROM x LEFT JOIN fr ON fr.query_id = x.query_id AND fr.doc_id = x.doc_id GROUP BY 1) y ON y.query_id = item_id),
sh AS (SELECT query_id, count(*) AS blocks, count(DISTINCT source) AS sources, sum(length(left(text,1200)))::BIGINT AS chars FROM fr JOIN documents USING (doc_id) GROUP BY 1),
o AS (SELECT rc.query_id, round(recall,6) AS recall, coalesce(blocks,0) AS blocks, coalesce(sources,0) AS sources, coalesce(chars,0) AS chars FROM rc LEFT JOIN sh USING (query_id))
SELECT *, round(CASE WHEN blocks > 0 THEN (blocks-sources)::DOUBLE/blocks ELSE 0 END, 6) AS duplicate_rate, CASE WHEN blocks = 0 THEN 'no_blocks' WHEN recall < 1 THEN 'visible_evidence' WHEN sources < 2 THEN 'few_sources' ELSE '' END AS failure,
 blocks > 0 AND recall >= 1 AND sources >= 2 AS passed FROM o"""


def coverage_plan(spark, d):
    """Per query: blocks of each source in order of first appearance, the first eight to be read, gaps of roles."""
    b = blocks(spark, d).groupBy("query_id", "source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))

    place = F.row_number().over(Window.partitionBy("query_id").orderBy("first", "source")).cast("int")
    return b.withColumn("place", place).select("query_id", "source", "place", F.col("n").alias("blocks"), F.when(F.col("place") <= 8, "must_read").otherwise("supporting").alias("decision"))


SQL["d16_coverage_plan"] = f"""WITH {BM25}, {VEC}, {RRF}, b AS (SELECT query_id, source, min(rank) AS f, count(*) AS n FROM fr JOIN documents USING (doc_id) GROUP BY ALL)
SELECT query_id, source, p AS place, n AS blocks, CASE WHEN p <= 8 THEN 'must_read' ELSE 'supporting' END AS decision FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY f, source)::INTEGER AS p FROM b)"""


def duplicate_scan(spark, d):
    """Documents that hold any of an item's three longest words, also inside of longer ones, in their first 16 KiB; at most 20 a query, by path."""
    words = F.array_distinct(search.tokens(F.coalesce("query", F.lit(""))))
    longest = F.slice(F.reverse(F.array_sort(F.transform(words, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))), 1, 3)
    asked = stored(_queries(spark, d).select("query_id", F.explode(longest["t"]).alias("term")))
    have = corpus(spark, d).select("doc_id", "path", F.explode(F.array_distinct(search.tokens(F.substring("text", 1, 16384)))).alias("word"))
    held = search.holding(have.select("word").distinct(), asked.select("term").distinct())
    found = have.join(held, "word").join(asked, "term").select("query_id", "doc_id", "path").distinct()
    w = Window.partitionBy("query_id").orderBy("path", "doc_id")
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where("rank <= 20").select("query_id", "doc_id", "rank")


SQL["c12_duplicate_scan"] = f"""{DOCS}, q0 AS (SELECT item_id AS query_id, list_distinct({TOK}) AS w FROM benchmark),
q AS (SELECT query_id, unnest(list_reverse_sort(list_transform(w, lambda t: {{'n': length(t), 't': t}}))[1:3]).t AS term FROM q0),
v AS (SELECT doc_id, path, lower(left(text, 16384)) AS low FROM d),
m AS (SELECT DISTINCT query_id, doc_id, path FROM q JOIN v ON contains(low, term))
SELECT query_id, doc_id, rank FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY path, doc_id)::INTEGER AS rank FROM m) WHERE rank <= 20"""

QUERIES = {
    "i04_bm25": bm25, "f03_lexical_topk": bm25, "f02_vector_topk": vector_topk, "i06_vector_search": filtered_search, "i07_hybrid_search": hybrid,
    "g06_route_union": route_union, "i08_route_collection": route_union, "i05_like_fallback": like_search, "c07_posting_lookup": posting_lookup, "i16_self_nearest": self_nearest,
    "c14_evidence_match": evidence, "l02_recall": recall, "e08_first_rank": recall, "c06_hydrate": blocks, "f08_block_budget": budgeted, "i13_context": blocks,
    "l03_response_score": response_scores, "l04_failure_class": response_scores, "d16_coverage_plan": coverage_plan, "c12_duplicate_scan": duplicate_scan,
}
