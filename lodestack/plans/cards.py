"""Registered queries of cards, sources in pieces, links and vectors as text, and query-aware excerpts."""

from __future__ import annotations

import base64
import re

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.functions import excerpt, text
from lodestack.operators import includes, main_file
from lodestack.plans.columns import DOCS
from lodestack.plans.papers import quoted
from lodestack.plans.planning import STOP, TERMS
from lodestack.plans.search import BM25, RRF, VEC, hybrid
from lodestack.sources.tables import conversations_markdown, corpus, read, stored

SQL: dict = {}


# Numbered or known headings, and captions, of plain texts.
HEADING = r"^[0-9]+(?:\.[0-9]+)*[ \t]+[A-Z][A-Za-z0-9 ,:;()/-]{2,}$"
KNOWN = r"(?i)^(?:Abstract|Introduction|Related Work|Methods?|Experiments?|Results?|Discussion|Conclusion|Limitations|Appendix)(?:$|[^0-9A-Za-z_])"
CAPTION = r"(?i)(?:Figure|Fig\.|Table)[ \t]*[0-9]+[^\n]{0,120}"
CARD_LIMIT = 200  # most cards of a kind from one document


def inventory(spark, d):
    """Numbered and known headings, and captions, of whole texts; paragraphs and `... the` stand for the numbers of plain papers."""
    numbered = F.regexp_replace(F.regexp_replace("text", r"\n([A-Z][a-z]+ [a-z]+) ", "\n2.1 $1\n"), r"(?m)^([A-Z][a-z]+) the ", "Figure 7: $1 the ")
    t = F.concat(F.lit("Abstract\nTable "), F.col("doc_id").cast("string"), F.lit(": "), F.col("lang"), F.lit("\n"), numbered)
    lines = corpus(spark, d).select("doc_id", F.posexplode(F.split(t, "\n")).alias("n", "line"))
    stripped = F.trim("line")
    lines = lines.select("doc_id", "n", F.when(stripped.rlike(HEADING) | stripped.rlike(KNOWN), F.lit("section")).when(stripped.rlike(CAPTION), "caption").alias("kind"), stripped.alias("s"))
    first = Window.partitionBy("doc_id", "kind").orderBy("n")
    kept = lines.where("kind IS NOT NULL").withColumn("k", F.row_number().over(first)).where(F.col("k") <= CARD_LIMIT)
    return kept.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("cards"), F.min("n").alias("first"), F.min_by(F.substring("s", 1, 180), "n").alias("heading"))


SQL["m01_inventory"] = rf"""
WITH t AS (SELECT doc_id, concat('Abstract', chr(10), 'Table ', doc_id, ': ', lang, chr(10),
  regexp_replace(regexp_replace(text, '\n([A-Z][a-z]+ [a-z]+) ', chr(10) || '2.1 \1' || chr(10), 'g'), '(?m)^([A-Z][a-z]+) the ', 'Figure 7: \1 the ', 'g')) AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS n FROM t),
k AS (SELECT doc_id, n, trim(line) AS s, CASE WHEN regexp_matches(trim(line), '{HEADING}') OR regexp_matches(trim(line), '{KNOWN}') THEN 'section' WHEN regexp_matches(trim(line), '{CAPTION}') THEN 'caption' END AS kind FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY n) AS i FROM k WHERE kind IS NOT NULL)
SELECT doc_id, kind, count(*) AS cards, min(n)::INTEGER AS first, arg_min(left(s, 180), n) AS heading FROM r WHERE i <= {CARD_LIMIT} GROUP BY 1, 2"""


# Words of documents stand for the commands of TeX files, and their first words for names of files.
TEX_MARKS = (
    (r"(?m)^([A-Z][a-z]{2,4}) ", "\\section{$1} "), (r" ([a-z]{8}), ", " \\input {$1}, "), (r"\. ([A-Z][a-z]{5,7})\.", ". \\title{$1}\\maketitle."),
    (r", ([a-z]{6})\.", ", \\begin{document}."), (r" ([a-z]{3}), ([a-z]{3}) ", " \\begin{abstract} $1, $2 "), (r" ([a-z]{10}) ([a-z]{2}) ", " % $1 $2 "),
)
NAME_MARKS = ((r"^([A-C][a-z]*)$", "main_$1"), (r"^([P-S][a-z]*)$", "parts/appendix-$1"), (r"^([T-Z][a-z]*)$", "$1/macros"))


def tex_files(spark, d):
    """(project, path, tex): documents of one source and language as files of a project; those that begin with the same word are told by their folders."""
    tex, name = F.coalesce("text", F.lit("")), F.regexp_extract(F.coalesce("text", F.lit("")), "([A-Za-z]+)", 1)
    for pattern, mark in TEX_MARKS:
        tex = F.regexp_replace(tex, pattern, mark.replace("\\", "\\\\"))
    for pattern, mark in NAME_MARKS:
        name = F.regexp_replace(name, pattern, mark)
    return corpus(spark, d).select(F.concat_ws("/", "source", "lang").alias("project"), F.concat(name, F.lit("-"), F.col("doc_id").cast("string"), F.lit(".tex")).alias("path"), F.explode(F.array(tex)).alias("tex"))


def main_file_rows(spark, d):
    """The main file of each project by prose, sections, includes, markers and names."""
    return main_file.main_files(tex_files(spark, d))


def _main_file_sql() -> str:
    tex, name, prose = "coalesce(text, '')", "regexp_extract(coalesce(text, ''), '([A-Za-z]+)', 1)", "tex"
    for pattern, mark in TEX_MARKS:
        tex = f"regexp_replace({tex}, {quoted(pattern)}, {quoted(re.sub(r'[$]([12])', r'\\\1', mark.replace(chr(92), chr(92) * 2)))}, 'g')"
    for pattern, mark in NAME_MARKS:
        name = f"regexp_replace({name}, {quoted(pattern)}, {quoted(mark.replace('$', chr(92)))})"
    for pattern in main_file.NO_PROSE:
        prose = f"regexp_replace({prose}, {quoted(pattern)}, ' ', 'g')"
    return rf"""WITH f AS (SELECT concat_ws('/', source, lang) AS project, concat({name}, '-', doc_id, '.tex') AS path, {tex} AS tex FROM documents),
s AS (SELECT project, path, least(length(trim({prose})), 20000) AS prose, len(regexp_extract_all(tex, '\\(?:sub){{0,2}}section\*?\{{')) AS sections, len(regexp_extract_all(tex, '\\(?:input|include)\s*\{{')) AS includes, contains(tex, '\begin{{document}}') AS doc,
 contains(lower(tex), '\begin{{abstract}}') OR regexp_matches(lower(tex), '\\abstract\b') AS abs, contains(tex, '\maketitle') AS made, regexp_matches(tex, '\\title\s*(?:\[[^\]]*\]\s*)?\{{\s*[^\s{{}}]') AS title,
 list_contains(['main.tex', 'paper.tex', 'article.tex', 'ms.tex', 'manuscript.tex'], split_part(lower(path), '/', -1)) OR ends_with(lower(path), '_main.tex') OR starts_with(split_part(lower(path), '/', -1), 'main_') OR contains(lower(path), '/main') AS main,
 len(list_filter(['defs', 'macro', 'preamble', 'supplement', 'appendix'], lambda x: contains(lower(path), x))) > 0 AS support FROM f),
c AS (SELECT *, prose // 80 + sections * 20 + includes * 15 + doc::INTEGER * 100 + abs::INTEGER * 80 + made::INTEGER * 20 + title::INTEGER * 20 AS score FROM s),
u AS (SELECT *, CASE WHEN support THEN 'all_usable' WHEN main OR doc OR abs OR title THEN 'preferred_main' ELSE 'non_support' END AS pool FROM c
 WHERE (prose >= 120 AND (doc OR abs OR sections >= 2) AND (score >= 120 OR main)) OR (main AND includes > 0 AND (doc OR title)))
SELECT project, path, score::BIGINT AS score, prose::INTEGER AS prose, pool, usable_files FROM (SELECT *, count(*) OVER (PARTITION BY project) AS usable_files, row_number() OVER (PARTITION BY project ORDER BY pool = 'all_usable', pool = 'non_support', score DESC, prose DESC, path) AS n FROM u) WHERE n = 1"""


SQL["m04_main_file"] = _main_file_sql()


def abstract_spans(spark, d):
    """Merged intervals of abstract blocks: overlapping windows of line numbers become islands."""
    lines = conversations_markdown(spark, d).select("conv_id", F.posexplode(F.split("markdown", "\n")).alias("n", "line"))
    starts = lines.where(F.col("line").startswith("## assistant")).select("conv_id", F.col("n").alias("a"), (F.col("n") + 4).alias("b"))
    w = Window.partitionBy("conv_id").orderBy("a")
    far = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = starts.withColumn("far", far).withColumn("new", F.when(F.col("far").isNull() | (F.col("a") > F.col("far")), 1).otherwise(0)).withColumn("island", F.sum("new").over(w))
    return flagged.groupBy("conv_id", "island").agg(F.min("a").alias("first"), F.max("b").alias("last")).drop("island")


SQL["h28_abstract_spans"] = """WITH l AS (SELECT conv_id, role, turn, sum(len(string_split(text,chr(10))) + 1) OVER (PARTITION BY conv_id ORDER BY turn) - len(string_split(text,chr(10))) - 1 AS a FROM conversations),
s AS (SELECT conv_id, a::INTEGER AS a, (a+4)::INTEGER AS b FROM l WHERE role = 'assistant'), f AS (SELECT *, max(b) OVER (PARTITION BY conv_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM s),
g AS (SELECT *, sum(CASE WHEN far IS NULL OR a > far THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY a) AS i FROM f) SELECT conv_id, min(a) AS first, max(b) AS last FROM g GROUP BY conv_id, i"""


def vectors_as_text(spark, d):
    """Vectors as base64 of little-endian floats, decoded again in Arrow batches; wrong lengths are no vector."""
    @F.pandas_udf("string")
    def encode(v: pd.Series) -> pd.Series:
        ends = np.cumsum([0, *map(len, v)]) * 4
        raw = np.concatenate([np.zeros(0, "<f4"), *v]).astype("<f4").tobytes()
        return pd.Series([base64.b64encode(raw[a:b]).decode() for a, b in zip(ends, ends[1:])])

    @F.pandas_udf("array<float>")
    def decode(s: pd.Series) -> pd.Series:
        raw = [base64.b64decode(x) for x in s]
        whole = np.array([len(x) == DIM * 4 for x in raw])
        rows = np.frombuffer(b"".join(x for x, w in zip(raw, whole, strict=True) if w), "<f4").reshape(-1, DIM)  # all of a batch at once
        fine = np.isfinite(rows).all(1)
        out = np.full(len(raw), None, object)
        out[np.flatnonzero(whole)] = [r if f else None for r, f in zip(rows, fine, strict=True)]
        return pd.Series(out)

    short = F.when(F.col("embedding")[0] < 0, F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))
    e = read(spark, d, "embeddings").select("vec_id", encode(short).alias("s"))
    return e.select("vec_id", decode("s").alias("v")).select("vec_id", F.coalesce(F.size("v"), F.lit(-1)).alias("dim"), F.round(F.coalesce(F.get("v", F.lit(0)).cast("double"), F.lit(0.0)), 6).alias("first"))


DIM = 64
SQL["h25_base64_vectors"] = "SELECT vec_id, CASE WHEN embedding[1] < 0 THEN -1 ELSE len(embedding) END::INTEGER AS dim, CASE WHEN embedding[1] < 0 THEN 0.0 ELSE round(embedding[1]::DOUBLE, 6) END::DOUBLE AS first FROM embeddings"


def provider_rows(spark, d):
    """Vectors out of provider responses: entries sorted by index, count and dimension checked; some entries fail to come or come short."""
    e = read(spark, d, "embeddings")
    more = F.when(F.get("embedding", F.lit(1)) > 0.2, "]}").otherwise(F.concat(F.lit(","), F.col("vec_id").cast("string"), F.lit("]}")))
    entry = F.concat(F.lit('{"index":'), (F.col("vec_id") % 5).cast("string"), F.lit(',"embedding":['), F.col("label").cast("string"), F.lit(".5"), more)
    entry = F.when(F.get("embedding", F.lit(0)) > -0.2, entry)
    r = e.groupBy(F.floor(F.col("vec_id") / 5).alias("batch")).agg(F.concat(F.lit('{"data":['), F.array_join(F.sort_array(F.collect_list(F.struct((-F.col("vec_id")).alias("o"), entry.alias("e"))))["e"], ","), F.lit("]}")).alias("body"), F.count(F.lit(1)).alias("asked"))
    data = F.array_sort(F.from_json("body", "data array<struct<index:int,embedding:array<double>>>")["data"])
    short = F.exists(data, lambda x: F.size(x["embedding"]) != 2)
    return r.select("batch", F.when(F.size(data) != F.col("asked"), "count").when(short, "dimension").otherwise( F.array_join(F.transform(data, lambda x: x["embedding"][0].cast("string")), ",")).alias("firsts"))


SQL["h39_provider_rows"] = "SELECT vec_id // 5 AS batch, CASE WHEN bool_or(embedding[1] <= -0.2::FLOAT) THEN 'count' WHEN bool_or(embedding[2] > 0.2::FLOAT) THEN 'dimension' ELSE string_agg(concat(label, '.5'), ',' ORDER BY vec_id) END AS firsts FROM embeddings GROUP BY 1"


# The tables hold no projects of TeX files: documents of one source are a project, the first word names a file, and words make it include others.
INCLUDES = (
    (r"(?m)^([A-Z][a-z]+) ", "\\input{$1}\n"),
    (r"\. ([A-Z][a-z]{7,})\.", ".\n\\include{../$1.tex}\n"),
    (r", ([a-z]{8,})\.", "\n\\appendix\n\\include{https://$1}\n"),
    (r" ([a-z]{9,}), ", " \\input {parts/$1.eps}, "),
    (r" ([a-z])[a-z]* ([a-z]+)\. ", " \\include{./$2}\n"),
)


def project_files(spark, d):
    """(project, path, tex, doc_id): of documents of one source that begin with the same word the first one is its file."""
    t = F.coalesce("text", F.lit(""))
    tex = t
    for pattern, mark in INCLUDES:
        tex = F.regexp_replace(tex, pattern, mark.replace("\\", "\\\\"))
    rows = read(spark, d, "documents").select(F.col("source").alias("project"), F.concat(F.regexp_extract(t, "([A-Za-z]+)", 1), F.lit(".tex")).alias("path"), tex.alias("tex"), "doc_id").where("project IS NOT NULL")
    first = rows.groupBy("project", "path").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(first, ["project", "path", "doc_id"], "left_semi")


def include_walk(spark, d):
    """Includes followed from the first file of each project: units in order, cycles, and names that lead nowhere."""
    files = stored(project_files(spark, d))
    first = files.groupBy("project").agg(F.min_by("path", "doc_id").alias("path"))
    return includes.walk(files, first).drop("root")


def _include_sql() -> str:
    tex = "coalesce(text, '')"
    for pattern, mark in INCLUDES:
        tex = f"regexp_replace({tex}, {quoted(pattern)}, {quoted(re.sub(r'[$]([12])', r'\\\1', mark.replace(chr(92), chr(92) * 2)))}, 'g')"
    return rf"""
WITH RECURSIVE a AS (SELECT source AS project, concat(regexp_extract(coalesce(text, ''), '([A-Za-z]+)', 1), '.tex') AS path, {tex} AS tex, doc_id FROM documents WHERE source IS NOT NULL),
f AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY project, path ORDER BY doc_id) = 1),
v AS (SELECT project, path, unnest(e) AS e, unnest(range(0, len(e)))::INTEGER AS place, list_position(list_transform(e, lambda x: starts_with(x, '\appendix')), true) AS app FROM (SELECT project, path, regexp_extract_all(tex, '\\appendix\b|\\(?:input|include)\s*\{{[^{{}}]+\}}') AS e FROM f)),
i AS (SELECT project, path, place, coalesce(app, 0) > 0 AND place >= app AS appendix, regexp_extract(e, '\{{([^{{}}]+)\}}', 1) AS include, regexp_replace(trim(regexp_extract(e, '\{{([^{{}}]+)\}}', 1)), '^(?:\./)+', '') AS name FROM v WHERE NOT starts_with(e, '\appendix')),
r AS (SELECT *, CASE WHEN regexp_matches(name, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN 'remote_url' WHEN starts_with(name, '/') OR list_contains(string_split(name, '/'), '..') THEN 'path_traversal' END AS refused, CASE WHEN ends_with(lower(name), '.tex') THEN name ELSE concat(name, '.tex') END AS file FROM i),
e AS (SELECT r.project, r.path, place, appendix, include, CASE WHEN refused IS NULL THEN f.path END AS target, CASE WHEN refused IS NOT NULL THEN refused WHEN f.path IS NULL THEN CASE WHEN regexp_matches(name, '[^/]\.[^./]+$') AND NOT ends_with(lower(name), '.tex') THEN 'unsupported_extension' ELSE 'missing_source' END END AS reason
  FROM r LEFT JOIN f ON f.project = r.project AND f.path = r.file),
l(project, path, ordinals, trail, role, parent) USING KEY (project, path) AS (
  SELECT project, path, []::INTEGER[], [path], 'body', '' FROM f QUALIFY row_number() OVER (PARTITION BY project ORDER BY doc_id) = 1
  UNION SELECT project, target, o.ordinals, o.trail, o.role, o.parent FROM (
    SELECT l.project, e.target, min({{'ordinals': list_append(l.ordinals, e.place), 'trail': list_append(l.trail, e.target), 'role': CASE WHEN e.appendix THEN 'appendix' ELSE l.role END, 'parent': l.path}}) AS o
    FROM l JOIN e ON e.project = l.project AND e.path = l.path AND e.target IS NOT NULL AND NOT list_contains(l.trail, e.target) GROUP BY ALL) n
  WHERE NOT EXISTS (SELECT 1 FROM recurring.l b WHERE b.project = n.project AND b.path = n.target AND b.ordinals <= n.o.ordinals))
SELECT project, 'unit' AS kind, path, parent AS other, role, row_number() OVER (PARTITION BY project ORDER BY ordinals) - 1 AS number FROM l
UNION ALL SELECT l.project, 'cycle', l.path, e.target, '', e.place::BIGINT FROM l JOIN e ON e.project = l.project AND e.path = l.path AND list_contains(l.trail, e.target)
UNION ALL SELECT l.project, 'include_unresolved', l.path, e.include, e.reason, e.place::BIGINT FROM l JOIN e ON e.project = l.project AND e.path = l.path AND e.target IS NULL"""


SQL["j08_include_closure"] = _include_sql()


# Words of items that ask for sizes and relations, and words of texts that stand for numbers and expressions.
EXCERPT_ASKED = ((" is ", " size "), (" to ", " X below "), (" la ", " Y at least "))
EXCERPT_MARKS = ((" of ", " $X < 64$ "), (" le ", " 48 "), (" die ", " 128 "), (" in ", " $Y \\ge X$ "))


def marked(column, marks):
    for word, mark in marks:
        column = F.replace(column, F.lit(word), F.lit(mark))
    return column


def excerpts(spark, d):
    """Query-aware excerpts of selected hits."""
    hits = hybrid(spark, d).where("rank <= 5")
    query = marked(F.coalesce("text", F.lit("")), EXCERPT_ASKED)
    q = read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), query.alias("query"), text.scoring_terms(text.query_terms(query)).alias("terms"))
    body = marked(F.coalesce("text", F.lit("")), EXCERPT_MARKS)
    rows = hits.join(q, "query_id").join(read(spark, d, "documents").select("doc_id", body.alias("text")), "doc_id").select("query_id", "rank", "doc_id", "text", "query", "terms")
    return excerpt.with_excerpt(rows, 300).select("query_id", "rank", "doc_id", "excerpt", "begin")


def _excerpt_sql(most: int = 300) -> str:
    def put(column, marks):
        for word, mark in marks:
            column = f"replace({column}, '{word}', '{mark}')"
        return column

    query, body = put("coalesce(text, '')", EXCERPT_ASKED), put("coalesce(text, '')", EXCERPT_MARKS)
    # places of what a text is split at: lengths of the parts and of the matches before it
    place = "list_sum(list_transform(parts[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:k-1], lambda x: length(x))), 0)"
    number, formula = "[0-9]+(?:\\.[0-9]+)?", "\\$[^$]{1,80}\\$"
    return rf"""WITH {BM25}, {VEC}, {RRF},
iq AS (SELECT item_id AS query_id, {query} AS query FROM benchmark),
it AS (SELECT query_id, query, {TERMS.replace('b.text', 'b.query')} AS t FROM iq b),
ia AS (SELECT query_id, query, lower(query) AS low, CASE WHEN len(list_filter(t, lambda x: NOT list_contains({STOP}, x))) > 0 THEN list_filter(t, lambda x: NOT list_contains({STOP}, x)) ELSE t END AS terms,
  list_filter(list_distinct(string_split_regex(query, '[^\p{{L}}\p{{N}}_]+')), lambda x: regexp_full_match(x, '[A-Za-z]') AND lower(x) NOT IN ('a', 'i')) AS vars FROM it),
h AS (SELECT query_id, rank, doc_id, {body} AS body, terms, low, vars, list_has_any(terms, ['capacity', 'count', 'number', 'size', 'many']) AS asked, list_has_any(terms, ['capacity', 'size']) AS sized FROM fr JOIN documents USING (doc_id) JOIN ia USING (query_id) WHERE rank <= 5),
g AS (SELECT *, lower(body) AS lb FROM h WHERE length(body) > {most}),
ln0 AS (SELECT query_id, rank, string_split(body, chr(10)) AS l FROM g),
ln1 AS (SELECT query_id, rank, len(l) AS n, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM ln0),
ln AS (SELECT query_id, rank, i, line, sum(length(line) + 1) OVER w - length(line) - 1 AS b, sum(length(line) + 1) OVER w - CASE WHEN i = n THEN 1 ELSE 0 END AS e FROM ln1 WINDOW w AS (PARTITION BY query_id, rank ORDER BY i) QUALIFY NOT (i = n AND line = '')),
gt AS (SELECT query_id, rank, lb, unnest(terms) AS t FROM g),
lt AS (SELECT ln.query_id, ln.rank, i, t, b + instr(lower(line), t) - 1 AS pos FROM ln JOIN gt USING (query_id, rank) WHERE contains(lower(line), t)),
top AS (SELECT ln.query_id, ln.rank, b, e, n, pos FROM ln LEFT JOIN (SELECT query_id, rank, i, count(*) AS n, min(pos) AS pos FROM lt GROUP BY ALL) USING (query_id, rank, i) QUALIFY row_number() OVER (PARTITION BY query_id, rank ORDER BY coalesce(n, 0) DESC, i) = 1),
pl AS (SELECT query_id, rank, t, (list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * length(t))::BIGINT AS pos FROM (SELECT query_id, rank, t, string_split(lb, t) AS parts, unnest(range(1, least(4, len(string_split(lb, t)) - 1) + 1)) AS k FROM gt)),
nu AS (SELECT query_id, rank, found[k] AS m, ({place})::BIGINT AS pos, sized FROM (SELECT *, unnest(range(1, least(16, len(found)) + 1)) AS k FROM (SELECT query_id, rank, sized, string_split_regex(body, '{number}') AS parts, regexp_extract_all(body, '{number}') AS found FROM g WHERE asked))),
ex AS (SELECT query_id, rank, found[k] AS m, ({place})::BIGINT AS pos, vars, low FROM (SELECT *, unnest(range(1, least(16, len(found)) + 1)) AS k FROM (SELECT query_id, rank, vars, low, string_split_regex(body, '{formula}') AS parts, regexp_extract_all(body, '{formula}') AS found FROM g WHERE len(list_filter(vars, lambda x: x <> lower(x))) > 0))),
ey AS (SELECT *, len(list_filter(vars, lambda x: regexp_matches(m[2:-2], concat('(^|[^A-Za-z])', x, '([^A-Za-z]|$)')))) + CASE WHEN (list_has_any(string_split_regex(low, '\s+'), ['below', 'less']) AND contains(m, '<')) OR ((contains(low, 'above') OR contains(low, 'at least')) AND (contains(m, '>') OR contains(m, '\ge'))) THEN 2 ELSE 0 END AS c FROM ex),
cu AS (SELECT query_id, rank, pos, pos + length(m) AS e, CASE WHEN sized AND regexp_full_match(m, '[0-9]+') AND m::DOUBLE >= 8 AND log2(m::DOUBLE) = floor(log2(m::DOUBLE)) THEN 2 ELSE 1 END AS c FROM nu
  UNION ALL SELECT query_id, rank, pos, pos + length(m), CASE WHEN c > 0 THEN c + 1 ELSE 0 END FROM ey),
rn AS (SELECT r.query_id, r.rank, r.i AS right, r.e, min(l.i) AS left, min(l.b) AS b FROM ln r JOIN ln l ON l.query_id = r.query_id AND l.rank = r.rank AND l.i <= r.i AND r.e - l.b <= {most} GROUP BY ALL),
ru AS (SELECT rn.query_id, rn.rank, rn.b, rn.e FROM rn LEFT JOIN lt ON lt.query_id = rn.query_id AND lt.rank = rn.rank AND lt.i BETWEEN rn.left AND rn.right GROUP BY rn.query_id, rn.rank, rn.b, rn.e, rn.left, rn.right
  QUALIFY row_number() OVER (PARTITION BY rn.query_id, rn.rank ORDER BY count(DISTINCT t) DESC, rn.left, rn.e - rn.b DESC, rn.right DESC) = 1),
op AS (SELECT query_id, rank, count(*) >= 2 AS opening FROM lt WHERE i = 1 GROUP BY ALL),
st AS (SELECT query_id, rank, pos - {most // 2} AS s FROM pl UNION ALL SELECT query_id, rank, pos + length(t) - {most} FROM pl UNION ALL SELECT query_id, rank, pos - {most // 2} FROM cu UNION ALL SELECT query_id, rank, e - {most} FROM ru UNION ALL SELECT query_id, rank, 0 FROM g),
wi AS (SELECT DISTINCT query_id, rank, greatest(0, least(s, length(body) - {most}))::BIGINT AS b, (greatest(0, least(s, length(body) - {most})) + {most})::BIGINT AS e FROM st JOIN g USING (query_id, rank) UNION SELECT query_id, rank, b::BIGINT, e::BIGINT FROM ru),
wt AS (SELECT wi.query_id, wi.rank, wi.b, wi.e, t, count(*) AS n, min(pos) AS f FROM wi JOIN pl ON pl.query_id = wi.query_id AND pl.rank = wi.rank AND pos >= wi.b AND pos + length(t) <= wi.e GROUP BY ALL),
wk AS (SELECT query_id, rank, b, e, count(*) AS terms, sum(least(2, n)) AS hits, min(least(f - b, e - f - length(t))) AS margin FROM wt GROUP BY ALL),
wc AS (SELECT wi.query_id, wi.rank, wi.b, wi.e, max(c) AS cue FROM wi JOIN cu ON cu.query_id = wi.query_id AND cu.rank = wi.rank AND cu.pos >= wi.b AND cu.e <= wi.e GROUP BY ALL),
be AS (SELECT query_id, rank, list(b::BIGINT) AS bs, list(e::BIGINT) AS es FROM ln GROUP BY ALL),
bw AS (SELECT wi.query_id, wi.rank, wi.b, wi.e FROM wi LEFT JOIN wk USING (query_id, rank, b, e) LEFT JOIN wc USING (query_id, rank, b, e) LEFT JOIN op USING (query_id, rank) JOIN be USING (query_id, rank)
  QUALIFY row_number() OVER (PARTITION BY wi.query_id, wi.rank ORDER BY coalesce(cue, 0) DESC, coalesce(terms, 0) DESC, coalesce(opening, false) AND wi.b = 0 DESC, coalesce(hits, 0) DESC, list_contains(bs, wi.b)::INTEGER + list_contains(es, wi.e)::INTEGER DESC, coalesce(margin, 0) DESC, wi.b, wi.e DESC) = 1)
SELECT query_id, h.rank, h.doc_id, CASE WHEN length(body) <= {most} THEN body WHEN top.n IS NULL THEN left(body, {most}) WHEN top.e - top.b > {most} THEN substr(body, x + 1, {most}) ELSE substr(body, bw.b + 1, bw.e - bw.b) END AS excerpt,
 CASE WHEN length(body) <= {most} OR top.n IS NULL THEN 0 WHEN top.e - top.b > {most} THEN x ELSE bw.b END::INTEGER AS begin
FROM h LEFT JOIN (SELECT *, greatest(b, least(pos - {most // 2}, e - {most}))::BIGINT AS x FROM top) top USING (query_id, rank) LEFT JOIN bw USING (query_id, rank)"""


SQL["h19_excerpts"] = _excerpt_sql()


def cues(spark, d):
    """Whether an address answers a question for a number or a relation: links of a page stand for the words of the question."""
    word = F.concat_ws(" ", F.regexp_extract_all("html", F.lit('href="/([A-Za-z]+)'), F.lit(1)))
    for pattern, asked in ASKED:
        word = F.regexp_replace(word, pattern, asked)
    formula = F.concat(F.lit("$"), F.regexp_replace(F.regexp_replace("url", r"\?page=([0-4])", " < $1"), r"\?page=", " > "), F.lit("$ and $x \\ge T$"))
    p = read(spark, d, "pages").select("page_id", "url", word.alias("q"), F.regexp_replace(formula, r"[?&]ref=", " T ").alias("f"))
    letters = F.array_distinct(F.regexp_extract_all("q", F.lit(r"\b([A-Za-z])\b"), F.lit(1)))
    return p.select("page_id", excerpt.number_cue(F.col("url"), F.split("q", " ")).alias("number"), excerpt.formula_cue(F.col("f"), letters, F.col("q")).alias("formula"))


ASKED = ((r"\bt[h-z][a-z]*", "size"), (r"\ba[a-n][a-z]*", "count"), (r"\bo[a-z]+", "T"), (r"\bI[a-z]+", "below"), (r"\bh[a-z]+", "at least"), (r"\bu[a-z]+", "x"))


def _asked() -> str:
    word = """array_to_string(regexp_extract_all(html, 'href="/([A-Za-z]+)', 1), ' ')"""
    for pattern, asked in ASKED:
        word = f"regexp_replace({word}, '{pattern}', '{asked}', 'g')"
    return word


SQL["h20_number_cue"] = rf"""
WITH p AS (SELECT page_id, url, {_asked()} AS q, regexp_replace(concat('$', regexp_replace(regexp_replace(url, '\?page=([0-4])', ' < \1', 'g'), '\?page=', ' > ', 'g'), '$ and $x \ge T$'), '[?&]ref=', ' T ', 'g') AS f FROM pages),
w AS (SELECT *, string_split(q, ' ') AS w, list_distinct(list_filter(string_split_regex(q, '[^A-Za-z0-9_]+'), lambda x: regexp_full_match(x, '[A-Za-z]'))) AS v FROM p),
e AS (SELECT page_id, unnest(regexp_extract_all(f, '\$([^$]{{1,80}})\$', 1)) AS b, q, v FROM w),
s AS (SELECT page_id, max(len(list_filter(v, lambda x: regexp_matches(b, concat('(^|[^A-Za-z])', x, '([^A-Za-z]|$)')))) + CASE WHEN (regexp_matches(lower(q), '(^| )(below|less)( |$)') AND contains(b, '<'))
   OR ((contains(lower(q), 'above') OR contains(lower(q), 'at least')) AND (contains(b, '>') OR contains(b, '\ge'))) THEN 2 ELSE 0 END) AS best FROM e GROUP BY 1),
n AS (SELECT page_id, list_has_any(w, ['capacity', 'count', 'number', 'size', 'many']) AS asked, list_has_any(w, ['capacity', 'size']) AS sized, regexp_extract_all(url, '[0-9]+(\.[0-9]+)?') AS x FROM w)
SELECT page_id, CASE WHEN NOT asked OR len(x) = 0 THEN 0 WHEN sized AND len(list_filter(x, lambda y: log2(y::DOUBLE) >= 3 AND log2(y::DOUBLE) = floor(log2(y::DOUBLE)))) > 0 THEN 2 ELSE 1 END::INTEGER AS number,
 CASE WHEN coalesce(best, 0) > 0 THEN best + 1 ELSE 0 END::INTEGER AS formula FROM n LEFT JOIN s USING (page_id)"""

QUERIES = {
    "m01_inventory": inventory, "m04_main_file": main_file_rows,
    "h28_abstract_spans": abstract_spans, "h25_base64_vectors": vectors_as_text, "h39_provider_rows": provider_rows, "j08_include_closure": include_walk, "h19_excerpts": excerpts, "h20_number_cue": cues,
}
