"""Registered queries of Markdown notes: front matter, titles, headings, spans, links and seed edges."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.functions import ids, markdown, tex, text
from lodestack.plans.columns import CID, DOCS
from lodestack.plans.papers import quoted
from lodestack.sources.tables import corpus

SQL: dict = {}

# The tables hold no Markdown: words of the texts decide where headings, tables, lists and links stand, and what front matter says.
MARKS = (
    (r"(?m)^([A-Z][a-z]{1,2}) ([a-z]+) ", "# $1 $2\n"),
    (r"(?m)^([A-Z][a-z]{3,5}) ([a-z]+) ", "## Open questions of $1\n"),
    (r"(?m)^([A-Z][a-z]{6,7}) ", "### **Results** and  future work: $1 ##\n"),
    (r"(?m)^([A-Z][a-z]{8,}) ", "### Method $1\n"),
    (r", ([a-z]+) ([a-z]+)\.", "\n| $1 | [[$2]] |\n|---|:---:|\n| $1\n"),
    (r"\. ([A-Z][a-z]+) ([a-z]+) ", ".\n- $1: [[$2|see $1]]\n"),
    (r" (de|le|the|of|la|der|et) ([a-z]+), ", " [[ $2#$1]], "),
)
WORDS = r"([a-z]+)[^a-z]+([a-z]+)[^a-z]+([a-z]+)[^a-z]+([a-z]+)"
FRONT = ('---\ntitle: "', '"\ntype: ', "\ndomain: ", "\ntags: [", ", '", "']\n# not a heading\nsources:\n  - ../concepts/", '.md\n  - "https://example.org/', '"\n  - ../../../', ".md\n  - ./", ".md\n  - raw/clip/2401//", ".md\n---\n")


def notes(spark, d):
    """(doc_id, path, stem, role, md): each document as a Markdown note with front matter; the stem is its first word."""
    t = F.coalesce("text", F.lit(""))
    body = t
    for pattern, mark in MARKS:
        body = F.regexp_replace(body, pattern, mark)
    word = [F.regexp_extract(t, WORDS, k) for k in range(1, 5)]
    kind = F.regexp_replace(F.regexp_replace(word[0], "^[a-d].*$", "raw-note"), "^[g-l].*$", "paper-note")
    values = (F.regexp_extract(t, "([A-Z][a-z]{9,})", 1), kind, F.regexp_replace(word[1], "^[e-h].*$", "paper"), word[2], F.coalesce("lang", F.lit("")), word[2], word[3], word[2], word[3], word[0])
    md = F.concat(*[x for mark, value in zip(FRONT, values) for x in (F.lit(mark), value)], F.lit(FRONT[-1]), body)
    stem = F.coalesce(F.nullif(word[0], F.lit("")), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    c = corpus(spark, d).select("doc_id", F.concat(F.regexp_extract("path", "^.*/", 0), stem, F.lit(".md")).alias("path"), stem.alias("stem"), md.alias("md"))
    return c.withColumn("role", ids.role_of_type(ids.doc_type(F.col("path"))))


def _made() -> str:
    body = "t"
    for pattern, mark in MARKS:
        body = f"regexp_replace({body}, {quoted(pattern)}, {quoted(re.sub(r'[$]([12])', r'\\\1', mark))}, 'g')"
    word = [f"regexp_extract(t, {quoted(WORDS)}, {k})" for k in range(1, 5)]
    kind = f"regexp_replace(regexp_replace({word[0]}, '^[a-d].*$', 'raw-note'), '^[g-l].*$', 'paper-note')"
    values = ("regexp_extract(t, '([A-Z][a-z]{9,})', 1)", kind, f"regexp_replace({word[1]}, '^[e-h].*$', 'paper')", word[2], "lang", word[2], word[3], word[2], word[3], word[0])
    md = ", ".join(x for mark, value in zip(FRONT, values) for x in (quoted(mark), value))
    return f"""{DOCS}, e AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, regexp_extract(path, '^.*/', 0) AS folder FROM d),
 s AS (SELECT doc_id, folder, coalesce(nullif({word[0]}, ''), concat('doc-', doc_id)) AS stem, concat({md}, {quoted(FRONT[-1])}) AS front, {body} AS body FROM e),
 n AS (SELECT *, concat(folder, stem, '.md') AS path, CASE split_part(folder, '/', 1) WHEN '_meta' THEN 'meta_map' WHEN 'raw' THEN 'raw' WHEN 'notes' THEN 'wiki' ELSE 'compiled' END AS role FROM s)"""


MADE = _made()
META = r"""SELECT doc_id, path, stem, role, folder, body, regexp_extract(front, '(?m)^title: "(.*)"$', 1) AS title, regexp_extract(front, '(?m)^type: (.*)$', 1) AS type, regexp_extract(front, '(?m)^domain: (.*)$', 1) AS domain,
 list_filter(list_transform(string_split(regexp_extract(front, '(?m)^tags: .(.*).$', 1), ','), lambda x: trim(x, ' ''')), lambda x: x <> '') AS tags, regexp_extract_all(front, '(?m)^  - "?([^"\n]*)"?$', 1) AS sources FROM n"""


def with_front(spark, d):
    return notes(spark, d).select("*", markdown.front_matter(F.col("md")).alias("meta"), markdown.body(F.col("md")).alias("body"))


# more front matter, of the same words: texts of many lines, quotes, nested keys and lists that are indented or not
MORE = (
    "---\nabstract: >-\n  ", " ", "\n  more\n\n  ", "\ncode: |\n  # no comment ", "\n    ", "\nquote: \"say \\\"", "\\\"\\n# kept\" # gone\nsingle: 'it''s ",
    "' # gone\nlinks:\n  home: https://x.org/", " # gone\n  more:\n    deep: ", "\n  list:\n  - ", "\n  - \"a, ", "\"\nflags: [ \"", "\", 'b', ", " ] # gone\n",
)
PLACES = (0, 1, 2, 0, 1, 0, 2, 0, 1, 2, 3, 0, 1)  # of the words that stand between them
FIELDS = ("title", "tags", "sources", "abstract", "code", "quote", "single", "links.home", "links.more.deep", "links.list", "flags")


def front_rows(spark, d):
    """Values of front matter in all its forms, and the length of what follows."""
    word = [F.coalesce(F.nullif(F.regexp_extract(F.coalesce("text", F.lit("")), WORDS, k), F.lit("")), F.lit("none")) for k in range(1, 5)]
    more = F.concat(*[x for mark, k in zip(MORE, PLACES) for x in (F.lit(mark), word[k])], F.lit(MORE[-1]))
    rows = notes(spark, d).join(corpus(spark, d).select("doc_id", more.alias("more")), "doc_id").withColumn("md", F.concat("more", F.substr("md", F.lit(5))))
    meta = rows.select("doc_id", markdown.front_matter(F.col("md")).alias("meta"), F.length(markdown.body(F.col("md"))).cast("long").alias("body_chars"))
    return meta.select("doc_id", *[F.array_join(F.col("meta")[k], ",").alias(k.replace(".", "_")) for k in FIELDS], "body_chars")


def _front_sql() -> str:
    word = [f"coalesce(nullif(regexp_extract(coalesce(text, ''), {quoted(WORDS)}, {k}), ''), 'none')" for k in range(1, 5)]
    more = ", ".join(x for mark, k in zip(MORE, PLACES) for x in (quoted(mark), word[k]))
    return rf"""{MADE}, m AS (SELECT doc_id, concat({more}, {quoted(MORE[-1])}) AS more FROM documents), f AS (SELECT * FROM ({META}) JOIN m USING (doc_id))
SELECT doc_id, title, array_to_string(tags, ',') AS tags, array_to_string(sources, ',') AS sources, length(body)::BIGINT AS body_chars,
 replace(regexp_replace(trim(regexp_extract(more, '(?s)abstract: >-\n(.*?)\ncode:', 1), ' '), '([^\n])\n  ', '\1 ', 'g'), chr(10) || chr(10) || '  ', chr(10)) AS abstract,
 replace(substr(regexp_extract(more, '(?s)code: \|\n(.*?)\nquote:', 1), 3), chr(10) || '  ', chr(10)) AS code,
 replace(replace(regexp_extract(more, 'quote: "(.*)" # gone', 1), '\"', '"'), '\n', chr(10)) AS quote, replace(regexp_extract(more, 'single: ''(.*)'' # gone', 1), '''''', '''') AS single,
 trim(regexp_extract(more, 'home: (.*) # gone', 1)) AS links_home, regexp_extract(more, 'deep: (.*)', 1) AS links_more_deep, concat(regexp_extract(more, '\n  - ([a-z]*)\n', 1), ',', regexp_extract(more, '\n  - "(.*)"', 1)) AS links_list,
 concat_ws(',', nullif(regexp_extract(more, 'flags: . "([a-z]*)"', 1), ''), 'b', nullif(regexp_extract(more, '''b'', ([a-z]*) ', 1), '')) AS flags FROM f"""


SQL["h09_front_matter"] = _front_sql()


def titles(spark, d):
    return with_front(spark, d).select("doc_id", markdown.title(F.get(F.col("meta")["title"], F.lit(0)), F.col("body"), F.col("path")).alias("title"))


SQL["b04_title"] = f"{MADE} SELECT doc_id, coalesce(nullif(title, ''), nullif(trim(regexp_extract(body, '(?m)^# (.*)$', 1)), ''), replace(stem, '-', ' ')) AS title FROM ({META})"


def structured(spark, d):
    """Whether front matter makes a note a structured one."""
    return with_front(spark, d).select("doc_id", markdown.structured(F.col("meta")).alias("structured"))


SQL["b19_structured_note"] = f"{MADE} SELECT doc_id, type IN ('raw-note', 'paper-note') OR domain = 'paper' AS structured FROM ({META})"


def header_fields(spark, d):
    """Values of header lines; a field that is not there is empty."""
    return notes(spark, d).select("doc_id", *[text.header_field(F.col("md"), k).alias(k) for k in ("title", "tags", "absent")])


SQL["h41_header_field"] = f"""{MADE} SELECT doc_id, concat('"', title, '"') AS title, trim(regexp_extract(front, '(?m)^tags: (.*)$', 1)) AS tags, '' AS absent FROM ({META}) JOIN (SELECT doc_id, front FROM n) USING (doc_id)"""


# --- lines ---------------------------------------------------------------------------------
def lines(spark, d):
    """(doc_id, path, role, n, line): lines after the front matter, numbered in the whole note."""
    return lines_of(notes(spark, d))


def lines_of(rows):
    """lines() of any notes (doc_id, path, role, md)."""
    front = tex.newlines(F.substr("md", F.lit(1), F.length("md") - F.length("body")))
    # counted before the lines are told apart: beside posexplode it would be counted anew for each of them
    rows = rows.withColumn("body", markdown.body(F.col("md"))).select("doc_id", "path", "role", "body", front.alias("front"))
    rows = rows.select("doc_id", "path", "role", "front", F.posexplode(F.split("body", "\n")).alias("n", "line"))
    return rows.select("doc_id", "path", "role", (F.col("front") + F.col("n") + 1).alias("n"), "line")


L = """l AS (SELECT doc_id, path, role, unnest(string_split(body, chr(10))) AS line, (unnest(range(1, len(string_split(body, chr(10))) + 1)) + length(front) - length(replace(front, chr(10), '')))::INTEGER AS n FROM n),
 h AS (SELECT *, length(regexp_extract(line, '^(#{1,6})\\s+(.+?)\\s*#*\\s*$', 1)) AS level, trim(regexp_extract(line, '^(#{1,6})\\s+(.+?)\\s*#*\\s*$', 2)) AS title, trim(line) AS s FROM l)"""
IS_TABLE = "(starts_with(s, '|') AND length(s) - length(replace(s, '|', '')) >= 2 AND len(list_filter(string_split(trim(s, '|'), '|'), lambda x: NOT regexp_full_match(trim(x), ':?-{3,}:?'))) > 0)"
IS_MAP = "(starts_with(s, '- ') OR starts_with(s, '* '))"


def row_tests(spark, d):
    """Lines that are table rows (not the rules between them) or rows of a map."""
    tested = lines(spark, d).select("doc_id", "n", markdown.is_table_row(F.col("line")).alias("is_table"), markdown.is_map_row(F.col("line")).alias("is_map"), F.trim("line").alias("s"))
    return tested.where(F.col("s").startswith("|") | F.col("is_map")).drop("s")


SQL["h32_row_tests"] = f"{MADE}, {L} SELECT doc_id, n, {IS_TABLE} AS is_table, {IS_MAP} AS is_map FROM h WHERE starts_with(s, '|') OR {IS_MAP}"


def heading_kinds(spark, d):
    """Section kinds of every heading; one may have several."""
    return lines(spark, d).where(markdown.level(F.col("line")) > 0).select("doc_id", "n", F.array_join(markdown.heading_kinds(markdown.heading_title(F.col("line"))), ",").alias("kinds"))


def _kind_tests() -> str:
    key = r"trim(regexp_replace(trim(regexp_replace(lower(title), '\s+', ' ', 'g')), '^[\s#>*`_~\-–—•·]+', ''))"
    tests = []
    for kind in markdown.KINDS:
        found = [f"starts_with(k, '{p}')" for p in markdown.KIND_PREFIXES.get(kind, ())] + [f"contains(k, '{p}')" for p in markdown.KIND_CONTAINS.get(kind, ())]
        tests.append(f"CASE WHEN {' OR '.join(found)} THEN '{kind}' END")
    return f"SELECT doc_id, n, concat_ws(',', {', '.join(tests)}) AS kinds FROM (SELECT doc_id, n, {key} AS k FROM h WHERE level > 0)"


SQL["h11_heading_kinds"] = f"{MADE}, {L} {_kind_tests()}"


def spans(spark, d):
    """Heading, table-row and, in maps, list-row spans with the titles above them.

    The title of each level that stands last counts unless a smaller level came after it, so that
    running maxima replace a stack.
    """
    return spans_of(lines(spark, d))


def spans_of(rows):
    """spans() of any numbered lines."""
    level = markdown.level(F.col("line"))
    kind = F.when(level > 0, "doc.heading").when(markdown.is_table_row(F.col("line")), "table.row").when((F.col("role") == "meta_map") & markdown.is_map_row(F.col("line")), "map.row")
    rows = rows.withColumn("level", level).withColumn("span_kind", kind).where("span_kind IS NOT NULL")
    w = Window.partitionBy("doc_id").orderBy("n")
    title = markdown.heading_title(F.col("line"))
    rows = rows.withColumns({f"_{k}": F.max(F.when(F.col("level") == k, F.struct("n", title.alias("title")))).over(w) for k in range(1, 7)})
    above, top = [], F.lit(0)
    for k in range(1, 7):
        above.append(F.when(F.col(f"_{k}.n") > top, F.col(f"_{k}.title")))
        top = F.greatest(top, F.col(f"_{k}.n"))
    return rows.withColumn("heading_path", F.array_compact(F.array(*above))).select("doc_id", "path", "n", "level", "span_kind", "heading_path", F.trim("line").alias("text"))


STACK = f"""k AS (SELECT *, CASE WHEN level > 0 THEN 'doc.heading' WHEN {IS_TABLE} THEN 'table.row' WHEN role = 'meta_map' AND {IS_MAP} THEN 'map.row' END AS span_kind FROM h),
 x AS (SELECT *, {', '.join(f"last_value(CASE WHEN level = {i} THEN n END IGNORE NULLS) OVER w AS n{i}, last_value(CASE WHEN level = {i} THEN title END IGNORE NULLS) OVER w AS t{i}" for i in (1, 2, 3))} FROM k WHERE span_kind IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
 st AS (SELECT *, concat_ws(' > ', t1, CASE WHEN n2 > coalesce(n1, 0) THEN t2 END, CASE WHEN n3 > greatest(coalesce(n1, 0), coalesce(n2, 0)) THEN t3 END) AS heading_path FROM x)"""


def heading_stack(spark, d):
    """Each heading with the titles above it."""
    w = Window.partitionBy("doc_id").orderBy("n")
    return spans(spark, d).where("level > 0").select("doc_id", (F.row_number().over(w) - 1).alias("ord"), F.array_join("heading_path", " > ").alias("path"))


SQL["e12_heading_stack"] = f"{MADE}, {L}, {STACK} SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1)::INTEGER AS ord, heading_path AS path FROM st WHERE level > 0"


def span_rows(spark, d):
    """Spans with ids made of their place and content."""
    return named_spans(spans(spark, d))


def named_spans(rows):
    digest = F.substring(F.sha1(F.concat_ws("\n", "path", F.col("n").cast("string"), "span_kind", "text")), 1, 12)
    span_id = F.concat_ws(":", F.lit("lexical"), "path", F.col("n").cast("string"), "span_kind", digest)
    return rows.select("doc_id", span_id.alias("span_id"), F.col("n").alias("start_line"), "span_kind", F.array_join("heading_path", " > ").alias("heading_path"), "text")


SQL["i02_span_extraction"] = f"""{MADE}, {L}, {STACK} SELECT doc_id, concat_ws(':', 'lexical', path, n, span_kind, left(sha1(concat_ws(chr(10), path, n, span_kind, s)), 12)) AS span_id, n AS start_line, span_kind, heading_path, s AS text FROM st"""


# --- links ---------------------------------------------------------------------------------
def last_of(rows, key: str):
    """(key, target_id, target_path): of notes that share a key the last one counts."""
    last = F.max(F.struct("doc_id", "path"))
    return rows.groupBy(key).agg(last.alias("t")).select(key, F.col("t.doc_id").alias("target_id"), F.col("t.path").alias("target_path"))


def linked(rows):
    """(doc_id, path, link, links, target_id, target_path): wikilinks of compiled notes and maps, by the stem of a note."""
    found = rows.where(F.col("role").isin("compiled", "meta_map")).select("doc_id", "path", F.explode(text.wikilinks(F.col("md"))).alias("link"))
    found = found.groupBy("doc_id", "path", "link").agg(F.count(F.lit(1)).alias("links"))
    return found.join(last_of(rows, "stem").withColumnRenamed("stem", "link"), "link", "left")


def resolved_links(spark, d):
    """Wikilinks of notes with the note they mean, -1 for none."""
    return linked(notes(spark, d)).select("doc_id", "link", "links", F.coalesce("target_id", F.lit(-1)).alias("target_id"))


LINKS = r"""w AS (SELECT doc_id, path, link, count(*) AS links FROM (SELECT doc_id, path, trim(regexp_extract(unnest(regexp_extract_all(body, '\[\[[^\]]+\]\]')), '\[\[([^|#\]]*)', 1)) AS link FROM n WHERE role IN ('compiled', 'meta_map')) WHERE link <> '' GROUP BY ALL),
 stems AS (SELECT stem AS link, max(doc_id) AS target_id, arg_max(path, doc_id) AS target_path FROM n GROUP BY 1)"""
SQL["c08_wikilink_resolution"] = f"{MADE}, {LINKS} SELECT doc_id, w.link, links, coalesce(target_id, -1)::BIGINT AS target_id FROM w LEFT JOIN stems USING (link)"


def referred(rows):
    """(doc_id, path, ref, target, target_id, target_path): source references of front matter as paths below the root, with their note."""
    refs = rows.where(F.col("role").isin("compiled", "meta_map")).select("doc_id", "path", F.explode(F.col("meta")["sources"]).alias("ref")).where("ref <> '' AND NOT ref RLIKE '^https?://'")
    refs = refs.withColumn("target", ids.resolved_path(F.regexp_replace("path", "[^/]*$", ""), F.col("ref")))
    return refs.join(last_of(rows, "path").select(F.col("path").alias("target"), "target_id", "target_path"), "target", "left")


def resolved_sources(spark, d):
    """Source references with the path they lead to ('' above the root) and its note, -1 for none."""
    return referred(with_front(spark, d)).select("doc_id", "ref", "target", F.coalesce("target_id", F.lit(-1)).alias("target_id"))


REFS = f"""r AS (SELECT doc_id, path, ref, list_filter(string_split(folder, '/'), lambda x: x <> '') AS f, string_split(ref, '/') AS p, string_split(ref, '/')[1] IN ({', '.join(quoted(x) for x in ids.ROOTS)}) AS at_root FROM (SELECT doc_id, path, folder, unnest(sources) AS ref FROM ({META}) WHERE role IN ('compiled', 'meta_map')) WHERE ref <> '' AND NOT starts_with(ref, 'http')),
 u AS (SELECT doc_id, path, ref, CASE WHEN at_root THEN [] ELSE f END AS f, len(list_filter(p, lambda x: x = '..')) AS ups, list_filter(p, lambda x: x NOT IN ('', '.', '..')) AS rest FROM r),
 y AS (SELECT doc_id, path, ref, CASE WHEN ups > len(f) THEN '' ELSE array_to_string(list_concat(f[1:len(f) - ups], rest), '/') END AS target FROM u),
 paths AS (SELECT path AS target, max(doc_id) AS target_id FROM n GROUP BY 1)"""
SQL["c09_source_resolution"] = f"{MADE}, {REFS} SELECT doc_id, ref, target, coalesce(target_id, -1)::BIGINT AS target_id FROM y LEFT JOIN paths USING (target)"


def seed_edges(spark, d):
    """WIKILINKS_TO, SOURCED_BY and HAS_TAG edges of compiled notes and maps, with a running number in each note."""
    rows = with_front(spark, d)
    src = ids.canonical_id(F.col("path")).alias("src")

    def leg(found, tgt, kind, weight):
        return found.select("doc_id", src, tgt.alias("tgt"), F.lit(kind).alias("kind"), F.lit(weight).alias("weight"))

    target = ids.canonical_id(F.col("target_path"))
    tags = rows.where(F.col("role").isin("compiled", "meta_map")).select("doc_id", "path", F.explode(F.array_distinct(F.col("meta")["tags"])).alias("tag")).where("tag <> ''")
    legs = leg(linked(rows).where("target_id IS NOT NULL"), target, "WIKILINKS_TO", 1.0).unionByName(leg(referred(rows).where("target_id IS NOT NULL"), target, "SOURCED_BY", 1.0))
    edges = legs.distinct().unionByName(leg(tags, F.concat(F.lit("tag:"), "tag"), "HAS_TAG", 0.7))
    return edges.withColumn("edge_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("kind", "tgt")))


def _cid(path: str, stem: str) -> str:
    return CID.replace("concat('doc-', doc_id)", stem).replace("path", path)


SQL["j02_seed_edges"] = f"""{MADE}, {LINKS}, {REFS}, cid AS (SELECT doc_id, path, {_cid('path', 'stem')} AS cid FROM n),
 g AS (SELECT DISTINCT w.doc_id, a.cid AS src, b.cid AS tgt, 'WIKILINKS_TO' AS kind, 1.0::DOUBLE AS weight FROM w JOIN stems USING (link) JOIN cid a ON a.doc_id = w.doc_id JOIN cid b ON b.doc_id = stems.target_id
  UNION ALL SELECT DISTINCT y.doc_id, a.cid, b.cid, 'SOURCED_BY', 1.0 FROM y JOIN paths USING (target) JOIN cid a ON a.doc_id = y.doc_id JOIN cid b ON b.doc_id = paths.target_id
  UNION ALL SELECT DISTINCT t.doc_id, a.cid, concat('tag:', t.tag), 'HAS_TAG', 0.7 FROM (SELECT doc_id, unnest(tags) AS tag FROM ({META}) WHERE role IN ('compiled', 'meta_map')) t JOIN cid a ON a.doc_id = t.doc_id)
SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY kind, tgt)::INTEGER AS edge_no FROM g"""

QUERIES = {
    "h09_front_matter": front_rows, "b04_title": titles, "b19_structured_note": structured, "h41_header_field": header_fields, "h32_row_tests": row_tests, "h11_heading_kinds": heading_kinds,
    "e12_heading_stack": heading_stack, "i02_span_extraction": span_rows, "c08_wikilink_resolution": resolved_links, "c09_source_resolution": resolved_sources, "j02_seed_edges": seed_edges,
}
