"""Registered queries of TeX sources: cards, result and limitation cards, digests, reading views and plain words."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lodestack.functions import tex, text
from lodestack.sources.tables import read

SQL: dict = {}

# The tables hold no TeX: words of the texts decide where headings, statements, tables, equations and figures stand.
MARKS = (
    (r"(?m)^([A-Z][a-z]{1,3}) ([a-z]+) ", "\\section{Experiment $1 $2}\n% made of $2\n"),
    (r"(?m)^([A-Z][a-z]+) ([a-z]+) ", "\\subsection{$1 $2 limitations}\n"),
    (r"\. ([A-Z][a-z]{5,}) ([a-z]+) ", ".\n\\begin{theorem}[$1]\n\\label{thm:$2}\n\\name holds 50\\% of $2\n\\end{theorem}\n\\begin{proof}\nby \\emph{$1}\n\\end{proof}\n"),
    (r"\. ([A-Z][a-z]+) ([a-z]+) ", ".\n\\begin{lemma}\nSmall~$1 \\& $2 % not $1\n\\end{lemma}\n\n\n\n"),
    (r", ([a-z]+) (of|la|der|le|in) ", ",\n\\begin{table}\n\\caption{Scores of {$1}}\n\\label{tab:$1}\n$1 & $2\n\\end{table}\n"),
    (r", ([a-z]+) (et|und|the|de) ", ",\n\\begin{table*}\n\\begin{tabular}{ll}\n\\textbf{$1} & $2 \\\\\n\\end{tabular}\n\\caption{$2 of $1}\n\\end{table*}\n"),
    (r" ([a-z]{7,}) ([a-z]+), ", "\n\\begin{equation}\nx_{$1} = $2 \\label{eq:$2}\n\\end{equation}\n"),
    (r" ([a-z]{9,})\.", "\n\\begin{figure}\n\\includegraphics{$1.png}\n\\caption{Accuracy of $1}\n\\end{figure}\n"),
)
HEAD = (
    "\\documentclass{x}\n\\newcommand{\\name}{", "}\n\\title{On ", "}\n\\begin{document}\n\\begin{frontmatter}\nKeywords {of\nit\n\\end{frontmatter}\n\\author{",
    " {and\n others \\textbf{of {\n% not } this\nthe group}} at \\} once\\\\% or twice\n}}\n\\correspondingauthor{x}\n\\date{\n\\today}\n\\maketitle\n\\begin{abstract}\n", "\n\\end{abstract}\n\\vspace{1em}\n",
)
TAIL = "\n\\begin{thebibliography}{9}\n\\bibitem{x} Gone {with\n\\end{thebibliography}\nAfter the list.\n\\section{References}\n[1] ", "\n\\appendix\n\\section{Extra results}\n\\name\n\\end{document}\n"


def papers(spark, d):
    """(doc_id, tex): each document as a TeX source."""
    body = F.coalesce("text", F.lit(""))
    marked = body
    for pattern, mark in MARKS:
        marked = F.regexp_replace(marked, pattern, mark.replace("\\", "\\\\"))
    lang, source, opening = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")), F.substring_index(body, "\n", 1)
    whole = F.concat(F.lit(HEAD[0]), lang, F.lit(HEAD[1]), source, F.lit(HEAD[2]), source, F.lit(HEAD[3]), opening, F.lit(HEAD[4]), marked, F.lit(TAIL[0]), source, F.lit(TAIL[1]))
    return read(spark, d, "documents").select("doc_id", whole.alias("tex"))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _made() -> str:
    out = "coalesce(text, '')"
    for pattern, mark in MARKS:
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(re.sub(r'[$]([12])', r'\\\1', mark.replace(chr(92), chr(92) * 2)))}, 'g')"
    parts = [quoted(HEAD[0]), "lang", quoted(HEAD[1]), "source", quoted(HEAD[2]), "source", quoted(HEAD[3]), "string_split(coalesce(text, ''), chr(10))[1]", quoted(HEAD[4]), out, quoted(TAIL[0]), "source", quoted(TAIL[1])]
    return f"p AS (SELECT doc_id, concat({', '.join(parts)}) AS t FROM documents)"


LINES = "(length({0}) - length(replace({0}, chr(10), '')))"


def _plain(t: str) -> str:
    """SQL of tex.plain."""
    for _ in range(3):
        t = f"regexp_replace({t}, {quoted(tex.MARKUP)}, '\\1', 'g')"
    t = f"regexp_replace({t}, '\\\\[A-Za-z]+\\*?(\\[[^\\]]*\\])?', '', 'g')"
    return f"trim(regexp_replace(replace(replace(replace(replace({t}, '{{', ''), '}}', ''), '~', ' '), '\\&', '&'), '\\s+', ' ', 'g'))"


def _cards(kind: str) -> str:
    """SQL of one kind: starts and ends are counted from the stretches between the matches."""
    pattern, title = quoted(tex.PATTERNS[kind]), quoted(tex.TITLES.get(kind, tex.CAPTION))
    reach = f"+ {LINES.format(f'CASE WHEN i < len(v) THEN g[i + 1] ELSE left(g[i + 1], {tex.EXCERPT}) END')}" if kind == "section" else ""
    below = f"CASE WHEN i < len(v) THEN g[i + 1] ELSE left(g[i + 1], {tex.EXCERPT}) END"
    body = f"regexp_extract(v[i], {quoted(tex.BODY)}, 1)"
    shown = {
        "section": lambda: _plain(below), "statement": lambda: _plain(body), "equation": lambda: f"trim(regexp_replace(regexp_replace({body}, {quoted(tex.LABEL)}, '', 'g'), '\\s+', ' ', 'g'))",
        "table": lambda: _plain(f"coalesce(nullif(regexp_extract(v[i], {quoted(tex.TABULAR)}, 1), ''), {body})"), "figure": lambda: f"array_to_string(regexp_extract_all(v[i], {quoted(tex.INCLUDED)}, 1), ',')",
    }[kind]()
    name = quoted(r"\\((?:sub)*section)" if kind == "section" else r"\\begin\{([a-z]+)")
    before = f"1 + list_sum(list_transform(g[1:i], lambda x: {LINES.format('x')})) + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: {LINES.format('x')})), 0)"
    return f"""SELECT doc_id, '{kind}' AS kind, i::INTEGER AS place, regexp_extract(v[i], {name}, 1) AS name, left({shown}, {tex.SHOWN.get(kind, 1000000)}) AS excerpt,
 left({_plain(f'regexp_extract(v[i], {quoted(tex.PROOF)}, 1)')}, {tex.SHOWN['proof']}) AS proof, regexp_extract(v[i], {quoted(tex.LABEL)}, 1) AS label, {_plain(f'regexp_extract(v[i], {title}, 1)')} AS title,
 a::INTEGER AS line_start, (a + {LINES.format('v[i]')} {reach})::INTEGER AS line_end FROM (SELECT *, {before} AS a FROM (SELECT doc_id, v, g, unnest(range(1, least(len(v), {tex.LIMITS[kind]}) + 1)) AS i
 FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS v, string_split_regex(t, {pattern}) AS g FROM p)))"""


MADE = f"WITH {_made()}"
ALL_CARDS = f"{MADE}, c AS ({' UNION ALL '.join(_cards(k) for k in tex.PATTERNS)})"


def card_arrays(spark, d, brief=False):
    """(doc_id, tex, an array of cards for each kind)."""
    return papers(spark, d).select("doc_id", "tex", *[tex.cards(F.col("tex"), k, brief).alias(k) for k in tex.PATTERNS])


def tex_cards(spark, d):
    """Section, equation, statement, table and figure cards with labels, titles or captions and line spans."""
    return card_arrays(spark, d).select("doc_id", F.inline(F.concat(*tex.PATTERNS)))


SQL["m02_tex_cards"] = f"{ALL_CARDS} SELECT * FROM c"


def told_cards(spark, d):
    """Result and limitation cards, numbered again."""
    made = card_arrays(spark, d, brief=True)
    def side(name, cards):
        return F.transform(cards, lambda c, i: F.struct(F.lit(name).alias("card"), (i + 1).alias("place"), c["kind"].alias("source"), c["label"].alias("label"), c["title"].alias("title")))

    sides = F.concat(side("result", tex.result_cards(F.col("table"), F.col("figure"), F.col("section"))), side("limitation", tex.limitation_cards(F.col("section"))))
    return made.select("doc_id", F.inline(sides))


TOLD = f"""{ALL_CARDS}, r AS (SELECT doc_id, 'result' AS card, kind, place, label, title, CASE kind WHEN 'table' THEN 1 WHEN 'figure' THEN 2 ELSE 3 END AS o FROM c
  WHERE (kind = 'table' AND place <= 8) OR (kind = 'figure' AND place <= 8 AND regexp_matches(title, '{tex.RESULT_FIGURES}')) OR (kind = 'section' AND regexp_matches(title, '{tex.RESULTS}'))
  UNION ALL SELECT doc_id, 'limitation', kind, place, label, title, 1 FROM c WHERE kind = 'section' AND regexp_matches(title, '{tex.LIMITATIONS}')),
 told AS (SELECT * FROM (SELECT doc_id, card, row_number() OVER (PARTITION BY doc_id, card ORDER BY o, place)::INTEGER AS place, kind AS source, label, title FROM r) WHERE place <= CASE card WHEN 'result' THEN 20 ELSE 10 END)"""
SQL["m03_result_cards"] = f"{TOLD} SELECT * FROM told"

PAPER_TITLE, ABSTRACT = r"\\title\{([^{}]*)\}", r"(?is)\\begin\{abstract\}(.*?)\\end\{abstract\}"


def digest(spark, d):
    """One row a source: title, abstract, how many cards of each kind (40 sections at most), and warnings for kinds that lack."""
    c = card_arrays(spark, d, brief=True)
    warnings = F.array_compact(F.array(F.when(F.size("equation") == 0, "no_tex_equation_cards_detected"), F.when(F.size("figure") == 0, "no_figure_cards_detected")))
    return c.select(
        "doc_id", F.regexp_extract("tex", PAPER_TITLE, 1).alias("title"), F.substring(tex.plain(F.regexp_extract("tex", ABSTRACT, 1)), 1, 1200).alias("abstract"),
        F.least(F.size("section"), F.lit(40)).alias("sections"), *[F.size(k).alias(f"{k}s") for k in ("equation", "statement", "table", "figure")],
        F.size(tex.result_cards(F.col("table"), F.col("figure"), F.col("section"))).alias("results"), F.size(tex.limitation_cards(F.col("section"))).alias("limitations"),
        F.array_join(warnings, ",").alias("warnings"),
    )


def _count(kind: str) -> str:
    return f"count(*) FILTER (WHERE kind = '{kind}')::INTEGER"


SQL["m05_digest"] = f"""{TOLD}, k AS (SELECT p.doc_id, any_value(t) AS t, {', '.join(f'{_count(k)} AS {k}s' for k in tex.PATTERNS)} FROM p LEFT JOIN c USING (doc_id) GROUP BY p.doc_id),
 n AS (SELECT doc_id, count(*) FILTER (WHERE card = 'result')::INTEGER AS results, count(*) FILTER (WHERE card = 'limitation')::INTEGER AS limitations FROM told GROUP BY 1)
SELECT k.doc_id, regexp_extract(t, {quoted(PAPER_TITLE)}, 1) AS title, left({_plain(f'regexp_extract(t, {quoted(ABSTRACT)}, 1)')}, 1200) AS abstract, least(sections, 40)::INTEGER AS sections, equations, statements, tables, figures,
 coalesce(results, 0)::INTEGER AS results, coalesce(limitations, 0)::INTEGER AS limitations,
 concat_ws(',', CASE WHEN equations = 0 THEN 'no_tex_equation_cards_detected' END, CASE WHEN figures = 0 THEN 'no_figure_cards_detected' END) AS warnings FROM k LEFT JOIN n USING (doc_id)"""


def reading_views(spark, d):
    """Sources as readers get them: bodies and appendices without preambles, comments, authors and references."""
    return papers(spark, d).select("doc_id", tex.reading_view(F.col("tex")).alias("view"))


# by running counts and sums over lines, where the query folds them: what is open is told by braces since the last command, by environments begun and ended, and by the last mark of references
_FORMAT = r"^\s*\\(author|correspondingauthor|date|title)\{"
SQL["m09_source_view"] = rf"""{MADE}, l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS s, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS n FROM p),
 u AS (SELECT doc_id, n, rtrim(regexp_replace(s, '(^|[^\\])((?:\\\\)*)%.*$', '\1\2'), ' ' || chr(9) || chr(13)) AS s FROM l),
 d AS (SELECT *, length(regexp_replace(regexp_replace(s, '\\.', '', 'g'), '[^{{]', '', 'g')) - length(regexp_replace(regexp_replace(s, '\\.', '', 'g'), '[^}}]', '', 'g')) AS delta, regexp_matches(s, '{_FORMAT}')::INTEGER AS command FROM u),
 c AS (SELECT *, sum(command) OVER w AS run, coalesce(sum(contains(s, '\begin{{document}}')::INTEGER) OVER b, 0) AS begun,
   sum(regexp_matches(s, '^\s*\\begin\{{(frontmatter|thebibliography)\}}')::INTEGER) OVER w - coalesce(sum(regexp_matches(s, '\\end\{{(frontmatter|thebibliography)\}}')::INTEGER) OVER b, 0) AS inside,
   coalesce(last_value(CASE WHEN s = '\section{{References}}' THEN 1 WHEN s = '\appendix' THEN 0 END IGNORE NULLS) OVER w, 0) AS refs FROM d
   WINDOW w AS (PARTITION BY doc_id ORDER BY n), b AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 e AS (SELECT *, sum(delta) OVER (PARTITION BY doc_id, run ORDER BY n) AS depth FROM c),
 f AS (SELECT *, run > 0 AND coalesce(min(depth) OVER (PARTITION BY doc_id, run ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS open FROM e),
 k AS (SELECT doc_id, n, s FROM f WHERE begun > 0 AND refs = 0 AND inside = 0 AND command = 0 AND NOT open AND s <> '\end{{document}}' AND NOT regexp_matches(s, '^\s*\\(maketitle|vspace)'))
SELECT doc_id, trim(regexp_replace(string_agg(s, chr(10) ORDER BY n), '\n{{3,}}', chr(10) || chr(10), 'g'), chr(10)) AS view FROM k GROUP BY 1"""


def plain_words(spark, d):
    """Words of sources: comments cut, simple macros put in, markup gone."""
    # comments are cut before, not anew for each look at the macros
    return papers(spark, d).select("doc_id", tex.uncommented(F.col("tex")).alias("tex")).select("doc_id", tex.plain(tex.expanded(F.col("tex"))).alias("words"))


_uncommented = r"regexp_replace(t, '(^|[^\\])((?:\\\\)*)%[^\n]*', '\1\2', 'g')"
_expanded = rf"regexp_replace(regexp_replace({_uncommented}, '\\newcommand\{{\\name\}}\{{[^}}]*\}}', ''), '\\name([^A-Za-z])', regexp_extract(t, '\\name\}}\{{([^}}]*)\}}', 1) || '\1', 'g')"
SQL["h36_tex_strip"] = f"{MADE} SELECT doc_id, {_plain(_expanded)} AS words FROM p"

QUERIES = {"m02_tex_cards": tex_cards, "m03_result_cards": told_cards, "m05_digest": digest, "m09_source_view": reading_views, "h36_tex_strip": plain_words}
