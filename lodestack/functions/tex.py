"""TeX sources as column expressions: cards with line spans, plain words, macros, and the view without front and references."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squeeze


def block(*names: str) -> str:
    """Pattern of whole environments of these names."""
    return "|".join(rf"\\begin\{{{n}\*?\}}(?s:.*?)\\end\{{{n}\*?\}}" for n in names)


# Card kinds with their environments, and the most cards of a kind from one source.
STATEMENTS = ("theorem", "lemma", "proposition", "corollary", "definition", "remark", "example", "claim")
PATTERNS = {
    "section": r"\\(?:sub)?(?:sub)?section\*?\{(?s:.*?)\}",
    "equation": block("equation", "align", "gather", "multline"),
    "statement": f"(?:{block(*STATEMENTS)})(?:[ \\t\\r\\n]*{block('proof')})?",
    "table": block("table"),
    "figure": block("figure"),
}
LIMITS = {"section": 80, "equation": 60, "statement": 120, "table": 40, "figure": 80}
TITLES = {
    "section": r"section\*?\{((?s:.*?))\}",
    "statement": r"^\\begin\{[a-z]+\*?\}\[([^\]]*)\]",
}
CAPTION = r"\\caption\*?(?:\[[^\]]*\])?\{((?:[^{}]|\{[^{}]*\})*)\}"
LABEL = r"\\label\{([^{}]*)\}"
RESULTS = "(?i)result|experiment|evaluation|ablation|benchmark"
RESULT_FIGURES = "(?i)result|benchmark|performance|accuracy|score|ablation|实验|结果"
LIMITATIONS = "(?i)limitation|discussion|caveat|局限"
MACRO = r"\\(?:re)?newcommand[ \t]*\{\\([A-Za-z]+)\}(?:\[[0-9]+\])?[ \t]*\{([^{}\\]+)\}"
MARKUP = r"\\(?:textbf|textit|emph|section|subsection|caption|title|url)\*?(?:\[[^\]]*\])?\{([^{}]*)\}"
DROPPED = (
    "addtolength", "bibliography", "bibliographystyle", "declaremathoperator", "declarerobustcommand", "def", "documentclass", "hypersetup", "include", "input", "maketitle",
    "newcommand", "newtheorem", "pagestyle", "printbibliography", "providecommand", "renewcommand", "requirepackage", "setcounter", "setlength", "thispagestyle", "usepackage", "vspace",
)
FRONT = ("affiliation", "author", "date", "email", "institute", "thanks", "title")
BODY = r"(?s)^\\begin\{[a-z]+\*?\}(?:\[[^\]]*\])?(.*?)\\end\{"  # of the first environment of a card
PROOF = r"(?s)\\begin\{proof\}(?:\[[^\]]*\])?(.*)\\end\{proof"
TABULAR = r"(?s)\\begin\{tabular\}\{[^{}]*\}(.*?)\\end\{tabular\}"
INCLUDED = r"\\includegraphics(?:\[[^\]]*\])?\{([^{}]+)\}"
SHOWN = {"section": 600, "equation": 900, "statement": 1200, "table": 900, "proof": 900}  # characters of an excerpt
EXCERPT = 2000  # characters after the last heading that belong to it


def newlines(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit("\n"), F.lit("")))


def told(kind: str, value: Column, below: Column) -> Column:
    """Excerpt of a card of this kind: value is its source, below what follows a heading."""
    if kind == "figure":
        return F.array_join(F.regexp_extract_all(value, F.lit(INCLUDED), F.lit(1)), ",")
    body = F.regexp_extract(value, BODY, 1)
    if kind == "equation":
        return F.substring(squeeze(F.regexp_replace(body, LABEL, "")), 1, SHOWN[kind])
    rows = F.coalesce(F.nullif(F.regexp_extract(value, TABULAR, 1), F.lit("")), body)
    return F.substring(plain({"section": below, "statement": body, "table": rows}[kind]), 1, SHOWN[kind])


def cards(tex: Column, kind: str, brief: bool = False) -> Column:
    """Array of (kind, place, name, label, title, excerpt, proof, line_start, line_end), at most LIMITS[kind], in order.

    name is the level of a section or the environment. The excerpt is the plain text below a heading, the
    formula of an equation without its label, the body of a statement (its proof apart), the rows
    of a table, or the files of a figure.

    A section reaches to the next heading, the last one EXCERPT characters far; the other kinds
    span their environment, statements their proof too. A source without any gives an empty array.
    brief: without excerpt, proof and lines (null), for those who only count cards or read their titles.
    """
    # what all matches begin with is looked at first, not each environment at each character
    pattern, most = PATTERNS[kind] if kind == "section" else rf"(?=\\begin\{{)(?:{PATTERNS[kind]})", LIMITS[kind]
    shape = "array<struct<kind:string,place:int,name:string,label:string,title:string,excerpt:string,proof:string,line_start:int,line_end:int>>"
    hits = F.regexp_extract_all(tex, F.lit(pattern), F.lit(0))
    if brief:
        def named(value, i):
            name = F.regexp_extract(value, r"\\((?:sub)*section)" if kind == "section" else r"\\begin\{([a-z]+)", 1)
            return F.struct(
                F.lit(kind).alias("kind"), (i + 1).alias("place"), name.alias("name"), F.regexp_extract(value, LABEL, 1).alias("label"), plain(F.regexp_extract(value, TITLES.get(kind, CAPTION), 1)).alias("title"),
                *[F.lit(None).cast(t).alias(k) for k, t in (("excerpt", "string"), ("proof", "string"), ("line_start", "int"), ("line_end", "int"))],
            )

        return F.transform(F.slice(hits, 1, most), named).cast(shape)
    parts = F.struct(hits.alias("hits"), F.split(tex, pattern, most + 2).alias("gaps"))

    def found(p):
        def step(acc, i):
            value, after = F.element_at(p["hits"], i), F.element_at(p["gaps"], i + 1)
            start = acc["line"] + newlines(F.element_at(p["gaps"], i))
            end = start + newlines(value)
            below = F.when(i < F.size(p["hits"]), after).otherwise(F.substring(after, 1, EXCERPT))
            reach = newlines(below) if kind == "section" else F.lit(0)
            card = F.struct(
                F.lit(kind).alias("kind"), i.alias("place"), F.regexp_extract(value, r"\\((?:sub)*section)" if kind == "section" else r"\\begin\{([a-z]+)", 1).alias("name"),
                F.regexp_extract(value, LABEL, 1).alias("label"), plain(F.regexp_extract(value, TITLES.get(kind, CAPTION), 1)).alias("title"),
                told(kind, value, below).alias("excerpt"), F.substring(plain(F.regexp_extract(value, PROOF, 1)), 1, SHOWN["proof"]).alias("proof"), start.alias("line_start"), (end + reach).alias("line_end"),
            )
            return F.struct(end.alias("line"), F.array_append(acc["out"], card).alias("out"))

        none = F.array().cast(shape)
        out = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(F.size(p["hits"]), F.lit(most)), F.lit(1))), F.struct(F.lit(1).alias("line"), none.alias("out")), step, lambda acc: acc["out"])
        return F.when(F.size(p["hits"]) > 0, out).otherwise(none)

    # bound once, not evaluated anew for each card
    return F.element_at(F.transform(F.array(parts), found), 1)


def result_cards(tables: Column, figures: Column, sections: Column) -> Column:
    """At most 20 cards that tell results: the first 8 tables, those of the first 8 figures and all sections that say so."""
    told = F.filter(F.slice(figures, 1, 8), lambda c: c["title"].rlike(RESULT_FIGURES))
    return F.slice(F.concat(F.slice(tables, 1, 8), told, F.filter(sections, lambda c: c["title"].rlike(RESULTS))), 1, 20)


def limitation_cards(sections: Column) -> Column:
    return F.slice(F.filter(sections, lambda c: c["title"].rlike(LIMITATIONS)), 1, 10)


def expanded(tex: Column) -> Column:
    """tex with its simple macros put in, the first definition of a name counting."""
    both = F.arrays_zip(F.regexp_extract_all(tex, F.lit(MACRO), F.lit(1)).alias("name"), F.regexp_extract_all(tex, F.lit(MACRO), F.lit(2)).alias("value"))

    def put(acc, m):
        return F.regexp_replace(acc, F.concat(F.lit(r"\\"), m["name"], F.lit(r"(?:\{\})?(?![A-Za-z])")), squeeze(m["value"]))

    return F.aggregate(both, F.regexp_replace(tex, MACRO, ""), put)


def uncommented(tex: Column) -> Column:
    """tex without comments; a percent sign behind an odd number of backslashes stays."""
    return F.regexp_replace(tex, r"(?=[\\%])(?<!\\)((?:\\\\)*+)%[^\n]*", "$1")


def plain(tex: Column) -> Column:
    """Words without markup: known commands give their argument, others and braces go."""
    for _ in range(3):
        tex = F.regexp_replace(tex, MARKUP, "$1")
    tex = F.regexp_replace(tex, r"\\[A-Za-z]+\*?(?:\[[^\]]*\])?", "")
    tex = F.replace(F.regexp_replace(tex, "[{}]", ""), F.lit("~"), F.lit(" "))
    return squeeze(F.replace(tex, F.lit(r"\&"), F.lit("&")))


# Fixed values of the reading view: environments and commands of front matter, and commands whose line goes.
FORMAT_ENVIRONMENT = re.compile(r"\\begin\{([^{}]*(?:frontmatter|author[^{}]*|affiliation[^{}]*)\*?|references\*?|thebibliography\*?)\}", re.I)
FORMAT_COMMAND = re.compile(rf"\\[A-Za-z@]*?(?:author[A-Za-z@]*|{'|'.join(FRONT)})\*?(?![A-Za-z@*])", re.I)
DROPPED_COMMAND = re.compile(rf"\\(?:{'|'.join(DROPPED)})\*?(?![A-Za-z@*])", re.I)
REFERENCES = re.compile(r"\\(?:section|chapter)\*?\{\s*(?:References|Bibliography|参考文献)\s*\}|\\begin\{(?:thebibliography|references)\}", re.I)
APPENDIX = re.compile(r"\\appendix(?![A-Za-z0-9_])|\\begin\{appendices\}|\\section\*?\{\s*Appendix", re.I)
COMMENT = re.compile(r"(?<!\\)((?:\\\\)*)%.*")
INSIDE, LAST, OUT = "inside", "last", "out"  # what a line is to the stretch that is left out before it


def depth_of(line: str) -> int:
    """Braces that a line opens and does not close; escaped ones do not count."""
    bare = re.sub(r"\\.", "", line)
    return bare.count("{") - bare.count("}")


def _environment(name: str):
    end = re.compile(rf"\\end\{{{re.escape(name)}\}}", re.I)
    return lambda line: LAST if end.search(line) else INSIDE


def _command(depth: int):
    def braces(line: str) -> str:
        nonlocal depth
        depth += depth_of(line)
        return INSIDE if depth > 0 else LAST

    return braces


def _references(line: str) -> str:
    return OUT if APPENDIX.search(line) else INSIDE


def _left_out(line: str):
    """What a line begins that readers do not get: (whether the line itself goes, the test of the lines after it)."""
    if m := FORMAT_ENVIRONMENT.match(line):
        return True, _environment(m[1])
    if REFERENCES.search(line):
        return True, _references
    if DROPPED_COMMAND.match(line) or r"\end{document}" in line:
        return True, None
    if FORMAT_COMMAND.match(line):
        depth = depth_of(line)
        return True, _command(depth) if depth > 0 else None
    return False, None


def view_of(tex: str) -> str:
    """The body of one source, in one pass over its lines."""
    lines = [COMMENT.sub(r"\1", line).rstrip() for line in tex.split("\n")]
    begin = next((i + 1 for i, line in enumerate(lines) if r"\begin{document}" in line), 0)
    kept, skip = [], None
    for line in lines[begin:]:
        if skip is not None:
            state = skip(line)
            if state != INSIDE:
                skip = None
            if state != OUT:
                continue
        goes, skip = _left_out(line.strip())
        if not goes:
            kept.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip("\n")


def reading_view(tex: Column) -> Column:
    """The body for readers: no preamble, comments, front matter, format commands or references; appendices stay.

    Commands and environments of many lines go as a whole, however deep their braces. The state of a
    line depends on all before it, so that a source is one pass in a batch of sources; null stays null.
    """

    def views(batch: pd.Series) -> pd.Series:
        return batch.map(view_of, na_action="ignore")

    return F.pandas_udf(views, "string")(tex)
