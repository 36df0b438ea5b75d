"""Markdown structure: headings, sections, titles, tables, front matter."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import stem

HEADING = r"^(#{1,6})\s+(.+?)\s*#*\s*$"
# Section kinds, with prefixes and contained words of their headings.
KIND_PREFIXES = {
    "summary": ["一句话总结", "一句话结论", "tl;dr", "tldr", "最小闭环", "先说整体判断", "核心要点"],
    "abstract": ["论文摘要", "中文摘要", "摘要", "abstract", "paper abstract"],
    "motivation": ["motivation", "研究动机", "显式 motivation", "动机"],
    "methodology": ["methodology", "method:", "method：", "method /", "method ", "方法", "方法论", "技术路线", "实验方法", "阅读方法"],
    "results": ["关键实验结果", "实验结果", "作者结论", "主要结果", "结果", "评估结果", "results", "experiments", "evaluation"],
}
KIND_CONTAINS = {
    "results": ["关键实验结果", "作者结论", "experimental results", "main results", "evaluation results", "benchmark results"],
    "future": ["对未来研究的启发", "未来研究", "启发", "future work", "future research", "inspiration"],
    "limitations": ["可能的局限", "局限", "limitations", "limitation", "failure mode", "failure modes"],
    "questions": ["可继续追问的问题", "继续追问", "追问", "open question", "open questions", "unresolved question"],
}
NOTE_TYPES = ("raw-note", "paper-note")
KINDS = ("summary", "abstract", "motivation", "methodology", "results", "future", "limitations", "questions")


def level(line: Column) -> Column:
    """Heading level of a line, 0 if it is none."""
    return F.when(~line.startswith("#"), 0).otherwise(F.length(F.regexp_extract(line, HEADING, 1)))


def heading_title(line: Column) -> Column:
    return F.trim(F.regexp_extract(line, HEADING, 2))


def heading_key(title: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.lower(title), r"\s+", " ")), r"^[\s#>*`_~\-–—•·]+", ""))


def heading_kinds(title: Column) -> Column:
    """Section kinds that a heading matches, in the order of KINDS; a heading may have several."""

    def of_key(key):
        tests = []
        for kind in KINDS:
            ok = F.lit(False)
            for p in KIND_PREFIXES.get(kind, ()):
                ok = ok | key.startswith(p)
            for p in KIND_CONTAINS.get(kind, ()):
                ok = ok | F.contains(key, F.lit(p))
            tests.append(F.when(ok, F.lit(kind)))
        return F.array_compact(F.array(*tests))

    # bound once, not made anew for each test
    return F.element_at(F.transform(F.array(heading_key(title)), of_key), 1)


def sections(markdown: Column) -> Column:
    """Array of (ord, level, title, content): sections under headings of levels 2 to 6.

    A section ends at the next heading of its level or a smaller one; deeper headings are lines
    of it. One fold over the headings keeps the open section and those that are closed, as places
    among the lines; lines are put together once for each section.
    """
    shape = "struct<done:array<struct<level:int,title:string,first:int,after:int>>,level:int,title:string,first:int>"
    start = F.struct(
        F.array().cast("array<struct<level:int,title:string,first:int,after:int>>").alias("done"), F.lit(0).alias("level"),
        F.lit(None).cast("string").alias("title"), F.lit(0).alias("first"),
    ).cast(shape)

    def closed(acc, after):
        one = F.struct(acc["level"].alias("level"), acc["title"].alias("title"), acc["first"].alias("first"), after.alias("after"))
        return F.when(acc["title"].isNull(), acc["done"]).otherwise(F.array_append(acc["done"], one))

    def step(acc, h):
        opens = acc["title"].isNull() | (h["level"] <= acc["level"])
        fresh = F.struct(closed(acc, h["at"]).alias("done"), h["level"].alias("level"), heading_title(h["line"]).alias("title"), (h["at"] + 1).alias("first")).cast(shape)
        return F.when(opens, fresh).otherwise(acc)

    def of_lines(lines):
        marked = F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("at"), line.alias("line"))), lambda x: x["line"].startswith("##"))
        heads = F.filter(F.transform(marked, lambda x: F.struct(x["at"].alias("at"), level(x["line"]).alias("level"), x["line"].alias("line"))), lambda h: h["level"] >= 2)
        found = F.aggregate(heads, start, step, lambda acc: closed(acc, F.size(lines)))
        return F.transform(found, lambda s, i: F.struct(
            i.alias("ord"), s["level"].alias("level"), s["title"].alias("title"),
            F.trim(F.array_join(F.slice(lines, s["first"] + 1, s["after"] - s["first"]), "\n"), F.lit(" \n\t")).alias("content"),
        ))

    # lines are bound once, not made anew for each use
    return F.element_at(F.transform(F.array(F.split(F.replace(markdown, F.lit("\r\n"), F.lit("\n")), "\n")), of_lines), 1)


def section_text(found: Column, keywords: list[str]) -> Column:
    """Content of the first section whose title holds a keyword, else the empty string."""
    def ok(s):
        out = F.lit(False)
        for k in keywords:
            out = out | F.contains(F.lower(s["title"]), F.lit(k.lower()))
        return out

    return F.coalesce(F.get(F.filter(found, ok), F.lit(0))["content"], F.lit(""))


def title(front: Column, body: Column, path: Column) -> Column:
    """Front-matter title, else the first level-one heading, else the file name with spaces for dashes."""
    first = F.trim(F.regexp_extract(body, r"(?m)^# (.*)$", 1))
    return F.coalesce(F.nullif(F.trim(front), F.lit("")), F.nullif(first, F.lit("")), F.replace(stem(path), F.lit("-"), F.lit(" ")))


def is_table_row(line: Column) -> Column:
    s = F.trim(line)
    rule = s.rlike(r"^\|?(\s*:?-{3,}:?\s*\|)*\s*:?-{3,}:?\s*\|?$")
    return s.startswith("|") & (F.length(s) - F.length(F.replace(s, F.lit("|"), F.lit(""))) >= 2) & ~rule


def is_map_row(line: Column) -> Column:
    s = F.trim(line)
    return s.startswith("- ") | s.startswith("* ")


FRONT = re.compile(r"\A---\s*\n(.*?)\n---\s*(?:\n|\Z)", re.S)
DOUBLE, SINGLE = re.compile(r'"((?:[^"\\]|\\.)*)"\s*(?:#.*)?'), re.compile(r"'((?:[^']|'')*)'\s*(?:#.*)?")
KEY = re.compile(r"\s*(\"[^\"]*\"|'[^']*'|[^:]*?)\s*:(?:\s(.*))?$")
TEXT_MARK, LIST_MARK = re.compile(r"([|>])[+-]?[0-9]*\s*(?:#.*)?"), re.compile(r"\[(.*)\]\s*(?:#.*)?")
ESCAPES = {"n": "\n", "t": "\t"}


def scalar(value: str) -> str:
    """A front-matter scalar: double quotes with escapes, single quotes doubled inside, or plain without a comment behind it."""
    value = value.strip()
    if m := DOUBLE.fullmatch(value):
        return re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[1]), m[1])
    if m := SINGLE.fullmatch(value):
        return m[1].replace("''", "'")
    return re.sub(r"(?:^|\s+)#.*$", "", value).strip().strip("\"' ")


def text_of(mark: str, lines: list[str]) -> str:
    """A text of many lines: kept (|) as it stands below its first line's margin, or folded (>) to paragraphs; outer empty lines go."""
    margin = next((len(s) - len(s.lstrip()) for s in lines if s.strip()), 0)
    lines = [s[min(margin, len(s) - len(s.lstrip())) :] if s.strip() else "" for s in lines]
    whole = "\n".join(lines).strip("\n")
    return whole if mark == "|" else "\n".join(re.sub(r"\n", " ", p) for p in whole.split("\n\n"))


def front_of(text: str) -> dict[str, list[str]]:
    """Front matter of one text, in one pass over its lines."""
    found = FRONT.match(text)
    out: dict[str, list[str]] = {}
    above: list[tuple[int, str]] = []  # keys that the next one may stand below, with their indentation
    key, mark, parent, lines = None, "", 0, []
    for line in found[1].split("\n") if found else []:
        indent, bare = len(line) - len(line.lstrip()), line.strip()
        if mark and (not bare or indent > parent):
            lines.append(line)
            continue
        if mark:
            out[key], mark = [text_of(mark, lines)], ""
        if not bare or bare.startswith("#"):
            continue
        if key is not None and re.match("-(?: |$)", bare):
            out[key].append(scalar(bare[1:]))
        elif m := KEY.match(line):
            above = [a for a in above if a[0] < indent]
            name, value = m[1].strip("\"' "), (m[2] or "").strip()
            key = ".".join([*(k for _, k in above), name])
            if not value or value.startswith("#"):
                above.append((indent, name))
                out[key] = []
            elif t := TEXT_MARK.fullmatch(value):
                out[key], mark, parent, lines = [], t[1], indent, []
            elif t := LIST_MARK.fullmatch(value):
                out[key] = [v for v in map(scalar, t[1].split(",")) if v]
            else:
                out[key] = [scalar(value)]
    if mark:
        out[key] = [text_of(mark, lines)]
    return out


def front(text: Column) -> Column:
    """The front matter of a text with its rules, empty if there is none; white space is that of Python."""
    return F.regexp_extract(text, r"(?sU)\A---[\s\x1c-\x1f]*\n.*?\n---[\s\x1c-\x1f]*(?:\n|\z)", 0)


def front_matter(text: Column) -> Column:
    """Map of front-matter keys to lists of strings: scalars, [inline, lists], block lists, and texts of many lines (| and >).

    Keys of nested maps are joined by dots. What a line means depends on the keys open above it, so that a
    text is one pass in a batch, and only its front matter goes to Python. Of a repeated key the last value
    counts; a text without front matter has an empty map, null stays null.
    """

    def fronts(batch: pd.Series) -> pd.Series:
        return batch.map(front_of, na_action="ignore")

    return F.pandas_udf(fronts, "map<string, array<string>>")(front(text))


def structured(meta: Column) -> Column:
    """Whether front matter makes a structured note: by its type, or by its domain."""
    def value(key):
        return F.lower(F.coalesce(F.trim(F.get(meta[key], F.lit(0))), F.lit("")))

    return value("type").isin(*NOTE_TYPES) | (value("domain") == "paper")


def body(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\s*\n.*?\n---\s*(?:\n|\z)", "")
