"""Terms, excerpts, masks and other functions of a text, as column expressions."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CJK = "㐀-䶿一-鿿豈-﫿"
TERM = f"[0-9]{{1,3}}(?:,[0-9]{{3}})+|[A-Za-z0-9]+|[{CJK}]+"
# Words without weight in ranking; query words of each section kind; strict secret patterns.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "below", "by", "does", "for", "from", "how", "in", "is", "of", "or",
    "the", "to", "under", "used", "using", "was", "were", "what", "when", "which", "with",
)
KIND_ALIASES = {
    "summary": "一句话总结 一句话结论 TLDR paper takeaway concise summary",
    "abstract": "论文摘要 中文摘要 abstract paper summary contribution",
    "motivation": "Motivation 研究动机 problem framing why motivation",
    "methodology": "Methodology 方法拆解 方法机制 方法总览 技术路线 关键公式 机制推导 目标函数 损失函数 method mechanism pipeline architecture equation formula objective derivation symbol definition",
    "results": "关键实验结果 作者结论 实验结果 评估结果 figure table plot chart diagram axes panels ablation trend metrics benchmark results conclusion",
    "future": "对未来研究的启发 future work future research inspiration research ideas",
    "limitations": "可能的局限 limitations limitation failure modes bottlenecks caveats",
    "questions": "可继续追问的问题 open questions unresolved questions research questions",
}
ASSIGNED_SECRET = r"(?i)(api[_-]?key|token|password|secret)\s*[:=]\s*[\"']?([A-Za-z0-9_\-]{28,})"
STRICT_SECRETS = (
    r"sk-[A-Za-z0-9]{20,}", r"ghp_[A-Za-z0-9]{30,}", r"AKIA[0-9A-Z]{16}", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}",
    r"(?i)bearer [A-Za-z0-9._-]{24,}",
)


def query_terms(query: Column, most: int = 32) -> Column:
    """Distinct terms in order: grouped digits joined, ASCII runs of two or more in lower case, CJK runs whole or as bigrams."""
    runs = F.regexp_extract_all(query, F.lit(TERM), F.lit(0))

    def expand(run):
        plain = F.lower(F.replace(run, F.lit(","), F.lit("")))
        pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))
        ascii_terms = F.when(F.length(plain) >= 2, F.array(plain)).otherwise(F.array().cast("array<string>"))
        return F.when(run.rlike("^[0-9A-Za-z,]"), ascii_terms).when(F.length(run) <= 4, F.array(run)).otherwise(pairs)

    return F.slice(F.array_distinct(F.flatten(F.transform(runs, expand))), 1, most)


def legacy_terms(query: Column, most: int = 8) -> Column:
    return F.slice(F.regexp_extract_all(query, F.lit("[0-9A-Za-z_一-鿿]+"), F.lit(0)), 1, most)


def scoring_terms(terms: Column) -> Column:
    """Terms without stop words, or all of them if none is left."""
    left = F.filter(terms, lambda t: ~t.isin(*STOPWORDS))
    return F.when(F.size(left) > 0, left).otherwise(terms)


def term_coverage(text: Column, terms: Column, numeric_weight: Column | None = None) -> Column:
    """Weighted share of terms found in text; numbers need digit boundaries after dropping commas and braces."""

    def weight(t):
        return F.when(t.rlike("^[0-9]+$"), numeric_weight if numeric_weight is not None else F.lit(1)).otherwise(F.lit(1)).cast("double")

    def of_low(low):
        def hit(t):
            pattern = F.concat(F.lit("(^|[^0-9])"), t, F.lit("([^0-9]|$)"))
            return F.when(t.rlike("^[0-9]+$"), F.regexp_like(F.regexp_replace(low, "[,{}]", ""), pattern)).otherwise(F.contains(low, t))

        return F.filter(terms, hit)

    def total(part):
        return F.aggregate(part, F.lit(0.0), lambda acc, t: acc + weight(t))

    # lower case is bound once, not made anew for each term
    found = F.element_at(F.transform(F.array(F.lower(text)), of_low), 1)
    return F.when(F.size(terms) > 0, total(found) / total(terms)).otherwise(F.lit(0.0))


def expand_query(kind: Column, query: Column) -> Column:
    kind = F.lower(F.trim(kind))
    alias = F.create_map(*[F.lit(x) for kv in KIND_ALIASES.items() for x in kv])[kind]
    return F.concat_ws(" ", F.lit("raw_section"), F.concat(F.lit("section_kind "), kind), alias, F.nullif(F.trim(query), F.lit("")))


def token_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))


SPACES = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"  # Unicode's space separators


BLANKS = r"\t\n\x0b\f\r"


def squeeze(text: Column, blanks: str = BLANKS) -> Column:
    """text with one space for each run of spaces and `blanks` (as in a character class), without space separators at its ends."""
    # single spaces stay as they are, so that not every word is copied on its own
    return F.trim(F.regexp_replace(text, f"[ {blanks}]{{2,}}|[{blanks}]", " "), F.lit(SPACES))


def first_sentences(text: Column, most: int = 600, blanks: str = BLANKS) -> Column:
    return F.rtrim(F.substring(squeeze(text, blanks), 1, most), F.lit(SPACES))


def bullets(text: Column, most: int = 5) -> Column:
    """Lines without list marks longer than eight characters, cut to 240; the first 240 characters if there is none."""
    lines = F.transform(F.split(text, "\n"), lambda s: F.regexp_replace(F.trim(s), r"^[-*]\s+", ""))
    items = F.slice(F.transform(F.filter(lines, lambda s: F.length(s) > 8), lambda s: F.substring(s, 1, 240)), 1, most)
    return F.when(F.size(items) > 0, items).when(F.trim(text) != "", F.array(first_sentences(text, 240))).otherwise(F.array().cast("array<string>"))


def limited(text: Column, most: int) -> Column:
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, most)), F.lit(" ...[truncated]")))


def redact(text: Column, patterns: tuple[str, ...] = STRICT_SECRETS) -> Column:
    for p in patterns:
        text = F.regexp_replace(text, p, "[REDACTED]")
    return text


def evidence_hash(text_hash: Column, content_hash: Column, text: Column) -> Column:
    return F.coalesce(F.nullif(text_hash, F.lit("")), F.nullif(content_hash, F.lit("")), F.sha2(squeeze(F.coalesce(text, F.lit(""))), 256))


def embedding_text(title: Column, kind: Column, section: Column, path: Column, content: Column, most: int = 6000, blanks: str = BLANKS, stripped: bool = True) -> Column:
    """Header lines, an empty line and the squeezed content; without content the empty lines go, unless `stripped` is off."""
    body = F.coalesce(first_sentences(content, most, blanks), F.lit(""))
    head = [F.concat(F.lit(f"{name}: "), F.coalesce(c, F.lit(""))) for name, c in (("Title", title), ("Section kind", kind), ("Section title", section), ("Source path", path))]
    whole = F.concat_ws("\n", *head, F.lit(""), body)
    return F.concat(F.rtrim(whole, F.lit(" \n")) if stripped else whole, F.lit("\n"))


def prefixed(text: Column, prefix: str) -> Column:
    """text with an asymmetric-embedding prefix, added once."""
    return F.when(text.startswith(prefix), text).otherwise(F.concat(F.lit(prefix + " "), text))


def places(text: Column, pattern: str) -> Column:
    """Matches of a pattern as array of (value, start), start in characters from 0."""
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.transform(F.split(text, pattern, -1), F.length).alias("gaps"))

    def located(p):
        def step(acc, i):
            start = acc["at"] + F.element_at(p["gaps"], i)
            value = F.element_at(p["hits"], i)
            one = F.struct(value.alias("value"), start.alias("start"))
            return F.struct((start + F.length(value)).alias("at"), F.array_append(acc["out"], one).alias("out"))

        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<value:string,start:int>>").alias("out"))
        found = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(p["hits"]), F.lit(1))), none, step, lambda acc: acc["out"])
        return F.when(F.size(p["hits"]) > 0, found).otherwise(F.array().cast("array<struct<value:string,start:int>>"))

    # bound once, not evaluated anew for each match
    return F.element_at(F.transform(F.array(parts), located), 1)


def header_field(text: Column, name: str) -> Column:
    """Value of the first line `name: value`, else the empty string."""
    return F.trim(F.regexp_extract(text, rf"(?m)^{name}:\s*(.+)$", 1))


REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"  # what html.unescape looks at, one by one


def unescaped(text: Column) -> Column:
    """text with every named and numeric HTML entity replaced once, by the table of the standard library; only references go to Python, not the text around them."""

    def decode(batch: pd.Series) -> pd.Series:
        return batch.map(lambda found: [html.unescape(x) for x in found], na_action="ignore")

    found = F.when(F.contains(text, F.lit("&")), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))
    decoded = F.concat(F.pandas_udf(decode, "array<string>")(found), F.array(F.lit("")))
    return F.coalesce(F.array_join(F.zip_with(F.split(text, REFERENCE, -1), decoded, lambda gap, x: F.concat(gap, x)), ""), text)


def sanitised(text: Column) -> Column:
    """Trimmed text without entities and control characters."""
    return F.trim(F.regexp_replace(unescaped(F.trim(text)), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""))


def escaped_values(text: Column, field: str) -> Column:
    """Distinct values of a string field of JSON that may stand in a text escaped once or twice or with HTML entities.

    The text as it is comes first, then without its escapes, then the same without its entities; values
    stand in the order in which these four show them, trimmed and without escapes of their own. Null gives no value.
    """

    def slashes(t):
        for code, plain in (("\\/", "/"), ("\\u002F", "/"), ("\\u002f", "/"), ("\\u003A", ":"), ("\\u003a", ":")):
            t = F.replace(t, F.lit(code), F.lit(plain))
        return t

    def plain(t):
        for quote in ('\\\\"', '\\"') * 2:
            t = F.replace(t, F.lit(quote), F.lit('"'))
        return slashes(t)

    def values(t):
        return F.regexp_extract_all(t, F.lit(f'"{re.escape(field)}"\\s*:\\s*"([^"]*)"'), F.lit(1))

    text = F.coalesce(text, F.lit(""))
    found = F.concat(*[values(v) for t in (text, unescaped(text)) for v in (t, plain(t))])
    # entities are decoded in texts of values, one a text: lists go to Python as one text
    joined = unescaped(F.array_join(found, "\x1e"))
    return F.filter(F.array_distinct(F.transform(F.split(joined, "\x1e"), lambda v: slashes(F.trim(v)))), lambda v: v != "")


def wikilinks(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"\[\[([^\]]+)\]\]"), F.lit(1))
    names = F.transform(found, lambda t: F.trim(F.split(F.split(t, r"\|")[0], "#")[0]))
    return F.filter(names, lambda t: t != "")


def urls(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"https?://[^\s<>\"')\]]+"), F.lit(0))
    return F.filter(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?]+$", "")), lambda u: F.try_parse_url(u, F.lit("HOST")).isNotNull())
