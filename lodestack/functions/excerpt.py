"""Query-aware excerpts of selected texts; a small helper of an Arrow function, run on selected rows only."""

from __future__ import annotations

import bisect
import itertools
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that ask for a number.
NUMERIC_WORDS = {"capacity", "count", "number", "size", "many"}


def numeric_cue(part: str, terms: list[str]) -> int:
    """0 without a number (or if none is asked for), 2 for a power of two of at least 8 where a size is asked for, else 1."""
    if not NUMERIC_WORDS & set(terms):
        return 0
    numbers = re.findall(r"\d+(?:\.\d+)?", part)[:64]
    if not numbers:
        return 0
    if {"capacity", "size"} & set(terms):
        for n in numbers:
            if n.isdigit() and int(n) >= 8 and int(n) & (int(n) - 1) == 0:
                return 2
    return 1


def math_cue(part: str, variables: set[str], query: str) -> int:
    """1 plus the variables that the best $expression$ covers, plus 2 if its relation is the one asked for; 0 for none."""
    words, best = set(query.lower().split()), 0
    for body in re.findall(r"\$([^$]{1,80})\$", part):
        found = sum(bool(re.search(rf"(?<![A-Za-z]){re.escape(v)}(?![A-Za-z])", body)) for v in variables)
        below = words & {"below", "less"} and "<" in body
        above = ("above" in query.lower() or "at least" in query.lower()) and (">" in body or "\\ge" in body)
        best = max(best, found + 2 * bool(below or above))
    return best + 1 if best else 0


SECTION, CONTENT = "[LLM_WIKI_RAW_SECTION]", "\n## Section Content\n"
HITS, CUES = 4, 16  # places of one term, and numbers or expressions, that windows are laid around


def line_run(ends: list[int], found: list[set], most: int) -> tuple[int, int] | None:
    """First and last line of the run within `most` characters that holds most terms; then the earliest, then the longest, then the last."""
    best, left, begins = None, 0, [0, *ends[:-1]]
    for right, end in enumerate(ends):
        while left <= right and end - begins[left] > most:
            left += 1
        if left <= right:
            key = (len(set().union(*found[left : right + 1])), -left, end - begins[left], right)
            best = max(best, key) if best else key
    return best and (-best[1], best[3])


def excerpt(body: str, terms: list[str], most: int, query: str = "") -> tuple[str, int]:
    """(window, begin) of at most `most` characters of body.

    A body that fits is returned whole and one without any term gives its opening. If the line with
    most terms is longer than the window, the window lies around its first term. Otherwise windows
    are laid around terms, numbers and expressions, at the opening and along the best run of lines,
    and the best one is taken by answer cue, distinct terms, heading cue, hits (two of a term at
    most), line boundaries, margin of terms to the rims, earliest start and greatest length.
    """
    if len(body) <= most:
        return body, 0
    after = body.find(CONTENT) if body.startswith(SECTION) else -1
    floor = after + len(CONTENT) if after >= 0 else 0
    lines = body.splitlines(keepends=True)
    ends = list(itertools.accumulate(map(len, lines)))
    begins = [0, *ends[:-1]]
    finders = {t: re.compile(re.escape(t), re.IGNORECASE) for t in terms}
    places = {t: [m.start() for m in f.finditer(body, floor)] for t, f in finders.items()}
    found = [set() for _ in lines]
    for t, starts in places.items():
        for at in starts:
            found[bisect.bisect_right(begins, at) - 1].add(t)
    top = max(range(len(lines)), key=lambda i: (len(found[i]), -i))
    if not found[top]:
        return body[:most], 0
    if len(lines[top]) > most:
        first = min(at for starts in places.values() for at in starts if begins[top] <= at < ends[top])
        begin = max(begins[top], min(first - most // 2, ends[top] - most))
        return body[begin : begin + most], begin

    last = len(body) - most
    places = {t: starts[:HITS] for t, starts in places.items()}
    cues = []
    if NUMERIC_WORDS & set(terms):
        cues += [(*m.span(), numeric_cue(m.group(), terms)) for m in itertools.islice(re.finditer(r"\d+(?:\.\d+)?", body), CUES)]
    variables = {v for v in re.findall(r"\b[A-Za-z]\b", query) if v.lower() not in ("a", "i")}
    if any(v.isupper() for v in variables):
        cues += [(*m.span(), math_cue(m.group(), variables, query)) for m in itertools.islice(re.finditer(r"\$[^$]{1,80}\$", body), CUES)]
    opening = sum(bool(f.search(lines[0])) for f in finders.values()) >= 2
    centres = [at for starts in places.values() for at in starts] + [c[0] for c in cues]
    starts = {at - most // 2 for at in centres} | {at + len(t) - most for t, ats in places.items() for at in ats} | {0}
    run = line_run(ends, found, most)
    if run:
        starts.add(ends[run[1]] - most)
    windows = {(b, b + most) for b in (max(0, min(s, last)) for s in starts)} | ({(begins[run[0]], ends[run[1]])} if run else set())
    begin_set, end_set = set(begins), set(ends)

    def key(window):
        begin, end = window
        inside = {t: kept for t, ats in places.items() if (kept := [at for at in ats if begin <= at and at + len(t) <= end])}
        margin = min((min(ats[0] - begin, end - ats[0] - len(t)) for t, ats in inside.items()), default=0)
        cue = max((c for a, b, c in cues if begin <= a and b <= end), default=0)
        hits = sum(min(2, len(ats)) for ats in inside.values())
        return cue, len(inside), opening and begin == 0, hits, (begin in begin_set) + (end in end_set), margin, -begin, end - begin

    begin, end = max(windows, key=key)
    return body[begin:end], begin


def with_excerpt(rows, most: int):
    """rows (..., text, query, terms) with excerpt and begin; text and query go."""
    @F.pandas_udf("excerpt string, begin int")
    def run(body: pd.Series, query: pd.Series, terms: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([excerpt(b or "", list(t) if t is not None else [], most, q or "") for b, q, t in zip(body, query, terms, strict=True)], columns=["excerpt", "begin"])

    return rows.withColumn("_e", run("text", "query", "terms")).select("*", "_e.excerpt", "_e.begin").drop("_e", "text", "query")


def number_cue(part: Column, terms: Column) -> Column:
    """numeric_cue as a column expression."""
    numbers = F.slice(F.regexp_extract_all(part, F.lit(r"\d+(?:\.\d+)?"), F.lit(0)), 1, 64)

    def power(n):
        whole = n.try_cast("long")
        return F.coalesce(n.rlike(r"^\d+$") & (whole >= 8) & (whole.bitwiseAND(whole - 1) == 0), F.lit(False))

    asked = F.arrays_overlap(terms, F.array(*[F.lit(w) for w in sorted(NUMERIC_WORDS)]))
    sized = F.arrays_overlap(terms, F.array(F.lit("capacity"), F.lit("size")))
    return F.when(~asked | (F.size(numbers) == 0), 0).when(sized & F.exists(numbers, power), 2).otherwise(1)


def formula_cue(part: Column, variables: Column, query: Column) -> Column:
    """math_cue as a column expression; variables are letters."""
    low = F.lower(query)
    words = F.split(F.trim(low), r"\s+")
    below = F.arrays_overlap(words, F.array(F.lit("below"), F.lit("less")))
    above = F.contains(low, F.lit("above")) | F.contains(low, F.lit("at least"))

    def score(body):
        covered = F.size(F.filter(variables, lambda v: F.regexp_like(body, F.concat(F.lit("(?<![A-Za-z])"), v, F.lit("(?![A-Za-z])")))))
        lower, higher = F.contains(body, F.lit("<")), F.contains(body, F.lit(">")) | F.contains(body, F.lit("\\ge"))
        return covered + F.when((below & lower) | (above & higher), 2).otherwise(0)

    best = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(part, F.lit(r"\$([^$]{1,80})\$"), F.lit(1)), score)), F.lit(0))
    return F.when(best > 0, best + 1).otherwise(0)
