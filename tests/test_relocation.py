"""Stored spans found again, fields out of escaped JSON, and budgets, against plain Python."""

import random
from collections import Counter

from pyspark.sql import functions as F

from lodestack.functions import text
from lodestack.operators import planner
from lodestack.operators.relocation import STATES, relocated

SPANS = "span_id string, source_id string, start int, block string, text string"


def plainly(start, block, source):
    if source is None:
        return "missing", None
    now, lines = source.split("\n"), block.split("\n")
    found = [i + 1 for i in range(len(now) - len(lines) + 1) if now[i : i + len(lines)] == lines]
    if start in found:
        return "current", start
    if len(found) == 1:
        return "relocated", found[0]
    return ("ambiguous" if found else "stale"), None


def test_relocation_like_a_search_of_all_places(spark):
    draw = random.Random(4)
    words = ["", "a", "b", "## a", "é 한", "a.b*"]
    sources = [(f"s{i}", "\n".join(draw.choice(words) for _ in range(draw.randrange(0, 9)))) for i in range(40)] + [("none", None)]
    spans = []
    for source, now in [*sources, ("gone", None)]:
        lines = (now or "").split("\n")
        for j in range(12):
            a = draw.randrange(len(lines))
            block = "\n".join(lines[a : a + draw.randrange(1, 4)]) if draw.random() < 0.8 else "\n".join(draw.choice(words) for _ in range(2))
            spans.append((f"{source}:{j}", source, draw.choice([a + 1, a + 2, 1, 0, -3, 99, None]), block, "extra"))
    spans += [("x", "s0", 1, None, ""), (None, "s0", 1, "a", ""), ("y", None, 1, "a", "")]
    got = relocated(spark.createDataFrame(spans, SPANS), spark.createDataFrame([(*s, 7) for s in sources], "source_id string, text string, start int")).collect()
    texts = dict(sources)
    want = {(i, s): plainly(start or 0, block, texts.get(s)) for i, s, start, block, _ in spans if None not in (i, s, block)}
    assert len(got) == len(want)
    assert {(r.span_id, r.source_id): (r.state, r.line) for r in got} == want
    assert set(Counter(r.state for r in got)) == set(STATES)
    assert relocated(spark.createDataFrame([], SPANS), spark.createDataFrame([], "source_id string, text string")).count() == 0


def test_values_of_escaped_fields(spark):
    rows = [
        (1, r'{"u":"one", "v":"no", "u" : " two "}', ["one", "two"]),
        (2, r'{\"u\":\"http:\/\/x\"} {"u":"plain"}', ["plain", "http://x"]),
        (3, r'\\\"u\\\": \\\"twice\\\"', ["twice"]),
        (4, r"&quot;u&quot;:&quot;/a:b&amp;c&quot;", ["/a:b&c"]),
        (5, r'"u":"same" \"u\":\"same\" "u":""', ["same"]),
        (6, r'"uu":"x" "u": 7 u:"y"', []),
        (7, "", []),
        (8, None, []),
        (9, '"u":"' + "long " * 20000 + '"', [("long " * 20000).strip()]),
    ]
    got = spark.createDataFrame([r[:2] for r in rows], "i int, t string").select("i", text.escaped_values(F.col("t"), "u").alias("v")).collect()
    assert {r.i: r.v for r in got} == {i: v for i, _, v in rows}


def test_budgets_hold_their_limits(spark):
    got = spark.createDataFrame([(k,) for k in (1, 8, 9, 40, 41, 100)], "k int").select("k", planner.candidate_budget(F.col("k")).alias("c"), planner.scope_budget(F.col("k")).alias("s")).collect()
    assert [(r.c, r.s) for r in got] == [(min(200, max(40, 5 * k)), min(min(200, max(40, 5 * k)), max(20, 3 * k))) for k in (1, 8, 9, 40, 41, 100)]
