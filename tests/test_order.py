"""Running numbers, percentiles and numbered paths against plain loops."""

import random
import statistics

import pytest

from lodestack.operators import order
from lodestack.plans import records


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_running_number_like_a_sort(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice("aaaaab"), i, rng.random()) for i in rng.sample(range(1000), 300)]
    got = order.running_number(spark.createDataFrame(rows, "g string, i long, x double").repartition(5), ["g"], ["i"], parts=parts).collect()
    want = {(g, i): n for k in "ab" for n, (g, i, _) in enumerate(sorted(r for r in rows if r[0] == k), 1)}
    assert {(r.g, r.i): r.number for r in got} == want and len(got) == 300


def test_no_range_holds_a_group(spark):
    dealt = order.ranged(spark.range(4000).selectExpr("'hot' AS g", "id"), ["g"], ["id"], 8)
    assert max(r["count"] for r in dealt.groupBy("_part").count().collect()) < 1000


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 50, list(map(float, range(101))), [1.5, 1.5, 2.25, 9.0, 9.0, 9.0, 10.0]])
def test_percentiles_like_sorted_lists(spark, values):
    rows = [("a", v) for v in values] + [("b", v * 3) for v in values[:3]] + [("a", None), (None, 1.0), ("c", None)]
    wanted = {"low": (0.0, False), "p95": (0.95, False), "line": (0.95, True), "mid": (0.5, True), "top": (1.0, False)}
    got = {r.g: r for r in order.percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", wanted, 4).collect()}
    assert set(got) == {"a", "b"}
    for g in "ab":
        v = sorted(x for k, x in rows if k == g and x is not None)
        at = 0.95 * (len(v) - 1)
        low = int(at)
        line = v[low] + (at - low) * (v[min(low + 1, len(v) - 1)] - v[low])
        want = (v[0], v[max(0, -(-95 * len(v) // 100) - 1)], line, statistics.median(v), v[-1])
        assert [got[g][n] for n in wanted] == pytest.approx(list(want), abs=1e-12)


def test_numbers_like_the_two_passes(spark):
    rng = random.Random(3)
    taken = [(d, n) for d in "xy" for n in rng.sample(range(1, 30), 8)]
    rows = [(rng.choice("xxyz"), i, rng.choice([None, rng.randint(1, 30)])) for i in range(120)]
    got = {r.id: (r.day, r.number) for r in records.allocated(spark.createDataFrame(rows, "day string, id long, wanted long"), spark.createDataFrame(taken, "day string, number long"), 5).collect()}
    used, want = {d: {n for k, n in taken if k == d} for d in "xyz"}, {}
    for d, i, w in rows:
        if w is not None and w not in used[d]:
            used[d].add(w)
            want[i] = (d, w)
    for d, i, _ in rows:
        if i not in want:
            n = max(used[d], default=0) + 1
            used[d].add(n)
            want[i] = (d, n)
    assert got == want
