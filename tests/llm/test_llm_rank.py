"""Ranked search, language of texts and fill-in-the-middle."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lodestack.llm import document_tree as dt
from lodestack.llm import fill_in_middle as fim
from lodestack.llm import string_kernel as sk

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    """(item index, rank, id, score) by scoring every document for every item."""
    words = [(i, plain_terms(t)) for i, t in docs if i is not None]
    words = [(i, w) for i, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for at, text in enumerate(items):
        scored = []
        for i, w in words:
            tf, m = Counter(w), 75 + 25 * len(w) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in plain_terms(text) if tf[t])
            if s > 0:
                scored.append((-s, i))
        out += [(at, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("k", [3, 20])
def test_search_like_plain_loop(spark, docs, texts, k):
    items = ["quick brown fox quick", "passage of the river stone light", None, "", "ZEBRA", "日本語 É é x", " ".join(texts[9].split()[:40]), texts[0]]
    frame = spark.createDataFrame([(i * 10, t, "z") for i, t in enumerate(items)] + [(0, items[0], "z")], "item_id int, text string, doc_id string")
    got = sorted((r.item_id // 10, r["rank"], r.doc_id, r.score) for r in dt.search(docs, frame, k).collect())
    rows = [*enumerate(texts), (0, texts[0])]  # the table repeats its first row
    assert got == sorted(plain_search(rows, [t or "" for t in items], k))


def test_search_of_nothing(spark, docs, none):
    items = spark.createDataFrame([(1, "quick"), (None, "lazy dog")], "item_id int, text string")
    assert dt.search(none, items).count() == 0
    assert dt.search(docs, items.limit(0)).count() == 0
    assert {r.item_id for r in dt.search(docs, items, 2).collect()} == {1, None}


def test_rounds_give_the_same(spark, docs, texts, monkeypatch):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts) if t and len(t) < 500], "item_id int, text string")
    want = sorted(map(tuple, dt.search(docs, items, 4).collect()))
    monkeypatch.setattr(dt, "QUERY_BYTES", 2500)
    assert sorted(map(tuple, dt.search(docs, items, 4).collect())) == want


@pytest.mark.parametrize("depth", [0, 1, 3, 12])
def test_tree_like_all_scores(monkeypatch, depth):
    monkeypatch.setattr(dt, "DEPTH", depth)
    rng = random.Random(depth)
    for _ in range(30):
        docs = []
        for i in range(rng.randint(1, 60)):
            terms = sorted(rng.sample(range(12), rng.randint(1, 8)))
            docs.append((i, rng.randint(75, 80), np.array(terms, np.int32), np.array([rng.randint(1, 3) for _ in terms], np.int32)))
            if rng.random() < 0.4:
                docs.append((i + 1000, *docs[-1][1:]))
        ids, m, rows, counts = zip(*docs, strict=True)
        cut = len(docs) // 2 or 1
        trees = [dt.Tree.of(np.array(ids[a:b]), np.array(m[a:b]), rows[a:b], counts[a:b]) for a, b in ((0, cut), (cut, len(docs))) if b > a]
        for k in (1, 4, 20):
            weight = np.array([rng.choice([0, 0, 3, 500, 7000]) for _ in range(12)], np.int64)
            best = []
            for tree in trees:
                tree.search(weight, best, k)
            score = {i: int(sum(dt.part_of_score(weight[t], int(c), mm) for t, c in zip(r, cs))) for i, mm, r, cs in docs}
            want = sorted((-s, i) for i, s in score.items() if s > 0)[:k]
            assert sorted((-s, -i) for s, i in best) == want


def test_bounds_leave_documents_out():
    """Few of many nodes are opened for a rare term."""
    rng = random.Random(1)
    rows = [np.array(sorted({*rng.sample(range(20), 8), *([25] if i % 40 == 0 else [])}), np.int32) for i in range(800)]
    counts = [np.array([rng.randint(1, 4) for _ in r], np.int32) for r in rows]
    tree = dt.Tree.of(np.arange(800), np.full(800, 100), rows, counts)
    weight, opened = np.zeros(30, np.int64), []
    weight[25] = 9000
    bounds = dt.Tree.bounds
    dt.Tree.bounds = lambda self, node, w: opened.append(node) or bounds(self, node, w)
    try:
        best = []
        tree.search(weight, best, 5)
    finally:
        dt.Tree.bounds = bounds
    assert len(best) == 5 and len(opened) < sum(1 for x in tree.last if x) / 3


def test_terms_across_pieces(monkeypatch):
    text = "Ab9 é-日本 x" * 50
    monkeypatch.setattr(dt, "PIECE", 7)
    assert [w.decode() for words in dt.terms_of(text.encode()) for w in words if w] == plain_terms(text)


def plain_grams(text):
    s = re.sub(r"[\W\d_]+", " ", " " + "".join(c if c.isalpha() else " " for c in text) + " ")
    s = "".join(c.lower() if len(c.lower()) == 1 else c for c in s)
    found = {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}
    found.discard(" ")
    return found if any(len(g) == 1 for g in found) else set()


def as_text(number):
    out = ""
    while number:
        out, number = chr(number & ((1 << 21) - 1)) + out, number >> 21
    return out


@pytest.mark.parametrize("piece", [1, 5, 1 << 20])
def test_grams_like_plain_sets(monkeypatch, piece):
    monkeypatch.setattr(sk, "PIECE", piece)
    for text in ["", "a", "A.", "12 ..", "Über die Größe, İz!", "日本語 text  x9y", "straße  ÉÉ", " lead", "tail  "]:
        assert {as_text(int(g)) for g in sk.gram_set(text.encode())} == plain_grams(text), text


def test_kernels_like_plain_sets(monkeypatch):
    monkeypatch.setattr(sk, "COLUMNS", 7)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé ñx") for _ in range(rng.randint(1, 40))) for _ in range(21)]
    marks = sk.Landmarks.of([t.encode() for t in texts[:11]])
    got, some = marks.kernels([t.encode() for t in texts] + [b"", b"12"])
    for i, t in enumerate(texts):
        for j, u in enumerate(texts[:11]):
            a, b = plain_grams(t), plain_grams(u)
            want = len(a & b) / math.sqrt(len(a) * len(b)) if a and b else 0
            assert abs(got[i, j] - want) < 1e-12
    assert not some[-2:].any() and not got[-2:].any()


def test_ridge_on_all_landmarks_is_kernel_ridge():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 6))
    own = x @ x.T + 1e-3 * np.eye(30)
    langs = ["a"] * 15 + ["b"] * 15
    names, weights, shift = sk.solve(own, langs, own, 1e-2)
    y = np.eye(2)[[0] * 15 + [1] * 15]
    # ridge regression in the dual, centred, with the same weight for every row
    h = np.eye(30) - 1 / 30
    alpha = np.linalg.solve(h @ own @ h + 30 * 1e-2 * np.eye(30), h @ y)
    want = h @ own @ h @ alpha + y.mean(0)
    assert names == ["a", "b"] and np.allclose(own @ weights + shift, want, atol=1e-6)


def test_language_held_out_and_awkward_rows(spark, sf, docs, none, texts):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    model = sk.fit(table.where(~sk.held_out()))
    got = sk.predict(table.select("doc_id", "text", "lang"), model).where(sk.held_out()).toPandas()
    assert len(got) > 40 and (got.lang == got.lang_pred).mean() > 0.97
    rows = sk.predict(docs, model).collect()
    assert len(rows) == docs.count() and set(rows[0].asDict()) == {*docs.columns, "lang_pred", "score"}
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in model.langs and 0 <= r.score <= 1
    assert sk.predict(none, model).count() == 0
    unknown = sk.fit(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang <> ''"))
    assert {(r.lang_pred, r.score) for r in sk.predict(docs, unknown).collect()} == {("und", 0)}
    one = sk.fit(docs)
    assert one.langs == ["en"] and {r.lang_pred for r in sk.predict(docs, one).collect()} == {"en", "und"}


def test_fit_does_not_depend_on_the_order(spark, docs):
    table = docs.withColumn("lang", docs.source)
    a, b = sk.fit(table), sk.fit(table.repartition(2))
    assert a.langs == b.langs and np.allclose(a.weights, b.weights)


def plain_fim(i, text):
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[j : j + 8], 16) for j in (0, 8, 16, 24))
    text, n = text or "", len(text or "")
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle_like_plain_slices(spark, docs, texts, none):
    extra = ["a<P>b", "<S>", "x<M", "<<P", "$1 \\ $", "line\r\n \u0085end\n", "😀" * 700, "\x00\n", "<", ">" * 300]
    rows = [(1000 + i, t, "f") for i, t in enumerate(extra * 4)]
    table = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(rows, "doc_id long, text string, lang string")).withColumnRenamed("lang", "fim_text")
    got = fim.transform(table).withColumn("back", fim.restored(fim.F.col("fim_text"), fim.F.col("fim_form"))).collect()
    assert len(got) == table.count()
    forms = Counter()
    for r in got:
        assert (r.fim_n, r.fim_form, r.fim_prefix, r.fim_middle, r.fim_text) == plain_fim(r.doc_id, r.text)
        assert r.back == (r.text or "")
        forms[r.fim_form] += 1
    assert min(forms[f] for f in ("plain", "psm", "spm")) > 0
    assert fim.transform(none).count() == 0
