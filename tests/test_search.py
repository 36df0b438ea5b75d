"""Substring search and passages against plain scans."""

import math
import random
import re

from pyspark.sql import functions as F

from lodestack.functions import text
from lodestack.operators import search
from lodestack.plans import planning
from lodestack.plans import search as plans_search

DOCS = "doc_id long, text string, path string, source string, kind string"


def plain_terms(text):
    return [t.lower() for t in re.findall(r"[0-9A-Za-z_一-鿿]+", text)]


def ungrouped(text):
    for _ in range(2):
        text = re.sub(r"([0-9])(?:,|\{,\})([0-9]{3})", r"\1\2", text)
    return text


def scan(docs, query, k):
    """The rules of the substring search over all documents of one query."""
    terms = list(dict.fromkeys(plain_terms(ungrouped(query or ""))[:8]))
    longest = sorted(terms, key=lambda t: (-len(t), terms.index(t)))[:4]
    anchors = (longest + [t for t in terms if re.search("[0-9]", t) and t not in longest])[:6]
    intent = bool(re.search(r"\b(?:formula|equation)\b|公式", query or "", re.I))
    found, others = [], []
    for i, text, path, source, kind in docs:
        low, way = ungrouped(text or "").lower(), (path or "").lower()
        wordy = [t for t in terms if len(t) >= 3 and not t.isdigit()]
        matches = sum((len(terms) if t.isdigit() else 1) for t in terms if t in low)
        score = sum((len(t) if intent else 1) for t in wordy if t in way)
        if any(t in low for t in anchors) or intent and any(t in way for t in wordy):
            found.append((not (intent and kind == "table.row"), -(score if intent else 0), -(matches + score), -matches, path or "", i, matches, score))
        elif any(t in low or t in way or t in (source or "").lower() for t in terms):
            others.append((path or "", i))
    best = [(r[5], r[6], r[7], "anchors") for r in sorted(found)[:k]]
    return best + [(i, 0, 0, "any") for _, i in sorted(others)[: max(0, k - len(best))]]


def test_fallback_like_a_scan(spark):
    rng = random.Random(4)
    words = "alpha beta Gamma delta epsilon zeta eta theta the of a 12 1,234,567 99{,}000 数据 公式 x_1 thetheta".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 9))), f"{rng.choice(['raw', 'notes', 'beta'])}/{rng.choice(words[:6]).lower()}-{i % 7}.md", rng.choice(["src1", "delta"]), rng.choice(["table.row", "text"])) for i in range(60)]
    docs += [(100, None, None, None, None), (101, "", "", "", "")]
    asked = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 10))) for _ in range(30)] + ["the of a", "formula of alpha theta", "zzz the", "1234567 equation", "99,000 x", "", None, "!!", "数 a"]
    for k in (3, 50):
        got = {}
        rows = search.like_fallback(spark.createDataFrame(docs, DOCS), spark.createDataFrame(list(enumerate(asked)), "query_id long, query string"), k)
        for r in sorted(rows.collect(), key=lambda r: r["rank"]):
            got.setdefault(r.query_id, []).append((r.doc_id, r.matches, r.path_score, r.stage))
        assert got == {q: want for q, text in enumerate(asked) if (want := scan(docs, text, k))}
    assert any(s == "any" for rows in got.values() for *_, s in rows)


def test_passages_of_any_length(spark):
    docs = [(0, "xx alpha beta yy gamma"), (1, "Alphabet of gammas"), (2, None), (3, "alpha  beta"), (4, "é alpha beta é"), (5, "alphas betas alpha betas")]
    passages = ["alpha beta", "gamma", "alpha", "pha be", "Alphabet", "xx alpha beta yy", "beta yy gam", "é", "", None, "alpha betas", "mm", "s betas a"]
    got = {(r.item_id, r.doc_id) for r in search.passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(passages)), "item_id long, passage string")).collect()}
    want = {(i, d) for i, p in enumerate(passages) if p and plain_terms(p) for d, t in docs if t and p in t}
    assert got == want


def test_fallback_shuffles_texts_not_their_tokens(spark):
    docs = [(i, " ".join(f"alpha{j} beta{j} w{(i + j) % 50}" for j in range(20)), f"raw/{i}.md", "src", "text") for i in range(400)]
    asked = [(q, f"alpha{q} beta1 w{q} alpha zz") for q in range(5)]
    spark.sparkContext.setJobGroup("fallback", "fallback")
    try:
        assert search.like_fallback(spark.createDataFrame(docs, DOCS), spark.createDataFrame(asked, "query_id long, query string"), 3).count() == 15
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup("fallback") for s in tracker.getJobInfo(j).stageIds}
    ran = [s for s in stages if tracker.getStageInfo(s)]
    assert sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in ran) < 1000  # 400 texts; they have 24,000 tokens


def shuffled(spark, job):
    """Records that the stages of a job write to shuffles."""
    spark.sparkContext.setJobGroup(job.__name__, job.__name__)
    try:
        job()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(job.__name__) for s in tracker.getJobInfo(j).stageIds}
    return sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages if tracker.getStageInfo(s))


def test_fallback_reads_texts_where_they_stand(spark):
    docs = [(i, f"alpha{i % 7} beta{i} w{i % 50}", f"raw/{i}.md", "src", "text") for i in range(2000)]
    rows, asked = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(q, f"alpha{q} beta1 w{q} zz") for q in range(5)], "query_id long, query string")
    assert shuffled(spark, lambda: search.like_fallback(rows, asked, 3).collect()) < 500  # 2000 texts


def test_fallback_in_rounds_and_parts_of_batches(spark, monkeypatch):
    monkeypatch.setattr(search, "LIKE_ROUND", 7)
    monkeypatch.setattr(search, "LIKE_CELLS", 100)
    test_fallback_like_a_scan(spark)


def test_terms_are_found_wherever_they_stand(monkeypatch):
    rng = random.Random(9)
    for most in (1 << 22, 40):
        monkeypatch.setattr(search, "LIKE_BYTES", most)
        terms = sorted({"".join(rng.choice("ab1据") for _ in range(rng.randint(1, 7))) for _ in range(150)})
        texts = [search.low("".join(rng.choice("aAb1据 \x00é") for _ in range(rng.choice([0, 1, 5, 90])))) for _ in range(60)]
        got = search.Held(terms).of(texts)
        assert [[t.encode() in text for text in texts] for t in terms] == got.tolist()
    assert search.Held([]).of([b"a"]).shape == (0, 1) and search.Held(["a"]).of([]).shape == (1, 0)
    assert search.low_ungrouped("K\u212a \u0130\u00c9 1,234{,}567 1,23") == "kk i\u00c9 1234567 1,23".encode()


def test_words_are_those_of_the_pattern():
    for text in ["", "A b_C 9", "éİstanbul KA", "数据A b_c é", "\x00\x7f\x85 a　b", "AÉB", "鿿ꀀ一㿿"]:
        assert [w.decode() for w in search.words_of(text)] == plain_terms(text)


def test_short_passages_of_one_begin_and_across_each_other(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("Tabé .") for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None]
    short = sorted({"".join(rng.choice("Tabé .") for _ in range(rng.randint(1, 4))) for _ in range(60)})
    for known in (short, []):
        got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", search.containing(known)("t").alias("p")).collect()
        assert all(r.p is None if r.t is None else sorted(r.p) == [p for p in known if p in r.t] for r in got)


def test_passages_in_many_rounds(spark, monkeypatch):
    plain = search.rounds
    monkeypatch.setattr(search, "rounds", lambda keys, most=0: plain(keys, 1))
    test_passages_of_any_length(spark)


def test_passages_shuffle_neither_texts_nor_their_words(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j) % 90}x{j}" for j in range(30))) for i in range(400)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j) % 90}x{j}" for j in range(4, 9))) for i in range(5)] + [(9, "w7x1")], "item_id long, passage string")
    assert shuffled(spark, lambda: search.passages(docs, items).collect()) < 1000  # 400 texts; they have 12,000 words


def plain_bm25(docs, query, k):
    """Scores of all documents that hold each of a query's first eight terms."""
    words = {i: plain_terms(t) for i, t in docs if t is not None}
    n, avg = len(docs), sum(map(len, words.values())) / len(words)
    terms = list(dict.fromkeys(plain_terms(query or "")[:8]))
    df = {t: sum(t in w for w in words.values()) for t in terms}
    out = []
    for i, w in words.items():
        if terms and all(t in w for t in terms):
            tf = {t: w.count(t) for t in terms}
            out.append((i, sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(w) / avg)) for t in terms)))
    return [i for i, _ in sorted(out, key=lambda r: (-round(r[1], 9), r[0]))][:k], dict(out)


def test_bm25_like_a_scan_in_rounds_of_terms(spark, monkeypatch):
    rng, plain = random.Random(7), search.rounds
    words = "alpha Beta gamma the THE of 数据 é x_1 12".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(80)] + [(90, None), (91, "")]
    asked = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(15)] + ["alpha zzz", "", None, "é", "the the of", " ".join(words) + " zzz"]
    for most in (100, 2):
        monkeypatch.setattr(search, "rounds", lambda keys, _=0, most=most: plain(keys, most))
        rows = search.bm25(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(asked)), "query_id long, query string"), 7).collect()
        for q, text in enumerate(asked):
            order, scores = plain_bm25(docs, text, 7)
            mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
            assert [r.doc_id for r in mine] == order
            assert all(abs(r.score - scores[r.doc_id]) < 1e-5 for r in mine)


def test_bm25_shuffles_no_postings(spark):
    docs = spark.createDataFrame([(i, " ".join(f"t{j}" for j in range(30)) + (" rare" if i % 40 == 0 else "")) for i in range(400)], "doc_id long, text string")
    asked = spark.createDataFrame([(q, f"rare t{q} t{q + 1} t{q + 2} t{q + 3} t{q + 4}") for q in range(0, 25, 5)], "query_id long, query string")
    assert shuffled(spark, lambda: search.bm25(docs, asked).collect()) < 3000  # 400 texts have 10,000 postings of these terms


def test_planner_texts_meet_rows_that_are_written(spark, sf, monkeypatch):
    plans, plain = [], planning.stored
    monkeypatch.setattr(planning, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or plain(df))
    planning.evidence(spark, sf)
    assert "Join" in plans[-1] and "Window" not in plans[-1]  # rows of unknown number would have texts shuffled
    assert str(text.term_coverage(F.col("t"), F.col("terms"))).count("lower(") == 1


def test_scores_send_texts_to_python_once(spark, sf, monkeypatch):
    plans, plain = [], search.stored

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df)

    for module in (search, plans_search):
        monkeypatch.setattr(module, "stored", noted)
    plans.append(plans_search.response_scores(spark, sf)._jdf.queryExecution().optimizedPlan().toString())
    assert sum(p.count("ArrowEvalPython") for p in plans) == 1


def test_passages_like_a_scan_of_all_texts(spark, monkeypatch):
    rng, plain = random.Random(8), search.rounds
    words = ["a", "B", "ab", "é", "a_b", "数", "数a", "9", "aéb"]

    def some(most):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "", " "]) for _ in range(rng.randint(0, most)))

    docs = [(i, some(40)) for i in range(150)] + [(200, None), (201, "")]
    asked = ["the a of b", "the a of", " a B ", "a B ab é a", "A a B", None, "", "é", ". ,"] + [some(6) for _ in range(150)]
    asked += [t[i : i + rng.randint(1, 20)] for _, t in docs[:100] if t for i in [rng.randrange(len(t))]]
    want = {(q, d) for q, p in enumerate(asked) if p and plain_terms(p) for d, t in docs if t and p in t}
    assert len(want) > 500
    for most in (1000, 90):
        monkeypatch.setattr(search, "rounds", lambda keys, _=0, most=most: plain(keys, most))
        rows = search.passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(asked)), "item_id long, passage string")).collect()
        assert len(rows) == len(want) and {(r.item_id, r.doc_id) for r in rows} == want


def test_a_common_beginning_is_no_key():
    known = [f"One and the same beginning w{i} x{i} end" for i in range(50)] + ["one two three", "two alone"]
    assert {len(v) for v in search.keyed(known).values()} == {1}
    assert sorted(p for v in search.keyed(known).values() for p in v) == sorted(known[:-1])
