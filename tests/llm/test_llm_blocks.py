"""Nearest neighbours, packing and the pipeline."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestack.llm import block_ann, line_quality, packing


def test_nearest_like_brute_force(spark):
    rng = np.random.default_rng(4)
    v = {i: rng.normal(size=6).astype("f4").tolist() for i in range(90)}
    for i in range(40, 60):
        v[i] = v[0]  # ties
    v[61], v[62], v[63], v[64], v[65], v[66] = None, [0.0] * 6, [float("nan")] + [1.0] * 5, [None] + [1.0] * 5, [], [1.0, 2.0]
    rows = [(i, x, "e") for i, x in v.items()] + [(3, v[3], "again"), (None, v[0], "n")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = defaultdict(list)
    for r in block_ann.nearest(frame, F.col("vec_id") % 3 == 0, 5, candidate_rows=20, query_rows=7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = {i: np.array(x, dtype=float) for i, x in v.items() if i not in range(61, 67)}
    for q in [i for i in good if i % 3 == 0]:
        want = sorted(((-float(good[q] @ good[c]), c) for c in good if c != q))[:5]
        assert [c for c, _ in got[q]] == [c for s, c in sorted((round(s, 9), c) for s, c in want)]
    assert set(got) == {i for i in good if i % 3 == 0}
    assert block_ann.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_best_fit_takes_the_tightest_bin_without_conflict():
    bins = packing.best_fit([6, 5, 4, 4, 2, 1], [0, 1, 2, 0, 1, 3], [-1] * 6, 10)
    assert bins == [0, 1, 0, 1, 2, 1]


def plain_best_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        fits = [(b["room"], k) for k, b in enumerate(bins) if b["room"] >= max(n, 1) and (s < 0 or s not in b["s"]) and (c < 0 or c not in b["c"])]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"room": capacity, "s": set(), "c": set()})
        bins[k]["room"] -= n
        bins[k]["s"].add(s)
        bins[k]["c"].add(c)
        out.append(k)
    return out


def test_best_fit_like_a_plain_search():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(0, 60)
        rows = [[rng.randint(1, 20) for _ in range(n)], [rng.randint(-1, 6) for _ in range(n)], [rng.randint(-1, 20) for _ in range(n)]]
        assert packing.best_fit(*rows, 20) == plain_best_fit(*rows, 20)


def test_rows_of_one_id_are_dealt_over_shards(spark):
    frame = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").alias("n_tokens"), F.lit("s").alias("source"), F.col("id").alias("cluster"))
    shards = {r.bin_id.split("-")[0] for r in packing.pack(frame, shard_rows=50).collect()}
    assert len(shards) > 10


def test_pack_keeps_every_row(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([0, 1, 30, 50, 100, 250]), f"s{rng.randint(0, 5)}" if i % 7 else None, rng.randint(0, 9)) for i in range(400)]
    rows += [(None, None, None, None), (1005, -3, "s1", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster long").withColumn("bin_id", F.lit("x"))
    got = packing.pack(frame, capacity=100, shard_rows=64).collect()
    total, used, held = defaultdict(int), defaultdict(int), defaultdict(list)
    row = {r[0]: r for r in rows}
    for r in got:
        total[r.doc_id] += r.length
        used[r.bin_id] += r.length
        if r.length < 100 or row[r.doc_id][1] == 100:
            held[r.bin_id].append(r.doc_id)
    for i, n, _, _ in rows[:400]:
        assert total[i] == n
    assert None in total and max(used.values()) <= 100
    assert all(used[r.bin_id] == r.bin_used for r in got)
    for ids in held.values():
        for k in (2, 3):
            seen = [row[i][k] for i in ids if i is not None and row[i][k] is not None]
            assert len(seen) == len(set(seen))
    assert packing.pack(frame.limit(0)).count() == 0


def test_pipeline(spark, sf):
    out = corpus_pipeline.run(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    assert out["doc_id"].isin(docs.index).all()
    kept = docs.loc[out["doc_id"].unique(), "text"]
    assert kept.is_unique
    good = labels[labels["quality"] == 1].index.intersection(docs.index)
    assert docs.loc[good, "text"].drop_duplicates().index.isin(out["doc_id"]).mean() > 0.7
    assert (out.groupby("bin_id")["length"].sum() <= corpus_pipeline.CAPACITY).all()


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)} if w else set()


def digits(value):
    return re.sub("[^0-9]", "", value)


def luhn(value):
    return sum((x := int(c) * (1 + i % 2)) - 9 * (x > 9) for i, c in enumerate(reversed(digits(value)))) % 10 == 0


def mod97(value):
    s = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


RULES = [
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("IP", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("CARD", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(v)),
    ("PHONE", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
    ("IBAN", r"(?<![A-Za-z0-9])(?:DE|GB)[0-9]{2}(?:\x20?[A-Z0-9]){18}(?![A-Za-z0-9])", mod97),
]


def plain_pipeline(rows, model):
    """The five stages as loops over (doc_id, text, source) rows: {(doc_id, piece): (offset, length)}, bins as sets of keys."""
    rows = [r for r in rows if model.score([r[1] or ""])[0] >= 0.7]
    last = {}
    for i, t, _ in rows:
        last[t or ""] = max(i, last.get(t or "", i))
    rows = sorted(r for r in rows if last[r[1] or ""] == r[0])
    sets = [grams(t or "") for _, t, _ in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):  # rows stand in order of ids
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) / len(a | b) >= 0.8:
                one, two = sorted((label[i], label[j]))
                label = [one if x == two else x for x in label]
    packed = []
    for k, (i, t, s) in enumerate(rows):
        if label[k] == k:
            t = t or ""
            for name, pattern, good in RULES:
                t = re.sub(pattern, lambda m, name=name, good=good: f"[{name}]" if good(m.group()) else m.group(), t)
            packed.append((i, len(re.findall(r"[^\x20\x09-\x0D]+", t)), s, t))
    cap = corpus_pipeline.CAPACITY
    pieces, bins = {}, []
    for i, n, _, _ in packed:
        for k in range(n // cap):
            pieces[i, k] = (k * cap, cap)
            bins.append({(i, k)})
    rest = sorted(((n % cap, i, n, s, t) for i, n, s, t in packed if n % cap or not n), key=lambda r: (-r[0], r[1]))
    ids = {x: k for k, x in enumerate({r[3] for r in rest} - {None})}
    texts = {x: k for k, x in enumerate({r[4] for r in rest})}
    numbers = plain_best_fit([r[0] for r in rest], [ids.get(r[3], -1) for r in rest], [texts[r[4]] for r in rest], cap)
    shared = defaultdict(set)
    for (tail, i, n, _, _), b in zip(rest, numbers, strict=True):
        pieces[i, n // cap] = (n - tail, tail)
        shared[b].add((i, n // cap))
    return pieces, {frozenset(b) for b in [*bins, *shared.values()]}


@pytest.mark.parametrize("part", ["table", "awkward"])
def test_pipeline_like_plain_loops(spark, sf, tmp_path, texts, part):
    if part == "awkward":
        extra = [
            "write to a.b@c.de or call +49 30 1234567 today", "card 4111 1111 1111 1111 and 4111 1111 1111 1112, host 10.0.0.1, not 10.0.0.256",
            "iban DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00 again", "a@b.c " * 3000,
        ]
        rows = [(i, t, "en", ("hot" if i % 3 == 0 else f"s{i % 4}") if i % 5 else None, len(t or "")) for i, t in enumerate([*texts, *extra])]
        sf_dir = str(tmp_path)
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf_dir}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    else:
        sf_dir = sf
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~line_quality.held_out())
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    pieces, bins = plain_pipeline(rows, line_quality.fit_documents(docs, labels))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.piece): (r.offset, r.length) for r in got} == pieces and len(got) == len(pieces)
    made = defaultdict(set)
    for r in got:
        made[r.bin_id].add((r.doc_id, r.piece))
        assert r.bin_used == sum(pieces[k][1] for k in bins_of(bins, r))
    assert {frozenset(b) for b in made.values()} == bins


def bins_of(bins, row):
    return next(b for b in bins if (row.doc_id, row.piece) in b)


def test_stages_keep_columns_and_take_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for frame in (docs.limit(0), docs.limit(5).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.col("text")))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, sf)
            assert frame.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, sf).count() >= 0
