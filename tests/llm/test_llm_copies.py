"""Exact copies, near copies and repeats against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestack.llm import exact_dedup, ngram_join, repeats, substring_dedup, suffix_levels


def test_exact_dedup(docs, texts):
    got = exact_dedup.exact_dedup(docs, block_bytes=16).collect()
    same = defaultdict(list)
    for i, t in enumerate(texts):
        same[t or ""].append(i)
    same[texts[0]].append(0)  # the repeated row
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.group_size == 1 and r.kept
            continue
        group = same[texts[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(group), len(group), r.doc_id == max(group))


def test_exact_dedup_does_not_depend_on_block_size(plain):
    one, two = ({tuple(r) for r in exact_dedup.exact_dedup(plain, block_bytes=b).collect()} for b in (7, 8192))
    assert one == two


def test_exact_dedup_of_nothing(none):
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.drop_copies(none).columns == none.columns


def test_drop_copies(docs, texts):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert Counter(r.text or "" for r in left.select("text").collect()) == Counter({*(t or "" for t in texts), "row without an id"})


def test_drop_copies_leaves_one_of_repeated_rows(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (None, "c"), (None, "c"), (4, None), (4, "")]
    left = exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, "c"), (2, "a"), (3, "b"), (4, "")]


def grams(text, n=5):
    w = (text or "").split()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def test_near_classes(plain, texts):
    sets = [grams(t) for t in texts]
    links = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and a and b and len(a & b) / len(a | b) >= 0.8}
    label = list(range(len(texts)))
    for _ in label:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r for r in ngram_join.near_classes(plain).collect()}
    assert [got[i].class_id for i in range(len(texts))] == label
    for i, s in enumerate(sets):
        other = {sets[b if a == i else a] for a, b in links if i in (a, b)} - {s}
        assert got[i].n_links == len(other)


def test_near_classes_edge_rows(docs, none):
    rows = ngram_join.near_classes(docs).collect()
    assert len(rows) == docs.count()
    assert [r.class_id for r in rows if r.doc_id is None] == [None]
    assert ngram_join.near_classes(none).count() == 0
    assert ngram_join.drop_near_copies(docs).columns == docs.columns


def test_drop_near_copies_leaves_one_row_of_a_class(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, base), (1, base + " x"), (2, base + " y"), (3, "other words here"), (3, "other words here"), (4, None), (4, ""), (5, ""), (None, base), (None, base)]
    left = ngram_join.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id or 0 for r in left) == [0, 0, 1, 3, 4, 5]
    lone = ngram_join.drop_near_copies(spark.createDataFrame([(i, f"text number {i}") for i in range(9)], "doc_id long, text string"))
    assert lone.count() == 9


@pytest.mark.parametrize("rows", [12, 13, 500])
def test_groups_of_all_sizes_like_brute_force(spark, rows):
    rng = np.random.default_rng(rows)
    texts = []
    for i in range(rows):
        w = [f"w{k}" for k in range(200)]
        for k in rng.choice(200, i % 5, replace=False):
            w[k] = f"x{i}"
        texts.append(" ".join(w))
    sets = [grams(t) for t in texts]
    got = {r.doc_id: r for r in ngram_join.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    links = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if texts[i] != texts[j] and len(a & b) / len(a | b) >= 0.8}
    other = defaultdict(set)
    for i, j in links:
        other[i].add(texts[j])
    assert [got[i].n_links for i in range(rows)] == [len(other[i]) for i in range(rows)]
    label = list(range(rows))
    first = {t: i for i, t in reversed(list(enumerate(texts)))}
    pairs = links | {(i, first[t]) for i, t in enumerate(texts)}
    for _ in range(rows):
        before = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    assert [got[i].class_id for i in range(rows)] == label


def test_large_buckets_use_landmarks(spark):
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        w = list(base)
        w[i * 4] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"y{i}_{k}" for k in range(50))) for i in range(5)]
    got = {r.doc_id: r.class_id for r in ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(60)} == {0}
    assert all(got[100 + i] == 100 + i for i in range(5))


@pytest.mark.parametrize("members", [1024, 16])
def test_links_of_large_groups_like_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(ngram_join, "MEMBERS", members)
    rng = np.random.default_rng(7)
    texts = []
    for i in range(60):
        w = [f"w{k}" for k in range(300)]
        for k in rng.choice(300, i % 8, replace=False):
            w[k] = f"x{i}"
        texts.append(" ".join(w))
    texts += [texts[1].replace(" ", "  "), texts[1], "a b c d e f g", "a b c d e  f g", "lone words here"]
    sets = [grams(t) for t in texts]
    got = {r.doc_id: r.n_links for r in ngram_join.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, a in enumerate(sets):
        assert got[i] == len({t for t, b in zip(texts, sets, strict=True) if len(a & b) / len(a | b) >= 0.8} - {texts[i]})
    assert len({got[i] for i in range(60)}) > 3


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.node: r.label for r in ngram_join.components(links).collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


@pytest.mark.parametrize("recall", [0.9, 0.999, 0.9999])
def test_bands_reach_the_recall(recall):
    bands, rows = ngram_join.choose_bands(0.8, recall)
    assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= 128


def brute_words(texts, length):
    words = [(t or "").split() for t in texts]
    first = {}
    for i, w in enumerate(words):
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), i)
    out = []
    for i, w in enumerate(words):
        gone = {p for s in range(len(w) - length + 1) if first[tuple(w[s : s + length])] < i for p in range(s, s + length)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


@pytest.mark.parametrize("part, group", [(1 << 20, 4096), (64, 4096), (1 << 20, 1)])
def test_substring_dedup(plain, texts, monkeypatch, part, group):
    monkeypatch.setattr(repeats, "PART", part)
    monkeypatch.setattr(repeats, "GROUP", group)
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(plain).collect()}
    for i, (n, gone, kept) in enumerate(brute_words(texts, 13)):
        assert (got[i].n_words, sum(got[i].ends) - sum(got[i].begins), got[i].kept) == (n, gone, kept)


def test_substring_dedup_edge_rows(docs, none):
    assert substring_dedup.remove_repeats(docs).count() == docs.count()
    assert substring_dedup.remove_repeats(none).count() == 0


def brute_bytes(texts, length):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(raw[s : s + length])
        out.append((len(raw), sum(gone), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("part, group", [(1 << 20, 4096), (300, 4096), (1 << 20, 1)])
def test_suffix_levels(plain, texts, monkeypatch, part, group):
    monkeypatch.setattr(repeats, "PART", part)
    monkeypatch.setattr(repeats, "GROUP", group)
    got = {r.doc_id: r for r in suffix_levels.remove_repeats(plain).collect()}
    for i, (n, gone, kept) in enumerate(brute_bytes(texts, 100)):
        assert (got[i].n_bytes, sum(got[i].ends) - sum(got[i].begins), bytes(got[i].kept)) == (n, gone, kept)


def test_suffix_levels_edge_rows(docs, none):
    assert suffix_levels.remove_repeats(docs).count() == docs.count()
    assert suffix_levels.remove_repeats(none).count() == 0


def test_rows_without_id_stand_in_order_of_their_hashes(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    frame = spark.createDataFrame([(None, "a " + passage), (None, "b b " + passage), (3, "c c c c")], "doc_id long, text string")
    words = sorted(sum(r.ends) - sum(r.begins) for r in substring_dedup.remove_repeats(frame).collect())
    raw = sorted(sum(r.ends) - sum(r.begins) for r in suffix_levels.remove_repeats(frame).collect())
    assert words == [0, 0, 40] and raw[:2] == [0, 0] and raw[2] >= len(passage)


@pytest.mark.parametrize("kind", [suffix_levels.byte_windows(20, 4), substring_dedup.word_windows(9, 3)])
def test_extension_like_brute_force(kind):
    rng = np.random.default_rng(3)
    bytes_ = kind.symbol == "u1"
    passage = rng.integers(97, 105, 60)
    many, windows, n_docs = [], defaultdict(list), 0
    for _ in range(24):
        parts, symbols, offset = [], [], 0
        for _ in range(5):
            a, b = sorted(rng.integers(0, 60, 2))
            text = np.concatenate([rng.integers(97, 105, 30), passage[a:b], rng.integers(97, 105, 30)]).astype("u1")
            x = text.astype("u8")
            r = repeats.segments(kind, [suffix_levels._BYTE[text] if bytes_ else x])
            sizes = r.count.astype(int) - 1 + kind.length
            parts.append((r.seed, np.full(len(r.seed), n_docs, "u4"), r.start, r.count, r.lead, offset + np.cumsum(sizes) - sizes))
            symbols.append((text if bytes_ else x)[repeats._stretches(r.start.astype(int), sizes)])
            offset += sizes.sum()
            for s in range(len(text) - kind.length + 1):
                windows[text[s : s + kind.length].tobytes()].append((n_docs, s))
            n_docs += 1
        many.append(repeats.Contexts(*map(np.concatenate, zip(*parts, strict=True)), np.concatenate(symbols)))
    got = kind.extend(many, np.arange(n_docs), kind)
    want = {p for places in windows.values() for p in places if (p > min(places) if kind.within else p[0] > min(places)[0])}
    assert want and set(zip(got.doc.tolist(), got.start.tolist(), strict=True)) == want


def test_levels_stay_few():
    kind = suffix_levels.byte_windows(20, 4)
    rng = np.random.default_rng(4)
    family = suffix_levels.SuffixLevels(np.arange(64), kind)
    for d in range(64):
        text = rng.integers(97, 123, 200).astype("u1")
        r = repeats.segments(kind, [suffix_levels._BYTE[text]])
        sizes = r.count.astype(int) - 1 + kind.length
        family.add(repeats.Contexts(r.seed, np.full(len(r.seed), d, "u4"), r.start, r.count, r.lead, np.cumsum(sizes) - sizes, text[repeats._stretches(r.start.astype(int), sizes)]))
        assert len(family.levels) <= 2 + np.log2(1 + sum(len(x.lead) for x in family.levels))


def test_digest_columns(spark, sf):
    got = substring_dedup.query(spark, sf).first()
    assert len(got.kept_sha256) == len(hashlib.sha256().hexdigest())


def test_small_batches_share_a_level(monkeypatch):
    kind = suffix_levels.byte_windows(20, 4)
    rng = np.random.default_rng(5)
    many = []
    for d in range(40):
        text = np.tile(rng.integers(97, 100, 40).astype("u1"), 2) if d % 2 else rng.integers(97, 99, 120).astype("u1")
        r = repeats.segments(kind, [suffix_levels._BYTE[text]])
        sizes = r.count.astype(int) - 1 + kind.length
        many.append(repeats.Contexts(r.seed, np.full(len(r.seed), d, "u4"), r.start, r.count, r.lead, np.cumsum(sizes) - sizes, text[repeats._stretches(r.start.astype(int), sizes)]))
    scans, scan, found = [], suffix_levels.scan, []
    monkeypatch.setattr(suffix_levels, "scan", lambda *args: scans.append(1) or scan(*args))
    for least in (1, 100, suffix_levels.ENTRIES):
        monkeypatch.setattr(suffix_levels, "ENTRIES", least)
        scans.clear()
        r = kind.extend(many, np.arange(40), kind)
        found.append((set(zip(r.doc.tolist(), r.start.tolist(), strict=True)), len(scans)))
    assert found[0][0] and found[0][0] == found[1][0] == found[2][0]
    assert found[0][1] >= 40 > found[1][1] > found[2][1] == 1
