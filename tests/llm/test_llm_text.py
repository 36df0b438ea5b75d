"""Codec, personal data, quality and language model."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestack.llm import lattice_lm, line_quality, pii
from lodestack.llm import sentencepiece_codec as codecs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60).filter(lambda t: not re.search("[\ud800-\udfff]", t)))
def test_encode_and_decode_like_the_library(text):
    (ids, begins, ends), *_ = codecs.codec(MODEL).encode_all([text.encode()])
    assert ids.tolist() == LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert codecs.codec(MODEL).decode(ids) == LIBRARY.decode(ids.tolist())
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)) == raw or "▁" in text or any(b - a > 1 for a, b in zip(begins, ends, strict=True))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=12))
def test_decode_any_ids(ids):
    assert codecs.codec(MODEL).decode(np.array(ids, dtype=int)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_character_map_like_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = dict(codecs._fields(dict(codecs._fields(library.serialized_model_proto()))[3]))
    own = codecs.Codec.__new__(codecs.Codec)
    own.map, own.dummy, own.squeeze, own.escape = codecs.CharsMap(spec[2]), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
    rng = random.Random(2)
    pool = "aB  \t\nﬁ①Å ㍿½é́ｱ日A​ß…"
    for _ in range(500):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 20)))
        s, begin, end = own.normalise(text.encode())
        assert s == library.normalize(text)
        assert len(begin) == len(end) == len(s) and (begin <= end).all()


def test_encode_frame(docs, none, texts):
    got = codecs.encode(docs, MODEL, decoded="back").collect()
    assert len(got) == docs.count() and "kept" in got[0].asDict()
    for r in got:
        if r.doc_id is not None:
            assert r.ids == LIBRARY.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
            assert r.ends[-1] == len((texts[r.doc_id] or "").encode())
    assert codecs.encode(none, MODEL).count() == 0
    twice = codecs.decode(codecs.encode(docs, MODEL), MODEL).where("doc_id = 0").first()
    assert twice.decoded == texts[0]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def fine(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum((x := int(c) * (1 + i % 2)) - 9 * (x > 9) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def test_pii_spans_like_brute_force(spark):
    rng = random.Random(9)
    bits = ["a@b.c", "x", "@", ".", " ", "-", "1", "22", "255", "256", "+", "+1 (499) 555-6503", "4111 1111 1111 1111", "4111-1111", "10.0.0.1", "é", "😀", "_d@e.f", "%", "\n", "0001"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(600)] + ["", "4111111111111111" * 3]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_pii(frame).collect():
        want = [(k, m.start(), m.end(), m.group()) for k, p in BASE.items() for m in re.finditer(p, r.text) if fine(k, m.group())]
        assert [(s.kind, s.start, s.end, s.value) for s in r.pii if s.kind in BASE] == want, r.text


def test_pii_validators_and_scores(spark):
    text = "pay my iban DE89370400440532013000 now, DE88370400440532013000 is wrong. card 4111 1111 1111 1111"
    got = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().pii
    assert [(s.kind, s.value) for s in got] == [("card", "4111 1111 1111 1111"), ("iban", "DE89370400440532013000")]
    assert all(s.score == 0.95 for s in got)


def test_pii_frames(docs, none, spark):
    assert pii.find_pii(none).count() == 0
    out = pii.mask_pii(docs)
    assert out.columns == docs.columns and out.exceptAll(docs).count() == 0
    one = pii.mask_pii(spark.createDataFrame([("é a@b.co and 10.0.0.1!",), (None,), ("",)], "text string")).collect()
    assert [r.text for r in one] == ["é [EMAIL] and [IP]!", None, ""]


def test_long_texts_stay_linear(spark):
    text = "a" * 300_000 + "@" + "b." * 50_000 + "1" * 300_000 + " " + "1-" * 100_000
    got = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first().pii
    assert [(s.kind, s.start, s.end) for s in got] == [("email", 0, 700_001)]


def test_many_matches_stay_linear(spark):
    n = 100_000
    text = "x 10.0.0.1 " * n
    frame = spark.createDataFrame([(text,), ("é 10.0.0.1, 10.0.0.256 10.0.0.2",)], "text string")
    got = pii.find_pii(frame).select("pii.start", "pii.end").collect()
    assert got[0].start == list(range(2, 11 * n, 11)) and got[0].end == list(range(10, 11 * n, 11))
    assert got[1].start == [2, 23]
    assert [r.text for r in pii.mask_pii(frame).collect()] == ["x [IP] " * n, "é [IP], 10.0.0.256 [IP]"]


@pytest.mark.parametrize("tail", ["", " BIC", " bic", " X1", ", A"])
def test_iban_ends_at_its_length(spark, tail):
    iban = "DE89 3704 0044 0532 0130 00"
    got = pii.find_pii(spark.createDataFrame([(f"to {iban}{tail}",)], "text string")).first().pii
    assert [(s.kind, s.value) for s in got] == [("iban", iban)]


def test_long_chains_pass_their_state_on(monkeypatch):
    rng = np.random.default_rng(6)
    model = line_quality.Model(*[np.zeros(0)] * 3, rng.normal(size=(2, 2)), rng.normal(size=2))
    lines = [rng.normal(size=n) for n in (1, 3, 40, 7, 8, 9, 100)]
    want = [line_quality.chain(np.stack([np.zeros(len(u)), u], 1)[None], model.trans, model.first, np.array([len(u)]))[1][0, :, 1] for u in lines]
    for steps, cells in ((512, 1 << 17), (4, 16), (1, 1), (7, 100)):
        monkeypatch.setattr(line_quality, "STEPS", steps)
        monkeypatch.setattr(line_quality, "CELLS", cells)
        assert all(np.allclose(a, b) for a, b in zip(model.good_lines(lines), want, strict=True))


def test_line_weights_do_not_depend_on_blocks(monkeypatch):
    model = line_quality.fit(["good text here.\nmore of it.", "X!! Y!! | Z%%%\nA!! B!!"] * 5, [1, 0] * 5)
    text = "good text here.\nX!! Y!!\n\ngood text here.\nmore"
    rows, weight = line_quality.line_features(text)
    want = ((line_quality.with_neighbours(rows) - model.mean) / model.scale) @ model.weights
    for block in (8192, 2, 1):
        monkeypatch.setattr(line_quality, "BLOCK", block)
        got, length = model.lines(text)
        assert np.allclose(got, want) and (length == weight).all()
    assert 0 <= model.score(["\n" * 600_000 + "good text here.", ""])[0] <= 1


def test_chain_sums_over_all_labellings():
    rng = np.random.default_rng(1)
    unary, trans, first = rng.normal(size=(1, 5, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    z, node, _ = line_quality.chain(unary, trans, first, np.array([5]))
    total, good = 0.0, np.zeros(5)
    for code in range(32):
        y = [(code >> i) & 1 for i in range(5)]
        w = math.exp(first[y[0]] + sum(unary[0, t, y[t]] for t in range(5)) + sum(trans[y[t], y[t + 1]] for t in range(4)))
        total += w
        good += np.array(y) * w
    assert np.isclose(z[0], math.log(total)) and np.allclose(node[0, :, 1], good / total)


def test_quality_on_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = line_quality.query(spark, sf).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.9
    assert np.mean([r.predicted for r in held if r.quality]) >= 0.9
    assert docs.count() == line_quality.query(spark, sf).count()


def test_quality_frames(docs, none, spark):
    model = line_quality.fit(["good text here.\nmore of it.", "X!! Y!! | Z%%%\nA!! B!!"] * 5, [1, 0] * 5)
    out = line_quality.score(docs, model, out_col="q")
    assert out.count() == docs.count() and out.where("q is null or q < 0 or q > 1").count() == 0
    assert line_quality.score(none, model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert line_quality.fit_documents(docs, labels).prior == 1.0
    assert line_quality.fit(["a", "b"], [0, 0]).prior == 0.0


def segmentations(lattice, word):
    if not word:
        return 1.0
    return sum(math.exp(lattice.logs[i]) * segmentations(lattice, word[len(p) :]) for i, p in enumerate(lattice.pieces) if word.startswith(p))


@pytest.mark.parametrize("long", [48, 2])
def test_lattice_sums_over_all_segmentations(monkeypatch, long):
    monkeypatch.setattr(lattice_lm, "LONG", long)
    pieces = [b"a", b"b", b"ab", b" ", b" a", b"ba", b"abb"]
    lattice = lattice_lm.Lattice(pieces, np.log([0.2, 0.1, 0.15, 0.1, 0.2, 0.05, 0.2]))
    words = [b"ab", b"abba", b"bb", b"aaabbb", b"abb" * 5, b"a"]
    assert np.allclose(np.exp(lattice.marginals(words)), [segmentations(lattice, b" " + w) for w in words])


def test_expected_counts_cover_every_byte():
    pieces = [b"a", b"b", b"ab", b" ", b" a", b"ba"]
    lattice = lattice_lm.Lattice(pieces, np.log([0.2, 0.2, 0.2, 0.1, 0.2, 0.1]))
    got = lattice.expected([b"ab", b"abba"], np.array([2.0, 3.0]))
    assert np.isclose(sum(len(p) * n for p, n in zip(pieces, got, strict=True)), 2 * 3 + 3 * 5)


def test_expected_counts_of_long_words(monkeypatch):
    pieces = [b"a", b"b", b"ab", b" ", b" a", b"ba", b"abab"]
    lattice = lattice_lm.Lattice(pieces, np.log([0.2, 0.2, 0.2, 0.1, 0.1, 0.1, 0.1]))
    words, counts = [b"ab", b"abba", b"babab" * 3, b"ab" * 40], np.array([2.0, 3.0, 1.0, 5.0])
    monkeypatch.setattr(lattice_lm, "LONG", 1000)
    want = lattice.expected(words, counts)
    for long in (3, 48):
        monkeypatch.setattr(lattice_lm, "LONG", long)
        assert np.allclose(lattice.expected(words, counts), want)


def test_lattice_scores(docs, none, texts):
    from pyspark.sql import functions as F

    training = F.col("doc_id") % 2 == 0
    got = lattice_lm.score_texts(docs, training, MODEL).collect()
    assert len(got) == docs.count()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(t or "").translate(low).split() + ["\n"] for t in texts]
    counts = {}
    for ts in [*tokens[::2], tokens[0]]:  # the first row is there twice
        for w in ts:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in got:
        assert r.train_tokens == n and r.score < 0
        if r.doc_id is not None:
            assert r.n_tokens == len(tokens[r.doc_id]) and r.n_known == sum(w in counts for w in tokens[r.doc_id])
            assert math.isclose(r.base_score, sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens[r.doc_id]), abs_tol=1e-6)
    assert lattice_lm.score_texts(none, training, MODEL).count() == 0
    assert lattice_lm.score_texts(docs, F.lit(False), MODEL).where("base_score <> 0 or train_tokens <> 0").count() == 0
