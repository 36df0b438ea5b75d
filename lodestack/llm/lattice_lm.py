"""Language-model scores from subword lattices.

Every word, with a mark for the space before it, is a lattice of all its segmentations into
pieces of an existing vocabulary and single bytes. The vocabulary's own scores give first
weights; expected piece counts over the training words (forward-backward on the lattice of
each distinct word, times its count) give the weights that score; a word of the training texts
is one more edge, from its begin to its end. The forward recursion in log space sums over all
segmentations, and a text's probability is the product over its words and one end. Words are counted and scored once for each bucket of the vocabulary, never once
for each document; what goes back to a batch of documents is one number for each of its words.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import groups_of, pack, partitions, sizes_of, texts_of, unpack, written
from .sentencepiece_codec import NORMAL, _fields
from .tokens import WordNumbers, mixed

MARK = b"\xe2\x96\x81"  # fixed value: the space mark of pieces, a blank in lattices
BATCH_BYTES = 6 << 20  # texts whose words are gathered together
LONG = 48  # bytes; longer words go one by one
MOST = 20_000  # words of one length that are weighed together
SLICES = 64  # parts of the vocabulary that sums of piece counts travel in
END = b"\n"  # names the end token; no word holds it


@dataclass
class Lattice:
    """Pieces as byte strings, with log weights; all single bytes are pieces."""

    pieces: list[bytes]
    logs: np.ndarray

    def __post_init__(self):
        self.widest = max(map(len, self.pieces))
        self.index = {p: i for i, p in enumerate(self.pieces)}
        keys = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.bits = max(12, len(keys).bit_length() + 5)
        self.slot_key, self.slot = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        for i, k in enumerate(keys):
            at = int(k >> np.uint64(64 - self.bits))
            while self.slot[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.slot_key[at], self.slot[at] = k, i

    @staticmethod
    def _hash(p: bytes) -> int:
        h = np.zeros(1, np.uint64)
        for b in p:
            h = mixed(h + np.uint64(b + 1))
        return int(h[0])

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1."""
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(h), -1, np.int32)
        left = np.arange(len(h))
        while len(left):
            slot = self.slot[at[left]]
            hit = (slot >= 0) & (self.slot_key[at[left]] == h[left])
            out[left[hit]] = slot[hit]
            left = left[(slot >= 0) & ~hit]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
        return out

    def _edges(self, block: np.ndarray):
        """For words of one length, row by row: {(begin, end): piece of each word or -1}."""
        m, n = block.shape
        out = {}
        for i in range(n):
            h = np.zeros(m, np.uint64)
            for j in range(i, min(n, i + self.widest)):
                h = mixed(h + block[:, j] + np.uint64(1))
                found = self._find(h)
                if (found >= 0).any():
                    out[i, j + 1] = found
        return out

    def _forward(self, edges: dict, m: int, n: int) -> np.ndarray:
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0
        for (i, j), piece in sorted(edges.items(), key=lambda e: e[0][1]):
            alpha[j] = np.logaddexp(alpha[j], alpha[i] + np.where(piece >= 0, self.logs[piece], -np.inf))
        return alpha

    def _blocks(self, words: list[bytes]):
        """(indices, bytes as numbers) of words of one length, at most MOST together."""
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        for size in np.unique(sizes):
            which = order[np.searchsorted(sizes[order], size) : np.searchsorted(sizes[order], size, "right")]
            most = MOST if size <= LONG else max(1, MOST * LONG // int(size) ** 2)
            for k in range(0, len(which), most):
                part = which[k : k + most]
                yield part, np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(len(part), -1).astype(np.uint64)

    def _one_by_one(self, word: bytes) -> np.ndarray:
        """Forward logs of one long word."""
        alpha = np.full(len(word) + 1, -np.inf)
        alpha[0] = 0
        for j in range(1, len(word) + 1):
            got = [alpha[i] + self.logs[p] for i in range(max(0, j - self.widest), j) if (p := self.index.get(word[i:j])) is not None]
            top = max(got)
            alpha[j] = top + np.log(np.exp(np.array(got) - top).sum())
        return alpha

    def _count_one(self, word: bytes, times: float, out: np.ndarray) -> None:
        """Add to out the expected piece counts of one long word, by a backward pass."""
        alpha, n = self._one_by_one(word), len(word)
        beta = np.full(n + 1, -np.inf)
        beta[n] = 0
        for i in range(n - 1, -1, -1):
            got = [(p, j) for j in range(i + 1, min(n, i + self.widest) + 1) if (p := self.index.get(word[i:j])) is not None]
            piece, end = np.array(got).T
            w = self.logs[piece] + beta[end]
            beta[i] = w.max() + np.log(np.exp(w - w.max()).sum())
            out[piece] += np.exp(alpha[i] + w - alpha[n]) * times

    def marginals(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the total weight of all segmentations of ' ' + word, for each word."""
        marked = [b" " + w for w in words]
        short = [i for i, w in enumerate(marked) if len(w) <= LONG]
        out = np.zeros(len(words))
        for part, block in self._blocks([marked[i] for i in short]):
            m, n = block.shape
            out[np.array(short)[part]] = self._forward(self._edges(block), m, n)[n]
        for i, w in enumerate(marked):
            if len(w) > LONG:
                out[i] = self._one_by_one(w)[-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected number of times that each piece is used in `counts` copies of each word."""
        marked = [b" " + w for w in words]
        out = np.zeros(len(self.pieces))
        short = [i for i, w in enumerate(marked) if len(w) <= LONG]
        for part, block in self._blocks([marked[i] for i in short]):
            m, n = block.shape
            times = counts[np.array(short)[part]]
            edges = self._edges(block)
            alpha = self._forward(edges, m, n)
            beta = np.full((n + 1, m), -np.inf)
            beta[n] = 0
            for (i, j), piece in sorted(edges.items(), key=lambda e: -e[0][0]):
                w = np.where(piece >= 0, self.logs[piece], -np.inf)
                beta[i] = np.logaddexp(beta[i], beta[j] + w)
            for (i, j), piece in edges.items():
                has = piece >= 0
                p = np.exp(alpha[i][has] + self.logs[piece[has]] + beta[j][has] - alpha[n][has]) * times[has]
                out += np.bincount(piece[has], p, minlength=len(out))
        for i, w in enumerate(marked):
            if len(w) > LONG:
                self._count_one(w, counts[i], out)
        return out


def vocabulary_lattice(model_path: str) -> Lattice:
    """Pieces of a SentencePiece model and first weights from its scores.

    Scores of merge models fall by one with each merge; they are read as ranks of Zipf's law.
    Scores of unigram models are logs already. Bytes have the weight of the rarest piece.
    """
    pieces: dict[bytes, float] = {}
    kind = 1
    with open(model_path, "rb") as f:
        raw = f.read()
    for number, value in _fields(raw):
        if number == 1:
            part = dict(_fields(value))
            if part.get(3, NORMAL) == NORMAL:
                (score,) = struct.unpack("<f", part.get(2, b"\0\0\0\0"))
                p = part[1].replace(MARK, b" ")
                if p.count(b" ") <= (p[:1] == b" ") and p.strip():
                    pieces[p] = score
        elif number == 2:
            kind = dict(_fields(value)).get(3, 1)
    logs = {p: (s if kind == 1 else -np.log(2.0 - max(s, -1e6))) for p, s in pieces.items()}
    least = min(logs.values(), default=0.0)
    for b in range(256):
        logs.setdefault(bytes([b]), least)
    names = sorted(logs)
    weights = np.array([logs[p] for p in names])
    top = weights.max()
    return Lattice(names, weights - top - np.log(np.exp(weights - top).sum()))


MADE = "_part long, _bucket int, _ends long, _words binary, _counts binary, _bags binary"


def _gather(docs: DataFrame, training: Column, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of MADE: for each batch of documents its distinct words by bucket, with training counts, and its documents as bags of them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def run(batches):
        serial = TaskContext.get().partitionId() << 32
        numbers = WordNumbers()
        for batch in batches:
            for part in groups_of(sizes_of(batch.column(2)), BATCH_BYTES):
                some = batch.slice(part.start, part.stop - part.start)
                serial += 1
                lists = [t.lower().split() for t in texts_of(some.column(2))]
                place: dict[bytes, int] = {}
                bags, sizes = [], []
                for words in lists:
                    for w in words:
                        if w not in place:
                            place[w] = len(place)
                    at, n = np.unique(np.fromiter(map(place.__getitem__, words), np.uint32, len(words)), return_counts=True)
                    bags.append((at, n))
                    sizes.append(len(at))
                names = list(place)
                bucket = (mixed(numbers.of(names)) % np.uint64(buckets)).astype(np.int32) if names else np.zeros(0, np.int32)
                train = np.zeros(len(names), np.int64)
                ends = 0
                for (at, n), known in zip(bags, some.column(1).to_pylist(), strict=True):
                    if known:
                        train[at] += n
                        ends += 1
                order = np.argsort(bucket, kind="stable")
                moved = np.empty(len(names), np.uint32)
                moved[order] = np.arange(len(names), dtype=np.uint32)  # words stand by bucket from here on
                rows = []
                for b in range(buckets):
                    lo, hi = np.searchsorted(bucket[order], [b, b + 1])
                    if hi > lo:
                        mine = [names[i] for i in order[lo:hi]]
                        rows.append((serial, b, 0, pack(np.frombuffer(b"\n".join(mine), np.uint8)), pack(np.array([lo], "i8"), train[order[lo:hi]].astype("i8")), None))
                ids = some.column(0)
                rows.append((serial, -1, ends, None, None, pack(
                    np.array(ids.is_valid(), "u1"), ids.fill_null(0).to_numpy(), np.array([len(w) for w in lists], "i8"), np.array(sizes, "i8"),
                    moved[np.concatenate([np.zeros(0, np.uint32), *[b[0] for b in bags]]).astype(np.int64)].astype("u4") if names else np.zeros(0, "u4"),
                    np.concatenate([np.zeros(0, np.int64), *[b[1] for b in bags]]).astype("u4"),
                )))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["_part", "_bucket", "_ends", "_words", "_counts", "_bags"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(training, F.lit(False)).alias("_train"), text.alias("_t"))
    return rows.mapInArrow(run, MADE)


def _bucket_words(pdf: pd.DataFrame) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    """Distinct words of a bucket, their training counts, and for each row the places of its words among them."""
    place: dict[bytes, int] = {}
    rows, counts = [], []
    for words, c in zip(pdf["_words"], pdf["_counts"], strict=True):
        names = unpack(words, "u1")[0].tobytes().split(b"\n")
        for w in names:
            if w not in place:
                place[w] = len(place)
        rows.append(np.fromiter(map(place.__getitem__, names), np.int64, len(names)))
        counts.append(unpack(c, "i8", "i8")[1])
    total = np.zeros(len(place), np.int64)
    for at, c in zip(rows, counts, strict=True):
        np.add.at(total, at, c)
    return list(place), total, rows


def score_texts(docs: DataFrame, training: Column, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id as long, n_tokens, n_known, train_tokens, base_score, score): one row per row of docs, log10.

    Tokens are lower-case (A-Z) words and one end; counts come from the rows where `training`
    holds. base_score adds one to every count; score is the lattice model's. Null texts are
    empty and have the end only. With no training rows, base_score is 0 and the lattice keeps
    the vocabulary's own weights. Rows that repeat are scored each; other columns are not read.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    made = written(_gather(docs, training, buckets, id_col, text_col))
    words = made.where("_bucket >= 0").select("_part", "_bucket", "_words", "_counts")
    first = vocabulary_lattice(model_path)
    ends = made.agg(F.sum("_ends")).first()[0] or 0

    def expect(pdf: pd.DataFrame) -> pd.DataFrame:
        names, total, _ = _bucket_words(pdf)
        seen = np.flatnonzero(total)
        weights = first.expected([names[i] for i in seen], total[seen].astype(float))
        weights = np.concatenate([weights, [float(total.sum()), float(len(seen))]])
        slices = np.array_split(weights, SLICES)
        return pd.DataFrame({"slice": np.arange(SLICES, dtype="int32"), "sums": [pack(x) for x in slices]})

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        out = sum(unpack(x, "f8")[0] for x in pdf["sums"])
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "sums": [pack(out)]})

    # a slice of the vocabulary from every bucket; SLICES rows come to the driver, the vocabulary's size in all
    learnt = words.groupBy("_bucket").applyInPandas(expect, "slice int, sums binary").groupBy("slice").applyInPandas(summed, "slice int, sums binary")
    found = {r["slice"]: unpack(r["sums"], "f8")[0] for r in learnt.collect()}
    counts = np.concatenate([found[i] for i in sorted(found)]) if found else np.zeros(len(first.pieces) + 2)
    counts, (n_tokens, n_types) = counts[:-2], counts[-2:]
    tokens, types = int(round(n_tokens)) + ends, int(round(n_types)) + (ends > 0)
    total = counts.sum() + ends
    if ends:
        # as much mass as one document's pieces goes to the vocabulary's own weights, so that no piece is impossible
        own = np.exp(first.logs) * max(1.0, total / ends)
        second = Lattice(first.pieces, np.log(counts + own) - np.log(total + own.sum()))
    else:
        second = first
    # a training word is an edge of its own lattice, of its share of tokens; Witten-Bell weight against the subword edges
    whole = tokens / (tokens + types) if tokens else 0.0
    end_log = float(np.log10(ends / tokens)) if ends else 0.0
    base_end = float(np.log10((ends + 1) / (tokens + types + 1)))

    def weigh(pdf: pd.DataFrame) -> pd.DataFrame:
        names, total, rows = _bucket_words(pdf)
        logs = second.marginals(names) + np.log1p(-whole)
        if tokens:
            with np.errstate(divide="ignore"):
                logs = np.logaddexp(logs, np.log(whole * total / tokens))
        logs = logs / np.log(10)
        out = []
        for part, c, at in zip(pdf["_part"], pdf["_counts"], rows, strict=True):
            out.append((int(part), pack(unpack(c, "i8", "i8")[0], total[at].astype("i8"), logs[at])))
        return pd.DataFrame(out, columns=["_wpart", "_values"])

    values = words.groupBy("_bucket").applyInPandas(weigh, "_wpart long, _values binary")

    def add_up(bags: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        got = sorted((unpack(v, "i8", "i8", "f8") for v in values["_values"]), key=lambda x: x[0][0])
        count = np.concatenate([np.zeros(0, "i8"), *[g[1] for g in got]])
        logs = np.concatenate([np.zeros(0), *[g[2] for g in got]])
        base = np.log10((count + 1) / (tokens + types + 1))
        out = []
        for bag in bags["_bags"]:
            valid, ids, n_words, sizes, at, times = unpack(bag, "u1", "i8", "i8", "i8", "u4", "u4")
            doc = np.repeat(np.arange(len(ids)), sizes)
            sums = [np.bincount(doc, x[at] * times, minlength=len(ids)) for x in (base, logs, (count > 0).astype(float))]
            names = pd.Series(ids, dtype="Int64").mask(valid == 0)
            out.append(pd.DataFrame({"_id": names, "n_tokens": n_words + 1, "n_known": np.rint(sums[2]).astype("i8") + int(ends > 0), "base_score": sums[0] + base_end, "score": sums[1] + end_log}))
        return pd.concat(out) if out else pd.DataFrame([], columns=["_id", "n_tokens", "n_known", "base_score", "score"])

    bags = made.where("_bucket = -1").select("_part", "_bags")
    scored = bags.groupBy("_part").cogroup(values.groupBy("_wpart")).applyInPandas(add_up, "_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumnRenamed("_id", id_col).withColumn("train_tokens", F.lit(tokens).cast("long"))


def held_out(id_col: str = "doc_id") -> Column:
    """True for documents that the model does not learn from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score_texts(docs, ~held_out(), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
