"""Language of texts from a string kernel with Nyström landmarks.

The kernel of two texts is the number of distinct n-grams of letters (n = 1 to 3) that both
hold, over the root of the product of their own numbers. A bounded number of documents of each
language are landmarks; a text is described by its kernels with all of them, mapped by the
inverse root of the landmarks' own kernel matrix. One-versus-rest ridge regression is solved on
a bounded sample; Spark computes the kernels of the sample and of all documents by products of
presence matrices, a batch of texts at a time.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups_of, sizes_of, texts_of, written

LANDMARKS = 128  # texts that describe all others, dealt evenly to the languages, one each at least
FIT_DOCS = 400  # most texts of a language that a fit uses, those of the smallest hash
SHORT = 4096  # bytes up to which texts are preferred for landmarks and fit
SHARES = 64  # parts of a language that are ranked apart
GRAM = 3
RIDGE = 1e-3  # penalty for each text of the fit
ROWS = 64  # texts of a product
COLUMNS = 8192  # n-grams of a product
PIECE = 1 << 20  # bytes of a text whose n-grams are made at once
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Lower-case letter of each code point, a blank for all that are no letters; made once a process."""
    if not _LETTERS:
        table = np.full(sys.maxunicode + 1, 32, np.uint32)
        for c in map(chr, range(sys.maxunicode + 1)):
            if c.isalpha():
                low = c.lower()
                table[ord(c)] = ord(low) if len(low) == 1 else ord(c)
        _LETTERS.append(table)
    return _LETTERS[0]


def _grams(codes: np.ndarray) -> np.ndarray:
    """n-grams of letters and single blanks as exact numbers: 21 bits a code point."""
    c = codes.astype(np.uint64)
    parts, run = [c[c != 32]], c
    for n in range(2, GRAM + 1):
        run = (run[:-1] << np.uint64(21)) | c[n - 1 :]
        parts.append(run)
    return np.unique(np.concatenate(parts))


def gram_set(text: bytes) -> np.ndarray:
    """Distinct n-grams of a whole text, sorted; none if it has no letter."""
    found, rest = [], np.array([32], np.uint32)
    for at in range(0, len(text), PIECE):
        begin, end = at, min(at + PIECE, len(text))
        while begin < len(text) and text[begin] & 0xC0 == 0x80:
            begin += 1
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        codes = letters()[np.frombuffer(text[begin:end].decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
        codes = np.concatenate([rest, codes])
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        found.append(_grams(codes))
        rest = codes[-GRAM + 1 :]
    if len(rest) and rest[-1] != 32:
        found.append(_grams(np.append(rest, np.uint32(32))))
    out = found[0] if len(found) == 1 else np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))
    return out if (out < (1 << 21)).any() else out[:0]  # blanks alone are no text


@dataclass
class Landmarks:
    """Distinct n-grams of the landmarks, and for each of them one bit a landmark."""

    grams: np.ndarray
    bits: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(texts: list[bytes]) -> Landmarks:
        sets = [gram_set(t) for t in texts]
        grams = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]))
        bits = np.zeros((len(grams), -(-len(sets) // 8)), np.uint8)
        for i, s in enumerate(sets):
            bits[np.searchsorted(grams, s), i // 8] |= np.uint8(128 >> i % 8)
        return Landmarks(grams, bits, np.array([len(s) for s in sets], float))

    def kernels(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(normalised kernels of texts with the landmarks, whether a text has a letter): products of presence matrices over bands of n-grams."""
        shared = np.zeros((len(texts), len(self.sizes)), np.float32)
        rows, columns, sizes = [], [], np.zeros(len(texts))
        for i, t in enumerate(texts):
            s = gram_set(t)
            at = np.minimum(np.searchsorted(self.grams, s), max(0, len(self.grams) - 1))
            at = at[self.grams[at] == s] if len(self.grams) else at[:0]
            rows.append(np.full(len(at), i))
            columns.append(at)
            sizes[i] = len(s)
        row, column = np.concatenate([np.zeros(0, int), *rows]), np.concatenate([np.zeros(0, int), *columns])
        for low in range(0, len(self.grams), COLUMNS):
            landmarks = np.unpackbits(self.bits[low : low + COLUMNS], axis=1, count=len(self.sizes)).astype(np.float32)
            here = (column >= low) & (column < low + COLUMNS)
            present = np.zeros((len(texts), len(landmarks)), np.float32)
            present[row[here], column[here] - low] = 1
            shared += present @ landmarks  # counts below 2**24 are exact
        root = np.sqrt(np.maximum(sizes, 1))[:, None] * np.sqrt(np.maximum(self.sizes, 1))[None, :]
        return shared.astype(float) / root, sizes > 0


@dataclass
class Model:
    landmarks: Landmarks
    langs: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    shift: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; without a learned language or a letter UNKNOWN and 0."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows, some = self.landmarks.kernels(texts)
        value = rows @ self.weights + self.shift
        best = value.argmax(1)
        score = np.round(np.clip(value[np.arange(len(texts)), best], 0, 1), 6) * some
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], score


def solve(kernels: np.ndarray, langs: list[str], own: np.ndarray, ridge: float = RIDGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, weights, shifts) of kernel rows: ridge regression of 0 and 1 for each language on Nyström features."""
    names = sorted(set(langs))
    y = (np.array(langs)[:, None] == np.array(names)[None, :]).astype(float)
    value, vector = np.linalg.eigh(own)
    good = value > value.max() * 1e-8
    root = vector[:, good] / np.sqrt(value[good])  # kernel rows times root: features whose products are the kernel
    x = kernels @ root
    share = 1 / (y.sum(0)[y.argmax(1)] * len(names))  # every language weighs the same
    mean_x, mean_y = share @ x, share @ y
    xc, yc = x - mean_x, y - mean_y
    beta = np.linalg.solve((xc * share[:, None]).T @ xc + ridge * np.eye(x.shape[1]), (xc * share[:, None]).T @ yc)
    return names, root @ beta, mean_y - mean_x @ beta


def _kernel_rows(docs: DataFrame, landmarks: Landmarks) -> DataFrame:
    """(lang, kernels) of a bounded sample."""

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            for part in groups_of([max(1, len(t)) for t in texts], 1 << 20):
                k, _ = landmarks.kernels(texts[part])
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], pa.array(list(k), pa.list_(pa.float64()))], ["_l", "_k"])

    return docs.select("_l", "_t").mapInArrow(run, "_l string, _k array<double>")


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", landmarks: int = LANDMARKS, most: int = FIT_DOCS) -> Model:
    """Learn from the rows of docs that have a language and a text with a letter.

    Of each language at most `most` rows are used, those of the smallest hash of id and text,
    texts of up to SHORT bytes before longer ones. The driver holds the landmarks' texts and one
    row of kernels for each row of the sample, whatever the number of documents.
    """
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    rows = docs.select(F.col(id_col).cast("string").alias("_i"), text.alias("_t"), lang.alias("_l")).where(r"_l IS NOT NULL AND _t RLIKE '\\p{L}'")
    long = F.greatest(F.octet_length("_t"), F.lit(SHORT))
    keys = rows.select("_l", long.alias("_n"), F.xxhash64("_i", "_t").alias("_h"))
    # a language may hold most rows: the first of each of SHARES shares, limited in every task before the shuffle, then the first of these
    part = Window.partitionBy("_l", F.pmod("_h", F.lit(SHARES))).orderBy("_n", "_h")
    first = Window.partitionBy("_l").orderBy("_n", "_h")
    chosen = keys.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= most)
    chosen = chosen.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= most)
    chosen = chosen.groupBy("_l", "_h").agg(F.min("_r").alias("_r"))
    sample = written(rows.withColumn("_h", F.xxhash64("_i", "_t")).join(F.broadcast(chosen), ["_l", "_h"]).dropDuplicates(["_l", "_h"]))
    count = sample.select("_l").distinct().count()
    if not count:
        return Model(Landmarks.of([]), [])
    each = max(1, landmarks // count)
    found = sample.where(F.col("_r") <= each).select("_l", "_r", "_t").orderBy("_l", "_r").collect()
    marks = Landmarks.of([r["_t"].encode() for r in found])
    own, _ = marks.kernels([r["_t"].encode() for r in found])
    fitted = _kernel_rows(sample, marks).collect()
    fitted.sort(key=lambda r: (r["_l"], r["_k"]))
    return Model(marks, *solve(np.array([r["_k"] for r in fitted]), [r["_l"] for r in fitted], own))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """`docs` with the language of each text and a score from 0 to 1; columns of these names are replaced.

    Null texts and texts without a letter are `und` with score 0, as are all texts if nothing was
    learned. Equal texts get equal results; an empty table gives an empty one.
    """
    keep = [c for c in docs.columns if c not in (lang_col, score_col)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema), f"{lang_col} string", f"{score_col} double"])
    at = keep.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks of bounded number, nothing of the corpus

    def run(batches):
        for batch in batches:
            column = batch.column(at).cast(pa.string())
            for part in groups_of([max(n, PIECE // ROWS) for n in sizes_of(column)], PIECE):
                piece = batch.slice(part.start, part.stop - part.start)
                langs, score = shared.value.predict(texts_of(column[part.start : part.stop]))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())], [*keep, lang_col, score_col])

    return docs.select(*keep).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """True for documents that no fit may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
