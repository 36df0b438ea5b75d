"""Substring dedup of words by seed and extend.

Winnowed anchors (word runs of the smallest hash in each window) join documents: occurrences of
one anchor meet. Where all windows around an anchor are equal, a fingerprint says so at once.
All other matches are extended word by word to the right and to the left; occurrences that
agree with no other any more leave. A window repeats if its words on both sides of the anchor
agree with those of an earlier occurrence; repeats that overlap merge, so that they are maximal.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .repeats import Contexts, Kind, Records, covered, first_places, repeated, with_spans
from .tokens import WordNumbers, grams, words_of


@lru_cache(maxsize=1)
def _known() -> WordNumbers:
    return WordNumbers()


def _numbers(text: bytes) -> np.ndarray:
    return _known().of(words_of(text))


def _split(classes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Classes of occurrences that also agree in one more word; -1 for those that are alone from here on."""
    order = np.lexsort((words, classes))
    new = np.concatenate([[True], (classes[order][1:] != classes[order][:-1]) | (words[order][1:] != words[order][:-1])])
    number = np.cumsum(new) - 1
    out = np.empty(len(classes), np.int64)
    out[order] = np.where(np.bincount(number)[number] > 1, number, -1)
    return out


def _extensions(c: Contexts, begin: np.ndarray, room: np.ndarray, step: int, most: int) -> list[np.ndarray]:
    """Classes of occurrences that agree in 0, 1, ... most words beyond the anchor, from begin on in direction step."""
    out = [_split(c.seed, np.zeros(len(c.seed), "u8"))]
    for k in range(most):
        classes = np.full(len(c.seed), -1, np.int64)
        live = np.flatnonzero((out[-1] >= 0) & (room > k))
        if len(live):
            classes[live] = _split(out[-1][live], c.symbols[begin[live] + step * k])
        out.append(classes)
    return out


def extend_both_ways(many: list[Contexts], rank: np.ndarray, kind: Kind) -> Records:
    """Windows that also stand at an earlier occurrence of their anchor."""
    c = Contexts.join(many)
    lead, count = c.lead.astype(np.int64), c.count.astype(np.int64)
    beyond = kind.length - kind.seed
    right = _extensions(c, c.offset + lead + kind.seed, count - 1 + beyond - lead, 1, beyond)
    left = _extensions(c, c.offset + lead - 1, lead, -1, beyond)
    doc, start = [np.zeros(0, "u4")], [np.zeros(0, np.int64)]
    for before in range(beyond + 1):  # words of the window before its anchor
        a, b = left[before], right[beyond - before]
        which = np.flatnonzero((a >= 0) & (b >= 0) & (lead >= before) & (lead - before < count))
        at = c.start[which] + lead[which] - before
        seen = first_places(a[which] * (len(b) + 1) + b[which], rank[c.doc[which]], at, kind.within)
        doc.append(c.doc[which[seen]])
        start.append(at[seen])
    doc, start = np.concatenate(doc), np.concatenate(start)
    return Records.windows(np.zeros(len(doc), "u8"), np.zeros(len(doc), "u8"), doc, start)


def word_windows(length: int = 13, anchor: int = 5) -> Kind:
    return Kind(length, anchor, False, _numbers, lambda x: grams(x, anchor), _numbers, "u8", extend_both_ways)


def remove_repeats(docs: DataFrame, length: int = 13, anchor: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, begins, ends, kept): maximal repeats as word spans, and the words outside joined by one space.

    A repeat is covered by windows of `length` words whose sequence also starts in a document
    with a smaller id; windows are judged on the input. Null texts have no words; null ids count
    as the largest, in order of their texts' hashes; texts shorter than a window lose nothing; rows that repeat an id do not
    remove from each other. Other columns of docs are not read.
    """
    kind = word_windows(length, anchor)

    def run(batches):
        for batch in batches:
            out = []
            for text, lists in zip(texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words, cut = words_of(text), covered(lists)
                kept, at = [], 0
                for a, b in cut.tolist():
                    kept += words[at:a]
                    at = b
                out.append((len(words), cut[:, 0].astype("i4"), cut[:, 1].astype("i4"), b" ".join(kept + words[at:])))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
            arrays = [pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays[:3], arrays[3].cast(pa.string())], [id_col, "n_words", "begins", "ends", "kept"])

    found = repeated(docs, kind, id_col=id_col, text_col=text_col)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words long, begins array<int>, ends array<int>, kept string"
    return with_spans(docs, found, run, schema, id_col, text_col, [id_col])


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    removed = F.aggregate(F.zip_with("begins", "ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.size("begins").cast("long").alias("n_repeats"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13),
win AS (SELECT doc_id, s, list_slice(w, s, s + 12) AS g FROM pos),
seen AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY g) AS first_id FROM win),
gone AS (SELECT doc_id, list(DISTINCT p) AS r FROM (SELECT doc_id, unnest(range(s, s + 13)) AS p FROM seen WHERE first_id < doc_id) GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.p) AS t FROM words w LEFT JOIN
         (SELECT doc_id, unnest(r) AS p FROM gone) g ON g.doc_id = w.doc_id AND g.p = w.p WHERE g.p IS NULL GROUP BY w.doc_id),
runs AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM (SELECT doc_id, unnest(r) AS p FROM gone)) WHERE q IS NULL OR q < p - 1 GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(r), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, coalesce(n, 0)::BIGINT AS n_repeats
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
