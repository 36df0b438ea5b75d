"""Substring dedup of bytes with a logarithmic family of suffix arrays.

Suffixes are sampled where windows elect a seed, so that every long match passes a sampled
place. Stretches that are equal as a whole are told by fingerprints. The suffixes of all others
are dealt by their seeds, and each batch of documents becomes a suffix array: entries in order of
their bytes, with the length of the prefix that each shares with its neighbour, and the same for
the bytes before them, read backwards. A new array is merge-scanned against the existing level:
what two entries share on both sides of the sampled place gives the long matches, and the later
entry of each is a repeat. Levels of about equal size merge, so that a family holds
logarithmically many; entries all of whose windows are repeats leave it.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .repeats import Contexts, Kind, Records, after_equals, covered, repeated, with_spans
from .tokens import BASE, mixed

ENTRIES = 8192  # of a first level: what one task of the scan sends to a bucket gets less, the more buckets there are
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def _numbers(text: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(text, np.uint8)]


def _seeds(size: int):
    """Hash of `size` numbers at each place, by doubling; size is a power of two."""

    def run(x: np.ndarray) -> np.ndarray:
        out, width, base = x, 1, BASE
        while width < size:
            out = out[: len(out) - width] * base + out[width:]
            width *= 2
            base = np.uint64(int(base) ** 2 & (2**64 - 1))
        return mixed(out)

    return run


def _bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


@dataclass
class Level:
    """Sampled suffixes in order of their bytes (from 1 on, 0 beyond their end), with the bytes before them backwards."""

    after: np.ndarray
    before: np.ndarray
    room: np.ndarray  # bytes of `after` that count
    lead: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    done: np.ndarray  # windows known as repeats

    def take(self, which) -> Level:
        return Level(*(getattr(self, f.name)[which] for f in fields(self)))

    @staticmethod
    def of(c: Contexts, kind: Kind) -> Level:
        lead, count = c.lead.astype(np.int64), c.count.astype(np.int64)
        room = np.minimum(count - 1 + kind.length - lead, kind.length)
        k = np.arange(kind.length)
        end = len(c.symbols) - 1

        def rows(at, size):
            return np.where(np.arange(at.shape[1]) < size[:, None], c.symbols[np.clip(at, 0, end)] + np.uint8(1), np.uint8(0))

        after = rows((c.offset + lead)[:, None] + k, room)
        before = rows((c.offset + lead)[:, None] - 1 - k[: kind.length - kind.seed], lead)
        one = Level(after, before, room, lead, count, c.doc, c.start.astype(np.int64), np.zeros((len(lead), kind.length - kind.seed + 1), bool))
        return one.take(_order(after))

    def merged(self, other: Level) -> Level:
        both = Level(*(np.concatenate([getattr(self, f.name), getattr(other, f.name)]) for f in fields(self)))
        return both.take(_order(both.after))


def _order(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes in ascending order; two sorted runs take one pass."""
    return np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")


def _shared(rows: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before it; -1 for the first."""
    out = np.full(len(rows), -1, np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[1:] = np.minimum(first, np.minimum(room[1:], room[:-1]))
    return out


def _most(shared: np.ndarray) -> np.ndarray:
    """Longest prefix shared with any other row of the order."""
    return np.maximum(shared, np.append(shared[1:], -1))


def scan(level: Level, rank: np.ndarray, kind: Kind) -> None:
    """Mark in level.done the windows that an earlier entry holds too."""
    length, beyond = kind.length, kind.length - kind.seed
    ahead = _shared(level.after, level.room)
    group = np.cumsum(ahead < kind.seed)
    # in order of the bytes before, among entries of one seed
    back = _order(level.before)
    back = back[np.argsort(group[back], kind="stable")]
    behind = _shared(level.before[back], np.minimum(level.lead[back], beyond))
    behind[1:][group[back][1:] != group[back][:-1]] = -1
    most_back = np.empty(len(back), np.int64)
    most_back[back] = _most(behind)
    low = np.maximum(level.lead - level.count + 1, length - _most(ahead))
    high = np.minimum(level.lead, most_back)
    place = np.empty(len(back), np.int64)
    place[back] = np.arange(len(back))
    live = np.flatnonzero(low <= high)
    # in order of documents and places, which is the same for all windows that start d bytes before
    live = live[np.lexsort((level.start[live] + level.lead[live], rank[level.doc[live]]))]
    for d in range(beyond + 1) if len(live) else ():  # bytes of the window before its sampled place
        which = live[(low[live] <= d) & (d <= high[live])]
        which = which[~level.done[which, level.lead[which] - d]]
        if not len(which):
            continue
        right, left = np.cumsum(ahead < length - d)[which], np.cumsum(behind < d)[place[which]]
        w = level.lead[which] - d
        seen = after_equals(right * (len(back) + 1) + left, rank[level.doc[which]], level.start[which] + w, kind.within)
        level.done[which[seen], w[seen]] = True


class SuffixLevels:
    """Suffix arrays of growing sizes; found: (document, place) of windows that are repeats."""

    def __init__(self, rank: np.ndarray, kind: Kind):
        self.rank, self.kind = rank, kind
        self.levels: list[Level] = []
        self.doc, self.start = [np.zeros(0, "u4")], [np.zeros(0, np.int64)]

    def _settle(self, level: Level) -> Level:
        scan(level, self.rank, self.kind)
        whole = level.done.sum(1) == level.count
        self._report(level.take(whole))
        return level.take(~whole)

    def _report(self, level: Level) -> None:
        i, w = np.nonzero(level.done)
        self.doc.append(level.doc[i])
        self.start.append(level.start[i] + w)

    def add(self, batch: Contexts) -> None:
        """Make a batch a level, and merge-scan levels while the last two are of about equal size."""
        self.levels.append(self._settle(Level.of(batch, self.kind)))
        while len(self.levels) > 1 and len(self.levels[-2].lead) < 2 * len(self.levels[-1].lead):
            self._merge()

    def _merge(self) -> None:
        new, old = self.levels.pop(), self.levels.pop()
        self.levels.append(self._settle(old.merged(new)))

    def close(self) -> Records:
        """Scan the levels against each other; all windows that are repeats."""
        while len(self.levels) > 1:
            self._merge()
        for level in self.levels:
            self._report(level)
        doc, start = np.concatenate(self.doc), np.concatenate(self.start)
        return Records.windows(np.zeros(len(doc), "u8"), np.zeros(len(doc), "u8"), doc, start)


def batched(many: list[Contexts], least: int):
    """Neighbours joined until they hold `least` entries, so that a scan pays for more than its own calls."""
    some, size = [], 0
    for c in many:
        some.append(c)
        size += len(c.seed)
        if size >= least:
            yield Contexts.join(some)
            some, size = [], 0
    if some:
        yield Contexts.join(some)


def by_levels(many: list[Contexts], rank: np.ndarray, kind: Kind) -> Records:
    """Windows of a bucket that stand earlier too, batch by batch."""
    family = SuffixLevels(rank, kind)
    for batch in batched(many, ENTRIES):
        family.add(batch)
    return family.close()


def byte_windows(length: int = 100, seed: int = 32) -> Kind:
    return Kind(length, seed, True, _numbers, _seeds(seed), _bytes, "u1", by_levels)


def remove_repeats(docs: DataFrame, length: int = 100, seed: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, begins, ends, kept): removed byte spans of each text and the bytes that stay (binary).

    A byte goes if a string of `length` bytes covers it that also starts earlier: in a document
    of a smaller id, or in the same one further left. Strings are judged on the input. Null texts
    count as empty, null ids as the largest, in order of their texts' hashes; rows that repeat an id and text do not remove each
    other. What stays may not be valid UTF-8. Other columns of docs are not read.
    """
    kind = byte_windows(length, seed)

    def run(batches):
        for batch in batches:
            out = []
            for text, lists in zip(texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                cut = covered(lists)
                edges = [0, *cut.ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(text), cut[:, 0].astype("i4"), cut[:, 1].astype("i4"), kept))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)]], [id_col, "n_bytes", "begins", "ends", "kept"])

    found = repeated(docs, kind, id_col=id_col, text_col=text_col)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, begins array<int>, ends array<int>, kept binary"
    return with_spans(docs, found, run, schema, id_col, text_col, [id_col])


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT doc_id, s, md5(substr(x, 2 * s + 1, 200)) AS g FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS s FROM d WHERE n >= 100)),
seen AS (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM win),
hit AS (SELECT doc_id, s, max(s) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM seen WHERE k > 1),
num AS (SELECT doc_id, s, sum(CASE WHEN p IS NULL OR s > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM hit),
span AS (SELECT doc_id, r, min(s) AS a, max(s) + 100 AS b FROM num GROUP BY 1, 2),
gap AS (SELECT doc_id, r, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY r), 0) AS e FROM span),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * e + 1, 2 * (a - e)), '' ORDER BY r) AS h, max(b) AS last, sum(b - a) AS gone, count(*) AS spans FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
 sha256(unhex(concat(coalesce(h, ''), substr(x, 2 * coalesce(last, 0) + 1)))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
