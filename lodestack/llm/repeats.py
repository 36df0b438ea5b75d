"""Windows of symbols that occur earlier elsewhere: the common ground of both substring operators.

Every window of `length` symbols elects one of its seeds (runs of `seed` symbols), that of the
smallest hash; equal windows elect equal seeds at equal places. Neighbouring windows that elect
the same seed make a segment. Two stretches of equal text have equal segments inside: segments
whose fingerprints are equal settle most of what is copied. Segments that share a seed but are
not equal go on with the symbols around the seed, and an operator extends the match of the
seeds to both sides by its own method. Where very many different segments share one seed, no task
holds them all: their windows are dealt by their own fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_of, pack, partitions, sizes_of, texts_of, unpack, written
from .tokens import BASE, ODD, mixed

PART = 1 << 20  # symbols (of UTF-8 text: bytes) that a task looks at together; longer texts are read in overlapping parts
PLACE = np.uint64((1 << 23) - 1)
BASE2 = np.uint64(0xA0761D6478BD642F | 1)
LAST_ID = np.iinfo(np.int64).max  # null ids come last, in order of their texts' hashes
GROUP = 4096  # different segments of one seed that are extended together
BUCKET_BYTES = 32 << 20  # text whose segments make a bucket, about


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(base), -1, 1 << 64)

    def run(b):
        out = np.full(n, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(int(base)), run(inverse)


def content_hash(numbers: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of numbers[start:end] for each pair, equal for equal content wherever it stands."""
    size = 1 << int(len(numbers) + 1).bit_length()
    powers, inverse = _powers(int(base), size)
    total = np.zeros(len(numbers) + 1, np.uint64)
    np.cumsum(numbers * powers[: len(numbers)], out=total[1:])
    return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * ODD)


@dataclass(frozen=True)
class Kind:
    """What a document is made of, and which windows count."""

    length: int  # symbols of a window
    seed: int  # symbols of a seed
    within: bool  # an earlier place in the same document counts, not only smaller ids
    numbers: Callable[[bytes], np.ndarray] = field(repr=False)  # symbols of a text as 64-bit numbers
    seeds: Callable[[np.ndarray], np.ndarray] = field(repr=False)  # hash of the seed that starts at each symbol
    symbols: Callable[[bytes], np.ndarray] = field(repr=False)  # symbols of a text as they are compared
    symbol: str = "u8"  # their kind
    extend: Callable = field(repr=False, default=None)  # (list of Contexts, ranks of documents, Kind) to Records of windows that occur earlier


FIELDS = {"seed": "u8", "content": "u8", "doc": "u4", "start": "u4", "count": "u4", "lead": "u4"}


@dataclass
class Records:
    """Segments or windows: key (two numbers), document (index into ids), first window, number of windows, symbols before the seed."""

    seed: np.ndarray
    content: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    lead: np.ndarray

    def take(self, which) -> Records:
        return Records(*(getattr(self, n)[which] for n in FIELDS))

    @staticmethod
    def join(many: list[Records]) -> Records:
        return Records(*(np.concatenate([np.zeros(0, k), *(getattr(r, n) for r in many)]).astype(k) for n, k in FIELDS.items()))

    @staticmethod
    def windows(seed: np.ndarray, content: np.ndarray, doc: np.ndarray, start: np.ndarray) -> Records:
        return Records(seed, content, doc.astype("u4"), start.astype("u4"), np.ones(len(seed), "u4"), np.zeros(len(seed), "u4"))


@dataclass
class Contexts:
    """Segments with all symbols that their windows cover, from symbols[offset] on."""

    seed: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    lead: np.ndarray
    offset: np.ndarray
    symbols: np.ndarray

    @staticmethod
    def join(many: list[Contexts]) -> Contexts:
        base = np.cumsum([0, *(len(c.symbols) for c in many)])
        cols = [np.concatenate([getattr(c, n) for c in many]) for n in ("seed", "doc", "start", "count", "lead")]
        return Contexts(*cols, np.concatenate([c.offset + b for c, b in zip(many, base, strict=False)]), np.concatenate([c.symbols for c in many]))


def first_places(key: np.ndarray, rank: np.ndarray, start: np.ndarray, within: bool) -> np.ndarray:
    """True where an equal key stands at an earlier place."""
    order = np.lexsort((start, rank))
    out = np.zeros(len(key), bool)
    out[order] = after_equals(key[order], rank[order], start[order], within)
    return out


def after_equals(key: np.ndarray, rank: np.ndarray, start: np.ndarray, within: bool) -> np.ndarray:
    """first_places of rows that are in order of rank and start."""
    order = np.argsort(key, kind="stable")
    k, r, s = key[order], rank[order], start[order]
    lead = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
    first = np.repeat(lead, np.diff(np.append(lead, len(k))))
    out = np.zeros(len(key), bool)
    out[order] = (r > r[first]) | ((r == r[first]) & (s > s[first])) if within else r > r[first]
    return out


def _elected(seeds: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest seed hash (leftmost of equals) of each run of `width` seeds."""
    key = (seeds & ~PLACE) | np.arange(len(seeds), dtype=np.uint64)
    n = len(key)
    padded = np.full(-(-n // width) * width, ~np.uint64(0))
    padded[:n] = key
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(after[: n - width + 1], before[width - 1 : n]) & PLACE).astype(np.int64)


def segments(kind: Kind, parts: list[np.ndarray]) -> Records:
    """Segments of consecutive parts; doc is the part's index, start counts from the part's begin."""
    x = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    n, length = len(x), kind.length
    if n < length:
        return Records.join([])
    sizes = np.array([len(p) for p in parts])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    seeds = kind.seeds(x)
    at = _elected(seeds, length - kind.seed + 1)
    first = np.flatnonzero(part[: n - length + 1] == part[length - 1 :])
    if not len(first):
        return Records.join([])
    at = at[first]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)])
    lead = np.flatnonzero(new)
    start, count = first[lead], np.diff(np.append(lead, len(first)))
    content = content_hash(x, start, start + count - 1 + length, BASE)
    doc = part[start]
    return Records(seeds[at[lead]], content, doc.astype("u4"), (start - begin[doc]).astype("u4"), count.astype("u4"), (at[lead] - start).astype("u4"))


def ranks(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Documents in order of their ids as small numbers; those without an id in order of their hashes."""
    tie = np.where(ids == LAST_ID, hashes, 0)
    order = np.lexsort((tie, ids))
    new = np.concatenate([[False], (ids[order][1:] != ids[order][:-1]) | (tie[order][1:] != tie[order][:-1])])[: len(ids)]
    out = np.empty(len(ids), np.int64)
    out[order] = np.cumsum(new)
    return out


def later(r: Records, rank: np.ndarray, within: bool) -> tuple[Records, np.ndarray]:
    """r in order of key and place, and which of its rows have an equal key at an earlier place."""
    order = np.lexsort((r.start, rank[r.doc], r.content, r.seed))
    r = r.take(order)
    if not len(order):
        return r, np.zeros(0, bool)
    new = np.concatenate([[True], (r.seed[1:] != r.seed[:-1]) | (r.content[1:] != r.content[:-1])])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    own, least = rank[r.doc], rank[r.doc[lead]]
    return r, (own > least) | ((own == least) & (r.start > r.start[lead])) if within else own > least


def spans(r: Records, length: int) -> np.ndarray:
    """Packed (begin, end) pairs that r's windows cover in one document, merged."""
    order = np.argsort(r.start, kind="stable")
    begin = r.start[order].astype(np.int64)
    end = np.maximum.accumulate(begin + r.count[order] - 1 + length)
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
    return np.stack([begin[new], end[last]], 1).astype("<u4")


def _runs(x: np.ndarray):
    """(begin, end) of each run of equal values."""
    edges = np.flatnonzero(x[1:] != x[:-1]) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(x)], strict=True) if len(x) else ()


def _by_doc(r: Records):
    r = r.take(np.argsort(r.doc, kind="stable"))
    for a, b in _runs(r.doc):
        yield int(r.doc[a]), r.take(slice(a, b))


MOVED = "_bucket int, _id long, _h long, _marks binary, _blob binary, _wide binary"
FOUND = "_id long, _h long, _marks binary, _needs binary"


def _found(r: Records, ids: np.ndarray, hashes: np.ndarray, kind: Kind) -> list[tuple]:
    """(id, hash, spans) of each document with records in r."""
    return [(int(ids[d]), int(hashes[d]), spans(x, kind.length).tobytes()) for d, x in _by_doc(r)]


def shipped(r: Records, ids: np.ndarray, hashes: np.ndarray, kind: Kind, buckets: int, wide: bool = False) -> list[tuple]:
    """Rows of MOVED: spans found among these records alone, and what is left, packed by bucket of the seed."""
    r, dup = later(r, ranks(ids, hashes), kind.within)
    rows = [(i % buckets, i, h, m, None, None) for i, h, m in _found(r.take(dup), ids, hashes, kind)]
    r = r.take(~dup)
    bucket = (mixed(r.seed) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    r, bucket = r.take(order), bucket[order]
    for a, b in _runs(bucket):
        x = r.take(slice(a, b))
        used, doc = np.unique(x.doc, return_inverse=True)
        blob = pack(ids[used], hashes[used], x.seed, x.content, doc.astype("u4"), x.start, x.count, x.lead)
        rows.append((int(bucket[a]), 0, 0, None, *((None, blob) if wide else (blob, None))))
    return rows


def shipped_contexts(c: Contexts, ids: np.ndarray, hashes: np.ndarray, kind: Kind, buckets: int) -> list[tuple]:
    """Rows of MOVED: segments with their symbols, packed by bucket of the seed."""
    bucket = (mixed(c.seed) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rows = []
    for a, b in _runs(bucket[order]):
        x = order[a:b]
        used, doc = np.unique(c.doc[x], return_inverse=True)
        sizes = c.count[x].astype(np.int64) - 1 + kind.length
        symbols = c.symbols[_stretches(c.offset[x], sizes)]
        blob = pack(ids[used], hashes[used], c.seed[x], doc.astype("u4"), c.start[x], c.count[x], c.lead[x], symbols)
        rows.append((int(bucket[x[0]]), 0, 0, None, blob, None))
    return rows


def _stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each stretch, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _opened(blobs: list[bytes], *kinds: str) -> tuple[list[list[np.ndarray]], np.ndarray, np.ndarray]:
    """Arrays of each blob after ids and hashes; documents are numbered through all blobs."""
    ids, hashes, out, base = [np.zeros(0, "i8")], [np.zeros(0, "i8")], [], 0
    for blob in blobs:
        i, h, *rest = unpack(blob, "i8", "i8", *kinds)
        at = list(kinds).index("u4")  # the first of this kind is the document
        rest[at] = rest[at] + np.uint32(base)
        ids.append(i)
        hashes.append(h)
        out.append(rest)
        base += len(i)
    return out, np.concatenate(ids), np.concatenate(hashes)


def one_sort(many: list[Records], rank: np.ndarray, within: bool) -> tuple[Records, Records]:
    """(first places of all keys, later places), by sorting all records of a bucket."""
    r, dup = later(Records.join(many), rank, within)
    return r.take(~dup), r.take(dup)


def _settled(blobs: list[bytes], kind: Kind) -> tuple[Records, list[tuple], np.ndarray, np.ndarray]:
    many, ids, hashes = _opened(blobs, *FIELDS.values())
    first, dup = one_sort([Records(*x) for x in many], ranks(ids, hashes), kind.within)
    return first, _found(dup, ids, hashes, kind), ids, hashes


def resolved(pdf: pd.DataFrame, kind: Kind, group: int) -> pd.DataFrame:
    """Rows of FOUND of one bucket: spans of segments that occur earlier, and segments whose windows need a closer look."""
    passed = pdf["_marks"].notna()
    out = [(i, h, m, None) for i, h, m in zip(pdf.loc[passed, "_id"], pdf.loc[passed, "_h"], pdf.loc[passed, "_marks"], strict=True)]
    first, found, ids, hashes = _settled(pdf.loc[~passed, "_blob"].tolist(), kind)
    out += [(*x, None) for x in found]
    if len(first.seed):
        first = first.take(np.lexsort((first.content, first.seed)))
        change = np.concatenate([[True], first.seed[1:] != first.seed[:-1]])
        number = np.cumsum(change) - 1
        size = np.bincount(number)[number]  # of different segments, as equal ones have left but one
        mixed_up = first.take(size > 1)
        wide = (size > group)[size > 1]
        order = np.argsort(mixed_up.doc, kind="stable")
        mixed_up, wide = mixed_up.take(order), wide[order]
        for a, b in _runs(mixed_up.doc):
            x = mixed_up.take(slice(a, b))
            out.append((int(ids[x.doc[0]]), int(hashes[x.doc[0]]), None, pack(x.seed, x.start, x.count, x.lead, wide[a:b].astype("u1"))))
    return pd.DataFrame(out, columns=["_id", "_h", "_marks", "_needs"])


def extended(pdf: pd.DataFrame, kind: Kind) -> pd.DataFrame:
    """Rows (_id, _h, _marks) of one bucket: spans of windows that occur earlier."""
    passed = pdf["_marks"].notna()
    out = list(zip(pdf.loc[passed, "_id"], pdf.loc[passed, "_h"], pdf.loc[passed, "_marks"], strict=True))
    out += _settled(pdf["_wide"].dropna().tolist(), kind)[1]
    many, ids, hashes = _opened(pdf["_blob"].dropna().tolist(), "u8", "u4", "u4", "u4", "u4", kind.symbol)
    contexts = []
    for *cols, symbols in many:
        sizes = cols[3].astype(np.int64) - 1 + kind.length
        contexts.append(Contexts(*cols, np.cumsum(sizes) - sizes, symbols))
    if contexts:
        out += _found(kind.extend(contexts, ranks(ids, hashes), kind), ids, hashes, kind)
    return pd.DataFrame(out, columns=["_id", "_h", "_marks"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_t"))


def _parts(x: np.ndarray, length: int, most: int):
    """(place, part) of a long sequence: parts of at most `most` overlap so that each window is in one of them."""
    step = most - length + 1
    for at in range(0, max(1, len(x) - length + 1), step):
        yield at, x[at : at + most]


def _batches(batch: pa.RecordBatch, text_at: int, most: int):
    for part in groups_of(sizes_of(batch.column(text_at)), most):
        yield batch.slice(part.start, part.stop - part.start)


def _moved(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["_bucket", "_id", "_h", "_marks", "_blob", "_wide"])


def _windows(x: np.ndarray, start: np.ndarray, count: np.ndarray, length: int, most: int):
    """(places, two fingerprints) of all windows of some segments, part by part of a long text."""
    for at, part in _parts(x, length, most):
        top = at + len(part) - length + 1
        # the windows of the segments that begin in this part
        lo, hi = np.maximum(start, at), np.minimum(start + count, top)
        w = _stretches(lo, np.maximum(hi - lo, 0))
        if len(w):
            yield w, *(content_hash(part, w - at, w - at + length, base) for base in (BASE, BASE2))


def repeated(docs: DataFrame, kind: Kind, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _h, _all): for each row of docs with any, a list of packed span arrays that windows seen earlier cover.

    _h is xxhash64 of the text; null ids are LAST_ID. Spans of different entries may overlap.
    """
    rows, most, group = _keyed(docs, id_col, text_col), PART, GROUP
    size = rows.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    buckets = max(2 * partitions(docs.sparkSession), -(-size // BUCKET_BYTES))

    def scan(batches):
        for batch in batches:
            for some in _batches(batch, 2, most):
                ids, hashes = some.column(0).to_numpy(), some.column(1).to_numpy()
                found = []
                numbers = [kind.numbers(t) for t in texts_of(some.column(2))]
                if sum(map(len, numbers)) <= 2 * most:
                    found.append(segments(kind, numbers))
                else:
                    for d, x in enumerate(numbers):
                        for at, part in _parts(x, kind.length, most):
                            r = segments(kind, [part])
                            found.append(Records(r.seed, r.content, r.doc + np.uint32(d), r.start + np.uint32(at), r.count, r.lead))
                yield _moved(shipped(Records.join(found), ids, hashes, kind, buckets))

    def closer(batches):
        for batch in batches:
            for some in _batches(batch, 2, most):
                ids, hashes = some.column(0).to_numpy(), some.column(1).to_numpy()
                wide, near, symbols, base = [Records.join([])], [], [], 0
                for d, (t, lists) in enumerate(zip(texts_of(some.column(2)), some.column(3).to_pylist(), strict=True)):
                    asked = [unpack(p, "u8", "u4", "u4", "u4", "u1") for p in lists]
                    seed, start, count, lead, big = (np.concatenate([a[k] for a in asked]) for k in range(5))
                    big = big.astype(bool)
                    if big.any():
                        order = np.flatnonzero(big)[np.argsort(start[big], kind="stable")]
                        for w, a, b in _windows(kind.numbers(t), start[order].astype(np.int64), count[order].astype(np.int64), kind.length, most):
                            wide.append(Records.windows(a, b, np.full(len(w), d), w))
                    if not big.all():
                        x = kind.symbols(t)
                        pick = ~big
                        near.append((seed[pick], np.full(pick.sum(), d, "u4"), start[pick], count[pick], lead[pick], start[pick].astype(np.int64) + base))
                        symbols.append(x)
                        base += len(x)
                rows = shipped(Records.join(wide), ids, hashes, kind, buckets, wide=True)
                if near:
                    rows += shipped_contexts(Contexts(*map(np.concatenate, zip(*near, strict=True)), np.concatenate(symbols)), ids, hashes, kind, buckets)
                yield _moved(rows)

    coarse = written(rows.mapInArrow(scan, MOVED).groupBy("_bucket").applyInPandas(lambda pdf: resolved(pdf, kind, group), FOUND))
    asked = coarse.where("_needs IS NOT NULL").groupBy("_id", "_h").agg(F.collect_list("_needs").alias("_needs"))
    near = rows.join(asked, ["_id", "_h"]).select("_id", "_h", "_t", "_needs").mapInArrow(closer, MOVED)
    near = near.groupBy("_bucket").applyInPandas(lambda pdf: extended(pdf, kind), "_id long, _h long, _marks binary")
    both = coarse.where("_marks IS NOT NULL").select("_id", "_h", "_marks").union(near)
    return written(both).groupBy("_id", "_h").agg(F.collect_list("_marks").alias("_all"))


def covered(lists: list[bytes] | None) -> np.ndarray:
    """Merged (begin, end) pairs of packed span arrays, ascending."""
    if not lists:
        return np.zeros((0, 2), np.int64)
    x = np.frombuffer(b"".join(lists), "<u4").reshape(-1, 2).astype(np.int64)
    x = x[np.argsort(x[:, 0], kind="stable")]
    end = np.maximum.accumulate(x[:, 1])
    new = np.concatenate([[True], x[1:, 0] > end[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(x) - 1)
    return np.stack([x[new, 0], end[last]], 1)


def with_spans(docs: DataFrame, found: DataFrame, run, schema: str, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """docs joined with repeated()'s rows and mapped by run over batches of (keep..., text, span lists)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_t"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"), F.xxhash64(text).alias("_h"))
    return rows.join(found, ["_id", "_h"], "left").select(*keep, "_t", "_all").mapInArrow(run, schema)
