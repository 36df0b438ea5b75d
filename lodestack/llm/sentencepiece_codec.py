"""SentencePiece (BPE models) encoding with source offsets, and decoding.

The model file is read as what it is, a protocol buffer: pieces, normaliser settings and the
compiled character map. Normalisation takes the longest prefix found in the map and records
for every normalised character the source bytes it stands for; the pieces of the normalised
text are then projected to byte spans of the source. Merges never cross certain places
(before a space mark that follows another character, and around characters that no longer
piece holds), so texts are cut there and each distinct cut is encoded once for a worker.
"""

from __future__ import annotations

import heapq
import re
import struct
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_of, sizes_of, texts_of

MARK = "▁"  # fixed value: what stands for a space in pieces
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # fixed values: kinds of pieces
KEPT_CUTS = 200_000  # a worker's store of encoded cuts starts anew beyond this
LONG_CUT = 64  # longer cuts are merged one by one, with a heap
BATCH_BYTES = 2 << 20  # texts that are encoded, and sent on, together


def _fields(raw: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at, end = 0, len(raw)

    def varint():
        nonlocal at
        shift = out = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < end:
        tag = varint()
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            yield number, varint()
        elif kind == 2:
            n = varint()
            yield number, raw[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield number, raw[at : at + n]
            at += n


class CharsMap:
    """The compiled character map: a double-array trie from source prefixes to replacements."""

    def __init__(self, raw: bytes):
        self.units, self.pool = [], b""
        if raw:
            (size,) = struct.unpack_from("<I", raw)
            self.units = np.frombuffer(raw, "<u4", size // 4, 4).tolist()
            self.pool = raw[4 + size :]
        self.known: dict[bytes, bytes] = {}

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix of text[at:] that the map replaces, and its replacement."""
        units, found = self.units, None
        if not units:
            return None

        def offset(unit):
            return (unit >> 10) << ((unit & (1 << 9)) >> 6)

        node = offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & ((1 << 31) | 255) != text[i]:
                break
            node ^= offset(unit)
            if (unit >> 8) & 1:
                value = units[node] & ((1 << 31) - 1)
                found = (i - at + 1, self.pool[value : self.pool.index(b"\0", value)])
        return found


class Codec:
    def __init__(self, model: bytes):
        self.pieces, self.kinds, scores = [], [], []
        spec = trainer = b""
        for number, value in _fields(model):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for k, v in _fields(value):
                    if k == 1:
                        piece = v.decode()
                    elif k == 2:
                        (score,) = struct.unpack("<f", v)
                    elif k == 3:
                        kind = v
                self.pieces.append(piece)
                self.kinds.append(kind)
                scores.append(score)
            elif number == 2:
                trainer = value
            elif number == 3:
                spec = value
        settings = dict(_fields(trainer))
        if settings.get(3, 1) != 2:
            raise ValueError("not a BPE model")
        self.bos, self.eos, self.unk = settings.get(41, 1), settings.get(42, 2), settings.get(40, 0)
        self.byte_fallback = bool(settings.get(35, 0))
        norm = dict(_fields(spec))
        self.map = CharsMap(norm.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        if any(k == USER for k in self.kinds):
            raise ValueError("user-defined pieces are not supported")
        self.ids = normal
        self.rank = {p: (-scores[i], i) for p, i in normal.items()}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        longer = [p for p in normal if len(p) > 1]
        self.cut_at_mark = not any(MARK in p.lstrip(MARK) for p in longer)
        inside = re.escape("".join(sorted({c for p in longer for c in p} - {MARK})))
        words = f"{MARK}*[{inside}]+" if self.cut_at_mark else f"[{MARK}{inside}]+"
        self.cuts = re.compile(f"{words}|{MARK}+|." if inside else ".", re.DOTALL)
        self.kept: dict[str, tuple] = {}
        self._pairs(normal)

    def _pairs(self, normal: dict[str, int]) -> None:
        """A hash table from pairs of symbols to the piece they merge to; symbols are pieces and single characters."""
        chars = sorted({c for p in normal for c in p if c not in normal})
        self.symbols = normal | {c: len(self.pieces) + i for i, c in enumerate(chars)}
        keys, merged = [], []
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(i)
        keys, merged = np.array(keys or [0], np.uint64), np.array(merged or [-1], np.int64)
        self.bits = max(10, int(len(keys)).bit_length() + 3)
        self.slot_key = np.full(1 << self.bits, ~np.uint64(0))
        self.slot_piece = np.full(1 << self.bits, -1, np.int64)
        self.probes, left = 0, np.arange(len(keys))
        while len(left):
            at = self._slot(keys[left], self.probes)
            free = self.slot_key[at] == ~np.uint64(0)
            first = np.zeros(len(left), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.slot_key[at[put]], self.slot_piece[at[put]] = keys[left[put]], merged[left[put]]
            left = left[~put]
            self.probes += 1
        scores = np.full(len(self.pieces), np.inf)
        for score, i in self.rank.values():
            scores[i] = score
        # dense ranks keep equal scores equal
        self.order = np.append(np.unique(scores, return_inverse=True)[1], 0).astype(np.int64)

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return (((keys + np.uint64(probe)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for probe in range(self.probes):
            at = self._slot(keys[left], probe)
            got = self.slot_key[at]
            hit = got == keys[left]
            out[left[hit]] = self.slot_piece[at[hit]]
            left = left[~hit & (got != ~np.uint64(0))]
            if not len(left):
                break
        return out

    # --- normalisation -------------------------------------------------------------------

    def normalise(self, text: bytes) -> tuple[str, np.ndarray, np.ndarray]:
        """Normalised text, and for each of its characters the begin and end of its source bytes.

        Characters that the normaliser adds have an empty span at the place they were added.
        """
        if not self.map.units and not self.squeeze:
            s = text.decode("utf-8", "replace")
            raw = np.frombuffer(text, np.uint8)
            begin = np.flatnonzero((raw & 0xC0) != 0x80).astype(np.int32)
            end = np.append(begin[1:], len(text)).astype(np.int32)[: len(begin)]
            if self.escape:
                s = s.replace(" ", MARK)
        else:
            out, begins, ends = [], [], []
            at = 0
            while at < len(text):
                found = self.map.longest(text, at)
                if found:
                    n, new = found[0], found[1].decode()
                else:
                    n = 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
                    new = text[at : at + n].decode("utf-8", "replace")
                for c in new:
                    if c == " " and self.squeeze and (not out or out[-1] == " "):
                        continue
                    out.append(c)
                    begins.append(at)
                    ends.append(at + n)
                at += n
            if self.squeeze and out and out[-1] == " ":
                out, begins, ends = out[:-1], begins[:-1], ends[:-1]
            s = "".join(out)
            if self.escape:
                s = s.replace(" ", MARK)
            begin, end = np.array(begins, np.int32), np.array(ends, np.int32)
        if self.dummy and s:
            s = (MARK if self.escape else " ") + s
            begin, end = np.append(begin[:1], begin), np.append(begin[:1], end)
        return s, begin, end

    # --- encoding ------------------------------------------------------------------------

    def _merge(self, cut: str) -> list[str]:
        """Pieces of one cut: the pair of the best score merges first, the leftmost of equals."""
        parts = list(cut)
        n, rank = len(parts), self.rank
        if n == 1:
            return parts
        if cut in rank and n == 2:
            return [cut]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i, j):
            if i >= 0 and j >= 0 and (r := rank.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r[0], i, len(parts[i]) + len(parts[j]), j))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, size, j = heapq.heappop(heap)
            if not parts[i] or not parts[j] or len(parts[i]) + len(parts[j]) != size or after[i] != j:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p]

    def _encode_cut(self, cut: str) -> tuple:
        """(packed ids, characters of each id's piece) of a cut.

        A character outside the vocabulary becomes its bytes; the first of them carries the character.
        """
        ids, widths = [], []
        for p in self._merge(cut):
            i = self.ids.get(p)
            if i is not None:
                ids.append(i)
                widths.append(len(p))
            elif self.byte_fallback:
                raw = p.encode()
                ids += [self.byte_id[b] for b in raw]
                widths += [1] + [0] * (len(raw) - 1)
            else:
                ids.append(self.unk)
                widths.append(len(p))
        return struct.pack(f"<{len(ids)}I", *ids), bytes(widths)

    def _learn(self, cuts: list[str]) -> None:
        """Encode distinct cuts: in every round each cut merges its best pair, all cuts at once."""
        short = [c for c in cuts if len(c) <= LONG_CUT]
        for c in cuts:
            if len(c) > LONG_CUT:
                self.kept[c] = self._encode_cut(c)
        if not short:
            return
        text = "".join(short)
        names = sorted(set(text))
        other = {c: len(self.pieces) + len(self.symbols) + i for i, c in enumerate(names)}
        code = np.array([self.symbols.get(c, other[c]) for c in names], np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        sym = code[np.searchsorted(np.array([ord(c) for c in names], np.uint32), points)]
        size = np.ones(len(sym), np.int64)
        cut = np.repeat(np.arange(len(short)), [len(c) for c in short])
        none = np.int64(1) << 62

        def ranked(i):
            """Rank and place of the pairs that start at i, in sym as it is."""
            piece = np.full(len(i), -1, np.int64)
            inner = (i + 1 < len(sym)) & (i >= 0)
            inner[inner] = cut[i[inner]] == cut[i[inner] + 1]
            piece[inner] = self._lookup(sym[i[inner]], sym[i[inner] + 1])
            return np.where(piece >= 0, self.order[piece] << 32, none), piece

        rank, piece = ranked(np.arange(len(sym)))
        done = []
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], cut[1:] != cut[:-1]]))
            best = np.minimum.reduceat(np.where(rank < none, rank | np.arange(len(rank)), none), starts)
            go = best < none
            if not go.all():
                live = np.repeat(go, np.diff(np.append(starts, len(sym))))
                done.append((cut[~live], sym[~live], size[~live]))
                shift = np.cumsum(live) - 1
                at = shift[best[go] & 0xFFFFFFFF]
                cut, sym, size, rank, piece = cut[live], sym[live], size[live], rank[live], piece[live]
            else:
                at = best & 0xFFFFFFFF
            if not len(sym):
                break
            sym[at] = piece[at]
            size[at] += size[at + 1]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            at = (np.cumsum(stay) - 1)[at]
            cut, sym, size, rank, piece = cut[stay], sym[stay], size[stay], rank[stay], piece[stay]
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near], piece[near] = ranked(near)
        cut, sym, size = (np.concatenate([d[k] for d in done]) for k in range(3))
        order = np.argsort(cut, kind="stable")
        sym, size = sym[order], size[order]
        ends = np.cumsum(np.bincount(cut, minlength=len(short))).tolist()
        plain = sym < len(self.pieces)
        ids, widths = sym.astype("<u4").tobytes(), size.astype(np.uint8).tobytes()
        odd = set(np.unique(cut[order][~plain]).tolist())
        at = 0
        for i, (c, end) in enumerate(zip(short, ends, strict=True)):
            if i in odd:
                chars, row, wide = 0, [], []
                for k in range(at, end):
                    if plain[k]:
                        row.append(int(sym[k]))
                        wide.append(int(size[k]))
                    elif self.byte_fallback:
                        raw = c[chars].encode()
                        row += [self.byte_id[b] for b in raw]
                        wide += [1] + [0] * (len(raw) - 1)
                    else:
                        row.append(self.unk)
                        wide.append(1)
                    chars += int(size[k])
                self.kept[c] = (struct.pack(f"<{len(row)}I", *row), bytes(wide))
            else:
                self.kept[c] = (ids[4 * at : 4 * end], widths[at:end])
            at = end

    def encode_all(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text (ids with begin and end id, span begins, span ends); spans are bytes of the source."""
        if len(self.kept) > KEPT_CUTS:
            self.kept.clear()
        normal = [self.normalise(t) for t in texts]
        cuts = [self.cuts.findall(n[0]) for n in normal]
        new = set().union(*cuts).difference(self.kept)
        if new:
            self._learn(sorted(new))
        return [self._assemble(t, n, c) for t, n, c in zip(texts, normal, cuts, strict=True)]

    def _assemble(self, text: bytes, normal: tuple, cuts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, begin, end = normal
        got = [self.kept[c] for c in cuts]
        ids = np.frombuffer(b"".join([x[0] for x in got]), "<u4")
        widths = np.frombuffer(b"".join([x[1] for x in got]), np.uint8).astype(np.int64)
        upto = np.cumsum(widths)
        begins = begin[np.maximum(upto - np.maximum(widths, 1), 0)] if len(ids) else np.zeros(0, np.int32)
        ends = end[np.maximum(upto - 1, 0)] if len(ids) else np.zeros(0, np.int32)
        n = np.int32(len(text))
        return (
            np.concatenate([[self.bos], ids, [self.eos]]).astype("<u4"),
            np.concatenate([[np.int32(0)], begins, [n]]).astype("<i4"),
            np.concatenate([[np.int32(0)], ends, [n]]).astype("<i4"),
        )

    # --- decoding ------------------------------------------------------------------------

    @cached_property
    def surfaces(self) -> list[bytes]:
        """The bytes that each id adds to a text; control pieces add none."""
        out = []
        for p, k in zip(self.pieces, self.kinds, strict=True):
            out.append(b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else p.replace(MARK, " ").encode())
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: control pieces vanish, runs of byte pieces are read as UTF-8, the added space goes."""
        ids = ids.tolist()
        while ids and self.kinds[ids[0]] == CONTROL:
            ids = ids[1:]
        while ids and self.kinds[ids[-1]] == CONTROL:
            ids.pop()
        surfaces, kinds = self.surfaces, self.kinds
        parts = [surfaces[i] for i in ids]
        if parts and self.dummy and kinds[ids[0]] == NORMAL and parts[0][:1] == b" ":
            parts[0] = parts[0][1:]
        if b"" not in parts[1:]:
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        out, run = [], b""
        for i, part in zip(ids, parts, strict=True):
            if kinds[i] == BYTE:
                run += part
            else:
                out += [_lenient(run), part]
                run = b""
        return b"".join([*out, _lenient(run)]).decode()


def _lenient(raw: bytes) -> bytes:
    """raw with every byte that starts no valid character replaced by U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        out, at = b"", 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    raw[at : at + n].decode()
                    out += raw[at : at + n]
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out += b"\xef\xbf\xbd"
                at += 1
        return out


@lru_cache(maxsize=4)
def codec(model_path: str) -> Codec:
    with open(model_path, "rb") as f:
        return Codec(f.read())


def encode(docs: DataFrame, model_path: str, text_col: str = "text", *, packed: bool = False, decoded: str | None = None) -> DataFrame:
    """`docs` without the text, with piece ids and the byte span of the source that each piece stands for.

    Columns ids, begins, ends: arrays of int, or with packed=True binary columns of little-endian
    32-bit integers (ids unsigned). Begin and end ids have empty spans at the text's ends. decoded
    names a column for what decode() makes of the ids, done in the same pass. Null texts count as
    empty and give the begin and end id only. Columns of docs with these names are replaced.
    model_path must exist on every executor.
    """
    names = ["ids", "begins", "ends", *([decoded] if decoded else [])]
    keep = [c for c in docs.columns if c not in {*names, text_col}]
    kind = "binary" if packed else "array<int>"
    kinds = [kind] * 3 + ["string"] * bool(decoded)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema), *(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))])

    def run(batches):
        c = codec(model_path)
        for batch in batches:
            for part in groups_of(sizes_of(batch.column(len(keep))), BATCH_BYTES):
                some = batch.slice(part.start, part.stop - part.start)
                rows = c.encode_all(texts_of(some.column(len(keep))))
                cols = []
                for k in range(3):
                    if packed:
                        cols.append(pa.array([r[k].tobytes() for r in rows], pa.binary()))
                    else:
                        cols.append(pa.array([r[k].astype("<i4") for r in rows], pa.list_(pa.int32())))
                if decoded:
                    cols.append(pa.array([c.decode(r[0]) for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays([*some.columns[: len(keep)], *cols], [*keep, *names])

    return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`tokens` with the text of its ids (array of int, or packed); null ids give null, no ids the empty text."""
    keep = [c for c in tokens.columns if c != out_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(keep).schema), f"{out_col} string"])
    at = keep.index(ids_col)

    def run(batches):
        c = codec(model_path)
        for batch in batches:
            out = []
            for x in batch.column(at):
                v = x.as_py() if isinstance(x, pa.BinaryScalar) else x.values
                out.append(None if v is None else c.decode(np.frombuffer(v, "<u4") if isinstance(v, bytes) else v.to_numpy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*keep, out_col])

    return tokens.select(*keep).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tokens = encode(docs, path, packed=True, decoded="decoded")
    # the last piece ends where the text ends: four bytes, least first
    spanned = F.conv(F.concat(*[F.hex(F.substring("ends", -k, 1)) for k in (1, 2, 3, 4)]), 16, 10).cast("long")
    return tokens.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.octet_length("begins") / 4).cast("long").alias("n_spans"), spanned.alias("n_bytes"),
    )
