"""Ranked lexical search by branch and bound over trees of documents.

The terms of all queries are numbered from the most frequent down, and a document is the
ascending list of those it holds. A task sorts blocks of documents by these lists: neighbours
share prefixes, and the shared prefixes are the inner nodes of a tree (an FP-tree without
chains). Every node knows the largest count of each term below it and the smallest length
factor, which bound the score of all its documents; at a leaf the bound is the score itself.
Each query walks the trees of a task depth first, best child first, and leaves out what its
k best so far exceed. The lists of all tasks merge into the result, which is exact.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import texts_of, written

QUERY_BYTES = 8 << 20  # bytes of query texts that are searched in one round
BLOCK_DOCS = 2048  # documents of a tree
BLOCK_TERMS = 400_000  # terms of a tree, about; a longer document is a tree of its own
DEPTH = 12  # inner levels of a tree; below them documents hang side by side
PIECE = 1 << 20  # bytes that are cut to terms at once
SCALE, TF, FACTOR = 1_000_000_000, 1000, 12
_TERM = set(range(0x30, 0x3A)) | set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes(ord(chr(b).lower()) if b < 0x80 and b in _TERM else b if b in _TERM else 0x20 for b in range(256))


def terms_of(text: bytes):
    """Lists of terms of a whole text, a piece of it at a time: runs of letters, digits and bytes beyond ASCII, A-Z in lower case."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] in _TERM:
            end += 1
        yield text[at:end].translate(_FOLD).split(b" ")
        at = end


def vectors(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, counts) of every row with a term: its number of terms, and the query terms in it, by their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(number)  # terms of at most QUERY_BYTES of queries

    def run(batches):
        known = shared.value.get
        for batch in batches:
            length, sizes, keys, counts = [], [], [], []
            for text in texts_of(batch.column(1)):
                n, found = 0, []
                for words in terms_of(text):
                    n += len(words) - words.count(b"")
                    found += filter(None, map(known, words))
                term, tf = np.unique(np.array(found, np.int32), return_counts=True)
                length.append(n)
                sizes.append(len(term))
                keys.append(term)
                counts.append(tf)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            keys, counts = (np.concatenate([np.zeros(0, np.int32), *x]).astype(np.int32) for x in (keys, counts))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (keys, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length, pa.int64()), *lists], ["_id", "_n", "_terms", "_counts"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t")).where("_id IS NOT NULL AND _t IS NOT NULL")
    return rows.mapInArrow(run, "_id long, _n long, _terms array<int>, _counts array<int>").where("_n > 0")


def part_of_score(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to the score of a document, and, for a node's largest tf and smallest m, the most it adds to any below."""
    return weight * ((SCALE * tf) // (TF * tf + FACTOR * m))


@dataclass
class Tree:
    """Nodes of one block, children of a node next to each other; rows of (term, largest tf) of node i start at start[i]."""

    first: np.ndarray  # first child of each node
    last: np.ndarray  # after its last child; 0 of a leaf
    m: np.ndarray  # smallest m below
    start: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    members: list  # of each leaf, the ids of its documents in ascending order; None of inner nodes

    @staticmethod
    def of(ids: np.ndarray, m: np.ndarray, rows: list[np.ndarray], counts: list[np.ndarray]) -> Tree:
        """The tree of documents whose terms stand in `rows`, most frequent first, with their counts."""
        keys = [r.astype(">i4").tobytes() for r in rows]
        order = sorted(range(len(rows)), key=lambda i: (keys[i], counts[i].tobytes(), m[i], ids[i]))
        leaves: list[list[int]] = []
        for i in order:  # documents of equal vectors and m are one leaf
            j = leaves[-1][0] if leaves else i
            if leaves and keys[i] == keys[j] and m[i] == m[j] and np.array_equal(counts[i], counts[j]):
                leaves[-1].append(i)
            else:
                leaves.append([i])
        head = [x[0] for x in leaves]
        common = np.array([0, *(_shared(rows[a], rows[b]) for a, b in zip(head, head[1:]))])
        first, last, span, level = [0], [0], [(0, len(head))], [0]
        at = 0
        while at < len(span):  # breadth first, so that children follow each other
            low, high = span[at]
            if at == 0 or high - low > 1:
                cut = common[low + 1 : high]
                inner = np.arange(1, high - low) if level[at] >= DEPTH or not len(cut) else np.flatnonzero(cut == cut.min()) + 1
                edges = [low, *(low + inner).tolist(), high]
                first[at], last[at] = len(span), len(span) + len(edges) - 1
                span += zip(edges, edges[1:])
                first += [0] * (len(edges) - 1)
                last += [0] * (len(edges) - 1)
                level += [level[at] + 1] * (len(edges) - 1)
            at += 1
        return Tree._with_bounds(np.array(first), np.array(last), np.array(span), np.array(level), [ids[x] for x in leaves], m[head], [rows[i] for i in head], [counts[i] for i in head])

    @staticmethod
    def _with_bounds(first, last, span, level, members, m, rows, counts) -> Tree:
        """Largest counts and smallest m of all nodes, a level of the tree at a time."""
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        term, tf = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *counts]).astype(np.int64)
        width = int(term.max(initial=0)) + 1
        node_m, found = np.zeros(len(span), np.int64), []
        for lv in range(int(level.max()) + 1):
            nodes = np.flatnonzero(level == lv)
            owner = np.full(len(rows) + 1, -1)
            lows, highs = span[nodes, 0], span[nodes, 1]
            for node, low, high in zip(nodes.tolist(), lows.tolist(), highs.tolist(), strict=True):
                owner[low:high] = node
                node_m[node] = m[low:high].min(initial=np.iinfo(np.int64).max)
            of = owner[doc]
            key = (of * width + term)[of >= 0]
            by = np.argsort(key, kind="stable")
            key, most = key[by], tf[of >= 0][by]
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            found.append((key[at], np.maximum.reduceat(most, at) if len(at) else most))
        key, most = (np.concatenate(x) for x in zip(*found, strict=True))  # levels ascend, and nodes within a level
        start = np.searchsorted(key, np.arange(len(span) + 1) * width)
        leaf = [members[low] if b == 0 and high - low == 1 else None for b, (low, high) in zip(last.tolist(), span.tolist(), strict=True)]
        return Tree(first, last, node_m, start, key % width, most, leaf)

    def bounds(self, node: int, weight: np.ndarray) -> np.ndarray:
        """The highest score possible below each child of a node."""
        a, b = self.first[node], self.last[node]
        low, high = self.start[a], self.start[b]
        w = weight[self.term[low:high]]
        held = np.flatnonzero(w)
        child = np.searchsorted(self.start[a : b + 1], held + low, "right") - 1
        out = np.zeros(b - a, np.int64)
        np.add.at(out, child, part_of_score(w[held], self.tf[low:high][held], self.m[a:b][child]))
        return out

    def search(self, weight: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
        """Walk depth first; `best` is a heap of (score, -id) of the k best so far, which also holds those of other trees."""
        todo = [(np.iinfo(np.int64).max, 0)]
        while todo:
            bound, node = todo.pop()
            if len(best) == k and bound < best[0][0]:
                continue
            ids = self.members[node]
            if ids is not None:
                for i in ids[:k].tolist():
                    if len(best) < k:
                        heapq.heappush(best, (bound, -i))
                    elif (bound, -i) > best[0]:
                        heapq.heapreplace(best, (bound, -i))
                    else:
                        break
                continue
            limits = self.bounds(node, weight)
            least = best[0][0] if len(best) == k else 1
            alive = np.flatnonzero(limits >= max(1, least))
            alive = alive[np.argsort(limits[alive], kind="stable")]  # the best child is popped first
            todo += zip(limits[alive].tolist(), (alive + self.first[node]).tolist(), strict=True)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two lists."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _blocks(batches):
    """(ids, m, terms, counts) of consecutive rows, bounded by BLOCK_DOCS and BLOCK_TERMS."""
    held, size = [], 0
    for batch in batches:
        ids, m = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        at = batch.column(2).offsets.to_numpy()
        terms, counts = batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
        for i in range(batch.num_rows):
            if held and (len(held) >= BLOCK_DOCS or size + at[i + 1] - at[i] > BLOCK_TERMS):
                yield held
                held, size = [], 0
            by = np.argsort(terms[at[i] : at[i + 1]])
            held.append((ids[i], m[i], terms[at[i] : at[i + 1]][by], counts[at[i] : at[i + 1]][by]))
            size += at[i + 1] - at[i]
    if held:
        yield held


def _round(docs: DataFrame, items: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """(_item, doc_id, score): the k best documents for each of a bounded list of query texts, by its place in the list."""
    spark = docs.sparkSession
    wanted = [[w for words in terms_of(text.encode()) for w in words if w] for text in items]
    number = {w: i for i, w in enumerate(sorted({w for words in wanted for w in words}), 1)}
    rows = written(vectors(docs, number, id_col, text_col))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_n").alias("l")).first()
    found = dict(map(tuple, rows.select(F.explode("_terms").alias("t")).groupBy("t").count().collect()))  # at most one row for each query term
    df = np.zeros(len(number) + 1, np.int64)
    df[list(found)] = list(found.values())
    rank = np.zeros(len(df), np.int32)
    rank[np.lexsort((np.arange(1, len(df)), -df[1:])) + 1] = np.arange(len(df) - 1)
    weight = [math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * int(d) + 1))) for d in df]
    asked = []
    for words in wanted:
        term, times = np.unique(np.array([number[w] for w in words], int), return_counts=True)
        asked.append((rank[term], times * np.array([weight[t] for t in term], np.int64)))
    shared = spark.sparkContext.broadcast((rank, asked))

    def run(batches):
        rank, asked = shared.value
        best = [[] for _ in asked]
        for block in _blocks(batches):
            ids, m, terms, counts = zip(*block, strict=True)
            by = [np.argsort(rank[t]) for t in terms]
            tree = Tree.of(np.array(ids), np.array(m), [rank[t][o] for t, o in zip(terms, by, strict=True)], [c[o] for c, o in zip(counts, by, strict=True)])
            dense = np.zeros(len(rank), np.int64)
            for i, (term, w) in enumerate(asked):
                dense[term] = w
                tree.search(dense, best[i], k)
                dense[term] = 0
        out = [(i, -d, s) for i, heap in enumerate(best) for s, d in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], ["_item", "doc_id", "score"])

    m = F.expr(f"75L + ((25L * _n * {total['n']}L) DIV {total['l'] or 1}L)")
    return rows.where(F.size("_terms") > 0).select("_id", m.alias("_m"), "_terms", "_counts").mapInArrow(run, "_item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents of highest score above 0, equal scores by ascending id.

    Null texts have no term; documents without an id take no part. Items that repeat an id and text
    count once, different texts of one id are ranked apart, and a null item id stays null. Rows
    that repeat a document are documents of their own. Without documents or items there are no rows.
    Items are searched in rounds of about QUERY_BYTES bytes, so that what is broadcast stays bounded.
    """
    asked = items.select(F.col(item_col).alias("_key"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("_q")).distinct()
    size = asked.agg(F.sum(F.octet_length("_q"))).first()[0] or 0
    rounds, out = -(-size // QUERY_BYTES) or 1, []
    for r in range(rounds):
        here = asked.where(F.pmod(F.xxhash64("_key", "_q"), F.lit(rounds)) == r).orderBy("_key", "_q").collect()
        keys = docs.sparkSession.createDataFrame([(i, row["_key"]) for i, row in enumerate(here)], items.select(F.lit(0).cast("long").alias("_item"), F.col(item_col).alias("item_id")).schema)
        best = _round(docs, [row["_q"] for row in here], k, id_col, text_col)
        w = Window.partitionBy("_item").orderBy(F.desc("score"), "doc_id")
        best = best.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
        out.append(best.join(F.broadcast(keys), "_item").select("item_id", "rank", "doc_id", "score"))
    result = out[0]
    for other in out[1:]:
        result = result.unionByName(other)
    return result


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents), tot AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
q AS (SELECT item_id, term, count(*) AS mult FROM (SELECT item_id, unnest({WORDS}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), tot),
m AS (SELECT doc_id, 75 + ((25 * len(w) * n) // l) AS m FROM d, tot WHERE len(w) > 0),
s AS (SELECT item_id, doc_id, sum(mult * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
