"""Jaccard self-join of documents on their word n-grams, by MinHash banding.

Bands and rows are chosen for a target recall at the threshold. Documents with one n-gram set
form a class and go on as one. Classes shuffle on their band hashes; within a bucket of few
classes every pair is a candidate, in larger ones every class meets landmarks, and what they
connect goes on as one. Candidates are verified on full n-gram sets, links connect classes, and
connected classes get one id. Links are counted afterwards, among all members of each class.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_of_each, texts_of, written
from .tokens import ODD, WordNumbers, grams, mixed, words_of

SMALL = 12  # buckets of at most so many classes are compared pair by pair
TILE = 256  # sets of a block, unless their n-grams take more than BLOCK_BYTES
MEMBERS = 1024  # sets of a class that are counted as one block, unless their n-grams take more than
BLOCK_BYTES = 8 << 20


def choose_bands(threshold: float, recall: float, hashes: int = 128) -> tuple[int, int]:
    """(bands, rows) with the most rows a band whose recall at the threshold reaches the target within so many hashes."""
    best = None
    for rows in range(1, hashes + 1):
        p = threshold**rows
        bands = 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log1p(-p)) if p > 0 else hashes + 1
        if bands * rows > hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def ngram_set(text: bytes, n: int, numbers: WordNumbers) -> np.ndarray:
    """Hashes of the distinct runs of n words, ascending; of all words if there are fewer; none for no words."""
    words = numbers.of(words_of(text))
    if not len(words):
        return words
    return np.unique(grams(words, min(n, len(words))) ^ np.uint64(min(n, len(words)) * 0x1234567))


def minhash(ngrams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band."""
    k = np.arange(1, bands * rows + 1, dtype=np.uint64)
    factor, add = mixed(k * ODD) | np.uint64(1), mixed(k + ODD)
    sig = np.full(bands * rows, np.iinfo(np.uint32).max, np.uint64)
    for at in range(0, len(ngrams), 2048):
        part = (ngrams[at : at + 2048, None] * factor + add) >> np.uint64(32)
        sig = np.minimum(sig, part.min(0))
    out = np.arange(bands, dtype=np.uint64)
    for column in sig.reshape(bands, rows).T:
        out = mixed(out * ODD + column)
    return out


def _text(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def sketches(docs: DataFrame, n: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, _set, _size, _bands): hash of the text, 128-bit hash of the n-gram set, its size, band hashes."""

    def run(batches):
        numbers = WordNumbers()
        for batch in batches:
            sets = [ngram_set(t, n, numbers) for t in texts_of(batch.column(2))]
            keys = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            hashes = [minhash(s, bands, rows).astype(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(hashes, pa.list_(pa.int64()))],
                ["_id", "_h", "_set", "_size", "_bands"],
            )

    rows_in = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(_text(docs, text_col)).alias("_h"), _text(docs, text_col).alias("_t"))
    return rows_in.mapInArrow(run, "_id long, _h long, _set binary, _size long, _bands array<long>")


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """pairs (a, b) with their Jaccard similarity; pairs whose sizes alone rule them out get none above the threshold."""
    one = pairs.join(sets.select(F.col("_set").alias("b"), F.col("_grams").alias("_gb")), "b")
    both = one.join(sets.select(F.col("_set").alias("a"), F.col("_grams").alias("_ga")), "a")
    shared = F.size(F.array_intersect("_ga", "_gb"))
    return both.select("a", "b", (shared / (F.size("_ga") + F.size("_gb") - shared)).alias("sim"))


def _gram_sets(docs: DataFrame, chosen: DataFrame, n: int, text_col: str, id_col: str) -> DataFrame:
    """(_set, _grams) of the chosen rows (_cid, _ch)."""

    def run(batches):
        numbers = WordNumbers()
        for batch in batches:
            sets = [ngram_set(t, n, numbers) for t in texts_of(batch.column(0))]
            keys = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))], ["_set", "_grams"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(_text(docs, text_col)).alias("_h"), _text(docs, text_col).alias("_t"))
    rows = rows.join(chosen, (rows["_id"] == F.col("_cid")) & (rows["_h"] == F.col("_ch")), "left_semi").select("_t")
    return rows.mapInArrow(run, "_set binary, _grams array<long>").dropDuplicates(["_set"])


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in links (a, b): the smallest node that it is connected to.

    Every node moves to its smallest neighbour, with two jumps along such moves; links then join
    where their ends moved to, and vanish where both moved to one place, until none is left.
    """
    edges = written(links.select(F.col("a").alias("x"), F.col("b").alias("y")).where("x <> y").distinct())
    labels = None
    while True:
        moves = edges.union(edges.select("y", "x")).toDF("node", "to").groupBy("node").agg(F.min("to").alias("to"))
        moves = moves.select("node", F.least("node", "to").alias("to"))
        for _ in range(2):
            moves = written(moves)
            further = moves.select(F.col("node").alias("to"), F.col("to").alias("far"))
            moves = moves.join(further, "to").select("node", F.col("far").alias("to"))
        moves = written(moves)
        if labels is None:
            labels = moves.withColumnRenamed("to", "label")
        else:
            next_ = moves.withColumnsRenamed({"node": "label", "to": "_to"})
            labels = written(labels.join(next_, "label", "left").select("node", F.coalesce("_to", "label").alias("label")))
        left, right = (moves.withColumnsRenamed({"node": c, "to": f"_{c}"}) for c in "xy")
        edges = edges.join(left, "x").join(right, "y").where("_x <> _y").select(F.least("_x", "_y").alias("x"), F.greatest("_x", "_y").alias("y")).distinct()
        edges = written(edges)
        if edges.isEmpty():
            return labels


def _labelled(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """rows (..., _set) with _comp: the class that links put the set into so far, else the set itself."""
    if links is None:
        return rows.withColumn("_comp", F.col("_set")).withColumn("_joined", F.lit(False))
    label = written(components(links)).select(F.col("node").alias("_node"), "label")
    out = rows.join(label, rows["_set"] == label["_node"], "left")
    return out.withColumn("_comp", F.coalesce("label", "_set")).withColumn("_joined", F.col("label").isNotNull()).drop("_node", "label")


def _landmark_pairs(buckets: DataFrame, turn: int) -> DataFrame:
    """(a, b, s, t): in every bucket of more than SMALL sets and more than one class, its landmark with the sets of other classes."""
    order = F.struct(F.xxhash64("_set", F.lit(turn)).alias("o"), F.col("_set").alias("l"), F.col("_size").alias("ls"), F.col("_comp").alias("lc"))
    lead = buckets.groupBy("k").agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_lead"), F.min("_comp").alias("_c0"), F.max("_comp").alias("_c1"))
    lead = written(lead.where((F.col("_n") > SMALL) & (F.col("_c0") != F.col("_c1"))).select("k", "_lead.l", "_lead.ls", "_lead.lc"))
    met = buckets.join(lead, "k").where(F.col("_comp") != F.col("lc"))
    first = F.col("l") < F.col("_set")
    ends = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("l", "_set"), ("_set", "l"), ("ls", "_size"), ("_size", "ls"))]
    return met.select(*[e.alias(c) for e, c in zip(ends, "abst", strict=True)])


LINK = "a binary, b binary, sim double"


def _forest(left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between classes of a left and a right block, found on full n-gram sets: enough to connect what is connected, no more."""
    out = []
    if len(left) and len(right):
        sim = _similarity(left["_grams"].tolist(), right["_grams"].tolist())
        classes = pd.factorize(pd.concat([left["_comp"], right["_comp"]]))[0]
        x, y = classes[: len(left)], classes[len(left) :]
        i, j = np.nonzero((sim >= threshold) & (x[:, None] != y))
        first = np.unique(x[i] * len(classes) + y[j], return_index=True)[1]
        root = list(range(len(classes)))

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for at in first:
            a, b = find(x[i[at]]), find(y[j[at]])
            if a != b:
                root[a] = b
                out.append((*sorted((left["_set"].iloc[i[at]], right["_set"].iloc[j[at]])), float(sim[i[at], j[at]])))
    return pd.DataFrame(out, columns=["a", "b", "sim"])


def _blocks(n, size):
    """How many blocks n sets of so many n-grams in all make."""
    return F.ceil(F.greatest(n / TILE, size * 8 / BLOCK_BYTES)).cast("int")


def _dealt(n, seed: int):
    return F.pmod(F.xxhash64("_set", F.lit(seed)), n.cast("long")).cast("int")


def _tiled(left: DataFrame, right: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, sim) between rows (_unit, _set, _size, _comp) of left and right that have one unit, in tiles of two blocks."""
    count = [F.count(F.lit(1)).alias("n"), F.sum("_size").alias("m")]
    info = left.groupBy("_unit").agg(*count).select("_unit", _blocks(F.col("n"), F.col("m")).alias("_lb"))
    info = written(info.join(right.groupBy("_unit").agg(*count).select("_unit", _blocks(F.col("n"), F.col("m")).alias("_rb")), "_unit"))
    grams = sets.select("_set", "_grams")
    cols = ("_unit", "_set", "_comp", "_grams", "i", "j")
    one = left.join(info, "_unit").join(grams, "_set").withColumn("i", _dealt(F.col("_lb"), 1)).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("_rb") - 1)))
    two = right.join(info, "_unit").join(grams, "_set").withColumn("j", _dealt(F.col("_rb"), 2)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("_lb") - 1)))
    two = two.select(*[F.col(c).alias(f"_r{c}" if c in ("_unit", "i", "j") else c) for c in cols])
    return one.select(*cols).groupBy("_unit", "i", "j").cogroup(two.groupBy("_r_unit", "_ri", "_rj")).applyInPandas(lambda a, b: _forest(a, b, threshold), LINK)


def _left_apart(large: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, sim) of sets that share a large bucket and that landmarks have left in different classes.

    The sets outside a bucket's largest class meet that whole class, which comes once, whatever
    number of buckets it fills; and they meet each other within each bucket.
    """
    sizes = large.groupBy("k", "_comp").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("k").agg(F.max_by("_comp", F.struct("n", "_comp")).alias("_main"), F.count(F.lit(1)).alias("_classes")).where("_classes > 1").select("k", "_main")
    apart = written(large.join(main, "k").where("_comp <> _main").select("k", "_main", "_set", "_size", "_comp"))
    ends = large.groupBy(F.col("_comp").alias("_main")).agg(F.min("_size").alias("_least"), F.max("_size").alias("_most"))
    near = apart.join(ends, "_main").where((F.col("_size") >= threshold * F.col("_least")) & (F.col("_size") * threshold <= F.col("_most")))
    near = written(near.select(F.col("_main").alias("_unit"), "_set", "_size", "_comp").distinct())
    whole = large.select("_set", "_size", "_comp").distinct().withColumn("_unit", F.col("_comp"))
    whole = written(whole.join(near.select("_unit").distinct(), "_unit", "left_semi"))
    rest = apart.select(F.col("k").alias("_unit"), "_set", "_size", "_comp")
    return _tiled(near, whole, sets, threshold).union(_tiled(rest, rest, sets, threshold))


def _similarity(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of each left with each right set, by exact counts of what they share."""
    n, m = (np.array([len(x) for x in side]) for side in (left, right))
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    places = []
    for side, sizes in ((left, n), (right, m)):
        grams, row = np.concatenate(side), np.repeat(np.arange(len(side)), sizes)
        at = np.minimum(np.searchsorted(shared, grams), max(len(shared) - 1, 0))
        found = np.flatnonzero(shared[at] == grams) if len(shared) else np.zeros(0, np.int64)
        found = found[np.argsort(at[found], kind="stable")]
        places.append((at[found], row[found]))
    same = np.zeros((len(left), len(right)))
    for lo in range(0, len(shared), 2048):
        parts = []
        for (at, row), side in zip(places, (left, right), strict=True):
            i, j = np.searchsorted(at, [lo, lo + 2048])
            part = np.zeros((len(side), min(2048, len(shared) - lo)), np.float32)
            part[row[i:j], at[i:j] - lo] = 1
            parts.append(part)
        same += parts[0] @ parts[1].T
    return same / (n[:, None] + m - same)


def _count(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(_set, n) of whole classes, or of one tile of a class: texts of other sets that each set is linked to."""
    out = []
    for _, one in pdf.groupby("_class"):
        i, j = one["i"].iloc[0], one["j"].iloc[0]
        parts = [one[one["_block"] == x] for x in ((i,) if i == j else (i, j))]
        if any(p.empty for p in parts):
            continue
        left, right = parts[0], parts[-1]
        close = _similarity(left["_grams"].tolist(), right["_grams"].tolist()) >= threshold
        if i == j:
            np.fill_diagonal(close, False)
        else:
            out.append((right["_set"], close.T @ left["_texts"].to_numpy()))
        out.append((left["_set"], close @ right["_texts"].to_numpy()))
    return pd.DataFrame({"_set": [x for s, _ in out for x in s], "n": np.concatenate([np.zeros(0, np.int64), *[n for _, n in out]])})


def link_counts(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(_set, n) of members (_set, _class, _size, _texts): how many texts of other sets of its class each set is linked to.

    All pairs of a class meet, in tiles of two blocks where the class has more than one; a task
    holds a tile, or some small classes, and counts leave it, not pairs.
    """
    sizes = members.groupBy("_class").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_all")).where("_n > 1")
    blocks = F.ceil(F.greatest(F.col("_n") / MEMBERS, F.col("_all") * 8 / BLOCK_BYTES)).cast("int")
    sizes = written(sizes.select("_class", "_all", blocks.alias("_blocks")))
    total = sizes.where("_blocks = 1").agg(F.sum("_all")).first()[0] or 0
    slots = max(members.sparkSession.sparkContext.defaultParallelism, -(-total * 8 // BLOCK_BYTES))
    rows = members.join(sizes, "_class").withColumn("_block", F.pmod(F.xxhash64("_set", F.lit(3)), F.col("_blocks").cast("long")).cast("int"))
    rows = rows.join(sets, "_set").withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    unit = F.when(F.col("_blocks") > 1, F.col("_class")).otherwise(F.pmod(F.xxhash64("_class"), F.lit(slots)).cast("string").cast("binary"))
    rows = rows.select(
        unit.alias("_unit"), F.least("_block", "_q").alias("i"), F.greatest("_block", "_q").alias("j"), "_class", "_block", "_set", "_texts", "_grams"
    )
    found = rows.groupBy("_unit", "i", "j").applyInPandas(lambda p: _count(p, threshold), "_set binary, n long")
    return found.groupBy("_set").agg(F.sum("n").alias("n"))


def _all_pairs(rows: DataFrame) -> DataFrame:
    """(a, b, s, t) of the rows of a bucket whose classes differ or come from no landmark yet."""
    left = rows.select("k", F.col("_set").alias("a"), F.col("_size").alias("s"), F.col("_comp").alias("_ca"), F.col("_joined").alias("_ja"))
    right = rows.select("k", F.col("_set").alias("b"), F.col("_size").alias("t"), F.col("_comp").alias("_cb"))
    return left.join(right, "k").where("a < b AND (_ca <> _cb OR NOT _ja)").select("a", "b", "s", "t")


def similar(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, links, sets): _id, _h, _set, _size of every row, links (a, b, sim) that connect n-gram sets, sets with their n-grams.

    Buckets of more than SMALL sets go first: in the first band, then in all bands, each set meets
    its bucket's landmark unless links connect the two already, so that a large group of near
    copies is met a few times for each member, not once for each pair. Sets that landmarks leave
    apart meet the sets of their buckets in tiles, out of which come no more links than connect
    classes. Then every pair in the small buckets is verified, but for pairs that landmarks have
    connected already. Every pair that shares a bucket is so compared or connected by links, at
    whatever bucket size; link_counts() counts all links.
    """
    bands, rows = choose_bands(threshold, recall)
    sketch = written(sketches(docs, n, bands, rows, id_col, text_col))
    one = sketch.where("_size > 0").groupBy("_set").agg(F.min(F.struct("_id", "_h")).alias("_one"))
    one = one.select(F.col("_set").alias("_cset"), F.col("_one._id").alias("_cid"), F.col("_one._h").alias("_ch"))
    distinct = sketch.join(one, (F.col("_set") == F.col("_cset")) & (F.col("_id") == F.col("_cid")) & (F.col("_h") == F.col("_ch")))
    buckets = distinct.dropDuplicates(["_set"]).select("_set", "_size", F.posexplode("_bands").alias("band", "k"))
    shared = written(buckets.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    buckets = written(buckets.join(shared, "k"))
    wanted = one.join(buckets.select(F.col("_set").alias("_cset")).distinct(), "_cset", "left_semi")
    # as many rows as there are copies in the corpus: never broadcast
    sets = written(_gram_sets(docs, wanted.select("_cid", "_ch").hint("merge"), n, text_col, id_col))
    links = None

    def add(pairs: DataFrame) -> DataFrame:
        fit = pairs.where(F.least("s", "t") >= threshold * F.greatest("s", "t")).select("a", "b").distinct()
        found = written(_verify(fit, sets, threshold).where(F.col("sim") >= threshold))
        return found if links is None else written(links.union(found).dropDuplicates(["a", "b"]))

    large = written(buckets.where(F.col("_n") > SMALL).select("k", "band", "_set", "_size"))
    if not large.isEmpty():
        for turn, part in enumerate((large.where("band = 0"), large)):
            links = add(_landmark_pairs(_labelled(part, links), turn))
        found = written(_left_apart(written(_labelled(large, links)), sets, threshold))
        links = written(links.union(found).dropDuplicates(["a", "b"]))
    few = _labelled(buckets.where(F.col("_n") <= SMALL).select("k", "_set", "_size"), links)
    links = add(_all_pairs(few))
    return sketch.select("_id", "_h", "_set", "_size"), links, sets


def _members(docs: DataFrame, threshold: float, n: int, recall: float, id_col: str, text_col: str, count_links: bool) -> DataFrame:
    """(_id, _h, class_id, _first, class_size, n_links) of the rows with an id; _first is the hash of the text of the class's first row.

    Without count_links, n_links is 0.
    """
    rows, links, sets = similar(docs.where(F.col(id_col).isNotNull()), threshold, n, recall, id_col, text_col)
    label = components(links).select(F.col("node").alias("_node"), "label")
    if count_links:
        texts = rows.where("_size > 0").groupBy("_set").agg(F.first("_size").alias("_size"), F.countDistinct("_h").alias("_texts"))
        texts = written(texts.join(label, texts["_set"] == label["_node"], "left").drop("_node"))
        counts = written(link_counts(texts.where("label IS NOT NULL").withColumnRenamed("label", "_class"), sets, threshold))
        total = (F.coalesce("n", F.lit(0)) + F.col("_texts") - 1).alias("n_links")
        # only sets with a link or a second text
        info = texts.join(counts, "_set", "left").select(F.col("_set").alias("_node"), "label", total).where("label IS NOT NULL OR n_links > 0")
    else:
        info = label.withColumn("n_links", F.lit(0))
    named = rows.join(written(info), rows["_set"] == F.col("_node"), "left")
    alone = F.col("_size") == 0
    key = F.when(alone, F.concat(F.lit("-"), F.col("_id").cast("string")).cast("binary")).otherwise(F.coalesce("label", "_set"))
    named = named.select("_id", "_h", key.alias("_key"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    classes = named.groupBy("_key").agg(F.min(F.struct("_id", "_h")).alias("_one"), F.count(F.lit(1)).alias("class_size"))
    classes = written(classes.select("_key", F.col("_one._id").alias("class_id"), F.col("_one._h").alias("_first"), "class_size"))
    return named.join(classes, "_key").drop("_key")


def near_classes(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, _h, class_id, n_links, class_size): one row per row of docs.

    class_id is the smallest id among all documents connected by links (or with the same n-gram set);
    n_links counts the different texts that reach the threshold with it, those of the same n-gram
    set too; rows of one text count once. Texts without words are alone: class_id is their id, no links. Rows with a null id are returned with null class_id and join
    nothing. Rows that repeat share a class. Other columns of docs are not read.
    """
    out = _members(docs, threshold, n, recall, id_col, text_col, True).select(F.col("_id").alias(id_col), "_h", "class_id", "n_links", "class_size")
    nameless = docs.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias(id_col), F.xxhash64(_text(docs, text_col)).alias("_h"), F.lit(None).cast("long").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"),
    )
    return out.union(nameless)


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each class, of the smallest id; all columns stay, and all rows with a null id.

    Classes are those of near_classes(); links are not counted. Of several texts of the smallest id
    that of the smallest hash stays, and of rows that repeat both any one.
    """
    rows = _members(docs, threshold, n, recall, id_col, text_col, False).where("class_size > 1")
    kept = (F.col("_id") == F.col("class_id")) & (F.col("_h") == F.col("_first"))
    return one_of_each(docs, rows.select(F.col("_id").alias("_gid"), F.col("_h").alias("_gh"), kept.alias("kept")), id_col, text_col)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_classes(docs).select("doc_id", "class_id", "n_links", "class_size")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + least(len(w), 5) - 1), ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y USING (gram) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE c / (na.n + nb.n - c) >= 0.8),
reach(node, label) AS (SELECT doc_id, doc_id FROM d UNION SELECT link.b, label FROM reach JOIN link ON link.a = node),
class AS (SELECT node AS doc_id, min(label) AS class_id FROM reach GROUP BY 1),
others AS (SELECT a AS doc_id, count(DISTINCT y.t) FILTER (WHERE y.t <> x.t) AS n_links FROM link JOIN d x ON x.doc_id = a JOIN d y ON y.doc_id = b GROUP BY 1)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, count(*) OVER (PARTITION BY class_id) AS class_size FROM class LEFT JOIN others USING (doc_id)
"""
