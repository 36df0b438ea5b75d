"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own and of its neighbours. A two-state chain labels lines
good or bad; forward-backward gives each line's probability of being good, and the mean of
these weighted by line length is a document's quality. The chain is fitted on a bounded
sample of labelled documents whose lines start with the label of their document; lines of
bad documents that look good are then set right and the chain is fitted again. A logistic
curve maps the weighted mean to the probability of label 1.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_of, texts_of

FIT_DOCS = 3000  # most labelled documents that a fit uses, those of the smallest hash
FIT_LINES = 512  # documents of more lines are not used for a fit
FIT_BYTES = 1 << 16  # nor are longer texts, so that a fit collects at most FIT_DOCS times as much
STEPS = 512  # lines of a chain that are looked at together; longer chains pass their state on
CELLS = 1 << 17  # padded lines of a batch of chains
BLOCK = 8192  # lines whose features are held at once
OWN = 12  # features of a line itself
_ODD_END = re.compile(r"[^\w\s.,;:?!'\")\]]+(?=\s|$)")
_LOUD = re.compile(r"!!|\?\?|\|")
_CLASS = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 space, 5 plain punctuation, 6 other ASCII, 7 beyond
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 7 if _b > 127 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c.isspace() else 5 if _c in ".,;:'\"()-" else 6


def _features(lines: list[str], seen: set[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features, length) of each line; seen: the lines before them, to which these are added."""
    rows = np.zeros((len(lines), OWN))
    weight = np.empty(len(lines))
    for i, line in enumerate(lines):
        raw = line.encode("utf-8", "replace")
        n = len(raw)
        weight[i] = n + 1
        if not n:
            rows[i, 0] = 1
            continue
        counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) / n
        words = line.split()
        k = max(1, len(words))
        bare = line.strip().lower()
        letters = counts[1] + counts[2] + counts[7]
        rows[i] = (
            0,
            min(3.0, np.log1p(n) / 3),
            counts[2] / max(letters, 1e-9),
            counts[3],
            counts[6],
            letters,
            len(set(words)) / k,
            min(3.0, n / k / 8),
            min(1.0, len(_ODD_END.findall(line)) / k),
            min(1.0, len(_LOUD.findall(line)) / k),
            bare in seen,
            bool(words) and words[-1][-1] in ".!?:;",
        )
        seen.add(bare)
    return rows, weight


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line, its length). A text has at least one line, which may be empty."""
    return _features(text.split("\n"), set())


def with_neighbours(rows: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the line before and after, zero outside, and a constant."""
    zero = np.zeros((1, rows.shape[1]))
    return np.hstack([rows, np.vstack([zero, rows[:-1]]), np.vstack([rows[1:], zero]), np.ones((len(rows), 1))])


def forward(unary: np.ndarray, trans: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Forward logs of padded sequences; after a sequence's end its last value stays."""
    alpha = np.zeros(unary.shape)
    alpha[:, 0] = unary[:, 0] + first
    for t in range(1, unary.shape[1]):
        x = alpha[:, t - 1, :, None] + trans
        new = np.logaddexp(x[:, 0], x[:, 1]) + unary[:, t]
        alpha[:, t] = np.where((t < lengths)[:, None], new, alpha[:, t - 1])
    return alpha


def chain(unary: np.ndarray, trans: np.ndarray, first: np.ndarray, lengths: np.ndarray, last: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded sequences: log Z, node marginals, summed edge marginals.

    unary: (sequences, steps, 2); trans: (2, 2) and first: (2,), all logs; lengths: steps of each.
    first may have a row for each sequence, and so may last, the logs of what follows its end.
    """
    n, steps, _ = unary.shape
    alpha, beta = forward(unary, trans, first, lengths), np.zeros((n, steps, 2))
    last = np.broadcast_to(last, (n, 2))
    beta[:, -1] = last
    z = np.logaddexp.reduce(alpha[:, -1] + last, axis=1)
    edges = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        inside = (t + 1 < lengths)[:, None]
        y = trans + (unary[:, t + 1] + beta[:, t + 1])[:, None, :]
        beta[:, t] = np.where(inside, np.logaddexp(y[:, :, 0], y[:, :, 1]), last)
        edges += (np.exp(alpha[:, t, :, None] + y - z[:, None, None]) * inside[:, :, None]).sum(0)
    return z, np.exp(alpha + beta - z[:, None, None]), edges


def _padded(parts: list[np.ndarray]):
    """(indices, unary logs, lengths) of chains of like length, with a bounded number of cells."""
    lengths = np.array([len(p) for p in parts])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        # in ascending order, so that the last of a batch sets its width
        end = at + 1
        while end < len(order) and (end + 1 - at) * lengths[order[end]] <= CELLS:
            end += 1
        pick = order[at:end]
        unary = np.zeros((len(pick), lengths[pick[-1]], 2))
        for k, i in enumerate(pick):
            unary[k, : lengths[i], 1] = parts[i]
        yield pick, unary, lengths[pick]
        at = end


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the good state; the bad state is zero
    trans: np.ndarray
    first: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    prior: float = -1.0  # used alone if it is not negative

    def lines(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(log weight of being good, length) of each line; features are held for BLOCK lines at a time."""
        own, before, after = (self.weights[k * OWN : (k + 1) * OWN] / self.scale[k * OWN : (k + 1) * OWN] for k in range(3))
        shift = self.weights[-1] - (self.mean[:-1] / self.scale[:-1]) @ self.weights[:-1]
        lines, seen, parts = text.split("\n"), set(), []
        for at in range(0, len(lines), BLOCK):
            rows, weight = _features(lines[at : at + BLOCK], seen)
            parts.append((rows @ own, rows @ before, rows @ after, weight))
        u, prev, next_, weight = (np.concatenate(c) for c in zip(*parts, strict=True))
        u += shift
        u[1:] += prev[:-1]
        u[:-1] += next_[1:]
        return u, weight

    def good_lines(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of being good of every line, for each document's log weights.

        Chains of more than STEPS lines are cut; what each part makes of either state before it
        gives, part by part, the forward logs that enter it and the backward logs that follow it.
        """
        parts = [u[at : at + STEPS] for u in lines for at in range(0, len(u), STEPS)]
        doc = np.repeat(np.arange(len(lines)), [-(-len(u) // STEPS) for u in lines])
        enter, leave = np.tile(self.first, (len(parts), 1)), np.zeros((len(parts), 2))
        cut = np.flatnonzero(np.bincount(doc)[doc] > 1) if len(doc) else doc
        moves = np.zeros((len(parts), 2, 2))
        for pick, unary, lengths in _padded([parts[i] for i in cut]):
            for a in (0, 1):
                moves[cut[pick], a] = forward(unary, self.trans, self.trans[a], lengths)[:, -1]
        for i in cut:
            if doc[i - 1] != doc[i] or i == 0:
                state = forward(np.stack([np.zeros(len(parts[i])), parts[i]], 1)[None], self.trans, self.first, np.array([len(parts[i])]))[0, -1]
            else:
                x = state[:, None] + self.trans
                enter[i] = np.logaddexp(x[0], x[1])
                x = state[:, None] + moves[i]
                state = np.logaddexp(x[0], x[1])
        for i in cut[::-1]:
            if i + 1 < len(doc) and doc[i + 1] == doc[i]:
                leave[i] = np.logaddexp.reduce(moves[i + 1] + leave[i + 1], axis=1)
        node: list = [None] * len(parts)
        for pick, unary, lengths in _padded(parts):
            _, p, _ = chain(unary, self.trans, enter[pick], lengths, leave[pick])
            for k, i in enumerate(pick):
                node[i] = p[k, : lengths[k], 1]
        ends = np.searchsorted(doc, np.arange(len(lines) + 1))
        return [np.concatenate(node[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def quality(self, lines: list[np.ndarray], weight: list[np.ndarray]) -> np.ndarray:
        return np.array([float(p @ w / w.sum()) for p, w in zip(self.good_lines(lines), weight, strict=True)])

    def score(self, texts: list[str]) -> np.ndarray:
        if self.prior >= 0:
            return np.full(len(texts), self.prior)
        q = np.clip(self.quality(*map(list, zip(*map(self.lines, texts), strict=True))), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(q / (1 - q)) + self.shift, -30, 30)))


def _fit_chain(x: list[np.ndarray], labels: list[np.ndarray], rounds: int = 90) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest penalised likelihood of the lines' labels, by gradient steps with momentum (Adam)."""
    lengths = np.array([len(r) for r in x])
    steps, width = lengths.max(), x[0].shape[1]
    padded, target = np.zeros((len(x), steps, width), np.float32), np.zeros((len(x), steps))
    inside = np.arange(steps) < lengths[:, None]
    for i, (r, y) in enumerate(zip(x, labels, strict=True)):
        padded[i, : len(r)], target[i, : len(r)] = r, y
    flat = padded.reshape(-1, width)
    seen = np.zeros((2, 2))
    both = inside[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((target[:, :-1] == a) & (target[:, 1:] == b) & both).sum()
    begun = np.array([(target[:, 0] == 0).sum(), (target[:, 0] == 1).sum()])
    theta = np.zeros(width + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = lengths.sum()
    for r in range(1, rounds + 1):
        w, trans, first = theta[:width], theta[width : width + 4].reshape(2, 2), theta[width + 4 :]
        unary = np.zeros((len(x), steps, 2))
        unary[..., 1] = (flat @ w.astype(np.float32)).reshape(len(x), steps) * inside
        _, node, edges = chain(unary, trans, first, lengths)
        miss = ((node[..., 1] - target) * inside).reshape(-1).astype(np.float32)
        grad = np.concatenate([flat.T @ miss, (edges - seen).ravel(), node[:, 0].sum(0) - begun]) / total + 1e-3 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return theta[:width], theta[width : width + 4].reshape(2, 2).copy(), theta[width + 4 :].copy()


def _pieces(rows: list[np.ndarray], labels: list[np.ndarray], most: int = 48):
    """Long documents cut to chains of at most `most` lines, so that padding stays small."""
    for r, y in zip(rows, labels, strict=True):
        for at in range(0, len(r), most):
            yield r[at : at + most], y[at : at + most]


def fit(texts: list[str], labels: list[int]) -> Model:
    """A model from labelled texts; with one class only (or none) it scores every text by the share of label 1."""
    y = np.array(labels)
    if len(y) == 0 or y.min() == y.max():
        return Model(*[np.zeros(0)] * 5, prior=1.0 if len(y) == 0 else float(y.mean()))
    rows, weight = zip(*(line_features(t) for t in texts), strict=True)
    near = [with_neighbours(r) for r in rows]
    stacked = np.vstack(near)
    mean, scale = stacked.mean(0), stacked.std(0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    x = [(r - mean) / scale for r in near]
    lines = [np.full(len(r), float(k)) for r, k in zip(rows, y, strict=True)]
    model = Model(mean, scale, *_fit_chain(*map(list, zip(*_pieces(x, lines), strict=True))))
    for i, p in enumerate(model.good_lines([model.lines(t)[0] for t in texts])):
        if not y[i]:
            lines[i] = (p > max(0.5, p.min())).astype(float)  # at least the worst line is bad
    model = Model(mean, scale, *_fit_chain(*map(list, zip(*_pieces(x, lines), strict=True))))
    q = np.clip(model.quality([model.lines(t)[0] for t in texts], list(weight)), 1e-6, 1 - 1e-6)
    f = np.stack([np.log(q / (1 - q)), np.ones(len(q))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps of a penalised logistic fit
        p = 1 / (1 + np.exp(-np.clip(f @ beta, -30, 30)))
        hess = (f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hess, f.T @ (p - y) + 1e-2 * beta), -2, 2)
    model.slope, model.shift = float(max(beta[0], 1e-3)), float(beta[1])
    return model


def fit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = FIT_DOCS) -> Model:
    """Fit on at most `most` labelled documents, those whose ids have the smallest hashes.

    Null labels and ids are not used; of several labels for one id the larger counts. Documents
    of more than FIT_LINES lines or FIT_BYTES bytes are left out of the fit (they are still scored).
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(most)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    got = docs.select(F.col(id_col).alias("_id"), text.alias("_t")).join(F.broadcast(chosen), "_id")
    got = got.where((F.octet_length("_t") <= FIT_BYTES) & (F.size(F.split("_t", "\n", -1)) <= FIT_LINES))
    found = got.orderBy("_id", "_t").limit(most).collect()
    return fit([r["_t"] for r in found], [int(r["_y"] > 0) for r in found])


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """`docs` with the probability of label 1; null texts count as empty, a column named out_col is replaced."""
    keep = [c for c in docs.columns if c != out_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema), f"{out_col} double"])
    at = keep.index(text_col)

    def run(batches):
        for batch in batches:
            texts, out = texts_of(batch.column(at).cast(pa.string())), []
            for part in groups_of([len(t) for t in texts], 4 << 20):
                out.append(model.score([t.decode("utf-8", "replace") for t in texts[part]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *out]))], [*keep, out_col])

    return docs.select(*keep).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """True for documents whose labels no fit may use."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score(docs, fit_documents(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
