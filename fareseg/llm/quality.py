"""Quality: regularised quadratic discriminant over transformed document statistics.

Each whole text becomes ``DIM`` numbers (lengths, character-class shares,
repetition of words and lines), squashed by logs and logits so that ordinary
documents are near normal. Class means and covariances come from count, sum and
outer-product partials of every labelled row that isn't held out (one bounded
row per task); the covariance is shrunk towards the pooled one and towards its
own mean variance. The score is the posterior from the two Mahalanobis
log-densities, using Cholesky factors computed once.

Null and empty texts have all-zero statistics and are scored like any other.
Rows with a null label or key don't train. When a class has no row, every score
is the share of label 1 (0.5 without any labelled row).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.common import by_batch, held_out, slices, written
from fareseg.llm.words import LOWER, NOT_SPACE, Hasher, combine

STATS = ["log_words", "word_len", "word_len_sd", "upper", "digit", "symbol", "pipe", "bang", "stop_mark", "space",
         "multi_byte", "log_lines", "word_repeat", "pair_repeat", "line_repeat", "adjacent_same", "marked_words"]
DIM = len(STATS)

_UPPER, _DIGIT, _SYMBOL, _MULTI = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[]^_`{}~|\\!"]] = True
_MULTI[128:] = True


def _repeats(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Per text, how many of its hashes are not the first of their kind."""
    if not len(doc):
        return np.zeros(n)
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    again = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    return np.bincount(d[1:][again], minlength=n).astype(float)


def statistics(hasher: Hasher, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts, DIM) for one slice; shares carry a prior of ten units, so short texts stay near the middle."""
    n = len(offs) - 1
    size = np.diff(offs).astype(float)

    def total(mask: np.ndarray) -> np.ndarray:
        c = np.zeros(len(data) + 1)
        np.cumsum(mask, out=c[1:])
        return c[offs[1:]] - c[offs[:-1]]

    def share(part: np.ndarray, whole: np.ndarray, prior: float) -> np.ndarray:
        p = (part + 10 * prior) / (whole + 10)
        return np.log(p / (1 - p)) - np.log(prior / (1 - prior))

    low = LOWER[data]
    s, e, doc = hasher.spans(low, offs, NOT_SPACE)
    h = hasher.hashes(low, s, e)
    words = np.bincount(doc, minlength=n).astype(float)
    lens = (e - s).astype(float)
    mean = np.bincount(doc, lens, n) / np.maximum(words, 1)
    var = np.bincount(doc, lens * lens, n) / np.maximum(words, 1) - mean ** 2
    same = doc[1:] == doc[:-1]
    pair = combine(h[:-1][same], h[1:][same])
    adjacent = np.bincount(doc[1:][same & (h[1:] == h[:-1])], minlength=n).astype(float)
    marked = np.bincount(doc[_SYMBOL[data[e - 1]]], minlength=n).astype(float) if len(e) else np.zeros(n)
    line = np.ones(256, bool)
    line[10] = False
    ls, le, ldoc = hasher.spans(low, offs, line)
    lh = hasher.hashes(low, ls, le)
    lines = np.bincount(ldoc, minlength=n).astype(float)
    return np.stack([
        np.log1p(words), np.log1p(mean), np.log1p(np.sqrt(np.maximum(var, 0))),
        share(total(_UPPER[data]), size, 0.03), share(total(_DIGIT[data]), size, 0.005),
        share(total(_SYMBOL[data]), size, 0.005), share(total(data == 124), size, 0.002),
        share(total(data == 33), size, 0.002), share(total((data == 46) | (data == 44)), size, 0.03),
        share(total(~NOT_SPACE[data]), size, 0.16), share(total(_MULTI[data]), size, 0.05),
        np.log1p(lines), share(_repeats(doc, h, n), words, 0.3),
        share(_repeats(doc[1:][same], pair, n), words, 0.02), share(_repeats(ldoc, lh, n), lines, 0.05),
        share(adjacent, words, 0.01), share(marked, words, 0.01)], axis=1)


def document_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "stats") -> DataFrame:
    """``keep`` columns (default all) and ``out`` array<double>, one row per row."""
    keep = docs.columns if keep is None else keep

    def kernel(b):
        hasher, x = Hasher(), np.zeros((b.num_rows, DIM))
        for lo, hi, data, offs in slices(b.column(text)):
            x[lo:hi] = statistics(hasher, data, offs)
        stats = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, DIM, dtype=np.int32)), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [stats], [*keep, out])

    schema = docs.select(*keep, F.array(F.lit(0.0)).alias(out)).schema
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(by_batch(kernel), schema)


@dataclass(frozen=True)
class Quadratic:
    """Per class: mean, inverse Cholesky factor, log prior minus half the log determinant."""

    mean: np.ndarray
    whiten: np.ndarray
    const: np.ndarray
    share: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(self.mean):
            return np.full(len(x), self.share)
        d = [c - 0.5 * np.sum(((x - m) @ w.T) ** 2, axis=1) for m, w, c in zip(self.mean, self.whiten, self.const)]
        return 1.0 / (1.0 + np.exp(-np.clip(d[1] - d[0], -35, 35)))


def fit(stats: DataFrame, labels: DataFrame, shrink: float = 0.15, ridge: float = 0.02) -> Quadratic:
    """The discriminant from ``stats (doc_id, stats)`` and ``labels (doc_id, quality)``, all rows that aren't held out."""
    y = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("_y"))
    rows = stats.select("doc_id", "stats").join(y, "doc_id").select("_y", "stats")

    def partials(batches):
        sums = {0: np.zeros(1 + DIM + DIM * DIM), 1: np.zeros(1 + DIM + DIM * DIM)}
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy().reshape(-1, DIM)
                labels_ = b.column(0).to_numpy()
                for c, t in sums.items():
                    z = x[labels_ == c]
                    t += np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([list(sums[0]), list(sums[1])])], ["c", "m"])

    parts = rows.mapInArrow(partials, "c int, m array<double>").select("c", F.posexplode("m").alias("i", "v"))
    total = {0: np.zeros(1 + DIM + DIM * DIM), 1: np.zeros(1 + DIM + DIM * DIM)}
    for r in parts.groupBy("c", "i").agg(F.sum("v").alias("v")).collect():
        total[r["c"]][r["i"]] = r["v"]
    n = np.array([total[0][0], total[1][0]])
    if n.min() < 1:
        return Quadratic(np.zeros((0, DIM)), np.zeros((0, DIM, DIM)), np.zeros(0), float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = np.stack([total[c][1:DIM + 1] / n[c] for c in (0, 1)])
    cov = [total[c][DIM + 1:].reshape(DIM, DIM) / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    whiten, const = [], []
    for c in (0, 1):
        s = (1 - shrink) * cov[c] + shrink * pooled
        s = (1 - ridge) * s + ridge * max(np.trace(s) / DIM, 1e-6) * np.eye(DIM)
        chol = np.linalg.cholesky(s)
        whiten.append(np.linalg.inv(chol))
        const.append(np.log(n[c] / n.sum()) - np.log(np.diag(chol)).sum())
    return Quadratic(mean, np.stack(whiten), np.array(const), float(n[1] / n.sum()))


def score(stats: DataFrame, q: Quadratic, keep: list[str], column: str = "stats") -> DataFrame:
    """``keep`` columns and ``score``."""
    def kernel(b):
        p = q.probability(b.column(column).flatten().to_numpy().reshape(-1, DIM))
        return pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(p)], [*keep, "score"])

    shape = stats.select(*keep, F.lit(0.0).alias("score"))
    return stats.select(*dict.fromkeys([*keep, column])).mapInArrow(by_batch(kernel), shape.schema)


def accepted(docs: DataFrame, q: Quadratic, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` scored at least ``threshold``, all columns; one Python step from text to decision."""
    def kernel(b):
        hasher, p = Hasher(), np.zeros(b.num_rows)
        for lo, hi, data, offs in slices(b.column(text)):
            p[lo:hi] = q.probability(statistics(hasher, data, offs))
        return b.filter(pa.array(p >= threshold))

    return docs.mapInArrow(by_batch(kernel), docs.schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; one pass over the texts."""
    stats = written(document_statistics(docs.select("doc_id", "text"), keep=["doc_id"]), "stats")
    return score(stats, fit(stats, labels), ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


