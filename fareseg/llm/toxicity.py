"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashed words, neighbouring pairs and pairs
with one word between (lower-cased ASCII, runs of letters and digits; whole
text). Training visits a bounded, hash-chosen sample of labelled rows in a
fixed order with per-coordinate rates; L1 leaves few non-zero weights, at most
``2**bits``, which travel with the scoring tasks.

Null and empty texts have no feature and get the intercept's score. Rows with a
null label or key don't train. Without any labelled row every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.common import by_batch, held_out, slices
from fareseg.llm.words import ALNUM, LOWER, Hasher, combine

BITS = 20
#: Most labelled rows that the fit reads (the first by hash of doc_id).
MAX_TRAIN = 12000


@dataclass(frozen=True)
class Weights:
    """Sparse weights: ``index`` ascending, ``value`` non-zero, and the intercept."""

    index: np.ndarray
    value: np.ndarray
    bias: float
    bits: int


def gram_indices(hasher: Hasher, data: np.ndarray, offs: np.ndarray, bits: int):
    """``(doc, index)`` of every word, pair and skip pair, repeats included."""
    data = LOWER[data]
    s, e, doc = hasher.spans(data, offs, ALNUM)
    h = hasher.hashes(data, s, e)
    docs, idx = [doc], [combine(h)]
    for gap in (1, 2):
        same = doc[gap:] == doc[:-gap]
        docs.append(doc[gap:][same])
        idx.append(combine(h[:-gap][same], h[gap:][same], np.full(int(same.sum()), gap, np.uint64)))
    return np.concatenate(docs), (np.concatenate(idx) >> np.uint64(64 - bits)).astype(np.int64)


def _distinct(doc: np.ndarray, idx: np.ndarray, bits: int):
    key = np.unique((doc << bits) | idx)
    return key >> bits, key & ((1 << bits) - 1)


def gram_sets(df: DataFrame, text: str, keep: list[str], bits: int = BITS) -> DataFrame:
    """``keep`` columns and ``grams`` binary: each text's distinct int32 indices."""
    def kernel(b):
        hasher, out = Hasher(), []
        for lo, hi, data, offs in slices(b.column(text)):
            doc, idx = _distinct(*gram_indices(hasher, data, offs, bits), bits)
            cut = np.searchsorted(doc, np.arange(hi - lo + 1))
            out += [idx[cut[i]:cut[i + 1]].astype("<i4").tobytes() for i in range(hi - lo)]
        return pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(out, pa.binary())], keep + ["grams"])

    schema = df.select(*keep, F.lit(b"").alias("grams")).schema
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(by_batch(kernel), schema)


def ftrl(examples: list[np.ndarray], labels: np.ndarray, bits: int = BITS, alpha: float = 2.0, beta: float = 1.0,
         l1: float = 12.0, l2: float = 0.0, epochs: int = 6) -> Weights:
    """FTRL-proximal over binary features, one example at a time; the intercept is not penalised by L1."""
    z, n, zb, nb = np.zeros(1 << bits), np.zeros(1 << bits), 0.0, 0.0
    wb = 0.0
    for _ in range(epochs):
        for x, y in zip(examples, labels, strict=True):
            zi, ni = z[x], n[x]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2))
            wb = -zb / ((beta + np.sqrt(nb)) / alpha)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + wb, -35, 35)))
            g = p - y
            z[x] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
            n[x] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * wb
            nb += g * g
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
    at = np.flatnonzero(w)
    return Weights(at, w[at], float(-zb / ((beta + np.sqrt(nb)) / alpha)), bits)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN, bits: int = BITS) -> Weights:
    """Weights from at most ``max_rows`` labelled rows that are not held out.

    The sample's keys are bounded by ``max_rows`` and are broadcast; the texts'
    index sets (at most 4 * 2**bits bytes each) come back, never the texts.
    """
    pick = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.max("toxic").alias("_y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = gram_sets(docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id"), "text", ["doc_id", "_y"], bits)
    rows = sorted(rows.select(F.xxhash64("doc_id").alias("h"), "_y", "grams").collect(), key=lambda r: (r["h"], r["grams"]))
    return ftrl([np.frombuffer(r["grams"], "<i4") for r in rows], np.array([float(r["_y"]) for r in rows]), bits)


def score(docs: DataFrame, w: Weights, text: str = "text", out: str = "score", threshold: float | None = None,
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) and the score; with ``threshold``, only rows scored below it, without the score."""
    keep = docs.columns if keep is None else keep

    def kernel(b):
        hasher, total = Hasher(), np.full(b.num_rows, w.bias)
        for lo, hi, data, offs in slices(b.column(text)):
            doc, idx = gram_indices(hasher, data, offs, w.bits)
            at = np.minimum(np.searchsorted(w.index, idx), max(len(w.index) - 1, 0))
            hit = w.index[at] == idx if len(w.index) else np.zeros(len(idx), bool)
            doc, idx = _distinct(doc[hit], idx[hit], w.bits)
            total[lo:hi] += np.bincount(doc, w.value[np.searchsorted(w.index, idx)], hi - lo)
        p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
        cols = [b.column(c) for c in keep]
        if threshold is not None:
            return pa.RecordBatch.from_arrays(cols, keep).filter(pa.array(p < threshold))
        return pa.RecordBatch.from_arrays([*cols, pa.array(p)], [*keep, out])

    shape = docs.select(*keep) if threshold is not None else docs.select(*keep, F.lit(0.0).alias(out))
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(by_batch(kernel), shape.schema)


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    w = fit(docs, labels, max_rows)
    return score(docs.select("doc_id", "text"), w, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
