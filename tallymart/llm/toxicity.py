"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and texts taken whatever their label (U) train a linear numpy
classifier. The risk of U's being negative is corrected by the class prior, and where the
corrected part turns negative, a sign of overfitting, its gradient is followed backwards.

Features are words and their beginnings of 4, 5 and 6 bytes, hashed to 32 bits, present or
not. Those that P holds more surely than U (by the z-score of the two shares) are kept.
The prior is the share of toxic rows among the labels that may be learned from. The last
step shifts scores so that their mean over U is the prior.

The fit uses at most ``POSITIVES`` and ``UNLABELLED`` texts, the first by a hash of doc_id,
one text a doc_id (of several the first by hash); scores use whole texts only. Rows of a held-out fold are used neither way, nor are rows
without doc_id. A document with several labels is toxic if one says so. Without a confirmed
toxic text every score is 0. Null texts are empty, empty texts get the score of no feature.
Repeated rows are scored alike. Other columns of ``docs`` are kept unread; one named
``toxicity`` is replaced by the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.llm import _text

POSITIVES, UNLABELLED = 2000, 4000
PREFIXES = (4, 5, 6)
FEATURES = 2048
THRESHOLD = 0.3


def held_out(folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold, F.lit(True))


def first_by_hash(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """The ``n`` rows that come first by a hash of doc_id.

    Hashes above twice the share that is wanted are left out before rows are sorted, so each
    task hands on its share and not ``n`` rows.
    """
    total = rows.count()
    key = F.xxhash64("doc_id", F.lit(seed))
    if total > 2 * n:
        rows = rows.filter(key < int(-(2**63) + 2**64 * 2 * n / total))
    return rows.orderBy(key, "doc_id").limit(n)


def one_text(rows: DataFrame, kind: str) -> DataFrame:
    """``(kind, text)`` with one text for each ``kind`` and doc_id, however many share the id."""
    return rows.groupBy(kind, "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select(kind, "text")


def _features(w: _text.Words) -> np.ndarray:
    """32-bit features, one row per kind and one column per word."""
    return (np.stack([w.key, *w.prefixes]) >> np.uint64(32)).astype(np.uint32)


def _of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in _text.steps(batch.column(1)):
            w = _text.words(texts, _text.ALPHANUMERIC, PREFIXES)
            found = _features(w)
            ends = np.cumsum(np.bincount(w.doc, minlength=texts.rows))
            blobs = [np.unique(found[:, a:b]).tobytes() for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
            kinds = batch.column(0).slice(texts.first, texts.rows)
            yield pa.RecordBatch.from_arrays([kinds, pa.array(blobs, pa.binary())], ["positive", "features"])


class Model(NamedTuple):
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: _text.Texts) -> np.ndarray:
        w = _text.words(texts, _text.ALPHANUMERIC, PREFIXES)
        total = np.full(texts.rows, self.bias)
        if len(self.features):
            known = np.zeros(1 << 16, bool)
            known[self.features & 0xFFFF] = True
            seen = []
            for kind in _features(w):
                at = np.flatnonzero(known[kind & 0xFFFF])
                place = np.minimum(np.searchsorted(self.features, kind[at]), len(self.features) - 1)
                real = self.features[place] == kind[at]
                seen.append(w.doc[at[real]] * len(self.features) + place[real])
            seen = np.unique(np.concatenate(seen))
            doc, place = np.divmod(seen, len(self.features))
            total += np.bincount(doc, self.weights[place], minlength=texts.rows)
        return _sigmoid(total)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _select(p: list[np.ndarray], u: list[np.ndarray]) -> np.ndarray:
    """Features that P holds more often than U, the surest ones, sorted."""
    keys, n_p = np.unique(np.concatenate(p), return_counts=True)
    others, n_u = np.unique(np.concatenate(u), return_counts=True) if u else (keys[:0], n_p[:0])
    at = np.searchsorted(others, keys)
    match = at < len(others)
    match[match] = others[at[match]] == keys[match]
    in_u = np.zeros(len(keys))
    in_u[match] = n_u[at[match]]
    a, b = n_p / len(p), in_u / max(len(u), 1)
    both = (n_p + in_u + 1) / (len(p) + len(u) + 2)
    z = (a - b) / np.sqrt(both * (1 - both) * (1 / len(p) + 1 / max(len(u), 1)))
    good = np.flatnonzero((z > 3) & (n_p >= 3))
    return np.sort(keys[good[np.argsort(-z[good], kind="stable")[:FEATURES]]])


class _Rows(NamedTuple):
    """Sparse rows of present features."""

    row: np.ndarray
    column: np.ndarray
    n: int

    @classmethod
    def of(cls, texts: list[np.ndarray], features: np.ndarray) -> _Rows:
        row, column = [], []
        for i, x in enumerate(texts):
            at = np.minimum(np.searchsorted(features, x), len(features) - 1)
            at = at[features[at] == x]
            column.append(at)
            row.append(np.full(len(at), i))
        return cls(np.concatenate(row), np.concatenate(column), len(texts))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], minlength=self.n)

    def gradient(self, d: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.column, d[self.row], minlength=size) / self.n


def train(p: list[np.ndarray], u: list[np.ndarray], prior: float, rounds: int = 250, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Adam on the non-negative risk ``prior*R_P(+) + max(0, R_U(-) - prior*R_P(-))`` of the logistic loss."""
    features = _select(p, u)
    size = len(features)
    if not size:
        return Model(features, np.zeros(0), float(np.log(prior / (1 - prior))))
    rows_p, rows_u = _Rows.of(p, features), _Rows.of(u, features)
    w, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    moment, spread = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        z_p, z_u = rows_p.times(w) + bias, rows_u.times(w) + bias
        s_p, s_u = _sigmoid(z_p), _sigmoid(z_u)
        # Derivatives of the losses by the margin: s - 1 for the label +, s for the label -.
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        corrected = np.r_[rows_u.gradient(s_u, size) - prior * rows_p.gradient(s_p, size), s_u.mean() - prior * s_p.mean()]
        positive = prior * np.r_[rows_p.gradient(s_p - 1, size), (s_p - 1).mean()]
        g = positive + corrected if negative >= 0 else -corrected
        g[:-1] += decay * w
        moment, spread = 0.9 * moment + 0.1 * g, 0.999 * spread + 0.001 * g * g
        move = rate * moment / (1 - 0.9**t) / (np.sqrt(spread / (1 - 0.999**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    margins = rows_u.times(w)
    low, high = -40.0, 40.0
    for _ in range(60):
        bias = (low + high) / 2
        low, high = (low, bias) if _sigmoid(margins + bias).mean() > prior else (bias, high)
    return Model(features, w, bias)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> Model | None:
    """Learn from the rows of ``labels(doc_id, toxic)`` and ``docs`` outside the held-out fold."""
    known = labels.filter(~held_out(folds, fold)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic IS NOT NULL")
    n, prior = known.agg(F.count(F.lit(1)), F.avg(F.col("toxic").cast("double"))).first()
    if not n or not prior:
        return None
    prior = min(prior, 0.95)
    sample = first_by_hash(known.filter("toxic = 1"), POSITIVES, 11).select("doc_id", F.lit(True).alias("positive"))
    rest = first_by_hash(docs.select("doc_id").filter(~held_out(folds, fold)).distinct(), UNLABELLED, 11)
    sample = sample.union(rest.select("doc_id", F.lit(False)))
    rows = one_text(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "positive")
    rows = rows.mapInArrow(_of_texts, "positive boolean, features binary").collect()
    rows.sort(key=lambda r: r.features)  # whatever order the rows came in
    p, u = ([np.frombuffer(r.features, np.uint32) for r in rows if r.positive == side] for side in (True, False))
    return train(p, u, prior) if p else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` and ``toxicity``, from 0 to 1, of its ``text``."""
    kept = docs.drop("toxicity")
    at, names = kept.columns.index("text"), kept.columns
    kept = kept.toDF(*(f"c{i}" for i in range(len(names))))  # mapInArrow can't name columns with dots
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(at)
            scores = [np.zeros(t.rows) if model is None else model.scores(t) for t in _text.steps(column)]
            scores = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "toxicity"])

    fields = StructType(list(kept.schema)).add("toxicity", "double")
    return kept.mapInArrow(run, fields).toDF(*names, "toxicity")
