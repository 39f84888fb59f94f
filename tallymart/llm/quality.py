"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Random indexing: every token (a run of letters and digits, or of marks) has a fixed sparse
random vector of -1, 0 and 1; its word vector is the sum of the random vectors of the tokens
within two places, over the whole corpus. Tokens are hashed into ``BUCKETS``, so each task
adds up one table of fixed size; the tables are added block by block in two rounds, whatever
their number.

A document is pooled to the means of its tokens' word vectors and random vectors, how far
these differ from place to place, the share of distinct tokens and its length. A network of
two layers, written in numpy, is trained on at most ``SAMPLE`` labelled documents, the
first by a hash of doc_id, one text an id; a fifth of them is kept aside to stop the training and to fit the
temperature that calibrates its probabilities.

Rows of the held-out fold and rows without doc_id are not learned from. Conflicting labels
of one document: the lower counts. Without labels of both kinds every score is the share of
good labels, or 0.5. Null texts are empty and pooled to zeros. Repeated rows are scored
alike, very long texts as a whole. Other columns of ``docs`` are kept unread; one named
``quality_score`` is replaced by the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.llm import _text
from tallymart.llm.toxicity import _sigmoid, first_by_hash, held_out, one_text

BUCKETS, WIDTH, NONZERO = 1 << 14, 32, 4
BLOCKS, ROUND = 64, 64
SAMPLE = 8000
HIDDEN = 32
THRESHOLD = 0.3
POOLED = 4 * WIDTH + 3


def _random_vectors() -> np.ndarray:
    rng = np.random.default_rng(99)
    table = np.zeros((BUCKETS, WIDTH), np.float32)
    places = np.argsort(rng.random((BUCKETS, WIDTH)), axis=1)[:, :NONZERO]
    table[np.arange(BUCKETS)[:, None], places] = rng.choice([-1, 1], (BUCKETS, NONZERO))
    return table


def _tokens(texts: _text.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of every token."""
    w = _text.words(texts, _text.TOKENS)
    return w.doc, (w.key >> np.uint64(50)).astype(np.uint16)


def _neighbours(vectors: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Sums of the vectors one and two places before and after, within a document."""
    total = np.zeros_like(vectors)
    for d in (1, 2):
        same = (doc[d:] == doc[:-d])[:, None]
        total[d:] += vectors[:-d] * same
        total[:-d] += vectors[d:] * same
    return total


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    random = _random_vectors()
    sums = np.zeros((BUCKETS, WIDTH), np.int64)
    for batch in batches:
        for texts in _text.steps(batch.column(0)):
            doc, bucket = _tokens(texts)
            if len(doc):
                near = _neighbours(random[bucket], doc)
                order = np.argsort(bucket, kind="stable")
                sorted_ = bucket[order]
                first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
                sums[sorted_[first]] += np.add.reduceat(near[order], first, axis=0).astype(np.int64)
    part = TaskContext.get().partitionId() % ROUND
    # Most cells are small, so their high bytes are zeros and compress away.
    yield _blocks(range(BLOCKS), [part] * BLOCKS, np.split(sums, BLOCKS))


def _blocks(block, part, tables) -> pa.RecordBatch:
    blobs = [np.ascontiguousarray(t.astype(np.int64).reshape(-1).view(np.uint8).reshape(-1, 8).T).tobytes() for t in tables]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(block), pa.int32()), pa.array(list(part), pa.int32()), pa.array(blobs, pa.binary())], ["block", "part", "sums"]
    )


def _table(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, key = None, None
    for batch in batches:
        for block, part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = (block, part)
            total = _table(blob) if total is None else total + _table(blob)
    if total is not None:
        yield _blocks([key[0]], [key[1]], [total])


BLOCK_ROW = "block int, part int, sums binary"


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The corpus's word vectors by bucket, each of length 1 (or 0)."""
    rows = docs.select("text").mapInArrow(_context_sums, BLOCK_ROW)
    rows = rows.groupBy("block", "part").applyInArrow(_add, BLOCK_ROW)
    rows = rows.withColumn("part", F.lit(0)).groupBy("block").applyInArrow(_add, BLOCK_ROW)
    table = np.zeros((BLOCKS, BUCKETS // BLOCKS * WIDTH))
    for row in rows.collect():  # BLOCKS rows
        table[row.block] = _table(bytes(row.sums))
    table = table.reshape(BUCKETS, WIDTH)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(length, 1)).astype(np.float32)


def pooled(texts: _text.Texts, vectors: np.ndarray, random: np.ndarray) -> np.ndarray:
    doc, bucket = _tokens(texts)
    out = np.zeros((texts.rows, POOLED), np.float32)
    counts = np.bincount(doc, minlength=texts.rows)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    first = (np.cumsum(counts) - counts)[some]
    n = counts[some][:, None]
    for i, table in enumerate((vectors, random)):
        own = table[bucket]
        mean = np.add.reduceat(own, first, axis=0) / n
        own *= own
        out[some, 2 * i * WIDTH : (2 * i + 1) * WIDTH] = mean
        spread = np.add.reduceat(own, first, axis=0) / n - mean * mean
        out[some, (2 * i + 1) * WIDTH : (2 * i + 2) * WIDTH] = np.sqrt(np.maximum(spread, 0))
    pairs = np.sort(doc * BUCKETS + bucket)
    distinct = np.bincount(pairs[np.r_[True, pairs[1:] != pairs[:-1]]] // BUCKETS, minlength=texts.rows)
    out[some, -3] = distinct[some] / counts[some]
    out[some, -2] = np.log1p(counts[some])
    out[some, -1] = np.log1p(np.diff(texts.offsets)[some])
    return out


class Model(NamedTuple):
    vectors: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(np.clip((x - self.center) / self.scale, -8, 8) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margins(x) / self.temperature)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float((np.logaddexp(0, z) - y * z).mean())


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 0.003) -> Model:
    """Adam on the log loss; the epoch with the least loss on the rows kept aside wins."""
    rng = np.random.default_rng(5)
    order = rng.permutation(len(y))
    aside, own = order[: len(y) // 5], order[len(y) // 5 :]
    aside = aside if len(set(y[aside])) == 2 else own
    center, scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
    share = np.clip(y[own].mean(), 0.01, 0.99)
    params = [
        rng.normal(0, 1 / np.sqrt(POOLED), (POOLED, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.array(np.log(share / (1 - share))),
    ]
    moments, spreads = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    model = lambda t=1.0: Model(vectors, center, scale, *(p.copy() for p in params[:3]), float(params[3]), t)
    scaled = np.clip((x - center) / scale, -8, 8)
    best, least, t = model(), np.inf, 0
    for _ in range(epochs):
        rng.shuffle(own)
        for rows in np.array_split(own, max(1, len(own) // batch)):
            t += 1
            a = scaled[rows]
            h = np.tanh(a @ params[0] + params[1])
            d = (_sigmoid(h @ params[2] + params[3]) - y[rows]) / len(rows)
            back = d[:, None] * params[2] * (1 - h * h)
            grads = [a.T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ d + 1e-4 * params[2], d.sum()]
            for i, g in enumerate(grads):
                moments[i] = 0.9 * moments[i] + 0.1 * g
                spreads[i] = 0.999 * spreads[i] + 0.001 * g * g
                params[i] = params[i] - rate * moments[i] / (1 - 0.9**t) / (np.sqrt(spreads[i] / (1 - 0.999**t)) + 1e-8)
        now = model()
        loss = _loss(now.margins(x[aside]), y[aside])
        if loss < least:
            best, least = now, loss
    z = best.margins(x[aside])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    return best._replace(temperature=float(grid[np.argmin([_loss(z / g, y[aside]) for g in grid])]))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> tuple[Model | None, float]:
    """The model, or None, and the share of good labels. Word vectors come from all ``docs``."""
    known = labels.filter(~held_out(folds, fold)).groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality IS NOT NULL")
    sample = first_by_hash(known, SAMPLE, 13)
    sample = sample.select("doc_id", F.col("quality").cast("double").alias("quality"))
    texts = one_text(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "quality").select("text", "quality")
    vectors = word_vectors(docs)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = _random_vectors()
        for batch in batches:
            for part in _text.steps(batch.column(0)):
                blobs = [r.tobytes() for r in pooled(part, shared.value, random)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blobs, pa.binary()), batch.column(1).slice(part.first, part.rows)], ["pooled", "quality"]
                )

    rows = texts.mapInArrow(run, "pooled binary, quality double").collect()
    y = np.array([r.quality for r in rows])
    share = float(y.mean()) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return None, share
    x = np.stack([np.frombuffer(r.pooled, np.float32) for r in rows]).astype(np.float64)
    order = np.lexsort(x.T)  # whatever order the rows came in
    return train(x[order], y[order], vectors), share


def score(docs: DataFrame, fitted: tuple[Model | None, float]) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``, from 0 to 1, of its ``text``."""
    kept = docs.drop("quality_score")
    at, names = kept.columns.index("text"), kept.columns
    kept = kept.toDF(*(f"c{i}" for i in range(len(names))))  # mapInArrow can't name columns with dots
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, share = shared.value
        random = _random_vectors()
        for batch in batches:
            column = batch.column(at)
            scores = [
                np.full(t.rows, share) if model is None else model.scores(pooled(t, model.vectors, random)) for t in _text.steps(column)
            ]
            scores = pa.array(np.concatenate(scores).astype(np.float64) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "quality_score"])

    fields = StructType(list(kept.schema)).add("quality_score", "double")
    return kept.mapInArrow(run, fields).toDF(*names, "quality_score")
