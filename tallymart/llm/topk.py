"""Exact top-k inner products over norm-sorted vectors with SVD-rotated partial sums.

Components are turned into ``floor(64 * x)``; scores are exact integer inner products.
Vectors are kept in descending order of length. The queries, a stated set, are met with all
vectors in blocks of bounded size, each broadcast once:

* the longest vectors of all (``HEAD`` of them) give every query a first threshold, its
  k-th best score among them;
* a task goes through its vectors from the longest on. When a query's length times the
  next vector's can no longer reach its threshold, the query is done (Cauchy-Schwarz);
* for the others, partial sums over the first axes of an SVD rotation plus the product of
  the two residual lengths bound the score; only pairs whose bound reaches the threshold
  are scored. Bounds are widened by the rounding error they may carry.

Every task returns at most k rows per query; a window takes the best. Equal scores go to
the smaller vec_id. The rotation is fitted on at most ``SAMPLE`` vectors and only decides how
much is pruned, never the result.

Vectors that are null or hold a null, NaN or infinite component take no part, neither do
rows without vec_id. Shorter vectors count as padded with zeros. Rows that repeat a vec_id
are candidates each, but never of a query of that id; such queries are answered once. The
sums of a pair's products must stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.session import stage

HEAD, SAMPLE, QUERY_BLOCK, STEP = 1024, 8192, 1024, 2048
FULL = 0.2  # share of open pairs from which scoring all of them at once is cheaper


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, norms, blobs = [], [], []
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if i is None or not x.is_valid or x.values.null_count:
                continue
            v = np.floor(64 * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if np.isfinite(v).all():
                ids.append(i)
                norms.append(float(np.sqrt(v @ v)))
                blobs.append(v.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(norms, pa.float64()), pa.array(blobs, pa.binary())], ["vec_id", "norm", "vector"]
        )


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(blobs), width))
    for row, blob in zip(out, blobs, strict=True):
        row[: len(blob) // 8] = np.frombuffer(blob)
    return out


def _rotation(sample: np.ndarray) -> np.ndarray:
    """All right singular vectors, the largest value first."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1]


class Best:
    """The k best scores of each query so far, by score and then by smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    @property
    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge ``score[i, j]``, of query ``rows[i]`` and vector ``ids[j]``; -inf is none."""
        if score.shape[1] > self.k:
            # What beats the k-th score stays; ties with it fill up from the smallest id.
            order = np.argsort(ids, kind="stable")
            score, ids = score[:, order], ids[order]
            last = np.partition(score, -self.k, axis=1)[:, -self.k, None]
            above, tied = score > last, score == last
            room = self.k - above.sum(axis=1, keepdims=True)
            top = np.nonzero(above | (tied & (np.cumsum(tied, axis=1) <= room)))[1].reshape(-1, self.k)
            score, ids = np.take_along_axis(score, top, axis=1), ids[top]
        else:
            ids = np.broadcast_to(ids, score.shape)
        ids = np.where(np.isfinite(score), ids, np.iinfo(np.int64).max)
        score, ids = np.hstack([self.score[rows], score]), np.hstack([self.id[rows], ids])
        order = np.lexsort((ids, -score), axis=-1)[:, : self.k]
        self.score[rows] = np.take_along_axis(score, order, axis=1)
        self.id[rows] = np.take_along_axis(ids, order, axis=1)


class Queries:
    """A block of queries with their rotated parts and first thresholds."""

    def __init__(self, ids, vectors, rotation, head_ids, head, k: int):
        width = vectors.shape[1]
        self.ids, self.vectors, self.rotation, self.k = ids, vectors, rotation, k
        self.cuts = sorted({max(1, width // 4), max(1, width // 2)}) if width else []
        self.rotated, self.rest, self.norm = self.parts(vectors)
        best = Best(len(ids), k)
        if len(head):
            score = vectors @ head.T
            score[ids[:, None] == head_ids[None, :]] = -np.inf
            best.add(np.arange(len(ids)), score, head_ids)
        self.threshold = best.least

    def parts(self, vectors: np.ndarray):
        """Rotated vectors, the lengths of what follows each cut, and whole lengths."""
        rotated = vectors @ self.rotation
        squares = rotated * rotated
        rest = [np.sqrt(squares[:, c:].sum(axis=1)) for c in self.cuts]
        return rotated, rest, np.sqrt((vectors * vectors).sum(axis=1))

    def search(self, steps: Iterator[tuple[np.ndarray, np.ndarray]]) -> Best:
        best = Best(len(self.ids), self.k)
        for ids, vectors in steps:
            rotated, rest, norm = self.parts(vectors)
            slack = 1e-9 * (1 + self.norm * norm.max(initial=0.0))
            goal = np.maximum(self.threshold, best.least) - slack
            active = np.flatnonzero(self.norm * norm.max(initial=0.0) >= goal)
            if not len(active):
                continue
            goal = goal[active]
            open_ = self.norm[active][:, None] * norm[None, :] >= goal[:, None]
            partial, at = np.zeros(open_.shape), 0
            for cut, own, other in zip(self.cuts, self.rest, rest, strict=True):
                if open_.mean() < FULL:
                    break
                partial += self.rotated[active, at:cut] @ rotated[:, at:cut].T
                at = cut
                open_ &= partial + own[active][:, None] * other[None, :] >= goal[:, None]
            if open_.mean() >= FULL:
                score = self.vectors[active] @ vectors.T
                score[~open_] = -np.inf
            else:
                score = np.full(open_.shape, -np.inf)
                i, j = np.nonzero(open_)
                for part in np.array_split(np.arange(len(i)), max(1, len(i) // 100_000)):
                    a, b = i[part], j[part]
                    score[a, b] = np.einsum("ij,ij->i", self.vectors[active[a]], vectors[b])
            score[self.ids[active][:, None] == ids[None, :]] = -np.inf
            best.add(active, score, ids)
        return best


def top_k(vectors: DataFrame, queries: str, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``vectors(vec_id, embedding)`` that
    satisfy the SQL condition ``queries`` over vec_id, against all rows."""
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    rows = rows.mapInArrow(_quantise, "vec_id long, norm double, vector binary")
    width = F.max(F.octet_length("vector") / 8).cast("int")
    spark = vectors.sparkSession
    # Tasks of about the same number of rows, each from the longest to the shortest.
    data, _ = stage(rows.repartition("vec_id").sortWithinPartitions(F.desc("norm")), "vectors")
    asked, n = stage(data.filter(queries).dropDuplicates(["vec_id"]), "queries")
    schema = "query_id long, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = data.agg(width).first()[0] or 0
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    rotation = _rotation(_matrix([r.vector for r in sample], width))
    longest = data.orderBy(F.desc("norm"), "vec_id").limit(HEAD).select("vec_id", "vector").collect()
    head_ids = np.array([r.vec_id for r in longest], np.int64)
    head = _matrix([r.vector for r in longest], width)

    def block(part: list) -> Queries:
        ids = np.array([r.vec_id for r in part], np.int64)
        return Queries(ids, _matrix([r.vector for r in part], width), rotation, head_ids, head, k)

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = shared.value

            def steps():
                for batch in batches:
                    for i in range(0, batch.num_rows, STEP):
                        part = batch.slice(i, STEP)
                        yield part.column(0).to_numpy(), _matrix(part.column(1).to_pylist(), width)

            best = asked.search(steps())
            q, r = np.nonzero(np.isfinite(best.score) & (best.score >= asked.threshold[:, None]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked.ids[q]), pa.array(best.id[q, r]), pa.array(best.score[q, r].astype(np.int64))],
                ["query_id", "vec_id", "score"],
            )

        return run

    found = None
    blocks = -(-n // QUERY_BLOCK)
    for i in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)) == i).collect()  # about QUERY_BLOCK rows
        if part:
            shared = spark.sparkContext.broadcast(block(part))
            one = data.select("vec_id", "vector").mapInArrow(search(shared), schema)
            found = one if found is None else found.union(one)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
