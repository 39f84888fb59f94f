"""Benchmark decontamination by a distributed positional inverted index.

The index is a table of segments: each row covers some whole documents and holds, for every
term in them, the sorted list of its positions. It is written to the shared folder once and
serves any number of benchmarks.

A lookup takes the windows of the test items, in blocks of bounded size that are broadcast
one by one, and meets every segment with them: a window is dropped if one of its terms has
no list; the list of its rarest term gives the candidate places, and the other lists,
adjusted by their offsets and rarest first, are intersected with these. Nothing is shuffled,
since a document lies in one segment.

With ``slop`` > 0 proximity matches are told as well: places where every term of a window
lies within ``slop`` words of its place, the rarest exactly there.

Nulls and texts without words have no words, are never hit and hit nothing. Repeated rows
are judged alike. A null item_id is not listed, but its windows hit. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import _text
from tallymart.session import stage

SEGMENT_BYTES = 1 << 20
BLOCK_WINDOWS = 200_000
CANDIDATES = 200_000  # checked at a time

SEGMENT = "doc_ids array<long>, n_words array<long>, terms binary, counts binary, positions binary"


def _planes(values: np.ndarray) -> bytes:
    """32-bit values by byte planes, which compress well."""
    return np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _values(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SEGMENT.split(", ")]
    for batch in batches:
        for texts in _text.steps(batch.column(1), SEGMENT_BYTES):
            w = _text.words(texts, _text.ALPHANUMERIC)
            order = np.argsort(w.key, kind="stable")
            key = w.key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
            ids = batch.column(0).slice(texts.first, texts.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.bincount(w.doc, minlength=texts.rows)], pa.list_(pa.int64())),
                    pa.array([key[first].tobytes()], pa.binary()),
                    pa.array([_planes(np.diff(np.r_[first, len(key)]))], pa.binary()),
                    pa.array([_planes(order)], pa.binary()),
                ],
                names,
            )


def positional_index(docs: DataFrame) -> DataFrame:
    """Segments of the index over ``docs(doc_id, text)``, written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_segments, SEGMENT)
    return stage(rows, "positions")[0]


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text.steps(batch.column(1)):
                w = _text.words(texts, _text.ALPHANUMERIC)
                counts = np.bincount(w.doc, minlength=texts.rows)
                starts = np.cumsum(counts) - counts
                item, terms = [], []
                for row in np.flatnonzero(counts):
                    own = w.key[starts[row] : starts[row] + counts[row]].view(np.int64)
                    n = min(width, len(own))
                    terms += [own[i : i + n] for i in range(len(own) - n + 1)]
                    item += [texts.first + row] * (len(own) - n + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(item, pa.int64())), pa.array(terms, pa.list_(pa.int64()))], ["item", "terms"]
                )

    return run


class Block:
    """Windows of test items, ready for lookups: padded term numbers and their lengths."""

    def __init__(self, items: list[str | None], windows: list[list[int]]):
        self.items = items
        self.length = np.array([len(x) for x in windows])
        flat = np.concatenate([np.array(x, np.int64) for x in windows]).view(np.uint64)
        self.terms, number = np.unique(flat, return_inverse=True)
        self.number = np.full((len(windows), self.length.max()), -1)
        self.number[np.arange(self.number.shape[1]) < self.length[:, None]] = number

    def places(self, terms, counts, positions, doc, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows and the starts of their matches in a segment, and whether each is exact."""
        n = len(positions)
        begin = np.cumsum(counts) - counts
        term_at = np.empty(n, np.int64)
        term_at[positions] = np.repeat(np.arange(len(terms)), counts)
        own = np.minimum(np.searchsorted(terms, self.terms), max(len(terms) - 1, 0))
        own = np.where(terms[own] == self.terms, own, -1) if n else np.full(len(self.terms), -1)
        number = np.where(self.number >= 0, own[self.number], -1)
        used = np.arange(number.shape[1]) < self.length[:, None]
        alive = np.flatnonzero(((number >= 0) | ~used).all(axis=1))
        often = np.where(used[alive], counts[np.maximum(number[alive], 0)] if n else 0, n + 1)
        order = np.argsort(often, axis=1, kind="stable")
        lists = often[np.arange(len(alive)), order[:, 0]]
        cuts = np.flatnonzero(np.diff(np.cumsum(lists) // CANDIDATES)) + 1
        for part in np.split(np.arange(len(alive)), cuts):
            size = lists[part]
            w = np.repeat(part, size)
            rare = order[w, 0]
            k = np.arange(len(w)) - np.repeat(np.cumsum(size) - size, size)
            start = positions[begin[number[alive[w], rare]] + k] - rare
            last = start + self.length[alive[w]] - 1
            fits = (start >= 0) & (last < n)
            w, start, last = w[fits], start[fits], last[fits]
            fits = doc[start] == doc[last]
            w, start = w[fits], start[fits]
            exact = np.ones(len(w), bool)
            for rank in range(1, number.shape[1]):
                offset = order[w, rank]
                wanted = number[alive[w], offset]
                at = start + offset
                skip = wanted < 0
                here = skip | (term_at[np.minimum(at, n - 1)] == wanted)
                near = here.copy()
                for d in [x for s in range(1, slop + 1) for x in (-s, s)]:
                    to = np.clip(at + d, 0, n - 1)
                    near |= (term_at[to] == wanted) & (doc[to] == doc[start])
                w, start, exact = w[near], start[near], (exact & here)[near]
            yield alive[w], start, exact


def _blocks(items: DataFrame, width: int) -> Iterator[Block]:
    rows = items.select(F.col("item_id").cast("string"), "text").mapInArrow(_windows(width), "item string, terms array<long>")
    rows, n = stage(rows.dropDuplicates(["item", "terms"]), "windows")
    blocks = -(-n // BLOCK_WINDOWS)
    for i in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("terms"), F.lit(blocks)) == i) if blocks > 1 else rows
        found = part.collect()  # about BLOCK_WINDOWS rows
        if found:
            yield Block([x[0] for x in found], [x[1] for x in found])


def contamination(index: DataFrame, items: DataFrame, width: int = 13, slop: int = 0) -> DataFrame:
    """Per indexed document: doc_id, n_words, n_hit (words inside an exact match), the sorted
    item_ids with an exact match, n_near (words inside a proximity match, exact ones too) and
    the matched words' spans ``(first, end)``."""
    context = index.sparkSession.sparkContext
    shared = [context.broadcast(b) for b in _blocks(items, width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                n_words = np.array(row["n_words"], np.int64)
                doc = np.repeat(np.arange(len(n_words)), n_words)
                terms = np.frombuffer(row["terms"], np.uint64)
                counts, positions = _values(row["counts"]), _values(row["positions"])
                steps = np.zeros((2, len(doc) + 1), np.int64)
                hits: list[set[str]] = [set() for _ in n_words]
                for block in (b.value for b in shared):
                    for w, start, exact in block.places(terms, counts, positions, doc, slop):
                        for level, own in ((0, exact), (1, slice(None))):
                            np.add.at(steps[level], start[own], 1)
                            np.add.at(steps[level], start[own] + block.length[w[own]], -1)
                        pairs = np.unique(np.stack([doc[start[exact]], w[exact]]), axis=1)
                        for d, i in pairs.T.tolist():
                            hits[d].add(block.items[i])
                inside = np.cumsum(steps, axis=1)[:, :-1] > 0
                n_hit, n_near = (np.bincount(doc[x], minlength=len(n_words)) for x in inside)
                spans: list[list] = [[] for _ in n_words]
                base = np.cumsum(n_words) - n_words
                edge = np.diff(np.r_[False, inside[0], False].astype(np.int8))
                first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                for a, b in zip(first.tolist(), end.tolist(), strict=True):
                    while a < b:  # a run may go on over the next document's first words
                        d = int(doc[a])
                        stop = min(b, int(base[d] + n_words[d]))
                        spans[d].append({"first": a - int(base[d]), "end": stop - int(base[d])})
                        a = stop
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(n_words),
                        pa.array(n_hit, pa.int64()),
                        pa.array([sorted(x - {None}) for x in hits], pa.list_(pa.string())),
                        pa.array(n_near, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                    ],
                    ["doc_id", "n_words", "n_hit", "items", "n_near", "spans"],
                )
            _text.give_back()

    return index.mapInArrow(
        run,
        "doc_id long, n_words long, n_hit long, items array<string>, n_near long, spans array<struct<first: long, end: long>>",
    )


def is_contaminated() -> Column:
    """At least a twentieth of the document's words, and not none, are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
