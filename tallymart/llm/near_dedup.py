"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

1. Every whole text becomes its set of word shingles. Each shingle ranks the signature's
   slots by a random permutation of its own; a slot keeps the lowest rank, ties broken by a random
   fraction. Ranks are handed out level by level, and a document stops as soon as no deeper
   level can win a slot.
2. Documents with equal sets are one class, so copies cost one row from here on.
3. Classes that share a band are joined to the band's smallest class; union-find over these
   stars gives families: no link can lie between two of them.
4. Families are verified on full sets in blocks. Small families are one block. The blocks
   of a large one hold the family's most central class as well, so nearly all members join
   its component at once; what stays apart is then compared with all blocks of the family,
   so no link is lost.
5. Union-find over verified links gives the components.

Two texts at the threshold miss each other in all bands with a probability below ``MISS``
(for 0.85 36 bands of 7 slots, for 0.8 42 of 6); more similar texts less often still.

Nulls and empty texts are linked with nothing. A very long text is one set of all its
shingles and a row like others. Rows that share a doc_id count as one
document. Rows without doc_id take part; if no member of a component has an id, its
component_id is null. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import _text
from tallymart.llm._graph import components, union_find
from tallymart.session import stage

SLOTS = 256
PART = 1 << 14  # elements whose permutations are held at once, a byte a slot
MISS = 1e-5
BLOCK = 72
BROADCAST_ROWS = 1_000_000  # of 8 and 40 bytes
NO_ID = 1 << 62

_C = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_BAND_KEYS = np.random.default_rng(7).integers(1, 2**63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BIG = np.uint64(2**63)


def shingle_sets(texts: _text.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the texts, sorted within each, and the number per text.

    Words are lower-cased ASCII-wise and separated by white space. A text of fewer words
    than ``width`` has its whole sequence as its one shingle.
    """
    w = _text.words(texts, _text.SPACE_SEPARATED)
    counts = np.bincount(w.doc, minlength=texts.rows)
    n = len(w.key)
    key = np.full(max(n - width + 1, 0), np.uint64(width))
    for i in range(width):
        key = _text.mix(key * _C[3] + w.key[i : n - width + 1 + i] * _C[i % 3])
    own = w.doc[: len(key)] == w.doc[width - 1 :] if len(key) else np.empty(0, bool)
    parts, docs = [key[own]], [w.doc[: len(key)][own]]
    starts = np.cumsum(counts) - counts
    for few in range(1, width):
        rows = np.flatnonzero(counts == few)
        if len(rows):
            short = np.full(len(rows), np.uint64(few))
            for i in range(few):
                short = _text.mix(short * _C[3] + w.key[starts[rows] + i] * _C[i % 3])
            parts.append(short)
            docs.append(rows)
    key, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    key, doc = key[order], doc[order]
    ends = np.cumsum(np.bincount(doc, minlength=texts.rows))
    for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True):
        key[a:b].sort()
    keep = np.ones(len(key), bool)
    keep[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return key[keep], np.bincount(doc[keep], minlength=texts.rows)


def super_minhash(sets: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """One row of slot values per set; ``slots`` is at most 256. Empty sets keep the top value.

    Every element draws a permutation of the slots by Fisher-Yates, a place a level; its value
    at the slot of level ``j`` is j and a random fraction. Elements go in parts of ``PART``, so
    permutations take bounded memory however long a text is.
    """
    doc = np.repeat(np.arange(len(counts)), counts)
    best = np.full((len(counts), slots), np.uint64(2**64 - 1))
    for a in range(0, len(sets), PART):
        _rank(best, doc[a : a + PART], _text.mix(sets[a : a + PART] ^ _C[1]))
    return best


def _rank(best: np.ndarray, doc: np.ndarray, seed: np.ndarray) -> None:
    """Lower the slot values of the documents ``doc`` by the elements of these seeds."""
    slots, flat = best.shape[1], best.reshape(-1)
    drawn = np.tile(np.arange(slots, dtype=np.uint8), len(doc))
    row = np.arange(0, len(drawn), slots)
    first, last = (doc[0], doc[-1] + 1) if len(doc) else (0, 0)
    for level in range(slots):
        if not len(doc):
            break
        word = _text.mix(seed + np.full(1, level, np.uint64) * _C[0])
        other = row + level + ((word & np.uint64(0xFFFF)).astype(np.int64) * (slots - level) >> 16)
        slot = drawn[other]
        drawn[other] = drawn[row + level]
        np.minimum.at(flat, doc * slots + slot, (word >> np.uint64(16)) | (np.uint64(level) << np.uint64(48)))
        open_ = best[first:last].max(axis=1) >= np.uint64(level + 1) << np.uint64(48)
        active = open_[doc - first]
        if not active.all():
            doc, seed, row = doc[active], seed[active], row[active]


def banding(percent: int) -> tuple[int, int]:
    """Bands and slots per band: the widest bands that keep misses at the threshold below ``MISS``."""
    fits = [r for r in range(1, SLOTS + 1) if (1 - (percent / 100) ** r) ** (SLOTS // r) < MISS]
    rows = max(fits, default=1)
    return SLOTS // rows, rows


def _sums(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _sketch(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text.steps(batch.column(1)):
                sets, counts = shingle_sets(texts, width)
                values = super_minhash(sets, counts)[:, : bands * rows].reshape(-1, bands, rows)
                band = _text.mix((values * _BAND_KEYS[:rows]).sum(axis=2) + np.arange(1, bands + 1, dtype=np.uint64) * _C[2])
                offsets = np.arange(0, bands * texts.rows + 1, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, texts.rows),
                        pa.array(counts, pa.int64()),
                        pa.array(_sums(_text.mix(sets), counts).view(np.int64)),
                        pa.array(_sums(_text.mix(sets ^ _C[0]), counts).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.reshape(-1).view(np.int64))),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text.steps(batch.column(1)):
                sets, counts = shingle_sets(texts, width)
                ends = np.cumsum(counts)
                blobs = [sets[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, texts.rows),
                        pa.array(_sums(_text.mix(sets), counts).view(np.int64)),
                        pa.array(blobs, pa.binary()),
                    ],
                    ["doc_id", "d1", "elements"],
                )

    return run


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements, all left sets by all right sets."""
    both = np.concatenate([*left, *right])
    values, index = np.unique(both, return_inverse=True)
    sizes = [len(x) for x in (*left, *right)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(left), len(right)), np.int64)
    cut = len(left)
    for a in range(0, len(values), 4096):  # bounded columns at a time, however long the texts
        own = (index >= a) & (index < a + 4096)
        table = np.zeros((len(sizes), min(4096, len(values) - a)), np.float32)
        table[row[own], index[own] - a] = 1
        out += (table[:cut] @ table[cut:].T).astype(np.int64)
    return out


def _links(percent: int):
    """Verified links of one block: those within it, or those between its two sides."""

    def run(table: pa.Table) -> pa.Table:
        node = np.array(table["node"].to_pylist(), np.int64)
        side = np.array(table["side"].to_pylist(), np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in table["elements"].to_pylist()]
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        right = right if len(right) else left
        shared = _shared([sets[i] for i in left], [sets[i] for i in right])
        size = np.array([len(x) for x in sets])
        union = size[left][:, None] + size[right][None, :] - shared
        a, b = np.nonzero((100 * shared >= percent * union) & (shared > 0) & (node[left][:, None] != node[right][None, :]))
        tree = union_find(zip(node[left][a].tolist(), node[right][b].tolist(), strict=True))
        stars = [(x, r) for x, r in tree.items() if x != r]
        return pa.table({"a": pa.array([x for x, _ in stars], pa.int64()), "b": pa.array([r for _, r in stars], pa.int64())})

    return run


def _verify(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    return rows.select(*keys, "node", "side", "elements").groupBy(*keys).applyInArrow(_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id linked) and kept.

    Texts are linked if ``100 * intersection >= percent * union`` of their shingle sets.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch, _ = stage(
        texts.mapInArrow(_sketch(width, *banding(percent)), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"), "sketch"
    )
    surrogate = F.lit(NO_ID) + F.col("d1").bitwiseAND(NO_ID - 1)
    classes = (
        sketch.filter("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
        .select("d1", "d2", F.coalesce("rep", surrogate).alias("node"), "bands")
    )
    classes, _ = stage(classes, "classes")
    rows = classes.select("node", F.explode("bands").alias("band"))
    hubs = rows.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members, _ = stage(rows.join(hubs, "band").select("node", "hub", "n"), "members")
    family = components(members.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    family, n_nodes = stage(
        family.withColumnRenamed("root", "family").join(members.groupBy("node").agg(F.sum("n").alias("degree")), "node", "left"),
        "families",
    )
    sizes = family.groupBy("family").agg(
        F.count(F.lit(1)).alias("size"), F.max_by("node", F.struct("degree", F.negative("node"))).alias("center")
    )
    family, _ = stage(family.join(sizes, "family").select("node", "family", "size", "center"), "placed")
    # Full sets of the classes in question only: one more scan, met with their ids. A class
    # without any doc_id is told by its digest.
    wanted = classes.join(family, "node").select("node", "d1", "family", "size", "center")
    few = n_nodes <= BROADCAST_ROWS
    keyed = wanted.filter(F.col("node") < NO_ID)
    keyed = F.broadcast(keyed.select("node")) if few else keyed.select("node")
    source = texts.join(keyed, texts.doc_id == keyed.node, "left_semi").union(texts.filter("doc_id IS NULL"))
    found = source.mapInArrow(_full_sets(width), "doc_id long, d1 long, elements binary")
    found = found.select(F.coalesce("doc_id", surrogate).alias("node"), "d1", "elements")
    sets, _ = stage(
        found.dropDuplicates(["node", "d1"]).join(F.broadcast(wanted) if few else wanted, ["node", "d1"]).drop("d1"), "sets"
    )
    spread = F.ceil(F.col("size") / BLOCK)
    block = F.pmod(F.xxhash64("node"), spread).cast("int")
    first = sets.withColumn("side", F.lit(0))
    seats = F.when(F.col("node") == F.col("center"), F.sequence(F.lit(0), spread.cast("int") - 1)).otherwise(F.array(block))
    links, _ = stage(_verify(first.withColumn("block", F.explode(seats)), ["family", "block"], percent), "links")
    large = sets.filter(F.col("size") > BLOCK)
    if large.limit(1).count():
        linked = components(links)
        placed = large.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
        main = placed.filter("node = center").select("family", F.col("root").alias("main"))
        n_apart = F.count(F.lit(1)).alias("n_apart")
        apart, n = stage(
            placed.select("family", "root").join(main, "family").filter("root <> main").groupBy("family", "main").agg(n_apart), "apart"
        )
        placed = placed.join(F.broadcast(apart) if n <= BROADCAST_ROWS else apart, "family")
        placed = placed.withColumn("apart", F.col("root") != F.col("main")).withColumn("block", block)
        placed = placed.withColumn("seats", F.ceil(F.col("n_apart") / BLOCK).cast("int"))
        seat = F.pmod(F.xxhash64("node", F.lit(1)), F.col("seats")).cast("int")
        left = placed.filter("apart").select(
            "family", seat.alias("seat"), F.explode(F.sequence(F.lit(0), spread.cast("int") - 1)).alias("block"), "node", F.lit(0).alias("side"), "elements"
        )
        right = placed.select(
            "family", F.explode(F.sequence(F.lit(0), F.col("seats") - 1)).alias("seat"), "block", "node", F.lit(1).alias("side"), "elements"
        )
        rest, _ = stage(_verify(left.union(right), ["family", "seat", "block"], percent), "links")
        links = links.union(rest)
    root = components(links)
    per_class = classes.select("d1", "d2", "node").join(root, "node", "left").select(
        "d1", "d2", F.coalesce("root", "node").alias("root")
    )
    out = sketch.select("doc_id", "n_shingles", "d1", "d2").join(per_class, ["d1", "d2"], "left")
    component = F.when(F.col("root") < NO_ID, F.col("root")).when(F.col("root").isNull(), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
