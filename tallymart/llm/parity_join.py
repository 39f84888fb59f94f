"""N-gram Jaccard join by parity sketches, per size band, with exact verification.

1. Every whole text becomes its set of word shingles. Each element is XORed into sketches, so
   a sketch of A and one of B differ in no more places than A and B have different elements.
2. Linked sets of sizes a and b differ in at most ``(100 - p) * (a + b) / (100 + p)`` elements.
   Sizes are cut into bands that overlap, so that linked sizes share a band; a set takes part
   in every band that holds its size, one or two. In a band with bound d the sketch has
   ``d + 1 + e`` words. At most d words differ, so a linked pair has at least ``e + 1`` words
   in common (pigeonhole).
3. Of these a set may leave out any e, if all sets leave out the first ones of one common
   order: the rarest common word is then left. Empty words come first in that order and are
   never written; see 6 for the rest.
4. Sets that share a word are paired with the one of them that shares the most words with any
   set. Pairs are compared by a finer parity sketch of two to four bits an element; what differs
   in too many bits is no link. The others are verified on full sets.
5. Connected components of the verified links. A word whose sets are all in one component has
   nothing left to tell, nor has one that only two sets have.
6. For the other words, common ones are left out by 3, and all sets of different components are
   compared by their finer sketches: those of words of few sets in packs of many words, those
   of a frequent word in blocks of bounded size. Only pairs that sketches allow are verified.
   At first each set is paired with its nearest one only, which joins most components; then all
   pairs that are left between components are taken, so no link between them is lost.

Two sets are the same if 64-bit digests of all their elements are; copies cost one pair each.

Nulls and texts without words have no set and are linked with nothing. A text of fewer words
than a shingle has its whole sequence as one. Long texts are read whole; a sketch grows with
its set. Rows that share a doc_id keep their own sets; rows without one take part, and if no
member of a component has an id, its component_id is null. Other columns are not read, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm import _text
from tallymart.llm._graph import components
from tallymart.llm.near_dedup import BLOCK, _sums, _verify, shingle_sets
from tallymart.session import stage

SPREAD = 1.8  # last size of a band over its first, for thresholds above 75 %
FEW = 24  # sets of a word that goes into a pack with others
PACK = 4000  # rows of a pack, about
CHUNK = 512  # sets on each side of a block of a frequent word

_C = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_LOW = np.uint64(0xFFFFFFFF)


def most_apart(a, b, percent: int):
    """Elements in which linked sets of sizes a and b can differ at most."""
    return (100 - percent) * (a + b) // (100 + percent)


def size_bands(percent: int, largest: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """First and last size of each band. A band begins with the least size that can be linked
    with the first one beyond the band before it; no size lies in more than two bands."""
    first, last = [1], [1]
    while last[-1] <= largest:
        first.append(max(first[-1] + 1, -(-percent * (last[-1] + 1) // 100)))
        last.append(max(first[-1], int(first[-1] * SPREAD)))
    return np.array(first, np.int64), np.array(last, np.int64)


def _xor_words(doc: np.ndarray, place: np.ndarray, value: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """One after another the sketches of all documents, ``widths[i]`` words each."""
    words = np.zeros(int(widths.sum()), np.uint64)
    np.bitwise_xor.at(words, (np.cumsum(widths) - widths)[doc] + place, value)
    return words


def word_keys(sets: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the sketch words of every set in its bands, their number, and per parity of the
    band how many more words the set may leave out. A key's lowest bit is the band's parity."""
    least, largest = size_bands(percent)
    band = np.searchsorted(least, counts, side="right") - 1
    n = len(counts)
    doc = np.repeat(np.arange(n), counts)
    scattered, value = _text.mix(sets ^ _C[0]) >> np.uint64(32), _text.mix(sets ^ _C[1])
    keys, owners, spare = [], [], np.zeros((n, 2), np.int32)
    for step in (0, 1):
        tag = np.maximum(band - step, 0)
        apart = most_apart(largest[tag], largest[tag], percent)
        holds = (counts > 0) & (band >= step) & (counts <= largest[tag]) & (apart > 0)
        left_out = np.where(holds, 1 + apart // 6, 0)
        width = np.where(holds, apart + 1 + left_out, 0)
        use = width[doc] > 0
        place = ((scattered[use] * width[doc[use]].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        words = _xor_words(doc[use], place, value[use], width)
        owner = np.repeat(np.arange(n), width)
        first = np.cumsum(width) - width
        empty = words == 0
        rank = np.cumsum(empty)
        before = np.r_[0, rank][first]
        kept = ~empty | (rank - before[owner] > left_out[owner])
        spare[np.arange(n)[holds], (tag & 1)[holds]] = (left_out - np.minimum(left_out, np.bincount(owner[empty], minlength=n)))[holds]
        at = (np.arange(len(words)) - first[owner]).astype(np.uint64)
        key = _text.mix(words ^ _text.mix(at * _C[2] + tag[owner].astype(np.uint64) * _C[3]))
        key = (key & ~np.uint64(1)) | (tag[owner] & 1).astype(np.uint64)
        keys.append(key[kept])
        owners.append(owner[kept])
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return key[order], np.bincount(owner, minlength=n), spare


def parity_bits(sets: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A bit an element in a sketch of a power of two of bits, at least two for an element."""
    width = 1 << np.ceil(np.log2(np.maximum(counts, 32) / 32)).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = _text.mix(sets ^ _C[2])
    place = ((at >> np.uint64(6)) & (width[doc] - 1).astype(np.uint64)).astype(np.int64)
    words = _xor_words(doc, place, np.uint64(1) << (at & np.uint64(63)), width)
    ends = np.cumsum(width)
    return [words[e - w : e].tobytes() for e, w in zip(ends, width, strict=True)]


def _wide(blobs: list[bytes], words: int) -> np.ndarray:
    """Sketches of one size, folded to ``words`` words each: parities add up."""
    return np.bitwise_xor.reduce(np.frombuffer(b"".join(blobs), np.uint64).reshape(len(blobs), -1, words), axis=1)


def _wide_of_any(blobs: list[bytes], most: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sketches by their number of words, at most ``most``: which they are, and folded to it."""
    words = np.minimum([len(x) // 8 for x in blobs], most)
    return {w: (at, np.concatenate([_wide([blobs[i]], w) for i in at])) for w in np.unique(words) if len(at := np.flatnonzero(words == w))}


def may_link(n_a: np.ndarray, n_b: np.ndarray, different: np.ndarray, percent: int) -> np.ndarray:
    fits = percent * np.maximum(n_a, n_b) <= 100 * np.minimum(n_a, n_b)
    return fits & (different <= most_apart(n_a, n_b, percent))


def _sketch(width: int, percent: int):
    """Sketches of a task's texts; of sets that the task has had only the first one's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for texts in _text.steps(batch.column(1)):
                sets, counts = shingle_sets(texts, width)
                node = _sums(_text.mix(sets), counts).view(np.int64)
                new = np.array([x not in seen and not seen.add(x) for x in node.tolist()], bool)
                own = np.where(new, counts, 0)
                keys, n_keys, spare = word_keys(sets[np.repeat(new, counts)], own, percent)
                bits = parity_bits(sets, counts)
                offsets = np.r_[0, np.cumsum(n_keys)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, texts.rows),
                        pa.array(counts, pa.int64()),
                        pa.array(node),
                        pa.array([b if x else None for b, x in zip(bits, new, strict=True)], pa.binary()),
                        pa.array(spare[:, 0], mask=~new),
                        pa.array(spare[:, 1], mask=~new),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64))),
                    ],
                    ["doc_id", "n", "node", "bits", "spare0", "spare1", "keys"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text.steps(batch.column(1)):
                sets, counts = shingle_sets(texts, width)
                ends = np.cumsum(counts)
                blobs = [sets[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                node = pa.array(_sums(_text.mix(sets), counts).view(np.int64))
                yield pa.RecordBatch.from_arrays([node, pa.array(blobs, pa.binary())], ["node", "elements"])

    return run


def _close_pairs(percent: int):
    """Pairs ``(a, b, n_a, bits_a, n_b, bits_b)`` that their sketches don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (np.array(batch.column(i)) for i in (2, 4))
            left, right = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            different = np.zeros(len(n_a), np.int64)
            sizes = np.array([[len(x) // 8, len(y) // 8] for x, y in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
            for pair in np.unique(sizes, axis=0):
                rows = np.flatnonzero((sizes == pair).all(axis=1))
                both = _wide([left[i] for i in rows], pair.min()) ^ _wide([right[i] for i in rows], pair.min())
                different[rows] = np.bitwise_count(both).sum(axis=1)
            keep = pa.array(may_link(n_a, n_b, different, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.Table:
    ordered = {(min(x), max(x)) for x in found}
    return pa.table({"a": pa.array([x for x, _ in ordered], pa.int64()), "b": pa.array([y for _, y in ordered], pa.int64())})


def _partners(close: np.ndarray, different: np.ndarray, nearest: bool) -> np.ndarray:
    """Columns of the partners of one set: all that sketches allow, or the nearest of them."""
    at = np.flatnonzero(close)
    return at[np.argmin(different[at])][None] if nearest and len(at) else at


def _close_in_block(percent: int, nearest: bool):
    """Pairs between the two sides of a block, of different components, that sketches allow."""

    def run(table: pa.Table) -> pa.Table:
        node, root, side, n = (np.array(table[c]) for c in ("node", "root", "side", "n"))
        bits = table["bits"].to_pylist()
        words = np.array([len(x) // 8 for x in bits])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        folded = {w: _wide_of_any([bits[i] for i in right], w) for w in np.unique(words[left])}
        found = []
        for i in left:
            own = np.frombuffer(bits[i], np.uint64)
            different = np.zeros(len(right), np.int64)
            for w, (some, sketches) in folded[words[i]].items():
                different[some] = np.bitwise_count(sketches ^ _wide([bits[i]], w)[0] if w < len(own) else sketches ^ own).sum(axis=1)
            close = may_link(n[i], n[right], different, percent) & (root[right] != root[i])
            found += [(node[i], node[right[j]]) for j in _partners(close, different, nearest)]
        return _pairs(found)

    return run


def _close_in_pack(percent: int, nearest: bool):
    """Like ``_close_in_block``, for all sets that share one of a pack's words."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        key, node, root, n = (np.array(table[c]) for c in ("key", "node", "root", "n"))
        bits, found = table["bits"].to_pylist(), []
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(key)], strict=True):
            least = min(map(len, bits[a:b])) // 8
            sketches = np.concatenate([_wide([blob], least) for blob in bits[a:b]])
            different = np.bitwise_count(sketches[:, None] ^ sketches[None, :]).sum(axis=2)
            close = may_link(n[a:b, None], n[None, a:b], different, percent) & (root[a:b, None] != root[None, a:b])
            for i in range(b - a):
                found += [(node[a + i], node[a + j]) for j in _partners(close[i], different[i], nearest)]
        return _pairs(found)

    return run


class _Join:
    def __init__(self, docs: DataFrame, width: int, percent: int):
        self.width, self.percent = width, percent
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        schema = "doc_id long, n long, node long, bits binary, spare0 int, spare1 int, keys array<long>"
        self.sketch, _ = stage(self.texts.mapInArrow(_sketch(width, percent), schema), "parity")
        carried = [F.first(c, ignorenulls=True).alias(c) for c in ("n", "bits", "spare0", "spare1")]
        sets = self.sketch.filter("n > 0")
        self.classes, _ = stage(sets.groupBy("node").agg(F.min("doc_id").alias("rep"), *carried), "classes")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs(a, b)``: a and b of one group, as stars, proven on full sets."""
        own = self.classes.select("node", "n", "bits")
        near = pairs.join(own.toDF("a", "n_a", "bits_a"), "a").join(own.toDF("b", "n_b", "bits_b"), "b")
        near = near.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(_close_pairs(self.percent), "a long, b long")
        near, n = stage(near, "near")
        if not n:
            return near
        nodes = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted, _ = stage(self.classes.select("node", "rep").join(nodes, "node", "left_semi"), "wanted")
        docs = self.texts.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        docs = docs.union(self.texts.filter("doc_id IS NULL")).select("doc_id", "text")
        sets = docs.mapInArrow(_full_sets(self.width), "node long, elements binary")
        sets, _ = stage(sets.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
        blocks = near.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        placed = near.join(blocks, "b").withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
        others = placed.select(F.col("b").alias("hub"), "block", F.col("a").alias("node"), F.lit(0).alias("side"))
        hubs = placed.select(F.col("b").alias("hub"), "block").distinct().select("hub", "block", F.col("hub").alias("node"), F.lit(1).alias("side"))
        rows = others.union(hubs).join(sets, "node")
        return stage(_verify(rows, ["hub", "block"], self.percent), "links")[0]

    def members(self) -> DataFrame:
        """``(key, node)``: the words that at least two different sets have."""
        rows = self.sketch.select("node", F.explode("keys").alias("key"))
        shared = rows.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
        return stage(rows.join(shared.select("key"), "key").distinct(), "members")[0]

    def stars(self, members: DataFrame) -> DataFrame:
        """``(a, b)``: every set of a word with the one of them that shares the most words."""
        degrees = members.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
        centers = members.join(degrees, "node").groupBy("key").agg(F.max_by("node", F.struct("degree", "node")).alias("b"))
        return members.join(centers, "key").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()

    def undecided(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        """``(key, node, root)`` of words that sets of several components have, without the
        frequent words that a set may leave out."""
        of = members.join(roots, "node", "left")
        of = of.select("key", "node", F.coalesce("root", "node").alias("root"))
        open_ = of.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        open_ = open_.filter("lo < hi AND n > 2").select("key", "n")
        parity = F.col("key").bitwiseAND(1)
        # One order of all words: the most frequent first.
        rank = F.row_number().over(Window.partitionBy("node", "parity").orderBy(F.desc("n"), "key"))
        ranked = of.join(open_, "key").withColumn("parity", parity).withColumn("rank", rank)
        spare = self.classes.select("node", "spare0", "spare1")
        kept = ranked.join(spare, "node").filter(F.col("rank") > F.when(F.col("parity") == 0, F.col("spare0")).otherwise(F.col("spare1")))
        return stage(kept.select("key", "node", "root"), "undecided")[0]

    def pairs_between(self, rows: DataFrame, nearest: bool) -> DataFrame:
        """``(a, b)`` of sets that share a word, lie in different components and may be linked;
        all of them, or the nearest in every block and pack."""
        per_root = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
        words = per_root.groupBy("key").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("n", "root")).alias("main"))
        words, _ = stage(words.filter("roots > 1").drop("roots"), "words")
        sketches = self.classes.select("node", "n", "bits")
        few, n = stage(rows.join(words.filter(F.col("size") <= FEW).select("key"), "key", "left_semi"), "few")
        pack = F.pmod(F.xxhash64("key"), F.lit(-(-max(n, 1) // PACK))).alias("pack")
        packed = few.join(sketches, "node").select(pack, "key", "node", "root", "n", "bits")
        pairs = packed.groupBy("pack").applyInArrow(_close_in_pack(self.percent, nearest), "a long, b long")
        many = words.filter(F.col("size") > FEW)
        if not many.isEmpty():
            placed, _ = stage(rows.join(many, "key").join(sketches, "node"), "frequent")
            apart = F.col("root") != F.col("main")
            seats = placed.filter(apart).groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("seats"))
            placed = placed.join(seats, "key")
            chunks = F.ceil(F.col("size") / CHUNK).cast("int")
            own = ["node", "root", "n", "bits"]
            seat, chunk = F.pmod(F.xxhash64("node"), F.col("seats")).cast("int"), F.pmod(F.xxhash64("node"), chunks).cast("int")
            left = placed.filter(apart).select("key", seat.alias("seat"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(0).alias("side"), *own)
            right = placed.select("key", F.explode(F.sequence(F.lit(0), F.col("seats") - 1)).alias("seat"), chunk.alias("chunk"), F.lit(1).alias("side"), *own)
            close = left.union(right).groupBy("key", "seat", "chunk").applyInArrow(_close_in_block(self.percent, nearest), "a long, b long")
            pairs = pairs.union(close)
        return pairs.distinct()


def jaccard_join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable).

    Texts are linked if ``100 * intersection >= percent * union`` of their shingle sets.
    """
    join = _Join(docs, width, percent)
    members = join.members()
    links = join.verified(join.stars(members))
    roots = components(links)
    for nearest in (True, False):
        rows = join.undecided(members, roots)
        if rows.isEmpty():
            break
        links = links.union(join.verified(join.pairs_between(rows, nearest)))
        roots = components(links)
    named = join.classes.select("node", "rep").join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    per_class = named.join(least, "root").select("node", "component_id")
    out = join.sketch.select("doc_id", "n", "node").join(per_class, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
