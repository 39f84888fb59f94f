"""Prefix trie of conversations, from padded matrices of turn ids.

1. Turns are numbered within their conversation, block of turn numbers by block, and each gets
   128-bit ids that depend on its depth, role and text. The XOR of the ids of a prefix names
   its node ``(depth, f1, f2)``; nodes are told apart by 128-bit hashes.
2. Conversations with equal turns are one row with a weight. A row is cut into tiles of ``TILE``
   turns, each with the node it begins at, so a long conversation is many rows and a matrix is
   never wider than a tile.
3. Tiles are dealt into ranges of (tile, node it begins at, turn ids). A task takes its sorted
   rows batch by batch as padded matrices of turn ids: lexsort, masks of the columns in which a
   row differs from the one before, OR-accumulated from left to right. They mark where the nodes
   of every depth start, and reduceat adds up every depth.
4. Nodes that hold the first or last row of a batch may go on beside it; only they are
   recombined by their names, all others are whole.
5. Subtree sums: what a node adds belongs to its smallest member. Sums over a conversation's
   deeper tiles go with each tile; running sums from right to left and the same masks give the
   sum below every node, recombined in the same way.

Every conversation takes part, one without turns in the root only. Null roles and texts are
empty. Null turns come first, rows of one turn are ordered by a hash of role and text. Rows
without conv_id belong to no conversation and are left out. Empty tables give no rows. Columns
beside conv_id, turn, role and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.session import stage

TILE = 32
BLOCK_BITS = 6  # turn numbers of one numbering window, as a power of two
HEADS = 4  # a conversation takes up to HEADS - 1 turns of its family's first one
FAMILY = 20
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "f1", "f2"]


def numbered(rows: DataFrame) -> DataFrame:
    """``(conv_id, pos, t1, t2, words)``: turns by turn number from 0, with ids and words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.col("turn").cast("long")
    turns = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"),
        F.coalesce(F.shiftright(turn, BLOCK_BITS), F.lit(-(1 << 62))).alias("block"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(text, role, F.lit(1)).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    turns, _ = stage(turns, "turns")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "t1", "t2"))
    placed = turns.withColumn("nth", nth).join(blocks, ["conv_id", "block"])
    return placed.select("conv_id", (F.col("offset") + F.col("nth") - 1).alias("pos"), "t1", "t2", "words")


def with_family_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are those of their family's first conversation.

    Conversation c is of the family of ``c - c % 20`` and h is drawn from its number. Returns
    all conversations and the turns ``(conv_id, depth, t1, t2, words)`` they have now.
    """
    turns, _ = stage(turns, "numbered")
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    drawn = F.crc32(F.col("conv_id").cast("string")) % HEADS
    convs = turns.select("conv_id").distinct().select("conv_id", family)
    h = F.when(F.col("conv_id") == F.col("family"), F.lit(0)).otherwise(drawn)
    heads = turns.filter((F.col("pos") < HEADS - 1) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "family")
    lengths = heads.groupBy("family").agg(F.count(F.lit(1)).alias("there"))
    convs = convs.withColumn("h", h).join(lengths, "family", "left")
    convs, _ = stage(convs.select("conv_id", "family", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "families")
    lent = heads.join(convs, "family").filter("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "t1", "t2", "words")
    own = turns.join(convs, "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "t1", "t2", "words")
    return convs.select("conv_id"), lent.unionByName(own)


def _rows(columns: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of up to ``width`` numbers as a padded matrix, and where it holds numbers."""
    lengths = np.fromiter(map(len, columns), np.int64, len(columns))
    there = np.arange(width) < lengths[:, None]
    out = np.zeros((len(columns), width), np.int64)
    out[there] = np.fromiter((x for row in columns for x in row), np.int64, int(lengths.sum()))
    return out, there


class _Matrix:
    """A batch of sorted tiles: the runs of rows of the nodes of every depth."""

    def __init__(self, batch: pa.RecordBatch):
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        self.start = np.column_stack([np.array(column[c], np.int64) for c in ("tile", "q1", "q2")])
        x1, there = _rows(column["x1"].to_pylist(), TILE)
        x2, _ = _rows(column["x2"].to_pylist(), TILE)
        keys = np.hstack([self.start, np.hstack([x1, x2, there])])
        self.order = np.lexsort(keys.T[::-1])
        self.start, x1, x2, self.there = self.start[self.order], x1[self.order], x2[self.order], there[self.order]
        n = len(self.order)
        change = np.ones((n, TILE + 1), bool)
        change[1:, 0] = (self.start[1:] != self.start[:-1]).any(axis=1)
        change[1:, 1:] = (x1[1:] != x1[:-1]) | (x2[1:] != x2[:-1]) | (self.there[1:] != self.there[:-1])
        self.starts = np.logical_or.accumulate(change, axis=1)[:, 1:]
        self.f1 = np.bitwise_xor.accumulate(np.column_stack([self.start[:, 1], x1]), axis=1)
        self.f2 = np.bitwise_xor.accumulate(np.column_stack([self.start[:, 2], x2]), axis=1)
        place = np.argsort(self.order)
        self.outer = (place[0], place[-1])  # where the batch's first and last row lie now

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, dict]]:
        """Per column: the first rows of all runs, which runs are nodes, and the nodes' names."""
        for j in range(TILE):
            if not self.there[:, j].any():
                return
            first = np.flatnonzero(self.starts[:, j])
            node = self.there[first, j]
            edge = np.zeros(len(first), bool)
            edge[np.searchsorted(first, self.outer, side="right") - 1] = True
            own = first[node]
            names = {
                "depth": self.start[own, 0] * TILE + j + 1, "f1": self.f1[own, j + 1], "f2": self.f2[own, j + 1],
                "edge": edge[node], "p1": self.f1[own, j], "p2": self.f2[own, j],
            }
            yield j, first, node, names


_COUNTS = "depth long, f1 long, f2 long, edge boolean, p1 long, p2 long, n_convs long, conv_id long, words long"
_SUMS = "depth long, f1 long, f2 long, edge boolean, p1 long, p2 long, n_leaves long, saved_tokens long"


def _emit(parts: list[dict]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate([p[c] for p in parts])) for c in parts[0]})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        m = _Matrix(batch)
        weight, rep = (np.array(batch.column(c), np.int64)[m.order] for c in ("weight", "rep"))
        words = _rows(batch.column("words").to_pylist(), TILE)[0][m.order]
        parts = []
        for j, first, node, names in m.levels():
            names["n_convs"] = np.add.reduceat(weight, first)[node]
            names["conv_id"] = np.minimum.reduceat(rep, first)[node]
            names["words"] = words[first[node], j]
            parts.append(names)
        yield from _emit(parts)


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        m = _Matrix(batch)
        added = np.zeros((2, batch.num_rows, TILE), np.int64)
        for i, (tile, own) in enumerate(zip(batch.column("tile").to_pylist(), batch.column("own").to_pylist(), strict=True)):
            for x in own or ():
                added[:, i, x["depth"] - 1 - tile * TILE] = x["n_leaves"], x["saved_tokens"]
        deeper = np.stack([np.array(batch.column(c), np.int64) for c in ("deeper_leaves", "deeper_saved")])
        below = (np.cumsum(added[:, :, ::-1], axis=2)[:, :, ::-1] + deeper[:, :, None])[:, m.order]
        parts = []
        for j, first, node, names in m.levels():
            names["n_leaves"], names["saved_tokens"] = np.add.reduceat(below[:, :, j], first, axis=1)[:, node]
            parts.append(names)
        yield from _emit(parts)


def _dealt(tiles: DataFrame) -> DataFrame:
    order = ["tile", "q1", "q2", "x1", "x2", "rep"]
    return tiles.repartitionByRange(*order).sortWithinPartitions(*order)


def _recombined(parts: DataFrame, name: str, *aggregates) -> DataFrame:
    """Nodes at the edge of a batch put together; the others are whole."""
    parts, _ = stage(parts, name)
    whole = parts.filter("NOT edge").drop("edge")
    edge = parts.filter("edge").groupBy(*NODE).agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), *aggregates)
    return whole.unionByName(edge)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids in order, whatever their number; a node's rows are adjacent."""
    schema = pa.schema([("depth", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("ends_sha256", pa.string())])
    now, digest = None, None
    for batch in batches:
        done = []
        for depth, f1, f2, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (depth, f1, f2) != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (depth, f1, f2), hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(b",%d" % conv_id)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, digest.hexdigest()), schema, strict=True)], schema=schema)


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per distinct prefix of the conversations ``convs(conv_id)`` with their turns
    ``(conv_id, depth, t1, t2, words)``, depth from 1 without gaps.

    conv_id is the smallest member; n_leaves and saved_tokens count the whole subtree.
    """
    ids = turns.select(
        "conv_id", "depth", F.xxhash64("depth", "t1", "t2").alias("x1"), F.xxhash64("t2", "t1", "depth", F.lit(1)).alias("x2"), "words"
    )
    ids, _ = stage(ids, "ids")
    ends = ids.groupBy("conv_id").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("x1").alias("f1"), F.bit_xor("x2").alias("f2"))
    zero = F.lit(0).cast("long")
    ends = convs.join(ends, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in NODE))
    ends, n = stage(ends, "ends")
    classes = ends.groupBy(*NODE).agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes, _ = stage(classes.select("rep", "weight"), "sequences")

    cell = F.struct("depth", "x1", "x2", "words")
    tile = F.floor((F.col("depth") - 1) / TILE).cast("long")
    tiles = ids.join(classes, F.col("conv_id") == F.col("rep")).groupBy("rep", "weight", tile.alias("tile")).agg(
        F.sort_array(F.collect_list(cell)).alias("cells"), F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2")
    )
    before = Window.partitionBy("rep").orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.select(
        "rep", "weight", "tile",
        *(F.coalesce(F.bit_xor(y).over(before), zero).alias(q) for y, q in (("y1", "q1"), ("y2", "q2"))),
        *(F.col(f"cells.{c}").alias(c) for c in ("x1", "x2", "words")),
    )
    tiles, _ = stage(tiles, "tiles")

    counted = _recombined(
        _dealt(tiles).mapInArrow(_count, _COUNTS), "counted",
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("words").alias("words"),
    )
    everything = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = everything.select(
        zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        "n_convs", "conv_id", zero.alias("words"),
    )
    counted, _ = stage(counted.unionByName(root), "named")
    children = counted.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    nodes = counted.join(children.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left")
    nodes, _ = stage(nodes.withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

    leaf = (F.col("n_children") == 0).cast("long").alias("n_leaves")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    added = nodes.select("depth", F.col("conv_id").alias("rep"), leaf, saved)
    own = added.filter("depth > 0").groupBy("rep", tile.alias("tile")).agg(
        F.collect_list(F.struct("depth", "n_leaves", "saved_tokens")).alias("own"),
        F.sum("n_leaves").alias("tile_leaves"), F.sum("saved_tokens").alias("tile_saved"),
    )
    after = Window.partitionBy("rep").orderBy(F.desc("tile")).rowsBetween(Window.unboundedPreceding, -1)
    owned = tiles.drop("words", "weight").join(own, ["rep", "tile"], "left").withColumns(
        {f"deeper_{c}": F.coalesce(F.sum(f"tile_{c}").over(after), zero) for c in ("leaves", "saved")}
    )
    below = _recombined(
        _dealt(owned.drop("tile_leaves", "tile_saved")).mapInArrow(_sum, _SUMS), "below",
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
    ).drop("p1", "p2")
    total = added.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")).filter("n_leaves > 0")
    below = below.unionByName(total.select(zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), "n_leaves", "saved_tokens"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    sorted_ends = ends.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    hashes = sorted_ends.mapInArrow(_hashed, "depth long, f1 long, f2 long, ends_sha256 string")
    out = nodes.join(parents, ["depth", "p1", "p2"], "left").join(below, NODE).join(hashes, NODE, "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )
