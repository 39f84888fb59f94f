"""Minimax contiguous partition of documents into shards, with built-in functions only.

Equal texts form an atomic group. Groups are ordered by their text's digest and cut into
contiguous shards so that the largest shard is as small as any contiguous cut allows: the
smallest feasible capacity is found by binary search, a capacity being feasible if filling
shards greedily needs no more than the given number.

A greedy fill needs only the running totals of the group sizes, and of these only the last
one that fits. So the driver searches over a few thousand totals taken at even distances.
They give a capacity that is surely feasible and one that is surely not, and with these the
narrow stretches in which each cut must lie; only the totals there are looked at again,
more finely, until all of them are known. The result is exact and no step holds more than
``KNOWN`` totals on the driver or one of ``CELLS`` slices of the groups in a task.

A null text counts as empty; so do its size (1) and checksum (0). Rows that repeat are each
placed. Slots number the rows of a shard without gaps, in an order given by hashes alone.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.session import stage

CELLS = 4096
BINS = 8192
KNOWN = 50_000


def _greedy(totals: list[int], capacity: int, shards: int, upper: bool) -> list[int]:
    """Ends of up to ``shards`` shards filled greedily, as running totals.

    With ``upper``, cuts may fall anywhere up to the next known total, which is as far as
    any unknown one could lie.
    """
    ends, at = [], 0
    for _ in range(shards):
        i = bisect_right(totals, at + capacity)
        if i == len(totals):
            return [*ends, totals[-1]]
        at = min(at + capacity, totals[i] - 1) if upper else (totals[i - 1] if i else 0)
        ends.append(at)
    return ends


def _smallest(totals: list[int], low: int, shards: int, upper: bool) -> int:
    """Smallest capacity above ``low`` for which a greedy fill reaches the last total."""
    high = totals[-1]
    while high - low > 1:
        middle = (low + high) // 2
        if _greedy(totals, middle, shards, upper)[-1] >= totals[-1]:
            high = middle
        else:
            low = middle
    return high


def cuts(groups: DataFrame, shards: int) -> tuple[list[str], int]:
    """First keys of shards 1, 2, ... and the capacity, for ``groups(key, size)``.

    ``key`` is a hexadecimal digest, unique. Fewer keys than ``shards - 1`` mean that the
    last shards stay empty.
    """
    cell = F.conv(F.substring("key", 1, 3), 16, 10).cast("int")
    by_cell = groups.groupBy(cell.alias("cell")).agg(F.sum("size").alias("size"))
    before = F.sum("size").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))  # CELLS rows
    before = by_cell.select("cell", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("cell").orderBy("key"))
    running = groups.withColumn("cell", cell).withColumn("inside", inside).join(F.broadcast(before), "cell")
    running, n = stage(running.select("key", (F.col("before") + F.col("inside")).alias("total"), "size"), "totals")
    if not n:
        return [], 0
    whole, largest = running.agg(F.max("total"), F.max("size")).first()
    low = max(-(-whole // shards), largest) - 1
    known, windows, width = {whole}, [(0, whole)], 2 * whole
    while True:
        span = sum(b - a for a, b in windows)
        width = max(1, min(-(-span // BINS), width // 2))
        within = F.lit(False)
        for a, b in windows:
            within |= F.col("total").between(a, b)
        bins = running.filter(within).groupBy(F.floor(F.col("total") / width).alias("bin"))
        bins = bins.agg(F.max("total"), F.min("total"), F.count(F.lit(1))).collect()
        known |= {x for row in bins for x in row[1:3]}
        every = sum(row[3] for row in bins) <= KNOWN or width == 1
        if every and any(row[3] > 2 for row in bins):
            known |= {row[0] for row in running.filter(within).select("total").collect()}
        totals = sorted(known)
        capacity = _smallest(totals, low, shards, False)
        if every:
            break
        low = max(low, _smallest(totals, low, shards, True) - 1)
        narrow, wide = _greedy(totals, low, shards, False), _greedy(totals, capacity, shards, True)
        windows = _merged([(a, b) for a, b in zip(narrow, wide + [whole] * shards, strict=False)])
    ends = _greedy(totals, capacity, shards, False)
    ends = [e for i, e in enumerate(ends) if e < whole and (not i or e > ends[i - 1])]
    last = running.filter(F.col("total").isin(ends)).select("total", "key").collect() if ends else []
    return [r.key for r in sorted(last)], capacity


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def slots(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0: counts of small cells, then places in a cell."""
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "key"), F.lit(CELLS)))
    counts = rows.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("shard", "_cell", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy("key", "doc_id"))
    rows = rows.withColumn("_place", place).join(F.broadcast(counts), ["shard", "_cell"])  # shards * CELLS rows
    return rows.withColumn("slot", F.col("_before") + F.col("_place") - 1).drop("_cell", "_before", "_place")


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``(doc_id, size, text_crc32, key, shard, slot)`` of every row of ``docs(doc_id, text)``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("key"),
    )
    rows, _ = stage(rows, "sized")
    lasts, _ = cuts(rows.groupBy("key").agg(F.sum("size").alias("size")), shards)
    shard = sum(((F.col("key") > k).cast("int") for k in lasts), F.lit(0))
    return slots(rows.withColumn("shard", shard))
