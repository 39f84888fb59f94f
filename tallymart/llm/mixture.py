"""Mixing sources to target weights by Pareto order sampling, with built-in functions only.

Targets: the sources, in code-point order and null last, carry repeating weights and share
a multiple of all words; no target exceeds ``most`` times its source's size, and what is cut
off is shared again by weight until no target is above.

Sampling: a document of source s expects ``target / source_size`` copies, scaled by its own
weight against the source's mean if a weight column is given, and never more than ``most``.
Whole copies are certain. For the fraction left, every document draws a uniform number from
its id and ranks by random odds divided by inclusion odds; documents are taken in that order
until the target's remaining words are reached, so a source's size is fixed. The document
that would cross the target stays out; two more draws over those that fit into the remaining gap
close it, and the very last document may cross the target if that comes nearer.

The order is never sorted as a whole: documents are counted into bins of their rank, the
bin where the words are reached is cut into finer bins, and only the last of these is
sorted. So a source of any size is spread over tasks, and reruns agree.

A null text has size 0 and takes nothing. A null source is a source of its own. Rows that
repeat are drawn alike and separately; ties are broken by doc_id and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.session import stage

WEIGHTS = (5, 2, 1)
BINS = 1024
LEVELS = 2
DRAWS = 3


def targets(sizes: DataFrame, share: float, most: float, weights: tuple = WEIGHTS) -> DataFrame:
    """Add ``target`` to ``sizes(source, source_size)``, one row per source.

    Sources reach their limit in the order of limit per weight, so the level at which the
    rest shares evenly is found from running sums. Holds one row per source, not documents.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights)).cast("int") + 1)
    )
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    total = share * F.sum("source_size").over(every)
    left = total - most * F.coalesce(F.sum("source_size").over(upto), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    rows = rows.withColumn("level", left / weight_left).withColumn("limit", (most * F.col("source_size")).cast("double"))
    # The first source that stays below its limit sets the level of all after it.
    below = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("limit") / F.col("weight"))
    first = F.min_by("level", F.when(below.isNotNull(), F.struct(below, F.col("source").isNull(), "source")))
    rows = rows.withColumn("level", first.over(every))
    level = F.least("limit", F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", F.coalesce(level, "limit").alias("target"))


def _taken(rows: DataFrame, goal: DataFrame, over: float) -> DataFrame:
    """Flag the rows of ``(source, size, rank, ...)`` that lie in the longest run, by rank,
    whose sizes stay within the source's ``goal``; adds ``chosen``. Rank is from 0 to 1. The
    last one may cross the goal by the share ``over`` of its size."""
    bound = goal.select("source", F.col("goal").alias("room"), F.lit(0.0).alias("from"), F.lit(1.0).alias("width"))
    same = lambda other: F.col("r.source").eqNullSafe(F.col(f"{other}.source"))
    for _ in range(LEVELS):
        fine = rows.alias("r").join(F.broadcast(bound).alias("b"), same("b")).filter(
            (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("from") + F.col("width"))
        )
        at = F.least(F.floor((F.col("rank") - F.col("from")) / F.col("width") * BINS), F.lit(BINS - 1))
        fine = fine.groupBy("b.source", "room", "from", "width", at.alias("bin")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
        fine = fine.withColumn("upto", upto).filter(F.col("upto") > F.col("room"))
        first = fine.groupBy("source").agg(F.min_by(F.struct("room", "from", "width", "bin", "upto", "words"), "bin").alias("x"))
        bound, _ = stage(
            first.select(
                "source",
                (F.col("x.room") - F.col("x.upto") + F.col("x.words")).alias("room"),
                (F.col("x.from") + F.col("x.bin") * F.col("x.width") / BINS).alias("from"),
                (F.col("x.width") / BINS).alias("width"),
            ),
            "bound",
        )
    # A source without a bound has room for all of its rows.
    met = rows.alias("r").join(F.broadcast(bound).alias("b"), same("b"), "left")
    met = met.select("r.*", "room", "from", "width")
    inside = F.col("from").isNotNull() & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("from") + F.col("width"))
    edge = met.filter(inside)
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("rank", "doc_id", "size", "id").rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("chosen", upto - over * F.col("size") <= F.col("room"))
    rest = met.filter(~inside).withColumn("chosen", F.col("from").isNull() | (F.col("rank") < F.col("from")))
    return edge.union(rest).drop("room", "from", "width")


def _uniform(seed: int) -> Column:
    """A number in (0, 1) from the document's id."""
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", "size", F.lit(seed)), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def mix(
    docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS, weight: str | None = None, seed: int = 1
) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)`` of every row of ``docs``."""
    sized = docs.select(
        "doc_id",
        "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        (F.greatest(F.coalesce(F.col(weight), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)).cast("double").alias("w"),
        F.monotonically_increasing_id().alias("id"),
    )
    sized, _ = stage(sized, "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("w")).alias("weighted"))
    goal = targets(sizes.select("source", "source_size"), share, most, weights).alias("t")
    goal = goal.join(sizes.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source"))).select("t.*", "weighted")
    goal, _ = stage(goal, "targets")
    rows = sized.alias("r").join(F.broadcast(goal).alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
    expected = F.when(F.col("weighted") > 0, F.col("target") * F.col("w") / F.col("weighted")).otherwise(F.lit(0.0))
    rows = rows.select("r.*", "source_size", "target", F.least(expected, F.lit(most)).alias("expected"))
    # Rounding must not turn exact copies into almost one more.
    rows = rows.withColumn("copies", F.floor(F.col("expected") + 1e-9).cast("long"))
    part = F.greatest(F.col("expected") - F.col("copies"), F.lit(0.0))
    odds = _uniform(seed) / (1 - _uniform(seed)) * (1 - part) / part
    rank = F.when(part > 1e-9, odds / (1 + odds)).otherwise(F.lit(2.0))
    rows, _ = stage(rows.withColumn("rank", rank), "ranked")

    def room(table: DataFrame) -> DataFrame:
        used = table.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("used")).alias("u")
        return goal.alias("g").join(used, F.col("g.source").eqNullSafe(F.col("u.source"))).select(
            "g.source", (F.col("target") - F.col("used")).alias("goal")
        )

    for turn in range(DRAWS):
        drawn = (F.col("rank") < 1) & (F.col("size") > 0) & (F.col("copies") + 1 <= most)
        gap = room(rows)
        if turn:
            gap, _ = stage(gap, "gap")
            rows = rows.alias("r").join(F.broadcast(gap).alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
            rows = rows.select("r.*", "goal")
            drawn &= ~F.col("chosen") & (F.col("size") <= F.col("goal"))
            rows = rows.withColumn("drawn", drawn).drop("chosen", "goal")
        else:
            gap, _ = stage(gap, "gap")
            rows = rows.withColumn("drawn", drawn)
        took = _taken(rows.filter("drawn").drop("drawn"), gap, 0.5 if turn == DRAWS - 1 else 0.0)
        rest = rows.filter("NOT drawn").drop("drawn").withColumn("chosen", F.lit(False))
        rows, _ = stage(took.unionByName(rest).withColumn("copies", F.col("copies") + F.col("chosen").cast("long")), "drawn")
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
