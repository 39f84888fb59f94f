"""Connected components of an edge table as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.session import stage

EDGE = "a long, b long"


def union_find(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Smallest member of each node's group, for the nodes of the given pairs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of each batch by the stars of its groups; connectivity stays."""
    for batch in batches:
        a, b = (batch.column(i).to_pylist() for i in (0, 1))
        stars = [(x, r) for x, r in union_find(zip(a, b, strict=True)).items() if x != r]
        if stars:
            x, r = zip(*stars, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(r, pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of all nodes in ``edges(a, b)``; root is the smallest node reached.

    Union-find shrinks what each task holds to stars; then the large-star and small-star
    steps alternate until no edge changes. Every round is written to the shared folder.
    A node of any degree is safe: its neighbours are reduced by a partial minimum, and the
    join on it is a plain equality join that AQE can split.
    """
    e = edges.filter("a <> b").mapInArrow(_contract, EDGE).distinct()
    e, n = stage(e, "edges")
    state = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        small = small.select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*")
        e, n = stage(small.filter("a <> b").distinct(), "edges")
        seen = e.agg(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[0]
        if state == (n, seen):
            break
        state = (n, seen)
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
