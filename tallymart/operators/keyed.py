"""Keep-one-per-key, match exclusion and keyed merges on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order``.

    The rank filter lets Spark keep one row per key on each map task before the
    shuffle, so a key that holds a large share of all rows sends one row per task.
    The hash leads the sort: comparing it decides nearly all pairs, where long or
    alike keys would be compared in full.
    """
    window = Window.partitionBy("_key_hash", *keys).orderBy(*order)
    return (
        df.withColumn("_key_hash", F.xxhash64(*keys))
        .withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_key_hash")
    )


def without_match(df: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``others``."""
    return df.join(others.select(*keys), list(keys), "left_anti")


def known_keys(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``incoming`` that ``current`` has already.

    Few incoming keys are broadcast and the large table is only scanned; many make both
    sides shuffle by key. Only key columns take part.
    """
    return current.select(*keys).join(incoming.select(*keys), list(keys), "left_semi")


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` (unique keys) whose key ``current`` does not have yet.

    ``incoming`` is read twice, so it should be a stored frame rather than a long plan.
    """
    return without_match(incoming, known_keys(current, incoming, keys), keys)


def merge_upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    newer_by: str | None = None,
    withdrawn: Column | None = None,
) -> DataFrame:
    """Full content after an upsert; keys are unique on both sides.

    On a key both sides have, ``update_cols`` come from ``incoming`` and every other
    column keeps its current value. With ``newer_by`` an incoming row that is older in
    that column changes nothing; a missing value is older than any. Current rows for which
    ``withdrawn`` holds are left out if ``incoming`` has nothing of their key.
    """
    values = [c for c in current.columns if c not in keys]
    gone = F.lit(False) if withdrawn is None else F.coalesce(withdrawn, F.lit(False))
    old = current.select(*keys, F.struct(*values).alias("_old"), gone.alias("_gone"))
    new = incoming.select(*keys, F.struct(*values).alias("_new"))
    joined = old.join(new, list(keys), "full_outer")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    if withdrawn is not None:
        joined = joined.filter(has_new | ~F.col("_gone"))
    fresh = has_new
    if newer_by:
        seen = F.col(f"_old.{newer_by}")
        fresh = has_new & (seen.isNull() | F.coalesce(F.col(f"_new.{newer_by}") >= seen, F.lit(False)))
    picked = []
    for name in values:
        take_new = has_new & ~has_old
        if name in update_cols:
            take_new = take_new | fresh
        picked.append(
            F.when(take_new, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}")).alias(name)
        )
    return joined.select(*keys, *picked).select(*current.columns)
