"""What the lake queries leave on disk while they run: shuffle files, CSV files, replaced segments."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymart import queries
from tallymart.plans import medallion
from tallymart.session import shuffles_freed, stage, together
from tallymart.sources.tables import LayerStore
from tests.test_large_batches import AS_OF, bronze


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in folders for p in Path(d).rglob("shuffle_*.data")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """F2 to F4, F6 to F8, F11: they went when the driver collected its garbage, if at all."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = spark.range(20_000).select(F.col("id"), F.col("id").cast("string").alias("t"))
    before, was = shuffle_files(spark), spark.conf.get(setting)
    kept, n = stage(rows.repartition(3, "t"), "kept")
    stores = bronze(spark, str(tmp_path / "b"), "raw_stores", [(i, "b", AS_OF, str(i), "n", "c", "r", "t", "2020-01-01") for i in range(9)])
    LayerStore(spark, str(tmp_path / "lake")).append(stores.repartition(3, "store_id"), "bronze/raw_stores")
    path = queries._csv(stores.repartition(3, "store_id"), "raw_stores")
    deadline = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left and n == kept.count() == 20_000
    assert spark.read.option("header", True).csv(path).count() == 9
    assert spark.conf.get(setting) == was
    with shuffles_freed(spark), shuffles_freed(spark):
        assert spark.conf.get(setting) == "true"
    assert spark.conf.get(setting) == was


def test_csv_files_are_there_from_first_load_to_last(spark, monkeypatch):
    """F2 to F4, F6 to F8, F11: all batches' files were written first and kept to the end."""
    seen, made = [], {}

    def batch(spark, sf_dir, number):
        made[number] = queries._csv(spark.range(1).select(*[F.lit("1").alias(c) for c in queries.S.FEED_COLUMNS["raw_stores"]]), "raw_stores")
        return {"raw_stores": made[number]}

    def there() -> list[int]:
        return sorted(b for b, path in made.items() if Path(path).exists())

    monkeypatch.setattr(queries, "_batch", batch)
    monkeypatch.setattr(queries, "_load", lambda store, name, paths, at: seen.append((name, "load", there())))
    monkeypatch.setattr(medallion, "refresh", lambda store, name, batches, at: seen.append((name, "refresh", there())))
    queries._lake(spark, "none", [1, 2, 2])
    assert seen == [
        ("batch-1", "load", [1]), ("batch-1", "refresh", []), ("batch-2", "load", [2]), ("batch-2", "refresh", [2]),
        ("batch-2", "load", [2]), ("batch-2", "refresh", []),
    ]
    assert there() == [] and len(made) == 2


def test_expire_keeps_what_an_intent_names(spark, tmp_path):
    """Old bronze of a reload is in no table any more, but the next run still reads it."""
    store, name, batch = LayerStore(spark, str(tmp_path / "lake")), "bronze/raw_stores", {"_batch_id": "b"}
    rows = [bronze(spark, str(tmp_path / str(i)), "raw_stores", [(i, "b", AS_OF, str(i), "n", "c", "r", "t", "2020-01-01")]) for i in (1, 2)]
    store.append(rows[0], name)
    old = store.segments_of(name, batch)
    segment = store.write(rows[1], name, values=batch)
    with store.transaction() as tx:
        tx.intend("b", {"raw_stores": old})
        store.replace(segment, [batch])
    store.expire(keep=1, grace_hours=0)
    assert [r["store_id"] for r in store.read_segments(name, old).collect()] == ["1"]
    with store.transaction() as tx:
        tx.intend("b", None)
    assert store.expire(keep=1, grace_hours=0)[1] == 1
    assert [r["store_id"] for r in store.read(name).collect()] == ["2"]


def test_jobs_side_by_side_return_in_order_and_raise(spark):
    """a slow first job doesn't keep the second from running."""
    begun = []

    def first():
        deadline = time.time() + 10
        while not begun and time.time() < deadline:
            time.sleep(0.05)
        return spark.range(3).count() if begun else None

    assert together(spark, first, lambda: begun.append(1)) == [3, None]
    with pytest.raises(ValueError, match="second"):
        together(spark, lambda: spark.range(1).count(), lambda: int("second"))
