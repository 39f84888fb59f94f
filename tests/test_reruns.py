"""Batches that are run again, corrected, broken or out of order; sessions of other zones."""

from __future__ import annotations

import contextlib
import shutil

import pytest
from pyspark.sql import functions as F

from tallymart.functions.clock import as_timestamp, iso_text, utc_date
from tallymart.plans import gold, medallion, run_log, silver
from tallymart.sources.csv_feeds import FeedContractError
from tallymart.sources.tables import LayerStore
from tests.test_medallion import CLEAN, INVENTORY, STORES, TX_HEADER, feeds, sales, tx

AS_OF = "2024-02-01 00:00:00"


@contextlib.contextmanager
def conf(spark, **values):
    keys = {k.replace("_", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def whole(store: LayerStore) -> tuple[int, int]:
    """Silver and quarantine are all of bronze, and apart."""
    transactions = store.read("silver/transactions")
    held = silver.current_quarantine(store.read("quarantine/raw_transactions"), transactions)
    assert transactions.count() + held.count() == store.read("bronze/raw_transactions").count()
    assert silver.silver_keys(transactions).intersect(held.select("_batch_id", "_id")).count() == 0
    ids = transactions.select("transaction_id")
    assert ids.distinct().count() == ids.count()
    return transactions.count(), held.count()


def test_rerun_under_other_splits_keeps_row_ids(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    text = TX_HEADER + "".join(tx(i, quantity="-1" if i % 40 == 7 else "2") for i in range(400))
    paths = feeds(tmp_path, "b1", text)
    medallion.run(spark, store.root, paths, AS_OF, batch_id="b1")
    before = whole(store), sales(store)
    with conf(spark, spark_sql_files_maxPartitionBytes="4096", spark_sql_files_openCostInBytes="1"):
        medallion.run(spark, store.root, paths, AS_OF, batch_id="b1")
    assert before == (whole(store), sales(store)) and before[0] == (390, 10)


def test_same_run_id_twice(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    for stores in (STORES, STORES.replace("North", "Renamed")):
        paths = feeds(tmp_path, f"b{len(stores)}", CLEAN, stores)
        medallion.run(spark, store.root, paths, AS_OF, run_id="r1", reload=True)
    names = {r.store_id: r.store_name for r in store.read("silver/stores").collect()}
    assert names == {1: "Renamed", 2: "South"}
    assert whole(store) == (40, 0)


def test_corrected_batch_replaces_its_rows_everywhere(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    long = "9,Extra,Oslo,EU,outlet,2019-05-01,surplus\n"
    first = CLEAN + tx(500, transaction_ts="2023-07-01 10:00:00") + tx(501, quantity="0")
    medallion.run(spark, store.root, feeds(tmp_path, "a", first, STORES + long), AS_OF, batch_id="a")
    # Row 500 of the second batch is a duplicate until the first batch no longer has it.
    second = TX_HEADER + tx(500, transaction_ts="2023-08-01 10:00:00") + "".join(tx(i) for i in range(600, 640))
    medallion.run(spark, store.root, feeds(tmp_path, "b", second), AS_OF, batch_id="b")
    assert whole(store) == (81, 2)
    assert store.read("quarantine/rejected_records").count() == 1
    assert ("2023-07-01", 1) in sales(store)
    medallion.run(spark, store.root, feeds(tmp_path, "a2", CLEAN), AS_OF, batch_id="a", reload=True)
    assert whole(store) == (81, 0)
    assert store.read("quarantine/rejected_records").count() == 0
    got = sales(store)
    assert ("2023-07-01", 1) not in got and got[("2023-08-01", 1)][2] == 1


def test_empty_feed_replaces_the_old_rows(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN), AS_OF, batch_id="a")
    medallion.run(spark, store.root, feeds(tmp_path, "b", CLEAN.replace("2024-01", "2024-01"), STORES, INVENTORY) | {
        "raw_transactions": feeds(tmp_path, "c", TX_HEADER + tx(900))["raw_transactions"]}, AS_OF, batch_id="b")
    header = TX_HEADER
    empty = feeds(tmp_path, "d", header, STORES.split("\n")[0] + "\n", INVENTORY.split("\n")[0] + "\n")
    medallion.run(spark, store.root, empty, AS_OF, batch_id="b", reload=True)
    for feed in ("raw_stores", "raw_inventory", "raw_transactions"):
        assert store.read(f"bronze/{feed}").filter("_batch_id = 'b'").count() == 0
        assert store.read(f"quarantine/{feed}").filter("_batch_id = 'b'").count() == 0
    assert whole(store) == (40, 0)


def test_line_break_in_quotes_fails_the_batch_with_advice(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    broken = STORES.replace("1,North", '1,"No\nrth"')
    last = STORES.replace("2019-05-01", '"2019-\n05-01"')
    for name, text in (("a", broken), ("b", last)):
        with pytest.raises(FeedContractError, match="multi_line"):
            medallion.run(spark, store.root, feeds(tmp_path, name, CLEAN, text), AS_OF, batch_id=name)
    assert store.read("bronze/raw_stores").count() == 0
    rejects = store.read("quarantine/rejected_records").filter("_batch_id = 'a'").collect()
    assert {r.record for r in rejects} == {'1,"No', 'rth",Oslo,EU,flagship,2019-05-01'}
    paths = feeds(tmp_path, "c", CLEAN, broken)
    medallion.run(spark, store.root, paths, AS_OF, batch_id="c", multi_line=True)
    assert {r.store_name for r in store.read("silver/stores").collect()} == {"No\nrth", "South"}


def test_unknown_feed_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="raw_inventry"):
        medallion.run(spark, str(tmp_path / "lake"), {"raw_inventry": "x.csv"}, AS_OF)


def test_lost_version_is_an_error(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN), AS_OF, batch_id="a")
    shutil.move(f"{store.root}/silver/stores", str(tmp_path / "elsewhere"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("silver/stores").count()


def test_older_batch_does_not_overwrite_newer_rows(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    newest = INVENTORY.replace("1,10,5,10", "1,10,99,10")
    medallion.run(spark, store.root, feeds(tmp_path, "new", CLEAN, STORES, newest), "2024-03-01 00:00:00", batch_id="new")
    old = STORES.replace("North", "Formerly") + "7,Only here,Oslo,EU,outlet,2019-05-01\n"
    more = TX_HEADER + tx(700)
    medallion.run(spark, store.root, feeds(tmp_path, "old", more, old), "2024-02-01 00:00:00", batch_id="old")
    stock = store.read("silver/inventory").filter("store_id = 1 and product_id = 10").first()
    assert stock.stock_level == 99
    names = {r.store_id: r.store_name for r in store.read("silver/stores").collect()}
    assert names == {1: "North", 2: "South", 7: "Only here"}


def test_step_counts_are_stored(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    result = medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN), AS_OF, run_id="r")
    steps = {r.step: r.rows for r in store.read("bronze/run_steps").collect()}
    assert steps == result.steps == {
        "raw_stores": 3, "raw_inventory": 5, "raw_transactions": 40, "silver_stores": 2,
        "silver_inventory": 3, "silver_transactions": 40, "quarantined": 0,
        "gold_daily_sales": 2, "gold_inventory_health": 2,
    }


def test_staged_folders_are_deleted_at_the_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallymart.session.shared_folder", lambda _: str(tmp_path / "shared"))
    medallion.run(spark, str(tmp_path / "lake"), feeds(tmp_path, "a", CLEAN), AS_OF)
    left = [p for p in (tmp_path / "shared" / "tallymart").glob("*/part-*.parquet")]
    assert left == []


@pytest.mark.parametrize("zone", ["America/New_York", "America/Sao_Paulo"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    def rows():
        bronze = spark.createDataFrame(
            [
                (i, f"{i:08x}-0000-0000-0000-000000000000", "1", "1", "2", "1.50", ts, "card", "1")
                for i, ts in enumerate(
                    ["2018-11-04 00:00:00", "2018-11-04T00:30:00Z", "2018-11-04", "2018-03-11 02:30:00", "2018-11-03 23:59:59+00:00"]
                )
            ],
            "_id long, transaction_id string, store_id string, product_id string, quantity string,"
            " unit_price string, transaction_ts string, payment_method string, cashier_id string",
        ).withColumns({"_ingested_at": as_timestamp(AS_OF), "_batch_id": F.lit("b")})
        tx = silver.silver_transactions(bronze, AS_OF)
        stores = spark.range(1).select(F.lit(1).alias("store_id"), F.lit("S").alias("store_name"))
        days = gold.daily_store_sales(tx, stores, AS_OF)
        events = spark.range(1).select(
            F.lit("r").alias("run_id"), F.lit("f").alias("flow_name"), F.lit(0).alias("seq"),
            as_timestamp("2024-01-01T00:00:00Z").alias("ts"), F.lit("success").alias("status"),
            *[F.lit(None).cast("long").alias(c) for c in ("records_loaded", "records_quarantined")],
            F.lit(None).cast("string").alias("error_message"),
        )
        return (
            sorted((r[0], r[1], str(r[2])) for r in tx.select("transaction_id", F.unix_micros("transaction_ts"), "txn_month").collect()),
            sorted((str(r.report_date), r.transaction_count, str(r.sales_month)) for r in days.collect()),
            run_log.last_run_status(run_log.fold_runs(events)).first().last_pipeline_run,
            spark.range(1).select(iso_text(as_timestamp(AS_OF)), utc_date(as_timestamp(AS_OF)).cast("string")).first()[:],
        )

    expected = rows()
    with conf(spark, spark_sql_session_timeZone=zone):
        assert rows() == expected
    assert expected[2] == "2024-01-01T00:00:00+00:00" and expected[3] == ("2024-02-01T00:00:00+00:00", "2024-02-01")
    assert expected[1] == [("2018-03-11", 1, "2018-03-01"), ("2018-11-03", 1, "2018-11-01"), ("2018-11-04", 3, "2018-11-01")]
