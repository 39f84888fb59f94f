"""Filters of keys and stored metrics: runs read no old rows and say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import key_filter
from tallymart.plans import gold, medallion, metrics, quality, serving, silver
from tallymart.sources.tables import LayerStore
from tests.test_medallion import CLEAN, INVENTORY, STORES, TX_HEADER, feeds, tx
from tests.test_snapshots import reload, two_batches

AS_OF = "2024-02-01 00:00:00"
NONE = STORES.split("\n")[0] + "\n", INVENTORY.split("\n")[0] + "\n"


def test_filters_find_every_key_and_few_others(spark):
    rows = spark.range(6000).selectExpr("concat('k', id) as transaction_id", "date_add(date'2024-01-01', int(if(id < 3000, 0, id % 40) * 31)) as txn_month")
    filters = key_filter.build(rows, ["transaction_id"], "txn_month").cache()
    assert filters.filter("level > 8").count() and filters.filter("level < 6").count()  # by the month's rows
    wanted = spark.range(0, 8000, 2).selectExpr("concat('k', id) as transaction_id")
    found = key_filter.possible(filters, wanted, ["transaction_id"], "txn_month")
    real = rows.join(wanted, "transaction_id")
    assert real.join(found, ["transaction_id", "txn_month"], "left_anti").count() == 0
    false = found.join(rows, ["transaction_id", "txn_month"], "left_anti").count()
    assert false < 0.03 * 4000 * 40
    # Filters of one month that were written apart count together.
    one, two = rows.filter("transaction_id < 'k4'"), rows.filter("transaction_id >= 'k4'")
    both = key_filter.build(one, ["transaction_id"], "txn_month").union(key_filter.build(two, ["transaction_id"], "txn_month"))
    found = key_filter.possible(both, wanted, ["transaction_id"], "txn_month")
    assert real.join(found, ["transaction_id", "txn_month"], "left_anti").count() == 0
    assert key_filter.possible(filters.limit(0), wanted, ["transaction_id"], "txn_month").collect() == []


def test_months_without_a_possible_hit_are_not_opened(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    months = "".join(tx(100 * m + i, transaction_ts=f"2023-{m:02d}-15 10:00:00") for m in range(1, 13) for i in range(10))
    medallion.run(spark, store.root, feeds(tmp_path, "a", TX_HEADER + months), AS_OF, batch_id="a")
    ids = [f"{i:08x}-0000-0000-0000-000000000000" for i in (305, 777_777)]
    candidates = spark.createDataFrame([(i,) for i in ids], "transaction_id string")
    places = metrics.possible_places(store, candidates)
    opened = {f.split("txn_month=")[1][:10] for f in metrics.known_transactions(store, places).inputFiles() if "silver/transactions/" in f}
    assert "2023-03-01" in opened and len(opened) <= 3
    assert [r.transaction_id for r in metrics.known_transactions(store, places).collect()] == ids[:1]


def full_report(store: LayerStore, as_of) -> list:
    transactions = store.read("silver/transactions")
    held = silver.current_quarantine(store.read("quarantine/raw_transactions"), transactions)
    report = quality.quality_report(
        store.read("bronze/raw_transactions"), held, transactions, store.read("silver/stores"), store.read("gold/daily_store_sales"), as_of)
    return sorted(map(tuple, report.collect()))


def same(store: LayerStore, as_of=AS_OF) -> None:
    report = metrics.stored_report(store, as_of)
    assert sorted(map(tuple, report.collect())) == full_report(store, as_of)
    files = [f for f in report.inputFiles() if "/silver/transactions/" in f or "/bronze/" in f or "/gold/" in f]
    assert not files
    held = silver.current_quarantine(store.read("quarantine/raw_transactions"), store.read("silver/transactions"))
    assert sorted(map(repr, metrics.current_quarantine(store).collect())) == sorted(map(repr, held.select(*metrics.current_quarantine(store).columns).collect()))


def test_the_stored_report_is_the_full_one(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    ahead = tx(201, transaction_ts="2024-03-05 09:00:00") + tx(202, transaction_ts="2024-03-06 09:00:00") + tx(3, quantity="0")
    medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN + ahead), AS_OF, batch_id="a")
    same(store)
    assert store.read("quarantine/raw_transactions").filter(F.col("reject_rule") == silver.FUTURE_RULE).count() == 2
    # One held row's date has passed; the store without sales is new.
    stores = STORES + "9,Idle,Lund,EU,outlet,2024-01-01\n"
    later = "2024-03-05 12:00:00"
    medallion.run(spark, store.root, feeds(tmp_path, "b", TX_HEADER + tx(300) + tx(5), stores, NONE[1]), later, batch_id="b")
    same(store, later)
    log = store.read("quarantine/recovered").collect()
    assert len(log) == 1 and log[0]._batch_id == "a"
    states = sorted((r._batch_id, r.change, r.reject_rule) for r in metrics.quarantine_states(store).collect())
    assert states == [
        ("a", "held", silver.FUTURE_RULE), ("a", "held", "quantity_not_positive"), ("a", "recovered", silver.FUTURE_RULE),
        ("b", "held", silver.DUPLICATE_RULE),
    ]
    # An earlier clock makes rows of silver future ones again: their months are read for it.
    report = {r.check_name: r for r in metrics.stored_report(store, AS_OF).collect()}
    assert report["no_future_transactions"].result == 1 and not report["no_future_transactions"].passed
    assert sorted(map(tuple, report.values())) == full_report(store, AS_OF)
    # The first batch again: what had recovered is no longer held at all.
    medallion.run(spark, store.root, {}, later, batch_id="a", replay=True)
    same(store, later)
    assert store.read("quarantine/recovered").count() == 0


def test_a_batch_reads_only_its_own_sales_and_gold_is_the_recount(spark, tmp_path, monkeypatch):
    store = LayerStore(spark, str(tmp_path / "lake"))
    unknown = tx(400, store_id="9", transaction_ts="2023-11-03 08:00:00")
    medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN + unknown), AS_OF, batch_id="a")
    old = {s for names in store.snapshot().tables["silver/transactions"].values() for s in names}
    read, real = [], LayerStore._read_folders

    def noted(self, name, parts):
        read.extend((name, s) for names in parts.values() for s in names)
        return real(self, name, parts)

    monkeypatch.setattr(LayerStore, "_read_folders", noted)
    stores = STORES + "9,Late,Lund,EU,outlet,2024-01-01\n"
    fresh = TX_HEADER + "".join(tx(i, store_id=str(1 + i % 2), unit_price="3.25") for i in range(5000, 5030))
    medallion.run(spark, store.root, feeds(tmp_path, "b", fresh, stores, NONE[1]), AS_OF, batch_id="b")
    monkeypatch.undo()
    assert {s for name, s in read if name == "silver/transactions"}.isdisjoint(old)
    assert {s for name, s in read if name == "silver/transaction_metrics"} > set()
    columns = ["report_date", "store_id", "store_name", "total_revenue", "transaction_count", "avg_basket_size"]
    recount = gold.daily_store_sales(store.read("silver/transactions"), store.read("silver/stores"), AS_OF)
    rows = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert rows(store.read("gold/daily_store_sales")) == rows(recount)
    assert recount.filter("store_id = 9 and store_name = 'Late'").count() == 1


def test_stored_sums_and_report_are_those_of_silver_after_a_reload_too(spark, tmp_path):
    store, fixed = two_batches(spark, tmp_path, "lake")
    for step in range(2):
        sums = metrics.store_days(store, None)
        own = gold.store_days(store.read("silver/transactions"))
        assert sorted(map(tuple, sums.select(*own.columns).collect())) == sorted(map(tuple, own.collect()))
        same(store, "2024-02-03 00:00:00")
        if not step:
            reload(store, fixed)
    log = sorted((r._batch_id, r.change, r.reject_rule) for r in store.read("quarantine/changes").collect())
    assert log == [("b", "held", silver.DUPLICATE_RULE), ("b", "promoted", silver.DUPLICATE_RULE)]


def test_newest_sales_open_no_month_more_than_needed(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    days = [(f"2023-{m:02d}-{d:02d}", s) for m in range(1, 13) for d in range(1, 11) for s in (1, 2)]
    text = "".join(tx(i, transaction_ts=f"{day} 10:00:00", store_id=str(s)) for i, (day, s) in enumerate(days))
    medallion.run(spark, store.root, feeds(tmp_path, "a", TX_HEADER + text), AS_OF, batch_id="a")
    everything = store.read("gold/daily_store_sales")

    def opened(df):
        return sorted({f.split("sales_month=")[1][:7] for f in df.inputFiles()})

    for limit, months in ((20, ["2023-12"]), (21, ["2023-11", "2023-12"]), (100, None), (1000, None)):
        got = serving.newest_sales(store, limit=limit)
        assert got.collect() == serving.daily_sales(everything, limit=limit).collect()
        assert months is None or opened(got) == months
    assert len(opened(serving.newest_sales(store, limit=100))) == 5
    for kw in ({"store_id": 2, "limit": 15}, {"store_id": 1, "start_date": "2023-03-05", "end_date": "2023-07-04", "limit": 7},
               {"end_date": "2023-02-03", "limit": 9}, {"store_id": 7, "limit": 5}):
        limit = kw.pop("limit")
        got = serving.newest_sales(store, **kw, limit=limit)
        assert got.collect() == serving.daily_sales(everything, **kw, limit=limit).collect()
    assert opened(serving.newest_sales(store, store_id=2, limit=15)) == ["2023-11", "2023-12"]
    assert serving.newest_sales(LayerStore(spark, str(tmp_path / "none"))).collect() == []
