"""One commit shows a whole run or nothing of it; reloads survive being cut off anywhere."""

from __future__ import annotations

import json
import shutil

import pytest

from tallymart.plans import medallion, silver
from tallymart.sources import tables
from tallymart.sources.snapshots import CommitConflict, Snapshot, Transaction
from tallymart.sources.tables import BUCKET, TABLES, LayerStore
from tests.test_medallion import CLEAN, INVENTORY, STORES, TX_HEADER, feeds, sales, tx
from tests.test_reruns import whole

AS_OF = "2024-02-01 00:00:00"
SHOWN = ("silver/transactions", "silver/stores", "silver/inventory", "gold/daily_store_sales",
         "gold/inventory_health", "quarantine/raw_transactions")


class Cut(RuntimeError):
    pass


def content(store: LayerStore) -> dict[str, list]:
    """Rows of all derived tables without the clock's stamps."""
    out = {}
    for name in SHOWN:
        df = store.read(name)
        df = df.drop(*[c for c in df.columns if c in ("_transformed_at", "_refreshed_at", "_id", "_bronze_id", "_source_file")])
        out[name] = sorted(map(repr, df.collect()))
    return out


def test_a_run_cut_off_anywhere_shows_the_tables_before_or_after_it(spark, tmp_path, monkeypatch):
    store = LayerStore(spark, str(tmp_path / "lake"))
    medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN), AS_OF, batch_id="a")
    before = content(store)
    second = TX_HEADER + tx(3, unit_price="9.00") + "".join(tx(i, store_id="2") for i in range(300, 320)) + tx(9, quantity="0")
    paths = feeds(tmp_path, "b", second, STORES.replace("North", "Renamed"), INVENTORY.replace("1,10,5,10", "1,10,50,10"))
    write, commit = LayerStore.write, Transaction.commit
    seen, n, done = [], 0, False
    while not done:
        left = [n]

        def counted(f, left=left):
            def call(self, *args, **kwargs):
                out = f(self, *args, **kwargs)
                left[0] -= 1
                if left[0] == -1:
                    raise Cut()
                return out

            return call

        monkeypatch.setattr(LayerStore, "write", counted(write))
        monkeypatch.setattr(Transaction, "commit", counted(commit))
        try:
            medallion.run(spark, store.root, paths, AS_OF, batch_id="b")
            done = True
        except Cut:
            now = content(LayerStore(spark, store.root))
            seen.append(now == before)
            if now != before:
                after = now
                done = True
        n += 7
    monkeypatch.setattr(LayerStore, "write", write)
    monkeypatch.setattr(Transaction, "commit", commit)
    assert seen and seen[0]
    medallion.run(spark, store.root, paths, AS_OF, batch_id="b")
    fresh = LayerStore(spark, str(tmp_path / "fresh"))
    medallion.run(spark, fresh.root, {k: v.replace("/b/", "/a/") for k, v in paths.items()}, AS_OF, batch_id="a")
    medallion.run(spark, fresh.root, paths, AS_OF, batch_id="b")
    assert content(store) == content(fresh) != before
    if seen[-1] is False:
        assert after == content(fresh)
    assert whole(store) == (60, 2)


def test_of_two_writers_one_fails_and_unrelated_ones_do_not(spark, tmp_path):
    root = str(tmp_path / "lake")
    one, two = LayerStore(spark, root), LayerStore(spark, root)
    rows = spark.range(3).selectExpr("'r' run_id", "cast(id as string) step", "id rows")
    one.append(rows, "bronze/run_steps")
    with pytest.raises(CommitConflict, match="silver/stores"):
        with one.transaction():
            one.read("silver/stores").count()
            one.append(rows, "bronze/run_steps")
            with two.transaction():
                two.replace_all(two.empty(tables.TABLES["silver/stores"].schema), "silver/stores")
    assert one.read("bronze/run_steps").count() == 3
    with one.transaction():  # both only add, so both come through
        one.append(rows, "bronze/run_steps")
        two.append(rows, "bronze/run_steps")
        assert one.read("bronze/run_steps").count() == 6
        assert two.read("bronze/run_steps").count() == 6
    assert one.read("bronze/run_steps").count() == 9
    assert one.log.numbers() == sorted(one.log.numbers()) and len(one.log.numbers()) == one.snapshot().number


def test_a_number_is_taken_once_and_names_are_not_lost(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    assert store.log.create(Snapshot(number=1)) and not store.log.create(Snapshot(number=1, marks={"x": {}}))
    assert store.log.at(1).marks == {}
    names = ["a b", "a/b=c", "ü%41{[*?", "x:y"]
    for i, name in enumerate(names):
        df = spark.range(i + 1).selectExpr(
            "'f' _source_file", "timestamp'2024-01-01' _rejected_at", "'r' _quarantine_reason", "cast(id as string) record")
        df = df.crossJoin(spark.createDataFrame([(name, "raw_stores")], "_batch_id string, source_table string"))
        store.append(df, "quarantine/rejected_records")
    for i, name in enumerate(names):
        assert store.read("quarantine/rejected_records", lambda p, name=name: p["_batch_id"] == name).count() == i + 1
    store.clear_partition("quarantine/rejected_records", {"_batch_id": names[1], "source_table": "raw_stores"})
    left = {r._batch_id for r in store.read("quarantine/rejected_records").collect()}
    assert left == set(names) - {names[1]}
    text = store.log.folder.read(f"{store.snapshot().number:020d}.json")
    assert json.loads(text)["number"] == store.snapshot().number


def test_a_pinned_reader_keeps_its_snapshot(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN), AS_OF, batch_id="a")
    pinned = store.at(store.snapshot().number)
    medallion.run(spark, store.root, feeds(tmp_path, "b", TX_HEADER + tx(700)), AS_OF, batch_id="b")
    assert (pinned.read("silver/transactions").count(), store.read("silver/transactions").count()) == (40, 41)
    with pytest.raises(RuntimeError, match="pinned"):
        pinned.mark("x", "y")


# --- reloads -----------------------------------------------------------------


_BUILT: dict[str, tuple] = {}


def two_batches(spark, tmp_path, name: str) -> tuple[LayerStore, dict]:
    """Batch a has X on Jan 5 and stores 1 to 5, batch b has X again on Jan 6; a's corrected
    files are without X, without store 4 and with other stock. Built once, then copied."""
    if not _BUILT:
        store = LayerStore(spark, str(tmp_path / "built"))
        folder = tmp_path / "built-in"
        folder.mkdir()
        x = tx(500, transaction_ts="2024-01-05 10:00:00")
        again = TX_HEADER + tx(500, transaction_ts="2024-01-06 10:00:00", store_id="2") + "".join(tx(i) for i in range(600, 630))
        more = STORES + "4,WRONG,Oslo,EU,outlet,2019-05-01\n5,Both,Oslo,EU,outlet,2019-05-01\n"
        sold = tx(510, store_id="4", transaction_ts="2023-12-24 09:00:00")
        a = feeds(folder, "a", CLEAN + x + sold, more, INVENTORY + "5,50,1,2,2024-01-01,8\n5,51,1,2,2024-01-01,8\n")
        b = feeds(folder, "b", again, STORES.replace("North", "Newer") + "5,Both II,Bern,EU,outlet,2019-05-01\n",
                  "store_id,product_id,stock_level,reorder_point,last_restocked,supplier_id\n5,50,9,2,2024-01-09,9\n")
        fixed = feeds(folder, "a2", CLEAN + sold, STORES.replace("South", "South fixed"),
                      INVENTORY.replace("1,20,100,50", "1,20,10,50") + "5,50,3,2,2024-01-02,7\n")
        medallion.run(spark, store.root, a, "2024-02-01 00:00:00", batch_id="a")
        medallion.run(spark, store.root, b, "2024-02-02 00:00:00", batch_id="b")
        _BUILT["lake"] = (store.root, fixed)
    root, fixed = _BUILT["lake"]
    shutil.copytree(root, tmp_path / name)
    return LayerStore(spark, str(tmp_path / name)), fixed


def reload(store: LayerStore, fixed: dict) -> None:
    medallion.run(store.spark, store.root, fixed, "2024-02-03 00:00:00", batch_id="a", reload=True)


def corrected(store: LayerStore) -> None:
    """What the tables must say once batch a is reloaded."""
    found = store.read("silver/transactions").filter("transaction_id like '000001f4-%'").collect()
    assert [(r._bronze_batch_id, str(r.txn_month)) for r in found] == [("b", "2024-01-01")]
    got = sales(store)
    assert ("2024-01-05", 1) not in got and got["2024-01-06", 2][2] == 1
    assert not any(s == 4 for _, s in got)  # its store is gone, and with it the sales of Dec 24
    assert whole(store)[1] == 0
    stores = {r.store_id: r.store_name for r in store.read("silver/stores").collect()}
    assert stores == {1: "Newer", 2: "South", 5: "Both II"}  # b came later than a's first load
    stock = {(r.store_id, r.product_id): (r.stock_level, r.supplier_id) for r in store.read("silver/inventory").collect()}
    assert stock == {(1, 10): (5, 1), (1, 20): (10, 2), (2, 40): (3, 4), (5, 50): (9, 7)}
    assert store.read("bronze/raw_stores").filter("store_name = 'WRONG'").isEmpty()
    assert store.intents() == {} and medallion.pending_batches(store, "a") == ["a"]


def test_a_reload_leaves_nothing_of_the_old_rows(spark, tmp_path):
    store, fixed = two_batches(spark, tmp_path, "lake")
    assert sales(store)["2023-12-24", 4][0] == "WRONG"
    reload(store, fixed)
    corrected(store)
    first = content(store)
    reload(store, fixed)  # again, with nothing to withdraw but itself
    corrected(store)
    assert content(store) == first


@pytest.mark.parametrize("step", ["withdraw", "refresh_inventory", "_mark_published"])
def test_a_reload_cut_off_anywhere_is_finished_by_the_next_run(spark, tmp_path, monkeypatch, step):
    store, fixed = two_batches(spark, tmp_path, "lake")
    before = content(store)
    real = getattr(medallion, step)

    def cut(*args, **kwargs):
        real(*args, **kwargs)
        raise Cut()

    monkeypatch.setattr(medallion, step, cut)
    with pytest.raises(Cut):
        reload(store, fixed)
    monkeypatch.undo()
    assert content(store) == before and set(store.intents()) == {"a"}
    if step == "withdraw":  # a run of another batch carries the intent out
        header = {k: v.split("\n")[0] + "\n" for k, v in (("s", STORES), ("i", INVENTORY))}
        medallion.run(spark, store.root, feeds(tmp_path, "c", TX_HEADER, header["s"], header["i"]), "2024-02-03 00:00:00", batch_id="c")
    else:
        reload(store, fixed)
    corrected(store)


def test_a_reload_between_two_feeds_keeps_the_old_rows_known(spark, tmp_path, monkeypatch):
    """Cut off when bronze has some of the corrected files, and loaded again."""
    store, fixed = two_batches(spark, tmp_path, "lake")
    real = medallion.ingest_feed

    def cut(store, feed, *args, **kwargs):
        if feed == "raw_transactions":
            raise Cut()
        return real(store, feed, *args, **kwargs)

    for _ in range(2):
        monkeypatch.setattr(medallion, "ingest_feed", cut)
        with pytest.raises(Cut):
            reload(store, fixed)
        monkeypatch.undo()
    reload(store, fixed)
    corrected(store)


# --- buckets -----------------------------------------------------------------


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    rows = "".join(f"{i % 20},{i},5,10,2024-01-01,1\n" for i in range(400))
    header = INVENTORY.split("\n")[0] + "\n"
    medallion.run(spark, store.root, feeds(tmp_path, "a", CLEAN, inventory=header + rows), AS_OF, batch_id="a")
    old = store.snapshot().tables["silver/inventory"]
    assert len(old) > 50
    medallion.run(spark, store.root, feeds(tmp_path, "b", TX_HEADER, inventory=header + "3,23,77,10,2024-01-09,2\n"), AS_OF, batch_id="b")
    new = store.snapshot().tables["silver/inventory"]
    changed = {p for p in new if new[p] != old.get(p)}
    touched = spark.range(1).selectExpr("cast(3 as int) store_id", "cast(23 as int) product_id")
    (bucket,) = touched.select(TABLES["silver/inventory"].bucket).first()
    assert changed == {f"{BUCKET}={bucket}"} and set(new) == set(old)
    row = store.read("silver/inventory").filter("store_id = 3 and product_id = 23").collect()
    assert [(r.stock_level, r.supplier_id) for r in row] == [(77, 1)]
    assert store.read("silver/inventory").count() == 400
    assert silver.silver_keys(store.read("silver/transactions")).count() == 40


# --- upkeep ------------------------------------------------------------------


def files(root) -> list[str]:
    return [str(p) for p in root.rglob("*") if p.is_file() and p.suffix in (".parquet", ".json")]


def test_many_commits_leave_few_files_and_pinned_readers_go_on(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    for i in range(24):
        store.append(spark.range(1).selectExpr(f"'r{i}' run_id", "'s' step", f"{i}L rows"), "bronze/run_steps")
    assert len(files(tmp_path / "lake")) >= 48
    pinned = store.at(store.snapshot().number)
    assert store.compact("bronze/run_steps", 30) == 0 and store.compact("bronze/run_steps") == 1
    assert store.expire(keep=2, grace_hours=1) == (23, 0)  # what was just written may be about to be committed
    assert store.expire(keep=2, grace_hours=0) == (0, 0)  # the snapshot before still names it
    assert pinned.read("bronze/run_steps").count() == 24
    rows = store.read("bronze/run_steps")
    assert sorted(r.rows for r in rows.collect()) == list(range(24))
    assert store.expire(keep=1, grace_hours=0) == (1, 24)
    assert len(files(tmp_path / "lake")) < 20
    assert sorted(r.rows for r in rows.collect()) == list(range(24))


def test_compaction_of_partitions_keeps_their_rows(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    for name, i in (("a", 0), ("b", 700), ("c", 800)):
        medallion.run(spark, store.root, feeds(tmp_path, name, CLEAN if not i else TX_HEADER + tx(i)), AS_OF, batch_id=name)
    before = content(store), sorted(map(repr, store.read("silver/transaction_filters").collect()))
    assert [len(s) for s in store.snapshot().tables["silver/transactions"].values()] == [3]
    for name in ("silver/transactions", "silver/transaction_filters", "silver/transaction_metrics"):
        assert store.compact(name) == 1
    assert (content(store), sorted(map(repr, store.read("silver/transaction_filters").collect()))) == before
    store.expire(keep=1, grace_hours=0)
    medallion.run(spark, store.root, feeds(tmp_path, "d", TX_HEADER + tx(700) + tx(900)), AS_OF, batch_id="d")
    assert whole(store) == (43, 1)
