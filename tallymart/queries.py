"""Registered queries: every job over the feeds derived from the given tables."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart import schemas as S
from tallymart.functions.clock import utc_date, utc_micros, utc_text
from tallymart.functions.exact import percentage
from tallymart.operators.keyed import insert_if_absent, merge_upsert
from tallymart.plans import gold, medallion, metrics, quality, run_log, serving, silver
from tallymart.session import scratch_path, shuffles_freed, stage, together
from tallymart.sources import testdata as feeds
from tallymart.sources.csv_feeds import FeedContractError
from tallymart.sources.snapshots import Folder
from tallymart.sources.tables import LayerStore

Query = Callable[[SparkSession, str], DataFrame]

AUDIT_COLUMNS = ["_transformed_at", "_refreshed_at", "_ingested_at"]


def comparable(df: DataFrame) -> DataFrame:
    """Columns in types both engines print alike: money, days and times as text.

    Only the registered results pass through here; the jobs keep DECIMAL, DATE, TIMESTAMP.
    """
    shown = []
    for field in df.schema:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            col = F.concat(utc_text(col), F.lit("."), utc_micros(col))
        shown.append(col.alias(field.name))
    return df.select(*shown)


# --- shared inputs ----------------------------------------------------------


def _transaction_order():
    """Order of equal ids in the derived feed, which has no load order of its own."""
    return [
        F.col(c).asc()
        for c in ("transaction_ts", "store_id", "product_id", "quantity", "unit_price")
    ]


def _inventory_order():
    return [F.col(c).desc() for c in ("_ingested_at", "stock_level", "reorder_point")]


def _transactions(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    raw = feeds.raw_transactions(spark, sf_dir, batch)
    return silver.silver_transactions(raw, feeds.AS_OF, _transaction_order())


def _inventory(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    raw = feeds.raw_inventory(spark, sf_dir, batch)
    return silver.silver_inventory(raw, feeds.AS_OF, _inventory_order())


def _stores(spark: SparkSession, sf_dir: str, revision: int = 1) -> DataFrame:
    return silver.silver_stores(feeds.raw_stores(spark, sf_dir, revision), feeds.AS_OF)


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.raw_transactions(spark, sf_dir)
    return silver.quarantine_transactions(raw, _transactions(spark, sf_dir), feeds.AS_OF)


def _daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_store_sales(
        _transactions(spark, sf_dir), _stores(spark, sf_dir), feeds.AS_OF
    )


def _staged(df: DataFrame, name: str) -> DataFrame:
    """A table that several parts of one query read is written once in the shared folder."""
    return stage(df, name)[0]


def _merged_transactions(spark: SparkSession, sf_dir: str, current: DataFrame) -> DataFrame:
    incoming = _staged(_transactions(spark, sf_dir, 2), "transactions")
    return current.unionByName(insert_if_absent(current, incoming, ["transaction_id"]))


def _merged_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the first batch; the later one is refreshed by the second batch."""
    first = _staged(_inventory(spark, sf_dir, 1), "inventory")
    earlier = gold.inventory_health(first, "1998-12-31", feeds.AS_OF)
    later = gold.inventory_health(first, feeds.AS_OF_DATE, feeds.AS_OF)
    incoming = gold.inventory_health(_inventory(spark, sf_dir, 2), feeds.AS_OF_DATE, feeds.AS_OF)
    return merge_upsert(
        earlier.unionByName(later), incoming, gold.HEALTH_KEY, gold.HEALTH_UPDATES
    )


# --- bronze and quarantine --------------------------------------------------


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.raw_transactions(spark, sf_dir).select(*S.FEED_COLUMNS["raw_transactions"])


def bronze_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.raw_inventory(spark, sf_dir).select(*S.FEED_COLUMNS["raw_inventory"])


def bronze_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.raw_stores(spark, sf_dir).select(*S.FEED_COLUMNS["raw_stores"])


def quarantine_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir).select(
        *S.FEED_COLUMNS["raw_transactions"], "_quarantine_reason", "reject_rule"
    )


def quarantine_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = silver.loss_by_rule(feeds.raw_transactions(spark, sf_dir), feeds.AS_OF)
    return lost.filter("rows > 0").select("reject_rule", "rows")


def flagged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.raw_transactions(spark, sf_dir)
    return silver.flagged_transactions(raw, _transactions(spark, sf_dir), feeds.AS_OF).select(
        *S.FEED_COLUMNS["raw_transactions"], "_is_quarantined", "_quarantine_reason"
    )


def quarantine_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of quarantined rows with and without repeated ids."""
    lost = silver.loss_by_rule(feeds.raw_transactions(spark, sf_dir), feeds.AS_OF)
    broken = F.when(F.col("reject_rule") != silver.DUPLICATE_RULE, F.col("rows"))
    counts = lost.agg(
        F.sum("seen").alias("total"),
        F.sum("rows").alias("held"),
        F.coalesce(F.sum(broken), F.lit(0)).alias("broken"),
    )
    return counts.select(
        percentage(F.col("held"), F.col("total")).alias("rate_all"),
        percentage(F.col("broken"), F.col("total")).alias("rate_without_duplicates"),
    )


def rejected_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = silver.classify_inventory(feeds.raw_inventory(spark, sf_dir))
    rejected = silver.rejected_rows(classified, "raw_inventory")
    return rejected.select(
        *S.FEED_COLUMNS["raw_inventory"], "_quarantine_reason", "reject_rule"
    )


def rejected_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = silver.classify_stores(feeds.raw_stores(spark, sf_dir))
    rejected = silver.rejected_rows(classified, "raw_stores")
    return rejected.select(*S.FEED_COLUMNS["raw_stores"], "_quarantine_reason", "reject_rule")


# --- silver -----------------------------------------------------------------


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transactions(spark, sf_dir).drop(
        "_bronze_batch_id", "_bronze_id", "txn_month", *AUDIT_COLUMNS
    )


def silver_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir).drop(*AUDIT_COLUMNS)


def silver_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stores(spark, sf_dir).drop(*AUDIT_COLUMNS)


# --- gold -------------------------------------------------------------------


def gold_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_sales(spark, sf_dir).drop("sales_month", *AUDIT_COLUMNS)


def gold_inventory_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = gold.inventory_health(_inventory(spark, sf_dir), feeds.AS_OF_DATE, feeds.AS_OF)
    return health.drop(*AUDIT_COLUMNS)


# --- merges of two batches --------------------------------------------------


def merge_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _staged(_transactions(spark, sf_dir, 1), "transactions")
    return _merged_transactions(spark, sf_dir, current).drop(
        "_bronze_batch_id", "_bronze_id", "txn_month", *AUDIT_COLUMNS
    )


def merge_upsert_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_upsert(
        _stores(spark, sf_dir, 1),
        _stores(spark, sf_dir, 2),
        ["store_id"],
        ["store_name", "city", "region", "store_type", "opened_date", "_transformed_at"],
    )
    return merged.drop(*AUDIT_COLUMNS)


def merge_upsert_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_upsert(
        _inventory(spark, sf_dir, 1),
        _inventory(spark, sf_dir, 2),
        ["store_id", "product_id"],
        ["stock_level", "reorder_point", "is_below_reorder", "last_restocked", "_transformed_at"],
    )
    return merged.drop(*AUDIT_COLUMNS)


def merge_upsert_inventory_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older batch comes last: it fills in what is missing and changes nothing else."""
    merged = merge_upsert(
        _inventory(spark, sf_dir, 2),
        _inventory(spark, sf_dir, 1),
        ["store_id", "product_id"],
        medallion.INVENTORY_UPDATES,
        "_ingested_at",
    )
    return merged.drop(*AUDIT_COLUMNS)


def merge_upsert_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the months that the second batch, or a store known since, can have changed."""
    first = _staged(_transactions(spark, sf_dir, 1), "transactions")
    old_stores, stores = _stores(spark, sf_dir, 1), _stores(spark, sf_dir, 2)
    current = _staged(gold.daily_store_sales(first, old_stores, feeds.AS_OF), "daily-sales")
    incoming = _staged(_transactions(spark, sf_dir, 2), "transactions")
    inserted = _staged(insert_if_absent(first, incoming, ["transaction_id"]), "inserted")
    months = medallion.touched_months(first, inserted, old_stores, stores)
    merged = medallion.merged_daily_sales(current, first.unionByName(inserted), stores, months, feeds.AS_OF)
    rest = current.filter(~F.col("sales_month").isin(months))
    return rest.unionByName(merged).drop("sales_month", *AUDIT_COLUMNS)


def merge_upsert_inventory_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_health(spark, sf_dir).drop(*AUDIT_COLUMNS)


# --- serving ----------------------------------------------------------------


def daily_sales_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.daily_sales(_daily_sales(spark, sf_dir)).drop(*AUDIT_COLUMNS)


def daily_sales_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.daily_sales(
        _daily_sales(spark, sf_dir), store_id=3, start_date="1998-03-01", end_date="1998-09-30"
    ).drop(*AUDIT_COLUMNS)


def _summary(period: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return serving.sales_summary(_daily_sales(spark, sf_dir), period, feeds.AS_OF_DATE)

    return query


def sales_summary_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window after the last sale still gives one row."""
    return serving.sales_summary(_daily_sales(spark, sf_dir), "7d", "2003-01-01")


def inventory_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.inventory_alerts(_inventory(spark, sf_dir), _stores(spark, sf_dir))


def inventory_health_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = _staged(_merged_health(spark, sf_dir), "health")
    return serving.health_snapshot(health).drop(*AUDIT_COLUMNS)


# --- quality and runs -------------------------------------------------------


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate comes from counts by rule: no row is matched with silver for it."""
    transactions = _staged(_transactions(spark, sf_dir), "transactions")
    stores = _stores(spark, sf_dir)
    lost = silver.loss_by_rule(feeds.raw_transactions(spark, sf_dir), feeds.AS_OF)
    lost = lost.agg(F.sum("rows").alias("held"), F.sum("seen").alias("total"))
    rate = lost.select(percentage(F.col("held"), F.col("total")).alias("quarantine_rate"))
    rows = gold.daily_store_sales(transactions, stores, feeds.AS_OF).agg(F.count(F.lit(1)).alias("rows"))
    return quality.report_of(quality.per_store(transactions, feeds.AS_OF), stores, rate, rows)


def stores_without_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.stores_without_sales(
        _stores(spark, sf_dir), _transactions(spark, sf_dir)
    ).select("store_id", "store_name")


def stores_without_recent_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = _transactions(spark, sf_dir).filter(utc_date(F.col("transaction_ts")) >= "2001-10-25")
    return quality.stores_without_sales(_stores(spark, sf_dir), recent).select(
        "store_id", "store_name"
    )


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log.fold_runs(feeds.run_events(spark, sf_dir))


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log.recent_runs(run_states(spark, sf_dir))


def last_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log.last_run_status(run_states(spark, sf_dir))


def run_states_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log appended in twelve commits, then compacted, with old snapshots and segments
    deleted."""
    store = LayerStore(spark, scratch_path(spark, "lake"))
    events = feeds.run_events(spark, sf_dir)
    for part in range(12):
        store.append(events.filter(F.pmod(F.xxhash64("run_id", "seq"), F.lit(12)) == part), "bronze/run_events")
    store.compact("bronze/run_events")
    store.expire(keep=1, grace_hours=0)
    if len(store.snapshot().segments()) != 1:
        raise RuntimeError("the run log is not compact")
    return medallion.runs(store)


# --- through files: CSV in, tables out --------------------------------------


def _csv(feed: DataFrame, name: str) -> str:
    """Write a derived feed as CSV files with ``NA`` for missing values."""
    path = scratch_path(feed.sparkSession, name)
    payload = feed.select(*S.FEED_COLUMNS[name])
    with shuffles_freed(feed.sparkSession):
        payload.write.option("header", True).option("escape", '"').option("nullValue", "NA").csv(path)
    return path


def _csvs(spark: SparkSession, inputs: dict[str, DataFrame]) -> dict[str, str]:
    return dict(zip(inputs, together(spark, *(functools.partial(_csv, df, feed) for feed, df in inputs.items())), strict=True))


def _delete(spark: SparkSession, paths: dict[str, str]) -> None:
    """CSV files that no later step reads."""
    for path in paths.values():
        Folder(spark, path).delete()


def _ordered_transactions(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Equal ids stand in one file in the order that the derived feed defines.

    Rows without an id are dealt out by product; the derived ids repeat a few times only.
    The ids begin alike, so a hash leads the sort: comparing it decides nearly all pairs.
    """
    raw = feeds.raw_transactions(spark, sf_dir, batch)
    order = [
        F.col("transaction_ts").try_cast("timestamp_ntz"), F.col("store_id").try_cast("int"),
        F.col("product_id").try_cast("int"), F.col("quantity").try_cast("int"),
        F.col("unit_price").try_cast("decimal(10,2)"),
    ]
    return raw.repartition(
        F.coalesce("transaction_id", "product_id")
    ).sortWithinPartitions(F.xxhash64("transaction_id"), "transaction_id", *order)


def _csv_ingest(name: str, feed: Callable[[SparkSession, str], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = LayerStore(spark, scratch_path(spark, "lake"))
        path = _csv(feed(spark, sf_dir), name)
        medallion.ingest_feed(store, name, path, "batch", feeds.AS_OF)
        return store.read(f"bronze/{name}").select(*S.FEED_COLUMNS[name])

    return query


def csv_ingest_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store names with a line break in quotes."""
    store = LayerStore(spark, scratch_path(spark, "lake"))
    broken = F.concat("store_name", F.lit("\n"), F.col("city"))
    path = _csv(feeds.raw_stores(spark, sf_dir).withColumn("store_name", broken), "raw_stores")
    medallion.ingest_feed(store, "raw_stores", path, "batch", feeds.AS_OF, multi_line=True)
    return store.read("bronze/raw_stores").select(*S.FEED_COLUMNS["raw_stores"])


def _ordered_inventory(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Of equal keys the newest row of the derived feed stands last in its file."""
    raw = feeds.raw_inventory(spark, sf_dir, batch)
    key, order = ["store_id", "product_id"], ["_ingested_at", F.col("stock_level").try_cast("int"), F.col("reorder_point").try_cast("int")]
    return raw.repartition("product_id").sortWithinPartitions(F.xxhash64(*key), *key, *order)


def _batch(spark: SparkSession, sf_dir: str, batch: int) -> dict[str, str]:
    inputs = {
        "raw_stores": feeds.raw_stores(spark, sf_dir, batch),
        "raw_inventory": _ordered_inventory(spark, sf_dir, batch),
        "raw_transactions": _ordered_transactions(spark, sf_dir, batch),
    }
    return _csvs(spark, inputs)


def _load(store: LayerStore, name: str, paths: dict[str, str], as_of=feeds.AS_OF, reload: bool = False) -> None:
    for feed, path in paths.items():
        medallion.ingest_feed(store, feed, path, name, as_of, reload=reload)


def _lake(spark: SparkSession, sf_dir: str, batches: list[int], as_of: dict[int, str] | None = None) -> LayerStore:
    """Tables after the given batches, from CSV files; a number may come again.

    A batch's files are there from its first load to its last. What a refresh has replaced is
    deleted, as nothing here reads older snapshots."""
    store, paths = LayerStore(spark, scratch_path(spark, "lake")), {}
    for i, batch in enumerate(batches):
        if batch not in paths:
            paths[batch] = _batch(spark, sf_dir, batch)
        name, at = f"batch-{batch}", (as_of or {}).get(batch, feeds.AS_OF)
        _load(store, name, paths[batch], at)
        if batch not in batches[i + 1 :]:
            _delete(spark, paths[batch])
        medallion.refresh(store, name, [name], at)
        store.expire(keep=1, grace_hours=0)
    return store


class _CutOff(RuntimeError):
    pass


@functools.lru_cache(maxsize=1)
def _reloaded_lake(spark: SparkSession, sf_dir: str) -> LayerStore:
    """Two batches, then corrected files of the first: no card sales, and no products that end
    in 4. The reload breaks off once, after it has taken the old sales out of silver.

    The queries that read this lake after one another in a session share it."""
    store = _lake(spark, sf_dir, [1, 2])
    fixed = {
        "raw_inventory": _ordered_inventory(spark, sf_dir, 1).filter("NOT product_id LIKE '%4'"),
        "raw_transactions": _ordered_transactions(spark, sf_dir, 1).filter("payment_method <> 'card'"),
    }
    paths = _csvs(spark, fixed)
    _load(store, "batch-1", paths, reload=True)
    _delete(spark, paths)
    with contextlib.suppress(_CutOff), store.transaction():
        medallion.withdraw(store)
        raise _CutOff
    store.expire(keep=1, grace_hours=0)  # what the broken off one wrote; old bronze stays, as the intent names it
    medallion.refresh(store, "again", ["batch-1"], feeds.AS_OF)
    store.expire(keep=1, grace_hours=0)
    return store


def medallion_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales after a reload: as if the corrected file had been loaded first, but for the
    store names of store-days that were known."""
    return _reloaded_lake(spark, sf_dir).read("gold/daily_store_sales").drop("sales_month", *AUDIT_COLUMNS)


def medallion_reload_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in silver by batch, and those held by rule, after the reload."""
    store = _reloaded_lake(spark, sf_dir)
    held = silver.current_quarantine(store.read("quarantine/raw_transactions"), store.read("silver/transactions"))
    sold = store.read("silver/transactions").select(F.lit("silver").alias("state"), F.col("_bronze_batch_id").alias("batch"), "total_amount")
    held = held.select(F.col("reject_rule").alias("state"), F.col("_batch_id").alias("batch"), F.lit(None).cast("decimal(10,2)").alias("total_amount"))
    return sold.unionByName(held).groupBy("state", "batch").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").cast("decimal(20,2)").alias("total_amount")
    )


def medallion_reload_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reloaded_lake(spark, sf_dir).read("silver/inventory").drop(*AUDIT_COLUMNS)


def medallion_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived layers are emptied and made anew from all of bronze at once."""
    store = _lake(spark, sf_dir, [1, 2])
    store.reset(("silver", "gold", "quarantine"))
    store.expire(keep=1, grace_hours=0)
    for name in ("silver/transactions", "silver/stores", "gold/daily_store_sales", "quarantine/raw_transactions"):
        if not store.read(name).isEmpty():
            raise RuntimeError(f"{name} is not empty after the reset")
    medallion.refresh(store, "replay", None, feeds.AS_OF)
    return store.read("gold/daily_store_sales").drop("sales_month", *AUDIT_COLUMNS)


def quarantine_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of held rows over two loads and a reload."""
    log = _reloaded_lake(spark, sf_dir).read("quarantine/changes")
    return log.groupBy(F.col("_batch_id").alias("batch"), "change", "reject_rule").agg(F.count(F.lit(1)).alias("rows"))


def medallion_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks after a reload from stored metrics alone: no row of bronze or silver
    transactions is read for them."""
    return metrics.stored_report(_reloaded_lake(spark, sf_dir), feeds.AS_OF)


_FIRST_LOAD = "2001-12-31 00:00:00"


def audit_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the time they were transformed, after two batches of different days."""
    store = _lake(spark, sf_dir, [1, 2], {1: _FIRST_LOAD})
    counts = [
        store.read(name).groupBy(F.lit(name).alias("table_name"), F.col(stamp).alias("stamp")).agg(F.count(F.lit(1)).alias("rows"))
        for name, stamp in (
            ("silver/transactions", "_transformed_at"), ("silver/stores", "_transformed_at"),
            ("silver/inventory", "_transformed_at"), ("gold/inventory_health", "_refreshed_at"),
        )
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def csv_ingest_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch, load time, file and row identity of two batches of transactions in bronze."""
    store = LayerStore(spark, scratch_path(spark, "lake"))
    for batch, at in ((1, _FIRST_LOAD), (2, feeds.AS_OF)):
        path = _csv(feeds.raw_transactions(spark, sf_dir, batch), "raw_transactions")
        medallion.ingest_feed(store, "raw_transactions", path, f"batch-{batch}", at)
    named = F.count_if(F.col("_source_file").rlike(r"/raw_transactions-[0-9a-f]+/part-[^/]*\.csv\z"))
    return store.read("bronze/raw_transactions").groupBy("_batch_id", "_ingested_at").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_id").alias("ids"), named.alias("named"),
        F.count_if(F.col("_is_quarantined")).alias("flagged"), F.count("_quarantine_reason").alias("reasons"),
    )


def csv_ingest_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns are found by name: one is missing, the others stand in another order."""
    store = LayerStore(spark, scratch_path(spark, "lake"))
    path = scratch_path(spark, "raw_stores")
    some = feeds.raw_stores(spark, sf_dir).select("opened_date", "store_name", "store_id", "store_type", "city")
    some.write.option("header", True).option("escape", '"').option("nullValue", "NA").csv(path)
    medallion.ingest_feed(store, "raw_stores", path, "batch", feeds.AS_OF)
    return store.read("bronze/raw_stores").select(*S.FEED_COLUMNS["raw_stores"])


def csv_ingest_unknown_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column outside the contract sets the whole batch aside, record by record."""
    store = LayerStore(spark, scratch_path(spark, "lake"))
    path = scratch_path(spark, "raw_stores")
    some = feeds.raw_stores(spark, sf_dir).select("store_id", "store_name", F.lit("x").alias("surprise"))
    some.write.option("header", True).option("escape", '"').option("nullValue", "NA").csv(path)
    with contextlib.suppress(FeedContractError):
        medallion.ingest_feed(store, "raw_stores", path, "batch", feeds.AS_OF)
    if not store.read("bronze/raw_stores").isEmpty():
        raise RuntimeError("a batch with an unknown column was loaded")
    return store.read("quarantine/rejected_records").select("_batch_id", "source_table", "_quarantine_reason", "record")


def medallion_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of all three feeds from CSV files to the gold table."""
    store = _lake(spark, sf_dir, [1, 2])
    return store.read("gold/daily_store_sales").drop("sales_month", *AUDIT_COLUMNS)


@functools.lru_cache(maxsize=1)
def _gold_lake(spark: SparkSession, sf_dir: str) -> LayerStore:
    """Daily sales of two batches in the gold table, with their noted row counts."""
    store = LayerStore(spark, scratch_path(spark, "lake"))
    sales = store.write(_daily_sales(spark, sf_dir), "gold/daily_store_sales")
    store.replace(sales)
    metrics.count_gold(store, sales, [], True)
    return store


def daily_sales_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest store-days of the gold table, read from its newest month back."""
    return serving.newest_sales(_gold_lake(spark, sf_dir)).drop(*AUDIT_COLUMNS)


def daily_sales_newest_of_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _gold_lake(spark, sf_dir)
    return serving.newest_sales(lake, store_id=3, end_date="1999-05-17", limit=40).drop(*AUDIT_COLUMNS)


def medallion_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch is run again: nothing changes."""
    store = _lake(spark, sf_dir, [1, 2, 2])
    return store.read("gold/daily_store_sales").drop("sales_month", *AUDIT_COLUMNS)


def medallion_rerun_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _lake(spark, sf_dir, [1, 2, 2])
    return silver.quarantine_by_reason(store.read("quarantine/raw_transactions"))


def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two whole runs with their records and the rows of every step, read back.

    The derived feed has more than a tenth of bad rows, so both runs end as failed after
    publishing. Every record names the check.
    """
    store = LayerStore(spark, scratch_path(spark, "lake"))
    for batch in (1, 2):
        paths = _batch(spark, sf_dir, batch)
        with contextlib.suppress(quality.QualityError):
            medallion.run(spark, store.root, paths, feeds.AS_OF, run_id=f"run-{batch}")
        _delete(spark, paths)
    record = medallion.runs(store).select(
        "run_id", "flow_name", "status", "records_loaded", "records_quarantined",
        F.col("error_message").contains("quarantine_rate_under_10pct").alias("rate_failed"),
    )
    return store.read("bronze/run_steps").join(record, "run_id")


# --- registry ---------------------------------------------------------------

_QUERIES: dict[str, Query] = {
    "bronze_transactions": bronze_transactions,
    "bronze_inventory": bronze_inventory,
    "bronze_stores": bronze_stores,
    "quarantine_transactions": quarantine_transactions,
    "quarantine_by_reason": quarantine_by_reason,
    "flagged_transactions": flagged_transactions,
    "quarantine_rates": quarantine_rates,
    "rejected_inventory": rejected_inventory,
    "rejected_stores": rejected_stores,
    "silver_transactions": silver_transactions,
    "silver_inventory": silver_inventory,
    "silver_stores": silver_stores,
    "gold_daily_sales": gold_daily_sales,
    "gold_inventory_health": gold_inventory_health,
    "merge_insert_if_absent": merge_insert_if_absent,
    "merge_upsert_stores": merge_upsert_stores,
    "merge_upsert_inventory": merge_upsert_inventory,
    "merge_upsert_inventory_backfill": merge_upsert_inventory_backfill,
    "merge_upsert_daily_sales": merge_upsert_daily_sales,
    "merge_upsert_inventory_health": merge_upsert_inventory_health,
    "daily_sales_latest": daily_sales_latest,
    "daily_sales_filtered": daily_sales_filtered,
    "sales_summary_7d": _summary("7d"),
    "sales_summary_30d": _summary("30d"),
    "sales_summary_90d": _summary("90d"),
    "sales_summary_unknown_period": _summary("1y"),
    "sales_summary_empty": sales_summary_empty,
    "inventory_alerts": inventory_alerts,
    "inventory_health_snapshot": inventory_health_snapshot,
    "quality_report": quality_report,
    "stores_without_sales": stores_without_sales,
    "stores_without_recent_sales": stores_without_recent_sales,
    "run_states": run_states,
    "run_states_compacted": run_states_compacted,
    "recent_runs": recent_runs,
    "last_run_status": last_run_status,
    "csv_ingest_transactions": _csv_ingest("raw_transactions", feeds.raw_transactions),
    "csv_ingest_inventory": _csv_ingest("raw_inventory", feeds.raw_inventory),
    "csv_ingest_stores": _csv_ingest("raw_stores", feeds.raw_stores),
    "csv_ingest_multiline": csv_ingest_multiline,
    "medallion_daily_sales": medallion_daily_sales,
    "daily_sales_newest": daily_sales_newest,
    "daily_sales_newest_of_store": daily_sales_newest_of_store,
    "medallion_rerun": medallion_rerun,
    "medallion_rerun_quarantine": medallion_rerun_quarantine,
    "medallion_run": medallion_run,
    "medallion_reload": medallion_reload,
    "medallion_reload_transactions": medallion_reload_transactions,
    "medallion_reload_inventory": medallion_reload_inventory,
    "medallion_quality": medallion_quality,
    "quarantine_history": quarantine_history,
    "medallion_reset": medallion_reset,
    "audit_stamps": audit_stamps,
    "csv_ingest_provenance": csv_ingest_provenance,
    "csv_ingest_missing_column": csv_ingest_missing_column,
    "csv_ingest_unknown_column": csv_ingest_unknown_column,
}


def _compared(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(spark, sf_dir))


def registry() -> dict[str, Query]:
    return {name: _compared(query) for name, query in _QUERIES.items()}
