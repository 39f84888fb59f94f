"""The whole run: feeds to bronze, silver, gold, checks, with a run record.

A feed of a batch is loaded once, in one commit; a run of the same batch uses the bronze rows
that are there, so their ids hold whatever the file splits or the cluster. Silver, quarantine,
gold and the mark that a batch is published change in one commit more. Whatever breaks off in
between, readers see the tables before or after it, and the next run takes up what is not
published. Of two runs at once that change the same tables, one fails and can be run again.

``reload`` takes a corrected file. Its bronze rows replace the old ones in one commit with an
intent, which names the old rows that are still in silver and gold. The next run, this one or a
later one, carries out all intents: the tables become what they were if the corrected file had
been loaded in the first place. The batch keeps the time of its first load. Two things stay as
upserts leave them: the store name of a store-day that was known, unless its store was reloaded,
and health snapshots of earlier days.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymart import schemas as S
from tallymart.functions.clock import as_date, as_timestamp, utc_text
from tallymart.operators import key_bits
from tallymart.operators.keyed import merge_upsert, without_match
from tallymart.plans import gold, metrics, quality, run_log, silver
from tallymart.session import discard, stage, together
from tallymart.sources import csv_feeds
from tallymart.sources.snapshots import CommitConflict
from tallymart.sources.tables import BUCKET, TABLES, LayerStore, Segment

FEEDS = ("raw_stores", "raw_inventory", "raw_transactions")
STORE_UPDATES = ["store_name", "city", "region", "store_type", "opened_date", "_transformed_at", "_ingested_at"]
INVENTORY_UPDATES = [
    "stock_level", "reorder_point", "is_below_reorder", "last_restocked", "_transformed_at",
    "_ingested_at",
]
CANDIDATE_COLUMNS = ["_id", "_ingested_at", "_batch_id", *S.FEED_COLUMNS["raw_transactions"]]


@dataclass(frozen=True)
class RunResult:
    run_id: str
    records_loaded: int
    records_inserted: int
    records_quarantined: int
    report: list
    steps: dict[str, int]


# --- bronze -----------------------------------------------------------------


def ingest_feed(
    store: LayerStore,
    feed: str,
    paths: str | Sequence[str],
    batch_id: str,
    as_of=None,
    multi_line: bool = False,
    reload: bool = False,
) -> int:
    """Load CSV files of one feed as one bronze batch; returns the batch's rows.

    A feed that the batch has loaded already is left as it is unless ``reload``. Columns
    outside the contract reject the batch as a whole, and so do texts with line breaks when
    ``multi_line`` is not set: the records go to ``quarantine/rejected_records`` and the call
    raises. Records with more fields than the header are set aside there one by one.
    """
    table, rejects = f"bronze/{feed}", "quarantine/rejected_records"
    batch = {"_batch_id": batch_id}
    rejected = {**batch, "source_table": feed}
    done = f"batches.{feed}"
    if not reload and batch_id in store.marked(done):
        return store.read(table, lambda p: p["_batch_id"] == batch_id).count()
    old = store.segments_of(table, batch)
    if reload:
        for p, names in store.intents().get(batch_id, {}).get(feed, {}).items():
            old[p] = [*names, *(n for n in old.get(p, []) if n not in names)]
    loaded_at = _first_load(store, table, old) if old else as_of
    raw = csv_feeds.read_csv(store.spark, paths, multi_line)

    def reject(rows: DataFrame, reason: str) -> None:
        rows = csv_feeds.rejected_records(rows, feed, batch_id, reason, as_of)
        store.replace_partitions(rows, rejects, [rejected])

    try:
        csv_feeds.to_bronze(raw, feed, batch_id, as_of)
    except csv_feeds.FeedContractError as error:
        reject(raw, str(error))
        raise
    extra = csv_feeds.has_extra_fields(raw)
    open_ = F.lit(False) if multi_line else csv_feeds.has_open_quote(raw)
    seen = Observation()
    counted = raw.observe(
        seen,
        F.count_if(~extra).alias("loaded"),
        F.count_if(extra).alias("malformed"),
        F.count_if(open_).alias("broken"),
    )
    rows = csv_feeds.to_bronze(counted.filter(~extra), feed, batch_id, loaded_at)
    segment = store.write(rows, table, values=batch)
    if seen.get["broken"]:
        reason = f"{feed}: line breaks inside quotes; load with multi_line=True"
        reject(raw.filter(open_), reason)
        raise csv_feeds.FeedContractError(reason)
    with store.transaction() as tx:
        if reload and old:
            tx.intend(batch_id, {**store.intents().get(batch_id, {}), feed: old})
        store.replace(segment, [batch])
        if seen.get["malformed"]:
            reject(raw.filter(extra), "more fields than the header names")
        else:
            store.clear_partition(rejects, rejected)
        store.mark(done, batch_id, rows=seen.get["loaded"])
        tx.unmark("batches.published", batch_id)
    return seen.get["loaded"]


def _first_load(store: LayerStore, table: str, segments: dict[str, list[str]]):
    """When the rows were loaded first."""
    at = store.read_segments(table, segments).agg(F.unix_micros(F.min("_ingested_at"))).first()[0]
    return None if at is None else F.timestamp_micros(F.lit(at))


# --- reloads ----------------------------------------------------------------


@dataclass(frozen=True)
class Withdrawn:
    """What the intents take back: months, batches to do again, lost keys by table, and stored rows
    of other batches that were duplicates of what is taken back."""

    months: list[dt.date]
    batches: list[str]
    stores: DataFrame | None
    inventory: DataFrame | None
    freed: DataFrame | None = None


def _old_rows(store: LayerStore, feed: str) -> DataFrame | None:
    """Rows of the feed that reloads have replaced in bronze."""
    parts = [i[feed] for i in store.intents().values() if feed in i]
    return store.read_segments(f"bronze/{feed}", {p: s for part in parts for p, s in part.items()}) if parts else None


def withdraw(store: LayerStore) -> Withdrawn:
    """Take the transactions of reloaded batches out of silver, in the open transaction.

    Only the months that these batches are marked with are read, and rewritten if they hold
    rows of them. Rows of their ids that other batches hold, duplicates until now, are candidates
    again, with nothing else of their batches; rows of lost inventory and store keys are found when
    these are refreshed.
    """
    reloaded = sorted(b for b, i in store.intents().items() if "raw_transactions" in i)
    stores, inventory = _old_rows(store, "raw_stores"), _old_rows(store, "raw_inventory")
    if stores is not None:
        stores = silver.classify_stores(stores).filter("reject_rule IS NULL").select("typed.store_id").distinct()
    if inventory is not None:
        inventory = silver.classify_inventory(inventory).filter("reject_rule IS NULL")
        inventory = inventory.select("typed.store_id", "typed.product_id").distinct()
    again = sorted(store.intents())
    if not reloaded:
        return Withdrawn([], again, stores, inventory)
    known = {m for b in reloaded for m in store.marked("batches.months").get(b, {}).get("months", [])}
    existing = store.read("silver/transactions", lambda p: p["txn_month"] in known)
    own = F.col("_bronze_batch_id").isin(reloaded)
    gone, n = stage(existing.filter(own).select("transaction_id", "txn_month"), "withdrawn")
    months = sorted(r["txn_month"] for r in gone.select("txn_month").distinct().collect()) if n else []
    freed = None
    if months:
        held = store.read("quarantine/raw_transactions", lambda p: p["_batch_id"] not in reloaded)
        held = held.filter(F.col("reject_rule") == silver.DUPLICATE_RULE)
        freed = held.join(gone.select("transaction_id"), "transaction_id", "left_semi").select(*CANDIDATE_COLUMNS)
        freed, n = stage(freed, "freed")
        if not n:
            discard(store.spark, [freed])
            freed = None
        kept = existing.filter(F.col("txn_month").isin(months) & ~own)
        metrics.put_transactions(store, kept, months)
    discard(store.spark, [gone])
    return Withdrawn(months, again, stores, inventory, freed)


# --- silver -----------------------------------------------------------------


def _upsert(
    store: LayerStore,
    name: str,
    incoming: DataFrame,
    update_cols: list[str],
    lost: DataFrame | None = None,
    refound: DataFrame | None = None,
) -> int:
    """Merge rows into a bucketed table, reading and rewriting only buckets they fall into.

    Rows of ``lost`` keys are replaced by what ``refound`` has of them. Returns the rows merged.
    """
    keys, bucket = list(TABLES[name].bucket_by), TABLES[name].bucket
    if lost is None and not store.partitions(name):  # nothing to merge with: the rows are written once
        segment = store.write(incoming, name)
        store.replace(segment)
        return segment.rows
    incoming, n = stage(incoming, "incoming")
    staged = [incoming]
    touched = incoming.select(bucket.alias(BUCKET))
    if lost is not None:
        (lost, _), (refound, _) = stage(lost, "lost"), stage(refound, "refound")
        staged += [lost, refound]
        touched = touched.union(lost.select(bucket))
    buckets = sorted(r[BUCKET] for r in touched.distinct().collect())
    if buckets:
        current = store.read(name, lambda p: int(p[BUCKET]) in buckets)
        if lost is not None:
            current, incoming = (without_match(df, lost, keys) for df in (current, incoming))
        merged = merge_upsert(current, incoming, keys, update_cols, "_ingested_at")
        if lost is not None:
            merged = merged.unionByName(refound)
        store.replace_partitions(merged, name, [{BUCKET: b} for b in buckets])
    discard(store.spark, staged)
    return n


def refresh_stores(store: LayerStore, bronze: DataFrame, as_of=None, lost: DataFrame | None = None) -> int:
    """Merge named stores into silver stores; returns the rows upserted. Rows loaded earlier than
    what silver has change nothing. Lost stores become what all of bronze says of them."""
    refound = None
    if lost is not None:
        every = store.read("bronze/raw_stores")
        refound = silver.silver_stores(every, as_of).join(lost, ["store_id"], "left_semi")
    return _upsert(store, "silver/stores", silver.silver_stores(bronze, as_of), STORE_UPDATES, lost, refound)


def refresh_inventory(store: LayerStore, bronze: DataFrame, as_of=None, lost: DataFrame | None = None) -> int:
    """Like ``refresh_stores``; a product keeps the supplier of its first load."""
    refound = None
    if lost is not None:
        every = store.read("bronze/raw_inventory")
        refound = silver.inventory_of(every, lost, as_of)
    return _upsert(store, "silver/inventory", silver.silver_inventory(bronze, as_of), INVENTORY_UPDATES, lost, refound)


def pending_batches(store: LayerStore, batch_id: str) -> list[str]:
    """This batch and earlier ones whose run did not publish them; usually just this one."""
    loaded, published = store.marked("batches.loaded"), store.marked("batches.published")
    return sorted({batch_id, *(b for b in loaded if b not in published)})


def candidate_transactions(
    store: LayerStore, batches: list[str] | None, freed: DataFrame | None = None
) -> DataFrame:
    """Bronze rows that may enter silver in this run.

    The given batches, rows that earlier runs held back for their date only, and ``freed`` ones
    of other batches: no other row can have become valid. Without batches all of bronze, for
    changed rules.
    """
    if batches is None:
        return store.read("bronze/raw_transactions")
    waiting = store.read("quarantine/raw_transactions", lambda p: p["_batch_id"] not in batches)
    waiting = waiting.filter(F.col("reject_rule") == silver.FUTURE_RULE)
    fresh = store.read("bronze/raw_transactions", lambda p: p["_batch_id"] in batches)
    found = fresh.select(*CANDIDATE_COLUMNS).unionByName(waiting.select(*CANDIDATE_COLUMNS))
    return found if freed is None else found.unionByName(freed.select(*CANDIDATE_COLUMNS))


# --- gold -------------------------------------------------------------------


def touched_months(
    existing: DataFrame, changed: DataFrame, old_stores: DataFrame, new_stores: DataFrame
) -> list[dt.date]:
    """Months whose daily sales can have changed: those of the changed transactions, and
    those of existing transactions whose store is only known since this run.

    A list, as there are only so many calendar months: as literals they prune the month
    folders of silver and gold before any file is opened.
    """
    months = changed.select("txn_month").distinct()
    added = without_match(new_stores.select("store_id"), old_stores, ["store_id"])
    if not added.isEmpty():  # else no scan of all transactions
        late = existing.select("store_id", "txn_month").join(added, "store_id", "left_semi")
        months = months.unionByName(late.select("txn_month")).distinct()
    return sorted(r["txn_month"] for r in months.collect())


def merged_daily_sales(
    current: DataFrame,
    transactions: DataFrame,
    stores: DataFrame,
    months: list[dt.date] | None,
    as_of=None,
) -> DataFrame:
    """Daily sales of the given months (all without any) after the upsert."""
    if months is not None:
        transactions = transactions.filter(F.col("txn_month").isin(months))
    return upserted_sales(current, gold.daily_store_sales(transactions, stores, as_of), months)


def upserted_sales(
    current: DataFrame,
    incoming: DataFrame,
    months: list[dt.date] | None,
    recounted: list[dt.date] | None = None,
    renamed: DataFrame | None = None,
) -> DataFrame:
    """Daily sales of the given months (all without any) after the upsert of ``incoming``.

    In ``recounted`` months transactions were withdrawn: store-days without any are dropped.
    Store-days of ``renamed`` stores take the name that the store has now.
    """
    if months is not None:
        current = current.filter(F.col("sales_month").isin(months))
    if renamed is not None:
        current = without_match(current, renamed, ["store_id"])
    fell = F.col("sales_month").isin(recounted) if recounted else None
    return merge_upsert(current, incoming, gold.DAILY_SALES_KEY, gold.DAILY_SALES_UPDATES, withdrawn=fell)


def merged_inventory_health(current: DataFrame, inventory: DataFrame, as_of=None) -> DataFrame:
    """The snapshot of the day of ``as_of`` after the upsert; other days are not read."""
    incoming = gold.inventory_health(inventory, as_of, as_of)
    today = current.filter(F.col("snapshot_date") == as_date(as_of))
    return merge_upsert(today, incoming, gold.HEALTH_KEY, gold.HEALTH_UPDATES)


# --- run record -------------------------------------------------------------


def log_event(
    store: LayerStore,
    run_id: str,
    flow_name: str,
    seq: int,
    status: str,
    ts=None,
    loaded: int | None = None,
    quarantined: int | None = 0,
    error: str | None = None,
) -> None:
    event = store.spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(flow_name).alias("flow_name"),
        F.lit(seq).cast("bigint").alias("seq"),
        as_timestamp(ts).alias("ts"),
        F.lit(status).alias("status"),
        F.lit(loaded).cast("bigint").alias("records_loaded"),
        F.lit(quarantined).cast("bigint").alias("records_quarantined"),
        F.lit(error).cast("string").alias("error_message"),
    )
    store.append(event, "bronze/run_events")


def log_steps(store: LayerStore, run_id: str, steps: dict[str, int]) -> None:
    """How many rows each step loaded, upserted, inserted or quarantined."""
    rows = [F.struct(F.lit(k).alias("step"), F.lit(n).cast("bigint").alias("rows")) for k, n in steps.items()]
    table = store.spark.range(1).select(F.lit(run_id).alias("run_id"), F.inline(F.array(*rows)))
    store.append(table, "bronze/run_steps")


def runs(store: LayerStore) -> DataFrame:
    return run_log.fold_runs(store.read("bronze/run_events"))


# --- the run ----------------------------------------------------------------


def run(
    spark: SparkSession,
    root: str,
    feeds: dict[str, str | Sequence[str]],
    as_of=None,
    flow_name: str = "daily",
    run_id: str | None = None,
    batch_id: str | None = None,
    publish_first: bool = True,
    replay: bool = False,
    reload: bool = False,
    multi_line: bool = False,
) -> RunResult:
    """Load the feeds (``raw_stores``, ``raw_inventory``, ``raw_transactions`` to CSV
    paths), refresh silver and gold, check, and record the run.

    With ``publish_first`` the tables are refreshed before the checks, so a failed check
    only marks the run. Without it, candidates are staged in the shared folder and
    published only after all error checks passed. ``reload`` replaces the batch's feeds.
    """
    unknown = sorted(set(feeds) - set(FEEDS))
    if unknown:
        raise ValueError(f"unknown feeds {unknown}; known are {list(FEEDS)}")
    store = LayerStore(spark, root)
    run_id = run_id or str(uuid.uuid4())
    batch_id = batch_id or run_id
    if as_of is None:  # one clock reading for the whole run
        as_of = utc_text(F.current_timestamp())
        as_of = spark.range(1).select(as_of).first()[0]
    loaded = held = 0
    log_event(store, run_id, flow_name, 0, run_log.RUNNING)
    try:
        store.mark("batches.loaded", batch_id)
        steps = {}
        for feed in (f for f in FEEDS if f in feeds):
            steps[feed] = ingest_feed(store, feed, feeds[feed], batch_id, as_of, multi_line, reload)
            loaded += steps[feed]
        batches = None if replay else pending_batches(store, batch_id)
        done, report = refresh(store, run_id, batches, as_of, publish_first)
        steps |= done
        held = steps["quarantined"]
        log_steps(store, run_id, steps)
        quality.require_passed(report)
    except Exception as error:
        log_event(store, run_id, flow_name, 1, "failed", None, loaded, held, str(error))
        raise
    log_event(store, run_id, flow_name, 1, "success", None, loaded, held)
    tidy(store)
    return RunResult(run_id, loaded, steps["silver_transactions"], held, report, steps)


def tidy(store: LayerStore, most: int = 30) -> None:
    """Merge the small segments of tables that grow by a few rows with every run."""
    for name in ("bronze/run_events", "bronze/run_steps"):
        with contextlib.suppress(CommitConflict):  # a later run does it
            store.compact(name, most)


def refresh(
    store: LayerStore, run_id: str, batches: list[str] | None, as_of, publish_first: bool = True
) -> tuple[dict[str, int], list]:
    """Silver, gold and checks for the given bronze batches (all without any), and for what
    reloads have left to do. Everything becomes visible in one commit, before the checks or,
    without ``publish_first``, after they passed.

    Returns the rows each step inserted, upserted or quarantined, and the check report.
    """
    staged: list[DataFrame] = []
    try:
        with store.transaction() as tx:
            steps = _derive(store, run_id, batches, as_of, staged)
            if publish_first:
                tx.commit()
            report = metrics.stored_report(store, as_of).collect()
            if not publish_first and quality.failed(report):
                tx.abort()
    finally:
        discard(store.spark, staged)
    return steps, report


def _derive(
    store: LayerStore, run_id: str, batches: list[str] | None, as_of, staged: list[DataFrame]
) -> dict[str, int]:
    """Write all that follows from bronze into the open transaction; returns the rows of its steps."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        staged.append(stage(df, name)[0])
        return staged[-1]

    def bronze(feed: str, also: Sequence[str] = ()) -> DataFrame:
        return store.read(f"bronze/{feed}", None if batches is None else lambda p: p["_batch_id"] in {*batches, *also})

    reloaded = sorted(b for b, i in store.intents().items() if "raw_transactions" in i)
    withdrawn = withdraw(store)
    freed, others = withdrawn.freed, []
    if freed is not None:
        staged.append(freed)
    if batches is not None:
        batches = sorted({*batches, *withdrawn.batches})
        if freed is not None:  # of batches that are done anyway they come with the batch
            freed = freed.filter(~F.col("_batch_id").isin(batches))
            others = sorted(r["_batch_id"] for r in freed.select("_batch_id").distinct().collect())
    lost_stores = kept(withdrawn.stores, "lost-stores") if withdrawn.stores is not None else None
    old_stores = store.read("silver/stores")
    # Rows loaded at the same time as a reloaded batch still win by their batch's name.
    merged_stores = refresh_stores(store, bronze("raw_stores", others), as_of, lost_stores)
    stores = store.read("silver/stores")
    only = {"_batch_id": batches[0]} if batches is not None and len(batches) == 1 else None

    def set_aside(feed: str, classified: DataFrame) -> Segment:
        return store.write(silver.rejected_rows(classified, feed), f"quarantine/{feed}", values=only)

    def goods() -> tuple[int, int, dict[str, Segment]]:
        """Inventory, its health, and what is set aside of it and of stores."""
        merged = refresh_inventory(store, bronze("raw_inventory", others), as_of, withdrawn.inventory)
        health = merged_inventory_health(store.read("gold/inventory_health"), store.read("silver/inventory"), as_of)
        health = store.write(health, "gold/inventory_health")
        store.replace(health)
        aside = {
            "raw_stores": set_aside("raw_stores", silver.classify_stores(bronze("raw_stores"))),
            "raw_inventory": set_aside("raw_inventory", silver.classify_inventory(bronze("raw_inventory"))),
        }
        return merged, health.rows, aside

    def sold() -> tuple[dict[str, int], DataFrame]:
        return _derive_sales(
            store, run_id, batches, as_of, staged, withdrawn, freed, others, reloaded, lost_stores, old_stores, stores
        )

    # They share no table that either changes.
    (steps, reached), (merged, healthy, aside) = together(store.spark, sold, goods)
    steps |= {"silver_stores": merged_stores, "silver_inventory": merged, "gold_inventory_health": healthy}
    with store.transaction() as tx:
        for feed, segment in aside.items():
            # A replay covers every batch, so its quarantine takes the place of the old one.
            if batches is None:
                tx.drop(f"quarantine/{feed}", lambda p: True)
            store.replace(segment, [{"_batch_id": b} for b in batches or ()])
        metrics.note_clock(store, as_of)
        _mark_published(store, run_id, batches, reached)
        for batch in list(store.intents()):
            tx.intend(batch, None)
    return steps


def _derive_sales(
    store: LayerStore,
    run_id: str,
    batches: list[str] | None,
    as_of,
    staged: list[DataFrame],
    withdrawn: Withdrawn,
    freed: DataFrame | None,
    others: list[str],
    reloaded: list[str],
    lost_stores: DataFrame | None,
    old_stores: DataFrame,
    stores: DataFrame,
) -> tuple[dict[str, int], DataFrame]:
    """Transactions, what is held of them, and daily sales; returns the rows of these steps and the
    bronze keys in silver by month."""
    steps: dict[str, int] = {}

    def kept(df: DataFrame, name: str) -> DataFrame:
        staged.append(stage(df, name)[0])
        return staged[-1]

    # Transactions: insert the absent ones, quarantine what reached no silver row.
    days_before = store.read(metrics.METRICS)
    absent = silver.silver_transactions(candidate_transactions(store, batches, freed), as_of)
    copies: list[DataFrame] = []
    if store.partitions(metrics.TRANSACTIONS):  # else all are absent: no copy to match with silver
        candidates, many = stage(absent, "candidates")
        copies = [candidates]
        staged += copies
        if metrics.filters_pay(store, many):
            known = metrics.known_transactions(store, kept(metrics.possible_places(store, candidates), "places"))
        else:
            known = store.read(metrics.TRANSACTIONS)
        absent = without_match(candidates, known, ["transaction_id"])
    marked = {m for b in batches or () for m in store.marked("batches.months").get(b, {}).get("months", [])}
    before = store.read("silver/transactions", lambda p: batches is None or p["txn_month"] in marked)
    inserted = metrics.put_transactions(store, absent)
    discard(store.spark, copies)
    steps["silver_transactions"] = inserted.rows
    recovered = None
    if batches is not None:
        # Of these batches silver has rows only if they were published before, in marked months.
        before = before.filter(F.col("_bronze_batch_id").isin(batches))
        late = silver.silver_keys(inserted.frame.filter(~F.col("_bronze_batch_id").isin(batches)))
        if others:
            metrics.put_promoted(store, run_id, kept(late.join(freed, silver.BRONZE_KEY, "left_semi"), "promoted"), others)
            late = without_match(late, freed, silver.BRONZE_KEY)
        recovered = late.select("_id", F.lit(run_id).alias("run_id"), "_batch_id")
    columns = ["_bronze_batch_id", "_bronze_id", "txn_month"]
    reached = before.select(*columns).unionByName(inserted.frame.select(*columns))
    bits, many = stage(key_bits.blocks(silver.silver_keys(reached), *silver.BRONZE_KEY), "reached")
    staged.append(bits)
    bronze = store.read("bronze/raw_transactions", None if batches is None else lambda p: p["_batch_id"] in batches)
    lost = silver.quarantine_by_bits(bronze, bits, many, as_of)
    steps["quarantined"] = metrics.put_quarantine(store, run_id, lost, recovered, batches, reached, reloaded)
    if others:
        steps["quarantined"] += metrics.held_rows(store, others)

    # Gold: only the months that can have changed, from sums of their days.
    months, recounted = None, withdrawn.months
    old_sales = store.read("gold/daily_store_sales")
    if lost_stores is not None:
        theirs = old_sales.join(lost_stores, "store_id", "left_semi").select("sales_month").distinct()
        recounted = sorted({*recounted, *(r["sales_month"] for r in theirs.collect())})
    if batches is not None:
        # What silver had of a batch before is in gold since then, unless gold has lost its month.
        months = touched_months(days_before, inserted.frame, old_stores, stores)
        lacking = marked - {p["sales_month"] for p in store.partitions("gold/daily_store_sales")}
        months = sorted({*months, *recounted, *map(dt.date.fromisoformat, lacking)})
    incoming = gold.sales_of(metrics.store_days(store, months), stores, as_of)
    sales = store.write(upserted_sales(old_sales, incoming, months, recounted, lost_stores), "gold/daily_store_sales")
    steps["gold_daily_sales"] = sales.rows
    store.replace(sales, [{"sales_month": m} for m in recounted])
    metrics.count_gold(store, sales, recounted, months is None)
    return steps, reached


def _mark_published(store: LayerStore, run_id: str, batches: list[str] | None, reached: DataFrame) -> None:
    """Batches as published, with the months in which silver has rows of them."""
    found = reached.groupBy("_bronze_batch_id").agg(F.collect_set("txn_month").alias("months")).collect()
    for r in found:
        known = store.marked("batches.months").get(r["_bronze_batch_id"], {}).get("months", [])
        store.mark("batches.months", r["_bronze_batch_id"], months=sorted({*known, *map(str, r["months"])}))
    for batch in pending_batches(store, run_id) if batches is None else batches:
        store.mark("batches.published", batch)
