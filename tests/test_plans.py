"""Plan shapes that have to hold at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tallymart import schemas as S
from tallymart.functions.clock import as_timestamp
from tallymart.operators.keyed import insert_if_absent, merge_upsert
from tallymart.plans import gold, quality, serving, silver
from tallymart.sources.tables import LayerStore

AS_OF = "2024-06-01 00:00:00"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Small stored tables, so that plans start from Parquet scans."""
    store = LayerStore(spark, str(tmp_path_factory.mktemp("lake")))
    day = F.expr("date_add(date'2024-01-01', cast(id % 90 as int))")
    tx = spark.range(0, 2000, 1, 4).select(
        F.format_string("%08x-0000-0000-0000-000000000000", "id").alias("transaction_id"),
        # One store holds a third of all rows.
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("store_id"),
        (F.col("id") % 7).cast("int").alias("product_id"), F.lit(2).alias("quantity"),
        F.lit("1.50").cast("decimal(10,2)").alias("unit_price"),
        F.lit("3.00").cast("decimal(10,2)").alias("total_amount"),
        day.cast("timestamp").alias("transaction_ts"), F.lit("card").alias("payment_method"),
        F.lit(1).alias("cashier_id"), F.lit("b").alias("_bronze_batch_id"),
        F.col("id").alias("_bronze_id"), as_timestamp(AS_OF).alias("_transformed_at"),
        F.trunc(day, "MM").alias("txn_month"),
    )
    store.append(tx, "silver/transactions")
    stores = spark.range(50).select(
        F.col("id").cast("int").alias("store_id"), F.format_string("S%02d", "id").alias("store_name"),
        *[F.lit("x").alias(c) for c in ("city", "region", "store_type")],
        F.lit(None).cast("date").alias("opened_date"), as_timestamp(AS_OF).alias("_transformed_at"),
        as_timestamp(AS_OF).alias("_ingested_at"),
    )
    store.write_version(stores, "silver/stores", "v1")
    store.commit_version("silver/stores", "v1")
    sales = gold.daily_store_sales(store.read("silver/transactions"), stores, AS_OF)
    store.replace_partitions(sales, "gold/daily_store_sales")
    return store


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def explain(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_sales_are_summed_before_and_after_the_shuffle_and_before_the_join(lake):
    text = plan(gold.daily_store_sales(lake.read("silver/transactions"), lake.read("silver/stores"), AS_OF))
    assert "partial_sum" in text
    assert text.index("Join") < text.index("partial_sum")  # printed top down: join is above
    schema = re.search(r"ReadSchema: struct<([^>]*total_amount[^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"store_id", "total_amount", "transaction_ts"}


def test_hot_store_sums_are_whole(lake):
    rows = lake.read("gold/daily_store_sales")
    assert rows.agg(F.sum("transaction_count")).first()[0] == 2000
    assert rows.filter("store_id = 1").agg(F.sum("transaction_count")).first()[0] > 660


def test_dates_prune_months_and_reach_the_scan(lake):
    gold_rows = lake.read("gold/daily_store_sales")
    text = plan(serving.daily_sales(gold_rows, 3, "2024-02-10", "2024-02-20"))
    assert re.search(r"PartitionFilters: \[[^\n]*sales_month", text), text
    # The scan's own metadata is cut short in the printed plan; ask for the whole value.
    frame = serving.daily_sales(gold_rows, 3, "2024-02-10", "2024-02-20")
    pushed = explain(frame)
    assert "GreaterThanOrEqual(report_date,2024-02-10)" in pushed, pushed
    assert "EqualTo(store_id,3)" in pushed and "TakeOrderedAndProject" in text


def test_no_plan_multiplies_rows_or_needs_all_keys_at_once(lake):
    tx, stores = lake.read("silver/transactions"), lake.read("silver/stores")
    bronze = lake.empty(S.bronze_schema("raw_transactions"))
    frames = [
        quality.stores_without_sales(stores, tx),
        insert_if_absent(tx, tx.filter("quantity > 100"), ["transaction_id"]),
        silver.quarantine_transactions(bronze, tx, AS_OF),
        quality.quality_report(
            bronze, lake.empty(S.quarantine_schema("raw_transactions")), tx, stores,
            lake.read("gold/daily_store_sales"), AS_OF,
        ),
        merge_upsert(stores, stores, ["store_id"], ["store_name"]),
    ]
    for df in frames:
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_large_sides_are_not_broadcast(spark, lake):
    """Beyond the size limit the same joins are done by sorting both sides."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        tx, stores = lake.read("silver/transactions"), lake.read("silver/stores")
        health = gold.daily_store_sales(tx, stores, AS_OF)
        assert "BroadcastHashJoin" not in plan(health)
        assert health.agg(F.sum("transaction_count")).first()[0] == 2000
    finally:
        spark.conf.set(limit, old)


def test_skewed_join_partition_is_split(spark, lake):
    """The alert join with one store holding most rows, beyond the broadcast limit."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 200_000
        inventory = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 50).cast("int").alias("store_id"),
            F.col("id").cast("int").alias("product_id"), F.lit(1).alias("stock_level"),
            F.lit(5).alias("reorder_point"), F.lit(True).alias("is_below_reorder"),
        )
        out = serving.inventory_alerts(inventory, lake.read("silver/stores"))
        assert len(out.collect()) == n
        assert "skew=true" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scans(df) -> int:
    return plan(df).count("FileScan parquet")


def test_loss_counts_scan_once_and_flags_twice(spark, lake, tmp_path):
    path = str(tmp_path / "bronze")
    spark.range(100).select(
        F.col("id").alias("_id"), as_timestamp(AS_OF).alias("_ingested_at"), F.lit("b").alias("_batch_id"),
        F.lit("f").alias("_source_file"), F.lit(False).alias("_is_quarantined"), F.lit("").alias("_quarantine_reason"),
        *[F.lit("1").alias(c) for c in S.FEED_COLUMNS["raw_transactions"]],
    ).write.parquet(path)
    bronze = spark.read.parquet(path)
    counts = silver.loss_by_rule(bronze, AS_OF)
    assert scans(counts) == 1 and "Join" not in plan(counts)
    assert {(r.reject_rule, r.rows) for r in counts.collect()} == {("malformed_transaction_id", 100)}
    flagged = silver.flagged_transactions(bronze, silver.silver_transactions(bronze, AS_OF), AS_OF)
    assert scans(flagged) == 2 and plan(flagged).count("SortMergeJoin") + plan(flagged).count("BroadcastHashJoin") == 1


def test_no_shuffle_between_scan_and_classification(spark):
    from tallymart.sources import testdata

    text = plan(silver.classify_transactions(testdata.raw_transactions(spark, "/root/testdata/sf0.001"), AS_OF))
    assert "Exchange" not in text


def test_report_limit_is_an_argument_and_orders_hold(lake):
    rows = lake.read("gold/daily_store_sales")
    assert serving.daily_sales(rows).count() == 100
    every = [(r.report_date, -r.store_id) for r in serving.daily_sales(rows, limit=None).collect()]
    assert len(every) == rows.count() and every == sorted(every, reverse=True)
