"""Gold: daily store sales and inventory health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.clock import as_date, as_timestamp, utc_date
from tallymart.functions.exact import from_cents, mean_of_cents, percentage, to_cents

# Columns an upsert refreshes; the store name of an existing row is kept.
DAILY_SALES_KEY = ["report_date", "store_id"]
DAILY_SALES_UPDATES = ["total_revenue", "transaction_count", "avg_basket_size", "_refreshed_at"]
HEALTH_KEY = ["snapshot_date", "store_id"]
HEALTH_UPDATES = ["products_below_reorder", "total_products", "reorder_rate", "_refreshed_at"]


def store_days(transactions: DataFrame) -> DataFrame:
    """Sums per day and store, of any store. They add up: sums of parts are those of the whole."""
    return transactions.groupBy(utc_date(F.col("transaction_ts")).alias("report_date"), "store_id").agg(
        F.sum(to_cents(F.col("total_amount"))).alias("cents"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.count("total_amount").alias("amounts"),
    )


def sales_of(sums: DataFrame, stores: DataFrame, as_of=None) -> DataFrame:
    """Daily sales of known stores from ``store_days``."""
    return sums.join(stores.select("store_id", "store_name"), "store_id").select(
        "report_date", "store_id", "store_name",
        from_cents(F.col("cents"), 20).alias("total_revenue"),
        "transaction_count",
        mean_of_cents(F.col("cents"), F.col("amounts")).alias("avg_basket_size"),
        as_timestamp(as_of).alias("_refreshed_at"),
        F.trunc("report_date", "MM").alias("sales_month"),
    )


def daily_store_sales(transactions: DataFrame, stores: DataFrame, as_of=None) -> DataFrame:
    """Revenue, count and mean basket per day and known store.

    Sales are summed before the join: what meets the store table is one row per store
    and day, whatever share of the sales a store holds.
    """
    return sales_of(store_days(transactions), stores, as_of)


def inventory_health(inventory: DataFrame, snapshot_date=None, as_of=None) -> DataFrame:
    """Products below their reorder point per store on the snapshot day."""
    below = F.count_if(F.col("is_below_reorder"))
    total = F.count(F.lit(1))
    return inventory.groupBy("store_id").agg(
        below.alias("products_below_reorder"), total.alias("total_products")
    ).select(
        "store_id", "products_below_reorder", "total_products",
        percentage(F.col("products_below_reorder"), F.col("total_products")).alias("reorder_rate"),
        as_timestamp(as_of).alias("_refreshed_at"),
        as_date(snapshot_date).alias("snapshot_date"),
    )
