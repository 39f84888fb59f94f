"""Read-only reports over gold and silver; all return lazy DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.clock import as_date
from tallymart.functions.exact import mean_of_cents, to_cents
from tallymart.sources.tables import LayerStore

# Period codes in days, the fallback and the row limit of the sales list.
PERIOD_DAYS = {"7d": 7, "30d": 30, "90d": 90}
DEFAULT_DAYS = 7
DAILY_SALES_LIMIT = 100


def daily_sales(
    gold: DataFrame,
    store_id: int | None = None,
    start_date: dt.date | str | None = None,
    end_date: dt.date | str | None = None,
    limit: int | None = DAILY_SALES_LIMIT,
) -> DataFrame:
    """The newest store-days within the optional bounds (both inclusive), at most ``limit``;
    all with ``None``."""
    by_month = "sales_month" in gold.columns
    rows = gold
    if store_id is not None:
        rows = rows.filter(F.col("store_id") == store_id)
    if start_date is not None:
        rows = rows.filter(F.col("report_date") >= as_date(start_date))
        if by_month:
            rows = rows.filter(F.col("sales_month") >= F.trunc(as_date(start_date), "MM"))
    if end_date is not None:
        rows = rows.filter(F.col("report_date") <= as_date(end_date))
        if by_month:
            rows = rows.filter(F.col("sales_month") <= F.trunc(as_date(end_date), "MM"))
    rows = rows.drop("sales_month").orderBy(F.desc("report_date"), "store_id")
    return rows if limit is None else rows.limit(limit)


def newest_sales(
    store: LayerStore,
    store_id: int | None = None,
    start_date: dt.date | str | None = None,
    end_date: dt.date | str | None = None,
    limit: int = DAILY_SALES_LIMIT,
) -> DataFrame:
    """``daily_sales`` over the gold table, from its newest month back: older months are opened
    only while fewer than ``limit`` rows are found.

    Rows of a newer month come before all of an older one, so the first months that have enough
    hold the answer. Without a filter the noted row counts tell them; else months are searched
    in steps that double, and no month twice as often as there are steps.
    """
    bounds = [None if d is None else str(d)[:7] for d in (start_date, end_date)]
    months = sorted(
        (p["sales_month"] for p in store.partitions("gold/daily_store_sales")
         if (bounds[0] is None or p["sales_month"][:7] >= bounds[0]) and (bounds[1] is None or p["sales_month"][:7] <= bounds[1])),
        reverse=True,
    )

    def among(some: list[str]) -> DataFrame:
        rows = store.read("gold/daily_store_sales", lambda p: p["sales_month"] in some)
        return daily_sales(rows, store_id, start_date, end_date, limit)

    if store_id is None and start_date is None and end_date is None:
        counts, enough, found = store.marked("rows.gold/daily_store_sales"), 0, 0
        while enough < len(months) and found < limit:
            found += counts.get(months[enough], {}).get("rows", 0)
            enough += 1
        return among(months[:enough])
    taken = 1
    while taken < len(months) and among(months[:taken]).count() < limit:
        taken *= 2
    return among(months[:taken])


def sales_summary(gold: DataFrame, period: str = "7d", today=None) -> DataFrame:
    """One row over the store-days since ``today`` minus the period.

    ``transaction_count`` counts store-days and ``avg_basket_size`` is the plain mean of
    daily means. ``top_store`` is the store of the best single day; ties go to the
    greatest name.
    """
    first_day = F.date_sub(as_date(today), PERIOD_DAYS.get(period, DEFAULT_DAYS))
    rows = gold.filter(F.col("report_date") >= first_day)
    if "sales_month" in gold.columns:
        rows = rows.filter(F.col("sales_month") >= F.trunc(first_day, "MM"))
    revenue = F.col("total_revenue")
    best = F.when(revenue.isNotNull(), F.struct("total_revenue", "store_name"))
    return rows.agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum(revenue).cast("decimal(30,2)").alias("total_revenue"),
        F.sum(to_cents(F.col("avg_basket_size"))).alias("_cents"),
        F.count("avg_basket_size").alias("_days"),
        F.max(best).getField("store_name").alias("top_store"),
    ).select(
        "transaction_count", "total_revenue",
        mean_of_cents(F.col("_cents"), F.col("_days")).alias("avg_basket_size"),
        "top_store",
    )


def inventory_alerts(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """Products below their reorder point in known stores, by store and product.

    No join hint: Spark broadcasts the stores when their measured size allows it, else
    it sorts both sides and splits the partition of a store with very many products.
    """
    low = inventory.filter(F.col("is_below_reorder")).select(
        "store_id", "product_id", "stock_level", "reorder_point"
    )
    return (
        low.join(stores.select("store_id", "store_name"), "store_id")
        .select(
            "store_id", "store_name", "product_id", "stock_level", "reorder_point",
            (F.col("reorder_point") - F.col("stock_level")).alias("units_needed"),
        )
        .orderBy("store_id", "product_id")
    )


def health_snapshot(health: DataFrame) -> DataFrame:
    """The latest snapshot, highest reorder rate first."""
    latest = health.select(F.max("snapshot_date")).scalar()
    return health.filter(F.col("snapshot_date") == latest).orderBy(
        F.desc_nulls_first("reorder_rate"), "store_id"
    )
