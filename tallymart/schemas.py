"""Column contracts of the feeds and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Feed column names, missing-value tokens, patterns and formats.
# ---------------------------------------------------------------------------
FEED_COLUMNS = {
    "raw_transactions": [
        "transaction_id", "store_id", "product_id", "quantity",
        "unit_price", "transaction_ts", "payment_method", "cashier_id",
    ],
    "raw_inventory": [
        "store_id", "product_id", "stock_level",
        "reorder_point", "last_restocked", "supplier_id",
    ],
    "raw_stores": [
        "store_id", "store_name", "city", "region", "store_type", "opened_date",
    ],
}

NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# \z, not $: Java's $ also matches before a final line break.
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
DIGITS_PATTERN = r"^[0-9]+\z"
PRICE_PATTERN = r"^[0-9]+(\.[0-9]+)?\z"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
TIMESTAMP_PATTERN = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}(:[0-9]{2})?)?)?\z"
)

QUARANTINE_REASON = "Failed silver transformation checks"
# ---------------------------------------------------------------------------


def _struct(**columns: str) -> T.StructType:
    schema = T.StructType()
    for name, type_name in columns.items():
        schema = schema.add(name, type_name)
    return schema


_PROVENANCE = {"_id": "long", "_ingested_at": "timestamp", "_source_file": "string"}
_FLAGS = {"_is_quarantined": "boolean", "_quarantine_reason": "string"}


def _payload(feed: str) -> dict[str, str]:
    return dict.fromkeys(FEED_COLUMNS[feed], "string")


def bronze_schema(feed: str) -> T.StructType:
    """Provenance, flags (not for stores), payload as text, and the batch partition."""
    flags = {} if feed == "raw_stores" else _FLAGS
    return _struct(**_PROVENANCE, **flags, **_payload(feed), _batch_id="string")


def quarantine_schema(feed: str) -> T.StructType:
    return _struct(
        **_PROVENANCE, **_payload(feed),
        _quarantine_reason="string", _batch_id="string", reject_rule="string",
    )


REJECTED_RECORD_SCHEMA = _struct(
    _source_file="string", _rejected_at="timestamp", _quarantine_reason="string",
    record="string", _batch_id="string", source_table="string",
)

RUN_EVENT_SCHEMA = _struct(
    run_id="string", flow_name="string", seq="long", ts="timestamp", status="string",
    records_loaded="long", records_quarantined="long", error_message="string",
)

RUN_STEP_SCHEMA = _struct(run_id="string", step="string", rows="long")

SILVER_SCHEMAS = {
    "stores": _struct(
        store_id="integer", store_name="string", city="string", region="string",
        store_type="string", opened_date="date", _transformed_at="timestamp",
        _ingested_at="timestamp",
    ),
    "transactions": _struct(
        transaction_id="string", store_id="integer", product_id="integer", quantity="integer",
        unit_price="decimal(10,2)", total_amount="decimal(10,2)", transaction_ts="timestamp",
        payment_method="string", cashier_id="integer", _bronze_batch_id="string",
        _bronze_id="long", _transformed_at="timestamp", txn_month="date",
    ),
    "inventory": _struct(
        store_id="integer", product_id="integer", stock_level="integer", reorder_point="integer",
        is_below_reorder="boolean", last_restocked="date", supplier_id="integer",
        _transformed_at="timestamp", _ingested_at="timestamp",
    ),
}

# Counts are long and revenue has 18 integer digits, so that one store holding a
# large share of a very large feed cannot overflow its own report row.
GOLD_SCHEMAS = {
    "daily_store_sales": _struct(
        report_date="date", store_id="integer", store_name="string",
        total_revenue="decimal(20,2)", transaction_count="long", avg_basket_size="decimal(10,2)",
        _refreshed_at="timestamp", sales_month="date",
    ),
    "inventory_health": _struct(
        store_id="integer", products_below_reorder="long", total_products="long",
        reorder_rate="decimal(5,2)", _refreshed_at="timestamp", snapshot_date="date",
    ),
}

# What the checks need of every segment, so that they read no old rows.
METRIC_SCHEMAS = {
    "transactions": _struct(
        report_date="date", store_id="integer", cents="long", transaction_count="long", amounts="long",
        negative="long", txn_month="date", txn_year="integer",
    ),
    "filters": _struct(level="integer", word="long", bits="long", txn_month="date", txn_year="integer"),
    "quarantine": _struct(reject_rule="string", rows="long", _batch_id="string"),
    "recovered": _struct(_id="long", run_id="string", _batch_id="string"),
    "changes": _struct(
        _id="long", number="long", step="integer", run_id="string", change="string", reject_rule="string",
        _batch_id="string",
    ),
}
