"""Silver: typed, valid, one row per business key; the rest is quarantined with a rule name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart import schemas as S
from tallymart.functions import parsing as P
from tallymart.functions.clock import as_timestamp, utc_date
from tallymart.functions.rules import first_failing
from tallymart.operators import key_bits
from tallymart.operators.keyed import insert_if_absent, keep_first, without_match

# The number first: sorts compare it before the longer text.
BRONZE_KEY = ["_id", "_batch_id"]
DUPLICATE_RULE = "duplicate_transaction_id"
FUTURE_RULE = "future_transaction"


def _oldest_first() -> list[Column]:
    return [F.col("_ingested_at").asc(), F.col("_batch_id").asc(), F.col("_id").asc()]


def _newest_first() -> list[Column]:
    return [
        F.col("_ingested_at").desc_nulls_first(), F.col("_batch_id").desc(), F.col("_id").desc(),
    ]


def with_typed_row(bronze: DataFrame, *columns: Column) -> DataFrame:
    """Add the parsed columns as one struct ``typed``.

    Exploding a one-element array parses every row once. As a plain projection Spark
    would copy each parse into every filter and rule that reads its result.
    """
    return bronze.select("*", F.explode(F.array(F.struct(*columns))).alias("typed"))


def _number_rules(name: str, pattern: str) -> list[tuple[str, Column]]:
    """Text of the wrong form, then numbers that do not fit; only failed parses are re-read."""
    parsed = F.col(f"typed.{name}").isNotNull()
    return [
        (f"malformed_{name}", parsed | P.matches(F.col(name), pattern)),
        (f"{name}_out_of_range", parsed),
    ]


# --- transactions -----------------------------------------------------------


def classify_transactions(bronze: DataFrame, as_of=None) -> DataFrame:
    """Bronze rows plus the typed row and the first rule the row breaks (NULL if none).

    The future rule comes last: it is the only one a row can outgrow.
    """
    raw = {c: F.col(c) for c in S.FEED_COLUMNS["raw_transactions"]}
    typed = {c: F.col(f"typed.{c}") for c in S.FEED_COLUMNS["raw_transactions"]}
    parsed = with_typed_row(
        bronze,
        raw["transaction_id"].alias("transaction_id"),
        P.to_int(raw["store_id"]).alias("store_id"),
        P.to_int(raw["product_id"]).alias("product_id"),
        P.to_count(raw["quantity"]).alias("quantity"),
        P.to_price(raw["unit_price"]).alias("unit_price"),
        P.to_timestamp(raw["transaction_ts"]).alias("transaction_ts"),
        raw["payment_method"].alias("payment_method"),
        P.to_int(raw["cashier_id"]).alias("cashier_id"),
    )
    amount = (typed["quantity"] * typed["unit_price"]).try_cast("decimal(10,2)")
    rules = [
        ("missing_transaction_id", raw["transaction_id"].isNotNull()),
        ("malformed_transaction_id", P.matches(raw["transaction_id"], S.UUID_PATTERN)),
        *_number_rules("quantity", S.DIGITS_PATTERN),
        ("quantity_not_positive", typed["quantity"] > 0),
        *_number_rules("unit_price", S.PRICE_PATTERN),
        ("bad_store_id", typed["store_id"].isNotNull()),
        ("bad_product_id", typed["product_id"].isNotNull()),
        ("total_amount_out_of_range", amount.isNotNull()),
        ("bad_transaction_ts", typed["transaction_ts"].isNotNull()),
        (FUTURE_RULE, typed["transaction_ts"] <= as_timestamp(as_of)),
    ]
    return parsed.withColumns({"total_amount": amount, "reject_rule": first_failing(rules)})


def silver_transactions(
    bronze: DataFrame, as_of=None, order: Sequence[Column] | None = None
) -> DataFrame:
    """Valid rows, the first per ``transaction_id``; ``order`` defaults to load order."""
    valid = (
        classify_transactions(bronze, as_of)
        .filter(F.col("reject_rule").isNull())
        .select("typed.*", "total_amount", "_ingested_at", "_batch_id", "_id")
    )
    return keep_first(valid, ["transaction_id"], order or _oldest_first()).select(
        "transaction_id", "store_id", "product_id", "quantity", "unit_price", "total_amount",
        "transaction_ts", "payment_method", "cashier_id",
        F.col("_batch_id").alias("_bronze_batch_id"),
        F.col("_id").alias("_bronze_id"),
        as_timestamp(as_of).alias("_transformed_at"),
        F.trunc(utc_date(F.col("transaction_ts")), "MM").alias("txn_month"),
    )


def silver_keys(silver: DataFrame) -> DataFrame:
    """The bronze keys that reached silver."""
    return silver.select(
        F.col("_bronze_batch_id").alias("_batch_id"), F.col("_bronze_id").alias("_id")
    )


def quarantine_transactions(bronze: DataFrame, silver: DataFrame, as_of=None) -> DataFrame:
    """Bronze rows without a silver row, with the fixed reason and the rule that explains it.

    The match is on the bronze key, which is unique, so no key is hot however often a
    transaction repeats. Rows that break a rule match nothing: they pass through the same join,
    so that bronze is read and classified once.
    """
    classified, keys = classify_transactions(bronze, as_of).alias("c"), silver_keys(silver).alias("s")
    same = [F.col(f"c.{k}") == F.col(f"s.{k}") for k in BRONZE_KEY]
    return _as_held(classified.join(keys, [*same, F.col("c.reject_rule").isNull()], "left_anti"))


def quarantine_by_bits(bronze: DataFrame, reached: DataFrame, many: int, as_of=None) -> DataFrame:
    """``quarantine_transactions`` where the bronze keys in silver are given as ``many`` stored
    ``key_bits`` blocks: bronze isn't shuffled for the match."""
    found = key_bits.marked(classify_transactions(bronze, as_of), reached, many, *BRONZE_KEY, "_reached")
    return _as_held(found.filter(F.col("reject_rule").isNotNull() | ~F.col("_reached")))


def _as_held(lost: DataFrame) -> DataFrame:
    return lost.select(
        "_id", "_ingested_at", "_source_file", *S.FEED_COLUMNS["raw_transactions"],
        F.lit(S.QUARANTINE_REASON).alias("_quarantine_reason"), "_batch_id",
        F.coalesce(F.col("reject_rule"), F.lit(DUPLICATE_RULE)).alias("reject_rule"),
    )


def loss_by_rule(bronze: DataFrame, as_of=None) -> DataFrame:
    """``(reject_rule, rows)`` for bronze rows of one load, without a join: the rows of each
    rule, and as duplicates the valid rows beyond one for each id.

    An id's rows are cut to one count per task before they are shuffled, so a hot id costs
    a row per task.
    """
    per_id = (
        classify_transactions(bronze, as_of)
        .withColumn("_valid_id", F.when(F.col("reject_rule").isNull(), F.col("transaction_id")))
        .groupBy("reject_rule", "_valid_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    lost = F.when(F.col("reject_rule").isNull(), F.col("rows") - 1).otherwise(F.col("rows"))
    rule = F.coalesce(F.col("reject_rule"), F.lit(DUPLICATE_RULE))
    return per_id.groupBy(rule.alias("reject_rule")).agg(F.sum(lost).alias("rows"), F.sum("rows").alias("seen"))


def flagged_transactions(bronze: DataFrame, silver: DataFrame, as_of=None) -> DataFrame:
    """Bronze with its quarantine flag and reason, from one match of keys: what broke a rule
    or has no silver row is flagged."""
    keys = silver_keys(silver).withColumn("_in_silver", F.lit(True))
    classified = classify_transactions(bronze, as_of).drop("_is_quarantined", "_quarantine_reason", "typed")
    joined = classified.join(keys, BRONZE_KEY, "left")
    held = F.col("reject_rule").isNotNull() | F.col("_in_silver").isNull()
    return joined.select(
        *BRONZE_KEY, *S.FEED_COLUMNS["raw_transactions"], held.alias("_is_quarantined"),
        F.when(held, F.lit(S.QUARANTINE_REASON)).alias("_quarantine_reason"),
    )


def current_quarantine(quarantine: DataFrame, silver: DataFrame) -> DataFrame:
    """Quarantined rows minus those that have entered silver since.

    Only rows held back for their date can do so; the others are not matched at all.
    """
    waiting = F.col("reject_rule") == FUTURE_RULE
    still_waiting = insert_if_absent(silver_keys(silver), quarantine.filter(waiting), BRONZE_KEY)
    return quarantine.filter(~waiting).unionByName(still_waiting)


def flagged_bronze(bronze: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Bronze with its quarantine flag and reason filled in from the quarantine table."""
    hits = quarantine.select(*BRONZE_KEY, F.col("_quarantine_reason").alias("_reason"))
    return (
        bronze.drop("_is_quarantined", "_quarantine_reason")
        .join(hits, BRONZE_KEY, "left")
        .withColumn("_is_quarantined", F.col("_reason").isNotNull())
        .withColumnRenamed("_reason", "_quarantine_reason")
    )


def quarantine_by_reason(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("reject_rule").agg(F.count(F.lit(1)).alias("rows"))


# --- inventory --------------------------------------------------------------


def classify_inventory(bronze: DataFrame) -> DataFrame:
    raw = {c: F.col(c) for c in S.FEED_COLUMNS["raw_inventory"]}
    parsed = with_typed_row(
        bronze,
        P.to_int(raw["store_id"]).alias("store_id"),
        P.to_int(raw["product_id"]).alias("product_id"),
        P.to_count(raw["stock_level"]).alias("stock_level"),
        P.to_count(raw["reorder_point"]).alias("reorder_point"),
        P.to_date(raw["last_restocked"]).alias("last_restocked"),
        P.to_int(raw["supplier_id"]).alias("supplier_id"),
    )
    rules = [
        ("missing_store_id", raw["store_id"].isNotNull()),
        ("missing_product_id", raw["product_id"].isNotNull()),
        *_number_rules("stock_level", S.DIGITS_PATTERN),
        *_number_rules("reorder_point", S.DIGITS_PATTERN),
        ("bad_store_id", F.col("typed.store_id").isNotNull()),
        ("bad_product_id", F.col("typed.product_id").isNotNull()),
    ]
    return parsed.withColumn("reject_rule", first_failing(rules))


def silver_inventory(
    bronze: DataFrame, as_of=None, order: Sequence[Column] | None = None
) -> DataFrame:
    """Valid rows, the newest per store and product."""
    valid = (
        classify_inventory(bronze)
        .filter(F.col("reject_rule").isNull())
        .select("typed.*", "_ingested_at", "_batch_id", "_id")
    )
    return keep_first(valid, ["store_id", "product_id"], order or _newest_first()).select(
        "store_id", "product_id", "stock_level", "reorder_point",
        (F.col("stock_level") < F.col("reorder_point")).alias("is_below_reorder"),
        "last_restocked", "supplier_id", as_timestamp(as_of).alias("_transformed_at"),
        "_ingested_at",
    )


def inventory_of(bronze: DataFrame, keys: DataFrame, as_of=None) -> DataFrame:
    """Silver inventory of the given keys after all loads: the newest valid row of each with the
    supplier of its oldest one, from one pass over bronze."""
    key = ["store_id", "product_id"]
    valid = classify_inventory(bronze).filter(F.col("reject_rule").isNull()).select("typed.*", "_ingested_at", "_batch_id", "_id")
    at = F.col("_ingested_at")
    newest = F.struct(at.isNull(), at, "_batch_id", "_id")
    oldest = F.struct(at.isNotNull(), at, "_batch_id", -F.col("_id"))
    values = F.struct("stock_level", "reorder_point", "last_restocked", "_ingested_at")
    found = valid.join(keys, key, "left_semi").groupBy(*key).agg(
        F.max_by(values, newest).alias("last"), F.min_by("supplier_id", oldest).alias("supplier_id")
    )
    return found.select(
        *key, "last.stock_level", "last.reorder_point",
        (F.col("last.stock_level") < F.col("last.reorder_point")).alias("is_below_reorder"),
        "last.last_restocked", "supplier_id", as_timestamp(as_of).alias("_transformed_at"), "last._ingested_at",
    )


# --- stores -----------------------------------------------------------------


def classify_stores(bronze: DataFrame) -> DataFrame:
    parsed = with_typed_row(
        bronze,
        P.to_int(F.col("store_id")).alias("store_id"),
        F.col("store_name"), F.col("city"), F.col("region"), F.col("store_type"),
        P.to_date(F.col("opened_date")).alias("opened_date"),
    )
    rules = [
        ("missing_store_id", F.col("store_id").isNotNull()),
        ("missing_store_name", F.col("store_name").isNotNull()),
        ("bad_store_id", F.col("typed.store_id").isNotNull()),
    ]
    return parsed.withColumn("reject_rule", first_failing(rules))


def silver_stores(
    bronze: DataFrame, as_of=None, order: Sequence[Column] | None = None
) -> DataFrame:
    """Named stores, the newest row per store."""
    valid = (
        classify_stores(bronze)
        .filter(F.col("reject_rule").isNull())
        .select("typed.*", "_ingested_at", "_batch_id", "_id")
    )
    return keep_first(valid, ["store_id"], order or _newest_first()).select(
        "store_id", "store_name", "city", "region", "store_type", "opened_date",
        as_timestamp(as_of).alias("_transformed_at"), "_ingested_at",
    )


def rejected_rows(classified: DataFrame, feed: str) -> DataFrame:
    """Rows of an inventory or store classification that broke a rule."""
    return classified.filter(F.col("reject_rule").isNotNull()).select(
        "_id", "_ingested_at", "_source_file", *S.FEED_COLUMNS[feed],
        F.lit(S.QUARANTINE_REASON).alias("_quarantine_reason"), "_batch_id", "reject_rule",
    )
