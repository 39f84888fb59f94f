"""The three feeds and the run events in the shape of the given star-schema tables.

Faults are arithmetic on the keys, so any engine derives the same rows. Rows are
identified by file and position, which stay the same when a task is run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.clock import utc_instant, zoned

# Fixed clock of the derived data: the not-in-future rule and the report windows.
AS_OF = "2002-01-01 00:00:00"
AS_OF_DATE = "2001-11-04"
BATCH_SPLIT = "1999-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _local_text(column: str, length: int):
    """The first characters of a timestamp without zone as text."""
    return F.substring(F.col(column).cast("timestamp_ntz").cast("string"), 1, length)


def _lineitem(spark: SparkSession, sf_dir: str, batch: int | None) -> DataFrame:
    """All rows, or the ones shipped before (batch 1) or after (batch 2) the split."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity",
        "l_extendedprice", "l_shipdate",
        F.col("_metadata.row_index").alias("_id"),
        F.col("_metadata.file_path").alias("_source_file"),
    )
    split = F.lit(BATCH_SPLIT).cast("timestamp_ntz")
    if batch == 1:
        return lines.filter(F.col("l_shipdate") < split)
    if batch == 2:
        return lines.filter(F.col("l_shipdate") >= split)
    return lines


def _provenance(ingested_at) -> list:
    return [
        F.col("_id"),
        ingested_at.alias("_ingested_at"),
        F.col("_source_file"),
        F.lit(False).alias("_is_quarantined"),
        F.lit(None).cast("string").alias("_quarantine_reason"),
    ]


def raw_transactions(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    order, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    cents = F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
    price = (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")
    methods = {0: "card", 1: "cash", 2: "contactless", 3: "mobile"}
    method = F.coalesce(
        *[F.when(F.col("l_linenumber") % 4 == i, F.lit(m)) for i, m in methods.items()]
    )
    return _lineitem(spark, sf_dir, batch).select(
        *_provenance(zoned(F.lit(AS_OF)).cast("timestamp")),
        F.when(k % 103 == 5, F.concat(F.lit("ghi12345-"), order))
        .when(
            k % 97 != 0,
            F.concat(
                F.lit("00000000-0000-0000-"), F.lpad(line, 4, "0"),
                F.lit("-"), F.lpad(order, 12, "0"),
            ),
        ).alias("transaction_id"),
        F.when(k % 127 == 9, F.lit("S1")).otherwise(F.col("l_suppkey").cast("string")).alias("store_id"),
        F.when(k % 131 == 10, F.lit("P")).otherwise(F.col("l_partkey").cast("string")).alias("product_id"),
        F.when(k % 89 == 1, F.lit("-1"))
        .when(k % 101 == 4, F.lit("abc"))
        .when(k % 107 == 6, F.lit("99999999999"))
        .when(k % 109 == 7, F.lit("0"))
        .when(k % 137 == 11, F.lit("2000000000"))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.when(k % 83 == 2, F.lit("-9.99"))
        .when(k % 113 == 8, F.lit("123456789012.00"))
        .otherwise(price.cast("string")).alias("unit_price"),
        F.when(k % 79 == 3, F.lit("2099-01-01 00:00:00"))
        .when(k % 139 == 12, F.lit("not a time"))
        .otherwise(_local_text("l_shipdate", 19))
        .alias("transaction_ts"),
        method.alias("payment_method"),
        (F.col("l_orderkey") % 50 + 1).cast("string").alias("cashier_id"),
        F.col("_source_file").alias("_batch_id"),
    )


def raw_inventory(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    stock = (part * 31 + F.col("l_quantity").cast("bigint") * 7) % 200
    return _lineitem(spark, sf_dir, batch).select(
        *_provenance(utc_instant(F.col("l_shipdate"))),
        F.when(order % 61 != 7, F.col("l_suppkey").cast("string")).alias("store_id"),
        part.cast("string").alias("product_id"),
        F.when(order % 53 == 5, F.lit("abc")).otherwise(stock.cast("string")).alias("stock_level"),
        F.when(order % 59 == 6, F.lit("-5"))
        .otherwise((part % 41 + 10).cast("string"))
        .alias("reorder_point"),
        _local_text("l_shipdate", 10).alias("last_restocked"),
        (part % 20 + 1).cast("string").alias("supplier_id"),
        F.col("_source_file").alias("_batch_id"),
    )


def raw_stores(spark: SparkSession, sf_dir: str, revision: int = 1) -> DataFrame:
    """Stores; revision 1 lacks a few names, revision 2 has all of them, renames every
    fifth store and moves its opening day."""
    key = F.col("s_suppkey")
    types = {0: "flagship", 1: "warehouse", 2: "outlet"}
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        "*",
        F.col("_metadata.row_index").alias("_id"),
        F.col("_metadata.file_path").alias("_source_file"),
    )
    renamed = (key % 5 == 3) if revision == 2 else F.lit(False)
    name = F.when(renamed, F.concat(F.col("s_name"), F.lit(" II"))).otherwise(F.col("s_name"))
    age = (key % 1800 + F.when(renamed, F.lit(1)).otherwise(F.lit(0))).cast("int")
    return suppliers.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "_id",
        F.lit(AS_OF).cast("timestamp").alias("_ingested_at"),
        "_source_file",
        key.cast("string").alias("store_id"),
        (F.when(key % 41 != 40, name) if revision == 1 else name).alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.coalesce(*[F.when(key % 3 == i, F.lit(t)) for i, t in types.items()]).alias("store_type"),
        F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), age), "yyyy-MM-dd").alias(
            "opened_date"
        ),
        F.col("_source_file").alias("_batch_id"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user and day; every event is a step of that run."""
    status = (
        F.when(F.col("event_type").isin("view", "click"), F.lit("running"))
        .when(F.col("event_type").isin("signup", "purchase"), F.lit("success"))
        .when(F.col("event_type") == "error", F.lit("failed"))
    )
    return table(spark, sf_dir, "events").select(
        F.concat(
            F.col("user_id").cast("string"), F.lit("-"), F.replace(_local_text("ts", 10), F.lit("-"))
        ).alias("run_id"),
        F.lit("daily").alias("flow_name"),
        F.col("event_id").alias("seq"),
        utc_instant(F.col("ts")).alias("ts"),
        status.alias("status"),
        (F.col("event_id") % 1000).alias("records_loaded"),
        (F.col("event_id") % 10).alias("records_quarantined"),
        F.when(status == "failed", F.concat(F.lit("event "), F.col("event_id").cast("string")))
        .alias("error_message"),
    )
