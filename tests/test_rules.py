"""One row per rule and boundary, plus invariants between silver and quarantine."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallymart import schemas as S
from tallymart.plans import silver

AS_OF = "2024-06-01 12:00:00"
GOOD_ID = "abc12345-1234-1234-1234-abc123456789"
GOOD = {
    "transaction_id": GOOD_ID, "store_id": "1", "product_id": "10", "quantity": "5",
    "unit_price": "9.99", "transaction_ts": "2024-01-15 10:00:00",
    "payment_method": "card", "cashier_id": "1",
}


def bronze(spark, feed: str, rows: list[dict]):
    schema = S.bronze_schema(feed)
    full = []
    for i, row in enumerate(rows):
        base = {"_id": i, "_batch_id": "b", "_source_file": "f", "_ingested_at": None}
        full.append(tuple({**base, **row}.get(name) for name in schema.names))
    return spark.createDataFrame(full, schema).withColumn(
        "_ingested_at", F.lit("2024-05-01").cast("timestamp")
    )


TX_CASES = [
    ({}, None),
    ({"transaction_id": None}, "missing_transaction_id"),
    ({"transaction_id": "ghi12345-1234-1234-1234-ghi123456789"}, "malformed_transaction_id"),
    ({"transaction_id": GOOD_ID.upper()}, "malformed_transaction_id"),
    ({"transaction_id": GOOD_ID + "\n"}, "malformed_transaction_id"),
    ({"quantity": None}, "malformed_quantity"),
    ({"quantity": "-2"}, "malformed_quantity"),
    ({"quantity": "+2"}, "malformed_quantity"),
    ({"quantity": " 2"}, "malformed_quantity"),
    ({"quantity": "5.0"}, "malformed_quantity"),
    ({"quantity": "5\n"}, "malformed_quantity"),
    ({"quantity": "0"}, "quantity_not_positive"),
    ({"quantity": "007"}, None),
    ({"quantity": "99999999999"}, "quantity_out_of_range"),
    ({"unit_price": "0"}, None),
    ({"unit_price": "9.995"}, None),
    ({"unit_price": "-9.99"}, "malformed_unit_price"),
    ({"unit_price": "9."}, "malformed_unit_price"),
    ({"unit_price": ".5"}, "malformed_unit_price"),
    ({"unit_price": "1e3"}, "malformed_unit_price"),
    ({"unit_price": None}, "malformed_unit_price"),
    ({"unit_price": "100000000"}, "unit_price_out_of_range"),
    ({"store_id": None}, "bad_store_id"),
    ({"store_id": "5.0"}, "bad_store_id"),
    ({"store_id": "0"}, None),
    ({"product_id": "x"}, "bad_product_id"),
    ({"cashier_id": "x"}, None),
    ({"quantity": "99999999", "unit_price": "99999999"}, "total_amount_out_of_range"),
    ({"transaction_ts": None}, "bad_transaction_ts"),
    ({"transaction_ts": "now"}, "bad_transaction_ts"),
    ({"transaction_ts": "2024"}, "bad_transaction_ts"),
    ({"transaction_ts": "10:00:00"}, "bad_transaction_ts"),
    ({"transaction_ts": "2024-13-01 10:00:00"}, "bad_transaction_ts"),
    ({"transaction_ts": "2024-01-15"}, None),
    ({"transaction_ts": "2024-01-15T10:00:00Z"}, None),
    ({"transaction_ts": AS_OF}, None),
    ({"transaction_ts": "2024-06-01 12:00:01"}, silver.FUTURE_RULE),
    ({"transaction_ts": "2099-01-01 00:00:00"}, silver.FUTURE_RULE),
    ({"quantity": "0", "transaction_ts": "2099-01-01 00:00:00"}, "quantity_not_positive"),
]


def test_transaction_rules(spark):
    frame = bronze(spark, "raw_transactions", [{**GOOD, **over} for over, _ in TX_CASES])
    got = {r._id: r.reject_rule for r in silver.classify_transactions(frame, AS_OF).collect()}
    wrong = [(c, got[i]) for i, c in enumerate(TX_CASES) if got[i] != c[1]]
    assert not wrong


def test_typed_values(spark):
    rows = [
        {**GOOD, "unit_price": "9.995", "quantity": "3", "cashier_id": "x"},
        {**GOOD, "transaction_id": GOOD_ID.replace("a", "d"), "unit_price": "0"},
    ]
    out = silver.silver_transactions(bronze(spark, "raw_transactions", rows), AS_OF)
    assert dict(out.dtypes)["total_amount"] == "decimal(10,2)"
    by_id = {r.transaction_id: r for r in out.collect()}
    first, second = by_id[GOOD_ID], by_id[GOOD_ID.replace("a", "d")]
    # The price is rounded before it is multiplied.
    assert (str(first.unit_price), str(first.total_amount)) == ("10.00", "30.00")
    assert first.cashier_id is None and str(first.txn_month) == "2024-01-01"
    assert str(second.total_amount) == "0.00"


def test_first_loaded_row_wins_and_the_rest_is_quarantined(spark):
    rows = [
        {**GOOD, "quantity": "7"}, {**GOOD, "quantity": "8"}, {**GOOD, "quantity": "bad"},
        {**GOOD, "transaction_id": None}, {**GOOD, "transaction_id": None},
    ]
    frame = bronze(spark, "raw_transactions", rows)
    kept = silver.silver_transactions(frame, AS_OF)
    assert [(r.quantity, r._bronze_id) for r in kept.collect()] == [(7, 0)]
    held = silver.quarantine_transactions(frame, kept, AS_OF)
    assert {r._id: r.reject_rule for r in held.collect()} == {
        1: silver.DUPLICATE_RULE, 2: "malformed_quantity",
        3: "missing_transaction_id", 4: "missing_transaction_id",
    }
    flagged = silver.flagged_bronze(frame, held)
    assert {r._id: r._is_quarantined for r in flagged.collect()} == {
        0: False, 1: True, 2: True, 3: True, 4: True,
    }


@pytest.mark.parametrize("hot", [0.34, 1.0])
def test_hot_id_leaves_the_map_side_once_per_task(spark, hot):
    """A third (or all) of the rows share one id: one row per task reaches the shuffle."""
    n, tasks = 3000, 6
    frame = (
        spark.range(0, n, 1, tasks)
        .select(
            F.col("id").alias("_id"),
            F.lit("b").alias("_batch_id"),
            F.lit("2024-05-01").cast("timestamp").alias("_ingested_at"),
            F.when(F.col("id") < int(n * hot), F.lit(GOOD_ID))
            .otherwise(F.format_string("%08x-0000-0000-0000-000000000000", F.col("id")))
            .alias("transaction_id"),
            *[F.lit(v).alias(k) for k, v in GOOD.items() if k != "transaction_id"],
        )
    )
    kept = silver.silver_transactions(frame, AS_OF)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    rows = n - int(n * hot) + 1
    assert kept.count() == rows
    assert kept.filter(F.col("transaction_id") == GOOD_ID).first()._bronze_id == 0


INVENTORY = {
    "store_id": "1", "product_id": "10", "stock_level": "5", "reorder_point": "10",
    "last_restocked": "2024-01-01", "supplier_id": "1",
}
INVENTORY_CASES = [
    ({}, None),
    ({"store_id": None}, "missing_store_id"),
    ({"product_id": None}, "missing_product_id"),
    ({"stock_level": "abc"}, "malformed_stock_level"),
    ({"stock_level": None}, "malformed_stock_level"),
    ({"stock_level": "99999999999"}, "stock_level_out_of_range"),
    ({"reorder_point": "-5"}, "malformed_reorder_point"),
    ({"reorder_point": "99999999999"}, "reorder_point_out_of_range"),
    ({"store_id": "x"}, "bad_store_id"),
    ({"product_id": "1.5"}, "bad_product_id"),
    ({"last_restocked": "x", "supplier_id": "x"}, None),
]


def test_inventory_rules(spark):
    frame = bronze(spark, "raw_inventory", [{**INVENTORY, **o} for o, _ in INVENTORY_CASES])
    got = {r._id: r.reject_rule for r in silver.classify_inventory(frame).collect()}
    assert [(c, got[i]) for i, c in enumerate(INVENTORY_CASES) if got[i] != c[1]] == []
    held = silver.rejected_rows(silver.classify_inventory(frame), "raw_inventory")
    assert held.count() == sum(rule is not None for _, rule in INVENTORY_CASES)


def test_inventory_newest_row_and_reorder_flag(spark):
    rows = [
        INVENTORY,
        {**INVENTORY, "stock_level": "10", "last_restocked": "bad"},
        {**INVENTORY, "product_id": "20", "stock_level": "9"},
    ]
    out = silver.silver_inventory(bronze(spark, "raw_inventory", rows), AS_OF)
    got = {r.product_id: (r.stock_level, r.is_below_reorder, r.last_restocked) for r in out.collect()}
    assert got[10] == (10, False, None)  # equal to the reorder point is not below it
    assert got[20][:2] == (9, True)


def test_store_rules(spark):
    store = {"store_id": "1", "store_name": "A", "opened_date": "2020-01-01"}
    cases = [
        ({}, None), ({"store_id": None}, "missing_store_id"),
        ({"store_name": None}, "missing_store_name"), ({"store_id": "A1"}, "bad_store_id"),
        ({"opened_date": "soon"}, None),
    ]
    frame = bronze(spark, "raw_stores", [{**store, **o} for o, _ in cases])
    got = {r._id: r.reject_rule for r in silver.classify_stores(frame).collect()}
    assert [got[i] for i in range(len(cases))] == [rule for _, rule in cases]
    kept = silver.silver_stores(frame).collect()
    assert [(r.store_id, r.store_name, r.opened_date) for r in kept] == [(1, "A", None)]
