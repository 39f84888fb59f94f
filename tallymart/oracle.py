"""The registered queries once more, as SQL for an independent engine."""

from __future__ import annotations

# Each view names the views it builds on, so a query carries only what it needs.
_VIEWS: dict[str, tuple[list[str], str]] = {}


def _view(name: str, needs: list[str], sql: str) -> None:
    _VIEWS[name] = (needs, sql)


def _with(needs: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in _VIEWS[name][0]:
                add(need)
            ordered.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{name} AS (\n{_VIEWS[name][1]}\n)" for name in ordered)
    return f"WITH {ctes}\n{body}"


def _cents(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,2))"


def _text(expr: str) -> str:
    """Money as text, so that the scale is compared as well."""
    return f"CAST({expr} AS VARCHAR)"


def _ratio(num: str, den: str) -> str:
    return f"CAST((2 * {num} + {den}) // (2 * nullif({den}, 0)) AS BIGINT)"


_TS = "'%Y-%m-%d %H:%M:%S'"

_view("raw_tx", [], f"""
SELECT l_shipdate AS src_ts,
       CASE WHEN k % 103 = 5 THEN concat('ghi12345-', CAST(l_orderkey AS VARCHAR))
            WHEN k % 97 = 0 THEN NULL ELSE
         concat('00000000-0000-0000-', lpad(CAST(l_linenumber AS VARCHAR), 4, '0'), '-',
                lpad(CAST(l_orderkey AS VARCHAR), 12, '0')) END AS transaction_id,
       CASE WHEN k % 127 = 9 THEN 'S1' ELSE CAST(l_suppkey AS VARCHAR) END AS store_id,
       CASE WHEN k % 131 = 10 THEN 'P' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
       CASE WHEN k % 89 = 1 THEN '-1' WHEN k % 101 = 4 THEN 'abc'
            WHEN k % 107 = 6 THEN '99999999999' WHEN k % 109 = 7 THEN '0'
            WHEN k % 137 = 11 THEN '2000000000'
            ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
       CASE WHEN k % 83 = 2 THEN '-9.99' WHEN k % 113 = 8 THEN '123456789012.00' ELSE
         CAST(CAST(CAST(CAST(round(l_extendedprice * 100 / l_quantity) AS BIGINT)
              AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS VARCHAR)
         END AS unit_price,
       CASE WHEN k % 79 = 3 THEN '2099-01-01 00:00:00' WHEN k % 139 = 12 THEN 'not a time'
            ELSE strftime(l_shipdate, {_TS}) END AS transaction_ts,
       CASE l_linenumber % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'cash'
            WHEN 2 THEN 'contactless' ELSE 'mobile' END AS payment_method,
       CAST(l_orderkey % 50 + 1 AS VARCHAR) AS cashier_id
FROM (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem)
""")


def _tx_views(suffix: str, where: str) -> None:
    _view(f"ruled{suffix}", ["raw_tx"], f"""
SELECT *, CASE
  WHEN transaction_id IS NULL THEN 'missing_transaction_id'
  WHEN NOT regexp_full_match(transaction_id,
    '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}')
    THEN 'malformed_transaction_id'
  WHEN NOT regexp_full_match(quantity, '[0-9]+') THEN 'malformed_quantity'
  WHEN TRY_CAST(quantity AS INTEGER) IS NULL THEN 'quantity_out_of_range'
  WHEN TRY_CAST(quantity AS INTEGER) <= 0 THEN 'quantity_not_positive'
  WHEN NOT regexp_full_match(unit_price, '[0-9]+(\\.[0-9]+)?') THEN 'malformed_unit_price'
  WHEN TRY_CAST(unit_price AS DECIMAL(10,2)) IS NULL THEN 'unit_price_out_of_range'
  WHEN TRY_CAST(store_id AS INTEGER) IS NULL THEN 'bad_store_id'
  WHEN TRY_CAST(product_id AS INTEGER) IS NULL THEN 'bad_product_id'
  WHEN CAST(quantity AS HUGEINT) * CAST(CAST(unit_price AS DECIMAL(10,2)) * 100 AS HUGEINT)
       > 9999999999 THEN 'total_amount_out_of_range'
  WHEN TRY_CAST(transaction_ts AS TIMESTAMP) IS NULL THEN 'bad_transaction_ts'
  WHEN TRY_CAST(transaction_ts AS TIMESTAMP) > TIMESTAMP '2002-01-01 00:00:00'
    THEN 'future_transaction'
  END AS rule
FROM raw_tx WHERE {where}
""")
    _view(f"ranked{suffix}", [f"ruled{suffix}"], f"""
SELECT *, row_number() OVER (
    PARTITION BY rule IS NULL, transaction_id
    ORDER BY TRY_CAST(transaction_ts AS TIMESTAMP), TRY_CAST(store_id AS INTEGER),
             TRY_CAST(product_id AS INTEGER), TRY_CAST(quantity AS INTEGER),
             TRY_CAST(unit_price AS DECIMAL(10,2))) AS rn
FROM ruled{suffix}
""")
    _view(f"silver_tx{suffix}", [f"ranked{suffix}"], f"""
SELECT transaction_id, CAST(store_id AS INTEGER) AS store_id,
       CAST(product_id AS INTEGER) AS product_id, CAST(quantity AS INTEGER) AS quantity,
       CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(quantity AS INTEGER) * CAST(unit_price AS DECIMAL(10,2)) AS DECIMAL(10,2))
         AS total_amount,
       CAST(transaction_ts AS TIMESTAMP) AS transaction_ts, payment_method,
       CAST(cashier_id AS INTEGER) AS cashier_id
FROM ranked{suffix} WHERE rule IS NULL AND rn = 1
""")


_tx_views("", "true")
_tx_views("_b1", "src_ts < TIMESTAMP '1999-01-01 00:00:00'")
_tx_views("_b2", "src_ts >= TIMESTAMP '1999-01-01 00:00:00'")

_view("silver_tx_merged", ["silver_tx_b1", "silver_tx_b2"], """
SELECT * FROM silver_tx_b1
UNION ALL
SELECT * FROM silver_tx_b2 b
WHERE NOT EXISTS (SELECT 1 FROM silver_tx_b1 a WHERE a.transaction_id = b.transaction_id)
""")

# The first batch without its card sales, as its corrected file has it.
_tx_views("_b1c", "src_ts < TIMESTAMP '1999-01-01 00:00:00' AND payment_method <> 'card'")

_view("silver_tx_freed", ["silver_tx_b1c", "silver_tx_b2"], """
SELECT * FROM silver_tx_b2 ANTI JOIN silver_tx_b1c USING (transaction_id)
""")

_view("silver_tx_reloaded", ["silver_tx_b1c", "silver_tx_freed"], """
SELECT * FROM silver_tx_b1c UNION ALL SELECT * FROM silver_tx_freed
""")

_view("quarantine", ["ranked"], """
SELECT transaction_id, store_id, product_id, quantity, unit_price, transaction_ts,
       payment_method, cashier_id, 'Failed silver transformation checks' AS _quarantine_reason,
       coalesce(rule, 'duplicate_transaction_id') AS reject_rule
FROM ranked WHERE rule IS NOT NULL OR rn > 1
""")

_view("raw_inv", [], """
SELECT l_shipdate AS ingested_at,
       CASE WHEN l_orderkey % 61 = 7 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS store_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CASE WHEN l_orderkey % 53 = 5 THEN 'abc' ELSE
         CAST((l_partkey * 31 + CAST(l_quantity AS BIGINT) * 7) % 200 AS VARCHAR) END
         AS stock_level,
       CASE WHEN l_orderkey % 59 = 6 THEN '-5' ELSE CAST(10 + l_partkey % 41 AS VARCHAR) END
         AS reorder_point,
       strftime(l_shipdate, '%Y-%m-%d') AS last_restocked,
       CAST(l_partkey % 20 + 1 AS VARCHAR) AS supplier_id
FROM lineitem
""")

_view("ruled_inv", ["raw_inv"], """
SELECT *, CASE
  WHEN store_id IS NULL THEN 'missing_store_id'
  WHEN product_id IS NULL THEN 'missing_product_id'
  WHEN NOT regexp_full_match(stock_level, '[0-9]+') THEN 'malformed_stock_level'
  WHEN NOT regexp_full_match(reorder_point, '[0-9]+') THEN 'malformed_reorder_point'
  END AS rule
FROM raw_inv
""")


def _inv_view(suffix: str, where: str) -> None:
    _view(f"silver_inv{suffix}", ["ruled_inv"], f"""
SELECT CAST(store_id AS INTEGER) AS store_id, CAST(product_id AS INTEGER) AS product_id,
       CAST(stock_level AS INTEGER) AS stock_level,
       CAST(reorder_point AS INTEGER) AS reorder_point,
       CAST(stock_level AS INTEGER) < CAST(reorder_point AS INTEGER) AS is_below_reorder,
       CAST(last_restocked AS DATE) AS last_restocked, CAST(supplier_id AS INTEGER) AS supplier_id
FROM ruled_inv WHERE rule IS NULL AND {where}
QUALIFY row_number() OVER (
  PARTITION BY CAST(store_id AS INTEGER), CAST(product_id AS INTEGER)
  ORDER BY ingested_at DESC, CAST(stock_level AS INTEGER) DESC,
           CAST(reorder_point AS INTEGER) DESC) = 1
""")


_inv_view("", "true")
_inv_view("_b1", "ingested_at < TIMESTAMP '1999-01-01 00:00:00'")
_inv_view("_b2", "ingested_at >= TIMESTAMP '1999-01-01 00:00:00'")
_inv_view("_b1c", "ingested_at < TIMESTAMP '1999-01-01 00:00:00' AND product_id NOT LIKE '%4'")


def _store_views(suffix: str, name: str, age: str) -> None:
    _view(f"raw_stores{suffix}", [], f"""
SELECT CAST(s_suppkey AS VARCHAR) AS store_id, {name} AS store_name, n_name AS city,
       r_name AS region,
       CASE s_suppkey % 3 WHEN 0 THEN 'flagship' WHEN 1 THEN 'warehouse' ELSE 'outlet' END
         AS store_type,
       strftime(DATE '1990-01-01' + CAST({age} AS INTEGER), '%Y-%m-%d') AS opened_date
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
""")
    _view(f"silver_stores{suffix}", [f"raw_stores{suffix}"], f"""
SELECT CAST(store_id AS INTEGER) AS store_id, store_name, city, region, store_type,
       CAST(opened_date AS DATE) AS opened_date
FROM raw_stores{suffix} WHERE store_id IS NOT NULL AND store_name IS NOT NULL
""")


_store_views("", "CASE WHEN s_suppkey % 41 = 40 THEN NULL ELSE s_name END", "s_suppkey % 1800")
_store_views(
    "_r2",
    "CASE WHEN s_suppkey % 5 = 3 THEN concat(s_name, ' II') ELSE s_name END",
    "s_suppkey % 1800 + CASE WHEN s_suppkey % 5 = 3 THEN 1 ELSE 0 END",
)


def _sales_view(suffix: str, tx: str, stores: str) -> None:
    cents = "CAST(sum(CAST(total_amount * 100 AS BIGINT)) AS BIGINT)"
    _view(f"gold_sales{suffix}", [tx, stores], f"""
SELECT report_date, store_id, store_name, cents AS revenue_cents, transaction_count,
       {_ratio('cents', 'transaction_count')} AS basket_cents
FROM (SELECT CAST(transaction_ts AS DATE) AS report_date, t.store_id, s.store_name,
             {cents} AS cents, count(*) AS transaction_count
      FROM {tx} t JOIN {stores} s ON t.store_id = s.store_id GROUP BY ALL)
""")


_sales_view("", "silver_tx", "silver_stores")
_sales_view("_b1", "silver_tx_b1", "silver_stores")
_sales_view("_all", "silver_tx_merged", "silver_stores_r2")
_sales_view("_reloaded", "silver_tx_reloaded", "silver_stores_r2")

_view("gold_merged", ["gold_sales_b1", "gold_sales_all"], """
SELECT report_date, store_id,
       CASE WHEN a.hit THEN a.store_name ELSE b.store_name END AS store_name,
       CASE WHEN b.hit THEN b.revenue_cents ELSE a.revenue_cents END AS revenue_cents,
       CASE WHEN b.hit THEN b.transaction_count ELSE a.transaction_count END AS transaction_count,
       CASE WHEN b.hit THEN b.basket_cents ELSE a.basket_cents END AS basket_cents
FROM (SELECT *, true AS hit FROM gold_sales_b1) a
FULL OUTER JOIN (SELECT *, true AS hit FROM gold_sales_all) b USING (report_date, store_id)
""")


def _health_view(suffix: str) -> None:
    _view(f"health{suffix}", [f"silver_inv{suffix}"], f"""
SELECT store_id, below AS products_below_reorder, total AS total_products,
       {_cents(_ratio('below * 10000', 'total'))} AS reorder_rate
FROM (SELECT store_id, CAST(count(*) FILTER (WHERE is_below_reorder) AS BIGINT) AS below,
             count(*) AS total FROM silver_inv{suffix} GROUP BY store_id)
""")


_health_view("")
_health_view("_b1")
_health_view("_b2")

_view("health_merged", ["health_b1", "health_b2"], """
SELECT '1998-12-31' AS snapshot_date, * FROM health_b1
UNION ALL
SELECT '2001-11-04', * FROM health_b2
UNION ALL
SELECT '2001-11-04', * FROM health_b1 a
WHERE NOT EXISTS (SELECT 1 FROM health_b2 b WHERE a.store_id = b.store_id)
""")

_view("runs", [], """
SELECT concat(CAST(user_id AS VARCHAR), '-', strftime(ts, '%Y%m%d')) AS run_id, ts,
       event_id AS seq,
       CASE WHEN event_type IN ('view', 'click') THEN 'running'
            WHEN event_type IN ('signup', 'purchase') THEN 'success' ELSE 'failed' END AS status
FROM events
""")

_view("run_states", ["runs"], """
SELECT run_id, 'daily' AS flow_name, status,
       strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
       CASE WHEN status <> 'running' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS finished_at,
       CAST(seq % 1000 AS BIGINT) AS records_loaded,
       CAST(seq % 10 AS BIGINT) AS records_quarantined,
       CASE WHEN status = 'failed' THEN concat('event ', CAST(seq AS VARCHAR)) END AS error_message
FROM (SELECT *, min(ts) OVER (PARTITION BY run_id) AS started,
             row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) AS rn FROM runs)
WHERE rn = 1
""")

_TX_OUT = f"""transaction_id, store_id, product_id, quantity,
       {_text('unit_price')} AS unit_price, {_text('total_amount')} AS total_amount,
       strftime(transaction_ts, '%Y-%m-%d %H:%M:%S.%f') AS transaction_ts,
       payment_method, cashier_id"""
_INV_OUT = """store_id, product_id, stock_level, reorder_point, is_below_reorder,
       strftime(last_restocked, '%Y-%m-%d') AS last_restocked, supplier_id"""
_STORE_OUT = """store_id, store_name, city, region, store_type,
       strftime(opened_date, '%Y-%m-%d') AS opened_date"""
_SALES_OUT = f"""strftime(report_date, '%Y-%m-%d') AS report_date, store_id, store_name,
       {_text(_cents('revenue_cents'))} AS total_revenue, transaction_count,
       {_text(_cents('basket_cents'))} AS avg_basket_size"""
_HEALTH_OUT = """snapshot_date, store_id, products_below_reorder, total_products,
       CAST(reorder_rate AS VARCHAR) AS reorder_rate"""


def _summary(days: int, today: str = "2001-11-04") -> str:
    """Totals of a period's store-days, beside the store of its best one."""
    return _with(["gold_sales"], f"""
, period AS (
SELECT * FROM gold_sales WHERE date_diff('day', report_date, DATE '{today}') <= {days}
), best AS (
SELECT store_name FROM period ORDER BY revenue_cents DESC, store_name DESC LIMIT 1
), totals AS (
SELECT count(*) AS days, CAST(sum(revenue_cents) AS BIGINT) AS revenue,
       CAST(sum(basket_cents) AS BIGINT) AS baskets FROM period
)
SELECT days AS transaction_count, {_text(_cents('revenue'))} AS total_revenue,
       {_text(_cents(_ratio('baskets', 'days')))} AS avg_basket_size,
       store_name AS top_store
FROM totals LEFT JOIN best ON true
""")


def _idle(since: str = "1900-01-01") -> str:
    """Stores outside the set of those with a sale."""
    return f"""
SELECT store_id, store_name FROM silver_stores
WHERE store_id IN (
  SELECT store_id FROM silver_stores
  EXCEPT
  SELECT store_id FROM silver_tx WHERE transaction_ts >= TIMESTAMP '{since} 00:00:00')
"""


def _check(name: str, severity: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS check_name, '{severity}' AS severity, CAST({value} AS DECIMAL(20,2)) AS result FROM {source}"


def _report(tx: str, held: str, total: str, gold: str, stores: str) -> str:
    """The checks over views of silver, gold and stores; ``held`` and ``total`` count rows."""
    idle = f"(SELECT store_id FROM {stores} EXCEPT SELECT store_id FROM {tx})"
    values = "\nUNION ALL\n".join([
        _check("no_negative_quantities", "error", "coalesce(sum(CAST(quantity <= 0 AS INTEGER)), 0)", tx),
        _check(
            "no_future_transactions", "error",
            "coalesce(sum(CAST(transaction_ts > TIMESTAMP '2002-01-01 00:00:00' AS INTEGER)), 0)", tx,
        ),
        _check(
            "quarantine_rate_under_10pct", "error", _cents(_ratio("held * 10000", "total")),
            f"(SELECT {held} AS held), (SELECT {total} AS total)",
        ),
        _check("silver_transactions_not_empty", "error", "count(*)", tx),
        _check("gold_daily_sales_not_empty", "warning", "count(*)", gold),
        _check("all_stores_have_sales", "warning", "count(*)", idle),
    ])
    return f"""
SELECT check_name, severity, CAST(result AS VARCHAR) AS result, CASE
    WHEN check_name = 'quarantine_rate_under_10pct' THEN coalesce(result, 0) <= 10
    WHEN check_name LIKE '%_not_empty' THEN coalesce(result >= 1, false)
    ELSE coalesce(result = 0, false) END AS passed
FROM ({values})"""


_RAW_TX_COLUMNS = """transaction_id, store_id, product_id, quantity, unit_price,
       transaction_ts, payment_method, cashier_id"""
_RAW_INV_COLUMNS = "store_id, product_id, stock_level, reorder_point, last_restocked, supplier_id"
_RAW_STORE_COLUMNS = "store_id, store_name, city, region, store_type, opened_date"
_REASON = "'Failed silver transformation checks' AS _quarantine_reason"


_SPLIT = "TIMESTAMP '1999-01-01 00:00:00'"
# Rows of every step of two runs; a run's gold rows are those of the months it touched.
_RUN = f"""
, late AS (
SELECT store_id FROM silver_stores_r2 EXCEPT SELECT store_id FROM silver_stores
), months AS (
SELECT DISTINCT date_trunc('month', transaction_ts) AS month
FROM (SELECT * FROM silver_tx_merged EXCEPT SELECT * FROM silver_tx_b1)
UNION
SELECT date_trunc('month', transaction_ts) FROM silver_tx_b1 SEMI JOIN late USING (store_id)
), days AS (
SELECT report_date, store_id FROM gold_sales_b1 UNION SELECT report_date, store_id FROM gold_sales_all
), steps AS (
SELECT 1 AS run, 'raw_stores' AS step, count(*) AS rows FROM supplier
UNION ALL SELECT 2, 'raw_stores', count(*) FROM supplier
UNION ALL SELECT 1, 'raw_inventory', count(*) FROM ruled_inv WHERE ingested_at < {_SPLIT}
UNION ALL SELECT 2, 'raw_inventory', count(*) FROM ruled_inv WHERE ingested_at >= {_SPLIT}
UNION ALL SELECT 1, 'raw_transactions', count(*) FROM ruled_b1
UNION ALL SELECT 2, 'raw_transactions', count(*) FROM ruled_b2
UNION ALL SELECT 1, 'silver_stores', count(*) FROM silver_stores
UNION ALL SELECT 2, 'silver_stores', count(*) FROM silver_stores_r2
UNION ALL SELECT 1, 'silver_inventory', count(*) FROM silver_inv_b1
UNION ALL SELECT 2, 'silver_inventory', count(*) FROM silver_inv_b2
UNION ALL SELECT 1, 'silver_transactions', count(*) FROM silver_tx_b1
UNION ALL SELECT 2, 'silver_transactions',
                 (SELECT count(*) FROM silver_tx_merged) - (SELECT count(*) FROM silver_tx_b1)
UNION ALL SELECT 1, 'gold_daily_sales', count(*) FROM gold_sales_b1
UNION ALL SELECT 2, 'gold_daily_sales', count(*) FROM days
                 WHERE date_trunc('month', report_date) IN (SELECT month FROM months)
UNION ALL SELECT 1, 'gold_inventory_health', count(DISTINCT store_id) FROM silver_inv_b1
UNION ALL SELECT 2, 'gold_inventory_health', count(*)
                 FROM (SELECT store_id FROM silver_inv_b1 UNION SELECT store_id FROM silver_inv_b2)
), every AS (
SELECT * FROM steps
UNION ALL
SELECT a.run, 'quarantined', a.rows - b.rows FROM steps a JOIN steps b USING (run)
WHERE a.step = 'raw_transactions' AND b.step = 'silver_transactions'
), totals AS (
SELECT run, CAST(sum(rows) FILTER (WHERE step LIKE 'raw_%') AS BIGINT) AS loaded,
       CAST(sum(rows) FILTER (WHERE step = 'quarantined') AS BIGINT) AS held
FROM every GROUP BY run
)
SELECT 'run-' || run AS run_id, step, CAST(rows AS BIGINT) AS rows, 'daily' AS flow_name,
       'failed' AS status, loaded AS records_loaded, held AS records_quarantined,
       true AS rate_failed
FROM every JOIN totals USING (run)
"""


def oracle() -> dict[str, str]:
    sql = _oracle()
    sql["csv_ingest_transactions"] = sql["bronze_transactions"]
    sql["csv_ingest_inventory"] = sql["bronze_inventory"]
    sql["csv_ingest_stores"] = sql["bronze_stores"]
    # Two refreshes through files end where the two-batch upsert ends, and so do three if
    # the third is the second again.
    sql["medallion_daily_sales"] = sql["merge_upsert_daily_sales"]
    sql["medallion_rerun"] = sql["merge_upsert_daily_sales"]
    sql["run_states_compacted"] = sql["run_states"]
    return sql | _reloads() | _contract()


def _inventory_of(first: str) -> str:
    """The second batch of inventory upon a first one."""
    return _with([first, "silver_inv_b2"], f"""
SELECT {_INV_OUT} FROM (
  SELECT store_id, product_id,
         CASE WHEN b.hit THEN b.stock_level ELSE a.stock_level END AS stock_level,
         CASE WHEN b.hit THEN b.reorder_point ELSE a.reorder_point END AS reorder_point,
         CASE WHEN b.hit THEN b.is_below_reorder ELSE a.is_below_reorder END AS is_below_reorder,
         CASE WHEN b.hit THEN b.last_restocked ELSE a.last_restocked END AS last_restocked,
         CASE WHEN a.hit THEN a.supplier_id ELSE b.supplier_id END AS supplier_id
  FROM (SELECT *, true AS hit FROM {first}) a
  FULL OUTER JOIN (SELECT *, true AS hit FROM silver_inv_b2) b USING (store_id, product_id))""")


def _reloads() -> dict[str, str]:
    """After a reload the tables are those of the corrected file and the second batch."""
    rows = "((SELECT count(*) FROM ruled_b1c) + (SELECT count(*) FROM ruled_b2))"
    amount = "CAST(CAST(sum(total_amount) AS DECIMAL(20,2)) AS VARCHAR)"
    return {
        "medallion_reload": _with(["gold_sales_b1", "gold_sales_reloaded"], f"""
SELECT {_SALES_OUT} FROM (
  SELECT g.* REPLACE (coalesce(a.store_name, g.store_name) AS store_name)
  FROM gold_sales_reloaded g LEFT JOIN gold_sales_b1 a USING (report_date, store_id))"""),
        "medallion_reload_inventory": _inventory_of("silver_inv_b1c"),
        "medallion_reload_transactions": _with(
            ["ruled_b1c", "ruled_b2", "silver_tx_b1c", "silver_tx_freed"], f"""
, lost AS (
SELECT 'batch-1' AS batch, rule, count(*) AS n FROM ruled_b1c GROUP BY ALL
UNION ALL SELECT 'batch-2', rule, count(*) FROM ruled_b2 GROUP BY ALL
), kept AS (
SELECT 'batch-1' AS batch, count(*) AS n, {amount} AS total_amount FROM silver_tx_b1c
UNION ALL SELECT 'batch-2', count(*), {amount} FROM silver_tx_freed
)
SELECT 'silver' AS state, batch, n AS rows, total_amount FROM kept WHERE n > 0
UNION ALL SELECT rule, batch, n, NULL FROM lost WHERE rule IS NOT NULL
UNION ALL
SELECT 'duplicate_transaction_id', batch, l.n - k.n, NULL FROM lost l JOIN kept k USING (batch)
WHERE rule IS NULL AND l.n > k.n"""),
        "medallion_quality": _with(
            ["ruled_b1c", "ruled_b2", "silver_tx_reloaded", "gold_sales_reloaded", "silver_stores_r2"],
            _report(
                "silver_tx_reloaded", f"{rows} - (SELECT count(*) FROM silver_tx_reloaded)", rows,
                "gold_sales_reloaded", "silver_stores_r2",
            ),
        ),
        "quarantine_history": _with(
            ["ruled_b1", "ruled_b1c", "ruled_b2", "silver_tx_b1", "silver_tx_b1c", "silver_tx_merged", "silver_tx_freed"], """
, broken AS (
SELECT 'batch-1' AS batch, 1 AS load, rule, count(*) AS n FROM ruled_b1 GROUP BY ALL
UNION ALL SELECT 'batch-1', 2, rule, count(*) FROM ruled_b1c GROUP BY ALL
UNION ALL SELECT 'batch-2', 1, rule, count(*) FROM ruled_b2 GROUP BY ALL
), kept AS (
SELECT 'batch-1' AS batch, 1 AS load, (SELECT count(*) FROM silver_tx_b1) AS n
UNION ALL SELECT 'batch-1', 2, (SELECT count(*) FROM silver_tx_b1c)
UNION ALL SELECT 'batch-2', 1, (SELECT count(*) FROM silver_tx_merged) - (SELECT count(*) FROM silver_tx_b1)
), held AS (
SELECT batch, load, coalesce(rule, 'duplicate_transaction_id') AS reject_rule,
       b.n - CASE WHEN rule IS NULL THEN k.n ELSE 0 END AS n
FROM broken b JOIN kept k USING (batch, load)
)
SELECT * FROM (
SELECT batch, 'held' AS change, reject_rule, CAST(sum(n) AS BIGINT) AS rows FROM held GROUP BY ALL
UNION ALL SELECT batch, 'withdrawn', reject_rule, n FROM held WHERE batch = 'batch-1' AND load = 1
UNION ALL SELECT 'batch-2', 'promoted', 'duplicate_transaction_id', (SELECT count(*) FROM silver_tx_freed) - n
FROM kept WHERE batch = 'batch-2'
) WHERE rows > 0"""),
        "medallion_reset": _with(["gold_sales_all"], f"SELECT {_SALES_OUT} FROM gold_sales_all"),
    }


def _contract() -> dict[str, str]:
    first, second = "'2001-12-31 00:00:00.000000'", "'2002-01-01 00:00:00.000000'"
    return {
        "audit_stamps": _with(
            ["silver_tx_b1", "silver_tx_merged", "silver_stores_r2", "silver_inv_b1", "silver_inv_b2"], f"""
SELECT * FROM (
SELECT 'silver/transactions' AS table_name, {first} AS stamp, count(*) AS rows FROM silver_tx_b1
UNION ALL SELECT 'silver/transactions', {second}, count(*) FROM silver_tx_merged ANTI JOIN silver_tx_b1 USING (transaction_id)
UNION ALL SELECT 'silver/stores', {second}, count(*) FROM silver_stores_r2
UNION ALL SELECT 'silver/inventory', {first}, count(*) FROM silver_inv_b1 ANTI JOIN silver_inv_b2 USING (store_id, product_id)
UNION ALL SELECT 'silver/inventory', {second}, count(*) FROM silver_inv_b2
UNION ALL SELECT 'gold/inventory_health', {first}, count(DISTINCT store_id) FROM silver_inv_b1
UNION ALL SELECT 'gold/inventory_health', {second}, count(*)
          FROM (SELECT store_id FROM silver_inv_b1 UNION SELECT store_id FROM silver_inv_b2)
) WHERE rows > 0"""),
        "csv_ingest_provenance": _with(["ruled_b1", "ruled_b2"], f"""
SELECT batch AS _batch_id, stamp AS _ingested_at, n AS rows, n AS ids, n AS named,
       CAST(0 AS BIGINT) AS flagged, CAST(0 AS BIGINT) AS reasons
FROM (SELECT 'batch-1' AS batch, {first} AS stamp, count(*) AS n FROM ruled_b1
      UNION ALL SELECT 'batch-2', {second}, count(*) FROM ruled_b2)"""),
        "csv_ingest_missing_column": _with(["raw_stores"], """
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS region) FROM raw_stores"""),
        "csv_ingest_unknown_column": _with(["raw_stores"], """
SELECT 'batch' AS _batch_id, 'raw_stores' AS source_table,
       'raw_stores: unknown columns [''surprise'']' AS _quarantine_reason,
       concat('{"store_id":"', store_id, '","store_name":"', coalesce(store_name, 'NA'), '","surprise":"x"}') AS record
FROM raw_stores"""),
    }


def _oracle() -> dict[str, str]:
    return {
        "bronze_transactions": _with(["raw_tx"], f"SELECT {_RAW_TX_COLUMNS} FROM raw_tx"),
        "bronze_inventory": _with(["raw_inv"], f"SELECT {_RAW_INV_COLUMNS} FROM raw_inv"),
        "bronze_stores": _with(["raw_stores"], f"SELECT {_RAW_STORE_COLUMNS} FROM raw_stores"),
        "quarantine_transactions": _with(["quarantine"], "SELECT * FROM quarantine"),
        "quarantine_by_reason": _with(
            ["quarantine"], "SELECT reject_rule, count(*) AS rows FROM quarantine GROUP BY 1"
        ),
        "flagged_transactions": _with(["ranked"], f"""
SELECT {_RAW_TX_COLUMNS}, (rule IS NOT NULL OR rn > 1) AS _is_quarantined,
       CASE WHEN rule IS NOT NULL OR rn > 1 THEN 'Failed silver transformation checks' END
         AS _quarantine_reason
FROM ranked"""),
        "quarantine_rates": _with(["ranked"], f"""
SELECT {_text(_cents(_ratio('held * 10000', 'total')))} AS rate_all,
       {_text(_cents(_ratio('broken * 10000', 'total')))} AS rate_without_duplicates
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE rule IS NOT NULL OR rn > 1) AS held,
             count(*) FILTER (WHERE rule IS NOT NULL) AS broken FROM ranked)"""),
        "rejected_inventory": _with(["ruled_inv"], f"""
SELECT {_RAW_INV_COLUMNS}, {_REASON}, rule AS reject_rule
FROM ruled_inv WHERE rule IS NOT NULL"""),
        "rejected_stores": _with(["raw_stores"], f"""
SELECT {_RAW_STORE_COLUMNS}, {_REASON}, 'missing_store_name' AS reject_rule
FROM raw_stores WHERE store_name IS NULL"""),
        "silver_transactions": _with(["silver_tx"], f"SELECT {_TX_OUT} FROM silver_tx"),
        "silver_inventory": _with(["silver_inv"], f"SELECT {_INV_OUT} FROM silver_inv"),
        "silver_stores": _with(["silver_stores"], f"SELECT {_STORE_OUT} FROM silver_stores"),
        "gold_daily_sales": _with(["gold_sales"], f"SELECT {_SALES_OUT} FROM gold_sales"),
        "gold_inventory_health": _with(
            ["health"],
            f"SELECT {_HEALTH_OUT} FROM (SELECT '2001-11-04' AS snapshot_date, * FROM health)",
        ),
        "merge_insert_if_absent": _with(
            ["silver_tx_merged"], f"SELECT {_TX_OUT} FROM silver_tx_merged"
        ),
        "merge_upsert_stores": _with(["silver_stores", "silver_stores_r2"], f"""
SELECT {_STORE_OUT} FROM silver_stores_r2
UNION ALL
SELECT {_STORE_OUT} FROM silver_stores a
WHERE NOT EXISTS (SELECT 1 FROM silver_stores_r2 b WHERE a.store_id = b.store_id)"""),
        "merge_upsert_inventory": _inventory_of("silver_inv_b1"),
        "merge_upsert_inventory_backfill": _with(["silver_inv_b1", "silver_inv_b2"], f"""
SELECT {_INV_OUT} FROM silver_inv_b2
UNION ALL
SELECT {_INV_OUT} FROM silver_inv_b1 ANTI JOIN silver_inv_b2 USING (store_id, product_id)"""),
        "csv_ingest_multiline": _with(["raw_stores"], """
SELECT store_id, store_name || chr(10) || city AS store_name, city, region, store_type, opened_date
FROM raw_stores"""),
        "medallion_rerun_quarantine": _with(["ruled", "silver_tx_merged"], """
SELECT rule AS reject_rule, count(*) AS rows FROM ruled WHERE rule IS NOT NULL GROUP BY 1
UNION ALL
SELECT 'duplicate_transaction_id',
       count(*) - (SELECT count(*) FROM silver_tx_merged) FROM ruled WHERE rule IS NULL"""),
        "medallion_run": _with(
            ["ruled_b1", "ruled_b2", "silver_tx_b1", "silver_tx_merged", "silver_inv_b1", "silver_inv_b2",
             "silver_stores", "silver_stores_r2", "gold_sales_b1", "gold_sales_all", "ruled_inv"],
            _RUN,
        ),
        "merge_upsert_daily_sales": _with(["gold_merged"], f"SELECT {_SALES_OUT} FROM gold_merged"),
        "daily_sales_newest": _with(["gold_sales"], f"""
SELECT {_SALES_OUT} FROM gold_sales g ORDER BY g.report_date DESC, g.store_id LIMIT 100"""),
        "daily_sales_newest_of_store": _with(["gold_sales"], f"""
SELECT {_SALES_OUT} FROM gold_sales g WHERE g.store_id = 3 AND g.report_date <= DATE '1999-05-17'
ORDER BY g.report_date DESC LIMIT 40"""),
        "merge_upsert_inventory_health": _with(
            ["health_merged"], f"SELECT {_HEALTH_OUT} FROM health_merged"
        ),
        "daily_sales_latest": _with(["gold_sales"], f"""
SELECT {_SALES_OUT} FROM gold_sales g ORDER BY g.report_date DESC, g.store_id LIMIT 100"""),
        "daily_sales_filtered": _with(["gold_sales"], f"""
SELECT {_SALES_OUT} FROM gold_sales g
WHERE g.store_id = 3 AND g.report_date BETWEEN DATE '1998-03-01' AND DATE '1998-09-30'
ORDER BY g.report_date DESC, g.store_id LIMIT 100"""),
        "sales_summary_7d": _summary(7),
        "sales_summary_30d": _summary(30),
        "sales_summary_90d": _summary(90),
        "sales_summary_unknown_period": _summary(7),
        "sales_summary_empty": _summary(7, "2003-01-01"),
        "inventory_alerts": _with(["silver_inv", "silver_stores"], """
, missing AS (
SELECT *, reorder_point - stock_level AS units_needed FROM silver_inv
)
SELECT m.store_id, (SELECT store_name FROM silver_stores n WHERE n.store_id = m.store_id)
         AS store_name,
       product_id, stock_level, reorder_point, units_needed
FROM missing m
WHERE units_needed > 0 AND m.store_id IN (SELECT store_id FROM silver_stores)"""),
        "inventory_health_snapshot": _with(["health_merged"], f"""
SELECT {_HEALTH_OUT} FROM (
  SELECT *, dense_rank() OVER (ORDER BY snapshot_date DESC) AS age FROM health_merged) h
WHERE age = 1 ORDER BY h.reorder_rate DESC, store_id"""),
        "quality_report": _with(
            ["silver_tx", "quarantine", "gold_sales", "silver_stores", "raw_tx"],
            _report(
                "silver_tx", "(SELECT count(*) FROM quarantine)", "(SELECT count(*) FROM raw_tx)",
                "gold_sales", "silver_stores",
            ),
        ),
        "stores_without_sales": _with(["silver_tx", "silver_stores"], _idle()),
        "stores_without_recent_sales": _with(
            ["silver_tx", "silver_stores"],
            _idle("2001-10-25"),
        ),
        "run_states": _with(["run_states"], "SELECT * FROM run_states"),
        "recent_runs": _with(["run_states"], """
SELECT * FROM run_states ORDER BY started_at DESC NULLS FIRST, run_id LIMIT 10"""),
        "last_run_status": _with(["runs"], """
SELECT coalesce(max(status), 'never_run') AS pipeline_status,
       max(CASE WHEN status <> 'running'
           THEN concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
                       CASE WHEN strftime(ts, '%f') = '000000' THEN ''
                            ELSE concat('.', strftime(ts, '%f')) END, '+00:00') END)
         AS last_pipeline_run
FROM (SELECT * FROM (
        SELECT *, min(ts) OVER (PARTITION BY run_id) AS started,
               row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) AS rn FROM runs)
      WHERE rn = 1 ORDER BY started DESC, run_id LIMIT 1)"""),
    }
