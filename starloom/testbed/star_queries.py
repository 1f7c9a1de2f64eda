"""Dimensions, facts, star reads and marts."""

from __future__ import annotations

import contextlib
import uuid
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog import STAR_SCHEMAS
from starloom.functions.scalars import END_OF_TIME, flag, money
from starloom.operators import dims, facts
from starloom.operators.ranges import global_rank, number_rows
from starloom.operators.scd import close_version, current_versions
from starloom.plans import conform, marts
from starloom.plans.star_load import LoadLog, StarStore, load_star
from starloom.session import materialize, shared_dir
from starloom.testbed.frames import curated_rows, plain, rows_sql, source_rows, stored_frames, table
from starloom.testbed.registry import query

BATCH = datetime(2026, 7, 25, 12)
OPENED, EARLIER = datetime(2026, 1, 1), datetime(2025, 1, 1)
_OPEN = "'9999-12-31 00:00:00'"
HISTORY = 1_000_000_000                    # surrogate keys of old versions start here


def _ts(value):
    return F.lit(value).cast("timestamp")


# Dimensions over the whole tables, some members with old versions. For the fact queries, whose feature is the lookup that
# misses, `known` keeps some members out, so that key 0 occurs.
def known(rows, column, but):
    return rows.where(F.col(column) % 10 != but)


def dim_customer(spark, sf_dir):
    base = curated_rows(spark, sf_dir, "customers").select(
        F.col("customerId").alias("customer_id"), F.col("customerCode").alias("customer_code"),
        F.col("displayName").alias("display_name"), "email", F.col("preferredLocale").alias("preferred_locale"), "status",
        money("lifetimeValueUsd").alias("lifetime_value_usd"))
    current = base.select((F.col("customer_id") + 1).alias("customer_sk"), *base.columns, _ts(OPENED).alias("valid_from"),
                          _ts(END_OF_TIME).alias("valid_to"), F.lit(1).alias("is_current"))
    old = base.where(F.col("customer_id") % 4 == 0).select(
        (F.col("customer_id") + HISTORY).alias("customer_sk"), *base.columns, _ts(EARLIER).alias("valid_from"),
        _ts(OPENED).alias("valid_to"), F.lit(0).alias("is_current"))
    return current.unionByName(old)


def dim_product(spark, sf_dir):
    base = curated_rows(spark, sf_dir, "products")
    return base.select(
        (F.col("productId") + 1).alias("product_sk"), F.col("productId").alias("product_id"), "sku",
        F.col("categoryId").alias("category_id"), F.lit("").alias("category_name"), F.col("displayName").alias("display_name"),
        money("listPriceUsd", 4).alias("list_price_usd"), _ts(OPENED).alias("valid_from"), _ts(END_OF_TIME).alias("valid_to"),
        F.lit(1).alias("is_current"))


def dim_warehouse(spark, sf_dir):
    return dims.warehouse_rows(curated_rows(spark, sf_dir, "warehouses"))


def order_calendar(spark, sf_dir):
    return dims.calendar(dims.date_keys([(curated_rows(spark, sf_dir, "orders"), "placedAtUtc")], BATCH))


def order_facts(spark, sf_dir):
    return facts.fact_order(curated_rows(spark, sf_dir, "orders"), dim_customer(spark, sf_dir))


def line_facts(spark, sf_dir):
    context = facts.order_context(curated_rows(spark, sf_dir, "orders"), dim_customer(spark, sf_dir))
    return facts.fact_order_line(curated_rows(spark, sf_dir, "order-lines"), context, dim_product(spark, sf_dir),
                                 dim_warehouse(spark, sf_dir))


def order_facts_with_misses(spark, sf_dir):
    return facts.fact_order(curated_rows(spark, sf_dir, "orders"), known(dim_customer(spark, sf_dir), "customer_id", 3))


def line_facts_with_misses(spark, sf_dir):
    context = facts.order_context(known(curated_rows(spark, sf_dir, "orders"), "orderId", 6), known(dim_customer(spark, sf_dir), "customer_id", 3))
    return facts.fact_order_line(curated_rows(spark, sf_dir, "order-lines"), context, known(dim_product(spark, sf_dir), "product_id", 4),
                                 known(dim_warehouse(spark, sf_dir), "warehouse_id", 5))


_DATE_KEY = "CAST(strftime({0}, '%Y%m%d') AS INT)"
SQL_ORDERS = f"""fo AS (
  SELECT o_orderkey AS order_id, {_DATE_KEY.format('o_orderdate')} AS order_date_key, CAST(o_orderdate AS DATE) AS full_date,
         CASE WHEN o_custkey % 10 <> 3 THEN o_custkey + 1 ELSE 0 END AS customer_sk, o_custkey,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"""
# line prices in units of 1/10000; half-even to cents in whole numbers
SQL_LINES = f"""raw_lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_line_id, l_orderkey AS order_id, l_partkey, l_suppkey,
         CAST(l_quantity AS INT) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) * 100 // CAST(l_quantity AS BIGINT) AS unit4,
         CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) AS disc4 FROM lineitem),
fl AS (
  SELECT order_line_id, r.order_id,
         CASE WHEN r.order_id % 10 <> 6 THEN COALESCE(fo.order_date_key, 0) ELSE 0 END AS order_date_key,
         CASE WHEN r.order_id % 10 <> 6 THEN COALESCE(fo.customer_sk, 0) ELSE 0 END AS customer_sk,
         CASE WHEN l_partkey % 10 <> 4 THEN l_partkey + 1 ELSE 0 END AS product_sk,
         CAST(CASE WHEN l_suppkey % 10 <> 5 THEN l_suppkey ELSE 0 END AS INT) AS warehouse_sk,
         l_partkey, l_suppkey, fo.o_custkey, fo.full_date, quantity, unit4, disc4, quantity * unit4 - disc4 AS t4
  FROM raw_lines r LEFT JOIN fo ON r.order_id = fo.order_id),
fact_line AS (
  SELECT *, CASE WHEN t4 % 100 > 50 OR (t4 % 100 = 50 AND (t4 // 100) % 2 = 1) THEN t4 // 100 + 1 ELSE t4 // 100 END AS total_cents
  FROM fl)"""
_MISSES = ["CASE WHEN o_custkey % 10 <> 3 THEN o_custkey + 1 ELSE 0 END", "CASE WHEN r.order_id % 10 <> 6 THEN COALESCE(fo.order_date_key, 0) ELSE 0 END",
           "CASE WHEN r.order_id % 10 <> 6 THEN COALESCE(fo.customer_sk, 0) ELSE 0 END", "CASE WHEN l_partkey % 10 <> 4 THEN l_partkey + 1 ELSE 0 END",
           "CASE WHEN l_suppkey % 10 <> 5 THEN l_suppkey ELSE 0 END"]
_WHOLE = ["o_custkey + 1", "COALESCE(fo.order_date_key, 0)", "COALESCE(fo.customer_sk, 0)", "l_partkey + 1", "l_suppkey"]
SQL_ALL_ORDERS, SQL_ALL_LINES = SQL_ORDERS, SQL_LINES
for _some, _all in zip(_MISSES, _WHOLE):
    SQL_ALL_ORDERS, SQL_ALL_LINES = SQL_ALL_ORDERS.replace(_some, _all), SQL_ALL_LINES.replace(_some, _all)


@query("customer_360", f"""
WITH agg AS (
  SELECT o_custkey, COUNT(*) AS n, SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
         MIN({_DATE_KEY.format('o_orderdate')}) AS lo, MAX({_DATE_KEY.format('o_orderdate')}) AS hi FROM orders GROUP BY o_custkey)
SELECT c_custkey + 1 AS customer_sk, c_custkey AS customer_id, c_name AS display_name, lower(c_name) || '@example.com' AS email,
       CAST(1 AS INT) AS status, CAST(COALESCE(n, 0) AS BIGINT) AS order_count,
       COALESCE(CAST(cents AS BIGINT) / 100.0, 0.0) AS total_revenue_usd,
       COALESCE((((2 * CAST(cents AS BIGINT) * 10000 + n) // (2 * n)) + 5000) // 10000 / 100.0, 0.0) AS avg_order_value_usd,
       lo AS first_order_date_key, hi AS last_order_date_key
FROM customer LEFT JOIN agg ON c_custkey = o_custkey""")
def customer_360(spark, sf_dir):
    return marts.customer_360(dim_customer(spark, sf_dir), order_facts(spark, sf_dir))


@query("customer_current", """
SELECT c_custkey + 1 AS customer_sk, c_custkey AS customer_id, c_name AS customer_code, c_name AS display_name,
       lower(c_name) || '@example.com' AS email, CASE WHEN c_nationkey % 2 = 0 THEN 'en-US' ELSE 'en-GB' END AS preferred_locale,
       CAST(1 AS INT) AS status, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS lifetime_value_usd
FROM customer""")
def customer_current(spark, sf_dir):
    return plain(marts.customer_current(dim_customer(spark, sf_dir)))


@query("dim_date", f"""
WITH days AS (
  SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION SELECT DATE '2026-07-25')
SELECT {_DATE_KEY.format('d')} AS date_key, CAST(d AS VARCHAR) AS full_date, CAST(year(d) AS INT) AS year,
       CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
       CAST(isodow(d) AS INT) AS day_of_week, CAST(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS INT) AS is_weekend,
       CAST(weekofyear(d) AS INT) AS iso_week
FROM days""")
def dim_date(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").select(F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ms"))
    keys = dims.date_keys([(curated_rows(spark, sf_dir, "orders"), "placedAtUtc"), (shipped, "ms")], BATCH)
    return plain(dims.merge_dim_date(dims.empty_dimension(spark, "dim_date"), keys))


@query("dim_warehouse_scd1", """
SELECT CAST(s_suppkey AS INT) AS warehouse_sk, CAST(s_suppkey AS INT) AS warehouse_id, 'WH-' || s_suppkey AS code,
       CASE WHEN s_suppkey % 3 = 0 THEN 'old ' || s_name ELSE s_name END AS name, r_name AS region,
       lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_iso2, 'Etc/GMT+' || n_regionkey AS timezone_iana
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def dim_warehouse_scd1(spark, sf_dir):
    rows = curated_rows(spark, sf_dir, "warehouses")
    old = dims.warehouse_rows(rows.where(F.col("warehouseId") % 2 == 0).unionByName(
        rows.where((F.col("warehouseId") % 3 == 0) & (F.col("warehouseId") % 2 == 1))))
    existing = old.withColumn("name", F.concat(F.lit("old "), "name"))
    return dims.merge_dim_warehouse(existing, rows.where(F.col("warehouseId") % 3 != 0))


@query("dim_carrier", """
WITH seen AS (SELECT o_orderpriority AS carrier, MIN(o_orderkey) AS first_seen FROM orders GROUP BY o_orderpriority)
SELECT CAST(CASE WHEN carrier = '1-URGENT' THEN 4 ELSE 4 + ROW_NUMBER() OVER (PARTITION BY carrier = '1-URGENT' ORDER BY first_seen, carrier) END AS INT)
         AS carrier_sk, carrier, CASE WHEN carrier = '1-URGENT' THEN 'express' ELSE 'standard' END AS service_level FROM seen""")
def dim_carrier(spark, sf_dir):
    existing = spark.createDataFrame([(4, "1-URGENT", "express")], STAR_SCHEMAS["dim_carrier"])
    return dims.merge_dim_carrier(existing, curated_rows(spark, sf_dir, "shipments"))


def _customer_versions(spark, sf_dir):
    """80 % of the customers as existing dimension, every 5th with another name, some with an old version."""
    base = known(dim_customer(spark, sf_dir), "customer_id", 3).where((F.col("is_current") == 1) & (F.col("customer_id") % 10 < 8))
    changed = F.when(F.col("customer_id") % 5 == 0, F.concat("display_name", F.lit(" (old)"))).otherwise(F.col("display_name"))
    old = base.where(F.col("customer_id") % 4 == 0).withColumns({
        "customer_sk": F.col("customer_sk") + HISTORY, "valid_from": _ts(EARLIER), "valid_to": _ts(OPENED), "is_current": F.lit(0)})
    return base.withColumn("display_name", changed).unionByName(old)


_SCD2_CUSTOMER = f"""
WITH base AS (
  SELECT c_custkey AS id, c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'en-US' ELSE 'en-GB' END AS preferred_locale,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS value FROM customer),
existing AS (SELECT * FROM base WHERE id % 10 < 8 AND id % 10 <> 3),
incoming AS (SELECT * FROM base WHERE id % 10 <> 7),
fresh AS (SELECT * FROM incoming WHERE id % 5 = 0 OR id % 10 IN (3, 8, 9)),
top AS (SELECT MAX(CASE WHEN id % 4 = 0 THEN id + 1 + {HISTORY} ELSE id + 1 END) AS sk FROM existing)
SELECT customer_sk, id AS customer_id, name AS customer_code, display_name, lower(name) || '@example.com' AS email,
       preferred_locale, CAST(1 AS INT) AS status, value AS lifetime_value_usd, valid_from, valid_to, CAST(is_current AS INT) AS is_current
FROM (
  SELECT id + 1 AS customer_sk, *, CASE WHEN id % 5 = 0 THEN name || ' (old)' ELSE name END AS display_name,
         '2026-01-01 00:00:00' AS valid_from, CASE WHEN id % 5 = 0 THEN '2026-07-25 12:00:00' ELSE {_OPEN} END AS valid_to,
         CASE WHEN id % 5 = 0 THEN 0 ELSE 1 END AS is_current FROM existing
  UNION ALL
  SELECT id + 1 + {HISTORY}, *, name, '2025-01-01 00:00:00', '2026-01-01 00:00:00', 0 FROM existing WHERE id % 4 = 0
  UNION ALL
  SELECT (SELECT sk FROM top) + ROW_NUMBER() OVER (ORDER BY id), *, name, '2026-07-25 12:00:00', {_OPEN}, 1 FROM fresh) v"""


@query("scd2_customer", _SCD2_CUSTOMER)
def scd2_customer(spark, sf_dir):
    incoming = curated_rows(spark, sf_dir, "customers").where(F.col("customerId") % 10 != 7)
    return plain(dims.merge_dim_customer(_customer_versions(spark, sf_dir), incoming, BATCH))


@query("scd2_rerun_noop", _SCD2_CUSTOMER)
def scd2_rerun_noop(spark, sf_dir):
    """Applying the same batch again, later, gives the same table."""
    incoming = curated_rows(spark, sf_dir, "customers").where(F.col("customerId") % 10 != 7)
    once = materialize(dims.merge_dim_customer(_customer_versions(spark, sf_dir), incoming, BATCH), "dim_customer")
    return plain(dims.merge_dim_customer(once, incoming, datetime(2026, 8, 1)))


@query("scd2_product", f"""
WITH cats AS (SELECT p_type AS t, CAST(MIN(p_partkey) + 1 AS INT) AS category_id FROM part GROUP BY p_type),
base AS (SELECT p_partkey AS id, p_name AS name, p_type, category_id, CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS DOUBLE) AS price
         FROM part JOIN cats ON p_type = t),
existing AS (SELECT * FROM base WHERE id % 10 < 8 AND id % 10 <> 4),
top AS (SELECT MAX(id) + 1 AS sk FROM existing),
renamed AS (SELECT *, p_type = (SELECT MIN(t) FROM cats) AS moved FROM base)
SELECT product_sk, id AS product_id, 'SKU-' || id AS sku, category_id, category_name, name AS display_name, price AS list_price_usd,
       valid_from, valid_to, CAST(is_current AS INT) AS is_current
FROM (
  SELECT id + 1 AS product_sk, *, p_type AS category_name, '2026-01-01 00:00:00' AS valid_from,
         CASE WHEN moved THEN '2026-07-25 12:00:00' ELSE {_OPEN} END AS valid_to, CASE WHEN moved THEN 0 ELSE 1 END AS is_current
  FROM renamed WHERE id % 10 < 8 AND id % 10 <> 4
  UNION ALL
  SELECT (SELECT sk FROM top) + ROW_NUMBER() OVER (ORDER BY id), *, CASE WHEN moved THEN p_type || ' (renamed)' ELSE p_type END,
         '2026-07-25 12:00:00', {_OPEN}, 1
  FROM renamed WHERE moved OR id % 10 IN (4, 8, 9)) v""")
def scd2_product(spark, sf_dir):
    """A renamed category gives all of its products a new version."""
    products = curated_rows(spark, sf_dir, "products")
    categories = materialize(curated_rows(spark, sf_dir, "product-categories"), "categories")
    existing = dims.product_attributes(products, categories, []).where((F.col("product_id") % 10 < 8) & (F.col("product_id") % 10 != 4))
    existing = existing.withColumns({"product_sk": F.col("product_id") + 1, "valid_from": _ts(OPENED), "valid_to": _ts(END_OF_TIME),
                                     "is_current": F.lit(1)})
    first = categories.agg(F.min("name")).first()[0]
    renamed = categories.withColumn("name", F.when(F.col("name") == first, F.concat("name", F.lit(" (renamed)"))).otherwise(F.col("name")))
    return plain(dims.merge_dim_product(existing, products, renamed, BATCH))


@query("scd2_close_version", f"""
SELECT c_custkey + 1 AS customer_sk, CASE WHEN c_custkey IN (1, 5, 8) THEN '2026-07-25 12:00:00' ELSE {_OPEN} END AS valid_to,
       CAST(CASE WHEN c_custkey IN (1, 5, 8) THEN 0 ELSE 1 END AS INT) AS is_current
FROM customer
UNION ALL SELECT c_custkey + {HISTORY}, '2026-01-01 00:00:00', 0 FROM customer WHERE c_custkey % 4 = 0""")
def scd2_close_version(spark, sf_dir):
    return plain(close_version(dim_customer(spark, sf_dir), "customer_sk", [2, 6, 9], BATCH).select("customer_sk", "valid_to", "is_current"))


@query("dense_line_numbers", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                          l_returnflag, l_linestatus, l_shipdate) AS line_sk
FROM lineitem""")
def dense_line_numbers(spark, sf_dir):
    """Dense numbering of a large table in a full row order; rows that tie are identical."""
    lines = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    # copies of a row may span ranges, so a heavy group of copies does not pile up in one
    spread = lines.withColumn("_copy", F.monotonically_increasing_id())
    return number_rows(spread, [*[F.col(c) for c in order], F.col("_copy")], "line_sk").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "line_sk")


@query("fact_order", f"""
WITH {SQL_ORDERS}
SELECT order_id, order_date_key, customer_sk, fo.o_custkey AS billing_address_id, fo.o_custkey AS shipping_address_id,
       CAST(CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 1 ELSE 2 END AS INT) AS status, cents / 100.0 AS subtotal_usd,
       CAST(0 AS DOUBLE) AS tax_usd, CAST(0 AS DOUBLE) AS shipping_usd, cents / 100.0 AS total_usd, 'USD' AS currency,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed_at_utc
FROM fo JOIN orders ON order_id = o_orderkey""")
def fact_order(spark, sf_dir):
    return plain(order_facts_with_misses(spark, sf_dir))


@query("fact_order_line", f"""
WITH {SQL_ORDERS}, {SQL_LINES}
SELECT order_line_id, order_id, order_date_key, customer_sk, product_sk, warehouse_sk, quantity, unit4 / 10000.0 AS unit_price_usd,
       disc4 / 10000.0 AS discount_usd, total_cents / 100.0 AS line_total_usd
FROM fact_line""")
def fact_order_line(spark, sf_dir):
    return plain(line_facts_with_misses(spark, sf_dir))


@query("fact_transaction", f"""
SELECT o_orderkey AS transaction_id, o_orderkey AS order_id, {_DATE_KEY.format("o_orderdate + INTERVAL 1 MINUTE")} AS txn_date_key,
       CASE o_orderkey % 3 WHEN 0 THEN 'stripe' WHEN 1 THEN 'paypal' ELSE 'adyen' END AS provider, CAST(2 AS INT) AS kind,
       CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS amount_usd, CAST(2 AS INT) AS status,
       strftime(o_orderdate + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS occurred_at_utc
FROM orders""")
def fact_transaction(spark, sf_dir):
    return plain(facts.fact_transaction(curated_rows(spark, sf_dir, "transactions")))


@query("fact_inventory_snap", """
SELECT CAST(20260725 AS INT) AS snap_date_key, CASE WHEN l_partkey % 10 <> 4 THEN l_partkey + 1 ELSE 0 END AS product_sk,
       CAST(CASE WHEN l_suppkey % 10 <> 5 THEN l_suppkey ELSE 0 END AS INT) AS warehouse_sk, CAST(SUM(l_quantity) AS INT) AS on_hand,
       CAST(COUNT(*) AS INT) AS reserved, CAST(MAX(l_linenumber) AS INT) AS reorder_point, CAST(10 AS INT) AS safety_stock
FROM lineitem GROUP BY l_partkey, l_suppkey""")
def fact_inventory_snap(spark, sf_dir):
    return facts.fact_inventory_snap(curated_rows(spark, sf_dir, "product-inventory"), known(dim_product(spark, sf_dir), "product_id", 4),
                                     known(dim_warehouse(spark, sf_dir), "warehouse_id", 5), BATCH)


@query("star_load_counts", """
SELECT 'dim_date' AS table_name, (SELECT COUNT(DISTINCT d) FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION
         SELECT CAST(o_orderdate + INTERVAL 1 MINUTE AS DATE) FROM orders UNION SELECT DATE '2026-07-25') x) AS rows
UNION ALL SELECT 'dim_warehouse', (SELECT COUNT(*) FROM supplier)
UNION ALL SELECT 'dim_carrier', (SELECT COUNT(DISTINCT o_orderpriority) FROM orders)
UNION ALL SELECT 'dim_customer(current)', (SELECT COUNT(*) FROM customer)
UNION ALL SELECT 'dim_product(current)', (SELECT COUNT(*) FROM part)
UNION ALL SELECT 'fact_order', (SELECT COUNT(*) FROM orders)
UNION ALL SELECT 'fact_order_line', (SELECT COUNT(*) FROM lineitem)
UNION ALL SELECT 'fact_transaction', (SELECT COUNT(*) FROM orders)
UNION ALL SELECT 'fact_inventory_snap', (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x)""")
def star_load_counts(spark, sf_dir):
    """The whole load, nine tables written in dependency order, then reconciled by row count."""
    snapshot = stored_frames({e: curated_rows(spark, sf_dir, e) for e in (
        "order-lines", "product-inventory", "orders", "shipments", "transactions", "customers", "products", "product-categories", "warehouses")})
    store = StarStore(spark, f"{shared_dir(spark)}/star-{uuid.uuid4().hex}", months=True)          # days of a few rows: a folder per month
    load_star(snapshot, store, BATCH, "trace")
    return marts.row_counts(store.read())


@query("fact_reload_folders", """
WITH o AS (SELECT CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m') AS INT) AS month, o_custkey % 500 = 0 AS touched FROM orders)
SELECT month, COUNT(*) AS rows, CAST(SUM(CASE WHEN touched THEN 1 ELSE 0 END) AS BIGINT) AS touched, CASE WHEN bool_or(touched) THEN 1 ELSE 0 END AS made FROM o GROUP BY month""")
def fact_reload_folders(spark, sf_dir):
    """The order fact loaded twice, the status of a few customers' orders changed in between: only the folders that hold one are written again."""
    orders = materialize(curated_rows(spark, sf_dir, "orders"), "orders")
    dim, fact = dim_customer(spark, sf_dir), StarStore(spark, f"{shared_dir(spark)}/star-{uuid.uuid4().hex}", months=True)["fact_order"]
    fact.replace(facts.fact_order(orders, dim))
    touched = F.col("customerId") % 500 == 0
    fact.replace(facts.fact_order(orders.withColumn("status", F.when(touched, 9).otherwise(F.col("status"))), dim))
    made = spark.createDataFrame([(int(month), number) for month, number in fact.folders().items()], "month int, made int")
    now = fact.read().select((F.col("status") == 9).alias("touched"), F.floor(F.col("order_date_key") / 100).cast("int").alias("month"))
    return now.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.count_if("touched").alias("touched")).join(made, "month")


@query("star_join_lines", f"""
WITH {SQL_ALL_ORDERS}, {SQL_ALL_LINES}
SELECT order_line_id, c_name AS customer, p_name AS product, 'WH-' || s_suppkey AS warehouse, quantity,
       total_cents / 100.0 AS line_total_usd, CAST(full_date AS VARCHAR) AS full_date
FROM fact_line JOIN customer ON fact_line.customer_sk = c_custkey + 1
JOIN part ON fact_line.product_sk = p_partkey + 1
JOIN supplier ON fact_line.warehouse_sk = s_suppkey
WHERE order_date_key > 0""")
def star_join_lines(spark, sf_dir):
    return plain(marts.order_lines_star(line_facts(spark, sf_dir), dim_customer(spark, sf_dir), dim_product(spark, sf_dir),
                                        order_calendar(spark, sf_dir), dim_warehouse(spark, sf_dir)))


@query("star_join_products", f"""
WITH {SQL_ALL_ORDERS}, {SQL_ALL_LINES}
SELECT order_line_id, c_name AS customer, p_name AS product, quantity, total_cents / 100.0 AS line_total_usd,
       CAST(full_date AS VARCHAR) AS full_date
FROM fact_line JOIN customer ON fact_line.customer_sk = c_custkey + 1
JOIN part ON fact_line.product_sk = p_partkey + 1
WHERE order_date_key > 0""")
def star_join_products(spark, sf_dir):
    return plain(marts.order_lines_star(line_facts(spark, sf_dir), dim_customer(spark, sf_dir), dim_product(spark, sf_dir),
                                        order_calendar(spark, sf_dir)))


@query("star_join_orders", f"""
WITH {SQL_ALL_ORDERS}
SELECT c_name AS customer, customer_sk, order_id, CAST(full_date AS VARCHAR) AS full_date, cents / 100.0 AS total_usd
FROM fo JOIN customer ON customer_sk = c_custkey + 1""")
def star_join_orders(spark, sf_dir):
    return plain(marts.orders_star(order_facts(spark, sf_dir), dim_customer(spark, sf_dir), order_calendar(spark, sf_dir)))


@query("order_value_windows", f"""
WITH {SQL_ALL_ORDERS},
w AS (
  SELECT c_name AS customer, customer_sk, order_id, full_date, cents,
         SUM(cents) OVER (PARTITION BY customer_sk ORDER BY full_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         CAST(SUM(cents) OVER (PARTITION BY customer_sk) AS BIGINT) AS spend, RANK() OVER (ORDER BY cents DESC) AS value_rank
  FROM fo JOIN customer ON customer_sk = c_custkey + 1)
SELECT customer, customer_sk, order_id, CAST(full_date AS VARCHAR) AS full_date, cents / 100.0 AS total_usd,
       CAST(run AS BIGINT) / 100.0 AS running_total, ((2000 * cents + spend) // (2 * spend)) / 10.0 AS pct_of_lifetime,
       CAST(value_rank AS BIGINT) AS value_rank FROM w""")
def order_value_windows(spark, sf_dir):
    return plain(marts.order_value_analytics(order_facts(spark, sf_dir), dim_customer(spark, sf_dir), order_calendar(spark, sf_dir)))


@query("newest_customers", """
SELECT c_custkey AS "customerId", c_name AS "customerCode", c_name AS "displayName" FROM customer ORDER BY c_custkey DESC LIMIT 10""")
def newest_customers(spark, sf_dir):
    return marts.newest_customers(curated_rows(spark, sf_dir, "customers")).select("customerId", "customerCode", "displayName")


@query("inventory_grid", """
SELECT p_partkey AS "productId", CAST(s_suppkey AS INT) AS "warehouseId", 'SKU-' || p_partkey AS sku, 'WH-' || s_suppkey AS code
FROM part CROSS JOIN supplier WHERE 'SKU-' || p_partkey LIKE 'SKU-1%' AND 'WH-' || s_suppkey IN ('WH-1', 'WH-2', 'WH-7')""")
def inventory_grid(spark, sf_dir):
    return marts.inventory_grid(curated_rows(spark, sf_dir, "products"), curated_rows(spark, sf_dir, "warehouses"), "SKU-1%",
                                ["WH-1", "WH-2", "WH-7"])


@query("natural_key_resolution", """
SELECT l_orderkey * 10 + l_linenumber AS "orderLineId", l_orderkey AS "orderId", l_partkey AS "productId",
       CAST(l_suppkey AS INT) AS "warehouseId" FROM lineitem""")
def natural_key_resolution(spark, sf_dir):
    """Lines that name their order, product and warehouse by code, resolved to ids."""
    lines = source_rows(spark, sf_dir, "order-lines").select(
        F.col("OrderLineId").alias("orderLineId"), F.concat(F.lit("ORD-"), "OrderId").alias("orderNumber"),
        F.concat(F.lit("SKU-"), "ProductId").alias("sku"), F.concat(F.lit("WH-"), "WarehouseId").alias("code"))
    rows = marts.resolve_natural_keys(lines, [
        ({"orderNumber": "orderNumber"}, curated_rows(spark, sf_dir, "orders"), "orderId"),
        ({"sku": "sku"}, curated_rows(spark, sf_dir, "products"), "productId"),
        ({"code": "code"}, curated_rows(spark, sf_dir, "warehouses"), "warehouseId"),
    ])
    return rows.select("orderLineId", "orderId", "productId", "warehouseId")


@query("order_key_resolution", """
SELECT 'ORD-' || o_orderkey AS "orderNumber", o_custkey AS "customerId", o_custkey AS "addressId"
FROM orders JOIN customer ON o_custkey = c_custkey""")
def order_key_resolution(spark, sf_dir):
    """Orders that name their customer by code, resolved to the customer and its address."""
    names = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("customerCode"))
    orders = marts.resolve_natural_keys(
        source_rows(spark, sf_dir, "orders").select("OrderNumber", "CustomerId"), [({"CustomerId": "c_custkey"}, names, "customerCode")]).select(F.col("OrderNumber").alias("orderNumber"), "customerCode")
    rows = marts.resolve_natural_keys(orders, [
        ({"customerCode": "customerCode"}, curated_rows(spark, sf_dir, "customers"), "customerId"),
        ({"customerId": "customerId"}, curated_rows(spark, sf_dir, "customer-addresses"), "addressId"),
    ])
    return rows.select("orderNumber", "customerId", "addressId")


@query("rank_with_nulls", """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value,
       RANK() OVER (ORDER BY CASE WHEN event_id % 5 <> 0 THEN value END DESC NULLS LAST) AS value_rank FROM events""")
def rank_with_nulls(spark, sf_dir):
    """Global rank of a column of which a fifth is null: the nulls share the last rank."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    return global_rank(rows, "value", ["event_id"], "value_rank")


@query("flags", """
SELECT c_custkey AS address_id, CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS INT) AS is_default FROM customer""")
def flags(spark, sf_dir):
    return curated_rows(spark, sf_dir, "customer-addresses").select(F.col("addressId").alias("address_id"), flag("isDefault").cast("int").alias("is_default"))


@query("star_load_recoded", """
SELECT 'dim_warehouse' AS table_name, (SELECT COUNT(*) FROM supplier) AS rows, (SELECT COUNT(*) FROM supplier WHERE s_suppkey % 3 = 0) AS renamed
UNION ALL SELECT 'dim_product(current)', (SELECT COUNT(*) FROM part), (SELECT COUNT(*) FROM part)
UNION ALL SELECT 'fact_order', (SELECT COUNT(*) FROM orders), 0 UNION ALL SELECT 'fact_order_line', (SELECT COUNT(*) FROM lineitem), 0
UNION ALL SELECT 'fact_inventory_snap', (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x), 0""")
def star_load_recoded(spark, sf_dir):
    """Warehouses, categories and orders that come again under another code, slug or number: one row per business id stays."""
    def again(entity, which, **new):
        rows = curated_rows(spark, sf_dir, entity)
        return rows.unionByName(rows.where(which).withColumns({**new, "offset": F.col("offset") + 10_000_000_000}))

    snapshot = {e: curated_rows(spark, sf_dir, e) for e in ("order-lines", "product-inventory", "shipments", "transactions", "customers", "products")}
    snapshot |= {"warehouses": again("warehouses", F.col("warehouseId") % 3 == 0, code=F.concat(F.lit("NEW-"), "code")),
                 "product-categories": again("product-categories", F.lit(True), name=F.concat(F.lit("new "), "name")),
                 "orders": again("orders", F.col("orderId") % 4 == 0, orderNumber=F.concat("orderNumber", F.lit("b")))}
    store = StarStore(spark, f"{shared_dir(spark)}/star-{uuid.uuid4().hex}", day_folders=False)
    load_star(stored_frames(snapshot), store, BATCH, "trace")
    tables = store.read()
    renamed = {"dim_warehouse": F.col("code").startswith("NEW-"), "dim_product(current)": F.col("category_name").startswith("new ")}
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count_if(renamed.get(name, F.lit(False))).alias("renamed"))
             for name, df in (("dim_warehouse", tables["dim_warehouse"]), ("dim_product(current)", current_versions(tables["dim_product"])), ("fact_order", tables["fact_order"]),
                              ("fact_order_line", tables["fact_order_line"]), ("fact_inventory_snap", tables["fact_inventory_snap"]))]
    return reduce(DataFrame.unionByName, parts)


@query("load_stage_rows", """
SELECT UNNEST(['dim_date', 'dim_warehouse', 'dim_carrier', 'dim_customer', 'dim_product', 'fact_order', 'fact_order_line', 'fact_transaction',
               'fact_inventory_snap']) AS stage, 'ok' AS status, NULL::BIGINT AS records
UNION ALL SELECT 'load', 'ok', (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM part) + (SELECT COUNT(DISTINCT p_type) FROM part) + (SELECT COUNT(*) FROM supplier)
  + 3 * (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM lineitem) + (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x)
UNION ALL SELECT 'dim_date', 'ok', NULL UNION ALL SELECT 'dim_warehouse', 'failed', NULL
UNION ALL SELECT 'dim_warehouse-load-failed', 'error', NULL""")
def load_stage_rows(spark, sf_dir):
    """What a load and a failing load leave behind as telemetry tables."""
    snapshot = stored_frames({e: curated_rows(spark, sf_dir, e) for e in (
        "order-lines", "product-inventory", "orders", "shipments", "transactions", "customers", "products", "product-categories", "warehouses")})
    root = f"{shared_dir(spark)}/load-{uuid.uuid4().hex}"
    log = LoadLog(spark, f"{root}/log")
    load_star(snapshot, StarStore(spark, f"{root}/star", day_folders=False), BATCH, "trace", log=log)
    broken = {**snapshot, "warehouses": snapshot["warehouses"].withColumn("code", F.raise_error(F.lit("broken warehouse")).cast("string"))}
    with contextlib.suppress(PySparkException, Py4JJavaError):
        load_star(broken, StarStore(spark, f"{root}/other", day_folders=False), BATCH, "trace", log=log)
    stages = log.stages.read().select("stage", "status", F.get_json_object("payload", "$.records").cast("bigint").alias("records"))
    return stages.unionByName(log.errors.read().select(F.col("error_code").alias("stage"), F.lit("error").alias("status"), F.lit(None).cast("bigint").alias("records")))


@query("mart_job_parquet", f"""
WITH agg AS (SELECT o_custkey, COUNT(*) AS n, SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY o_custkey)
SELECT c_custkey + 1 AS customer_sk, CAST(COALESCE(n, 0) AS BIGINT) AS order_count, COALESCE(CAST(cents AS BIGINT) / 100.0, 0.0) AS total_revenue_usd,
       TRUE AS sorted FROM customer LEFT JOIN agg ON c_custkey = o_custkey""")
def mart_job_parquet(spark, sf_dir):
    """The command line job over a star in Parquet; the mart's files are sorted and in order of customer_sk."""
    root = f"{shared_dir(spark)}/mart-{uuid.uuid4().hex}"
    dim_customer(spark, sf_dir).write.parquet(f"{root}/dim_customer")
    order_facts(spark, sf_dir).write.parquet(f"{root}/fact_order")
    options = conform.parser().parse_args(["--dim-customer-path", f"{root}/dim_customer", "--fact-order-path", f"{root}/fact_order", "--output", f"{root}/mart"])
    conform.build(spark, conform.star_of(options), f"{root}/mart")
    mart = spark.read.parquet(f"{root}/mart").select("*", "_metadata.file_name", "_metadata.file_block_start")
    # every file holds a range of its own: no other file begins within it
    spans = mart.groupBy("file_name").agg(F.min("customer_sk").alias("low"), F.max("customer_sk").alias("high"))
    crossed = spans.alias("a").join(spans.alias("b"), (F.col("a.low") < F.col("b.low")) & (F.col("b.low") <= F.col("a.high"))).count()
    return plain(mart.select("customer_sk", "order_count", "total_revenue_usd", F.lit(crossed == 0).alias("sorted")))
