"""The four facts: left lookups only, so every record gives one row; an unknown member has key 0."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalars import date_key, line_total, millis_to_seconds_timestamp, money, text
from starloom.operators.dims import batch_date_key
from starloom.operators.latest import RECENT, latest_per_key
from starloom.operators.lookup import lookup
from starloom.operators.scd import current_versions


def customer_keys(dim_customer: DataFrame) -> DataFrame:
    return current_versions(dim_customer).select("customer_id", "customer_sk")


def product_keys(dim_product: DataFrame) -> DataFrame:
    return current_versions(dim_product).select("product_id", "product_sk")


def fact_order(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    orders = latest_per_key(orders, ["orderId"], RECENT)           # a renumbered order is one order
    keyed = lookup(orders, customer_keys(dim_customer), {"customerId": "customer_id"}, {"customer_sk": 0})
    return keyed.select(
        F.col("orderId").alias("order_id"), date_key("placedAtUtc").alias("order_date_key"), "customer_sk",
        F.col("billingAddressId").alias("billing_address_id"), F.col("shippingAddressId").alias("shipping_address_id"),
        "status", money("subtotalUsd").alias("subtotal_usd"), money("taxUsd").alias("tax_usd"),
        money("shippingUsd").alias("shipping_usd"), money("totalUsd").alias("total_usd"), text("currency").alias("currency"),
        millis_to_seconds_timestamp("placedAtUtc").alias("placed_at_utc"))


def order_context(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """What an order line takes from its order: date key and customer key, resolved once per order."""
    newest = latest_per_key(orders.select("orderId", "customerId", "placedAtUtc", *RECENT), ["orderId"], RECENT)
    keyed = lookup(newest, customer_keys(dim_customer),
                   {"customerId": "customer_id"}, {"customer_sk": 0})
    return keyed.select("orderId", date_key("placedAtUtc").alias("order_date_key"), "customer_sk")


def fact_order_line(
    lines: DataFrame, context: DataFrame, dim_product: DataFrame, dim_warehouse: DataFrame,
) -> DataFrame:
    """context is order_context's output, or fact_order with its order_id renamed to orderId."""
    keyed = lookup(lines, context, {"orderId": "orderId"}, {"order_date_key": 0, "customer_sk": 0})
    keyed = lookup(keyed, product_keys(dim_product), {"productId": "product_id"}, {"product_sk": 0})
    keyed = lookup(keyed, dim_warehouse, {"warehouseId": "warehouse_id"}, {"warehouse_sk": 0})
    priced = keyed.withColumns({"unit_price_usd": money("unitPriceUsd", 4), "discount_usd": money("discountUsd", 4)})
    return priced.select(
        F.col("orderLineId").alias("order_line_id"), F.col("orderId").alias("order_id"), "order_date_key", "customer_sk",
        "product_sk", "warehouse_sk", "quantity", "unit_price_usd", "discount_usd",
        line_total("quantity", "unit_price_usd", "discount_usd").alias("line_total_usd"))


def fact_transaction(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        F.col("transactionId").alias("transaction_id"), F.col("orderId").alias("order_id"),
        date_key("occurredAtUtc").alias("txn_date_key"), text("provider").alias("provider"), "kind",
        money("amountUsd").alias("amount_usd"), "status", millis_to_seconds_timestamp("occurredAtUtc").alias("occurred_at_utc"))


def fact_inventory_snap(
    inventory: DataFrame, dim_product: DataFrame, dim_warehouse: DataFrame, batch_ts: datetime,
) -> DataFrame:
    keyed = lookup(inventory, product_keys(dim_product), {"productId": "product_id"}, {"product_sk": 0})
    keyed = lookup(keyed, dim_warehouse, {"warehouseId": "warehouse_id"}, {"warehouse_sk": 0})
    return keyed.select(
        F.lit(batch_date_key(batch_ts)).alias("snap_date_key"), "product_sk", "warehouse_sk",
        F.col("onHand").alias("on_hand"), "reserved", F.col("reorderPoint").alias("reorder_point"),
        F.col("safetyStock").alias("safety_stock"))
