"""Queries over the star: serving view, customer mart, star joins and order value analytics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import lookup
from starloom.operators.ranges import global_rank, keyed_scan
from starloom.operators.scd import current_versions


def customer_current(dim_customer: DataFrame) -> DataFrame:
    """The serving view: live customer versions without their validity columns."""
    return current_versions(dim_customer).select(
        "customer_sk", "customer_id", "customer_code", "display_name", "email", "preferred_locale", "status",
        "lifetime_value_usd")


def register_customer_current(dim_customer: DataFrame, name: str = "dim_customer_current") -> None:
    customer_current(dim_customer).createOrReplaceTempView(name)


def customer_360(dim_customer: DataFrame, fact_order: DataFrame) -> DataFrame:
    """One row per current customer with what they ordered; customers without orders count as zero.

    Orders are reduced per customer inside each task before the shuffle, so a customer with a large share
    of the orders costs no more than any other.
    """
    orders = fact_order.groupBy("customer_sk").agg(
        F.count("order_id").alias("n"), F.sum("total_usd").alias("revenue"), F.avg("total_usd").alias("average"),
        F.min("order_date_key").alias("first_order_date_key"), F.max("order_date_key").alias("last_order_date_key"))
    profile = current_versions(dim_customer).select("customer_sk", "customer_id", "display_name", "email", "status")
    zero = F.lit(0.0)
    return profile.join(orders, "customer_sk", "left").select(
        *profile.columns,
        F.coalesce("n", F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce(F.round("revenue", 2).cast("double"), zero).alias("total_revenue_usd"),
        F.coalesce(F.round("average", 2).cast("double"), zero).alias("avg_order_value_usd"),
        "first_order_date_key", "last_order_date_key")


def _customers(dim_customer: DataFrame) -> DataFrame:
    return current_versions(dim_customer).select("customer_sk", F.col("display_name").alias("customer"))


def _products(dim_product: DataFrame) -> DataFrame:
    return current_versions(dim_product).select("product_sk", F.col("display_name").alias("product"))


def order_lines_star(
    fact_order_line: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_date: DataFrame,
    dim_warehouse: DataFrame | None = None,
) -> DataFrame:
    """Order lines through customer, product and date, and warehouse if given; unknown members drop out."""
    needed = fact_order_line.select("order_line_id", "customer_sk", "product_sk", "warehouse_sk", "order_date_key",
                                    "quantity", "line_total_usd")
    joined = lookup(needed, dim_date, {"order_date_key": "date_key"}, {"full_date": None}, "inner")
    joined = lookup(joined, _products(dim_product), {"product_sk": "product_sk"}, {"product": None}, "inner")
    joined = lookup(joined, _customers(dim_customer), {"customer_sk": "customer_sk"}, {"customer": None}, "inner")
    columns = ["order_line_id", "customer", "product", "quantity", "line_total_usd", "full_date"]
    if dim_warehouse is not None:
        named = dim_warehouse.select("warehouse_sk", F.col("code").alias("warehouse"))
        joined = lookup(joined, named, {"warehouse_sk": "warehouse_sk"}, {"warehouse": None}, "inner")
        columns.insert(3, "warehouse")
    return joined.select(columns)


def orders_star(fact_order: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Orders through current customer and date."""
    needed = fact_order.select("order_id", "customer_sk", "order_date_key", "total_usd")
    joined = lookup(needed, dim_date, {"order_date_key": "date_key"}, {"full_date": None}, "inner")
    joined = lookup(joined, _customers(dim_customer), {"customer_sk": "customer_sk"}, {"customer": None}, "inner")
    return joined.select("customer", "customer_sk", "order_id", "full_date", "total_usd")


def order_value_analytics(
    fact_order: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, partitions: int | None = None,
) -> DataFrame:
    """Per order: running total and share of the customer's spend, and rank by value over all orders."""
    orders = orders_star(fact_order, dim_customer, dim_date)
    summed = keyed_scan(orders, ["customer_sk"], ["full_date", "order_id"],
                        running={"running_total": "total_usd"}, totals={"_spend": "total_usd"}, partitions=partitions)
    shared = summed.withColumn(
        "pct_of_lifetime", F.round(100 * F.col("total_usd") / F.nullif(F.col("_spend"), F.lit(0)), 1)).drop("_spend")
    return global_rank(shared, "total_usd", ["order_id"], "value_rank", partitions)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table; SCD2 tables count their current versions."""
    counts = []
    for name, df in tables.items():
        label, rows = name, df
        if "is_current" in df.columns:
            label, rows = f"{name}(current)", current_versions(df)
        counts.append(rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("table_name"), "rows"))
    return reduce(DataFrame.unionByName, counts)


def newest_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return customers.orderBy(F.desc("customerId")).limit(n)


def inventory_grid(products: DataFrame, warehouses: DataFrame, sku_like: str, codes: list[str]) -> DataFrame:
    """Every matching product in every listed warehouse.

    The listed codes are spread over each product and resolved by an equi-join, so the work is the size of the
    result and no nested-loop join runs.
    """
    wanted = products.where(F.col("sku").like(sku_like)).select(
        "productId", "sku", F.explode(F.array(*[F.lit(c) for c in codes])).alias("code"))
    listed = warehouses.where(F.col("code").isin(codes)).select("warehouseId", "code")
    return lookup(wanted, listed, {"code": "code"}, {"warehouseId": None}, "inner").select(
        "productId", "warehouseId", "sku", "code")


def resolve_natural_keys(rows: DataFrame, references: list[tuple[dict, DataFrame, str]]) -> DataFrame:
    """Replace natural keys by ids: (columns to match, referenced rows, id to fetch) per reference, inner joins."""
    for on, referenced, wanted in references:
        rows = lookup(rows, referenced, on, {wanted: None}, "inner")
    return rows
