"""The five dimensions, each as existing dimension + curated records -> whole new dimension."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog import STAR_SCHEMAS
from starloom.functions.scalars import calendar_columns, date_key, date_key_to_date, money, text
from starloom.operators.latest import RECENT, latest_per_key
from starloom.operators.lookup import lookup, upsert
from starloom.operators.ranges import number_rows
from starloom.operators.scd import CUSTOMER_SCD2, PRODUCT_SCD2, highest_key, scd2_merge
from starloom.session import materialize


def batch_date_key(batch_ts: datetime) -> int:
    return batch_ts.year * 10000 + batch_ts.month * 100 + batch_ts.day


def date_keys(instants: list[tuple[DataFrame, str]], batch_ts: datetime) -> DataFrame:
    """Distinct positive date keys of several epoch-millisecond columns and of the batch day."""
    spark = instants[0][0].sparkSession
    keys = [df.select(date_key(column).alias("date_key")).distinct() for df, column in instants]
    keys.append(spark.range(1).select(F.lit(batch_date_key(batch_ts)).alias("date_key")))
    return reduce(DataFrame.unionByName, keys).where(F.col("date_key") > 0).distinct()


def calendar(keys: DataFrame) -> DataFrame:
    """Date dimension rows for distinct date keys."""
    dated = keys.where(F.col("date_key") > 0).select("date_key").distinct().withColumn(
        "full_date", date_key_to_date("date_key"))
    return dated.select("date_key", "full_date", *[c.alias(n) for n, c in calendar_columns("full_date").items()])


def merge_dim_date(existing: DataFrame, keys: DataFrame) -> DataFrame:
    return upsert(existing, calendar(keys), ["date_key"])


def warehouse_rows(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        F.col("warehouseId").alias("warehouse_sk"), F.col("warehouseId").alias("warehouse_id"),
        text("code").alias("code"), text("name").alias("name"), text("region").alias("region"),
        text("countryIso2").alias("country_iso2"), text("timezoneIana").alias("timezone_iana"))


def merge_dim_warehouse(existing: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Type 1: the natural id is the surrogate key and attributes are overwritten. A re-coded warehouse is one row."""
    newest = latest_per_key(warehouses, ["warehouseId"], RECENT)
    return upsert(existing, warehouse_rows(newest), ["warehouse_sk"])


def merge_dim_carrier(existing: DataFrame, shipments: DataFrame, order: str = "offset") -> DataFrame:
    """Append carriers not seen before, in first-arrival order; known ones never change."""
    seen = shipments.groupBy(text("carrier").alias("carrier")).agg(F.min(order).alias("_first"))
    unseen = materialize(seen.join(existing.select("carrier"), "carrier", "left_anti"), "carriers")
    numbered = number_rows(unseen, [F.col("_first"), F.col("carrier")], "carrier_sk", highest_key(existing, "carrier_sk"))
    return existing.unionByName(numbered.select(
        F.col("carrier_sk").cast("int"), "carrier", F.lit("standard").alias("service_level")))


def customer_attributes(customers: DataFrame, order: list[str]) -> DataFrame:
    return customers.select(
        F.col("customerId").alias("customer_id"), text("customerCode").alias("customer_code"),
        text("displayName").alias("display_name"), text("email").alias("email"),
        text("preferredLocale").alias("preferred_locale"), "status",
        money("lifetimeValueUsd").alias("lifetime_value_usd"), *order)


def product_attributes(products: DataFrame, categories: DataFrame, order: list[str]) -> DataFrame:
    """Product attributes with the category name, empty when the category is unknown."""
    newest = latest_per_key(categories, ["categoryId"], RECENT)
    named = lookup(products, newest.select("categoryId", F.col("name").alias("category_name")),
                   {"categoryId": "categoryId"}, {"category_name": ""})
    return named.select(
        F.col("productId").alias("product_id"), text("sku").alias("sku"), F.col("categoryId").alias("category_id"),
        "category_name", text("displayName").alias("display_name"),
        money("listPriceUsd", 4).alias("list_price_usd"), *order)


def merge_dim_customer(
    existing: DataFrame, customers: DataFrame, batch_ts, order: list[str] = ("offset",), numbering: list[str] | None = None,
) -> DataFrame:
    """order says which record of a customer counts, numbering (order unless given) in which order new ones are numbered."""
    carried = list(dict.fromkeys([*order, *(numbering or ())]))
    return scd2_merge(existing, customer_attributes(customers, carried), CUSTOMER_SCD2, batch_ts, list(order), numbering)


def merge_dim_product(
    existing: DataFrame, products: DataFrame, categories: DataFrame, batch_ts, order: list[str] = ("offset",),
    numbering: list[str] | None = None,
) -> DataFrame:
    carried = list(dict.fromkeys([*order, *(numbering or ())]))
    return scd2_merge(existing, product_attributes(products, categories, carried), PRODUCT_SCD2, batch_ts, list(order), numbering)


def empty_dimension(spark, table: str) -> DataFrame:
    return spark.createDataFrame([], STAR_SCHEMAS[table])
