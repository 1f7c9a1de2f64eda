"""The driver's tables as the source rows of the ten entities, and as telemetry.

Each mapping is one list of SQL expressions that both Spark and the checking engine run; only three spellings
differ and are filled in per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import CATALOG
from starloom.operators.lookup import lookup
from starloom.session import materialize_all, prepare
from starloom.sources.raw import to_envelopes

SPARK = {"ms": "unix_millis(cast({0} as timestamp))", "div": "div", "md5": "md5(cast({0} as string))"}
DUCK = {"ms": "epoch_us({0}) // 1000", "div": "//", "md5": "md5(cast({0} as varchar))"}
BASE_TS = 1_767_225_600_000                # 2026-01-01T00:00:00Z: commit time of the row with id 0

_DECIMAL2 = "cast(cast({0} as decimal(18,2)) as varchar(40))"

# entity -> (source columns, FROM clause)
MAPPINGS = {
    "customers": ({
        "CustomerId": "c_custkey", "CustomerCode": "c_name", "DisplayName": "c_name",
        "Email": "lower(c_name) || '@example.com'",
        "PreferredLocale": "case when c_nationkey % 2 = 0 then 'en-US' else 'en-GB' end",
        "Status": "cast(1 as int)", "LifetimeValueUsd": _DECIMAL2.format("c_acctbal")}, "customer"),
    "product-categories": ({
        "CategoryId": "cast(min(p_partkey) + 1 as int)", "ParentId": "cast(null as int)", "Name": "p_type",
        "Slug": "lower(p_type)", "DisplayOrder": "cast(1 as int)"}, "part group by p_type"),
    "products": ({
        "ProductId": "p_partkey", "Sku": "'SKU-' || p_partkey", "CategoryId": "category_id", "DisplayName": "p_name",
        "ListPriceUsd": "cast(cast(p_retailprice as decimal(18,4)) as varchar(40))", "Status": "cast(1 as int)"},
        "part join (select cast(min(p_partkey) + 1 as int) as category_id, p_type as t from part group by p_type) g on p_type = t"),
    "warehouses": ({
        "WarehouseId": "cast(s_suppkey as int)", "Code": "'WH-' || s_suppkey", "Name": "s_name", "Region": "r_name",
        "CountryIso2": "lpad(cast(n_nationkey as varchar(40)), 2, '0')",
        "TimezoneIana": "'Etc/GMT+' || n_regionkey"},
        "supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"),
    "customer-addresses": ({
        "AddressId": "c_custkey", "CustomerId": "c_custkey", "AddressType": "cast(1 as int)", "City": "n_name",
        "Region": "case when c_custkey % 2 = 0 then n_name || '-R' end",
        "PostalCode": "lpad(cast(c_custkey as varchar(40)), 6, '0')",
        "CountryIso2": "lpad(cast(n_nationkey as varchar(40)), 2, '0')", "IsDefault": "c_custkey % 3 = 0"},
        "customer join nation on c_nationkey = n_nationkey"),
    "orders": ({
        "OrderId": "o_orderkey", "OrderNumber": "'ORD-' || o_orderkey", "CustomerId": "o_custkey",
        "BillingAddressId": "o_custkey", "ShippingAddressId": "o_custkey", "PlacedAtUtc": "{ms:o_orderdate}",
        "Status": "case o_orderstatus when 'F' then 4 when 'O' then 1 else 2 end",
        "SubtotalUsd": _DECIMAL2.format("o_totalprice"), "TaxUsd": "'0.00'", "ShippingUsd": "'0.00'",
        "TotalUsd": _DECIMAL2.format("o_totalprice"), "Currency": "'USD'"}, "orders"),
    "order-lines": ({
        "OrderLineId": "l_orderkey * 10 + l_linenumber", "OrderId": "l_orderkey", "ProductId": "l_partkey",
        "WarehouseId": "cast(l_suppkey as int)", "Quantity": "cast(l_quantity as int)",
        "UnitPriceUsd": "cast(cast((cast(round(l_extendedprice * 100) as bigint) * 100 {div} cast(l_quantity as bigint))"
                        " * 0.0001 as decimal(18,4)) as varchar(40))",
        "DiscountUsd": "cast(cast((cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint))"
                       " * 0.0001 as decimal(18,4)) as varchar(40))"}, "lineitem"),
    "transactions": ({
        "TransactionId": "o_orderkey", "OrderId": "o_orderkey",
        "Provider": "case o_orderkey % 3 when 0 then 'stripe' when 1 then 'paypal' else 'adyen' end",
        "ProviderRef": "'ref_' || o_orderkey", "Kind": "cast(2 as int)", "AmountUsd": _DECIMAL2.format("o_totalprice"),
        "OccurredAtUtc": "{ms:o_orderdate} + 60000", "Status": "cast(2 as int)"}, "orders"),
    "shipments": ({
        "ShipmentId": "o_orderkey", "OrderId": "o_orderkey", "Carrier": "o_orderpriority",
        "TrackingNumber": "'TRK-' || o_orderkey", "ShippedAtUtc": "{ms:shipped}",
        "DeliveredAtUtc": "case when o_orderstatus = 'F' then {ms:shipped} + 172800000 end",
        "Status": "case o_orderstatus when 'F' then 4 else 3 end"},
        "orders left join (select l_orderkey, min(l_shipdate) as shipped from lineitem group by l_orderkey) s"
        " on o_orderkey = l_orderkey"),
    "product-inventory": ({
        "ProductId": "l_partkey", "WarehouseId": "cast(l_suppkey as int)", "OnHand": "cast(sum(l_quantity) as int)",
        "Reserved": "cast(count(*) as int)", "ReorderPoint": "cast(max(l_linenumber) as int)",
        "SafetyStock": "cast(10 as int)"}, "lineitem group by l_partkey, l_suppkey"),
}

# column whose value, unique per row, serves as offset
OFFSETS = {"customers": "CustomerId", "product-categories": "CategoryId", "products": "ProductId", "warehouses": "WarehouseId",
           "customer-addresses": "AddressId", "orders": "OrderId", "order-lines": "OrderLineId",
           "transactions": "TransactionId", "shipments": "ShipmentId", "product-inventory": "ProductId"}

EVENTS_AS_STAGES = {
    "trace_id": "{md5:user_id}",
    "pipeline": "case when user_id % 2 = 0 then 'curation' else 'warehouse-sink' end",
    "stage": "event_type",
    "status": "case when event_type = 'error' then 'failed' else 'ok' end",
    "duration_ms": "cast(round(value * 1000) as bigint)",
    "payload": "props",
}


def _dialect(text: str, dialect: dict) -> str:
    import re

    text = re.sub(r"\{(ms|md5):(\w+)\}", lambda m: dialect[m[1]].format(m[2]), text)
    return text.replace("{div}", dialect["div"])


def rows_sql(entity: str) -> str:
    """The entity's curated business columns for the checking engine."""
    columns, source = MAPPINGS[entity]
    lower = lambda n: n[0].lower() + n[1:]
    return "SELECT " + ", ".join(f'{_dialect(e, DUCK)} AS "{lower(n)}"' for n, e in columns.items()) + f" FROM {source}"


def events_sql() -> str:
    return "SELECT event_id, ts AS event_time, " + ", ".join(
        f"{_dialect(e, DUCK)} AS {n}" for n, e in EVENTS_AS_STAGES.items()) + " FROM events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _from(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The FROM clause of a mapping, joined with lookups that hold under skew."""
    read = lambda name: table(spark, sf_dir, name)
    if entity == "products":
        types = read("part").groupBy(F.col("p_type").alias("t")).agg((F.min("p_partkey") + 1).cast("int").alias("category_id"))
        return lookup(read("part"), types, {"p_type": "t"}, {"category_id": None}, "inner")
    if entity in ("warehouses", "customer-addresses"):
        nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        rows, key, unique = ((read("supplier"), "s_nationkey", "s_suppkey") if entity == "warehouses"
                             else (read("customer"), "c_nationkey", "c_custkey"))
        return lookup(rows, nations, {key: "n_nationkey"},
                      {"n_nationkey": None, "n_name": None, "n_regionkey": None, "r_name": None}, "inner")
    if entity == "shipments":
        shipped = read("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped"))
        return read("orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return read(MAPPINGS[entity][1].split(" ")[0])


def source_rows(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Source rows of an entity, columns in PascalCase."""
    columns, source = MAPPINGS[entity]
    rows = _from(spark, sf_dir, entity)
    if entity == "product-categories":
        rows = rows.groupBy("p_type").agg(F.expr(columns["CategoryId"]).alias("CategoryId"))
        columns = {**columns, "CategoryId": "CategoryId"}
    if entity == "product-inventory":
        aggregates = ("OnHand", "Reserved", "ReorderPoint")
        rows = rows.groupBy("l_partkey", "l_suppkey").agg(*[F.expr(columns[a]).alias(a) for a in aggregates])
        columns = {**columns, **{a: a for a in aggregates}}
    return rows.select(*[F.expr(_dialect(e, SPARK)).alias(n) for n, e in columns.items()])


def raw_messages(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Source rows as raw change messages."""
    offset = F.col(OFFSETS[entity]).cast("bigint")
    return to_envelopes(source_rows(spark, sf_dir, entity), CATALOG[entity], offset, "c", F.lit(BASE_TS) + offset)


def curated_rows(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Records as curation would leave them, straight from the source rows."""
    rows = source_rows(spark, sf_dir, entity)
    offset = F.col(OFFSETS[entity]).cast("bigint")
    return rows.select(
        *[F.col(f.source).alias(f.name) for f in CATALOG[entity].fields], F.lit("insert").alias("operation"),
        (F.lit(BASE_TS) + offset).alias("sourceTsMs"), offset.alias("offset"), F.lit(0).alias("partition"))


def stored_frames(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frames by entity as stored ones. An entity that takes its rows one by one from one of the driver's tables is stored already, there;
    only those that are joined or aggregated are written."""
    made = {e: df for e, df in frames.items() if " " in MAPPINGS[e][1]}
    return {**frames, **materialize_all(made)}


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pipeline stage rows."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"),
        *[F.expr(_dialect(e, SPARK)).alias(n) for n, e in EVENTS_AS_STAGES.items()])


def lag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), F.lit("oltp").alias("source"),
        F.concat(F.lit("oltp.OltpDb.dbo."), F.col("event_type")).alias("topic"), F.col("value").alias("lag_seconds"))


def error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_events(spark, sf_dir).where(F.col("stage") == "error").select(
        "event_id", "event_time", "trace_id", F.col("pipeline").alias("service"), F.lit("stage-failed").alias("error_code"),
        F.col("payload").alias("message"), F.lit("").alias("stack"))


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types any client prints alike: decimals as doubles, dates and times as text."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        column = F.col(field.name)
        if kind == "decimal":
            column = column.cast("double")
        elif kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(field.name))
    return df.select(columns)
