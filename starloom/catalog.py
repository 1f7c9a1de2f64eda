"""The ten curated entities as data: field specs, Spark schemas, Avro schemas and topic names."""

from __future__ import annotations

import json
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Kind(Enum):
    """How a source column is encoded in the JSON after-image."""

    BIGINT = "bigint"
    INTEGER = "integer"
    TEXT = "text"
    DECIMAL_TEXT = "decimal"
    BOOLEAN = "boolean"
    MILLIS = "millis"


SPARK_TYPES = {
    Kind.BIGINT: T.LongType(),
    Kind.INTEGER: T.IntegerType(),
    Kind.TEXT: T.StringType(),
    Kind.DECIMAL_TEXT: T.StringType(),
    Kind.BOOLEAN: T.BooleanType(),
    Kind.MILLIS: T.LongType(),
}
AVRO_TYPES = {T.LongType: "long", T.IntegerType: "int", T.StringType: "string", T.BooleanType: "boolean"}
AVRO_DEFAULTS = {"long": 0, "int": 0, "string": "", "boolean": False}

ENVELOPE_FIELDS = (("operation", T.StringType()), ("sourceTsMs", T.LongType()), ("curatedAtUtc", T.LongType()))
POSITION_FIELDS = (("key", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()))


@dataclass(frozen=True)
class Field:
    name: str
    kind: Kind
    nullable: bool = False

    @property
    def source(self) -> str:
        """The source column: the field name in PascalCase."""
        return self.name[0].upper() + self.name[1:]

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.kind]


@dataclass(frozen=True)
class EntitySpec:
    entity: str
    table: str
    record: str
    key_field: str
    fields: tuple[Field, ...]
    raw_prefix: str
    curated_prefix: str
    grain: tuple[str, ...] = ()           # natural key when the message key is coarser than a row

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if self.key_field not in names:
            raise ValueError(f"{self.entity}: key field {self.key_field} is not in the schema")
        if len(set(names)) != len(names):
            raise ValueError(f"{self.entity}: duplicate field names")

    @property
    def raw_topic(self) -> str:
        return self.raw_prefix + self.table

    @property
    def curated_topic(self) -> str:
        return f"{self.curated_prefix}{self.entity}.changed.v1"

    def to_struct_type(self) -> T.StructType:
        """Typed business fields followed by the envelope fields."""
        fields = [T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields]
        return T.StructType(fields + [T.StructField(n, t, False) for n, t in ENVELOPE_FIELDS])

    def avro_schema(self) -> str:
        """The record schema for the curated topic; every field has a default so old data stays readable."""
        fields = []
        for field in self.to_struct_type().fields:
            avro = AVRO_TYPES[type(field.dataType)]
            if field.nullable:
                fields.append({"name": field.name, "type": ["null", avro], "default": None})
            else:
                fields.append({"name": field.name, "type": avro, "default": AVRO_DEFAULTS[avro]})
        return json.dumps({"type": "record", "name": self.record, "namespace": "starloom.curated", "fields": fields})


def conform(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Read older data under the current schema: add absent fields with their default, cast, order."""
    columns = []
    for field in spec.to_struct_type().fields:
        default = None if field.nullable else AVRO_DEFAULTS[AVRO_TYPES[type(field.dataType)]]
        if field.name not in df.columns:
            column = F.lit(default).cast(field.dataType)
        elif field.nullable:
            column = F.col(field.name).cast(field.dataType)
        else:
            column = F.coalesce(F.col(field.name).cast(field.dataType), F.lit(default).cast(field.dataType))
        columns.append(column.alias(field.name))
    return df.select(columns)


class Catalog:
    """An ordered set of entity specs, dimensions before facts."""

    def __init__(self, specs: list[EntitySpec]):
        if len({s.raw_topic for s in specs}) != len(specs) or len({s.curated_topic for s in specs}) != len(specs):
            raise ValueError("topics must be unique over the catalog")
        self.specs = tuple(specs)
        kinds: dict[str, Kind] = {}
        for field in (f for s in specs for f in s.fields):
            if SPARK_TYPES[kinds.setdefault(field.name, field.kind)] != field.spark_type:
                raise ValueError(f"field {field.name} has two types over the catalog")

    def __iter__(self):
        return iter(self.specs)

    def __getitem__(self, entity: str) -> EntitySpec:
        for spec in self.specs:
            if spec.entity == entity:
                return spec
        raise KeyError(entity)

    def for_raw_topic(self, topic: str) -> EntitySpec | None:
        return next((s for s in self.specs if s.raw_topic == topic), None)

    @property
    def entities(self) -> list[str]:
        return [s.entity for s in self.specs]

    @property
    def raw_topics(self) -> list[str]:
        return [s.raw_topic for s in self.specs]

    @property
    def curated_topics(self) -> list[str]:
        return [s.curated_topic for s in self.specs]


_L, _I, _T, _D, _B, _M = Kind.BIGINT, Kind.INTEGER, Kind.TEXT, Kind.DECIMAL_TEXT, Kind.BOOLEAN, Kind.MILLIS

# Table, record, key field and fields of each entity; "?" marks a nullable field.
_ENTITIES = {
    "customers": ("Customers", "CustomerChanged", "customerCode", {
        "customerId": _L, "customerCode": _T, "displayName": _T, "email": _T, "preferredLocale": _T,
        "status": _I, "lifetimeValueUsd": _D}),
    "product-categories": ("ProductCategories", "ProductCategoryChanged", "slug", {
        "categoryId": _I, "parentId?": _I, "name": _T, "slug": _T, "displayOrder": _I}),
    "products": ("Products", "ProductChanged", "sku", {
        "productId": _L, "sku": _T, "categoryId": _I, "displayName": _T, "listPriceUsd": _D, "status": _I}),
    "warehouses": ("Warehouses", "WarehouseChanged", "code", {
        "warehouseId": _I, "code": _T, "name": _T, "region": _T, "countryIso2": _T, "timezoneIana": _T}),
    "customer-addresses": ("CustomerAddresses", "CustomerAddressChanged", "addressId", {
        "addressId": _L, "customerId": _L, "addressType": _I, "city": _T, "region?": _T, "postalCode": _T,
        "countryIso2": _T, "isDefault": _B}),
    "orders": ("Orders", "OrderChanged", "orderNumber", {
        "orderId": _L, "orderNumber": _T, "customerId": _L, "billingAddressId": _L, "shippingAddressId": _L,
        "placedAtUtc": _M, "status": _I, "subtotalUsd": _D, "taxUsd": _D, "shippingUsd": _D, "totalUsd": _D,
        "currency": _T}),
    "order-lines": ("OrderLines", "OrderLineChanged", "orderLineId", {
        "orderLineId": _L, "orderId": _L, "productId": _L, "warehouseId": _I, "quantity": _I,
        "unitPriceUsd": _D, "discountUsd": _D}),
    "transactions": ("Transactions", "TransactionChanged", "transactionId", {
        "transactionId": _L, "orderId": _L, "provider": _T, "providerRef": _T, "kind": _I, "amountUsd": _D,
        "occurredAtUtc": _M, "status": _I}),
    "shipments": ("Shipments", "ShipmentChanged", "trackingNumber", {
        "shipmentId": _L, "orderId": _L, "carrier": _T, "trackingNumber": _T, "shippedAtUtc?": _M,
        "deliveredAtUtc?": _M, "status": _I}),
    "product-inventory": ("ProductInventory", "ProductInventoryChanged", "productId", {
        "productId": _L, "warehouseId": _I, "onHand": _I, "reserved": _I, "reorderPoint": _I, "safetyStock": _I}),
}


def build_catalog(raw_prefix: str = "oltp.OltpDb.dbo.", curated_prefix: str = "curated.") -> Catalog:
    specs = []
    for entity, (table, record, key, fields) in _ENTITIES.items():
        specs.append(EntitySpec(
            entity=entity, table=table, record=record, key_field=key,
            fields=tuple(Field(n.rstrip("?"), k, n.endswith("?")) for n, k in fields.items()),
            raw_prefix=raw_prefix, curated_prefix=curated_prefix,
            grain=("productId", "warehouseId") if entity == "product-inventory" else ()))
    return Catalog(specs)


CATALOG = build_catalog()

RAW_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
    "decimal(18,2)": T.DecimalType(18, 2), "decimal(18,4)": T.DecimalType(18, 4), "decimal(9,6)": T.DecimalType(9, 6),
}


def schema(columns: str) -> T.StructType:
    """A schema from "name type, name type"; unlike StructType.fromDDL it needs no running session."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names and types of the star and telemetry tables.
STAR_SCHEMAS = {
    "dim_date": schema("date_key int, full_date date, year int, quarter int, month int, day int, "
                        "day_of_week int, is_weekend int, iso_week int"),
    "dim_customer": schema("customer_sk bigint, customer_id bigint, customer_code string, display_name string, "
                            "email string, preferred_locale string, status int, lifetime_value_usd decimal(18,2), "
                            "valid_from timestamp, valid_to timestamp, is_current int"),
    "dim_product": schema("product_sk bigint, product_id bigint, sku string, category_id int, "
                           "category_name string, display_name string, list_price_usd decimal(18,4), "
                           "valid_from timestamp, valid_to timestamp, is_current int"),
    "dim_warehouse": schema("warehouse_sk int, warehouse_id int, code string, name string, region string, "
                             "country_iso2 string, timezone_iana string"),
    "dim_carrier": schema("carrier_sk int, carrier string, service_level string"),
    "fact_order": schema("order_id bigint, order_date_key int, customer_sk bigint, billing_address_id bigint, "
                          "shipping_address_id bigint, status int, subtotal_usd decimal(18,2), "
                          "tax_usd decimal(18,2), shipping_usd decimal(18,2), total_usd decimal(18,2), "
                          "currency string, placed_at_utc timestamp"),
    "fact_order_line": schema("order_line_id bigint, order_id bigint, order_date_key int, customer_sk bigint, "
                               "product_sk bigint, warehouse_sk int, quantity int, unit_price_usd decimal(18,4), "
                               "discount_usd decimal(18,4), line_total_usd decimal(18,2)"),
    "fact_transaction": schema("transaction_id bigint, order_id bigint, txn_date_key int, provider string, "
                                "kind int, amount_usd decimal(18,2), status int, occurred_at_utc timestamp"),
    "fact_inventory_snap": schema("snap_date_key int, product_sk bigint, warehouse_sk int, on_hand int, "
                                   "reserved int, reorder_point int, safety_stock int"),
    "bridge_customer_seg": schema("customer_sk bigint, segment_code string, as_of_date_key int, weight decimal(9,6)"),
}
STAR_TABLES = [name for name in STAR_SCHEMAS if name != "bridge_customer_seg"]

TELEMETRY_WIRE = {
    "pipeline_events": schema("event_ms bigint, trace_id string, pipeline string, stage string, status string, "
                               "duration_ms bigint, payload string"),
    "cdc_lag": schema("event_ms bigint, source string, topic string, lag_seconds double"),
    "error_events": schema("event_ms bigint, trace_id string, service string, error_code string, message string, "
                            "stack string"),
}
