"""Curation, snapshots and schema contracts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog import CATALOG, Catalog, EntitySpec, Field, Kind, build_catalog, conform
from starloom.functions.scalars import change_table_operation, entity_of_topic, operation_letter
from starloom.operators import curate as cur
from starloom.operators.latest import latest_change, latest_per_key
from starloom.plans.timeline import raw_changes, record_timeline
from starloom.sources.raw import to_envelopes
from starloom.testbed.frames import BASE_TS, OFFSETS, curated_rows, raw_messages, rows_sql, source_rows, table
from starloom.testbed.registry import query

CURATED_AT = datetime(2026, 7, 25, 12)
CURATED_MS = 1784980800000                 # CURATED_AT in epoch milliseconds


def _register_entity(spec: EntitySpec) -> None:
    key_sql = f'CAST("{spec.key_field}" AS VARCHAR)'
    offset = {"products": "productId", "product-categories": "categoryId", "customers": "customerId", "warehouses": "warehouseId",
              "customer-addresses": "addressId", "orders": "orderId", "order-lines": "orderLineId",
              "transactions": "transactionId", "shipments": "shipmentId", "product-inventory": "productId"}[spec.entity]

    @query("curate_" + spec.entity.replace("-", "_"),
           f'SELECT *, \'insert\' AS operation, CAST({BASE_TS} + "{offset}" AS BIGINT) AS "sourceTsMs", '
           f'CAST({CURATED_MS} AS BIGINT) AS "curatedAtUtc", {key_sql} AS key FROM ({rows_sql(spec.entity)}) r')
    def run(spark, sf_dir):
        curated = cur.curate_entity(raw_messages(spark, sf_dir, spec.entity), spec, CURATED_AT)
        return curated.drop("partition", "offset")


for _spec in CATALOG:
    _register_entity(_spec)


@query("curate_mixed_envelopes", f"""
SELECT c_custkey AS "customerId",
       CASE c_custkey % 8 WHEN 0 THEN 'insert' WHEN 1 THEN 'snapshot' WHEN 2 THEN 'update' WHEN 3 THEN 'delete' ELSE 'x' END
           AS operation,
       CAST(CASE WHEN c_custkey % 8 = 4 THEN 0 ELSE {BASE_TS} + c_custkey END AS BIGINT) AS "sourceTsMs"
FROM customer WHERE c_custkey % 8 <= 4""")
def curate_mixed_envelopes(spark, sf_dir):
    rows, spec = source_rows(spark, sf_dir, "customers"), CATALOG["customers"]
    kind = F.col("CustomerId") % 8
    ts = F.lit(BASE_TS) + F.col("CustomerId")
    op = F.element_at(F.array(*[F.lit(c) for c in "crudxccc"]), (kind + 1).cast("int"))
    nested = to_envelopes(rows.where(kind != 1), spec, F.col("CustomerId"), op, F.when(kind != 4, ts).otherwise(0))
    at_root = to_envelopes(rows.where(kind == 1), spec, F.col("CustomerId"), "r", ts, under_payload=False)
    raw = nested.unionByName(at_root)
    which = F.col("offset") % 8
    raw = raw.withColumn("value", F.when(which == 5, F.lit('{"payload":{"op":"d","source":{"ts_ms":1},"after":null}}'))
                         .when(which == 6, F.lit(None)).otherwise(F.col("value")))
    raw = raw.withColumn("topic", F.when(which == 7, "oltp.OltpDb.dbo.Unknown").otherwise(F.col("topic")))
    return cur.entity_frame(cur.classify(raw, CURATED_AT), spec).select("customerId", "operation", "sourceTsMs")


WIDGETS = EntitySpec("widgets", "Widgets", "WidgetChanged", "id", (
    Field("id", Kind.BIGINT), Field("count", Kind.INTEGER), Field("name", Kind.TEXT, nullable=True),
    Field("price", Kind.DECIMAL_TEXT), Field("active", Kind.BOOLEAN), Field("ts", Kind.MILLIS)), "raw.", "curated.")


@query("curate_field_kinds", """
SELECT event_id AS id, CAST(user_id AS INT) AS count, CASE WHEN event_id % 2 = 0 THEN event_type END AS name,
       CASE WHEN event_id % 3 = 0 THEN CAST(CAST(event_id AS VARCHAR) || '.5' AS VARCHAR) ELSE CAST(event_id AS VARCHAR) || '.50' END AS price,
       event_id % 4 IN (0, 1) AS active, epoch_us(ts) // 1000 AS ts, CAST(event_id AS VARCHAR) AS key
FROM events""")
def curate_field_kinds(spark, sf_dir):
    """Raw-number decimals, integer booleans, text timestamps and absent nullable fields."""
    text = """concat('{"op":"u","source":{"ts_ms":5},"after":{"Id":', event_id, ',"Count":', user_id,
      if(event_id % 2 = 0, concat(',"Name":"', event_type, '"'), ''),
      if(event_id % 3 = 0, concat(',"Price":', event_id, '.5'), concat(',"Price":"', event_id, '.50"')),
      case event_id % 4 when 0 then ',"Active":true' when 1 then ',"Active":1' when 2 then ',"Active":false' else ',"Active":0' end,
      if(event_id % 5 = 0, concat(',"Ts":"', unix_millis(cast(ts as timestamp)), '"'),
         concat(',"Ts":', unix_millis(cast(ts as timestamp)))), '}}')"""
    raw = table(spark, sf_dir, "events").select(
        F.lit("raw.Widgets").alias("topic"), F.expr(text).alias("value"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"))
    return cur.curate_entity(raw, WIDGETS, CURATED_AT).select("id", "count", "name", "price", "active", "ts", "key")


@query("curate_quarantine", """
SELECT 'customers' AS entity, error_code, field, COUNT(*) AS n FROM (
  SELECT CASE WHEN c_custkey % 10 IN (0, 1, 2, 7, 8) THEN 'parse-failed' ELSE 'projection-failed' END AS error_code,
         CASE c_custkey % 10 WHEN 3 THEN 'Email' WHEN 4 THEN 'CustomerId' WHEN 5 THEN 'DisplayName' WHEN 6 THEN 'Status' END AS field
  FROM customer WHERE c_custkey % 10 <> 9) q
GROUP BY error_code, field""")
def curate_quarantine(spark, sf_dir):
    """Broken JSON, rubbish after the JSON, wrong kinds and missing fields, counted per code and field."""
    raw = raw_messages(spark, sf_dir, "customers")
    which, value = F.col("offset") % 10, F.col("value")
    broken = (F.when(which == 0, F.lit("{ this is not valid json")).when(which == 1, F.concat(value, F.lit(" x")))
              .when(which == 2, F.lit("")).when(which == 3, F.replace(value, F.lit('"Email"'), F.lit('"Mail"')))
              .when(which == 4, F.regexp_replace(value, r'"CustomerId":(\d+)', r'"CustomerId":"$1"'))
              .when(which == 5, F.regexp_replace(value, r'"DisplayName":"[^"]*"', '"DisplayName":7'))
              .when(which == 6, F.replace(value, F.lit('"Status":1'), F.lit('"Status":2147483648')))
              .when(which == 7, F.lit('{"payload":null}')).when(which == 8, F.concat(value, F.lit(","), value)).otherwise(value))
    bad = cur.quarantine(cur.classify(raw.withColumn("value", broken), CURATED_AT), "trace", CURATED_AT)
    named = bad.select(F.lit("customers").alias("entity"), "error_code",
                       F.nullif(F.regexp_extract("message", "^(\\w+): ", 1), F.lit("")).alias("field"))
    return named.groupBy("entity", "error_code", "field").agg(F.count(F.lit(1)).alias("n"))


@query("entity_counts", """
WITH found AS (
  SELECT 'customers' AS entity, COUNT(*) AS n FROM customer UNION ALL SELECT 'customer-addresses', COUNT(*) FROM customer
  UNION ALL SELECT 'warehouses', COUNT(*) FROM supplier UNION ALL SELECT 'products', COUNT(*) FROM part
  UNION ALL SELECT 'product-categories', COUNT(DISTINCT p_type) FROM part UNION ALL SELECT 'order-lines', COUNT(*) FROM lineitem
  UNION ALL SELECT UNNEST(['orders', 'transactions', 'shipments']), (SELECT COUNT(*) FROM orders)
  UNION ALL SELECT 'product-inventory', (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x)),
names AS (SELECT UNNEST(['customers','product-categories','products','warehouses','customer-addresses','orders',
                         'order-lines','transactions','shipments','product-inventory']) AS entity)
SELECT names.entity, CAST(COALESCE(n, 0) AS BIGINT) AS records FROM names LEFT JOIN found ON names.entity = found.entity""")
def entity_counts(spark, sf_dir):
    raw = reduce(DataFrame.unionByName, (raw_messages(spark, sf_dir, entity) for entity in CATALOG.entities))
    return cur.record_counts(cur.classify(raw, CURATED_AT))


@query("topic_entities", """
SELECT entity, COUNT(*) AS n FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'elsewhere.topic' ELSE event_type END AS entity FROM events) t
GROUP BY entity""")
def topic_entities(spark, sf_dir):
    topics = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "elsewhere.topic")
        .otherwise(F.concat(F.lit("curated."), "event_type", F.lit(".changed.v1"))).alias("topic"))
    return topics.groupBy(entity_of_topic("topic", "curated.").alias("entity")).agg(F.count(F.lit(1)).alias("n"))


@query("schema_backfill", """
SELECT o_orderkey AS "orderId", '' AS "orderNumber", o_custkey AS "customerId", CAST(0 AS BIGINT) AS "billingAddressId",
       o_custkey AS "shippingAddressId", epoch_us(o_orderdate) // 1000 AS "placedAtUtc", CAST(0 AS INT) AS status,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "subtotalUsd", '' AS "taxUsd", '0.00' AS "shippingUsd",
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "totalUsd", '' AS currency,
       'insert' AS operation
FROM orders""")
def schema_backfill(spark, sf_dir):
    old = curated_rows(spark, sf_dir, "orders").drop("orderNumber", "billingAddressId", "status", "taxUsd", "currency")
    return conform(old, CATALOG["orders"]).drop("sourceTsMs", "curatedAtUtc")


@query("customer_change_events", """
SELECT c_custkey AS "customerId", c_name AS "customerCode", CASE c_custkey % 3 WHEN 1 THEN 'U' ELSE 'I' END AS operation
FROM customer""")
def customer_change_events(spark, sf_dir):
    rows = source_rows(spark, sf_dir, "customers")
    op = F.element_at(F.array(F.lit("c"), F.lit("u"), F.lit("r")), (F.col("CustomerId") % 3 + 1).cast("int"))
    raw = to_envelopes(rows, CATALOG["customers"], F.col("CustomerId"), op, 1)
    return cur.customer_change_events(cur.curate_entity(raw, CATALOG["customers"], CURATED_AT))


@query("latest_per_key", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def latest_user_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return latest_per_key(events, ["user_id"], ["event_id"])


@query("latest_per_composite_key", """
SELECT user_id, event_type, event_id, value,
       first_event_id FROM (
  SELECT *, MIN(event_id) OVER (PARTITION BY user_id, event_type) AS first_event_id,
         ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) e
WHERE rn = 1""")
def latest_user_type_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return latest_per_key(events, ["user_id", "event_type"], ["event_id"], first_seen="first_event_id")


@query("latest_null_keys", """
SELECT user_id, event_id FROM events WHERE user_id % 7 = 0 UNION ALL
SELECT user_id, MAX(event_id) FROM events WHERE user_id % 7 <> 0 GROUP BY user_id""")
def latest_null_keys(spark, sf_dir):
    """Records without a message key never replace one another."""
    keyed = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("key"), "user_id", "event_id")
    return latest_per_key(keyed, ["key"], ["event_id"]).select("user_id", "event_id")


@query("change_op_decode", """
SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' WHEN 3 THEN 'update(before)'
       WHEN 4 THEN 'update(after)' ELSE 'unknown' END AS operation FROM events""")
def change_op_decode(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", change_table_operation(F.col("event_id") % 5).alias("operation"))


@query("latest_change", """
SELECT event_id, event_type, value FROM events WHERE user_id = 7 ORDER BY ts DESC, event_id DESC LIMIT 1""")
def newest_change_of_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return latest_change(events, "user_id", 7, ["ts", "event_id"]).select("event_id", "event_type", "value")


# A key that JSON text writes in escaped form: a quote, a backslash and letters beyond ASCII
_KEY = 'C"42\\Zoë'
_SQL_CUSTOMER = "c_custkey = 42"


def _renamed(rows):
    return rows.withColumn("CustomerCode", F.when(F.col("CustomerId") == 42, F.lit(_KEY)).otherwise(F.col("CustomerCode")))


@query("record_timeline", f"""
SELECT 'customers' AS entity, 'raw' AS stage, c_custkey AS position, 'insert' AS operation, c_name AS detail FROM customer WHERE {_SQL_CUSTOMER}
UNION ALL SELECT 'customers', 'curated', c_custkey, 'insert', c_name FROM customer WHERE {_SQL_CUSTOMER}
UNION ALL SELECT 'customers', 'star', c_custkey + 1, 'current', c_name FROM customer WHERE {_SQL_CUSTOMER}
UNION ALL SELECT 'products', UNNEST(['raw', 'curated']), p_partkey, 'insert', p_name FROM part WHERE p_partkey = 7
UNION ALL SELECT 'products', 'star', p_partkey + 1, 'current', p_name FROM part WHERE p_partkey = 7""")
def follow_records(spark, sf_dir):
    """A customer whose code needs escaping and a product, each from the raw topic to the star; closed versions count too."""
    from starloom.testbed.star_queries import dim_customer, dim_product

    def follow(entity, rows, star, key, **where):
        spec = CATALOG[entity]
        raw = to_envelopes(rows, spec, F.col(OFFSETS[entity]).cast("bigint"), "c", 1)
        found = record_timeline(raw, cur.curate_entity(raw, spec, CURATED_AT), spec, key, star, **where)
        return found.withColumn("entity", F.lit(entity))

    people = dim_customer(spark, sf_dir).withColumn("customer_code", F.when(F.col("customer_id") == 42, F.lit(_KEY)).otherwise(F.col("customer_code")))
    customers = follow("customers", _renamed(source_rows(spark, sf_dir, "customers")), people, _KEY, star_key="customer_code", star_position="customer_sk", detail="displayName")
    return customers.unionByName(follow("products", source_rows(spark, sf_dir, "products"), dim_product(spark, sf_dir), "SKU-7", star_key="sku", star_position="product_sk",
                                        detail="displayName"))


@query("raw_changes", f"""
SELECT 'insert' AS operation, c_custkey AS "offset", c_name AS name FROM customer WHERE {_SQL_CUSTOMER}""")
def changes_of_one_record(spark, sf_dir):
    raw = to_envelopes(_renamed(source_rows(spark, sf_dir, "customers")), CATALOG["customers"], F.col("CustomerId"), "c", 1)
    return raw_changes(raw, CATALOG["customers"], _KEY).select("operation", "offset", F.get_json_object("after", "$.DisplayName").alias("name"))


_OTHER = build_catalog("shop.", "clean.")
_ROUTED = ("customers", "products", "warehouses", "orders")


@query("catalog_contract", " UNION ALL ".join(f"SELECT '{e}' AS entity, '{_OTHER[e].curated_topic}' AS curated_topic, COUNT(*) AS n FROM ({rows_sql(e)}) r" for e in _ROUTED))
def catalog_contract(spark, sf_dir):
    """Messages of topics under other prefixes, curated by a catalog built for them; a topic that it does not know reaches no entity."""
    named = lambda e: raw_messages(spark, sf_dir, e).withColumn("topic", F.lit(_OTHER[e].raw_topic))
    raw = reduce(DataFrame.unionByName, map(named, _ROUTED))
    strange = raw_messages(spark, sf_dir, "customers").join(F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("offset"))), "offset", "left_semi")
    found = cur.classify(raw.unionByName(strange), CURATED_AT, _OTHER)
    topics = F.create_map(*[F.lit(x) for s in _OTHER for x in (s.entity, s.curated_topic)])
    entity = F.when(F.col("outcome") == cur.CURATED, F.col("entity"))
    return found.groupBy(entity.alias("entity"), topics[entity].alias("curated_topic")).agg(F.count(F.lit(1)).alias("n"))
