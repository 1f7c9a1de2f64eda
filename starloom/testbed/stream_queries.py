"""Streaming jobs run over files made from the driver's tables; results must equal their batch twins."""

from __future__ import annotations

import contextlib
import uuid
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog import CATALOG
from starloom.operators import telemetry
from starloom.operators.dims import customer_attributes
from starloom.operators.lineage import LineageLog
from starloom.operators.scd import CUSTOMER_SCD2, Scd2Table, scd2_merge
from starloom.plans.star_load import LoadLog, StarStore, load_star
from starloom.catalog import RAW_SCHEMA, STAR_SCHEMAS, TELEMETRY_WIRE
from starloom.session import materialize, shared_dir
from starloom.sources.raw import raw_files, to_envelopes
from starloom.sources.tables import VersionedTable
from starloom.streaming import jobs
from starloom.testbed.frames import BASE_TS, OFFSETS, curated_rows, plain, raw_messages, rows_sql, source_rows, stage_events, table
from starloom.testbed.history_queries import SQL_SKETCH_OK, within_rank_error
from starloom.testbed.registry import query

FILES = 4


def workdir(spark) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _land(messages: DataFrame, path: str) -> int:
    """Raw messages as compressed JSON lines in files of bounded length, as many as there are rows for; returns how many lie there now.
    No shuffle: a fixed number of files would neither hold more rows nor be read by more tasks as the tables grow."""
    messages.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 100_000).json(path)
    return len(messages.sparkSession.read.schema(RAW_SCHEMA).json(path).inputFiles())


def _finish(q):
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# A column of each entity that shows whether values reached their place.
DETAILS = {"customers": "displayName", "product-categories": "name", "products": "displayName", "warehouses": "code", "customer-addresses": "countryIso2",
           "orders": "totalUsd", "order-lines": "unitPriceUsd", "transactions": "amountUsd", "shipments": "trackingNumber", "product-inventory": "onHand"}


def _curated_sql():
    lower = lambda n: n[0].lower() + n[1:]
    return " UNION ALL ".join(f"""SELECT '{e}' AS entity, CAST("{lower(OFFSETS[e])}" AS BIGINT) AS id, CAST("{DETAILS[e]}" AS VARCHAR) AS detail FROM ({rows_sql(e)}) r"""
                              + (' WHERE "customerId" % 9 <> 0' if e == "customers" else "") for e in CATALOG.entities)


@query("stream_curate_drain", _curated_sql() + """
UNION ALL SELECT 'parse-failed', COUNT(*), NULL FROM customer WHERE c_custkey % 9 = 0 UNION ALL SELECT 'drain rows', 2, NULL
UNION ALL SELECT 'counted', (SELECT COUNT(*) FROM lineitem), NULL""")
def stream_curate_drain(spark, sf_dir):
    """Raw messages of all ten entities in several files, curated in two batches; broken customers are quarantined."""
    root = workdir(spark)
    customers = raw_messages(spark, sf_dir, "customers")
    customers = customers.withColumn("value", F.when(F.col("offset") % 9 == 0, F.lit("{broken")).otherwise(F.col("value")))
    others = (raw_messages(spark, sf_dir, e) for e in CATALOG.entities if e != "customers")
    landed = _land(reduce(DataFrame.unionByName, others, customers), f"{root}/raw")
    store = jobs.CuratedStore(spark, f"{root}/curated")
    stream = raw_files(spark, f"{root}/raw", streaming=True, max_files=(landed + 1) // 2)
    _finish(jobs.start_curation(stream, store, f"{root}/checkpoint", jobs.drain(), "trace", datetime(2026, 7, 25, 12)))
    lower = lambda n: n[0].lower() + n[1:]
    rows = [store.entity(e).select(F.lit(e).alias("entity"), F.col(lower(OFFSETS[e])).cast("bigint").alias("id"), F.col(DETAILS[e]).cast("string").alias("detail")) for e in CATALOG.entities]
    told = lambda name, df, n: df.select(F.lit(name).alias("entity"), n.cast("bigint").alias("id"), F.lit(None).cast("string").alias("detail"))
    rows.append(told("parse-failed", store.errors.read().where("error_code = 'parse-failed'").agg(F.count(F.lit(1)).alias("n")), F.col("n")))
    drained = store.stages.read().where("stage = 'drain'")
    rows.append(told("drain rows", drained.agg(F.count(F.lit(1)).alias("n")), F.col("n")))
    rows.append(told("counted", drained.agg(F.sum(F.get_json_object("payload", "$['order-lines']").cast("bigint")).alias("n")), F.col("n")))
    return reduce(DataFrame.unionByName, rows)


@query("stream_replay", f"""
SELECT 'orders' AS entity, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS ids, 0 AS twice FROM orders
UNION ALL SELECT 'customers', COUNT(*), CAST(SUM(c_custkey) AS BIGINT), 0 FROM customer
UNION ALL SELECT 'latest', COUNT(DISTINCT user_id), CAST((SELECT SUM(m) FROM (SELECT MAX(event_id) AS m FROM events GROUP BY user_id) x) AS BIGINT), 0 FROM events
UNION ALL SELECT 'latency', COUNT(*), 0, 0 FROM events""")
def stream_replay(spark, sf_dir):
    """A drain, a new file, then a fresh checkpoint with other batch sizes over the same stores: all rows, none twice."""
    root = workdir(spark)
    store = jobs.CuratedStore(spark, f"{root}/curated")
    log = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    latest = jobs.LatestStore(spark, f"{root}/latest", log.schema, ["user_id"], ["event_id"])
    events, states = stage_events(spark, sf_dir), jobs.latency_store(spark, f"{root}/states")
    first = F.col("event_id") % 3 == 0
    for number, (entity, part) in enumerate((("orders", first), ("customers", ~first))):
        landed = _land(raw_messages(spark, sf_dir, entity), f"{root}/raw")
        log.where(part).repartition(FILES).write.mode("append").parquet(f"{root}/log")
        events.where(part).repartition(FILES).write.mode("append").parquet(f"{root}/events")
        files = (FILES // 2, 3 * FILES)[number]
        _finish(jobs.start_curation(raw_files(spark, f"{root}/raw", True, ((landed + 1) // 2, landed)[number]), store, f"{root}/checkpoint-{number}", jobs.drain(), "trace", datetime(2026, 7, 25, 12)))
        stream = lambda path, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)  # noqa: B023
        _finish(jobs.start_latest(stream(f"{root}/log", log.schema), latest, f"{root}/checkpoint-latest-{number}"))
        _finish(jobs.start_latency(stream(f"{root}/events", events.schema), states, f"{root}/checkpoint-states-{number}"))
        latest.compact()
    sums = [store.entity(e).agg(F.lit(e).alias("entity"), F.count(F.lit(1)).alias("n"), F.sum(key).alias("ids"), (F.count(F.lit(1)) - F.count_distinct(key)).cast("int").alias("twice"))
            for e, key in (("orders", "orderId"), ("customers", "customerId"))]
    newest = latest.read()
    sums.append(newest.agg(F.lit("latest").alias("entity"), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), (F.count(F.lit(1)) - F.count_distinct("user_id")).cast("int").alias("twice")))
    sums.append(telemetry.latency_report(states.read()).agg(F.lit("latency").alias("entity"), F.sum("events").alias("n"), F.lit(0).cast("bigint").alias("ids"), F.lit(0).alias("twice")))
    return reduce(DataFrame.unionByName, sums)


@query("stream_latest", """
SELECT user_id, event_id, event_type, value FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def stream_latest(spark, sf_dir):
    """Latest event per user folded batch by batch, with the deltas compacted at the end."""
    root = workdir(spark)
    log = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    log.repartition(FILES).write.parquet(f"{root}/log")
    store = jobs.LatestStore(spark, f"{root}/latest", log.schema, ["user_id"], ["event_id"])
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", FILES // 2).parquet(f"{root}/log")
    _finish(jobs.start_latest(stream, store, f"{root}/checkpoint"))
    store.compact()
    return store.read()


@query("stream_latest_state", """
SELECT user_id, event_id, event_type, value FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def stream_latest_state(spark, sf_dir):
    """Latest event per user in the state store: every other event first, then, on the same checkpoint, the others."""
    root = workdir(spark)
    log = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    store = jobs.LatestStore(spark, f"{root}/latest", log.schema, ["user_id"], ["event_id"])
    for part in (F.col("event_id") % 2 == 1, F.col("event_id") % 2 == 0):
        log.where(part).repartition(FILES).write.mode("append").parquet(f"{root}/log")
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", FILES).parquet(f"{root}/log")
        _finish(jobs.start_latest_in_state(stream, store, f"{root}/checkpoint"))
    return store.read()


@query("stream_latency", SQL_SKETCH_OK)
def stream_latency(spark, sf_dir):
    """Hourly sketch states appended per batch from telemetry lines, merged when read."""
    root, events = workdir(spark), stage_events(spark, sf_dir)
    telemetry.to_wire(events, "pipeline_events").repartition(FILES).write.text(f"{root}/lines")
    lines = spark.readStream.option("maxFilesPerTrigger", FILES // 2).text(f"{root}/lines")
    states = jobs.latency_store(spark, f"{root}/states")
    _finish(jobs.start_latency(telemetry.from_wire(lines, "pipeline_events"), states, f"{root}/checkpoint"))
    return within_rank_error(events, telemetry.latency_report(states.read()))


@query("stream_state_ranges", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type AS stage, COUNT(*) AS events, TRUE AS few FROM events GROUP BY ALL""")
def stream_state_ranges(spark, sf_dir):
    """States by offset range: a run that compacts as it goes, then a fresh one over what the topic still holds, a quarter of it having expired."""
    root, events = workdir(spark), stage_events(spark, sf_dir)
    end = events.agg(F.max("event_id")).first()[0] + 1
    events = events.withColumns({
        "topic": F.lit("pipeline_events"), "partition": (F.col("event_id") % 2).cast("int"), "offset": F.floor(F.col("event_id") / 2), "quarter": F.floor(F.col("event_id") * 4 / end) + 1})
    lines = materialize(telemetry.to_wire(events, "pipeline_events", ("topic", "partition", "offset", "quarter")), "quarters")
    states, place = jobs.latency_store(spark, f"{root}/states"), jobs.kafka_position()

    def run(name, quarters, **how):
        for quarter in quarters:                                        # a file each, in the order in which a topic is read
            lines.where(F.col("quarter") == quarter).drop("quarter").coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        stream = spark.readStream.schema(lines.drop("quarter").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
        told = telemetry.from_wire(stream, "pipeline_events", ("topic", "partition", "offset"))
        _finish(jobs.start_latency(told, states, f"{root}/{name}-checkpoint", jobs.drain(), *place, **how))

    run("first", (1, 2, 3), compact_every=2)
    states.compact(2)
    run("second", (2, 3, 4), compact_every=2)
    states.compact(2)
    merged = telemetry.merge_states(states.read(), ["hour", "stage"])
    return merged.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "stage", "events", F.lit(states.pieces() <= 4).alias("few"))


@query("stream_telemetry_table", """
SELECT event_type AS stage, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS n FROM events GROUP BY ALL""")
def stream_telemetry_table(spark, sf_dir):
    """Telemetry lines reshaped into a typed table partitioned by day."""
    root = workdir(spark)
    telemetry.to_wire(stage_events(spark, sf_dir), "pipeline_events").repartition(FILES).write.text(f"{root}/lines")
    lines = spark.readStream.option("maxFilesPerTrigger", FILES).text(f"{root}/lines")
    _finish(jobs.start_telemetry_table(lines, "pipeline_events", f"{root}/table", f"{root}/checkpoint"))
    stored = spark.read.parquet(f"{root}/table")
    return stored.groupBy("stage", F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_scd2", """
WITH base AS (SELECT c_custkey AS id, c_name AS name FROM customer),
first AS (SELECT * FROM base WHERE id % 4 <> 3)
SELECT customer_sk, id AS customer_id, display_name, valid_from, valid_to, CAST(is_current AS INT) AS is_current FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY id) AS customer_sk, id, name AS display_name, '2026-01-01 00:00:00' AS valid_from,
         CASE WHEN id % 4 = 0 THEN '2026-02-01 00:00:00' ELSE '9999-12-31 00:00:00' END AS valid_to,
         CASE WHEN id % 4 = 0 THEN 0 ELSE 1 END AS is_current FROM first
  UNION ALL
  SELECT (SELECT COUNT(*) FROM first) + ROW_NUMBER() OVER (ORDER BY id), id, CASE WHEN id % 4 = 0 THEN name || ' II' ELSE name END,
         '2026-02-01 00:00:00', '9999-12-31 00:00:00', 1 FROM base WHERE id % 4 IN (0, 3)) v""")
def stream_scd2(spark, sf_dir):
    """Two drains on one checkpoint: the second resumes and versions the renamed customers."""
    root = workdir(spark)
    people = customer_attributes(curated_rows(spark, sf_dir, "customers"), ["offset"])
    which = F.col("customer_id") % 4
    renamed = F.when(which == 0, F.concat("display_name", F.lit(" II"))).otherwise(F.col("display_name"))
    table_ = VersionedTable(spark, f"{root}/dim_customer", STAR_SCHEMAS["dim_customer"])
    months = [datetime(2026, 1, 1), datetime(2026, 2, 1)]
    for part in (people.where(which != 3), people.where(which != 1).withColumn("display_name", renamed)):
        part.write.mode("append").parquet(f"{root}/changes")
        stream = spark.readStream.schema(people.schema).parquet(f"{root}/changes")
        _finish(jobs.start_scd2(stream, table_, CUSTOMER_SCD2, ["offset"], f"{root}/checkpoint", lambda b: months[b]))
    return plain(table_.read().select("customer_sk", "customer_id", "display_name", "valid_from", "valid_to", "is_current"))


@query("stream_scd2_replay", """
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 1 END AS versions,
       CASE WHEN c_custkey % 4 = 0 THEN c_name || ' II' ELSE c_name END AS display_name, 1 AS current FROM customer""")
def stream_scd2_replay(spark, sf_dir):
    """A drain into a table that already has versions, from a checkpoint whose batch numbers begin at 0 again."""
    root = workdir(spark)
    people = customer_attributes(curated_rows(spark, sf_dir, "customers"), ["offset"])
    table_ = VersionedTable(spark, f"{root}/dim_customer", STAR_SCHEMAS["dim_customer"])
    table_.replace(scd2_merge(table_.read(), people.where("customer_id % 4 <> 3"), CUSTOMER_SCD2, datetime(2026, 1, 1), ["offset"]))
    renamed = F.when(F.col("customer_id") % 4 == 0, F.concat("display_name", F.lit(" II"))).otherwise(F.col("display_name"))
    people.withColumn("display_name", renamed).repartition(FILES).write.parquet(f"{root}/changes")
    stream = spark.readStream.schema(people.schema).option("maxFilesPerTrigger", FILES // 2).parquet(f"{root}/changes")
    _finish(jobs.start_scd2(stream, table_, CUSTOMER_SCD2, ["offset"], f"{root}/checkpoint", lambda b: datetime(2026, 2, 1 + b)))
    return table_.read().groupBy("customer_id").agg(
        F.count(F.lit(1)).cast("int").alias("versions"), F.max(F.when(F.col("is_current") == 1, F.col("display_name"))).alias("display_name"), F.sum("is_current").cast("int").alias("current"))


@query("scd2_buckets", """
WITH c AS (SELECT c_custkey AS id, c_name AS name, c_custkey IN (1, 2, 3) AS renamed FROM customer)
SELECT id AS customer_id, name || CASE WHEN v = 1 THEN ' II' ELSE '' END AS display_name, CASE WHEN v = 1 THEN 100000 + id ELSE id + 1 END AS customer_sk,
       CASE WHEN renamed AND v = 0 THEN 0 ELSE 1 END AS is_current, CASE WHEN v = 1 THEN 2 ELSE 1 END AS month, TRUE AS others_untouched
FROM (SELECT c.*, UNNEST([0, 1]) AS v FROM c) x WHERE v = 0 OR renamed""")
def scd2_buckets(spark, sf_dir):
    """A dimension in 32 buckets: three renamed customers make only their buckets' files new, the closed versions lie apart."""
    people = customer_attributes(curated_rows(spark, sf_dir, "customers"), ["offset"])
    dim = Scd2Table(spark, f"{workdir(spark)}/dim_customer", STAR_SCHEMAS["dim_customer"], CUSTOMER_SCD2, 32)
    dim.merge(people, datetime(2026, 1, 1), ["offset"])
    before, total = set(dim.current().inputFiles()), people.count()
    dim.merge(people.where("customer_id in (1, 2, 3)").withColumn("display_name", F.concat("display_name", F.lit(" II"))), datetime(2026, 2, 1), ["offset"])
    dim.merge(people.where("customer_id > 3"), datetime(2026, 3, 1), ["offset"])                    # known already: no file changes
    made = [n for n in dim.folders().values() if n]
    fresh = {f.rpartition("bucket=")[2].partition("/")[0] for f in set(dim.current().inputFiles()) - before}
    untouched = len(fresh) == len(made) <= 3
    sk = F.col("customer_sk")
    return dim.read().select("customer_id", "display_name", F.when(sk > total, 100000 + sk - total).otherwise(sk).alias("customer_sk"), "is_current",
                             F.month("valid_from").alias("month"), F.lit(untouched).alias("others_untouched"))


@query("stream_star_load", """
SELECT 'fact_order' AS what, COUNT(*) AS n FROM orders UNION ALL SELECT 'fact_order_line', COUNT(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem
UNION ALL SELECT 'dim_customer(current)', COUNT(*) FROM customer UNION ALL SELECT 'numbered by arrival', COUNT(*) FROM customer
UNION ALL SELECT 'stage rows', 10""")
def stream_star_load(spark, sf_dir):
    """Curation, then a tick of the periodic load: surrogate keys follow first arrival although later changes came in reverse."""
    root = workdir(spark)
    store = jobs.CuratedStore(spark, f"{root}/curated")
    messages = reduce(DataFrame.unionByName, (raw_messages(spark, sf_dir, e) for e in CATALOG.entities))
    people = source_rows(spark, sf_dir, "customers")
    again = to_envelopes(people, CATALOG["customers"], F.lit(10_000_000_000) - F.col("CustomerId"), "u", F.lit(BASE_TS + 10_000_000_000) - F.col("CustomerId"))
    _land(messages.unionByName(again), f"{root}/raw")
    _finish(jobs.start_curation(raw_files(spark, f"{root}/raw", True), store, f"{root}/checkpoint", jobs.drain(), "trace", datetime(2026, 7, 25, 12)))
    star, log = StarStore(spark, f"{root}/star", day_folders=False), LoadLog(spark, f"{root}/log")
    ticks = spark.readStream.schema(RAW_SCHEMA).json(f"{root}/raw")
    _finish(jobs.start_star_load(ticks, store, star, f"{root}/ticks", jobs.drain(), "trace", lambda b: datetime(2026, 7, 25, 12), log))
    count = lambda name, df: df.agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n"))
    current = star["dim_customer"].read().where("is_current = 1")
    return reduce(DataFrame.unionByName, [
        count("fact_order", star["fact_order"].read()), count("fact_order_line", star["fact_order_line"].read()), count("dim_customer(current)", current),
        count("numbered by arrival", current.join(current.select(F.col("customer_id").alias("before"), F.col("customer_sk").alias("_sk")), F.col("before") + 1 == F.col("customer_id"), "left")
              .where("before is null or _sk < customer_sk")), count("stage rows", log.stages.read())])


@query("lineage_emitted", """
SELECT 'curation' AS job, UNNEST(['START', 'COMPLETE']) AS event, 1 AS n, COUNT(*) > 0 AS rows FROM orders
UNION ALL SELECT 'warehouse-sink', 'START', 2, COUNT(*) > 0 FROM orders UNION ALL SELECT 'warehouse-sink', UNNEST(['COMPLETE', 'FAIL']), 1, COUNT(*) > 0 FROM orders""")
def lineage_emitted(spark, sf_dir):
    """Run events that curation, a load and a failing load leave in the lineage log."""
    root = workdir(spark)
    lines, store = LineageLog(spark, f"{root}/lineage"), jobs.CuratedStore(spark, f"{root}/curated")
    _land(raw_messages(spark, sf_dir, "orders"), f"{root}/raw")
    _finish(jobs.start_curation(raw_files(spark, f"{root}/raw", True), store, f"{root}/checkpoint", jobs.drain(), "a" * 32, datetime(2026, 7, 25, 12), lines))
    snapshot = store.snapshots()
    load_star(snapshot, StarStore(spark, f"{root}/star", day_folders=False), datetime(2026, 7, 25, 12), "b" * 32, order=("first_offset",), lineage=lines)
    broken = {**snapshot, "orders": snapshot["orders"].withColumn("placedAtUtc", F.raise_error(F.lit("broken order")).cast("bigint"))}
    with contextlib.suppress(PySparkException, Py4JJavaError):
        load_star(broken, StarStore(spark, f"{root}/other", day_folders=False), datetime(2026, 7, 25, 12), "c" * 32, order=("first_offset",), lineage=lines)
    found = store.current().limit(1).count() > 0
    return lines.read().groupBy(F.col("job.name").alias("job"), F.col("eventType").alias("event")).agg(F.count(F.lit(1)).cast("int").alias("n"), F.lit(found).alias("rows"))
