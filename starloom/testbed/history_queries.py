"""Temporal reads, hierarchies, telemetry and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.scalars import run_uuid
from starloom.operators import lineage, telemetry, temporal, trees
from starloom.operators.lookup import lookup
from starloom.testbed.frames import error_events, events_sql, lag_events, stage_events, table
from starloom.testbed.registry import query

_END_US = 253402214400000000               # 9999-12-31T00:00:00Z in epoch microseconds


def change_log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))


def _micros(df, *columns):
    return df.withColumns({c: F.unix_micros(c) for c in columns})


SQL_VERSIONS = """versions AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS valid_from,
         COALESCE(LEAD(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id), %d) AS valid_to FROM events)""" % _END_US


@query("version_intervals", f"WITH {SQL_VERSIONS} SELECT * FROM versions")
def version_intervals(spark, sf_dir):
    versions = temporal.version_intervals(change_log(spark, sf_dir), ["user_id"], "ts", ["event_id"])
    return _micros(versions.select("user_id", "event_id", "event_type", "valid_from", "valid_to"), "valid_from", "valid_to")


@query("as_of_lookup", f"""
WITH log AS (SELECT * FROM events WHERE event_type <> 'purchase'),
versions AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS valid_from,
         COALESCE(LEAD(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id), {_END_US}) AS valid_to FROM log)
SELECT p.event_id, p.user_id, v.event_id AS version_id, v.event_type AS state
FROM events p LEFT JOIN versions v
  ON p.user_id = v.user_id AND epoch_us(p.ts) - 3600000000 >= v.valid_from AND epoch_us(p.ts) - 3600000000 < v.valid_to
WHERE p.event_type = 'purchase'""")
def as_of_lookup(spark, sf_dir):
    """For each purchase, the user's state one hour before."""
    log = change_log(spark, sf_dir)
    versions = temporal.version_intervals(log.where(F.col("event_type") != "purchase"), ["user_id"], "ts", ["event_id"]).select(
        "user_id", F.col("event_id").alias("version_id"), F.col("event_type").alias("state"), "valid_from", "valid_to")
    probes = log.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", (F.col("ts") - F.expr("interval 1 hour")).alias("at"))
    return temporal.as_of(probes, versions, "user_id", "at", ["version_id", "state"], ["version_id"]).drop("at")


@query("system_time_between", f"""
WITH {SQL_VERSIONS}
SELECT user_id, event_id, event_type, valid_from, valid_to FROM versions
WHERE valid_from <= epoch_us(TIMESTAMP '2024-01-11') AND valid_to > epoch_us(TIMESTAMP '2024-01-10')""")
def system_time_between(spark, sf_dir):
    versions = temporal.version_intervals(change_log(spark, sf_dir), ["user_id"], "ts", ["event_id"])
    found = temporal.between(versions, "2024-01-10", "2024-01-11")
    return _micros(found.select("user_id", "event_id", "event_type", "valid_from", "valid_to"), "valid_from", "valid_to")


def _nodes(spark, sf_dir):
    node = lambda df, prefix, key, up, up_key, name: df.select(
        F.concat(F.lit(prefix), key).alias("id"),
        F.lit(None).cast("string").alias("parent") if up is None else F.concat(F.lit(up), up_key).alias("parent"), F.col(name).alias("name"))
    regions = node(table(spark, sf_dir, "region"), "R", "r_regionkey", None, None, "r_name")
    nations = node(table(spark, sf_dir, "nation"), "N", "n_nationkey", "R", "n_regionkey", "n_name")
    suppliers = node(table(spark, sf_dir, "supplier"), "S", "s_suppkey", "N", "s_nationkey", "s_name")
    return regions.unionByName(nations).unionByName(suppliers)


@query("category_tree", """
WITH RECURSIVE nodes AS (
  SELECT 'R' || r_regionkey AS id, NULL AS parent, r_name AS name FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, s_name FROM supplier),
tree AS (
  SELECT id, parent, name, name AS path, 0 AS depth FROM nodes WHERE parent IS NULL
  UNION ALL SELECT n.id, n.parent, n.name, t.path || ' > ' || n.name, t.depth + 1 FROM nodes n JOIN tree t ON n.parent = t.id)
SELECT id, path, CAST(depth AS INT) AS depth FROM tree""")
def category_tree(spark, sf_dir):
    return trees.hierarchy(_nodes(spark, sf_dir), "id", "parent", "name").select("id", "path", "depth")


EVENTS = f"ev AS ({events_sql()})"


@query("telemetry_roundtrip", f"""
WITH {EVENTS} SELECT epoch_us(event_time) // 1000 AS event_ms, trace_id, pipeline, stage, status, duration_ms, payload FROM ev""")
def telemetry_roundtrip(spark, sf_dir):
    rows = telemetry.from_wire(telemetry.to_wire(stage_events(spark, sf_dir), "pipeline_events"), "pipeline_events")
    return rows.select(F.unix_millis("event_time").alias("event_ms"), "trace_id", "pipeline", "stage", "status", "duration_ms",
                       "payload")


@query("stage_stats", f"""
WITH {EVENTS}
SELECT pipeline, stage, COUNT(*) AS rows, CAST((20 * SUM(duration_ms) + COUNT(*)) // (2 * COUNT(*)) AS BIGINT) / 10.0 AS avg_ms
FROM ev GROUP BY pipeline, stage""")
def stage_stats(spark, sf_dir):
    return telemetry.stage_stats(stage_events(spark, sf_dir))


@query("lag_stats", """
SELECT 'oltp' AS source, COUNT(*) AS samples, round(MIN(value), 1) + 0.0 AS min_lag, round(MAX(value), 1) AS max_lag FROM events""")
def lag_stats(spark, sf_dir):
    return telemetry.lag_stats(lag_events(spark, sf_dir))


@query("record_lag", """
SELECT c_custkey % 10 AS bucket, COUNT(*) AS samples, MIN(17755200.0 - c_custkey / 1000.0) AS min_lag
FROM customer WHERE c_custkey % 4 <> 0 GROUP BY c_custkey % 10""")
def record_lag(spark, sf_dir):
    """Lag of each curated record with a known commit time."""
    from datetime import datetime

    from starloom.operators import curate as cur
    from starloom.testbed.frames import raw_messages

    raw = raw_messages(spark, sf_dir, "customers")
    raw = raw.withColumn("value", F.when(F.col("offset") % 4 == 0, F.regexp_replace("value", r'"ts_ms":\d+', '"ts_ms":0'))
                         .otherwise(F.col("value")))
    at = datetime(2026, 7, 25, 12)
    samples = telemetry.lag_samples(cur.classify(raw, at), at)
    # the commit time is 2026-01-01 plus id milliseconds, so the lag gives the id back
    bucket = F.round((F.lit(17755200.0) - F.col("lag_seconds")) * 1000).cast("bigint") % 10
    return samples.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("samples"), F.min("lag_seconds").alias("min_lag"))


@query("error_recent", f"""
WITH {EVENTS}
SELECT event_id, epoch_us(event_time) AS event_us, trace_id, pipeline AS service, 'stage-failed' AS error_code, payload AS message
FROM ev WHERE stage = 'error' ORDER BY event_time DESC, event_id DESC LIMIT 10""")
def error_recent(spark, sf_dir):
    recent = telemetry.recent_errors(error_events(spark, sf_dir), 10, ["event_id"])
    return recent.select("event_id", F.unix_micros("event_time").alias("event_us"), "trace_id", "service", "error_code", "message")


@query("trace_distinct", """
SELECT COUNT(DISTINCT user_id) AS found FROM events WHERE event_type = 'error' AND user_id IN (1, 2, 3, 5, 8)""")
def trace_distinct(spark, sf_dir):
    import hashlib

    ids = [hashlib.md5(str(u).encode()).hexdigest() for u in (1, 2, 3, 5, 8)]
    return telemetry.landed_traces(error_events(spark, sf_dir), ids)


@query("emit_counts", """
SELECT 'pipeline_events' AS stream, COUNT(*) AS emitted FROM events UNION ALL SELECT 'cdc_lag', COUNT(*) FROM events
UNION ALL SELECT 'error_events', COUNT(*) FROM events WHERE event_type = 'error'""")
def emit_counts(spark, sf_dir):
    return telemetry.emit_counts({
        "pipeline_events": telemetry.to_wire(stage_events(spark, sf_dir), "pipeline_events"),
        "cdc_lag": telemetry.to_wire(lag_events(spark, sf_dir), "cdc_lag"),
        "error_events": telemetry.to_wire(error_events(spark, sf_dir), "error_events")})


_QUANTILES = ", ".join(f"round(quantile_cont(CAST(duration_ms AS DOUBLE), {f}), 1) AS {n}"
                       for f, n in zip(telemetry.FRACTIONS, telemetry.NAMES))


@query("latency_by_hour", f"""
WITH {EVENTS}
SELECT epoch_us(date_trunc('hour', event_time)) AS hour_us, pipeline, stage, COUNT(*) AS events, {_QUANTILES}
FROM ev GROUP BY ALL""")
def latency_by_hour(spark, sf_dir):
    exact = telemetry.exact_latency(stage_events(spark, sf_dir), ["hour", "pipeline", "stage"])
    return exact.withColumn("hour_us", F.unix_micros("hour")).drop("hour")


@query("latency_merged", f"WITH {EVENTS} SELECT stage, COUNT(*) AS events, {_QUANTILES} FROM ev GROUP BY stage")
def latency_merged(spark, sf_dir):
    return telemetry.exact_latency(stage_events(spark, sf_dir), ["stage"])


RANK_ERROR = 0.02                          # well above the sketch's error bound at its size


def within_rank_error(events, report):
    """Per stage, whether each reported percentile lies within the allowed rank of its fraction."""
    beside = lookup(events.select("stage", "duration_ms"), report, {"stage": "stage"},
                    {"events": None, **{n: None for n in telemetry.NAMES}}, "inner")
    ranks = []
    for n in telemetry.NAMES:
        ranks.append(F.count_if(F.col("duration_ms") < F.col(n)).alias(f"_{n}_below"))
        ranks.append(F.count_if(F.col("duration_ms") <= F.col(n)).alias(f"_{n}_upto"))
    ranked = beside.groupBy("stage").agg(F.max("events").alias("events"), F.count(F.lit(1)).alias("_n"), *ranks)
    checks = [((F.col(f"_{n}_below") / F.col("_n") <= f + RANK_ERROR) & (F.col(f"_{n}_upto") / F.col("_n") >= f - RANK_ERROR)).alias(n)
              for f, n in zip(telemetry.FRACTIONS, telemetry.NAMES)]
    return ranked.select("stage", "events", *checks)


SQL_SKETCH_OK = "SELECT event_type AS stage, COUNT(*) AS events, TRUE AS p50, TRUE AS p95, TRUE AS p99 FROM events GROUP BY event_type"


@query("latency_sketch", SQL_SKETCH_OK)
def latency_sketch(spark, sf_dir):
    """Hourly sketches merged over all hours and pipelines, checked against the rows they summarise."""
    events = stage_events(spark, sf_dir)
    return within_rank_error(events, telemetry.latency_report(telemetry.latency_states(events)))


def run_log(spark, sf_dir):
    """Lineage run events from the data: nation -> supplier -> part -> brand."""
    def runs(df, job, run_id, src, dst, event_type=F.lit("COMPLETE")):
        dataset = lambda name: F.array(F.struct(F.lit("shop").alias("namespace"), name.alias("name")))
        nothing = F.array().cast("array<struct<namespace:string,name:string>>")
        return df.select(
            event_type.alias("eventType"), F.lit("2026-07-25T12:00:00.000Z").alias("eventTime"), F.lit("starloom").alias("producer"),
            F.struct(run_uuid(run_id).alias("runId")).alias("run"),
            F.struct(F.lit("shop").alias("namespace"), F.lit(job).alias("name")).alias("job"),
            dataset(src).alias("inputs"), F.when(event_type == "COMPLETE", dataset(dst)).otherwise(nothing).alias("outputs"))

    name = lambda prefix, column: F.concat(F.lit(prefix), column)
    kind = F.when(F.col("l_orderkey") % 5 == 0, "START").when(F.col("l_orderkey") % 5 == 1, "FAIL").otherwise("COMPLETE")
    supply = runs(table(spark, sf_dir, "lineitem"), "supply", F.md5(F.col("l_orderkey").cast("string")), name("supplier.", "l_suppkey"),
                  name("part.", "l_partkey"), kind)
    brand = runs(table(spark, sf_dir, "part"), "branding", F.md5(F.col("p_partkey").cast("string")), name("part.", "p_partkey"), name("", "p_brand"))
    origin = runs(table(spark, sf_dir, "supplier"), "origin", F.md5(F.col("s_suppkey").cast("string")), name("nation.", "s_nationkey"),
                  name("supplier.", "s_suppkey"))
    return supply.unionByName(brand).unionByName(origin)


SQL_EDGES = """edges AS (
  SELECT DISTINCT 'supplier.' || l_suppkey AS src, 'supply' AS job, 'part.' || l_partkey AS dst FROM lineitem WHERE l_orderkey % 5 > 1
  UNION SELECT 'part.' || p_partkey, 'branding', p_brand FROM part
  UNION SELECT 'nation.' || s_nationkey, 'origin', 'supplier.' || s_suppkey FROM supplier)"""


@query("lineage_edges", f"WITH {SQL_EDGES} SELECT src, job, dst FROM edges")
def lineage_edges(spark, sf_dir):
    return lineage.edges(lineage.from_json_lines(lineage.to_json_lines(run_log(spark, sf_dir))))


@query("lineage_downstream", f"""
WITH {SQL_EDGES},
s AS (SELECT DISTINCT dst FROM edges WHERE src = 'nation.3'),
p AS (SELECT DISTINCT e.dst FROM edges e JOIN s ON e.src = s.dst),
b AS (SELECT DISTINCT e.dst FROM edges e JOIN p ON e.src = p.dst)
SELECT dst AS node, CAST(1 AS INT) AS depth FROM s UNION ALL SELECT dst, 2 FROM p UNION ALL SELECT dst, 3 FROM b""")
def lineage_downstream(spark, sf_dir):
    return lineage.impact(run_log(spark, sf_dir), "nation.3")


@query("lineage_inventory", """
SELECT 'job' AS kind, UNNEST(['supply', 'branding', 'origin']) AS name
UNION SELECT 'dataset', 'supplier.' || l_suppkey FROM lineitem
UNION SELECT 'dataset', 'part.' || l_partkey FROM lineitem WHERE l_orderkey % 5 > 1
UNION SELECT 'dataset', 'part.' || p_partkey FROM part UNION SELECT 'dataset', p_brand FROM part
UNION SELECT 'dataset', 'nation.' || s_nationkey FROM supplier UNION SELECT 'dataset', 'supplier.' || s_suppkey FROM supplier""")
def lineage_inventory(spark, sf_dir):
    log = run_log(spark, sf_dir)
    return (lineage.jobs(log).select(F.lit("job").alias("kind"), "name")
            .unionByName(lineage.datasets(log).select(F.lit("dataset").alias("kind"), "name")))


@query("run_correlation", """
WITH runs AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS id, 'branding' AS job FROM part
  UNION SELECT CAST(l_orderkey AS VARCHAR), 'supply' FROM lineitem WHERE l_orderkey % 5 > 1
  UNION SELECT CAST(s_suppkey AS VARCHAR), 'origin' FROM supplier)
SELECT substr(t, 1, 8) || '-' || substr(t, 9, 4) || '-' || substr(t, 13, 4) || '-' || substr(t, 17, 4) || '-' || substr(t, 21) AS run_id,
       stage, job, COUNT(*) AS n
FROM (SELECT md5(CAST(user_id AS VARCHAR)) AS t, event_type AS stage, job FROM events JOIN runs ON CAST(user_id AS VARCHAR) = id) e
GROUP BY ALL""")
def run_correlation(spark, sf_dir):
    """Stage events joined with the lineage run of the same id, counted per run and stage."""
    found = lineage.correlate(stage_events(spark, sf_dir), run_log(spark, sf_dir))
    return found.groupBy("run_id", "stage", "job").agg(F.count(F.lit(1)).alias("n"))
