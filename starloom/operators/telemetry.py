"""Telemetry as tables: wire rows, reports, and hourly latency states that merge."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import TELEMETRY_WIRE
from starloom.functions.scalars import lag_seconds
from starloom.operators.curate import CURATED
from starloom.operators.ranges import exact_percentiles

FRACTIONS = [0.5, 0.95, 0.99]
NAMES = ["p50", "p95", "p99"]
SKETCH_K = 800


def to_wire(rows: DataFrame, stream: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Table rows as JSON lines; the event time travels as epoch milliseconds and nulls are kept. carry names columns that stay beside the line."""
    names = TELEMETRY_WIRE[stream].names[1:]
    event_ms = F.unix_millis(F.col("event_time").cast("timestamp")).alias("event_ms")
    return rows.select(F.to_json(F.struct(event_ms, *names), {"ignoreNullFields": "false"}).alias("value"), *carry)


def from_wire(lines: DataFrame, stream: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines as table rows; works on a stream as well as on a batch. carry names columns of the lines that stay, such as
    topic, partition and offset."""
    schema = TELEMETRY_WIRE[stream]
    parsed = lines.select(F.from_json("value", schema).alias("r"), *carry)
    return parsed.select(F.timestamp_millis("r.event_ms").alias("event_time"), *[f"r.{n}" for n in schema.names[1:]], *carry)


def stage_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Driver-side stage rows: (event_time, trace_id, pipeline, stage, status, duration_ms, payload)."""
    return spark.createDataFrame(
        rows, "event_time timestamp, trace_id string, pipeline string, stage string, status string, "
              "duration_ms bigint, payload string")


def error_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(
        rows, "event_time timestamp, trace_id string, service string, error_code string, message string, stack string")


def lag_samples(classified: DataFrame, observed_at: datetime, source: str = "oltp") -> DataFrame:
    """One lag sample per curated record with a known commit time."""
    at = F.lit(observed_at).cast("timestamp")
    known = classified.where((F.col("outcome") == CURATED) & (F.col("sourceTsMs") > 0))
    return known.select(at.alias("event_time"), F.lit(source).alias("source"), "topic",
                        lag_seconds(at, "sourceTsMs").alias("lag_seconds"))


def stage_stats(events: DataFrame) -> DataFrame:
    return events.groupBy("pipeline", "stage").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("duration_ms"), 1).alias("avg_ms"))


def lag_stats(lags: DataFrame) -> DataFrame:
    return lags.groupBy("source").agg(
        F.count(F.lit(1)).alias("samples"), F.round(F.min("lag_seconds"), 1).alias("min_lag"),
        F.round(F.max("lag_seconds"), 1).alias("max_lag"))


def recent_errors(errors: DataFrame, n: int = 10, tie_break: list[str] = ()) -> DataFrame:
    return errors.orderBy(F.desc("event_time"), *[F.desc(c) for c in tie_break]).limit(n)


def landed_traces(errors: DataFrame, trace_ids: list[str]) -> DataFrame:
    """How many of the given trace ids have arrived."""
    return errors.where(F.col("trace_id").isin(trace_ids)).agg(F.count_distinct("trace_id").alias("found"))


def emit_counts(streams: dict[str, DataFrame]) -> DataFrame:
    """Rows emitted per telemetry stream."""
    counts = [df.agg(F.count(F.lit(1)).alias("emitted")).select(F.lit(s).alias("stream"), "emitted")
              for s, df in streams.items()]
    total = counts[0]
    for part in counts[1:]:
        total = total.unionByName(part)
    return total


def latency_states(events: DataFrame, batch_id: int | None = None, by: tuple[str, ...] = (), also: tuple[Column, ...] = ()) -> DataFrame:
    """Hourly partial states per (hour, pipeline, stage) and the columns by: a quantile sketch, a count and the aggregates also."""
    states = events.groupBy(F.date_trunc("hour", "event_time").alias("hour"), "pipeline", "stage", *by).agg(
        F.kll_sketch_agg_double(F.col("duration_ms").cast("double"), SKETCH_K).alias("sketch"),
        F.count(F.lit(1)).alias("events"), *also)
    return states if batch_id is None else states.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """Fewer, wider states: merging is associative, so any grouping of batches gives the same report."""
    return states.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"), F.sum("events").alias("events"))


def latency_report(states: DataFrame, keys: list[str] = ("stage",)) -> DataFrame:
    """Counts and percentiles finalised from merged states."""
    merged = merge_states(states, list(keys))
    return merged.select(*keys, "events", *[
        F.round(F.kll_sketch_get_quantile_double("sketch", F.lit(q)), 1).alias(n) for q, n in zip(FRACTIONS, NAMES)])


def exact_latency(events: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """The same report from the raw rows, exact."""
    hourly = events.withColumn("hour", F.date_trunc("hour", "event_time"))
    exact = exact_percentiles(hourly, list(keys), "duration_ms", FRACTIONS, NAMES, partitions)
    return exact.select(*keys, F.col("n").alias("events"), *[F.round(n, 1).alias(n) for n in NAMES])
