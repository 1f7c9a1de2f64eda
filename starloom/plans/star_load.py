"""Load the star from a snapshot of curated records, dimensions before facts."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import CATALOG, STAR_SCHEMAS, STAR_TABLES, Catalog
from starloom.operators import dims, facts
from starloom.operators.latest import RECENT
from starloom.operators.lineage import LOAD_JOB, LineageLog
from starloom.operators.telemetry import error_rows, stage_rows
from starloom.session import in_passes
from starloom.sources.tables import FolderTable, TelemetryTable, VersionedTable

PARTITION_COLUMNS = {"fact_order": "order_date_key", "fact_order_line": "order_date_key", "fact_transaction": "txn_date_key"}


class StarStore:
    """The nine star tables below one path. Facts have a folder per date key, or per month where days are small, of which a
    load rewrites those that changed; unless day_folders is False: then they are only clustered and sorted by date key."""

    def __init__(self, spark: SparkSession, path: str, day_folders: bool = True, months: bool = False):
        self.tables = {
            name: FolderTable(spark, f"{path}/{name}", STAR_SCHEMAS[name], (PARTITION_COLUMNS[name],), months=months) if day_folders and name in PARTITION_COLUMNS
            else VersionedTable(spark, f"{path}/{name}", STAR_SCHEMAS[name], (PARTITION_COLUMNS[name],) if name in PARTITION_COLUMNS else ())
            for name in STAR_TABLES}

    def __getitem__(self, name: str) -> VersionedTable:
        return self.tables[name]

    def read(self) -> dict[str, DataFrame]:
        return {name: table.read() for name, table in self.tables.items()}


@dataclass
class LoadReport:
    counts: dict[str, int] = field(default_factory=dict)
    stages: list[tuple] = field(default_factory=list)
    errors: list[tuple] = field(default_factory=list)


class LoadLog:
    """Stage and error rows of loads as tables by event day, one batch per load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.stages = TelemetryTable(spark, f"{path}/pipeline_events", stage_rows(spark, []).schema, (), ("pipeline", "stage", "event_time"))
        self.errors = TelemetryTable(spark, f"{path}/error_events", error_rows(spark, []).schema, (), ("service", "error_code", "event_time"))

    def keep(self, report: LoadReport) -> None:
        name = uuid.uuid4().hex
        self.stages.append(stage_rows(self.spark, report.stages).coalesce(1), name)
        if report.errors:
            self.errors.append(error_rows(self.spark, report.errors).coalesce(1), name)


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load_star(
    snapshot: dict[str, DataFrame], store: StarStore, batch_ts: datetime, trace_id: str = "",
    order: tuple[str, ...] = ("offset",), on_error: Callable[[LoadReport], None] | None = None,
    catalog: Catalog = CATALOG, log: LoadLog | None = None, lineage: LineageLog | None = None,
) -> LoadReport:
    """Nine stages in dependency order, each timed; a failing stage is reported, then raised again.

    order numbers new members (by arrival); which of several records of one id counts is decided by RECENT. Stage and
    error rows go to log, also when the load fails; START and COMPLETE or FAIL of the run go to lineage.

    snapshot maps each entity to a stored frame, as it is read more than once (see CuratedStore.snapshots).
    Every stage writes its table and later stages read it back, so surrogate keys are fixed before any fact uses
    them. Facts are rebuilt from the whole snapshot, large ones in passes; an empty entity leaves its table as it was.
    """
    report = LoadReport()
    loaded: set[str] = set()
    read = lambda name: store[name].read()

    def stage(name: str, build: Callable[[], DataFrame | list[DataFrame]], *sources: DataFrame) -> None:
        started = time.monotonic()
        try:
            if not sources or not sources[0].isEmpty():
                store[name].replace(build())
                loaded.add(name)
        except Exception as error:
            report.errors.append((_utc_now(), trace_id, LOAD_JOB, f"{name}-load-failed", str(error), repr(error)))
            report.stages.append((_utc_now(), trace_id, LOAD_JOB, name, "failed", int((time.monotonic() - started) * 1000), "{}"))
            if log:
                log.keep(report)
            if lineage:
                lineage.emit("FAIL", LOAD_JOB, trace_id, _utc_now(), catalog)
            if on_error:
                on_error(report)
            raise
        elapsed = int((time.monotonic() - started) * 1000)
        report.stages.append((_utc_now(), trace_id, LOAD_JOB, name, "ok", elapsed, "{}"))

    started = time.monotonic()
    if lineage:
        lineage.emit("START", LOAD_JOB, trace_id, _utc_now(), catalog)
    s = snapshot
    keys = lambda: dims.date_keys([(s["orders"], "placedAtUtc"), (s["transactions"], "occurredAtUtc")], batch_ts)
    newest, arrival = list(RECENT), list(order)

    def parts(name: str, entity: str, key: str) -> list[DataFrame]:
        return in_passes(s[entity], key) if store[name].takes_parts else [s[entity]]

    def order_context() -> DataFrame:
        # fact_order was just built from the same orders, so its keys need not be resolved again
        if "fact_order" in loaded:
            return read("fact_order").select(F.col("order_id").alias("orderId"), "order_date_key", "customer_sk")
        return facts.order_context(s["orders"], read("dim_customer"))

    stage("dim_date", lambda: dims.merge_dim_date(read("dim_date"), keys()))
    stage("dim_warehouse", lambda: dims.merge_dim_warehouse(read("dim_warehouse"), s["warehouses"]), s["warehouses"])
    stage("dim_carrier", lambda: dims.merge_dim_carrier(read("dim_carrier"), s["shipments"], order[-1]), s["shipments"])
    stage("dim_customer", lambda: dims.merge_dim_customer(
        read("dim_customer"), s["customers"], batch_ts, newest, arrival), s["customers"])
    stage("dim_product", lambda: dims.merge_dim_product(
        read("dim_product"), s["products"], s["product-categories"], batch_ts, newest, arrival), s["products"])
    stage("fact_order", lambda: [facts.fact_order(p, read("dim_customer")) for p in parts("fact_order", "orders", "orderId")], s["orders"])
    stage("fact_order_line", lambda: [facts.fact_order_line(
        p, order_context(), read("dim_product"), read("dim_warehouse")) for p in parts("fact_order_line", "order-lines", "orderId")], s["order-lines"])
    stage("fact_transaction", lambda: [facts.fact_transaction(p) for p in parts("fact_transaction", "transactions", "transactionId")], s["transactions"])
    stage("fact_inventory_snap", lambda: [facts.fact_inventory_snap(
        p, read("dim_product"), read("dim_warehouse"), batch_ts) for p in parts("fact_inventory_snap", "product-inventory", "productId")], s["product-inventory"])

    report.counts = snapshot_counts(snapshot, catalog)
    elapsed = int((time.monotonic() - started) * 1000)
    total = sum(report.counts.values())
    report.stages.append((_utc_now(), trace_id, LOAD_JOB, "load", "ok", elapsed, f'{{"records":{total}}}'))
    if log:
        log.keep(report)
    if lineage:
        lineage.emit("COMPLETE", LOAD_JOB, trace_id, _utc_now(), catalog)
    return report


def snapshot_counts(snapshot: dict[str, DataFrame], catalog: Catalog = CATALOG) -> dict[str, int]:
    """Records per entity in one job; an entity without records counts 0."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(e).alias("entity"), "n") for e, df in snapshot.items()]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    found = {r["entity"]: r["n"] for r in counted.collect()}          # one row per entity of the catalog
    return {e: found.get(e, 0) for e in catalog.entities}
