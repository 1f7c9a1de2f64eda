"""Dataset lineage as tables: run events, edges, impact and correlation with telemetry."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.catalog import CATALOG, STAR_TABLES, Catalog
from starloom.functions.scalars import run_uuid
from starloom.operators.lookup import lookup
from starloom.operators.trees import downstream

_DATASET = T.StructType([T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType())])
RUN_EVENT = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("eventTime", T.StringType()),
    T.StructField("producer", T.StringType()),
    T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
    T.StructField("job", _DATASET),
    T.StructField("inputs", T.ArrayType(_DATASET)),
    T.StructField("outputs", T.ArrayType(_DATASET)),
])
CURATION_JOB, LOAD_JOB = "curation", "warehouse-sink"


def star_datasets() -> list[str]:
    return [f"dwh.{t}" for t in STAR_TABLES]


def job_datasets(catalog: Catalog = CATALOG) -> dict[str, tuple[list[str], list[str]]]:
    """Inputs and outputs of the two jobs."""
    return {CURATION_JOB: (catalog.raw_topics, catalog.curated_topics),
            LOAD_JOB: (catalog.curated_topics, star_datasets())}


def run_events(
    spark: SparkSession, event_type: str, job: str, run_id: str, inputs: list[str], outputs: list[str],
    at: datetime, namespace: str = "starloom", producer: str = "https://example.com/starloom",
) -> DataFrame:
    """One run event. Outputs belong to COMPLETE; START and FAIL carry none."""
    names = outputs if event_type == "COMPLETE" else []
    stamp = at.astimezone(timezone.utc) if at.tzinfo else at
    row = (event_type, stamp.strftime("%Y-%m-%dT%H:%M:%S.") + f"{stamp.microsecond // 1000:03d}Z", producer,
           (run_id,), (namespace, job), [(namespace, n) for n in inputs], [(namespace, n) for n in names])
    events = spark.createDataFrame([row], RUN_EVENT)
    return events.withColumn("run", F.struct(run_uuid("run.runId").alias("runId")))


class LineageLog:
    """Run events kept as a table of JSON lines. Emitting is best effort: a log that can't be written stops no job."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def emit(self, event_type: str, job: str, run_id: str, at: datetime, catalog: Catalog = CATALOG) -> None:
        inputs, outputs = job_datasets(catalog)[job]
        try:
            to_json_lines(run_events(self.spark, event_type, job, run_id, inputs, outputs, at)).coalesce(1).write.mode("append").text(self.path)
        except Exception as error:
            logging.getLogger(__name__).warning("lineage of %s not written: %s", job, error)

    def read(self) -> DataFrame:
        return from_json_lines(self.spark.read.text(self.path))


def to_json_lines(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct(*RUN_EVENT.names), {"ignoreNullFields": "false"}).alias("value"))


def from_json_lines(lines: DataFrame) -> DataFrame:
    # a generator: conditions on the fields stay above it, so a line is parsed once and not once per condition
    return lines.select(F.inline(F.array(F.from_json("value", RUN_EVENT))))


def edges(events: DataFrame) -> DataFrame:
    """Distinct (src, job, dst) of completed runs: every input of a job to every output of it."""
    done = events.where(F.col("eventType") == "COMPLETE").select(F.col("job.name").alias("job"), "inputs", "outputs")
    return (done.select("job", "outputs", F.explode("inputs.name").alias("src"))
            .select("src", "job", F.explode("outputs.name").alias("dst")).distinct())


def jobs(events: DataFrame) -> DataFrame:
    return events.select(F.col("job.name").alias("name")).distinct()


def datasets(events: DataFrame) -> DataFrame:
    return events.select(F.explode(F.concat("inputs", "outputs")).alias("d")).select(F.col("d.name").alias("name")).distinct()


def impact(events: DataFrame, dataset: str, max_depth: int | None = None) -> DataFrame:
    """Datasets downstream of one, with the number of jobs in between."""
    start = events.sparkSession.range(1).select(F.lit(dataset).alias("node"))
    return downstream(edges(events), start, max_depth)


def correlate(stage_events: DataFrame, events: DataFrame) -> DataFrame:
    """Stage events beside the completed lineage run that carries the same id."""
    stages = stage_events.withColumn("run_id", run_uuid("trace_id"))
    runs = events.where(F.col("eventType") == "COMPLETE").select(
        F.col("run.runId").alias("run_id"), F.col("job.name").alias("job")).distinct()
    return lookup(stages, runs, {"run_id": "run_id"}, {"job": None}, "inner")
