"""Raw and curated change topics: Kafka, and a file twin with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import CATALOG, RAW_SCHEMA, Catalog, EntitySpec

def avro_header(schema_id: int) -> bytes:
    """What registry-aware producers put before Avro data: a zero byte and the schema id, four bytes big-endian."""
    return b"\0" + schema_id.to_bytes(4, "big")


def raw_files(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """JSON-line files holding raw messages, as a batch or a stream."""
    reader = (spark.readStream if streaming else spark.read).schema(RAW_SCHEMA)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def kafka_raw(
    spark: SparkSession, servers: str, catalog: Catalog = CATALOG, streaming: bool = True,
    starting: str = "earliest", options: dict[str, str] | None = None,
) -> DataFrame:
    """All raw topics of the catalog from Kafka (needs the spark-sql-kafka package on the cluster)."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(catalog.raw_topics))
              .option("startingOffsets", starting).options(**(options or {})))
    return reader.load().select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset", "timestamp")


def kafka_curated(
    spark: SparkSession, servers: str, spec: EntitySpec, options: dict[str, str] | None = None, header: bytes = b"",
) -> DataFrame:
    """One curated Avro topic as typed records (needs the spark-sql-kafka and spark-avro packages).

    header is what the producer put before the Avro data, as in curated_messages; only its length matters here.
    """
    from pyspark.sql.avro.functions import from_avro

    messages = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", spec.curated_topic)
                .option("startingOffsets", "earliest").options(**(options or {})).load())
    body = F.expr(f"substring(value, {len(header) + 1})")
    return messages.where(F.col("value").isNotNull()).select(
        from_avro(body, spec.avro_schema()).alias("r"), F.col("key").cast("string").alias("key"), "partition", "offset",
    ).select("r.*", "key", "partition", "offset")


def curated_messages(curated: DataFrame, spec: EntitySpec, avro: bool = False, header: bytes = b"") -> DataFrame:
    """Curated records as (topic, key, value) messages: Avro where the package is present, else JSON."""
    record = F.struct(*spec.to_struct_type().names)
    if avro:
        from pyspark.sql.avro.functions import to_avro

        value = F.concat(F.lit(header), to_avro(record, spec.avro_schema()))
    else:
        value = F.to_json(record, {"ignoreNullFields": "false"})
    return curated.select(F.lit(spec.curated_topic).alias("topic"), "key", value.alias("value"))


def to_envelopes(
    rows: DataFrame, spec: EntitySpec, offset, op="c", ts_ms=0, partition=0, under_payload: bool = True,
) -> DataFrame:
    """Source rows (columns in PascalCase) as raw change messages, nulls written out as JSON null."""
    after = F.struct(*[F.col(f.source) for f in spec.fields])
    as_column = lambda v: v if not isinstance(v, (str, int)) else F.lit(v)
    body = F.struct(as_column(op).alias("op"), F.struct(as_column(ts_ms).cast("bigint").alias("ts_ms")).alias("source"),
                    after.alias("after"))
    document = F.struct(body.alias("payload")) if under_payload else body
    return rows.select(
        F.lit(spec.raw_topic).alias("topic"), F.lit(None).cast("string").alias("key"),
        F.to_json(document, {"ignoreNullFields": "false"}).alias("value"),
        as_column(partition).cast("int").alias("partition"), as_column(offset).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"))
