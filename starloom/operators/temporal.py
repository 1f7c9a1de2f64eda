"""Versions over time: intervals from a change log, point-in-time and period reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalars import END_OF_TIME
from starloom.operators.ranges import keyed_scan


def version_intervals(changes: DataFrame, keys: list[str], at: str, tie_break: list[str], partitions: int | None = None) -> DataFrame:
    """Each change as a version valid from its time until the key's next change."""
    scanned = keyed_scan(changes, keys, [at, *tie_break], following={"_until": at}, partitions=partitions)
    end = F.lit(END_OF_TIME).cast("timestamp")
    return scanned.withColumns({"valid_from": F.col(at), "valid_to": F.coalesce(F.col("_until"), end)}).drop("_until")


def as_of(
    probes: DataFrame, versions: DataFrame, key: str, at: str, take: list[str], tie_break: list[str],
    partitions: int | None = None,
) -> DataFrame:
    """For each probe, the version with valid_from <= at < valid_to; nulls where there is none.

    Versions of a key must not overlap; tie_break orders versions that open at the same time, of which the last
    wins. Probes and versions are laid on one time line per key and the last version is carried forward,
    so work is linear in both even for a key that holds most of the rows.
    """
    value = F.struct(*[F.col(c) for c in take], F.col("valid_to").alias("_valid_to"))
    timeline = versions.select(
        F.col(key), F.col("valid_from").alias("_t"), F.lit(0).alias("_probe"),
        F.struct(*tie_break).alias("_tie"), value.alias("_version"),
        F.lit(None).cast(probes.select(F.struct(*probes.columns)).schema[0].dataType).alias("_row"),
        F.lit(0).cast("bigint").alias("_id"))
    asked = probes.select(
        F.col(key), F.col(at).alias("_t"), F.lit(1).alias("_probe"),
        F.lit(None).cast(timeline.schema["_tie"].dataType).alias("_tie"),
        F.lit(None).cast(timeline.schema["_version"].dataType).alias("_version"),
        F.struct(*probes.columns).alias("_row"), F.monotonically_increasing_id().alias("_id"))
    scanned = keyed_scan(timeline.unionByName(asked), [key], ["_t", "_probe", "_tie", "_id"],
                         carried={"_found": "_version"}, partitions=partitions)
    valid = F.col("_found._valid_to") > F.col("_t")
    return scanned.where(F.col("_probe") == 1).select(
        "_row.*", *[F.when(valid, F.col(f"_found.{c}")).alias(c) for c in take])


def between(versions: DataFrame, start, end) -> DataFrame:
    """Versions that were valid at some time in [start, end]."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return versions.where((F.col("valid_from") <= high) & (F.col("valid_to") > low))


def valid_at(versions: DataFrame, instant) -> DataFrame:
    """All versions valid at one instant."""
    t = F.lit(instant).cast("timestamp")
    return versions.where((F.col("valid_from") <= t) & (F.col("valid_to") > t))
