"""Follow one business key from the raw topic through curation into the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog import EntitySpec
from starloom.operators.curate import parse_envelopes

STAGES = ("raw", "curated", "star")


def record_timeline(
    raw: DataFrame, curated: DataFrame, spec: EntitySpec, key: str, star: DataFrame | None = None,
    star_key: str = "", star_position: str = "", detail: str = "",
) -> DataFrame:
    """Rows (stage, position, operation, detail) of one message key of any entity.

    detail names the curated field shown; the raw stage shows its source, the star stage its column of the same name in
    snake case. star is the dimension the entity ends in, if any, with its business key and surrogate columns.
    """
    source = next(f.source for f in spec.fields if f.name == detail)
    found = _raw_of(raw, spec, key)
    in_raw = found.select(F.lit("raw").alias("stage"), F.col("offset").alias("position"), "operation",
                          F.try_variant_get("after", f"$.{source}", "string").alias("detail"))
    in_curated = curated.where(F.col("key") == key).select(
        F.lit("curated").alias("stage"), F.col("offset").alias("position"), "operation", F.col(detail).cast("string").alias("detail"))
    stages = in_raw.unionByName(in_curated)
    if star is None:
        return stages
    column = "".join(f"_{c.lower()}" if c.isupper() else c for c in detail)
    current = F.when(F.col("is_current") == 1, "current").otherwise("closed") if "is_current" in star.columns else F.lit("current")
    return stages.unionByName(star.where(F.col(star_key) == key).select(
        F.lit("star").alias("stage"), F.col(star_position).cast("bigint").alias("position"), current.alias("operation"),
        F.col(column).cast("string").alias("detail")))


def _raw_of(raw: DataFrame, spec: EntitySpec, key: str) -> DataFrame:
    """Parsed raw changes of one key; no test on the text itself, as a key may be escaped there."""
    key_source = next(f.source for f in spec.fields if f.name == spec.key_field)
    parsed = parse_envelopes(raw.where(F.col("topic") == spec.raw_topic)).where(F.col("parsed"))
    return parsed.where(F.try_variant_get("after", f"$.{key_source}", "string") == key)


def raw_changes(raw: DataFrame, spec: EntitySpec, key: str) -> DataFrame:
    """Raw changes of one key: operation, offset and the after-image."""
    return _raw_of(raw, spec, key).select("operation", "offset", F.to_json("after").alias("after"))
