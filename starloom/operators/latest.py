"""Latest record per natural key, in arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog import EntitySpec

ARRIVAL = ("partition", "offset")
RECENT = ("sourceTsMs", "offset")         # which record of one business id counts, whatever message key it came under


def latest_per_key(df: DataFrame, keys: list[str], order: list[str] = ARRIVAL, first_seen: str | None = None) -> DataFrame:
    """The last row of each key by order, which must be unique; rows with a null key all stay.

    An aggregate rather than a window: each task first reduces its rows to one per key, so a key with a large
    share of the rows sends only one row per task through the shuffle. first_seen, if given, names a column
    for the smallest value of the last order column within the key.
    """
    position = F.struct(*order)
    # a row with a null key is its own group
    lone = F.when(F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1, position)
    wanted = [F.max_by(F.struct(*df.columns), position).alias("_row")]
    if first_seen:
        wanted.append(F.min(order[-1]).alias(first_seen))
    latest = df.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], lone.alias("_lone")).agg(*wanted)
    return latest.select("_row.*", *([first_seen] if first_seen else []))


def snapshot(curated: DataFrame, spec: EntitySpec) -> DataFrame:
    """Current state of an entity: latest record per message key, or per grain where the key is coarser."""
    return latest_per_key(curated, list(spec.grain) or ["key"], first_seen="first_offset")


def latest_change(changes: DataFrame, key: str, value, order: list[str]) -> DataFrame:
    """The newest change of one key."""
    return changes.where(F.col(key) == value).orderBy(*[F.desc(c) for c in order]).limit(1)
