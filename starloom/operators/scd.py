"""Slowly changing dimensions: type 2 versions, type 1 upserts, append-only members."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.scalars import END_OF_TIME
from starloom.operators.latest import latest_per_key
from starloom.operators.ranges import number_rows
from starloom.session import fits_broadcast, materialize
from starloom.sources.tables import BatchTable, FolderTable


@dataclass(frozen=True)
class Scd2Spec:
    surrogate: str
    business_key: str
    tracked: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, self.business_key, *self.tracked, "valid_from", "valid_to", "is_current"]


CUSTOMER_SCD2 = Scd2Spec("customer_sk", "customer_id", (
    "customer_code", "display_name", "email", "preferred_locale", "status", "lifetime_value_usd"))
PRODUCT_SCD2 = Scd2Spec("product_sk", "product_id", (
    "sku", "category_id", "category_name", "display_name", "list_price_usd"))


def highest_key(df: DataFrame, column: str) -> int:
    """Largest surrogate key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]


def _same(df: DataFrame, old: str, new: str) -> Column:
    """Equal by value; a missing text equals an empty one."""
    if isinstance(df.schema[old].dataType, T.StringType):
        return F.coalesce(F.col(old), F.lit("")) == F.coalesce(F.col(new), F.lit(""))
    return F.col(old).eqNullSafe(F.col(new))


def scd2_merge(
    existing: DataFrame, incoming: DataFrame, spec: Scd2Spec, batch_ts, order: list[str], numbering: list[str] | None = None,
    highest: int | None = None,
) -> DataFrame:
    """The whole new dimension after a batch.

    An unchanged key is a no-op; a changed one closes its current version and gets a new one; an unseen one
    gets its first version; keys absent from the batch stay. Several incoming rows of one business key count as
    the last by order. New surrogate keys continue after the highest existing one (to be given where existing is only a part),
    in (numbering, business key) order; numbering is order unless given.

    When the batch is small enough to broadcast, the dimension is compared in place without a shuffle.
    """
    batch = F.lit(batch_ts).cast("timestamp")
    key, tracked = spec.business_key, list(spec.tracked)
    numbering = list(numbering or order)
    fresh = latest_per_key(incoming.select(key, *tracked, *dict.fromkeys([*order, *numbering])), [key], order)
    fresh = fresh.select(key, *[F.col(c).alias(f"_new_{c}") for c in tracked], *[F.col(c).alias(f"_at_{c}") for c in numbering],
                         F.lit(True).alias("_incoming"))
    current = existing.where(F.col("is_current") == 1).select(spec.columns)
    history = existing.where(F.coalesce(F.col("is_current"), F.lit(0)) != 1).select(spec.columns)

    fresh = materialize(fresh, "scd2-batch")
    if fits_broadcast(fresh):
        compared = materialize(current.join(F.broadcast(fresh), key, "left"), "scd2")
        seen = compared.where("_incoming").select(key)
        unseen = fresh.join(seen, key, "left_anti")
        both = compared.unionByName(unseen, allowMissingColumns=True)
    else:
        both = materialize(current.join(fresh, key, "full_outer"), "scd2")

    equal = F.lit(True)
    for column in tracked:
        equal = equal & _same(both, column, f"_new_{column}")
    was_current = F.col(spec.surrogate).isNotNull()
    arrived = F.coalesce(F.col("_incoming"), F.lit(False))
    changed = was_current & arrived & ~equal

    kept = both.where(was_current).select(
        spec.surrogate, key, *tracked, "valid_from",
        F.when(changed, batch).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(changed, 0).otherwise(1).alias("is_current"))
    opened = both.where(arrived & (~was_current | ~equal)).select(
        key, *[F.col(f"_new_{c}").alias(c) for c in tracked], *[f"_at_{c}" for c in numbering])
    start = highest_key(existing, spec.surrogate) if highest is None else highest
    numbered = number_rows(opened, [*[F.col(f"_at_{c}") for c in numbering], F.col(key)], spec.surrogate, start)
    filled = [F.coalesce(F.col(c), F.lit("")).alias(c) if isinstance(numbered.schema[c].dataType, T.StringType) else F.col(c)
              for c in tracked]
    new = numbered.select(spec.surrogate, key, *filled, batch.alias("valid_from"),
                          F.lit(END_OF_TIME).cast("timestamp").alias("valid_to"), F.lit(1).alias("is_current"))
    return history.unionByName(kept).unionByName(new)


@dataclass(frozen=True)
class Scd2Table:
    """A type 2 dimension of which a batch reads and writes only what it touches.

    Current versions lie in folders by a hash of the business key; a batch reads the folders of its keys, and writes those whose
    rows it changes. Closed versions are added to a history of their own and never read again by a merge. The highest
    surrogate key is kept with each batch. A reader sees the folders of the last committed version and the history up to it.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    spec: Scd2Spec
    buckets: int = 64

    @property
    def _current(self) -> FolderTable:
        return FolderTable(self.spark, f"{self.path}/current", T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())]), ("bucket",))

    @property
    def _history(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.path}/history", T.StructType([*self.schema.fields, T.StructField("highest", T.LongType())]))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.spec.business_key), F.lit(self.buckets)).cast("int")

    def _batches(self, versions: list[int]) -> list[str]:
        """History up to the last committed version: a batch that failed half-way is not read, and is written again."""
        last = max(versions, default=-1)
        return [b for b in self._history.batches() if int(b) <= last]

    def current(self) -> DataFrame:
        return self._current.read().select(self.schema.names)

    def read(self) -> DataFrame:
        closed = self._history.read(self._batches(self._current.versions())).where(F.col(self.spec.surrogate).isNotNull())
        return self.current().unionByName(closed.select(self.schema.names))

    def last_batch(self) -> str:
        return self._current.last_batch()

    def folders(self) -> dict[str | None, int]:
        """Which merge wrote the folder of each bucket."""
        return self._current.folders()

    def merge(self, incoming: DataFrame, batch_ts, order: list[str], numbering: list[str] | None = None, batch: str = "") -> None:
        """Apply a batch as scd2_merge does; nothing if it is the last one that was applied."""
        table = self._current
        if batch and table.last_batch() == batch:
            return
        versions = table.versions()
        number = versions[-1] + 1 if versions else 0
        highest = self._history.read(self._batches(versions)).agg(F.coalesce(F.max("highest"), F.lit(0))).first()[0]
        incoming = incoming.withColumn("bucket", self._bucket())
        touched = [r[0] for r in incoming.select("bucket").distinct().collect()]                     # at most buckets
        before = table.read().where(F.col("bucket").isin(*touched)) if touched else table.read().limit(0)
        merged = materialize(scd2_merge(before.select(self.schema.names), incoming, self.spec, batch_ts, order, numbering, highest), "scd2-merged")
        top = max(highest, highest_key(merged, self.spec.surrogate))
        closed = merged.where(F.coalesce(F.col("is_current"), F.lit(0)) != 1).withColumn("highest", F.lit(top).cast("long"))
        mark = self.spark.createDataFrame([(top,)], "highest long")
        self._history.append(closed.unionByName(mark, allowMissingColumns=True), f"{number:010d}")
        table.update(merged.where("is_current = 1").withColumn("bucket", self._bucket()), {str(b) for b in touched}, batch)


def close_version(dim: DataFrame, surrogate: str, bad_keys: list[int], at) -> DataFrame:
    """Close wrongly opened versions in place."""
    hit = F.col(surrogate).isin(bad_keys)
    closed_at = F.lit(at).cast("timestamp")
    return dim.withColumns({
        "is_current": F.when(hit, 0).otherwise(F.col("is_current")),
        "valid_to": F.when(hit, closed_at).otherwise(F.col("valid_to")),
    })


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current") == 1)
