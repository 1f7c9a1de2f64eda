"""Parquet tables with atomic replacement and replay-safe appends, without a lakehouse format."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import COMPACT, materialize, shuffles_dropped
from starloom.sources.files import committed, exists, remove

_VERSION, _BATCH = "version=", "batch_id="


@dataclass(frozen=True)
class VersionedTable:
    """A table replaced as a whole: each write makes a new folder and readers take the last committed one.

    The version being read is never overwritten, so a job may read the table it writes. A version may carry the name of
    the batch it came from. The last keep versions stay; a reader that began with one of them is not disturbed. With partition
    columns, rows of one value are brought together and sorted, so that file statistics prune.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    keep: int = 3

    def _committed(self) -> list[tuple[int, str]]:
        parts = (name.partition("_") for name in committed(self.spark, self.path, _VERSION))
        return sorted((int(number), batch) for number, _, batch in parts)

    def _folder(self, number: int, batch: str) -> str:
        return f"{self.path}/{_VERSION}{number}{'_' * bool(batch)}{batch}"

    def versions(self) -> list[int]:
        return [number for number, _ in self._committed()]

    def last_batch(self) -> str:
        """The batch the current version came from, empty if it has none."""
        found = self._committed()
        return found[-1][1] if found else ""

    def read(self) -> DataFrame:
        found = self._committed()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self._content(self._folder(*found[-1])).select(self.schema.names)

    @property
    def takes_parts(self) -> bool:
        """Whether replace may be given its rows in parts without making files much smaller."""
        return True

    def replace(self, df: DataFrame | list[DataFrame], batch: str = "") -> DataFrame:
        """Write df as the new content and return it as read back; nothing if the current version came from this batch. Of several
        frames, which together are the content, one is shuffled and written after the other."""
        found = self._committed()
        if not (batch and found and found[-1][1] == batch):
            number = found[-1][0] + 1 if found else 0
            self._write([self._typed(part) for part in (df if isinstance(df, list) else [df])], number, batch)
            self._trim(found)
        return self.read()

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _trim(self, found: list[tuple[int, str]]) -> None:
        """After a write beside the versions found: only the last keep stay."""
        for old in found[:max(0, len(found) + 1 - self.keep)]:
            remove(self.spark, self._folder(*old))
        self._forget()

    def _content(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(folder)

    def _together(self, rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", *self.partition_by).sortWithinPartitions(*self.partition_by) if self.partition_by else rows

    def _write(self, parts: list[DataFrame], number: int, batch: str) -> None:
        for i, rows in enumerate(parts):
            commits = str(i == len(parts) - 1).lower()                   # the version is committed when its last part is written
            with shuffles_dropped(self.spark):
                (self._together(rows).write.mode("append" if i else "overwrite").options(**COMPACT, **{"mapreduce.fileoutputcommitter.marksuccessfuljobs": commits})
                 .parquet(self._folder(number, batch)))

    def _forget(self) -> None:
        """What else goes with the versions that went."""


_WRITE, _NO_VALUE = "write=", "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class FolderTable(VersionedTable):
    """A versioned table with a folder per date key (or per month of it), of which a write only makes those that changed.

    A version is a list of folders, a row each: the key, its digest (row count and two order-free hashes of whole rows) and the
    write that made it. Contents are compared by digest; unchanged folders stay where they are.
    """

    months: bool = False

    @property
    def takes_parts(self) -> bool:
        return self.months                                               # a part gives each of its folders a file of its own

    def _key(self) -> tuple[str, Column]:
        date_key = self.partition_by[0]
        return (f"{date_key}_month", F.floor(F.col(date_key) / 100).cast("int")) if self.months else (date_key, F.col(date_key))

    def _list(self, version: tuple[int, str]) -> DataFrame:
        return self.spark.read.parquet(self._folder(*version))

    def folders(self) -> dict[str | None, int]:
        """Which write the folder of each key comes from."""
        found = self._committed()
        return {r["_of"]: r["_made"] for r in self._list(found[-1]).collect()} if found else {}          # a row per folder

    def _content(self, folder: str) -> DataFrame:
        name = self._key()[0]
        paths = [f"{self.path}/{_WRITE}{r['_made']}/{name}={_NO_VALUE if r['_of'] is None else r['_of']}" for r in self.spark.read.parquet(folder).collect()]
        return self._content_of(paths) if paths else self.spark.createDataFrame([], self.schema)

    def _content_of(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)

    def _digests(self, rows: DataFrame) -> DataFrame:
        whole = [F.xxhash64(*self.schema.names, F.lit(salt)) for salt in (1, 2)]
        return rows.groupBy(self._key()[1].cast("string").alias("_of")).agg(
            F.count(F.lit(1)).alias("_rows"), F.bit_xor(whole[0]).alias("_mixed"), F.sum(whole[1].cast("decimal(38,0)")).cast("string").alias("_summed"))

    def _make(self, parts: list[DataFrame], number: int) -> None:
        """Write rows, which may come in parts, as the folders of their keys."""
        name, key = self._key()
        for i, rows in enumerate(parts):
            with shuffles_dropped(self.spark):
                (rows.withColumn(name, key).hint("rebalance", name).sortWithinPartitions(*dict.fromkeys([name, *self.partition_by])).write
                 .mode("append" if i else "overwrite").options(**COMPACT).partitionBy(name).parquet(f"{self.path}/{_WRITE}{number}"))

    def update(self, rows: DataFrame, keys: set[str | None], batch: str = "") -> None:
        """A new version in which rows are the whole content of the folders keys; all other folders stay unread."""
        found = self._committed()
        number = found[-1][0] + 1 if found else 0
        self._write([self._typed(rows)], number, batch, keys)
        self._trim(found)

    def _write(self, parts: list[DataFrame], number: int, batch: str, keys: set[str | None] | None = None) -> None:
        """keys: the folders that the parts are the content of; all, if None."""
        key, found = self._key()[1], self._committed()
        if not found:                                                   # every folder is new: the rows are written once and read back
            self._make(parts, number)
            now = materialize(self._digests(self._content_of([f"{self.path}/{_WRITE}{number}"])).withColumn("_made", F.lit(number)), "folders")
        else:
            rows = reduce(DataFrame.unionByName, [materialize(part, "folders") for part in parts])          # digests and files must come from the same rows
            now = self._digests(rows)
            same = ["_rows", "_mixed", "_summed"]
            old = self._list(found[-1]).select(*[F.col(c).alias(f"old{c}") for c in ("_of", *same)], "_made")
            equal = F.col("_made").isNotNull()
            for c in same:
                equal = equal & (F.col(c) == F.col(f"old{c}"))
            now = now.join(old, F.col("_of").eqNullSafe(F.col("old_of")), "left").select("_of", *same, F.when(equal, F.col("_made")).otherwise(number).alias("_made"))
            if keys is not None:
                others = self._list(found[-1])
                named = F.col("_of").isin(*[k for k in keys if k is not None])
                now = now.unionByName(others.where(~F.coalesce(named, F.lit(None in keys))))
            now = materialize(now, "folders")
            fresh = now.where(F.col("_made") == number).select("_of")
            if not fresh.isEmpty():
                self._make([rows.join(fresh, key.cast("string").eqNullSafe(F.col("_of")), "left_semi")], number)
        now.coalesce(1).write.mode("overwrite").parquet(self._folder(number, batch))          # the commit: a row per folder

    def _forget(self) -> None:
        held = {r["_made"] for version in self._committed() for r in self._list(version).select("_made").distinct().collect()}
        for number in committed(self.spark, self.path, _WRITE):
            if int(number) not in held:
                remove(self.spark, f"{self.path}/{_WRITE}{number}")


@dataclass(frozen=True)
class BatchTable:
    """An append-only table of batches. A batch's name is its identity: writing it again replaces it.

    Names of streaming batches begin with the run (the checkpoint) they belong to, so equal batch numbers of two
    checkpoints never meet.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    def batches(self) -> list[str]:
        return committed(self.spark, self.path, _BATCH)

    def has(self, batch: str) -> bool:
        return exists(self.spark, f"{self.path}/{_BATCH}{batch}/_SUCCESS")

    def append(self, df: DataFrame, batch: str) -> None:
        if self.sort_by:
            df = df.sortWithinPartitions(*self.partition_by, *self.sort_by)
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/{_BATCH}{batch}")

    def drop(self, batches: list[str]) -> None:
        for batch in batches:
            remove(self.spark, f"{self.path}/{_BATCH}{batch}")

    def read(self, batches: list[str] | None = None) -> DataFrame:
        """Committed batches with their name in batch_id."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.StringType())])
        chosen = self.batches() if batches is None else [b for b in batches if self.has(b)]
        if not chosen:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{_BATCH}{b}" for b in chosen]
        data = self.spark.read.option("basePath", self.path).schema(schema).parquet(*paths)
        return data.select(schema.names)


def batch_name(run: str, number: int) -> str:
    return f"{run}-{number:010d}"


def run_of(batch: str) -> str:
    return batch.rpartition("-")[0]


@dataclass(frozen=True)
class TelemetryTable(BatchTable):
    """Batches of telemetry rows, each with a folder per event day (event_date, by event_time) and sorted inside its files."""

    def _dated(self) -> BatchTable:
        dated = T.StructType([*self.schema.fields, T.StructField("event_date", T.DateType())])
        return BatchTable(self.spark, self.path, dated, ("event_date",), (*[c for c in self.sort_by if c != "event_time"], "event_time"))

    def append(self, df: DataFrame, batch: str) -> None:
        self._dated().append(df.select(*self.schema.names, F.to_date("event_time").alias("event_date")), batch)

    def read(self, batches: list[str] | None = None) -> DataFrame:
        return self._dated().read(batches)
