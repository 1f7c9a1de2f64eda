"""Session settings, tunable limits and the shared folder where long jobs write their cut points."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits, each overridable on the session as spark.starloom.<name>.
DEFAULTS = {
    "broadcastBytes": 64 * 1024 * 1024,   # a join side is broadcast only if it measures at most this
    "passBytes": 256 * 1024 * 1024,       # rows that Spark takes for larger are shuffled in several passes
}
# Rows of a Parquet file take about so many times its bytes, and a hash table of rows up to four times theirs.
_ROWS_OF_FILE, _TABLE_OF_ROWS = 8, 4

_own_dirs: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings results depend on: UTC timestamps, last duplicate JSON key wins, AQE."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Spark knows a table by its compressed files and a shuffle by its rows; what the driver has to hold is the hash table
    spark.conf.set("spark.sql.sources.fileCompressionFactor", str(_ROWS_OF_FILE))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit(spark, "broadcastBytes") // _TABLE_OF_ROWS))
    return spark


def limit(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(f"spark.starloom.{name}", str(DEFAULTS[name])))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a folder of our own only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _own_dirs[context.applicationId], ignore_errors=True)
    return _own_dirs[context.applicationId]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, wherever the driver found it; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="starloom-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        package = os.path.dirname(os.path.abspath(__file__))
        context.addPyFile(shutil.make_archive(f"{folder}/starloom", "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)


def _cut_points(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/starloom/{spark.sparkContext.applicationId}"


def drop_cut_points(spark: SparkSession) -> None:
    """Remove what materialize has written for this application. Call it when the results have been written elsewhere."""
    _drop(spark, _cut_points(spark))


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_open = threading.local()


@contextlib.contextmanager
def passing_cut_points(spark: SparkSession):
    """Cut points that this thread writes within the block are removed at its end: what they led to must be written by then."""
    outer, inner = getattr(_open, "folder", None), f"{_cut_points(spark)}/passing-{uuid.uuid4().hex}"
    _open.folder = inner
    try:
        yield
    finally:
        _open.folder = outer
        _drop(spark, inner)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping, _dropping_lock = [0, "false"], threading.Lock()         # how many writes are under way, and the setting before the first


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Spark removes the shuffle files of what is run within the block as soon as it has run, not when the driver next collects garbage."""
    with _dropping_lock:
        if not _dropping[0]:
            _dropping[1] = spark.conf.get(_DROP_SHUFFLES, "false")
        _dropping[0] += 1
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            _dropping[0] -= 1
            spark.conf.set(_DROP_SHUFFLES, "true" if _dropping[0] else _dropping[1])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    Cuts the lineage so that later passes agree on row placement and survive lost executors, and lets
    each pass read only the columns it needs. The shuffles of the write go with it: nothing reads them again.
    """
    return _stored(df, _new_cut_point(df.sparkSession, label))


def _new_cut_point(spark: SparkSession, label: str) -> str:
    return f"{getattr(_open, 'folder', None) or _cut_points(spark)}/{label}-{uuid.uuid4().hex}"


def _stored(df: DataFrame, path: str, options: dict[str, str] | None = None) -> DataFrame:
    spark = df.sparkSession
    with shuffles_dropped(spark):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


COMPACT = {"compression": "zstd"}           # for tables that stay a while: a third smaller than Spark's own choice


def materialize_all(frames: dict[str, DataFrame], at_once: int = 4) -> dict[str, DataFrame]:
    """materialize of independent frames by label, several at a time: cores that a frame of few tasks leaves idle work on the next. As
    all of them lie there together, they are stored compactly."""
    paths = {label: _new_cut_point(df.sparkSession, label) for label, df in frames.items()}      # here: the folder is this thread's
    with ThreadPoolExecutor(at_once) as pool:
        written = {label: pool.submit(inheritable_thread_target(df.sparkSession)(_stored), df, paths[label], COMPACT) for label, df in frames.items()}
        return {label: job.result() for label, job in written.items()}


_MOST_PASSES, _UNKNOWN_BYTES = 8, 1 << 50


def in_passes(df: DataFrame, key: str) -> list[DataFrame]:
    """df cut by a hash of key into parts to be shuffled one after the other, so that only one part's shuffle files lie on disk: as many as its
    size as Spark estimates it asks for, at most eight, so that df is never read more often. df has to give the same rows each time it is read."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    passes = min(_MOST_PASSES, -(-size // limit(df.sparkSession, "passBytes"))) if size < _UNKNOWN_BYTES else 1
    return [df.where(F.pmod(F.xxhash64(key), F.lit(passes)) == i) for i in range(passes)] if passes > 1 else [df]


_FIXED_WIDTH = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def measured_bytes(df: DataFrame) -> int:
    """Bytes of df's values plus a row overhead, from one distributed aggregate."""
    fixed = 24
    variable = F.lit(0).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            variable = variable + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            variable = variable + F.octet_length(F.to_json(F.struct(field.name)))
        else:
            fixed += _FIXED_WIDTH.get(type(field.dataType), 16)
    rows, text = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(variable), F.lit(0))).first()
    return rows * fixed + text


def fits_broadcast(df: DataFrame) -> bool:
    return measured_bytes(df) <= limit(df.sparkSession, "broadcastBytes")
