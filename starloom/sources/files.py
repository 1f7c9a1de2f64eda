"""File-system helpers that go through Hadoop, so they work on any storage Spark can reach."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def committed(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows the prefix in the names of the folders below path whose write was committed, in order of name.

    One listing, however many folders there are.
    """
    fs, target = _hadoop(spark, f"{path}/{prefix}*/_SUCCESS")
    return sorted(s.getPath().getParent().getName()[len(prefix):] for s in fs.globStatus(target) or [])


def checkpoint_run(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a streaming checkpoint: when it was made and the id its query keeps across restarts."""
    fs, target = _hadoop(spark, f"{checkpoint}/metadata")
    made = fs.getFileStatus(target).getModificationTime()
    return f"{made:013d}-{json.loads(spark.read.text(f'{checkpoint}/metadata').first()[0])['id']}"
