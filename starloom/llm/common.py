"""Small helpers the operators of this subpackage share: tables, stored cut points, word hashes, components."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import materialize

TEXT_BATCH_ROWS = 256                                        # rows of an Arrow batch that carries whole texts
_WORD_CACHE_ROWS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named table, only its given columns: further columns of the input never meet those an operator adds."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def small_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Hold Arrow batches to a few hundred rows: texts are long, and Python workers must stay within bounded memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def drop_table(stored: DataFrame) -> None:
    """Remove a table that materialize wrote, once all that was read from it is written itself."""
    files, spark = stored.inputFiles(), stored.sparkSession
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remainder(column: str, modulus: int):
    """crc32 of the id written as text, modulo modulus: the rule that names held-out documents. Null for a null id."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def plain_words(text: bytes | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` of a UTF-8 text with A-Z lower-cased: on bytes both are exact and cheap."""
    return text.lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words. The first _WORD_CACHE_ROWS are kept, frequent words among them; later ones are computed."""

    def __missing__(self, word: str | bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _WORD_CACHE_ROWS:
            self[word] = value
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection), so that any of their bits may be used alone."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of all runs of size words, ascending. A shorter text is one shingle; no words, none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        h = np.full(n, size, np.uint64)
        for k in range(size):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
    return np.unique(h)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of undirected edges (a, b): columns id, component (the smallest id of the component).

    Every node hooks onto the smallest label around it and labels then jump to their label's label, so a round at least
    halves long chains. Each round is a stored table; the loop ends when a round changes nothing. Edges to oneself and
    repeated edges do no harm; nulls must be filtered before.
    """
    pairs = edges.select(F.col("a"), F.col("b")).where("a <> b")
    pairs = materialize(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{label}-edges")
    labels = materialize(pairs.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), f"{label}-labels")
    while True:
        around = (pairs.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id"))
                  .agg(F.min("component").alias("near")))
        hooked = labels.join(around, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("low"))
        # the label moves too: whoever carried the old label may follow the smallest low of its bearers
        moved = hooked.groupBy(F.col("old").alias("bearer")).agg(F.min("low").alias("jump"))
        jumped = (hooked.join(moved.select(F.col("bearer").alias("old"), "jump"), "old")
                  .select("id", "old", F.least("low", "jump").alias("component")))
        stored = materialize(jumped, f"{label}-labels")
        changed = stored.where("component <> old").limit(1).count()
        labels = stored.select("id", "component")
        if not changed:
            return labels
