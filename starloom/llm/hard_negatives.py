"""Hard-negative mining: scores sorted by a secondary-sort shuffle, windows opened and filled by a streaming iterator.

Every anchor is scored against all rows, block by block: an item holds one block of anchors and one of rows (BLOCK_BYTES each at
most), and gives only what can count. Pair scores travel as packed keys (anchor, descending score, id) whose bytes sort as
the tuple does; repartitionAndSortWithinPartitions deals them out by anchor, and an iterator reads each partition once.

1. Within a label: an item's best POSITIVES per anchor; the iterator keeps the first POSITIVES of each anchor.
2. Against all rows: for each positive of an anchor, an item's first NEGATIVES rows of another label whose score lies in the
   positive's window. Positives and these candidates are sorted together: a positive opens its window as it passes, each
   later candidate goes to the windows that still lack rows and reach down to it. Candidates of the score just read
   are held (NEGATIVES at most), because a positive with that score may sort after them.

Nothing is held per anchor but its open windows, so an anchor may have any number of candidates. No pair that belongs to the
result is left out: what an item drops has NEGATIVES (POSITIVES) better rows in the same item and window.

Defined cases: rows with a null id, label or vector, an empty vector or a null or non-finite component take no part. Repeated
rows (same id, label and vector) are one row; rows that share an id but differ are rows of their own, also as
anchors, and tie by a hash. Vectors of different lengths are never scored. Integers beyond 2**53 are multiplied exactly and
scores beyond 64 bits are held at its ends. Zero vectors take part. No anchors or no positives: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import small_batches, table
from starloom.llm.registry import query
from starloom.session import materialize

POSITIVES, NEGATIVES = 5, 5
LOWEST, HIGHEST = 80, 100              # percent of the positive's score between which a negative's must lie
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 16_384
_CHUNK = 128                           # anchors of an item scored at once
_SIGN = 1 << 63
_END = (1 << 64) - 1
_KEYED = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("same", T.BooleanType())])


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, dim, vector (whole numbers as little-endian doubles) of the rows (vec_id, label, embedding) that take part."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, out = [], [], []
            for k, v in enumerate(batch.column(2).to_pylist()):
                if v and None not in v and np.isfinite(v := np.array(v, "<f8")).all():
                    with np.errstate(over="ignore"):
                        v = np.clip(np.floor(scale * v), -np.finfo("<f8").max, np.finfo("<f8").max)
                    rows.append(k)
                    dims.append(len(v))
                    out.append((v + 0.0).tobytes())
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                             names=["vec_id", "label", "dim", "vector"])

    schema = T.StructType([*vectors.select("vec_id", "label").schema.fields, *T.StructType.fromDDL("dim int, vector binary").fields])
    usable = vectors.where("vec_id is not null and label is not null and embedding is not null")
    return usable.select("vec_id", "label", "embedding").mapInArrow(pack, schema)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products as int64. Doubles are exact while no sum can pass 2**53; else Python's integers are used."""
    largest = lambda m: np.abs(m).max(initial=0.0)
    if largest(anchors) * largest(rows) * anchors.shape[1] < 1 << 53:
        return (anchors @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    return np.clip(whole(anchors) @ whole(rows).T, -_SIGN, _SIGN - 1).astype(np.int64)


def pack_keys(anchor: np.ndarray, anchor_row: np.ndarray, score: np.ndarray, vec: np.ndarray, row: np.ndarray) -> list[bytes]:
    """Keys of 40 bytes that sort by anchor, score from the highest, id and row."""
    shift = lambda x: np.asarray(x, np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    raw = np.stack([shift(anchor), shift(anchor_row), ~shift(score), shift(vec), shift(row)], axis=1).astype(">u8").tobytes()
    return [raw[k:k + 40] for k in range(0, len(raw), 40)]


def unpack_key(key: bytes) -> tuple[int, int, int, int, int]:
    a, b, s, v, r = (int.from_bytes(key[k:k + 8], "big") for k in range(0, 40, 8))
    return a - _SIGN, b - _SIGN, _END - s - _SIGN, v - _SIGN, r - _SIGN


def _anchor(key: bytes) -> int:
    return zlib.crc32(key[:16])


def sorted_by_anchor(keyed: DataFrame) -> RDD:
    """(key, same) pairs, the keys of an anchor together and in order."""
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.rdd.map(lambda r: (bytes(r[0]), r[1])).repartitionAndSortWithinPartitions(partitions, _anchor)


def first_positives(pairs: Iterator[tuple[bytes, bool]]) -> Iterator[tuple[bytes, bool]]:
    current, taken = None, 0
    for key, same in pairs:
        if key[:16] != current:
            current, taken = key[:16], 0
        if taken < POSITIVES:
            taken += 1
            yield key, same


def open_windows(pairs: Iterator[tuple[bytes, bool]]) -> Iterator[tuple]:
    """Rows (anchor, positive, rank, negative, positive's score, negative's score) of keys in order."""
    current, windows, tied, level = None, [], [], None
    for key, same in pairs:
        if key[:16] != current:
            current, windows, tied, level = key[:16], [], [], None
        anchor, _, score, vec, _ = unpack_key(key)
        if score != level:
            tied, level = [], score
        if same:
            window = [vec, score, 0]
            windows.append(window)
            if LOWEST * score <= HIGHEST * score:                     # not so for a negative score: its window is empty
                for other in tied:
                    window[2] += 1
                    yield anchor, vec, window[2], other, score, score
            continue
        if len(tied) < NEGATIVES:
            tied.append(vec)
        for window in windows:
            if window[2] < NEGATIVES and LOWEST * window[1] <= 100 * score <= HIGHEST * window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], vec, window[1], score


def items(rows: DataFrame, anchors: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """rows and anchors of equal columns by, each with the item (anchor block, row block) it belongs to; a row has one per block of the other side."""
    spark = rows.sparkSession
    held = F.greatest(F.lit(64), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES // 8) / F.col("dim"))))
    sizes = (rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).join(anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("a")), by)
             .withColumn("row_blocks", F.greatest(F.ceil(F.col("n") / held), F.least(F.lit(2 * spark.sparkContext.defaultParallelism), F.ceil(F.col("n") / 1024))).cast("int"))
             .withColumn("anchor_blocks", F.ceil(F.col("a") / held).cast("int")))
    sizes = materialize(sizes.select(*by, "row_blocks", "anchor_blocks"), "negative-blocks")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        met = side.join(sizes, by).withColumn(own, F.pmod(F.xxhash64("row", F.lit("block")), f"{own}s").cast("int"))
        met = met.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
        return met.select(F.xxhash64(*by, "row_block", "anchor_block").alias("item"), *[F.col(c).alias(c) for c in side.columns])

    return dealt(anchors, "anchor_block", "row_block"), dealt(rows, "row_block", "anchor_block")


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def _chunks(anchors: pd.DataFrame, rows: pd.DataFrame):
    """Per anchor of an item: its place among anchors and its scores with all rows of the item."""
    if len(anchors) and len(rows):
        a, r = _matrix(anchors["vector"]), _matrix(rows["vector"])
        for k in range(0, len(a), _CHUNK):
            for i, s in enumerate(scores(a[k:k + _CHUNK], r)):
                yield k + i, s


def _keyed(found: list[tuple[int, np.ndarray, np.ndarray]], anchors: pd.DataFrame, rows: pd.DataFrame, same: bool) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({"key": [], "same": []})
    at = np.concatenate([np.full(len(take), i) for i, take, _ in found])
    take, score = np.concatenate([t for _, t, _ in found]), np.concatenate([s for _, _, s in found])
    keys = pack_keys(anchors["vec_id"].to_numpy()[at], anchors["row"].to_numpy()[at], score, rows["vec_id"].to_numpy()[take], rows["row"].to_numpy()[take])
    return pd.DataFrame({"key": keys, "same": np.full(len(keys), same)})


def _best_of_label(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    vec, row, own, found = rows["vec_id"].to_numpy(), rows["row"].to_numpy(), anchors["row"].to_numpy(), []
    for i, s in _chunks(anchors, rows):
        other = np.flatnonzero(row != own[i])
        if len(other) > POSITIVES:
            s_other = s[other]
            other = other[s_other >= np.partition(s_other, -POSITIVES)[-POSITIVES]]         # with all that tie with the last
        best = other[np.lexsort((row[other], vec[other], ~s[other]))][:POSITIVES]
        found.append((i, best, s[best]))
    return _keyed(found, anchors, rows, True)


def _in_windows(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    vec, row, label, own, found = rows["vec_id"].to_numpy(), rows["row"].to_numpy(), rows["label"].to_numpy(), anchors["label"].to_numpy(), []
    positives = anchors["positives"].tolist()
    for i, s in _chunks(anchors, rows):
        windows = sorted({(-(-LOWEST * p // 100), HIGHEST * p // 100) for p in map(int, positives[i])})
        low, high = min(w[0] for w in windows), max(w[1] for w in windows)
        near = np.flatnonzero((label != own[i]) & (s >= max(low, -_SIGN)) & (s <= min(high, _SIGN - 1)))
        near = near[np.lexsort((row[near], vec[near], ~s[near]))]
        falling = ~s[near]                                                                # ascending as the score falls
        taken = [near[k:k + NEGATIVES][s[near[k:k + NEGATIVES]] >= lo] for lo, hi in windows for k in [np.searchsorted(falling, ~np.int64(min(hi, _SIGN - 1)))]]
        near = np.unique(np.concatenate(taken))
        found.append((i, near, s[near]))
    return _keyed(found, anchors, rows, False)


def hard_negatives(rows: DataFrame, anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from quantised rows; anchor tells which rows are anchors."""
    spark = rows.sparkSession
    small_batches(spark, 4096)
    rows = materialize(rows.distinct().withColumn("row", F.xxhash64("vec_id", "label", "vector")), "negative-rows")
    anchors = rows.where(anchor)
    a, r = items(rows, anchors, ["dim", "label"])
    best = a.groupBy("item").cogroup(r.groupBy("item")).applyInPandas(_best_of_label, _KEYED)
    positives = materialize(spark.createDataFrame(sorted_by_anchor(best).mapPartitions(first_positives), _KEYED), "negative-positives")

    parts = T.StructType([T.StructField("row", T.LongType()), T.StructField("score", T.LongType())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [unpack_key(k) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([t[1] for t in told], pa.int64()), pa.array([t[2] for t in told], pa.int64())], names=parts.names)

    windows = positives.select("key").mapInArrow(parse, parts).groupBy("row").agg(F.collect_list("score").alias("positives"))
    a, r = items(rows, anchors.join(windows, "row"), ["dim"])
    near = a.groupBy("item").cogroup(r.groupBy("item")).applyInPandas(_in_windows, _KEYED)
    mined = sorted_by_anchor(positives.unionByName(near)).mapPartitions(open_windows)
    return spark.createDataFrame(mined, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id, CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.id AS positive_id, CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INT) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {LOWEST} * p.score <= 100 * s.score AND 100 * s.score <= {HIGHEST} * p.score)
SELECT * FROM n WHERE rank <= {NEGATIVES}"""


@query("op12_hard_negatives", SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(quantised(vectors.withColumn("label", moved)), F.col("vec_id") % 100 == 0)
