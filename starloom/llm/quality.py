"""Quality by compression: a text is as good as the good dictionary makes it small beside the bad one.

From a bounded sample of labelled rows two zstandard raw-content dictionaries are built for each view of a text: its words (the
lower-cased text) and its outline, where every run of letters is one sign, capitals and digits another and a word that
repeats its forerunner a third, so that layout, shouting, stray symbols and repetition show whatever the language. The whole
text is compressed with both dictionaries, block by block; short blocks keep the text's own repetition from standing in for the
dictionary. The normalised difference (bad - good) / (bad + good) of the compressed sizes, one number a view, becomes a score
by logistic calibration on other labelled rows.

Bounds, both per class and documented: DICT_ROWS rows give DICT_BYTES of pieces, cut at a hashed offset where they are read;
CALIBRATION_ROWS rows give one pair of numbers each. Rows are the smallest hashes of doc_id, weighted back to the class
sizes. Everything else covers all rows.

Defined cases: a null, empty or blank text has difference 0 and the score that calibration gives to it. A label row with a null id
or null label is not used; repeated label rows of one id count once, as bad if any says so; a repeated document is scored each
time and gives at most one training row. With labels of one class only, or none, every score is the share of good ones, both
counts raised by one. Equal texts have equal scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import remainder, small_batches, table
from starloom.llm.registry import query

DICT_ROWS = 600
CALIBRATION_ROWS = 2_000
THRESHOLD = 0.7
_SIGNS = bytes(65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 97 if 97 <= b <= 122 or b >= 128 else b for b in range(256))
_RUNS = [(re.compile(sign + rb"+"), sign) for sign in (b"a", b"A", b"0")]


def words_view(text: str) -> bytes:
    return text.lower().encode()


def outline(text: str) -> bytes:
    words = text.encode().split(b" ")
    told = b" ".join([b"=" if a == b else a for a, b in zip(words, [None, *words])]).translate(_SIGNS)
    for run, sign in _RUNS:
        told = run.sub(sign, told)
    return told


@dataclass(frozen=True)
class View:
    of: object                     # text to bytes
    block: int                     # bytes compressed at once
    dict_bytes: int
    level: dict


VIEWS = (
    View(words_view, 1 << 14, 64_000, dict(hash_log=15, chain_log=16, search_log=3, min_match=4, target_length=16, strategy=zstandard.STRATEGY_GREEDY)),
    View(outline, 48, 16_000, dict(hash_log=15, chain_log=16, search_log=5, min_match=3, target_length=32, strategy=zstandard.STRATEGY_BTLAZY2)),
)


def compressor(content: bytes, view: View) -> zstandard.ZstdCompressor:
    level = zstandard.ZstdCompressionParameters(window_log=17, write_content_size=0, write_checksum=0, write_dict_id=0,
                                                format=zstandard.FORMAT_ZSTD1_MAGICLESS, **view.level)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=level)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=level)


@dataclass(frozen=True)
class Dictionaries:
    content: list[tuple[bytes, bytes]]                     # (bad, good) of each view

    def compressors(self) -> list[tuple]:
        return [(compressor(bad, view), compressor(good, view)) for (bad, good), view in zip(self.content, VIEWS)]


def differences(text: str | None, compressors: list[tuple]) -> list[float]:
    """The normalised size differences of one text, one a view: above 0 where the good dictionary makes it smaller."""
    out = []
    for view, (bad, good) in zip(VIEWS, compressors):
        data = view.of(text) if text and not text.isspace() else b""
        blocks = [data[k:k + view.block] for k in range(0, len(data), view.block)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in (bad, good)]
        out.append((sizes[0] - sizes[1]) / max(1, sum(sizes)))
    return out


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries | None
    weights: list[float]                                   # one a view, then the constant

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.concatenate([x, np.ones((len(x), 1))], axis=1) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


def calibrate(x: np.ndarray, good: np.ndarray, row_weights: np.ndarray) -> list[float]:
    """Logistic regression by Newton's method, held by a small L2 pull; the constant is free of it."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, pull = np.zeros(a.shape[1]), np.array([1e-3] * x.shape[1] + [1e-9])
    loss = lambda w: float(row_weights @ np.logaddexp(0, np.where(good > 0, -1, 1) * (a @ w)) + pull @ (w * w) / 2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        slope = a.T @ (row_weights * (p - good)) + pull * w
        step = np.linalg.solve((a * (row_weights * p * (1 - p))[:, None]).T @ a + np.diag(pull + 1e-9), slope)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return [float(v) for v in w]


def _piece(doc_id: int, data: bytes, size: int) -> bytes:
    start = xxhash.xxh64_intdigest(str(doc_id)) % max(1, len(data) - size + 1)
    return data[start:start + size]


def train(docs: DataFrame, labels: DataFrame, dict_rows: int = DICT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """Dictionaries and calibration from docs (doc_id, text) and labels (doc_id, quality)."""
    small_batches(docs.sparkSession)
    once = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("good"))
    counts = {r["good"]: r["n"] for r in once.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}       # two rows at most
    constant = Model(None, [0.0] * len(VIEWS) + [float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)))])
    if len(counts) < 2:
        return constant
    # a class has its rows in the order of a hash of the id: the first fill dictionaries, the next calibrate
    chosen = [once.where(F.col("good") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(dict_rows + calibration_rows)
              .withColumn("place", F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))) for c in (0, 1)]
    part = [F.least(F.lit(dict_rows), F.lit(max(1, n // 4))) for n in (counts[0], counts[1])]
    chosen = chosen[0].withColumn("fills", F.col("place") <= part[0]).unionByName(chosen[1].withColumn("fills", F.col("place") <= part[1])).drop("place")
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")           # at most 2 * (dict_rows + calibration_rows) rows

    sizes = [view.dict_bytes // dict_rows for view in VIEWS]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            pieces = [[_piece(i, view.of(t), size) for view, size in zip(VIEWS, sizes)] for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pieces, pa.list_(pa.binary()))], names=["doc_id", "good", "pieces"])

    found = (rows.where("fills").select("doc_id", "good", "text").mapInArrow(cut, "doc_id long, good int, pieces array<binary>")
             .groupBy("doc_id", "good").agg(F.min("pieces").alias("pieces")).collect())
    found.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"])), r["doc_id"]))
    content = [tuple(b"\n".join(bytes(r["pieces"][k]) for r in found if r["good"] == c) for c in (0, 1)) for k in range(len(VIEWS))]
    if min(len(c) for pair in content for c in pair) < 8:
        return constant
    dictionaries = Dictionaries(content)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressors = dictionaries.compressors()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "good": batch["good"], "x": [differences(t, compressors) for t in batch["text"]]})

    measured = (rows.where("not fills").select("doc_id", "good", "text").mapInPandas(measure, "doc_id long, good int, x array<double>")
                .groupBy("doc_id", "good").agg(F.min("x").alias("x")).orderBy("doc_id").collect())
    good = np.array([r["good"] for r in measured], np.float64)
    if len(set(good)) < 2:
        return constant
    weight = np.where(good > 0, counts[1] / good.sum(), counts[0] / (1 - good).sum()) * len(good) / (counts[0] + counts[1])
    return Model(dictionaries, calibrate(np.array([r["x"] for r in measured]), good, weight))


def score_column(spark: SparkSession, model: Model, column: str = "text"):
    """A column of scores in 0 to 1; dictionaries are broadcast (at most 2 * 80 KB)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        compressors = model.dictionaries.compressors() if model.dictionaries else None
        for texts in batches:
            x = np.array([differences(t, compressors) if compressors else [0.0] * len(VIEWS) for t in texts], np.float64).reshape(len(texts), len(VIEWS))
            yield pd.Series(model.score(x))

    return score(F.col(column))


@query("op13_compression_quality")
def op13_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(remainder("doc_id", 4) != 2)
    model = train(docs, labels)
    scored = docs.select("doc_id", (F.coalesce(remainder("doc_id", 4), F.lit(0)) == 2).alias("held_out"), score_column(spark, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
