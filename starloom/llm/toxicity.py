"""Toxicity: logistic regression over hashed word n-grams and skip-grams, fitted by FTRL-proximal.

Features of a text are the distinct hashes of its words, word pairs and pairs that skip one word, in 2**BITS slots. FTRL
gives every slot its own learning rate and an L1 pull to exact zero, so a few thousand weights remain; they are broadcast
as one float32 table of 2**BITS slots (4 MB, whatever the corpus). Training is sequential by nature and takes a documented,
bounded sample of labelled rows (MAX_TRAIN_ROWS, the smallest hashes of the id); scoring covers every whole text.

Defined cases: a null or empty text, or one without words, has the score of the bias alone. A label row with a null id or
null label is not used; repeated label rows of one id count once, as toxic if any says so. A repeated document is scored
each time it occurs. With no label rows of one class, all scores are the (clipped) prior. Equal texts have equal scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import WordHashes, mix, remainder, small_batches, table
from starloom.llm.registry import query

BITS = 20
MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.7
_PART_ROWS = 1000
_LETTERS = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 4.0             # learning rate scale
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 0.01
    epochs: int = 5
    toxic_weight: float = 3.0      # a toxic row counts as so many clean ones

    def step(self, z, n):
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))


@dataclass(frozen=True)
class Weights:
    slots: np.ndarray              # the slots whose weight is not zero
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.slots] = self.values
        return out


def slots(text: str | None, words: WordHashes) -> np.ndarray:
    """The distinct feature slots of a text."""
    h = words.of(_LETTERS.findall(text.lower())) if text else np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        grams = [mix(h)]
        for gap, tag in ((1, 3), (2, 5)):
            if len(h) > gap:
                grams.append(mix(mix(h[:-gap] + np.uint64(tag)) * np.uint64(3) + h[gap:]))
    return np.unique((np.concatenate(grams) & np.uint64((1 << BITS) - 1)).astype(np.int32))


class Rows:
    """Training rows from (text, label) pairs, which are read once: the slots of _PART_ROWS rows are one array."""

    def __init__(self, pairs: Iterable[tuple[str | None, int]], words: WordHashes):
        self.labels, self.parts, self.ends, part = [], [], [], []
        for text, label in pairs:
            self.labels.append(int(label))
            part.append(slots(text, words))
            if len(part) == _PART_ROWS:
                self._close(part)
                part = []
        self._close(part)

    def _close(self, part: list[np.ndarray]) -> None:
        if part:
            self.parts.append(np.concatenate(part))
            self.ends.append(np.cumsum([0, *map(len, part)]))

    def __len__(self) -> int:
        return len(self.labels)

    def __getitem__(self, k: int) -> tuple[np.ndarray, int]:
        part, at = divmod(k, _PART_ROWS)
        ends = self.ends[part]
        return self.parts[part][ends[at]:ends[at + 1]], self.labels[k]


def fit(rows: Rows, how: Ftrl) -> Weights:
    """FTRL-proximal over rows of (slots, label), in a fixed shuffled order per epoch."""
    z, n, bz, bn = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0
    bias = lambda: -bz / ((how.beta + np.sqrt(bn)) / how.alpha)  # noqa: E731  the bias has no L1 pull
    order = np.random.default_rng(1)
    for _ in range(how.epochs):
        for k in order.permutation(len(rows)):
            at, label = rows[k]
            zi, ni, b = z[at], n[at], bias()
            w = how.step(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = (p - label) * (how.toxic_weight if label else 1.0)
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / how.alpha * w
            n[at] = ni + g * g
            bz += g - (np.sqrt(bn + g * g) - np.sqrt(bn)) / how.alpha * b
            bn += g * g
    w = how.step(z, n)
    kept = np.flatnonzero(w)
    return Weights(kept, w[kept].astype(np.float32), float(bias()))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, how: Ftrl = Ftrl()) -> Weights:
    """Fit on docs (doc_id, text) with labels (doc_id, toxic). Only the chosen, bounded sample of labels meets the texts."""
    spark = docs.sparkSession
    small_batches(spark)
    sample = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = (pair for batch in batches for pair in zip(batch["text"], (batch["toxic"] > 0).astype(int)))
        if len(seen := Rows(pairs, WordHashes())):
            w = fit(seen, how)
            yield pd.DataFrame({"slots": [w.slots], "weights": [w.values.astype(np.float64)], "bias": [w.bias]})

    # the one task gets the rows in order, a small batch at a time: it never holds the texts
    ordered = rows.repartition(1).sortWithinPartitions("doc_id", "text")
    found = ordered.mapInPandas(one, "slots array<long>, weights array<double>, bias double").collect()
    if not found:
        return Weights(np.empty(0, np.int64), np.empty(0, np.float32), 0.0)
    return Weights(np.array(found[0][0], np.int64), np.array(found[0][1], np.float32), found[0][2])


def score_column(spark: SparkSession, weights: Weights, column: str = "text"):
    """A column of scores in 0 to 1; only the text goes through Python."""
    shared = spark.sparkContext.broadcast((weights.slots, weights.values, weights.bias))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, words = Weights(*shared.value), WordHashes()
        w = model.dense()
        for texts in batches:
            raw = np.array([w[slots(t, words)].sum(dtype=np.float64) for t in texts], np.float64) + model.bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -35, 35))))

    return score(F.col(column))


def learn(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Weights:
    """Weights from the label rows outside the held-out third."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return train(docs, labels.where(remainder("doc_id", 3) != 1))


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents whose score stays below the threshold, with their columns as they came."""
    weights = learn(spark, docs, sf_dir)
    columns = docs.columns
    return docs.withColumn("_toxicity", score_column(spark, weights)).where(F.col("_toxicity") < THRESHOLD).select(*columns)


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    weights = learn(spark, docs, sf_dir)
    scored = docs.select("doc_id", (F.coalesce(remainder("doc_id", 3), F.lit(0)) == 1).alias("held_out"),
                         score_column(spark, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
