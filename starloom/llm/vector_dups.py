"""Embedding near-duplicates: random-hyperplane signs in several tables, exact cosine, distributed components.

Vectors with the same label and the same bits are one class, known by its smallest vec_id. Each class gets, per table, the
signs of its projections on a table's hyperplanes (drawn from a fixed seed). Classes that agree on label and signs in some
table meet in a bucket, where the exact cosine (double precision) of all of them is taken block by block; a pair is emitted
only if it links, and only in the first table where it meets. Hyperplanes per table grow with the table (about EXPECTED
vectors a bucket), and tables are added until a pair exactly at the threshold meets with probability RECALL.

A bucket of any size is worked whole: beyond BLOCK rows it is cut into blocks, and every pair of blocks is a work item of
its own, so no task holds more than two blocks of a bucket.

Defined cases: a vector that is null, empty, zero or holds nulls, NaN or infinities, or whose label is null, links with
nothing and is its own component. Vectors of different lengths never link. Identical rows are one vector, returned as often
as they occur; a vec_id with several vectors links by each of them, and its rows share the smallest component of any. A null
vec_id is left as it is: component null, no links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import components, small_batches, table
from starloom.llm.registry import query
from starloom.session import materialize

THRESHOLD = 0.93
RECALL = 0.999
EXPECTED = 16                # vectors that meet by chance in a bucket
BLOCK = 1024
ITEM_ROWS = 16_384           # rows of a work group: many small buckets, or two blocks of a large one


def plan(vectors: int, labels: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(tables, bits): from the number of vectors per label, whatever the data look like."""
    bits = min(24, max(6, round(math.log2(max(2.0, vectors / max(1, labels) / EXPECTED)))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - RECALL) / math.log(1 - meet)), bits


def hyperplanes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, tables * bits))


def signs(vectors: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """One integer of bits signs per vector and table."""
    up = (vectors @ hyperplanes(vectors.shape[1], tables, bits) >= 0).reshape(len(vectors), tables, bits)
    return up @ (1 << np.arange(bits, dtype=np.int64))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, vector (little-endian doubles) of the rows that can link at all."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out, dims = [], [], []
            for k, v in enumerate(batch.column(2).to_pylist()):
                if not v or None in v:
                    continue
                v = np.array(v, "<f8") + 0.0                       # -0.0 and 0.0 are one value
                if np.isfinite(v).all() and v.any():
                    rows.append(k)
                    dims.append(len(v))
                    out.append(v.tobytes())
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                             names=["vec_id", "label", "dim", "vector"])

    schema = T.StructType([*vectors.select("vec_id", "label").schema.fields, *T.StructType.fromDDL("dim int, vector binary").fields])
    return vectors.where("vec_id is not null and label is not null and embedding is not null").select("vec_id", "label", "embedding").mapInArrow(pack, schema)


def unit(vectors: pd.Series, dim: int) -> np.ndarray:
    v = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)                   # no overflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def class_links(classes: DataFrame, tables: int, bits: int, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Each pair (a, b), a < b, of classes (node, label, dim, vector) that links and meets in some table, once."""
    spark = classes.sparkSession

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                found = signs(unit(part["vector"], dim), tables, bits)
                yield part.assign(signs=list(found))

    schema = T.StructType([*classes.schema.fields, *T.StructType.fromDDL("signs array<long>").fields])
    signed = materialize(classes.mapInPandas(sign, schema), "signed")
    met = signed.select("node", "label", "dim", "vector", "signs", F.posexplode("signs").alias("table", "bucket"))
    key = ["label", "dim", "table", "bucket"]
    sizes = met.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    met = met.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), "blocks").cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("node", "vector", "signs", "dim", "table", "block", F.xxhash64(*key, F.least("block", "with"), F.greatest("block", "with")).alias("item"),
                     (F.col("with") == F.col("block")).alias("alone"))
    rows = sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("blocks")), F.lit(0))).first()[0]
    groups = max(1, -(-rows // ITEM_ROWS), 2 * spark.sparkContext.defaultParallelism)

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in batch.groupby("item"):
            for dim, same in part.groupby("dim"):
                node, table_, own = same["node"].to_numpy(), same["table"].to_numpy(), np.stack(same["signs"].to_numpy())
                v = unit(same["vector"], dim)
                block_, alone = same["block"].to_numpy(), same["alone"].to_numpy()
                i, j = np.nonzero(np.triu(v @ v.T >= threshold, 1))
                # both in one block only in that block's own item; not met in an earlier table
                right = (block_[i] != block_[j]) | alone[i]
                i, j = i[right], j[right]
                equal = own[i] == own[j]
                first = equal.argmax(axis=1) == table_[i]
                out.append(np.stack([np.minimum(node[i[first]], node[j[first]]), np.maximum(node[i[first]], node[j[first]])], axis=1))
        pairs = np.concatenate(out) if out else np.empty((0, 2), np.int64)
        return pd.DataFrame(pairs, columns=["a", "b"])

    return (met.withColumn("group", F.pmod("item", F.lit(groups))).groupBy("group")
            .applyInPandas(compare, "a long, b long").where("a <> b").distinct())


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    vectors = vectors.select("vec_id", "embedding", "label")
    usable = materialize(usable_vectors(vectors).distinct(), "vectors")
    total, labels = usable.agg(F.count(F.lit(1)), F.countDistinct("label")).first()
    classes = usable.groupBy("label", "dim", "vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("size"))
    members = materialize(usable.join(classes, ["label", "dim", "vector"]).select("vec_id", "label", "node", "size", F.md5("vector").alias("bits")), "members")
    tables, bits = plan(total, labels, threshold)
    # a vec_id may lead several classes: classes are compared under their own number and brought back to vec_ids afterwards
    numbered = materialize(classes.withColumn("class", F.xxhash64("label", "vector")).select(F.col("class").alias("node"), "label", "dim", "vector", F.col("node").alias("vec_id"), "size"), "classes")
    links = materialize(class_links(numbered.select("node", "label", "dim", "vector"), tables, bits, threshold, block), "links")
    info = numbered.select(F.col("node").alias("class"), "vec_id", "size")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(info.select(F.col("class").alias("b"), "size"), "b").groupBy(F.col("a").alias("class")).agg(F.sum("size").alias("others"))
    counted = info.join(near, "class", "left").select("vec_id", "class", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    edges = (links.join(info.select(F.col("class").alias("a"), F.col("vec_id").alias("x")), "a").join(info.select(F.col("class").alias("b"), F.col("vec_id").alias("y")), "b")
             .select(F.col("x").alias("a"), F.col("y").alias("b")))
    copies = members.where("vec_id <> node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    parts = components(edges.unionByName(copies), "vectors")
    own = (usable.select("vec_id", F.xxhash64("label", "vector").alias("class")).join(counted.select("class", "links"), "class")
           .groupBy("vec_id").agg(F.sum("links").alias("n_links")))
    found = vectors.select("vec_id").join(own, "vec_id", "left").join(parts.select(F.col("id").alias("vec_id"), "component"), "vec_id", "left")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").cast("long").alias("component_id"),
                        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"))


SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
r AS (SELECT vec_id AS id, vec_id AS low FROM embeddings UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(low) AS component_id FROM r GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM l WHERE a = vec_id) AS n_links, component_id, component_id = vec_id AS kept FROM embeddings JOIN c ON id = vec_id"""


@query("op10_embedding_near_dedup", SQL)
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
