"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document's set is the distinct hashes (64 bits) of its word shingles; texts with equal sets form a class, and only the
class's smallest doc_id goes on. All hashes have one global order, rare first: by a count table of 2**SKETCH_BITS slots over
the whole corpus (2 MB, whatever the corpus), then by the hash. Two sets of similarity t share a hash among the first
n - ceil(2t/(1+t) n) + 1 of the smaller and the first n - ceil(t n) + 1 of the larger, so only those are joined. Length and
positional filters apply in the join, the suffix filter (difference of set sizes within hash ranges, a lower bound of the
symmetric difference) before sets are fetched, and each pair left is verified once on the whole sets.

A group of thousands of near copies would emit its square. So the join runs in two passes. The first pairs each row only
with its hash's central member (the one with the fewest rarer hashes) and forms components. The second, exact, pass joins
everything that is left: pairs that share a prefix hash but lie in different components. Pairs inside a component are
already connected, so no component differs from that of the full join. Where only components are asked for, that is all.

Links between different texts all lie within a component. near_counts and near_links therefore compare every two classes of
a component on their whole sets: a component of more than BLOCK classes is cut into blocks, and every pair of blocks is a
work item of its own. near_links gives the linked pairs of classes; near_counts the number of links per document, weighted by
class sizes, for which no pair ever leaves its item.

Defined cases: n_links is the number of other documents a document is linked with, exact copies included; a doc_id with several
texts has the sum of theirs. A null, empty or wordless text has an empty set and is linked with nothing; a text with fewer words than a
shingle is one shingle. Rows repeated under one doc_id are one node: links of any of them count for it. A row with a null
doc_id takes the component of documents with an equal set, if any, and is linked with nothing else. Ties are decided by
doc_id. Repeated rows cost a row each in the first two passes over the texts and nothing in the joins. Hash collisions within a pair of texts are the only error possible (below 1e-7 for texts of a million words).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import WordHashes, components, mix, plain_words, shingle_hashes, small_batches, table
from starloom.llm.registry import query
from starloom.session import fits_broadcast, materialize

SKETCH_BITS = 18
RANGES = 256                                            # hash ranges of the suffix filter
BLOCK = 256                                             # classes of a component that are compared at once
ITEM_ROWS = 1024                                        # rows of a work group: many small components, or two blocks of a large one


@dataclass(frozen=True)
class Likeness:
    """Two sets link when 100 * intersection >= percent * union; shingles have size words."""

    size: int
    percent: int

    def least_overlap(self, n: Column, m: Column) -> Column:
        return F.ceil(F.lit(self.percent) * (n + m) / F.lit(100.0 + self.percent) - F.lit(1e-9))

    def prefixes(self, n: int) -> tuple[int, int]:
        """(probe, index) prefix lengths of a set of n; 0 where only an equal set could link."""
        index = n + -(-2 * self.percent * n // (100 + self.percent)) * -1 + 1
        if not n or (index == 1 and 100 * n // self.percent == n and -(-2 * self.percent * n // (100 + self.percent)) == n):
            return 0, 0
        return n - -(-self.percent * n // 100) + 1, index


def _sets(batch: pa.RecordBatch, words: WordHashes, size: int) -> Iterator[np.ndarray]:
    for text in batch.column(1).cast(pa.binary()).to_pylist():
        yield shingle_hashes(words.of(plain_words(text)), size)


def count_table(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents' hashes fall in each of 2**SKETCH_BITS slots, over the whole table. Fixed size on the driver."""
    width = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = WordHashes(), np.zeros(width, np.int64)
        for batch in batches:
            for hashes in _sets(batch, words, size):
                np.add.at(total, (hashes & np.uint64(width - 1)).astype(np.int64), 1)
        slots = np.flatnonzero(total)
        for k in range(0, len(slots), 1 << 15):
            some = slots[k:k + (1 << 15)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["slot", "n"])

    found = docs.select("doc_id", "text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    table_ = np.zeros(width, np.int64)
    table_[found["slot"].to_numpy()] = found["n"].to_numpy()
    return table_


def signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, n, set_key (128 bits of the set), prefix (rare first, probe length), indexed (index length), ranges."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(count_table(docs, like.size))
    schema = T.StructType([*docs.select("doc_id").schema.fields, *T.StructType.fromDDL(
        "n_shingles long, set_key binary, prefix array<long>, indexed int, ranges binary").fields])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = WordHashes(), shared.value
        mask = np.uint64(len(counts) - 1)
        for batch in batches:
            n, key, prefix, indexed, ranges = [], [], [], [], []
            for hashes in _sets(batch, words, like.size):
                probe, index = like.prefixes(len(hashes))
                n.append(len(hashes))
                key.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                first = np.lexsort((hashes, counts[(hashes & mask).astype(np.int64)]))[:probe] if probe else slice(0)
                prefix.append(hashes[first].view(np.int64))
                indexed.append(index)
                ranges.append(np.minimum(np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(indexed, pa.int32()), pa.array(ranges, pa.binary())], names=[f.name for f in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(sign, schema)


def _positional(like: Likeness, a: str, b: str) -> Column:
    """Length and positional filter for a pair that shares a hash at these positions."""
    n, m, i, j = F.col(f"{a}_n"), F.col(f"{b}_n"), F.col(f"{a}_pos"), F.col(f"{b}_pos")
    return ((100 * F.least(n, m) >= like.percent * F.greatest(n, m))
            & (1 + F.least(n - 1 - i, m - 1 - j) >= like.least_overlap(n, m)))


@F.pandas_udf(T.LongType())
def _difference(a: pd.Series, b: pd.Series) -> pd.Series:
    """Sum over hash ranges of the difference of counts: never more than the size of the symmetric difference."""
    if not len(a):
        return pd.Series([], dtype="int64")
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), RANGES).astype(np.int64) for s in (a, b))
    return pd.Series(np.abs(x - y).sum(axis=1))


@F.pandas_udf(T.LongType())
def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a, b)], dtype="int64")


def _links(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, like: Likeness, label: str) -> DataFrame:
    """The pairs (a, a_n, b, b_n), each once, that link. Only sets of texts in pairs that pass the suffix filter move."""
    size = lambda side: nodes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"{side}_n"), F.col("ranges").alias(f"{side}_ranges"))
    pairs = pairs.select("a", "a_n", "b", "b_n").distinct()
    pairs = pairs.join(size("a"), ["a", "a_n"]).join(size("b"), ["b", "b_n"])
    least = like.least_overlap(F.col("a_n"), F.col("b_n"))
    pairs = materialize(pairs.where(_difference("a_ranges", "b_ranges") <= F.col("a_n") + F.col("b_n") - 2 * least)
                        .select("a", "a_n", "b", "b_n"), f"{label}-pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    wanted = materialize(wanted, f"{label}-wanted")
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted      # beyond the checked size a shuffled join
    schema = T.StructType([*docs.select("doc_id").schema.fields, *T.StructType.fromDDL("n long, set_key binary, members binary").fields])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            rows = {}
            for k, (doc, found) in enumerate(zip(batch.column(0).to_pylist(), _sets(batch, words, like.size))):
                if len(found):
                    rows.setdefault((doc, xxhash.xxh3_128_digest(found.tobytes())), (k, found))
            at, keys, sets = [k for k, _ in rows.values()], [key for _, key in rows], [s for _, s in rows.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "n", "set_key", "members"])

    # Repeated rows give one set: a pair is verified once however often its documents are repeated
    sets = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(members, schema)
    sets = materialize(sets.dropDuplicates(["doc_id", "set_key"]).select("doc_id", "n", "members"), f"{label}-sets")
    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("n").alias(f"{name}_n"), F.col("members").alias(f"{name}_set"))
    both = pairs.join(side("a"), ["a", "a_n"]).join(side("b"), ["b", "b_n"])
    common = both.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("sum"), _overlap("a_set", "b_set").alias("common"))
    return materialize(common.where(f"100 * common >= {like.percent} * (sum - common)").select("a", "b").distinct(), f"{label}-links")


def _placed(docs: DataFrame, like: Likeness) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, set_key, component_id."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    signed = materialize(signatures(docs, like).withColumn("row", F.monotonically_increasing_id()), "signatures")
    # The first row of a class's smallest doc_id stands for the class, so repeated rows add nothing to the joins
    classes = (signed.where("set_key is not null and doc_id is not null").groupBy("set_key", "n_shingles").agg(F.min(F.struct("doc_id", "row")).alias("lead"))
               .select("set_key", "n_shingles", F.col("lead.doc_id").alias("node"), F.col("lead.row").alias("lead")))
    members = materialize(signed.select("doc_id", "n_shingles", "set_key", "row", "prefix", "indexed", "ranges")
                          .join(classes, ["set_key", "n_shingles"], "left"), "members")
    nodes = members.where("row = lead").select("node", "n_shingles", "prefix", "indexed", "ranges")
    sizes = nodes.select("node", "n_shingles", "ranges")

    rows = nodes.select("node", F.col("n_shingles").cast("int").alias("n"), "indexed", F.posexplode("prefix").alias("pos", "hash"))
    central = (rows.where("pos < indexed").groupBy("hash").agg(F.min(F.struct("pos", "n", "node")).alias("hub")))
    shared = materialize(rows.join(central, "hash").where("node <> hub.node or n <> hub.n")
                         .select("hash", "node", "n", "pos", "indexed", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.pos").alias("hub_pos")), "shared")
    near = (shared.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos"),
                          F.col("hub").alias("b"), F.col("hub_n").alias("b_n"), F.col("hub_pos").alias("b_pos"))
            .where(_positional(like, "a", "b") & (F.col("a") != F.col("b"))))
    # A doc_id repeated with other texts is one node: its classes are linked
    several = (members.where("node is not null and doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high"))
               .where("a <> high").select("doc_id", "a"))
    repeated = members.join(several, "doc_id").select("a", F.col("node").alias("b")).where("a <> b").distinct()
    first = components(_links(near, docs, sizes, like, "central").unionByName(repeated), "central")

    # Second pass: hashes whose rows still lie in several components, joined by hash and band of lengths
    named = lambda df, key, as_: df.join(first.select(F.col("id").alias(key), F.col("component").alias(as_)), key, "left").withColumn(as_, F.coalesce(as_, key))
    every = shared.select("hash", "node", "n", "pos", "indexed").unionByName(
        shared.select("hash", F.col("hub").alias("node"), F.col("hub_n").alias("n"), F.col("hub_pos").alias("pos"), (F.col("hub_pos") + 1).alias("indexed")).distinct())
    every = named(every, "node", "part")
    open_ = every.groupBy("hash").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("hash")
    every = materialize(every.join(open_, "hash"), "open")
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / like.percent)))).cast("int")
    small = every.where("pos < indexed").select("hash", band.alias("band"), F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos"), F.col("part").alias("a_part"))
    large = every.select("hash", F.explode(F.array(band, band - 1, band - 2)).alias("band"), F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("pos").alias("b_pos"), F.col("part").alias("b_part"))
    rest = (small.join(large, ["hash", "band"]).where("a_part <> b_part and (a_n < b_n or (a_n = b_n and a < b) or (a_n = b_n and b_pos >= 0 and a > b))")
            .where(_positional(like, "a", "b")))
    rest = rest.select(*(F.when((F.col("a_n") == F.col("b_n")) & (F.col("a") > F.col("b")), F.col(y)).otherwise(F.col(x)).alias(x)
                         for x, y in (("a", "b"), ("a_n", "b_n"), ("b", "a"), ("b_n", "a_n"))))
    late = named(named(_links(rest, docs, sizes, like, "rest"), "a", "a_part"), "b", "b_part")
    second = components(late.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")), "rest")

    placed = named(members.select("doc_id", "n_shingles", "set_key", "node"), "node", "part")
    placed = placed.join(second.select(F.col("id").alias("part"), F.col("component").alias("last")), "part", "left")
    return placed.select("doc_id", "n_shingles", "set_key", F.coalesce("last", "part", "doc_id").alias("component_id"))


def near_components(docs: DataFrame, like: Likeness) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id."""
    return _placed(docs, like).select("doc_id", "n_shingles", "component_id")


def _classes(placed: DataFrame) -> DataFrame:
    """set_key, node (its smallest doc_id), size (its doc_ids), component of the classes with a doc_id."""
    return (placed.where("set_key is not null and doc_id is not null").groupBy("set_key")
            .agg(F.min("doc_id").alias("node"), F.count_distinct("doc_id").alias("size"), F.min("component_id").alias("component")))


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many hashes every two sets share, from products of slices of their incidence matrix."""
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.flatnonzero(times > 1)
    place = np.full(len(times), -1, np.int64)
    place[shared] = np.arange(len(shared))
    at = place[at]
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    for low in range(0, len(shared), width):
        cut = slice(*np.searchsorted(at, [low, low + width]))
        some = np.zeros((len(sets), width), np.float32)
        some[row[cut], at[cut] - low] = 1
        common += (some @ some.T).astype(np.int64)
    np.fill_diagonal(common, [len(s) for s in sets])
    return common


def _compared(docs: DataFrame, classes: DataFrame, like: Likeness, block: int, pairs: bool) -> DataFrame:
    """All classes of a component against each other: (a, b) of set_keys that link, each once, or (set_key, others) in parts."""
    spark = docs.sparkSession
    parts = classes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component", F.ceil(F.col("n") / block).cast("int").alias("blocks"), "n")
    todo = materialize(classes.join(parts, "component").withColumn("block", F.pmod(F.xxhash64("set_key", F.lit("block")), "blocks").cast("int")), "compared")
    rows = todo.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    groups = max(1, -(-rows // ITEM_ROWS), 2 * spark.sparkContext.defaultParallelism)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sets = [s.tobytes() for s in _sets(batch, words, like.size)]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) if s else None for s in sets], pa.binary()), pa.array(sets, pa.binary())], names=["set_key", "members"])

    wanted = todo.select(F.col("node").alias("doc_id")).distinct()
    sets = docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(members, "set_key binary, members binary")
    sets = sets.where("set_key is not null").groupBy("set_key").agg(F.first("members").alias("members"))
    work = todo.join(sets, "set_key").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = work.select("set_key", "size", "members", "block", F.xxhash64("component", F.least("block", "with"), F.greatest("block", "with")).alias("item"),
                       F.struct("component", F.least("block", "with"), F.greatest("block", "with")).cast("string").alias("key"), (F.col("with") == F.col("block")).alias("alone"))

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in batch.groupby("key"):
            keys, size, block_, alone = (part[c].to_numpy() for c in ("set_key", "size", "block", "alone"))
            held = [np.frombuffer(m, np.uint64) for m in part["members"]]
            n = np.fromiter(map(len, held), np.int64, len(held))
            common = overlaps(held)
            i, j = np.nonzero(np.triu((100 + like.percent) * common >= like.percent * (n[:, None] + n[None, :]), 1))
            # both in one block only in that block's own item
            right = (block_[i] != block_[j]) | alone[i]
            i, j = i[right], j[right]
            if pairs:
                out.append(pd.DataFrame({"a": keys[i], "b": keys[j]}))
            else:
                others = np.bincount(i, size[j], len(keys)) + np.bincount(j, size[i], len(keys))
                out.append(pd.DataFrame({"set_key": keys, "others": others.astype(np.int64)}))
        return pd.concat(out)

    return work.withColumn("group", F.pmod("item", F.lit(groups))).groupBy("group").applyInPandas(compare, "a binary, b binary" if pairs else "set_key binary, others long")


def near_counts(docs: DataFrame, like: Likeness, block: int = BLOCK) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, n_links."""
    docs = docs.select("doc_id", "text")
    placed = materialize(_placed(docs, like), "placed")
    classes = materialize(_classes(placed), "classes")
    others = _compared(docs, classes, like, block, False).groupBy("set_key").agg(F.sum("others").alias("others"))
    counted = classes.join(others, "set_key", "left").select("set_key", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    own = (placed.where("doc_id is not null and set_key is not null").select("doc_id", "set_key").distinct().join(counted, "set_key")
           .groupBy("doc_id").agg(F.sum("links").alias("n_links")))
    return placed.join(own, "doc_id", "left").select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_links(docs: DataFrame, like: Likeness, block: int = BLOCK) -> DataFrame:
    """Every linked pair of different texts, once: (a, b), the smallest doc_ids of their classes, a <= b."""
    docs = docs.select("doc_id", "text")
    classes = materialize(_classes(_placed(docs, like)), "classes")
    node = lambda side: classes.select(F.col("set_key").alias(side), F.col("node").alias(f"{side}_node"))
    found = _compared(docs, classes, like, block, True).join(node("a"), "a").join(node("b"), "b")
    return found.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))


def set_key_column(like: Likeness, column: str = "text") -> Column:
    """The 128-bit key of a text's set; null for an empty set."""
    @F.pandas_udf(T.BinaryType())
    def key(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = WordHashes()
        for texts in batches:
            sets = [shingle_hashes(words.of(plain_words(t.encode() if t else None)), like.size) for t in texts]
            yield pd.Series([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], dtype=object)

    return key(F.col(column))


def one_of_each(docs: DataFrame, like: Likeness) -> DataFrame:
    """Exactly one row of docs (doc_id, text, ..) for each component, with all its columns as they came.

    That is the row of the smallest doc_id. Rows repeated under one doc_id are one document: the one with the smallest text
    stays (any of those with equal texts; a null text only where there is no other). A row with a null doc_id goes if a document
    with an id has an equal set; of the others with equal sets one stays, and all whose set is empty.
    """
    columns = docs.columns
    placed = materialize(_placed(docs, like).select("doc_id", "set_key", "component_id"), "placed")
    per_id = materialize(placed.where("doc_id is not null").groupBy("doc_id")
                         .agg(F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("component_id")), "per-id")
    lost = materialize(per_id.where("rows > 1 or doc_id <> component_id").select("doc_id"), "lost")
    repeated = materialize(per_id.where("rows > 1 and doc_id = component_id").select("doc_id"), "repeated")
    single = docs.where("doc_id is not null").join(lost, "doc_id", "left_anti").select(*columns)
    first = (docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id")
             .agg(F.min_by(F.struct(*columns), F.struct(F.col("text").isNull(), "text")).alias("kept")).select("kept.*"))
    # Sets of rows without an id that no document with an id has; one row of each stays
    nameless = materialize(docs.where("doc_id is null").select(F.struct(*columns).alias("kept"), set_key_column(like).alias("set_key")), "nameless")
    named = placed.where("doc_id is not null and set_key is not null").select("set_key")
    alone = nameless.where("set_key is not null").join(named, "set_key", "left_anti").groupBy("set_key").agg(F.first("kept").alias("kept"))
    rest = alone.select("kept.*").unionByName(nameless.where("set_key is null").select("kept.*"))
    return single.unionByName(first).unionByName(rest)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of near copies (five words, 0.8), as one_of_each says."""
    return one_of_each(docs, Likeness(5, 80))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
  lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS id, doc_id AS low FROM documents UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(low) FROM r WHERE id = doc_id) AS component_id FROM s"""


@query("op4_ngram_jaccard_join", SQL)
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three words and 90 of 100, as the contract says."""
    return near_components(table(spark, sf_dir, "documents", "doc_id", "text"), Likeness(3, 90))


LINKS_SQL = SQL.replace("AS component_id FROM s", "AS component_id, (SELECT count(*) FROM l WHERE a = doc_id) AS n_links FROM s")


@query("op4_ngram_links", LINKS_SQL)
def op4_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with the number of links of each document."""
    return near_counts(table(spark, sf_dir, "documents", "doc_id", "text"), Likeness(3, 90))
