"""Document fingerprints: threshold-scaled sketches, built by DataFrame functions alone.

The sketch of a text holds every hash of its five-word shingles that lies below a fixed fraction of the hash space, so it
grows with the text, sketches of parts merge by union, and both resemblance and containment of very unequal documents can
be read from two of them. A hash is the first 12 hex digits of the shingle's MD5: SQL anywhere can compute it. A text none
of whose hashes is retained keeps its smallest one; in a merge with other sketches such a hash is dropped again
(`merge_sketches`). The fingerprint is the retained hashes in ascending order, written one after the other.

Defined cases: a null text is the empty text; no words, empty fingerprint; fewer words than a shingle, one shingle. Two empty
fingerprints are alike (1), an empty and another are not (0). A row with a null doc_id is nobody's next document and has
none (its text is edited with nothing, `near_next` is null). Rows of one doc_id follow each other in order of text. A single
document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import table
from starloom.llm.registry import query

SHINGLE_WORDS = 5
FRACTION = 1 / 8
HASH_DIGITS = 12
_SPACE = r"[\x20\x09-\x0D]+"


def _limit(fraction: float) -> str:
    return format(int(fraction * 16 ** HASH_DIGITS), f"0{HASH_DIGITS}x")


def add_sketch(df: DataFrame, text: str, name: str, fraction: float = FRACTION, words: int = SHINGLE_WORDS) -> DataFrame:
    """df with the sketch of a text column: an ascending array of hex hashes. One row in, one row out, no shuffle."""
    split = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), _SPACE), "")
    df = df.withColumn("_words", split)
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_words") - F.lit(words - 1), F.lit(1))),
                           lambda i: F.substring(F.md5(F.array_join(F.slice("_words", i, words), " ")), 1, HASH_DIGITS))
    df = df.withColumn("_hashes", F.when(F.size("_words") > 0, shingles).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(name, F.sort_array(F.array_distinct(F.filter("_hashes", lambda h: h < F.lit(_limit(fraction))))))
    least = F.when(F.size("_hashes") > 0, F.array(F.array_min("_hashes"))).otherwise(F.col(name))
    return df.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(least)).drop("_words", "_hashes")


def merge_sketches(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts together (shingles across their border aside)."""
    both = F.sort_array(F.array_union(a, b))
    low = F.filter(both, lambda h: h < F.lit(_limit(fraction)))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance: shared hashes over all hashes."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; an empty a is contained in anything."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def _bucket(ids: Column, starts: list) -> Column:
    """The place of the last start <= ids in an ascending list, by binary search over one array literal."""
    array = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(max(1, len(starts).bit_length())))
    first = F.struct(F.lit(0).alias("low"), F.lit(len(starts)).alias("high"))

    def halve(state, _):
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        right = (state["high"] - state["low"] > 1) & (F.element_at(array, middle + 1) <= ids)
        return F.struct(F.when(right, middle).otherwise(state["low"]).alias("low"),
                        F.when(right | (state["high"] - state["low"] <= 1), state["high"]).otherwise(middle).alias("high"))

    return F.aggregate(steps, first, halve, lambda state: state["low"])


def with_next(docs: DataFrame, *carried: str) -> DataFrame:
    """docs (doc_id, ..carried) with next_<column> of the following document by doc_id; the first follows the last.

    Only ids are range-partitioned to find where ranges start. Then every row goes once to its range, and the rows a range
    starts with also to the range before, so that each range finds all its neighbours by itself: one shuffle, no global sort.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = (docs.select("doc_id").where("doc_id is not null").repartitionByRange(ranges, "doc_id")
              .groupBy(F.spark_partition_id().alias("range")).agg(F.min("doc_id").alias("start")).collect())
    starts = sorted({r["start"] for r in starts}) or [0]
    bucket, last = _bucket(F.col("doc_id"), starts), len(starts) - 1
    place = lambda b, guest, after: F.struct(b.cast("int").alias("range"), F.lit(guest).alias("guest"), F.lit(after).alias("after"))
    array = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    rows = docs.withColumn("_range", F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64(*carried), F.lit(ranges)).cast("int")).otherwise(bucket))
    is_first = F.col("doc_id").isNotNull() & (F.element_at(array, F.greatest(F.col("_range"), F.lit(0)) + 1) == F.col("doc_id"))
    guest = F.when(F.col("_range") == 0, place(F.lit(last), True, True)).otherwise(place(F.col("_range") - 1, True, False))
    rows = rows.withColumn("_at", F.explode(F.when(is_first, F.array(place(F.col("_range"), False, False), guest)).otherwise(F.array(place(F.col("_range"), False, False)))))
    order = Window.partitionBy("_at.range").orderBy("_at.after", "doc_id", *carried)
    known = F.col("doc_id").isNotNull()
    rows = rows.select("*", *(F.when(known, F.lead(c).over(order)).alias(f"next_{c}") for c in carried))
    return rows.where(~F.col("_at.guest")).drop("_range", "_at")


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(F.coalesce(following, F.lit("")), F.lit(1), half))


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id, text), first_value(text) OVER (ORDER BY doc_id, text)) AS following FROM d),
e AS (SELECT *, CAST(floor(length(text) / 2) AS BIGINT) AS half FROM n),
t AS (SELECT doc_id, text, following, substring(text, 1, length(text) - half) || substring(following, 1, half) AS edited FROM e),
w AS (SELECT doc_id, text, edited, {', '.join(f"list_filter(string_split_regex({c}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS {c}_w" for c in ('text', 'edited', 'following'))} FROM t),
h AS (SELECT doc_id, text, edited, {', '.join(f"CASE WHEN len({c}_w) = 0 THEN [] ELSE list_transform(range(1, greatest(len({c}_w) - 3, 2)), lambda i: md5(array_to_string({c}_w[i:i + 4], ' '))[1:12]) END AS {c}_h" for c in ('text', 'edited', 'following'))} FROM w),
k AS (SELECT doc_id, text, edited, {', '.join(f"CASE WHEN len({c}_h) = 0 THEN [] WHEN list_min({c}_h) < '200000000000' THEN list_sort(list_distinct(list_filter({c}_h, lambda x: x < '200000000000'))) ELSE [list_min({c}_h)] END AS {c}_k" for c in ('text', 'edited', 'following'))} FROM h)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(text_k, '') AS fingerprint, array_to_string(edited_k, '') AS edited_fingerprint,
{', '.join(f"CASE WHEN len(text_k) + len({c}_k) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(text_k, {c}_k))::DOUBLE / (len(text_k) + len({c}_k) - len(list_intersect(text_k, {c}_k))) END AS {name}" for c, name in (('edited', 'near_edited'), ('following', 'near_next')))},
CASE WHEN len(text_k) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(text_k, edited_k))::DOUBLE / len(text_k) END AS kept_in_edited
FROM k"""


@query("op1_fingerprints", SQL)
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(add_sketch(docs, "text", "sketch"), "text", "sketch")
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch", edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    rows = add_sketch(rows, "edited", "edited_sketch")
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.array_join(own, "").alias("fingerprint"),
                       F.array_join(edited, "").alias("edited_fingerprint"), likeness(own, edited).alias("near_edited"),
                       F.when(following.isNotNull(), likeness(own, following)).alias("near_next"), containment(own, edited).alias("kept_in_edited"))
