"""Language ID by compression: a text is written in the language whose dictionary makes it smallest.

For each learned language a zstandard raw-content dictionary holds DICT_BYTES of normalised training text (a documented
bound): about SAMPLE_PER_LANGUAGE documents, drawn by a hash of doc_id, give a piece each from a hashed place in their text;
what short ones leave free, longer ones fill. A text is reduced to lower-case letters with their marks and single spaces,
cut into blocks of BLOCK bytes so that the dictionary counts all through a long text, and every block of the whole text is
compressed with every dictionary. Each block follows LEAD, a run of zeros, so that a text of a few words is compressed too
instead of being stored as it is.

The margin (second smallest size minus smallest, over the second) is the score. A text of n letters and marks is rejected
(`accepted` is false) where its margin is below MARGIN * n / (n + HALF_LETTERS) or 0: of few letters a small margin tells
more. The constants were chosen on held-out labelled documents; the README has the shares of wrong decisions.

Defined cases: a null text, or one without any letter, is `und` with score 0 and not accepted; so is every text when
nothing could be learned. Equal sizes go to the language with more training documents, then to the smaller name. Training
ignores null texts, null languages and texts without letters. Repeated rows are predicted each time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import remainder, small_batches, table
from starloom.llm.registry import query

DICT_BYTES = 64_000
SAMPLE_PER_LANGUAGE = 600        # training documents whose pieces fill a dictionary
PIECE_SHARES = 4                 # a sampled document gives at most this many equal shares of its dictionary
BLOCK = 1 << 14
LEAD = b"\0" * 64
MARGIN, HALF_LETTERS = 0.02, 100
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_OTHER_ASCII = re.compile("[^a-z]+")
_LETTER = regex.compile(r"\p{L}")
_LEVEL = dict(window_log=17, hash_log=15, chain_log=16, search_log=4, min_match=4, target_length=16,
              strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)


def normalised(text: str | None) -> str:
    """Lower-case letters with their marks, single spaces between; empty where there is no letter."""
    if not text:
        return ""
    found = (_OTHER_ASCII if text.isascii() else _OTHER).sub(" ", text.lower()).strip()
    return found if _LETTER.search(found) else ""


def least_margin(letters: int) -> float:
    return MARGIN * letters / (letters + HALF_LETTERS)


@dataclass(frozen=True)
class Dictionaries:
    content: dict[str, bytes]      # in order of preference between equal sizes

    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        out = {}
        for lang, content in self.content.items():
            level = zstandard.ZstdCompressionParameters(**_LEVEL)
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=level)
            out[lang] = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=level)
        return out


def classify(text: str | None, compressors: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float, bool]:
    """(language, margin, accepted) of one text."""
    plain = normalised(text)
    if not plain or not compressors:
        return "und", 0.0, False
    data = f" {plain} ".encode()
    sizes = [(sum(len(c.compress(LEAD + data[k:k + BLOCK])) for k in range(0, len(data), BLOCK)), place, lang)
             for place, (lang, c) in enumerate(compressors.items())]
    sizes.sort()
    if len(sizes) == 1:
        return sizes[0][2], 1.0, True
    lead = len(next(iter(compressors.values())).compress(LEAD)) * -(-len(data) // BLOCK)
    margin = min(1.0, (sizes[1][0] - sizes[0][0]) / max(1, sizes[1][0] - lead))
    return sizes[0][2], margin, margin > 0 and margin >= least_margin(len(plain) - plain.count(" "))


def piece(doc_id, text: str, size: int) -> bytes:
    """At most size characters of the normalised text, from a place that a hash of the document picks."""
    plain = normalised(text)
    at = xxhash.xxh3_64_intdigest(f"{doc_id}") % max(1, len(plain) - size + 1)
    return plain[at:at + size].encode()


def dealt(pieces: list[bytes], room: int) -> bytes:
    """The pieces one after another, all cut to the same longest length, as long as together they fit in room bytes."""
    lengths = [len(p) + 1 for p in pieces]
    low, high = 0, max(lengths, default=0)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(min(n, middle) for n in lengths) <= room else (low, middle - 1)
    return b"".join(p[:low - 1] + b" " for p in pieces) if low > 1 else b""


def train(docs: DataFrame) -> Dictionaries:
    """Dictionaries from docs (doc_id, text, lang). One pass counts the languages; a second reads only the sample's texts."""
    spark = docs.sparkSession
    small_batches(spark)
    usable = docs.where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Dictionaries({})
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    share, size = F.lit(0.0), F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, SAMPLE_PER_LANGUAGE / n))).otherwise(share)
        size = F.when(F.col("lang") == lang, F.lit(PIECE_SHARES * DICT_BYTES // min(n, SAMPLE_PER_LANGUAGE))).otherwise(size)

    @F.pandas_udf("binary")
    def pieces(ids: pd.Series, texts: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([piece(i, t, n) for i, t, n in zip(ids, texts, sizes)], dtype=object)

    # Only pieces of a few hundred bytes move, a set of them per language
    sample = usable.where(draw < share).select("lang", pieces(F.col("doc_id").cast("string"), "text", size).alias("piece")).where("octet_length(piece) > 0")

    def fill(batch: pd.DataFrame) -> pd.DataFrame:
        every = sorted(map(bytes, set(batch["piece"])), key=xxhash.xxh3_64_intdigest)
        return pd.DataFrame({"lang": [batch["lang"].iloc[0]], "content": [dealt(every, DICT_BYTES)]})

    found = {r["lang"]: bytes(r["content"]) for r in sample.groupBy("lang").applyInPandas(fill, "lang string, content binary").collect()}
    order = sorted((lang for lang in found if len(found[lang]) >= 8), key=lambda lang: (-counts[lang], lang))
    return Dictionaries({lang: found[lang] for lang in order})


def language_column(spark: SparkSession, learned: Dictionaries, column: str = "text"):
    """A struct column (lang, margin, accepted); dictionaries are broadcast (DICT_BYTES a language)."""
    shared = spark.sparkContext.broadcast(learned.content)

    @F.pandas_udf("lang string, margin double, accepted boolean")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = Dictionaries(shared.value).compressors()
        for texts in batches:
            yield pd.DataFrame([classify(t, compressors) for t in texts], columns=["lang", "margin", "accepted"])

    return language(F.col(column))


def learn(docs: DataFrame) -> Dictionaries:
    """Dictionaries from the documents outside the held-out quarter."""
    return train(docs.select("doc_id", "text", "lang").where(F.coalesce(remainder("doc_id", 4), F.lit(0)) != 2))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents whose language is told apart with enough margin, with their columns as they came."""
    learned, columns = learn(docs), docs.columns
    return docs.withColumn("_language", language_column(spark, learned)).where("_language.accepted").select(*columns)


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learned = learn(docs)
    return (docs.select("doc_id", (F.coalesce(remainder("doc_id", 4), F.lit(0)) == 2).alias("held_out"),
                        language_column(spark, learned).alias("found"))
            .select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.margin").alias("score"),
                    F.col("found.accepted").alias("accepted")))
