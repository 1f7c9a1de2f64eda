"""Chat formatting by quotation linking: nested quotes are parsed, linked to the messages they repeat, and taken out.

A line's quote level is the number of `>` it begins with. Runs of lines of one level are unwrapped and cut into sentences;
a sentence, normalised to lower-case letters and digits with single spaces, is a passage and known by its 64-bit hash. A
quoted passage belongs to the nearest earlier message of its conversation that wrote it itself. A message replies to the
one that most passages of its lowest linked level point to (of equals, the latest); without a link, to the message before.
Conversations are then laid out in reply order: each message is followed by its replies, oldest first.

Both steps that could gather a conversation in one task do not: nearest earlier messages come from a range-split scan, the
reply order from list ranking by pointer doubling, log2(messages) joins on unique keys.

Defined cases: a null text is the empty text; a text without quotes stays as it is; a text of quotes only becomes empty.
Messages are numbered by turn (null first), rows repeated under one turn in order of role and text. A null conv_id makes each of its
rows a conversation of its own. Quotes of nothing earlier in the conversation are taken out and link nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import small_batches, table
from starloom.llm.registry import query
from starloom.operators.ranges import keyed_scan
from starloom.session import materialize

_MARKS = re.compile(r"^[ \t]?(?:>[ \t]?)+")
_ATTRIBUTION = re.compile(r"^.{0,200}\b(?:wrote|writes|said|schrieb|a écrit|escribió) ?:\s*$", re.IGNORECASE)
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
_OTHER = re.compile(r"[\W_]+")


def passages(text: str) -> list[int]:
    """Hashes (signed 64 bits) of the sentences of unwrapped text."""
    plain = (_OTHER.sub(" ", s.lower()).strip() for s in _SENTENCE_END.split(text))
    return [(h ^ (1 << 63)) - (1 << 63) for h in (xxhash.xxh3_64_intdigest(p) for p in plain if p)]


def parse(text: str | None) -> tuple[str, list[int], list[tuple[int, int]]]:
    """(text without quotes, its own passages, quoted passages with their levels)."""
    lines = []
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        lines.append((marks[0].count(">"), line[marks.end():]) if marks else (0, line))
    if not any(level for level, _ in lines):
        return text or "", _own(text or ""), []
    quoted = [(level, h) for level, run in groupby(lines, key=lambda x: x[0]) if level for h in passages(" ".join(x for _, x in run))]
    # the line that introduces a quote ("... wrote:") goes with it
    kept = [line for k, (level, line) in enumerate(lines) if not level and not (_ATTRIBUTION.match(line) and any(x for x, _ in lines[k + 1:k + 3]))]
    clean = re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip("\n")
    return clean, _own(clean), quoted


def _own(text: str) -> list[int]:
    return [h for part in re.split(r"\n[ \t]*\n", text) for h in passages(part.replace("\n", " "))]


def parsed_messages(messages: DataFrame) -> DataFrame:
    """messages (conv_id, turn, role, text) with clean, own, quoted. No shuffle."""
    schema = T.StructType([*messages.schema.fields, *T.StructType.fromDDL("clean string, own array<long>, quoted array<struct<level: int, hash: bigint>>").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            clean, own, quoted = zip(*map(parse, batch["text"])) if len(batch) else ((), (), ())
            yield batch.assign(clean=list(clean), own=list(own), quoted=[[{"level": a, "hash": b} for a, b in q] for q in quoted])

    return messages.mapInPandas(run, schema)


def reply_targets(numbered: DataFrame) -> DataFrame:
    """conv_id, n, target, linked: the message each quoting message replies to, where any of its passages is found."""
    quotes = numbered.where(F.size("quoted") > 0).select("conv_id", "n", F.posexplode("quoted").alias("at", "q")).select("conv_id", "n", "at", F.col("q.level").alias("level"), F.col("q.hash").alias("hash"))
    asked = quotes.select("conv_id", "hash").distinct()
    written = numbered.select("conv_id", "n", F.explode("own").alias("hash")).join(asked, ["conv_id", "hash"], "left_semi").distinct()
    line = (quotes.select("conv_id", "hash", "n", F.lit(0).alias("kind"), "at", "level", F.lit(None).cast("long").alias("source"))
            .unionByName(written.select("conv_id", "hash", "n", F.lit(1).alias("kind"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("level"), F.col("n").alias("source"))))
    found = keyed_scan(line, ["conv_id", "hash"], ["n", "kind", "at"], carried={"target": "source"}).where("kind = 0 and target is not null")
    return (found.groupBy("conv_id", "n", "level", "target").agg(F.count(F.lit(1)).alias("hits"))
            .groupBy("conv_id", "n").agg(F.max(F.struct(-F.col("level"), "hits", "target")).alias("best"), F.sum("hits").alias("linked"))
            .select("conv_id", "n", F.col("best.target").alias("target"), "linked"))


def reply_order(replies: DataFrame) -> DataFrame:
    """conv_id, n, place: preorder of the reply tree. replies: conv_id, n (1, 2, .. per conversation), parent (0 for the first)."""
    first = replies.groupBy("conv_id", F.col("parent").alias("n")).agg(F.min("n").alias("child"))
    sibling = keyed_scan(replies.select("conv_id", "parent", "n"), ["conv_id", "parent"], ["n"], following={"sibling": "n"}).select("conv_id", "n", "sibling")
    tree = replies.join(sibling, ["conv_id", "n"]).join(first, ["conv_id", "n"], "left")
    down = F.struct((2 * F.col("n")).alias("arc"), F.coalesce(2 * F.col("child"), 2 * F.col("n") + 1).alias("next"), F.lit(1).cast("long").alias("weight"))
    up = F.struct((2 * F.col("n") + 1).alias("arc"), F.coalesce(2 * F.col("sibling"), F.when(F.col("parent") > 0, 2 * F.col("parent") + 1)).alias("next"), F.lit(0).cast("long").alias("weight"))
    arcs = materialize(tree.select("conv_id", F.explode(F.array(down, up)).alias("a")).select("conv_id", "a.*"), "arcs")
    while arcs.where("next is not null").limit(1).count():
        ahead = arcs.select("conv_id", F.col("arc").alias("next"), F.col("next").alias("after"), F.col("weight").alias("more"))
        arcs = materialize(arcs.join(ahead, ["conv_id", "next"], "left").select("conv_id", "arc", F.col("after").alias("next"), (F.col("weight") + F.coalesce("more", F.lit(0))).alias("weight")), "arcs")
    ranked = arcs.where("arc % 2 = 0").select("conv_id", (F.col("arc") / 2).cast("long").alias("n"), "weight")
    total = replies.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total"))
    return ranked.join(total, "conv_id").select("conv_id", "n", (F.col("total") - F.col("weight") + 1).alias("place"))


def formatted_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, reply_to (turn), place, n_quoted, n_linked; one row per message."""
    small_batches(messages.sparkSession, 2048)
    messages = messages.select("conv_id", "turn", "role", "text")
    parsed = parsed_messages(messages.where("conv_id is not null")).withColumns({
        "order": F.coalesce("turn", F.lit(-(1 << 63))), "who": F.coalesce("role", F.lit("")), "said": F.xxhash64("text"), "one": F.lit(1).cast("long"), "row": F.monotonically_increasing_id()})
    parsed = materialize(parsed.drop("text"), "parsed")
    numbers = keyed_scan(parsed.select("conv_id", "order", "who", "said", "row", "one"), ["conv_id"], ["order", "who", "said", "row"], running={"n": "one"}).select("row", "n")
    numbered = materialize(parsed.join(numbers, "row").select("conv_id", "n", "turn", "role", "clean", "own", "quoted"), "numbered")
    targets = materialize(reply_targets(numbered), "targets")
    replies = numbered.select("conv_id", "n").join(targets, ["conv_id", "n"], "left").select("conv_id", "n", F.coalesce("target", F.col("n") - 1).alias("parent"), "linked")
    # Where every message follows the one before, the order of turns is the reply order
    branching = replies.where("parent <> n - 1").select("conv_id").distinct()
    places = reply_order(replies.join(branching, "conv_id", "left_semi").select("conv_id", "n", "parent"))
    named = numbered.select("conv_id", F.col("n").alias("parent"), F.col("turn").alias("reply_to"))
    done = (numbered.join(replies, ["conv_id", "n"]).join(places, ["conv_id", "n"], "left").join(named, ["conv_id", "parent"], "left")
            .select("conv_id", "turn", "role", F.col("clean").alias("text"), "reply_to", F.coalesce("place", "n").alias("place"),
                    F.size("quoted").alias("n_quoted"), F.coalesce("linked", F.lit(0)).alias("n_linked")))
    alone = parsed_messages(messages.where("conv_id is null")).select(
        "conv_id", "turn", "role", F.col("clean").alias("text"), F.lit(None).cast(messages.schema["turn"].dataType).alias("reply_to"), F.lit(1).cast("long").alias("place"),
        F.size("quoted").alias("n_quoted"), F.lit(0).cast("long").alias("n_linked"))
    return done.unionByName(alone)


@query("op7_quotation_linking")
def op7_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted_conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
