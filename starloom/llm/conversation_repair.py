r"""Conversation structure repair: the cheapest edits that make the role initials `(s?(ua)+)?`, by depth-first branch-and-bound.

Rows of a conversation are taken by turn (nulls first), then role, then a digest of role and text. A row's first fault counts:
blank, duplicate of an earlier role and text, or truncated. Edits: Keep 0, Rerole 3, Delete 4 (required for blank and duplicate
rows), Insert an empty turn 3; a truncated row that stays adds 3. Of the cheapest repairs the one whose audit (the edits'
initials in order) is smallest wins; it fixes the repaired turns.

A search node is (rows done, what the output ends in, whether an Insert came last). The explicit stack yields Delete, Insert,
Keep, Rerole in this order, so of two equal costs the smaller audit reaches a node first. A node is left out if its dominance
table entry is no worse, or if its cost plus the suffix lower bound (each row's least cost, plus what disjoint clashing
neighbours must add) exceeds the incumbent (cost, audit) or ties it with a larger audit. The first incumbent comes from a greedy dive. Two
Inserts in a row, and a Delete right after an Insert, are never needed: deleting less, or deleting first, is cheaper or smaller.

A conversation may hold any share of all rows. Rows are placed by a range-split scan, cut into segments of SEGMENT
rows, and each segment is searched from every entry state to every exit state (equal segments of a worker once). The (cost,
audit) tables of FAN neighbours are joined level by level; this is exact, since equally cheap edits of the same rows never have
audits of which one begins the other. Repaired turns come from a stream sorted by conversation in which the audit precedes
the rows, so nothing but the audit (a letter a row) is held.

Defined cases: null roles and texts are one space; a null conv_id is a conversation of its own; turns may be null, repeat or
leave gaps; repeated rows are duplicates. An empty role has no initial. No rows: nothing returned for that conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import small_batches, table
from starloom.llm.registry import query
from starloom.operators.ranges import keyed_scan
from starloom.session import materialize

SEGMENT = 96
FAN = 16
TASK_ROWS = 100_000             # rows a task searches
_CACHE = 50_000
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
_BLANK = " \t\n\x0b\f\r"
# what the output ends in: nothing yet, a system turn, a user turn, an assistant turn
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_AFTER_KEEP = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_NEXT = (USER, USER, ASSISTANT, USER)                          # what a reroled or inserted turn becomes
_ROLE = {USER: "user", ASSISTANT: "assistant"}

# A row is one sign: its initial, one of s u a or o for any other; a capital if it is truncated; x if it must go.


def _least(sign: str) -> int:
    if sign == "x":
        return DELETE
    if sign in "oO":
        return min(REROLE + CUT * (sign == "O"), DELETE)
    return CUT if sign.isupper() else KEEP


def lower_bounds(signs: str) -> list[int]:
    """Per place, what the rows from there on cost at least, whatever came before."""
    n = len(signs)
    bound, staying = [0] * (n + 1), []                          # staying: (place, sign) of later rows that need not go, nearest last
    for i in range(n - 1, -1, -1):
        sign = signs[i]
        bound[i] = _least(sign) + bound[i + 1]
        if sign == "x":
            continue
        if staying and sign not in "oO":
            j, other = staying[-1]
            if other not in "oO" and (sign + other).lower() not in ("su", "ua", "au"):
                # the two can't both stay as they are next to each other; rows between them go anyway
                more = DELETE - CUT if (sign + other) != (sign + other).lower() else min(REROLE, INSERT)
                between = sum(map(_least, signs[i:j + 1]))
                bound[i] = max(bound[i], between + more + bound[j + 1])
        staying.append((i, sign))
    return bound


def greedy(signs: str, entry: int) -> tuple[int, str, int]:
    """(cost, audit, exit) of a quick dive."""
    cost, audit, state = 0, [], entry
    for sign in signs:
        low = sign.lower()
        if sign == "x":
            cost, step = cost + DELETE, "D"
        elif (low, state) in _AFTER_KEEP:
            cost, step, state = cost + KEEP + CUT * sign.isupper(), "K", _AFTER_KEEP[low, state]
        elif sign.isupper():
            cost, step = cost + DELETE, "D"
        else:
            cost, step, state = cost + REROLE, "R", _NEXT[state]
        audit.append(step)
    return cost, "".join(audit), state


def search(signs: str, entry: int, goal: int | None) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from state entry through all rows to state goal; None if nothing does.

    Without a goal the rows are the rest of the conversation: it may end, after an Insert where the last turn is a user's.
    """
    n, bound = len(signs), lower_bounds(signs)
    cost, audit, state = greedy(signs, entry)
    best = (cost, audit) if state == goal else None
    if goal is None:
        best = (cost + INSERT, audit + "I") if state == USER else (cost, audit) if state != SYSTEM else None
    seen: dict[tuple[int, int, bool], tuple[int, str]] = {}
    stack = [(0, entry, False, 0, "")]
    while stack:
        i, state, inserted, cost, audit = stack.pop()
        if best is not None and ((least := cost + bound[i]) > best[0] or least == best[0] and audit > best[1][:len(audit)]):
            continue
        node = (i, state, inserted)
        if node in seen and seen[node] <= (cost, audit):
            continue
        seen[node] = (cost, audit)
        if i == n:
            if goal is None and state == USER:
                state, cost, audit = ASSISTANT, cost + INSERT, audit + "I"
            if (state == goal or goal is None and state != SYSTEM) and (best is None or (cost, audit) < best):
                best = (cost, audit)
            continue
        sign = signs[i]
        low, cut = sign.lower(), CUT * (sign.isupper())
        if sign != "x":
            stack.append((i + 1, _NEXT[state], False, cost + REROLE + cut, audit + "R"))
            kept = _AFTER_KEEP.get((low, state))
            if kept is not None:
                stack.append((i + 1, kept, False, cost + KEEP + cut, audit + "K"))
            if not inserted:
                stack.append((i, _NEXT[state], True, cost + INSERT, audit + "I"))
        if not inserted:
            stack.append((i + 1, state, False, cost + DELETE, audit + "D"))
    return best


def segment_table(signs: str, first: bool, last: bool = False) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of every way through a segment; of a whole conversation only the best one."""
    if first and last:
        return [(NOTHING, ASSISTANT, *search(signs, NOTHING, None))]
    found = []
    for entry in ((NOTHING,) if first else range(4)):
        for goal in range(4):
            best = search(signs, entry, goal)
            if best:
                found.append((entry, goal, *best))
    return found


def joined(left: list[tuple], right: list[tuple]) -> list[tuple[int, int, int, str]]:
    """The table of two neighbouring stretches."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for entry, middle, cost, audit in left:
        for start, goal, more, rest in right:
            if start == middle:
                at, now = (entry, goal), (cost + more, audit + rest)
                if at not in best or now < best[at]:
                    best[at] = now
    return [(*at, *told) for at, told in best.items()]


def told_by(frame: DataFrame, tell) -> DataFrame:
    """conv_id, segment, told: the tables that tell gives for the columns of frame (conv_id, segment, ..) after conv_id."""
    schema = T.StructType([frame.schema["conv_id"], T.StructField("segment", T.LongType()), T.StructField("told", T.ArrayType(T.StructType([
        T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])))])
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[dict(zip(("entry", "exit", "cost", "audit"), r)) for r in rows] for rows in tell(*(c.to_pylist() for c in batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=schema.names)

    return frame.mapInArrow(run, schema)


def searched(cache: dict):
    """Tables by search, equal segments of a task once."""
    def tell(segments: list[int], signs: list[str], last: list[bool]) -> Iterator[list[tuple]]:
        for key in zip(signs, (s == 0 for s in segments), last):
            if key not in cache:
                if len(cache) >= _CACHE:
                    cache.clear()
                cache[key] = segment_table(*key)
            yield cache[key]

    return tell


def merged(segments: list[int], tables: list[list]) -> Iterator[list[tuple]]:
    for parts in tables:
        told = [[(r["entry"], r["exit"], r["cost"], r["audit"]) for r in part["told"]] for part in parts]
        whole = told[0]
        for part in told[1:]:
            whole = joined(whole, part)
        yield whole


def marked(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) stored with an id, a digest of role and text, the initial and what the text alone tells."""
    role, text = F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    rows = turns.select("conv_id", "turn", role, text)
    ends = F.substring(F.rtrim("text", F.lit(_BLANK)), -1, 1)
    initial = F.substring("role", 1, 1)
    return materialize(rows.select(
        "*", F.monotonically_increasing_id().alias("id"), F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), (ends == "").alias("blank"),
        ((ends != "") & ~ends.isin(".", "!", "?")).alias("cut")), "repair-turns")


def faults(stored: DataFrame) -> DataFrame:
    """Per row of marked turns its place in the conversation (upto, from 1), its fault (blank, duplicate, cut, or none of them) and the initial that follows."""
    narrow = stored.drop("text")
    firsts = narrow.groupBy("conv_id", "digest").agg(F.min_by("id", F.struct("turn", "id")).alias("id")).select("id", F.lit(True).alias("is_first"))
    told = narrow.join(firsts, "id", "left").withColumns({"duplicate": ~F.col("blank") & F.col("is_first").isNull(), "one": F.lit(1)})
    told = told.withColumn("cut", F.col("cut") & ~F.col("duplicate")).drop("is_first")
    return materialize(keyed_scan(told, ["conv_id"], ["turn", "role", "digest", "id"], running={"upto": "one"}, following={"next": "initial"}), "repair-places")


def repairs(placed: DataFrame) -> DataFrame:
    """conv_id, cost, audit of every conversation."""
    base = F.col("initial")
    sign = F.when(F.col("blank") | F.col("duplicate"), "x").when(F.col("cut"), F.upper(base)).otherwise(base)
    # dealt out by rows and not by bytes: a row is one sign, but the search of a few takes a while
    tasks = max(2 * placed.sparkSession.sparkContext.defaultParallelism, placed.count() // TASK_ROWS)
    segments = (placed.withColumn("segment", F.floor((F.col("upto") - 1) / SEGMENT)).repartition(tasks, "conv_id", "segment").groupBy("conv_id", "segment")
                .agg(F.array_sort(F.collect_list(F.struct("upto", sign.alias("sign")))).alias("rows"), F.bool_or(F.col("next").isNull()).alias("last")))     # SEGMENT rows at most
    level = materialize(told_by(segments.select("conv_id", "segment", F.array_join("rows.sign", "").alias("signs"), "last"), searched({})), "repair-level")
    while level.agg(F.max("segment")).first()[0]:
        near = level.groupBy("conv_id", F.floor(F.col("segment") / FAN).alias("segment")).agg(F.array_sort(F.collect_list(F.struct("segment", "told"))).alias("parts"))
        level = materialize(told_by(near, merged), "repair-level")
    ends = F.filter(F.transform("told", lambda t: F.when(t.exit.isin(NOTHING, ASSISTANT), F.struct(t.cost.alias("cost"), t.audit.alias("audit")))
                                .when(t.exit == USER, F.struct((t.cost + INSERT).alias("cost"), F.concat(t.audit, F.lit("I")).alias("audit")))), lambda t: t.isNotNull())
    return level.select("conv_id", F.array_min(ends).alias("best")).select("conv_id", "best.cost", "best.audit")


def repaired_turns(stored: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text of the repaired conversations, each conversation's turns together and in order."""
    small_batches(stored.sparkSession)
    rows = stored.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "id", "text").unionByName(
        found.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text")), allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest", "id").select("conv_id", "kind", "role", "text")
    schema = T.StructType([stored.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, NOTHING, 0
        for batch in batches:
            convs, out = batch.column(0), ([], [], [], [])

            def give(k: int, role: str, text: str) -> None:
                for column, value in zip(out, (k, place, role, text)):  # noqa: B023
                    column.append(value)

            def inserts(k: int) -> None:
                nonlocal at, state, place
                while at < len(audit) and audit[at] == "I":
                    at, state, place = at + 1, _NEXT[state], place + 1
                    give(k, _ROLE[state], "")  # noqa: B023

            for k, (kind, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                if kind == 0:
                    audit, at, state, place = text, 0, NOTHING, 0
                    continue
                inserts(k)
                step, at = audit[at], at + 1
                if step != "D":
                    state = _NEXT[state] if step == "R" else _AFTER_KEEP[role[:1], state]
                    place += 1
                    give(k, _ROLE[state] if step == "R" else role, text)
                if audit[at:at + 1] == "I" and at == len(audit) - 1:
                    inserts(k)
            yield pa.RecordBatch.from_arrays([convs.take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string())], names=schema.names)

    return ordered.mapInArrow(edit, schema)


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of turns that come together and in order: `role:text`, joined by newlines."""
    schema = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        for batch in batches:
            done = []
            for c, place, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if place == 1:
                    if sha:
                        done.append((conv, sha.hexdigest()))
                    conv, sha = c, hashlib.sha256()
                sha.update(f"{'' if place == 1 else chr(10)}{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field(0).type), pa.array([d[1] for d in done], pa.string())], names=schema.names)
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.field(0).type), pa.array([sha.hexdigest()])], names=schema.names)

    return turns.mapInArrow(digest, schema)


def structure(placed: DataFrame) -> DataFrame:
    """Counts per conversation: gaps, blank, duplicate, truncated, illegal."""
    pair = F.concat("initial", "next")
    return placed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"), F.count_if("blank").alias("blank"),
        F.count_if("duplicate").alias("duplicate"), F.count_if("cut").alias("truncated"), F.count_if(F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False))).alias("illegal"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of `conv_id:turn` modulo 20."""
    told = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20).alias("kind")).where("kind <> 0")
    return told.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def repair_report(turns: DataFrame, every: DataFrame) -> DataFrame:
    """One row per conv_id of every: the counts, cost and audit of the conversation and the digest of its repaired turns."""
    stored = marked(turns)
    placed = faults(stored)
    found = materialize(repairs(placed), "repairs")
    parts = structure(placed).unionByName(found, allowMissingColumns=True).unionByName(digests(repaired_turns(stored, found)), allowMissingColumns=True)
    whole = parts.unionByName(every.select("conv_id").distinct(), allowMissingColumns=True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


SQL = r"""
WITH RECURSIVE k AS (SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
h AS (SELECT *, xor(list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(range(1, length(s) + 1), lambda p: list_transform(range(0, 8), lambda i: ((ord(substr(s, p, 1)) >> i::INT) & 1)::UBIGINT)))),
    lambda c, b: CASE WHEN xor(c & 1, b) = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END), 4294967295::UBIGINT) % 20 AS kind FROM k),
d AS (SELECT conv_id, k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM h, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text)) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM d),
f AS (SELECT *, t = '' AS blank, t <> '' AND row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS duplicate, lead(role) OVER (PARTITION BY k ORDER BY i) AS following FROM o),
r AS (SELECT *, NOT blank AND NOT duplicate AND right(t, 1) NOT IN ('.', '!', '?') AS cut FROM f),
w AS (SELECT DISTINCT k, 0::BIGINT AS i, 0 AS q, {'c': 0::BIGINT, 'a': '', 'o': ''} AS best FROM r
  UNION ALL
  SELECT k, i, q, min({'c': c, 'a': a, 'o': o}) FROM (
    SELECT k, i, CASE e WHEN 'D' THEN q WHEN 'R' THEN CASE WHEN q = 2 THEN 3 ELSE 2 END ELSE CASE WHEN ini = 's' AND q = 0 THEN 1 WHEN ini = 'u' AND q IN (0, 1, 3) THEN 2 WHEN ini = 'a' AND q = 2 THEN 3 END END AS q,
      c + CASE e WHEN 'D' THEN 4 ELSE CASE WHEN e = 'R' THEN 3 ELSE 0 END + CASE WHEN cut THEN 3 ELSE 0 END END AS c, a || e AS a,
      o || CASE e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || text END AS o
    FROM (SELECT w.k, r.i, x, CASE WHEN x = 0 THEN w.q WHEN w.q = 2 THEN 3 ELSE 2 END AS q, w.best.c + 3 * x AS c, w.best.a || repeat('I', x) AS a,
            w.best.o || CASE WHEN x = 0 THEN '' WHEN w.q = 2 THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END AS o, r.role, r.text, r.blank OR r.duplicate AS gone, r.cut, left(r.role, 1) AS ini
          FROM w JOIN r ON r.k = w.k AND r.i = w.i + 1, (VALUES (0), (1)) ins(x)) y, (VALUES ('D'), ('K'), ('R')) z(e) WHERE e = 'D' OR NOT gone) v
  WHERE q IS NOT NULL GROUP BY k, i, q),
z AS (SELECT k, max(i) AS n FROM r GROUP BY k),
b AS (SELECT k, min(CASE WHEN q = 2 THEN {'c': best.c + 3, 'a': best.a || 'I', 'o': best.o || chr(10) || 'assistant:'} ELSE best END) AS best FROM w JOIN z USING (k) WHERE w.i = z.n AND w.q <> 1 GROUP BY k),
g AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(cut) AS truncated,
  count_if(following IS NOT NULL AND left(role, 1) || left(following, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY k)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM k) c LEFT JOIN g USING (k) LEFT JOIN b USING (k)"""


@query("op11_conversation_repair", SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair_report(damaged(conversations), conversations)
