"""Hourly latency states that know which source positions they summarise.

A piece is what one batch adds: states per (hour, pipeline, stage), and the span of positions it read of each source (a topic
partition and its offsets, or a file at position 0). Every row of the source counts once, whatever is replayed:

* Rows that a live piece of another run already summarises are kept apart, as a piece under that one. They count once their
  run has read all spans of the piece above; from then on that piece doesn't. The newest such run wins.
* So a replay replaces exactly the pieces it covers whole. Pieces it can't reach, whose messages have expired or belong to
  another source, and those it hasn't read to the end yet, keep their states.

compact() merges FAN pieces of a level into one of the next, so their number grows with the logarithm of the batches;
neighbouring spans become one. Folders it has merged go with the next compaction: readers that have begun may end.

One stream writes a table at a time. A run must read each source in order, as Kafka and file streams do.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.catalog import schema
from starloom.operators.telemetry import latency_states, merge_states
from starloom.session import materialize
from starloom.sources.tables import BatchTable, run_of

FAN = 8
KEYS = ["hour", "pipeline", "stage"]
ROW = schema("kind string, piece string, under string, run string, level int, source string, first bigint, last bigint, "
             "hour timestamp, pipeline string, stage string, sketch binary, events bigint")
STATE, SPAN, GONE = "state", "span", "gone"


@dataclass
class Piece:
    batch: str
    under: str | None
    run: str
    level: int
    replaced_by: str | None = None
    in_vain: bool = False          # its run began within the piece above and can't replace it


class LatencyStates:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = BatchTable(spark, path, ROW, ("kind",))

    def _gone(self, rows: DataFrame) -> set[str]:
        return {r.piece for r in rows.where(F.col("kind") == GONE).select("piece").distinct().collect()}

    def _look(self, but: str = "") -> tuple[DataFrame, dict[str, Piece], set[str], DataFrame]:
        """All rows, the pieces that are not merged away, the names of those that count, and their spans, as if batch but were
        not there. The driver holds a line per piece, as it does per folder."""
        rows = self.table.read().where(F.col("batch_id") != but)
        gone = self._gone(rows)
        spans = rows.where((F.col("kind") == SPAN) & ~F.col("piece").isin(*gone)) if gone else rows.where(F.col("kind") == SPAN)
        spans = spans.select("piece", "under", "run", "level", "source", "first", "last", "batch_id")
        pieces = {r.piece: Piece(r.batch_id, r.under, r.run, r.level) for r in spans.drop("source", "first", "last").distinct().collect()}
        if any(p.under for p in pieces.values()):
            read = spans.where("under is not null").groupBy(F.col("under").alias("piece"), F.col("run").alias("reader"), "source").agg(F.min("first").alias("lo"), F.max("last").alias("hi"))
            met = spans.join(read, ["piece", "source"]).groupBy("piece", "reader").agg(F.count_if(F.expr("lo <= first and hi >= last")).alias("met"), F.count_if(F.expr("lo > first")).alias("missed"))
            needed = spans.groupBy("piece").agg(F.count(F.lit(1)).alias("needed"))
            found = met.join(needed, "piece").collect()                           # a line per piece and replay at most
            for r in found:
                if r.met == r.needed:
                    pieces[r.piece].replaced_by = max(r.reader, pieces[r.piece].replaced_by or "")
            vain = {(r.piece, r.reader) for r in found if r.missed}
            for p in pieces.values():
                p.in_vain = (p.under, p.run) in vain

        def counts(piece: Piece) -> bool:
            above = pieces.get(piece.under)
            return above is None or above.replaced_by == piece.run and counts(above)

        return rows, pieces, {name for name, p in pieces.items() if p.replaced_by is None and counts(p)}, spans

    def _of(self, rows: DataFrame, names: set[str]) -> DataFrame:
        chosen = self.spark.createDataFrame([(n,) for n in sorted(names)], "piece string")
        return rows.join(F.broadcast(chosen), "piece", "left_semi")              # a line per piece, not per row or file

    def read(self) -> DataFrame:
        """States (hour, pipeline, stage, sketch, events) that count, to be merged."""
        rows, _, live, _ = self._look()
        return self._of(rows.where(F.col("kind") == STATE), live).select(*KEYS, "sketch", "events")

    def pieces(self) -> int:
        return len(self._look()[1])

    def append(self, events: DataFrame, batch: str) -> None:
        """Add a batch of events with the columns source and position; a batch written again replaces itself."""
        run = run_of(batch)
        _, pieces, live, spans = self._look(batch)                                 # what an earlier try of this batch replaced is to be replaced again
        others = {name for name in live if pieces[name].run != run}
        if others:
            known = self._of(spans, others).select(F.col("piece").alias("under"), F.col("source").alias("_source"), "first", "last")
            events = events.join(known, (F.col("source") == F.col("_source")) & F.col("position").between(F.col("first"), F.col("last")), "left").drop("_source", "first", "last")
        else:
            events = events.withColumn("under", F.lit(None).cast("string"))
        # one pass over the events: states per source, from which both kinds of rows follow
        fine = materialize(latency_states(events, by=("under", "source"), also=(F.min("position").alias("first"), F.max("position").alias("last"))), "states")
        piece = F.when(F.col("under").isNull(), F.lit(batch)).otherwise(F.concat_ws("|", F.lit(batch), F.md5("under"))).alias("piece")
        common = [piece, "under", F.lit(run).alias("run"), F.lit(0).alias("level")]
        states = merge_states(fine, [*KEYS, "under"]).select(F.lit(STATE).alias("kind"), *common, *KEYS, "sketch", "events")
        read = fine.groupBy("under", "source").agg(F.min("first").alias("first"), F.max("last").alias("last")).select(F.lit(SPAN).alias("kind"), *common, "source", "first", "last")
        self._write(states.unionByName(read, allowMissingColumns=True), batch)

    def _write(self, rows: DataFrame, batch: str) -> None:
        names = [n for n in ROW.names if n not in rows.columns]
        self.table.append(rows.withColumns({n: F.lit(None).cast(ROW[n].dataType) for n in names}).select(ROW.names), batch)

    def compact(self, fan: int = FAN) -> int:
        """Merge every level that has fan pieces or more, from below; returns how many pieces went. Not between two tries of a batch."""
        went = 0
        while merged := self._compact_once(fan):
            went += merged
        return went

    def _compact_once(self, fan: int) -> int:
        rows, pieces, live, spans = self._look()
        gone = self._gone(rows)
        folders = set(self.table.batches())
        held = defaultdict(set)                                                   # folder: the pieces it holds
        for r in rows.where(F.col("kind") == SPAN).select("batch_id", "piece").distinct().collect():
            held[r.batch_id].add(r.piece)
        awaited = {p.under for p in pieces.values() if p.under in live and not p.in_vain}            # a replay is reading these
        levels = defaultdict(list)
        for name in live - awaited:
            levels[pieces[name].level].append(name)
        level = min((n for n, names in levels.items() if len(names) >= fan), default=None)
        parts = set(levels[level]) if level is not None else set()
        dead = {name for name, p in pieces.items() if name not in live and (p.under not in live or p.in_vain)}
        if not parts and not dead:
            return 0
        going = parts | dead
        name = f"merged-{uuid.uuid4().hex}"
        notes = self.spark.createDataFrame([(GONE, n) for n in sorted(going | {p for f in folders for p in held[f] if p in gone})], "kind string, piece string")
        if parts:
            runs = {pieces[p].run for p in parts}
            common = [F.lit(name).alias("piece"), F.lit(runs.pop() if len(runs) == 1 else "").alias("run"), F.lit(level + 1).alias("level")]
            states = merge_states(self._of(rows.where(F.col("kind") == STATE), parts), KEYS).select(F.lit(STATE).alias("kind"), *common, *KEYS, "sketch", "events")
            here = self._of(spans, live).select("source", "first", "last", F.col("piece").isin(*parts).alias("mine"))
            order = Window.partitionBy("source").orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            islands = here.withColumn("island", F.sum(F.when(F.col("mine"), 0).otherwise(1)).over(order)).where("mine")       # neighbours with no other piece between them
            joined = islands.groupBy("source", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).select(F.lit(SPAN).alias("kind"), *common, "source", "first", "last")
            notes = states.unionByName(joined, allowMissingColumns=True).unionByName(notes, allowMissingColumns=True)
        self._write(notes.coalesce(1), name)
        self.table.drop([f for f in folders if held[f] and held[f] <= gone])       # merged before this compaction began
        return len(going)
