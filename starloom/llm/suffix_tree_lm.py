"""LM scoring with a probabilistic suffix tree over words.

Symbols are words and one end mark per document. A node is a context of up to DEPTH preceding words. It is a candidate when
it occurs CONTEXT_COUNT times in the training texts, and is retained when its next-symbol distribution diverges from that of
its longest retained suffix: the log-likelihood it gains over all its occurrences must exceed PENALTY nats for each
distinct next symbol. Its stored next symbols are those seen EDGE_COUNT times in it. Both counts are absolute, so the tree
grows with the corpus; it is a set of Spark tables keyed by the hash of a gram (a context and its next word) and is never
held by the driver or broadcast as a whole.

Smoothing is absolute discounting: P(w|s) = max(c(s,w) - DISCOUNT, 0) / c(s) + free(s) * P(w|suffix of s), where free(s) is the
mass that stored symbols leave; at the root P(w) = (c(w) + 1) / (N + V + 1). A token is scored in the longest retained
suffix of its context. The logarithm of that is a sum over the grams that end at the token: the root's value of the word,
log free(s) for every retained s before it, and for every stored edge its own logarithm less what its suffix would have given.
So a document's score is the sum of one weight per gram in it, and scoring is one join by gram.

The tree grows one size at a time. A gram is counted only after a context that may be a node, which a bitmap of hash places
tells; the bitmap has at most 2**FILTER_BITS places, and what it lets pass in vain the exact join by context drops, so its size never changes a
result. All numbers travel as packed columns per hash range, and a range holds the grams of about RANGE_TOKENS tokens at any corpus size: counts by the
whole gram, so that a frequent context is spread over all ranges, then, once a gram is one number, to the range of its suffix and to that of its context.
There each size is joined with the one below by cogrouping ranges; what meets at one context or suffix is at most one number for each word of the vocabulary.

Scoring asks a bitmap of all weights and looks up the HOT_ENTRIES most frequent in a broadcast table of that fixed size. The rest goes, a chunk of
documents at a time, to the hash ranges of the weights and back, in up to PASSES passes over the documents (by a hash of their id), so that only a part
of what is asked is on disk at a time.

Words and grams are identified by 64-bit hashes. Defined cases: a null, empty or wordless text is the end mark alone. Without any
training document every token has c = 0, N = V = 0. Repeated rows are counted and scored each time; a null id is no
held-out id. Contexts never reach over the beginning of a document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import drop_table, mix, remainder, small_batches, table
from starloom.llm.registry import query
from starloom.session import materialize

DEPTH = 4
CONTEXT_COUNT = 4                 # occurrences of a context that may become a node
EDGE_COUNT = 2                    # occurrences of a next symbol that is stored
PENALTY = 4.0
DISCOUNT = 0.5
FILTER_BITS = 27                  # a bitmap has at most 2**27 places, 16 MB
RANGE_TOKENS = 1 << 21            # tokens whose grams share a hash range, about
HOT_ENTRIES = 1 << 20             # weights of the most frequent grams, broadcast
PASSES = 3                        # passes over the documents to score: what one asks for is on disk at a time
PASS_TOKENS = 1 << 22             # training tokens for each pass at least
_CHUNK_TOKENS = 2_000_000         # tokens whose grams a worker reduces at once
_BLOCK = 1 << 20                  # bytes of text hashed at once
_RECORD = 1 << 14                 # numbers of a column that a record packs at most
_RECORDS = 64                     # rows of an Arrow batch of records, or of texts to score: about a dozen numbers for each token and size of gram are held at once
_NUMBER_ROWS = 20_000             # rows of an Arrow batch of numbers
_CHUNK_ASKS = 1 << 20             # grams that a worker holds to ask for at once, and documents: their numbers take two bytes
_CHUNK_DOCS = 1 << 16
_BLOCK_BITS = 12                  # both places of a gram are among 2**12

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
_END_HASH = mix(np.array([2**64 - 1], np.uint64))[0]


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n - 1 of the multiplier and of its inverse, modulo 2**64."""
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, m, np.uint64))]) for m in (_MULTIPLIER, pow(_MULTIPLIER, -1, 2**64)))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into pieces of about _BLOCK bytes."""
    at = 0
    while len(text) - at > _BLOCK and (cut := _SPACE.search(text, at + _BLOCK)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _word_hashes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some pieces in a row, and how many each piece has.

    A word's hash is its polynomial modulo 2**64 over coded bytes: the difference of two prefix sums, shifted back to power 0.
    """
    data = np.frombuffer(b"\n".join([*pieces, b""]).lower(), np.uint8)
    edge = np.diff(((data == 32) | ((data >= 9) & (data <= 13))).astype(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(1 << max(20, int(len(data)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.cumsum(_BYTE[data] * up[:len(data)])
        value = (sums[ends - 1] - np.where(starts > 0, sums[starts - 1], np.uint64(0))) * down[starts]
        hashes = mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    bounds = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    return hashes, np.diff(np.searchsorted(starts, bounds))


def _hashed(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Per batch: itself, the word hashes of all its tokens, and the number of tokens of each document, end mark included."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary()).to_pylist()
        if not texts:
            continue
        hashes, owned, held, owner, size = [], np.zeros(len(texts), np.int64), [], [], 0

        def flush():
            found, counts = _word_hashes(held)
            hashes.append(found)
            np.add.at(owned, owner, counts)
            held.clear(), owner.clear()

        for k, text in enumerate(texts):
            for piece in _pieces(text or b""):
                held.append(piece)
                owner.append(k)
                size += len(piece)
                if size > _BLOCK:
                    flush()
                    size = 0
        flush()
        flat = np.full(int(owned.sum()) + len(texts), _END_HASH, np.uint64)
        flat[np.arange(int(owned.sum())) + np.repeat(np.arange(len(texts)), owned)] = np.concatenate(hashes)
        yield batch, flat, owned + 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and document lengths of about _CHUNK_TOKENS tokens each, from batches of (text)."""
    flats, sizes, held = [], [], 0
    for _, flat, lengths in _hashed(batches, 0):
        flats.append(flat)
        sizes.append(lengths)
        held += len(flat)
        if held > _CHUNK_TOKENS:
            yield np.concatenate(flats), np.concatenate(sizes)
            flats, sizes, held = [], [], 0
    if flats:
        yield np.concatenate(flats), np.concatenate(sizes)


def _places(lengths: np.ndarray) -> np.ndarray:
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def joined(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Hash of a gram from those of the gram without its last word and the gram without its first."""
    with np.errstate(over="ignore"):
        return mix(context * np.uint64(0xD6E8FEB86659FD93) + suffix)


def _next_size(grams: np.ndarray) -> np.ndarray:
    """From the hash of the gram that ends at each token to that of the gram of one more word; of use only where it lies within the document."""
    return joined(np.concatenate([np.zeros(1, np.uint64), grams[:-1]]), grams)


def _range_bits(tokens: int) -> int:
    """A hash range is named by so many first bits of a gram's hash."""
    return max(1, math.ceil(math.log2(tokens / RANGE_TOKENS + 1)))


def _part(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def _ascending(keys: np.ndarray, shared: int = 0, exact: bool = True) -> np.ndarray:
    """Places of keys, all of the same first shared bits, in ascending order; not exact: by their first bits only, as many as fit beside a place.

    Numbers are sorted several times as fast as places are, so the place is put into the last bits of the key.
    """
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    packed = (keys << np.uint64(shared)) & ~low | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    if exact and (keys[order[1:]] < keys[order[:-1]]).any():
        return np.argsort(keys)
    return order


def _run_starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _matched(keys: np.ndarray, table_: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Of keys, ascending, those that are in a table of distinct ones: their places, and the places there."""
    order, own = _ascending(keys, shared), _ascending(table_, shared)
    sought, held = keys[order], table_[own]
    at = np.searchsorted(held, sought)
    same = at < len(held)
    same[same] = held[at[same]] == sought[same]
    return order[same], own[at[same]]


def _records(part: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """Rows (part, columns) as records that hold up to _RECORD numbers of one part, packed; part ascends."""
    starts = _run_starts(part)
    cuts = [k for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]) for k in range(a, b, _RECORD)]
    bounds = np.array([*cuts, len(part)], np.int64)
    packed = {name: pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer((bounds * column.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(column))])
              for name, column in columns.items()}
    return pa.table({"part": pa.array(part[bounds[:-1]]), **packed})


def _by_part(keys: np.ndarray, bits: int, columns: dict[str, np.ndarray]) -> pa.Table:
    """Packed records by the hash range of keys."""
    order = _ascending(keys, exact=False)
    return _records(_part(keys[order], bits), {name: column[order] for name, column in columns.items()})


def _numbers(records: pa.Table | pa.RecordBatch, name: str, kind: type = np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(records.column(name).to_pylist()), kind)


@dataclass
class Places:
    """Which of 2**bits places the grams of a set fall on, two for each: false for no gram of the set."""

    bits: int
    bitmap: np.ndarray

    def may_hold(self, grams: np.ndarray) -> np.ndarray:
        first, second = _two_places(grams, self.bits)
        held = (self.bitmap[first >> 3] >> (first & 7).astype(np.uint8) & 1).astype(bool)
        at = np.flatnonzero(held)
        second = second[at]
        held[at] = self.bitmap[second >> 3] >> (second & 7).astype(np.uint8) & 1
        return held


def _two_places(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The place that a hash's first bits tell, and that of its last bits in the same block."""
    first = (grams >> np.uint64(64 - bits)).astype(np.int64)
    return first, first >> _BLOCK_BITS << _BLOCK_BITS | (grams & np.uint64((1 << _BLOCK_BITS) - 1)).astype(np.int64)


def places_of(grams: DataFrame, count: int) -> Places:
    """The places of count grams (part, gram: packed records), sixteen for each up to 2**FILTER_BITS in all."""
    bits = min(FILTER_BITS, max(15, math.ceil(math.log2(16 * count + 1))))

    def piece(records: pa.Table) -> pa.Table:
        first, second = _two_places(_numbers(records, "gram"), bits)
        least, most = int(first.min()) >> _BLOCK_BITS, int(first.max()) >> _BLOCK_BITS
        held = np.zeros((most - least + 1) << _BLOCK_BITS, bool)
        held[first - (least << _BLOCK_BITS)] = held[second - (least << _BLOCK_BITS)] = True
        return pa.table({"block": [least], "bitmap": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    found = grams.select("part", "gram").where("length(gram) > 0").groupBy("part").applyInArrow(piece, "block long, bitmap binary").toArrow()
    bitmap, block = np.zeros(1 << (bits - 3), np.uint8), 1 << (_BLOCK_BITS - 3)
    for least, bytes_ in zip(found.column("block").to_pylist(), found.column("bitmap")):
        bitmap[least * block:][:len(bytes_.as_buffer())] |= np.frombuffer(bytes_.as_buffer(), np.uint8)
    return Places(bits, bitmap)


def word_counts(docs: DataFrame) -> DataFrame:
    """gram, n of every token of docs (text), the end mark included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, _ in _chunks(batches):
            found, n = np.unique(flat, return_counts=True)
            for k in range(0, len(found), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(found[k:k + (1 << 16)].view(np.int64)), pa.array(n[k:k + (1 << 16)])], names=["gram", "n"])

    return docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def packed_words(words: DataFrame, bits: int, tokens: int, kinds: int) -> DataFrame:
    """Words (gram, n) as records part, gram, n, p: p is a word's probability at the root."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            grams = batch.column(0).to_numpy().view(np.uint64)
            yield from _by_part(grams, bits, {"gram": grams, "n": n, "p": (n + 1) / float(tokens + kinds + 1)}).to_batches()

    small_batches(words.sparkSession, _NUMBER_ROWS)
    out = materialize(words.select("gram", "n").mapInArrow(pack, "part long, gram binary, n binary, p binary"), "packed-words")
    small_batches(words.sparkSession, _RECORDS)
    return out


def frequent(grams: DataFrame, least: int) -> DataFrame:
    """Of records (part, gram, n) those numbers whose n is least or more."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.repeat(batch.column(0).to_numpy(), pc.divide(pc.binary_length(batch.column(1)), 8).to_numpy())
            n = _numbers(batch, "n", np.int64)
            at = np.flatnonzero(n >= least)
            yield from _records(part[at], {"gram": _numbers(batch, "gram")[at], "n": n[at]}).to_batches()

    return grams.select("part", "gram", "n").mapInArrow(chosen, "part long, gram binary, n binary")


def gram_counts(docs: DataFrame, size: int, contexts: Places, bits: int) -> DataFrame:
    """Records context, suffix, n, by the range of the suffix, of the grams of size words that occur EDGE_COUNT times after one of the contexts."""
    asked = docs.sparkSession.sparkContext.broadcast(contexts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, lengths in _chunks(batches):
            at, below = np.flatnonzero(_places(lengths) >= size - 1), flat
            for _ in range(size - 2):
                below = _next_size(below)
            at = at[asked.value.may_hold(below[at - 1])]
            grams = joined(below[at - 1], below[at])
            order = _ascending(grams, exact=False)          # a gram may come in two runs: their counts are added up by its range
            grams = grams[order]
            new = _run_starts(grams)
            first = at[order[new]]
            n = np.diff(np.append(new, len(grams))).astype(np.uint32)
            for batch in _records(_part(grams[new], bits), {"context": below[first - 1], "suffix": below[first], "n": n}).to_batches(max_chunksize=_RECORDS):
                yield batch

    def total(records: pa.Table) -> pa.Table:
        context, suffix, n = _numbers(records, "context"), _numbers(records, "suffix"), _numbers(records, "n", np.uint32)
        grams = joined(context, suffix)
        order = _ascending(grams, bits)
        new = _run_starts(grams[order])
        seen = np.add.reduceat(n[order].astype(np.int64), new) if len(new) else np.zeros(0, np.int64)
        keep = np.flatnonzero(seen >= EDGE_COUNT)
        first = order[new[keep]]
        return _by_part(suffix[first], bits, {"context": context[first], "suffix": suffix[first], "n": seen[keep]})

    schema = "part long, context binary, suffix binary, n binary"
    return docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(total, schema)


def with_suffix(counts: DataFrame, lower: DataFrame, bits: int) -> DataFrame:
    """The records of counts, by the range of the context, with the probability of the last word after the suffix's context (before)."""
    def placed(rows: pa.Table, below: pa.Table) -> pa.Table:
        context, suffix, n = _numbers(rows, "context"), _numbers(rows, "suffix"), _numbers(rows, "n", np.int64)
        grams, p = _numbers(below, "gram"), _numbers(below, "p", np.float64)
        asked, at = _matched(suffix, grams, bits)           # a suffix that is not there: the bitmap let the gram pass in vain
        context, suffix, n, before = context[asked], suffix[asked], n[asked], p[at]
        return _by_part(context, bits, {"context": context, "suffix": suffix, "n": n, "before": before})

    return counts.groupBy("part").cogroup(lower.select("part", "gram", "p").groupBy("part")).applyInArrow(placed, "part long, context binary, suffix binary, n binary, before binary")


def with_context(rows: DataFrame, candidates: DataFrame, penalty: float, bits: int) -> DataFrame:
    """Records of two kinds by the range of their gram: node false, the grams after a candidate, gram, n, p, weight (nan if the context is no node); node true, the nodes, gram, n, weight."""
    def judged(rows: pa.Table, totals: pa.Table) -> pa.Table:
        context, suffix, n, before = _numbers(rows, "context"), _numbers(rows, "suffix"), _numbers(rows, "n", np.int64), _numbers(rows, "before", np.float64)
        grams, total = _numbers(totals, "gram"), _numbers(totals, "n", np.int64)
        asked, at = _matched(context, grams, bits)
        total = total[at]
        context, suffix, n, before = context[asked], suffix[asked], n[asked], before[asked]
        new = _run_starts(context)
        kinds = np.diff(np.append(new, len(context)))
        added = lambda values: np.add.reduceat(values, new) if len(new) else values
        seen, least, whole = added(n), added(before), total[new]
        rest = whole - seen                                 # all other symbols together are one more outcome
        with np.errstate(divide="ignore", invalid="ignore"):
            rest_gain = np.where(rest > 0, rest * np.log(rest / whole / np.maximum(1 - least, 1e-12)), 0.0)
        retained = added(n * np.log(n / total / before)) + rest_gain > penalty * kinds
        free = 1 - (seen - DISCOUNT * kinds) / whole
        own, kept = np.repeat(free, kinds), np.repeat(retained, kinds)
        p = np.where(kept, (n - DISCOUNT) / total + own * before, before)
        weight = np.where(kept, np.log10(p / before / own), np.nan)
        gram, nodes = joined(context, suffix), new[retained]
        edges = _by_part(gram, bits, {"gram": gram, "n": n, "p": p, "weight": weight})
        nodes = _by_part(context[nodes], bits, {"gram": context[nodes], "n": whole[retained], "p": np.zeros(len(nodes)), "weight": np.log10(free[retained])})
        return pa.concat_tables([t.add_column(1, "node", pa.array([node] * len(t), pa.bool_())) for t, node in ((edges, False), (nodes, True))])

    return rows.groupBy("part").cogroup(candidates.groupBy("part")).applyInArrow(judged, "part long, node boolean, gram binary, n binary, p binary, weight binary")


def edges_of(grams: DataFrame) -> DataFrame:
    """Of records (part, gram, n, weight) those numbers that have a weight."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.repeat(batch.column(0).to_numpy(), pc.divide(pc.binary_length(batch.column(1)), 8).to_numpy())
            weight = _numbers(batch, "weight", np.float64)
            at = np.flatnonzero(~np.isnan(weight))
            yield from _records(part[at], {"gram": _numbers(batch, "gram")[at], "n": _numbers(batch, "n", np.int64)[at], "weight": weight[at]}).to_batches()

    return grams.select("part", "gram", "n", "weight").mapInArrow(chosen, "part long, gram binary, n binary, weight binary")


@dataclass
class Model:
    """The tree as a table of packed records: weights (part, word, gram, n, weight) and what the root needs.

    A gram has up to three places: as a word (word is true, weight empty); its weight as an edge; its weight as a node. n is its count in each.
    """

    tokens: int
    words: int
    bits: int
    weights: DataFrame


def learn(docs: DataFrame, depth: int = DEPTH, penalty: float = PENALTY) -> Model:
    """The tree of docs (text), of any size: one pass over the texts per size of gram, each joined with the size below."""
    spark = docs.sparkSession
    small_batches(spark)
    words = materialize(word_counts(docs), "words")
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    bits = _range_bits(tokens)
    words, counted = packed_words(words, bits, tokens, kinds), words
    drop_table(counted)
    # p: probability of a gram's last word in the longest retained suffix of the words before it
    lower = words
    weights = [words.select("part", F.lit(True).alias("word"), "gram", "n", F.lit(b"").alias("weight"))]
    for size in range(2, depth + 2):
        candidates = materialize(frequent(lower, CONTEXT_COUNT), f"candidates-{size}")
        found = candidates.agg(F.coalesce(F.sum(F.length("gram")), F.lit(0))).first()[0] // 8
        if not found:
            break
        counts = materialize(gram_counts(docs, size, places_of(candidates, found), bits), f"counts-{size}")
        rows = materialize(with_suffix(counts, lower, bits), f"size-{size}")
        drop_table(counts)
        if size > 2:
            drop_table(lower)
        placed = materialize(with_context(rows, candidates, penalty, bits), f"lower-{size}")
        drop_table(rows)
        drop_table(candidates)
        lower = placed.where("not node")
        stored = materialize(placed.where("node").select("part", "gram", "n", "weight").unionByName(edges_of(lower)), f"weights-{size}")
        weights.append(stored.select("part", F.lit(False).alias("word"), "gram", "n", "weight"))
    if lower is not words:
        drop_table(lower)
    return Model(tokens, kinds, bits, reduce(DataFrame.unionByName, weights))


def _octave(n: np.ndarray) -> np.ndarray:
    """Counts by size, eight classes to a doubling: at most 512 of them."""
    return np.floor(np.log2(n) * 8).astype(np.int64)


@dataclass
class Hot:
    """The weights of the most frequent grams, ascending by gram."""

    grams: np.ndarray
    n: np.ndarray
    weight: np.ndarray

    def __post_init__(self):
        self.bits = len(self.grams).bit_length() + 1
        self.starts = np.searchsorted(self.grams, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Place of each gram, -1 where it is not: from where grams of its first bits start, upwards."""
        out, left = np.full(len(grams), -1, np.int64), np.arange(len(grams))
        at = self.starts[(grams >> np.uint64(64 - self.bits)).astype(np.int64)]
        while len(left):
            within = at < len(self.grams)
            left, at = left[within], at[within]
            here, asked = self.grams[at], grams[left]
            out[left[here == asked]] = at[here == asked]
            go = here < asked
            left, at = left[go], at[go] + 1
        return out


def _added(grams: np.ndarray, order: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct grams in ascending order, and the sums of their values."""
    new = _run_starts(grams[order])
    return grams[order[new]], *(np.add.reduceat(v[order], new) if len(new) else v[:0] for v in values)


def _weights(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """part, gram, seen, n (0 unless a word), weight of all numbers in records (part, word, gram, n, weight)."""
    kinds = pc.divide(pc.binary_length(batch.column(2)), 8).to_numpy()
    word, seen = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), kinds), _numbers(batch, "n", np.int64)
    weight = np.zeros(len(seen))
    weight[~word] = _numbers(batch, "weight", np.float64)
    return np.repeat(batch.column(0).to_numpy(), kinds), _numbers(batch, "gram"), seen, np.where(word, seen, 0), weight


def split_weights(model: Model, most: int = HOT_ENTRIES) -> tuple[Hot, DataFrame, Places]:
    """(the most frequent grams' weights, at most so many of them; records part, gram, n, weight of all others; the places of all)."""
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            octave, rows = np.unique(_octave(_weights(batch)[2]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(octave), pa.array(rows)], names=["class", "rows"])

    def most_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, grams, seen, n, weight = _weights(batch)
            at = np.flatnonzero(_octave(seen) >= least)
            yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64)), pa.array(n[at]), pa.array(weight[at])], names=["gram", "n", "weight"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, grams, seen, n, weight = _weights(batch)
            at = np.flatnonzero(_octave(seen) < least)
            yield from _records(part[at], {"gram": grams[at], "n": n[at], "weight": weight[at]}).to_batches()

    found = sorted(((r[0], r[1]) for r in model.weights.mapInArrow(classes, "class long, rows long").groupBy("class").sum("rows").collect()), reverse=True)
    held, least = 0, 1 << 20
    for octave, rows in found:
        if held + rows > most:
            break
        held, least = held + rows, octave
    hot = model.weights.mapInArrow(most_frequent, "gram long, n long, weight double").toArrow()
    grams = hot.column("gram").to_numpy().view(np.uint64)
    cold = model.weights.mapInArrow(others, "part long, gram binary, n binary, weight binary")
    return Hot(*_added(grams, np.argsort(grams), hot.column("n").to_numpy(), hot.column("weight").to_numpy())), cold, places_of(model.weights, sum(rows for _, rows in found))


def score(docs: DataFrame, model: Model, depth: int = DEPTH, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """docs (doc_id, held_out, text) to doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, bits = docs.sparkSession, model.bits
    small_batches(spark, _RECORDS)
    hot, cold, places = split_weights(model, hot_entries)
    hot, places = spark.sparkContext.broadcast(hot), spark.sparkContext.broadcast(places)

    def asks(rows: list[pa.RecordBatch], found: list[np.ndarray], grams: list[np.ndarray], owner: list[np.ndarray], chunk: int) -> Iterator[pa.RecordBatch]:
        """The records of one chunk of documents: by hash range the grams to look up and whose they are, and once the documents with what is known of them."""
        numbers = np.concatenate(found, axis=1)
        kept = pa.Table.from_batches(rows)
        for k, name in enumerate(("n_tokens", "known", "counted", "raised")):
            kept = kept.append_column(name, pa.array(numbers[k]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as stream:
            stream.write_table(kept)
        grams, owner = np.concatenate(grams), np.concatenate(owner)
        cut = _by_part(grams, bits, {"gram": grams, "owner": owner})
        for name, values in (("chunk", pa.array(np.full(len(cut), chunk))), ("docs", pa.nulls(len(cut), pa.binary()))):
            cut = cut.append_column(name, values)
        own = pa.table({"part": pa.array([chunk % (1 << bits)], pa.int64()), "gram": pa.array([b""], pa.binary()), "owner": pa.array([b""], pa.binary()), "chunk": pa.array([chunk], pa.int64()),
                        "docs": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
        yield from pa.concat_tables([own, cut]).to_batches(max_chunksize=_RECORDS)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, table_ = TaskContext.get().partitionId() << 40, hot.value
        rows, numbers, grams, owners, docs_held, held = [], [], [], [], 0, 0
        for batch, flat, lengths in _hashed((b.slice(k, _CHUNK_DOCS >> 1) for b in batches for k in range(0, len(b), _CHUNK_DOCS >> 1)), 2):
            if held > _CHUNK_ASKS or docs_held + len(batch) > _CHUNK_DOCS:
                yield from asks(rows, numbers, grams, owners, chunk)
                chunk, rows, numbers, grams, owners, docs_held, held = chunk + 1, [], [], [], [], 0, 0
            doc, place = np.repeat(np.arange(len(lengths)), lengths), _places(lengths)
            known, counted, raised = np.zeros(len(lengths)), np.zeros(len(lengths)), np.zeros(len(lengths))
            own = flat
            for d in range(1, depth + 2):
                own = flat if d == 1 else _next_size(own)
                at = np.flatnonzero(place >= d - 1 if d <= depth else (place >= d - 1) & np.append(False, before[:-1]))
                at = at[places.value.may_hold(own[at])]
                if d == depth:                              # the longest grams are edges only: their contexts have weights as nodes
                    before = np.zeros(len(flat), bool)
                    before[at] = True
                found = table_.find(own[at])
                hit, miss = at[found >= 0], at[found < 0]
                found = found[found >= 0]
                raised += np.bincount(doc[hit], table_.weight[found], len(lengths))
                if d == 1:
                    known += np.bincount(doc[hit], table_.n[found] > 0, len(lengths))
                    counted += np.bincount(doc[hit], np.log10(table_.n[found] + 1.0), len(lengths))
                grams.append(own[miss])
                owners.append((doc[miss] + docs_held).astype(np.uint16))
                held += len(miss)
            rows.append(batch.select([0, 1]))
            numbers.append(np.array([lengths, known, counted, raised]))
            docs_held += len(batch)
        if rows:
            yield from asks(rows, numbers, grams, owners, chunk)

    def answered(asked: pa.Table, table_: pa.Table) -> pa.Table:
        grams, n, weight = _numbers(table_, "gram"), _numbers(table_, "n", np.int64), _numbers(table_, "weight", np.float64)
        grams, n, weight = _added(grams, _ascending(grams, bits), n, weight)
        wanted, owner = _numbers(asked, "gram"), _numbers(asked, "owner", np.uint16)
        sizes = pc.divide(pc.binary_length(asked.column("gram")), 8).to_numpy()
        record = np.repeat(np.arange(len(sizes)), sizes)
        hit, at = _matched(wanted, grams, bits)
        back = np.argsort(hit)
        hit, at = hit[back], at[back]
        word, edge = np.flatnonzero(n[at] > 0), np.flatnonzero(weight[at] != 0)
        whose = record[hit].astype(np.uint64) << np.uint64(16) | owner[hit]
        summed, raised = _added(whose[edge], _ascending(whose[edge]), weight[at[edge]])       # one number for a document, however many of its grams are of this range
        out = {}
        for name, mine, values in (("word", whose[word], np.log10(n[at[word]] + 1.0)), ("gram", summed, raised)):
            bounds = np.searchsorted(mine >> np.uint64(16), np.arange(len(sizes) + 1).astype(np.uint64))
            for column, numbers in ((f"{name}_owner", mine.astype(np.uint16)), (name, values)):
                out[column] = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((bounds * numbers.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])
        return pa.table({"chunk": asked.column("chunk"), "docs": asked.column("docs"), **out})

    def summed(records: pa.Table) -> pa.Table:
        kept = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in records.column("docs").to_pylist() if x is not None])
        of = lambda name: _numbers(records, name, np.float64)
        word_owner, owner = _numbers(records, "word_owner", np.uint16), _numbers(records, "gram_owner", np.uint16)
        numbers = [kept.column(k).to_numpy() for k in range(2, 6)]
        known = numbers[1] + np.bincount(word_owner, minlength=len(kept))
        counted = numbers[2] + np.bincount(word_owner, of("word"), len(kept))
        base = counted - numbers[0] * math.log10(tokens + words + 1)
        scored = base + numbers[3] + np.bincount(owner, of("gram"), len(kept))
        return pa.table([kept.column(0), kept.column(1), pa.array(numbers[0].astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(kept), tokens, np.int64)), pa.array(base), pa.array(scored)],
                        names=names)

    def scored(some: DataFrame) -> DataFrame:
        asked = some.select("doc_id", "held_out", "text").mapInArrow(one, "part long, gram binary, owner binary, chunk long, docs binary")
        back = asked.groupBy("part").cogroup(cold.groupBy("part")).applyInArrow(answered, "chunk long, docs binary, word_owner binary, word binary, gram_owner binary, gram binary")
        return back.groupBy("chunk").applyInArrow(summed, schema)

    tokens, words = model.tokens, model.words
    schema = T.StructType([*docs.select("doc_id", "held_out").schema.fields, *T.StructType.fromDDL("n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])
    names = schema.names
    passes = min(PASSES, tokens // PASS_TOKENS)
    if passes < 2:
        return scored(docs)
    return reduce(DataFrame.unionByName, [materialize(scored(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(passes)) == k)), f"scored-{k}") for k in range(passes)])


@query("op8_suffix_tree_lm")
def op8_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", F.coalesce(remainder("doc_id", 7), F.lit(0)) == 2)
    return score(docs, learn(docs.where("not held_out")))
