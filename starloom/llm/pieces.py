"""SentencePiece encoding and decoding by suffix-array matching.

The new text of a batch is concatenated and indexed by a suffix array (suffixes compared over the longest piece's length).
Every piece of the vocabulary is binary-searched in it; its range of suffixes are its occurrences, the edges. Edges are
laid out by position, and the segmentation is relaxed over them. The public model is a BPE model, whose result is no
shortest path: relaxing means that, among the edges spanning two neighbouring symbols, the one with the best score (then the
leftmost) replaces both, until none is left. Characters without a piece become their bytes' pieces.

No piece of the vocabulary holds a space behind another letter, a line feed or a tab (checked when the model is loaded), so a
text falls into independent runs there; each distinct run is segmented once per worker, while they fit a bounded cache.

Defined cases: a null text has no ids, like an empty one. The character U+2581 stands for a space in this vocabulary, so it
is decoded as one. Ids outside the vocabulary are decoded as nothing; bytes that are not UTF-8 as U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.llm.common import small_batches, table
from starloom.llm.registry import query

INDEX_CHARS = 600_000                  # characters indexed at once
CACHE_RUNS = 800_000
LONG_RUN = 256                         # runs of more characters are relaxed with a heap, by themselves
_NORMAL, _BYTE = 1, 6                  # piece types of the public model format
_RUNS, _RUNS_ANY = re.compile(r" *[^ \n\t]+| +|[\n\t]"), re.compile(r" *[^ ]+| +")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary of a BPE model file, spaces written as spaces, in code point order."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as public

        model = public.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != 2:
            raise ValueError("this operator relaxes BPE models")
        found = sorted((p.piece.replace("▁", " "), k, p.score) for k, p in enumerate(model.pieces) if p.type == _NORMAL)
        self.text = np.array([p for p, _, _ in found])
        self.ids = np.array([k for _, k, _ in found], np.int32)
        self.lengths = np.array([len(p) for p, _, _ in found])
        order = np.argsort(np.argsort([-s for _, _, s in found], kind="stable"))
        self.rank = np.append(order, len(order)).astype(np.int64)       # 0: best score; the last: no piece
        self.longest = int(self.lengths.max())
        self.behind = np.char.ljust(self.text, self.longest, "\U0010ffff")     # no suffix that begins with the piece is greater
        self.prefix = " " if model.normalizer_spec.add_dummy_prefix else ""
        self.runs = _RUNS if not any(re.search(r"[\n\t]", p) for p in self.text) else _RUNS_ANY
        if any(" " in p.lstrip(" ") for p in self.text):
            raise ValueError("pieces with inner spaces would cross runs")
        self.byte_ids = {int(p.piece[1:-1], 16): k for k, p in enumerate(model.pieces) if p.type == _BYTE}
        self.decoded = [p.piece.replace("▁", " ").encode() if p.type == _NORMAL else bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE else b"" for p in model.pieces]


def edge_table(text: str, pieces: Pieces) -> np.ndarray:
    """table[position, length - 1]: the place of the piece that begins there with this length, or len(pieces)."""
    points = np.frombuffer((text + "\0" * pieces.longest).encode("utf-32-le", "surrogatepass"), "<u4")
    n, reach = len(points) - pieces.longest, 1
    rank = np.unique(points, return_inverse=True)[1].astype(np.int64)
    while reach < pieces.longest:                            # suffix array over the longest piece's length, by doubling
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-reach] = rank[reach:] + 1
        rank = np.unique(rank * (int(ahead.max()) + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        reach *= 2
    order = np.argsort(rank[:n], kind="stable")
    windows = np.lib.stride_tricks.sliding_window_view(points, pieces.longest)[order]
    suffixes = np.ascontiguousarray(windows).view(f"<U{pieces.longest}").ravel()
    low = np.searchsorted(suffixes, pieces.text)
    high = np.searchsorted(suffixes, pieces.behind, side="right")
    count = high - low
    piece = np.repeat(np.arange(len(count)), count)
    position = order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(len(piece))]
    table_ = np.full((n, pieces.longest), len(count), np.int32)
    table_[position, pieces.lengths[piece] - 1] = piece      # edges by position
    return table_


def relax(starts: np.ndarray, ends: np.ndarray, run: np.ndarray, table_: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge neighbouring symbols [start, end) of each run, best score first, until no edge spans two of them."""
    done = []
    while len(starts):
        inner = run[:-1] == run[1:]
        length = ends[1:] - starts[:-1]
        span = np.where(inner & (length <= pieces.longest), table_[starts[:-1], np.minimum(length, pieces.longest) - 1], len(pieces.ids))
        score = pieces.rank[span]
        first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        score = np.append(score, len(pieces.ids))
        best = np.minimum.reduceat(score * (len(score) + 1) + np.arange(len(score)), first)
        at, ok = best % (len(score) + 1), best // (len(score) + 1) < len(pieces.ids)
        over = np.repeat(~ok, np.diff(np.r_[first, len(run)]))
        done.append(np.stack([starts[over], ends[over], run[over]]))
        ends[at[ok]] = ends[at[ok] + 1]
        keep = ~over
        keep[at[ok] + 1] = False
        starts, ends, run = starts[keep], ends[keep], run[keep]
    whole = np.concatenate(done, axis=1) if done else np.empty((3, 0), np.int64)
    whole = whole[:, np.argsort(whole[0], kind="stable")]
    return whole[0], whole[1], whole[2]


def relax_long(start: int, end: int, table_: np.ndarray, pieces: Pieces) -> list[tuple[int, int]]:
    """The same for one long run, with a heap of the edges that span two neighbours."""
    after = {k: k + 1 for k in range(start, end)}             # symbol start -> its end, which is the next one's start
    before = {k + 1: k for k in range(start, end)}
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = after.get(a)
        c = after.get(b) if b is not None else None
        if c is not None and c - a <= pieces.longest and (p := int(table_[a, c - a - 1])) < len(pieces.ids):
            heapq.heappush(heap, (int(pieces.rank[p]), a, b, c))

    for k in range(start, end - 1):
        offer(k)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if after.get(a) == b and after.get(b) == c:
            after[a] = c
            del after[b]
            before[c] = a
            offer(a)
            if (left := before.get(a)) is not None and after.get(left) == a:
                offer(left)
    return sorted(after.items())


class Runs(dict):
    """Ids (little-endian int32 bytes) of runs of text, segmented in batches and kept while they fit."""

    def __init__(self, path: str):
        super().__init__()
        self.pieces = Pieces(path)

    def learn(self, new: list[str]) -> None:
        batch, size = [], 0
        for run in new:
            batch.append(run)
            size += len(run) + 1
            if size >= INDEX_CHARS:
                self._segment(batch)
                batch, size = [], 0
        if batch:
            self._segment(batch)

    def _segment(self, runs: list[str]) -> None:
        pieces, text = self.pieces, "\0".join(runs) + "\0"
        table_ = edge_table(text, pieces)
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        begins = np.cumsum(lengths + 1) - lengths - 1
        short = lengths <= LONG_RUN
        at = np.repeat(begins[short] - np.cumsum(lengths[short]) + lengths[short], lengths[short]) + np.arange(int(lengths[short].sum()))
        starts, ends, owner = relax(at, at + 1, np.repeat(np.flatnonzero(short), lengths[short]), table_, pieces)
        found = table_[starts, ends - starts - 1]
        ids = np.append(pieces.ids, -1)[found]
        cuts = np.searchsorted(owner, np.arange(len(runs) + 1))
        unknown = np.unique(owner[ids < 0])
        data = ids.astype("<i4").tobytes()
        for k, run in enumerate(runs):
            self[run] = data[4 * cuts[k]:4 * cuts[k + 1]]
        for k in unknown.tolist():
            self[runs[k]] = self._with_bytes(text, zip(starts[cuts[k]:cuts[k + 1]].tolist(), ends[cuts[k]:cuts[k + 1]].tolist()), table_)
        for k in np.flatnonzero(~short).tolist():
            self[runs[k]] = self._with_bytes(text, relax_long(int(begins[k]), int(begins[k] + lengths[k]), table_, pieces), table_)

    def _with_bytes(self, text: str, symbols, table_: np.ndarray) -> bytes:
        out = []
        for a, b in symbols:
            piece = int(table_[a, b - a - 1])
            out += [int(self.pieces.ids[piece])] if piece < len(self.pieces.ids) else [self.pieces.byte_ids[x] for x in text[a:b].encode()]
        return np.array(out, "<i4").tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        runs = [self.pieces.runs.findall(self.pieces.prefix + t.replace("▁", " ")) if t else [] for t in texts]
        distinct = set(chain.from_iterable(runs))
        new = distinct.difference(self)
        if len(self) + len(new) > CACHE_RUNS:
            self.clear()
            new = distinct
        self.learn(list(new))
        return [np.frombuffer(b"".join(map(self.__getitem__, r)), "<i4") for r in runs]

    def decode(self, ids: np.ndarray) -> str:
        decoded, n = self.pieces.decoded, len(self.pieces.decoded)
        text = b"".join(decoded[i] if 0 <= i < n else b"" for i in ids.tolist()).decode("utf-8", "replace")
        return text[len(self.pieces.prefix):] if self.pieces.prefix and text.startswith(self.pieces.prefix) else text


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids of docs (doc_id, text). No shuffle."""
    small_batches(docs.sparkSession, 1024)
    path = path or model_path()
    schema = T.StructType([*docs.select("doc_id").schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(path)
        for batch in batches:
            ids = runs.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of encoded (doc_id, ids)."""
    small_batches(encoded.sparkSession, 1024)
    path = path or model_path()
    schema = T.StructType([*encoded.select("doc_id").schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(path)
        for batch in batches:
            texts = [runs.decode(np.array(v, np.int64)) if v is not None else None for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and its ids decoded again: ids, their number and checksum, the decoded text's digest, and
    whether it is the text (as this vocabulary can spell it)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    small_batches(spark, 1024)
    path = model_path()
    schema = T.StructType([*docs.select("doc_id").schema.fields, *T.StructType.fromDDL(
        "ids array<int>, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = runs.encode(texts)
            back = [runs.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]), pa.array([b == (t or "").replace("▁", " ") for b, t in zip(back, texts)])],
                names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
