"""Sum-of-squares packing of tokenised documents into sequences of fixed capacity.

Tokenising: texts become ids of a public tokenizer followed by one end id; a document longer than the capacity is cut into
full pieces and a rest. Pieces are dealt by a hash of their row number into groups of about GROUP_PIECES, each packed by itself in one task of
bounded size, so the work spreads however large the corpus; a group wastes about one sequence in a few thousand.
Within a group pieces go in descending length, each to the place (a gap of the open bins, or a new bin) after which the sum
over gaps g of (number of open bins with gap g) squared is smallest; equal places go to the smallest gap.

Defined cases: a null or empty text is the end id alone (one piece of length 1). Rows with repeated or null ids are packed each time
and spread over the groups like any others. An empty table gives no pieces. Full pieces fill a sequence alone.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import small_batches, table
from starloom.llm.registry import query
from starloom.session import materialize

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 8192
_CACHE_WORDS = 1 << 16                                   # chunks, and parts of chunks, that a worker keeps the ids of
_ODD_SPACE = re.compile("[\x1c-\x1f]")                  # white space for str.split, but not for the tokenizer
_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-/:-@\[-`{-~]*)")   # Latin letters that lower-case to one letter


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself where printable, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)              # a few ids: far cheaper than by an array


class WordIds(dict):
    """The ids (little-endian uint32 bytes) of each chunk between white space, the first _CACHE_WORDS (frequent ones among them) kept, later ones computed.

    The tokenizer never joins across white space, so a text's ids are those of its chunks. Chunks of Latin letters with
    punctuation behind them are split here as the tokenizer splits them and looked up by their parts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.letters, self.cores = Tokenizer.from_file(path), _byte_letters(), {}
        self.model = self.tokenizer.model                  # asking the tokenizer for it makes a new object each time

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():            # most chunks, and one of three comes here: without the pattern and the second part
            value = self._part(chunk.lower())
        elif plain := _PLAIN.fullmatch(chunk):
            core = "".join(map(str.lower, plain[1])) if not plain[1].isascii() else plain[1].lower()
            value = self._part(core) + (self._part(plain[2]) if plain[2] else b"")
        else:
            value = _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        if len(self) < _CACHE_WORDS:
            self[chunk] = value
        return value

    def _part(self, part: str) -> bytes:
        if (value := self.cores.get(part)) is None:
            shown = part if part.isascii() else "".join(self.letters[b] for b in part.encode())
            value = _packed([t.id for t in self.model.tokenize(shown)])
            if len(self.cores) < _CACHE_WORDS:
                self.cores[part] = value
        return value

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        chunks = text.split() if not _ODD_SPACE.search(text) else [c for c in _SPACES.split(text) if c]
        return b"".join(map(self.__getitem__, chunks))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(path)


def tokenised_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of docs (doc_id, text): doc_id, piece, start, length, ids_crc32, and ids if asked for. No shuffle."""
    small_batches(docs.sparkSession)
    path = path or tokenizer_path()
    schema = T.StructType([*docs.select("doc_id").schema.fields, *T.StructType.fromDDL(
        "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, width = word_ids(path), np.array([END_ID], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = words.of(text) + end
                for k in range(0, len(data), width):
                    part = data[k:k + width]
                    rows.append(row)
                    piece.append(k // width)
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placed in the order given. All lengths must be 1 to capacity."""
    count = np.zeros(capacity + 1, np.int64)               # open bins by gap
    bins: dict[int, list[int]] = {}                        # and which they are
    where, offset, opened = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for k, s in enumerate(lengths.tolist()):
        # Change of the sum of squares, halved, if a bin of gap s, s + 1, .. capacity - 1 takes the piece
        cost = np.where(count[s:capacity] > 0, count[:capacity - s] - count[s:capacity] + 1.0, np.inf)
        if s < capacity and count[s]:
            cost[0] = 0.5 - count[s]                       # filled bins no longer count
        fresh = count[capacity - s] + 0.5 if s < capacity else 0.0
        best = int(cost.argmin()) if len(cost) else 0
        if len(cost) and cost[best] <= fresh:
            gap = s + best
            chosen = bins[gap].pop()
            count[gap] -= 1
        else:
            gap, chosen, opened = capacity, opened, opened + 1
        where[k], offset[k] = chosen, capacity - gap
        if gap > s:
            bins.setdefault(gap - s, []).append(chosen)
            count[gap - s] += 1
    return where, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ..), which must be a stored table: it is counted first."""
    groups = max(1, -(-pieces.count() // group_pieces))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    columns = pieces.columns

    def one(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.drop(columns="_group").sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        where, offset = sum_of_squares(batch["length"].to_numpy(), capacity)
        return batch.assign(sequence_id=(int(key[0]) << 32) + where, offset=offset)

    grouped = pieces.select(*columns, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("_group"))
    return grouped.groupBy("_group").applyInPandas(one, schema)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: every piece of the documents with its sequence and place."""
    return pack(materialize(tokenised_pieces(docs), "pieces"))


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_stage(spark, table(spark, sf_dir, "documents", "doc_id", "text"), sf_dir)
