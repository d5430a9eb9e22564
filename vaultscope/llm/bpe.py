"""Byte-level BPE with a hierarchical-bitmap rank queue.

A piece is a linked list of its bytes.  For each merge rank a bucket holds the
list positions whose pair has that rank; a bitmap in two levels, words of 256 ranks
and one bit for each word, says which buckets have entries.  Find-first-set on the levels
gives the lowest rank in a few steps however long the piece is; an entry whose
pair has changed since is stale and skipped.
"""

from __future__ import annotations

import base64
import uuid
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE = 500_000  # pieces of a worker's newer half of remembered pieces
FLUSH = 1 << 20  # ids of an Arrow batch, or one text's if more

# The characters of the Unicode property White_Space.
WHITE_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def bitmap_words(ranks: dict[bytes, int]) -> int:
    """Words of 256 ranks that a vocabulary needs."""
    return (max(ranks.values(), default=0) >> 8) + 1


def encode_piece(piece: bytes, ranks: dict[bytes, int], size: int) -> array:
    """The ids of one pre-token; ``size`` is :func:`bitmap_words` of the ranks.

    The queue is written out in place: most pieces are short, and calls would cost
    more than the work.
    """
    rank_of = ranks.get
    whole = rank_of(piece)
    if whole is not None:
        return array("i", [whole])
    n = len(piece)
    after = list(range(1, n + 2))  # where the part that starts here ends
    before = list(range(-1, n))
    pair = [-1] * (n + 1)  # the rank of the pair that starts here
    buckets: dict[int, list[int]] = {}  # positions by rank, as heaps
    words = [0] * size  # bit r of word w: bucket w * 256 + r has entries
    top = 0  # bit w: word w has bits
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            pair[i] = rank
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                words[rank >> 8] |= 1 << (rank & 255)
                top |= 1 << (rank >> 8)
    while top:
        word = (top & -top).bit_length() - 1
        bits = words[word]
        rank = word << 8 | (bits & -bits).bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket[0]
            del buckets[rank]
            bits &= bits - 1
            words[word] = bits
            if not bits:
                top &= top - 1
        if pair[i] != rank:
            continue  # stale
        middle = after[i]
        end = after[i] = after[middle]
        before[end] = i
        pair[middle] = pair[i] = -1
        # the pairs that now start at this part and at the one before it
        for j, stop in ((before[i], end), (i, after[end])) if end < n else ((before[i], end),):
            if j >= 0:
                rank = rank_of(piece[j:stop])
                if rank is None:
                    pair[j] = -1
                else:
                    pair[j] = rank
                    if rank in buckets:
                        heappush(buckets[rank], j)
                    else:
                        buckets[rank] = [j]
                        words[rank >> 8] |= 1 << (rank & 255)
                        top |= 1 << (rank >> 8)
    ids, i = array("i"), 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def splitter(pattern: str) -> regex.Pattern:
    """``pattern`` with white space as the Unicode property, as tiktoken's engine has it."""
    pattern = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\S", f"[^{WHITE_SPACE}]")
    return regex.compile(pattern.replace(r"\s", f"[{WHITE_SPACE}]"))


class Encoder:
    """Text to ids; remembers recent pieces, in two halves of ``CACHE`` pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.size, self.split = ranks, bitmap_words(ranks), splitter(pattern)
        self.new: dict[str, bytes] = {}  # ids as 32-bit integers
        self.old: dict[str, bytes] = {}

    def _miss(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = encode_piece(piece.encode(), self.ranks, self.size).tobytes()
        if len(piece) <= 64:
            if len(self.new) >= CACHE:
                self.old, self.new = self.new, {}
            self.new[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        known, miss = self.new.get, self._miss
        return np.frombuffer(b"".join([known(piece) or miss(piece) for piece in self.split.findall(text)]), np.int32)


_encoders: dict[str, Encoder] = {}


def _encoder(call: str, ranks: Broadcast, pattern: str) -> Encoder:
    """The worker's encoder for one call of :func:`encode`; it outlives a task, so that later tasks know the pieces."""
    if call not in _encoders:
        _encoders.clear()
        _encoders[call] = Encoder(ranks.value, pattern)
    return _encoders[call]


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: base64 of the bytes, a space and the rank, on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _ids(texts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, texts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*texts, np.zeros(0, np.int32)])))


class Decoder:
    """Ids to bytes, many texts at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.length = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)
        self.start = np.cumsum(np.maximum(self.length, 0)) - np.maximum(self.length, 0)
        self.data = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where each text's bytes begin (one more entry than texts)."""
        length = self.length[ids]
        if (length < 0).any():
            raise ValueError("an id is outside the vocabulary")
        end = np.concatenate([[0], np.cumsum(length)])
        at = np.repeat(self.start[ids] - end[:-1], length) + np.arange(end[-1])
        return self.data[at], end[offsets]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Byte-level BPE ids of every whole text: doc_id, ids (array of int).

    ``ranks_path`` is a tiktoken rank file, read by the driver and sent to the
    tasks (its size is the vocabulary's); ``pattern`` splits a text into pieces that
    are encoded separately.  There are no special tokens.  A null or empty text has
    no ids.  One row per input row, repeated rows and null ids included; other
    columns are ignored and an empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    call = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(call, ranks, pattern)
        for batch in batches:
            done, size, first = [], 0, 0
            for k, text in enumerate(batch.column(1)):
                done.append(encoder.encode(text.as_py() or ""))
                size += len(done[-1])
                if size >= FLUSH or k == batch.num_rows - 1:
                    yield pa.record_batch({"doc_id": batch.column(0).slice(first, len(done)), "ids": _ids(done)})
                    done, size, first = [], 0, k + 1

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The bytes of the ids: doc_id, ids, bytes.  Null ids give no bytes; an id outside the vocabulary is an error."""
    spark: SparkSession = encoded.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks.value)
        for batch in batches:
            first = 0
            while first < batch.num_rows:  # about FLUSH ids at a time
                ends = np.cumsum(pc.list_value_length(batch.column(1).slice(first)).fill_null(0).to_numpy())
                n = max(1, int(np.searchsorted(ends, FLUSH, side="right")))
                flat = batch.column(1).slice(first, n).flatten().to_numpy()
                data, at = decoder.decode(flat, np.concatenate([[0], ends[:n]]))
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
                part = batch.slice(first, n)
                yield pa.record_batch({"doc_id": part.column(0), "ids": part.column(1), "bytes": raw.cast(pa.binary())})
                first += n

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, bytes binary")
