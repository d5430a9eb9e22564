"""Line dedup with a sharded minimal perfect hash.

1. Documents emit the hashes of their distinct line keys; a pre-aggregated count
   keeps the lines found in enough documents, with count and largest doc_id.
2. Those hashes are cut into shards of about ``SHARD`` keys.  One task per shard
   builds a minimal perfect hash (levels of bitmaps: a key stays on the first
   level where it has a bit for itself, its slot is the rank of that bit) and
   fills compact arrays by slot: fingerprint, count, largest doc_id.
3. The documents' line hashes are sent to the shards, salted by document so that
   a line held by a third of all documents is spread, and probe the arrays in a
   stream: a task holds one shard at a time and never a group of probes.
4. Only the removed hashes of a document go back to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import table

SHARD = 16384
SALTS = 16
_LEVELS = 48
_OTHER = tokens.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks = []
        total = 0
        for bits in levels:
            ones = np.cumsum(np.bitwise_count(bits).astype(np.int64))
            self.ranks.append(np.concatenate([[0], ones[:-1]]) + total)
            total += int(ones[-1])
        self.placed = total

    @staticmethod
    def _place(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        return tokens.mix(keys + np.uint64((level + 1) * 0xD1342543DE82EF95 % 2**64)) % np.uint64(words * 64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Two bits a key on each level; keys that share a bit go to the next one.
        What the last level leaves is kept sorted."""
        levels = []
        while len(keys) and len(levels) < _LEVELS:
            words = max(1, -(-2 * len(keys) // 64))
            at = cls._place(keys, len(levels), words)
            alone = np.bincount(at.astype(np.int64), minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at]]
        return cls(levels, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key of the set, from 0 without gaps; any slot or -1 for other keys."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = self._place(keys[open_], level, len(bits))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = ranks[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            k = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            out[open_] = np.where(self.rest[k] == keys[open_], self.placed + k, -1)
        return out


def pack(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray, last: np.ndarray) -> bytes:
    """A shard: the hash's levels and the arrays by slot, as one run of 64-bit values."""
    index = PerfectHash.build(keys)
    slot = index.slots(keys)
    arrays = []
    for values in (prints, counts, last):
        own = np.empty(len(keys), np.uint64)
        own[slot] = values.view(np.uint64)
        arrays.append(own)
    head = np.array([len(index.levels), len(index.rest), len(keys), *map(len, index.levels)], np.uint64)
    return np.concatenate([head, *index.levels, index.rest, *arrays]).tobytes()


def unpack(blob: bytes) -> tuple[PerfectHash, np.ndarray, np.ndarray, np.ndarray]:
    values = np.frombuffer(blob, np.uint64)
    n_levels, n_rest, n = map(int, values[:3])
    cuts = np.cumsum([3 + n_levels, *map(int, values[3 : 3 + n_levels]), n_rest, n, n])
    parts = np.split(values, cuts)
    return PerfectHash(parts[1 : 1 + n_levels], parts[1 + n_levels]), parts[-3], parts[-2].view(np.int64), parts[-1].view(np.int64)


def _lines(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(start, end, index of each text's first line, h1, h2, whether long enough) of all lines."""
    breaks = np.flatnonzero(data == 10)
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    n = np.searchsorted(breaks, offsets)
    first = n + np.arange(len(offsets))
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1] + 1
    starts[first[:-1]] = offsets[:-1]
    lower = tokens._LOWER[data]
    solid = np.flatnonzero(~tokens._SPACE[data])
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    some = hi >= lo
    begin, end = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    begin[some], end[some] = solid[lo[some]], solid[hi[some]] + 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    long = points[end] - points[begin] >= least
    h1, h2 = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    if long.any():
        h1[long] = tokens.span_hashes(lower, begin[long], end[long])
        h2[long] = tokens.span_hashes(lower, begin[long], end[long], _OTHER)
    return starts, ends, first, h1, h2, long


def _emit(least: int):
    """(doc, h1, h2) of the distinct long lines of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, data, offsets in tokens.blocks(batch.column(1)):
                _, _, first, h1, h2, long = _lines(data, offsets, least)
                owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[long]
                h1, h2 = h1[long], h2[long]
                order = np.lexsort((h2, h1, owner))
                owner, h1, h2 = owner[order], h1[order], h2[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                yield pa.record_batch(
                    {
                        "doc": pa.array(ids[row + owner[new]]),
                        "h1": pa.array(tokens.signed(h1[new])),
                        "h2": pa.array(tokens.signed(h2[new])),
                    }
                )

    return run


def _index(shard: pa.Table) -> pa.Table:
    h1, h2, count, last = (shard[c].to_numpy() for c in ("h1", "h2", "docs", "last"))
    blob = pack(h1.view(np.uint64), h2.view(np.uint64), count, last)
    return pa.table({"shard": shard["shard"][:1], "blob": pa.array([blob], pa.binary())})


def _probe(min_docs: int):
    """Rows ordered by (shard, salt, kind): each index row is followed by its probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            heads = np.flatnonzero(batch.column("kind").to_numpy() == 0)
            doc, h1, h2 = (batch.column(c).fill_null(0).to_numpy() for c in ("doc", "h1", "h2"))
            for lo, hi in zip([0, *(heads + 1)], [*heads, batch.num_rows]):
                if hi > lo and index is not None:
                    keys, prints = h1[lo:hi], h2[lo:hi].view(np.uint64)
                    mph, fingerprint, count, last = index
                    slot = mph.slots(keys.view(np.uint64))
                    gone = (slot >= 0) & (fingerprint[slot] == prints) & (count[slot] >= min_docs)
                    gone &= last[slot] != doc[lo:hi]
                    yield pa.record_batch({"doc": pa.array(doc[lo:hi][gone]), "h1": pa.array(keys[gone])})
                if hi < batch.num_rows:
                    index = unpack(batch.column("blob")[int(hi)].as_py())

    return run


def _clean(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch.column(2)
            for row, data, offsets in tokens.blocks(batch.column(1)):
                count = len(offsets) - 1
                starts, ends, first, h1, _, long = _lines(data, offsets, least)
                dropped, texts = np.zeros(count, np.int64), []
                for k in range(count):
                    lo, hi = first[k], first[k + 1]
                    own = drops[row + k]
                    raw = data[offsets[k] : offsets[k + 1]].tobytes()
                    if own.is_valid and len(own.values):
                        gone = long[lo:hi] & np.isin(tokens.signed(h1[lo:hi].copy()), own.values.to_numpy())
                        dropped[k] = gone.sum()
                        keep = np.flatnonzero(~gone) + lo
                        raw = b"\n".join([data[a:b].tobytes() for a, b in zip(starts[keep], ends[keep])])
                    texts.append(raw)
                yield pa.record_batch(
                    {
                        "row": batch.column(0).slice(row, count),
                        "text": pa.array(texts, pa.binary()),
                        "n_lines": pa.array(np.diff(first).astype(np.int64)),
                        "n_dropped": pa.array(dropped),
                    }
                )

    return run


def _gone(texts: DataFrame, least: int, min_docs: int) -> DataFrame:
    """(doc, gone): the line hashes that each (doc_id, text) loses."""
    lines = texts.where("doc_id is not null").mapInArrow(_emit(least), "doc long, h1 long, h2 long")
    common = table(
        lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last")).where(F.col("docs") >= min_docs)
    )
    shards = -(-common.count() // SHARD) or 1
    shard = F.pmod("h1", F.lit(shards)).alias("shard")
    index = (
        common.select(shard, "h1", "h2", "docs", "last").groupBy("shard").applyInArrow(_index, "shard long, blob binary")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        .select("shard", "salt", F.lit(0).alias("kind"), "blob", *(F.lit(None).cast("long").alias(c) for c in ("doc", "h1", "h2")))
    )
    probes = lines.select(
        shard, F.pmod(F.xxhash64("doc"), F.lit(SALTS)).alias("salt"), F.lit(1).alias("kind"),
        F.lit(None).cast("binary").alias("blob"), "doc", "h1", "h2",
    )
    gone = (
        index.union(probes).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        .mapInArrow(_probe(min_docs), "doc long, h1 long")
    )
    return table(gone.groupBy("doc").agg(F.collect_set("h1").alias("gone")))


def _cleaned(docs: DataFrame, row: Column, least: int, min_docs: int, id_col: str, text_col: str) -> DataFrame:
    """(row, text, n_lines, n_dropped); ``row`` is carried along."""
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("binary")
    gone = _gone(docs.select(doc_id.alias("doc_id"), text.alias("text")), least, min_docs)
    rows = docs.select(row.alias("row"), text.alias("text"), doc_id.alias("doc_id"))
    kind = rows.schema["row"].dataType.simpleString()
    return (
        rows.join(gone.hint("shuffle_hash"), F.col("doc_id") == F.col("doc"), "left").select("row", "text", "gone")
        .mapInArrow(_clean(least), f"row {kind}, text binary, n_lines long, n_dropped long")
    )


def line_dedup(
    docs: DataFrame, least: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Drop lines that many documents share, except in the largest doc_id holding them.

    Texts are split at newlines; a line's key is the line without ``[\\x20\\x09-\\x0D]``
    at both ends, A-Z lower-cased.  Keys of at least ``least`` code points found in
    at least ``min_docs`` documents lose all their lines but in the largest doc_id.
    Returns one row per input row: doc_id, text (what stays, joined by newlines),
    n_lines (before) and n_dropped.  A null or empty text is one empty line and
    comes back empty.  Rows with the same doc_id count as a document each and, where
    it is the largest, all keep the line.  A row with a null doc_id neither counts
    nor loses lines.  Other columns are ignored; an empty table gives no rows.
    """
    return _cleaned(docs, F.col(id_col).cast("long"), least, min_docs, id_col, text_col).withColumnRenamed("row", "doc_id")


def without_shared_lines(
    docs: DataFrame, least: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with their columns, after :func:`line_dedup`; a null text comes back empty."""
    others = F.struct(F.lit(0).alias("__none"), *(F.col(c) for c in docs.columns if c != text_col))
    rows = _cleaned(docs, others, least, min_docs, id_col, text_col)
    text = F.col("text").cast("string")
    return rows.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
