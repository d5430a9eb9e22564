"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over all texts (its size is that of the
   alphabet, not of the corpus).
2. Disguised stretches of a text (symbols or digits in words, letters set apart,
   letters repeated, or these mixed) become lattices: a symbol may stand for
   letters, a separator for nothing, a repeated letter for one.  Viterbi decoding
   under the character model picks the likeliest reading.  Other words are read as
   they are; a word of letters with doubled ones is read both ways, as many
   ordinary words have them.
3. A lexicon of words and word starts is learned from the restored texts of a
   bounded sample of labelled rows; the score is a noisy-or over the entries a
   restored text holds.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import table

TRAIN_ROWS = 30_000  # labelled rows the lexicon is learned from, at most
MIN_SUPPORT = 3  # toxic rows, copies counted once, that an entry needs
MAX_CLEAN = 0.05  # clean rows that an entry may be in, as a share of its support
SHRINK = 5.0  # rows at the base rate that each entry's precision is mixed with
STARTS = (4, 5, 6)  # lengths of word starts, in bytes

# What a symbol or digit may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c",
}
SEPARATORS = " .-_*~'\t\n\r\x0b\x0c"

_CLASSES = 28  # boundary, a to z, other letters
_KIND = np.zeros(256, np.int64)
_KIND[97:123] = _KIND[65:91] = np.arange(1, 27)
_KIND[128:] = 27
_SIGN = np.isin(np.arange(256), [ord(c) for c in STANDS_FOR])
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_BETWEEN = np.isin(np.arange(256), [ord(c) for c in SEPARATORS[1:7]])
_BLANK = bytes(c if _KIND[c] else 32 for c in range(256))
_PLAIN = re.compile(rb"(?:([a-z])(?!\1\1)|[\x80-\xff])+")  # letters, none three times in a row


def disguised(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of lower-cased texts that have another reading.

    Words of letters with a sign or digit beside one, with a separator between
    letters, signs or digits, or with a letter twice in a row; and spaced runs:
    three or more words of one letter, sign or digit, at least one a letter, with
    separators beside or between them.
    """
    if not len(begin):
        return []
    letter, sign, between = _KIND[data] > 0, _SIGN[data], _BETWEEN[data]
    core = letter | sign
    inner = np.ones(len(data), bool)  # bytes with another of their word before
    inner[begin] = False
    mark = np.zeros(len(data), bool)
    if len(data) > 1:
        mark[1:] = inner[1:] & (
            (sign[:-1] & letter[1:]) | (letter[:-1] & sign[1:]) | (letter[1:] & (data[1:] < 128) & (data[1:] == data[:-1]))
        )
    if len(data) > 2:
        mark[1:-1] |= inner[1:-1] & inner[2:] & between[1:-1] & core[:-2] & core[2:]

    def upto(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(x)])

    letters, cores, others = upto(letter), upto(core), upto(~core & ~between)
    marks, calls = upto(mark), upto(data == ord("!"))
    # other bytes at a word's ends stay out
    place = np.arange(len(data))
    low = np.minimum(np.minimum.accumulate(np.where(core, place, len(data))[::-1])[::-1][begin], end)
    high = np.maximum(np.maximum.accumulate(np.where(core, place + 1, 0))[end - 1], begin)
    n, called = cores[end] - cores[begin], calls[end] - calls[begin]
    has = letters[end] > letters[begin]
    odd = (marks[end] > marks[begin]) & has
    unit = (n == 1) | (n - called == 1)
    one = unit | ((n == 0) & (others[end] == others[begin]))
    opens, closes = unit & (others[low] > others[begin]), unit & (others[end] > others[high])
    start = one & opens
    start[0] = one[0]
    start[1:] |= one[1:] & (~one[:-1] | closes[:-1])
    head = first[:-1][first[:-1] < len(one)]
    start[head] |= one[head]
    run = np.cumsum(start) * one
    apart = one & (np.bincount(run, unit)[run] >= 3) & (np.bincount(run, has)[run] >= 1)
    out = [(int(low[k]), int(high[k])) for k in np.flatnonzero(odd & ~apart)]
    own = np.flatnonzero(apart & unit)
    if len(own):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], run[own], [-1]])))
        out += [(int(low[own[a]]), int(high[own[b - 1]])) for a, b in zip(edge[:-1], edge[1:])]
    return sorted(out)


def _kind(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c.isspace() else 27


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a task."""
    total = np.zeros(_CLASSES**3, np.int64)
    for batch in batches:
        for _, data, offsets in tokens.blocks(batch.column(0)):
            kinds = _KIND[data]
            kinds[offsets[1:-1][offsets[1:-1] < len(kinds)]] = 0  # texts are apart
            total += np.bincount(
                (kinds[:-2] * _CLASSES + kinds[1:-1]) * _CLASSES + kinds[2:] if len(kinds) > 2 else kinds[:0], minlength=len(total)
            )
    some = np.flatnonzero(total)
    yield pa.record_batch({"gram": pa.array(some), "n": pa.array(total[some])})


class Restorer:
    """Viterbi decoding of disguised stretches under a character trigram model."""

    # Channel costs (negative logs): a second and a further equal letter kept or dropped, a sign
    # read as a letter or as a gap, a separator dropped or kept, an exclamation mark at the end
    # read as one.
    SECOND, SECOND_GONE, FURTHER, FURTHER_GONE = 0.5, 1.0, 4.0, 0.1
    SIGN, SIGN_APART, JOIN, APART, CALL = 0.7, 7.0, 0.3, 2.0, 0.3
    REMEMBERED = 50_000

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(_CLASSES, _CLASSES, _CLASSES).astype(np.float64)
        single = cube.sum((0, 1)) + 1.0
        single /= single.sum()
        double = cube.sum(0) + 5.0 * single
        double /= double.sum(1, keepdims=True)
        triple = cube + 5.0 * double[None]
        self.cost = (-np.log(triple / triple.sum(2, keepdims=True))).tolist()
        self.known: dict[str, str] = {}

    def _choices(self, text: str, i: int) -> list[tuple[str, float]]:
        c = text[i]
        if c in SEPARATORS:
            return [("", self.JOIN), (" ", self.APART)]
        if c in STANDS_FOR:
            called = c == "!" and text[i + 1 : i + 2] in ("", "!")
            return [(x, self.SIGN) for x in STANDS_FOR[c]] + [(" ", self.CALL if called else self.SIGN_APART)]
        if not i or text[i - 1] != c:
            return [(c, 0.0)]
        if i > 1 and text[i - 2] == c:
            return [(c, self.FURTHER), ("", self.FURTHER_GONE)]
        return [(c, self.SECOND), ("", self.SECOND_GONE)]

    def decode(self, text: str) -> str:
        """The likeliest reading of a lower-cased stretch."""
        paths: list[tuple[int, str]] = [(-1, "")]  # back pointers and what was read
        states = {(0, 0): (0.0, 0)}
        for i in range(len(text)):
            new: dict[tuple[int, int], tuple[float, int]] = {}
            read = {}
            for (a, b), (cost, path) in states.items():
                row = self.cost[a][b]
                for out, channel in self._choices(text, i):
                    if not out or (out == " " and b == 0):
                        to, all_ = (a, b), cost + channel
                    else:
                        k = _kind(out)
                        to, all_ = (b, k), cost + channel + row[k]
                    if to not in new or all_ < new[to][0]:
                        new[to] = (all_, path)
                        read[to] = out
            states = {}
            for to, (cost, path) in new.items():
                paths.append((path, read[to]))
                states[to] = (cost, len(paths) - 1)
        best = min((cost + self.cost[a][b][0], path) for (a, b), (cost, path) in states.items())[1]
        out = []
        while best > 0:
            best, c = paths[best]
            out.append(c)
        return "".join(reversed(out))

    def _known(self, stretch: bytes) -> bytes:
        got = self.known.get(stretch)
        if got is None:
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            got = self.decode(stretch.decode(errors="ignore")).encode()
            plain = stretch.rstrip(b"!")
            if got.strip() != plain and _PLAIN.fullmatch(plain):
                got = plain + b" " + got
            got = self.known[stretch] = b" " + got + b" "
        return got

    def restored(self, column: pa.Array) -> Iterator[list[bytes]]:
        """The words of each text, A-Z lower-cased, with its disguised stretches decoded."""
        for _, data, offsets in tokens.blocks(column):
            data = tokens._LOWER[data]
            begin, end, first = tokens.spans(data, offsets)
            raw, stretches, k = data.tobytes(), disguised(data, begin, end, first), 0
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                parts = []
                while k < len(stretches) and stretches[k][0] < b:
                    lo, hi = stretches[k]
                    parts += [raw[a:lo], self._known(raw[lo:hi])]
                    a, k = hi, k + 1
                parts.append(raw[a:b])
                yield b"".join(parts).translate(_BLANK).split()


def _entries(word: bytes) -> Iterable[bytes]:
    """What a word can match: its starts, and itself."""
    yield word + b"$"
    for n in STARTS:
        if len(word) >= n:
            yield word[:n]


def _evidence(cost_counts: np.ndarray, apart: bool):
    """(entry, context, sketch, toxic, n) of labelled texts: each entry once a text, ``apart`` with
    its least context; the sketch is the text's least word hash.  Copies mostly share both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(cost_counts)
        found: dict[tuple[bytes, int, int, int], int] = defaultdict(int)
        for batch in batches:
            for text, toxic in zip(restorer.restored(batch.column(0)), batch.column(1).to_pylist()):
                own: dict[bytes, int] = {}
                sketch = min(map(zlib.crc32, text), default=0) if apart else 0
                before = b""
                for word in text:
                    if len(word) > 2:
                        context = zlib.crc32(before + b" " + word) if apart else 0
                        for entry in _entries(word):
                            own[entry] = min(own.get(entry, 1 << 62), context)
                    before = word
                for entry, context in own.items():
                    found[entry, context, sketch, toxic] += 1
            if len(found) > 200_000:
                yield _flush(found)
        yield _flush(found)

    def _flush(found: dict) -> pa.RecordBatch:
        rows = list(found.items())
        found.clear()
        return pa.record_batch(
            {
                "entry": pa.array([k[0] for k, _ in rows], pa.binary()), "context": pa.array([k[1] for k, _ in rows], pa.int64()),
                "sketch": pa.array([k[2] for k, _ in rows], pa.int64()), "toxic": pa.array([k[3] for k, _ in rows], pa.int32()), "n": pa.array([n for _, n in rows], pa.int64()),
            }
        )

    return run


def _scores(counts: np.ndarray, lexicon: dict[bytes, float], base: float):
    starts = frozenset(entry[: STARTS[0]].rstrip(b"$") for entry in lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(counts)
        seen: dict[bytes, tuple[float, bytes]] = {}
        for batch in batches:
            out = []
            for text in restorer.restored(batch.column(1)):
                best: dict[bytes, float] = {}
                for word in set(text):
                    if word[: STARTS[0]] in starts:
                        if word not in seen:
                            if len(seen) > 100_000:
                                seen.clear()
                            seen[word] = max(((lexicon.get(e, 0.0), e) for e in _entries(word)))
                        weight, entry = seen[word]
                        if weight:
                            best[entry] = weight
                rest = 1.0 - base
                for entry in sorted(best):
                    rest *= 1.0 - best[entry]
                out.append(1.0 - rest)
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(out, pa.float64())})

    return run


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """Scores every whole text: doc_id, held_out, score (0 to 1), predicted.

    Labels are learned from at most ``TRAIN_ROWS`` labelled rows (those with the
    least hashes) with crc32(doc_id as text) mod 3 other than 1; held_out says that
    the remainder is 1.  Only texts enter a score.  A null or empty text has no
    evidence and the lowest score.  One row per input row, repeated rows
    included; a null doc_id is scored and not held out.  Without labels every score is
    0.  Null labels are ignored, and the larger of several for a doc_id counts.  Other
    columns are ignored; an empty table gives no rows.
    """
    fold = F.crc32(F.col(id_col).cast("long").cast("string")) % 3
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    grams = texts.select("text").mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(_CLASSES**3, np.int64)
    for row in grams.collect():  # at most 28**3 rows
        counts[row.gram] = row.n

    sample = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .where((fold != 1) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    )
    sample = table(sample)
    known = table(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic"))
    size = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    base = size.toxic / size.n if size.n else 0.0
    schema = "entry binary, context long, sketch long, toxic int, n long"
    support = (
        known.where("toxic = 1").mapInArrow(_evidence(counts, True), schema)
        .groupBy("entry").agg(F.least(F.count_distinct("context"), F.count_distinct("sketch")).alias("support")).where(F.col("support") >= MIN_SUPPORT)
    )
    clean = known.where("toxic = 0").mapInArrow(_evidence(counts, False), schema).groupBy("entry").agg(F.sum("n").alias("clean"))
    clean = support.join(clean, "entry", "left").select("entry", "support", F.coalesce("clean", F.lit(0)).alias("clean"))
    precise = clean.withColumn("p", (F.col("support") + SHRINK * base) / (F.col("support") + F.col("clean") + SHRINK))
    held = precise.where((F.col("p") > 0.5) & (F.col("clean") <= MAX_CLEAN * F.col("support"))).select("entry", "p").collect()
    lexicon = {bytes(row.entry): row.p for row in held}  # at most the entries of the toxic rows among TRAIN_ROWS
    return texts.mapInArrow(_scores(counts, lexicon, 0.1 * base), "doc_id long, score double").select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
