"""Vectorised word tools for tasks: words, word hashes and shingle hashes.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text.  Texts
reach Python as Arrow binaries and are worked on in blocks of ``BLOCK`` bytes
(a longer text is a block of its own), so a task's memory follows its longest
text and not its partition.  All hashes are 64-bit polynomials modulo 2**64,
mixed by a fixed finaliser; they depend on the bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base ("up") or of its inverse ("down")."""
    if len(_powers[kind]) < n:
        steps = np.full(max(n, BLOCK + 1), _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64's constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of a binary column; a null is empty."""
    array = column.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    n = len(array)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each text's first word (one more entry than texts)."""
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    starts[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, offsets)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """The hash of each span of bytes; ``values``, one for each byte, gives another hash."""
    total = np.zeros(len(data) + 1, np.uint64)
    each = data.astype(np.uint64) + np.uint64(1) if values is None else values[data]
    np.cumsum(each * _power("up", len(data) + 1)[: len(data)], out=total[1:])
    return mix((total[end] - total[begin]) * _power("down", len(data) + 1)[begin])


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the index of each text's first word; ``lower`` folds A-Z first."""
    data = _LOWER[data] if lower else data
    begin, end, first = spans(data, offsets)
    return span_hashes(data, begin, end), first


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of each run of ``size`` consecutive word hashes (also of runs across texts)."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    if seed:
        hashes = mix(hashes ^ np.uint64(seed))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _power("up", n + 1)[:n], out=total[1:])
    return mix((total[size:] - total[:-size]) * _power("down", n + 1)[: n - size + 1])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, lower-cased: (values, first index of each text).

    A text of fewer than ``size`` words, but at least one, has its whole word
    sequence as its only shingle; a text without words has none.  Values are
    sorted within a text.
    """
    words, first = word_hashes(data, offsets, lower=True)
    runs = windows(words, size)
    counts = np.diff(first)
    out = []
    for k, n in enumerate(counts):
        a = first[k]
        if n >= size:
            own = np.sort(runs[a : a + n - size + 1])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
        elif n:
            out.append(windows(words[a : a + n], int(n), seed=int(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    at = np.zeros(len(out) + 1, np.int64)
    np.cumsum([len(x) for x in out], out=at[1:])
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
