"""URL rules as one bit-parallel wildcard automaton.

All globs are packed into the bits of a few 64-bit words, one bit for each state.
A step of the extended Shift-And simulation handles every glob at once: a state
moves on where its next byte fits (mask ``move``) and stays where it stands on a
wildcard (mask ``stay``).  Tasks run it over many URLs side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOST_END = 0xFF  # no byte of UTF-8
LANES = 8192  # URLs worked on side by side


class Rule(NamedTuple):
    verdict: str
    host: str  # this host and its subdomains; "*" and "?" are wildcards
    path: str  # what the path starts with; "*" and "?" are wildcards


class Automaton:
    """Globs over the canonical form ``.host``, HOST_END, ``path``."""

    def __init__(self, rules: Sequence[Rule]):
        states: list[tuple[set[int], set[int]]] = []  # bytes a state is entered by, bytes it stays on
        self.first, self.last = [], []
        inner, outer = set(range(256)) - {HOST_END}, set(range(256))
        for rule in rules:
            self.first.append(len(states))
            states.append((set(), inner))  # anything before the rule's host
            for place, glob in ((inner, b"." + rule.host.encode()), (None, bytes([HOST_END])), (inner, rule.path.encode())):
                for c in glob:
                    if place is not None and c == ord("*"):
                        states[-1] = (states[-1][0], inner)
                    else:
                        states.append((inner if place is not None and c == ord("?") else {c}, set()))
            states[-1] = (states[-1][0], outer)  # anything after the rule's path
            self.last.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.move = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for k, (enter, stay) in enumerate(states):
            bit = np.uint64(1 << (k & 63))
            for masks, on in ((self.move, enter), (self.stay, stay)):
                for c in on:
                    masks[c, k >> 6] |= bit
        for k in self.first:
            self.start[k >> 6] |= np.uint64(1 << (k & 63))

    def match(self, urls: list[bytes]) -> np.ndarray:
        """Whether each URL (rows) fits each rule (columns)."""
        out = np.zeros((len(urls), len(self.last)), bool)
        order = sorted(range(len(urls)), key=lambda k: -len(urls[k]))
        for lo in range(0, len(order), LANES):
            self._lanes(urls, order[lo : lo + LANES], out)
        return out

    def _lanes(self, urls: list[bytes], lanes: list[int], out: np.ndarray) -> None:
        length = np.array([len(urls[k]) for k in lanes])
        begin = np.cumsum(length) - length
        data = np.frombuffer(b"".join([urls[k] for k in lanes]) or b"\0", np.uint8)
        state = np.tile(self.start, (len(lanes), 1))
        carry = np.zeros_like(state)
        for j in range(int(length.max(initial=0))):
            n = int(np.searchsorted(-length, -j))  # lanes that are longer than j come first
            c, now = data[begin[:n] + j], state[:n]
            if self.words > 1:
                carry[:n, 1:] = now[:, :-1] >> np.uint64(63)
            state[:n] = ((now << np.uint64(1) | carry[:n]) & self.move[c]) | (now & self.stay[c])
        for r, k in enumerate(self.last):
            out[lanes, r] = (state[:, k >> 6] >> np.uint64(k & 63)) & np.uint64(1) == 1


def url_filter(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """The longest rule that fits each URL: page_id, host, path, rule, verdict.

    Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: what follows up to ``?``, ``#`` or the end.  Both are empty
    for a null URL or one without ``://``.  A rule fits its host and all subdomains
    where the path starts with the rule's path.  The longest rule text wins, of
    equal ones the first; without any, rule is null and ``default`` the verdict.
    One row per input row, repeated rows and null ids included; other columns are
    ignored; URLs of any length are read whole; an empty table gives no rows.
    """
    automaton = Automaton(rules)
    best = sorted(range(len(rules)), key=lambda k: -len(rules[k].host + rules[k].path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([rules[k].host + rules[k].path for k in best] + [None], pa.string())
        verdicts = pa.array([rules[k].verdict for k in best] + [default], pa.string())
        for batch in batches:
            host, path = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("host", "path"))
            fits = automaton.match([b"." + h + bytes([HOST_END]) + p for h, p in zip(host, path)])[:, best]
            fits = np.hstack([fits, np.ones((len(fits), 1), bool)])
            first = pa.array(fits.argmax(axis=1))
            yield pa.record_batch(
                [*(batch.column(k) for k in range(3)), names.take(first), verdicts.take(first)],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    url, upper = F.col(url_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower()).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
    ).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
