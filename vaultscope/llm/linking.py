"""Links between sets that share a key, without the pairs of a key's members.

``members`` has rows (key, node).  Two nodes that share a key are compared on their whole
sets; wanted are the connected components of all that reach the similarity.  A key may
hold a large part of all nodes, so its pairs are never rows of a table:

* a key is cut into bands of set sizes, two for each member, so that members whose sizes
  rule the similarity out don't meet; keys with the same members are one key;
* ``STARS`` rounds compare each open key's members with one of them, its head;
* what is still in several components then meets in blocks: members outside the key's
  largest component (strays), ``SIDE`` at a time, with ``SIDE`` members at a time.  Blocks of
  bitmaps first drop members that are like no other; blocks of whole sets then return
  links that join components, fewer than they have members.

Keys of every size go the same way.  A key whose members are mostly connected costs a
few copies of each; one with many strays costs strays times members over ``SIDE``.

The bitmap of a set has a bit for each of its values modulo a power of two.  A bit of one
set that the other's bitmap lacks stands for a value the other set lacks, so too many of
them rule the pair out exactly: no pair at the threshold is ever dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, table

SIDE = 512
STARS = 2


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct values."""
    if not 0 < percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def bitmap(values: np.ndarray) -> np.ndarray:
    """A set's size and, in words of 64 bits, its bitmap of two to four bits a value."""
    bits = max(64, 1 << (2 * len(values) - 1).bit_length())
    at = values & np.uint64(bits - 1)
    words = np.zeros(bits // 64, np.uint64)
    np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return np.concatenate([np.array([len(values)], np.uint64), words])


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (one a row) as those of ``size`` words."""
    return np.bitwise_or.reduce(words.reshape(len(words), -1, size), axis=1)


def _needed(n, m, percent: int):
    """The least number of shared values of sets of n and m values at the threshold."""
    return -(-percent * (n + m) // (100 + percent))


def may_be_alike(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs of bitmaps that don't rule the similarity out."""
    out = np.zeros((len(left), len(right)), bool)
    sizes = [np.array([len(x) - 1 for x in side]) for side in (left, right)]
    for one in np.unique(sizes[0]):
        i = np.flatnonzero(sizes[0] == one)
        for two in (one // 2, one, one * 2):
            j = np.flatnonzero(sizes[1] == two)
            if not len(j):
                continue
            own, other = (np.stack([side[k] for k in at]) for side, at in ((left, i), (right, j)))
            n, m = own[:, 0].astype(np.int64), other[:, 0].astype(np.int64)
            a, b = (folded(x[:, 1:], min(one, two)) for x in (own, other))
            for k in range(len(i)):
                shared = _needed(n[k], m, percent)
                fits = np.flatnonzero(shared <= np.minimum(n[k], m))
                mine = np.bitwise_count(a[k] & ~b[fits]).sum(axis=1, dtype=np.int64)
                theirs = np.bitwise_count(b[fits] & ~a[k]).sum(axis=1, dtype=np.int64)
                out[i[k], j[fits[(mine <= n[k] - shared[fits]) & (theirs <= m[fits] - shared[fits])]]] = True
    return out


def _buffers(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _likely(percent: int):
    """Keep (a, b) whose bitmaps don't rule the similarity out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(_buffers(batch.column("sa")), _buffers(batch.column("sb")))
            keep = [bool(may_be_alike([x], [y], percent)[0, 0]) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _alive(percent: int):
    """key and node of a block's members whose bitmaps leave them a partner in another component."""

    def run(block: pa.Table) -> pa.Table:
        stray, comp = block["stray"].to_numpy(), block["comp"].to_numpy()
        bits = _buffers(block["bits"])
        left, right = np.flatnonzero(stray), np.flatnonzero(~stray)
        may = may_be_alike([bits[k] for k in left], [bits[k] for k in right], percent)
        may &= comp[left][:, None] != comp[right][None, :]
        return block.select(["key", "node"]).take(pa.array(np.concatenate([left[may.any(axis=1)], right[may.any(axis=0)]])))

    return run


def _confirmed(percent: int, possible: Callable | None = None):
    """Keep (a, b) whose sets reach the similarity."""

    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        return (possible is None or bool(possible([x], [y])[0, 0])) and alike(x, y, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(x, y) for x, y in zip(_buffers(batch.column("sa")), _buffers(batch.column("sb")))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _incidence(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, column) of each value that several sets hold, and the number of such columns."""
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    _, column, often = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    common = often > 1
    keep = common[column]
    return row[keep], (np.cumsum(common) - 1)[column[keep]], int(common.sum())


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of values that each set of ``left`` shares with each of ``right``."""
    row, column, width = _incidence([*left, *right])
    n, out = len(left), np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, width, 8192):  # a bounded part of the columns at a time
        own = (column >= lo) & (column < lo + 8192)
        matrix = np.zeros((n + len(right), min(8192, width - lo)), np.float32)
        matrix[row[own], column[own] - lo] = 1
        out += matrix[:n] @ matrix[n:].T
    return out


def block_links(percent: int, possible: Callable | None = None):
    """Links between strays and members of one block: those that join components.

    ``possible`` (left, right) gives the pairs of sets that may be alike at all."""

    def run(block: pa.Table) -> pa.Table:
        stray = block["stray"].to_numpy()
        node, comp = block["node"].to_numpy(), block["comp"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in block["set"]]
        left, right = np.flatnonzero(stray), np.flatnonzero(~stray)
        links = []
        if len(left) and len(right):
            size = np.array([len(s) for s in sets])
            one, two = size[left][:, None], size[right][None, :]
            may = (comp[left][:, None] != comp[right][None, :]) & (100 * np.minimum(one, two) >= percent * np.maximum(one, two))
            if possible is not None and may.any():
                may &= possible([sets[k] for k in left], [sets[k] for k in right])
            if np.count_nonzero(may) > 1000:
                both = shared_counts([sets[k] for k in left], [sets[k] for k in right])
                i, j = np.nonzero(may & (100 * both >= percent * (one + two - both)))
                pairs = ((a, b) for a, b in zip(left[i], right[j]))
            else:
                i, j = np.nonzero(may)
                pairs = ((a, b) for a, b in zip(left[i], right[j]) if joined(comp[a]) != joined(comp[b]) and alike(sets[a], sets[b], percent))
            parent: dict[int, int] = {}

            def joined(c: int) -> int:
                while (up := parent.get(c, c)) != c:
                    parent[c] = parent.get(up, up)
                    c = up
                return c

            for a, b in pairs:
                x, y = joined(comp[a]), joined(comp[b])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((node[a], node[b]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def with_both(pairs: DataFrame, of: DataFrame, column: str) -> DataFrame:
    """(a, b, sa, sb): a column of ``of`` for both nodes of a pair."""
    one = pairs.join(of.select(F.col("node").alias("b"), F.col(column).alias("sb")), "b")
    return one.join(of.select(F.col("node").alias("a"), F.col(column).alias("sa")), "a").select("a", "b", "sa", "sb")


def component_links(
    members: DataFrame,
    nodes: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    percent: int,
    possible: Callable | None = None,
) -> DataFrame:
    """Links (a, b) with the components of all links among nodes that share a key.

    ``members``: key, node, size (of the node's set) and ``weight``; of a key's members the one of the largest weight,
    then the smallest node, is compared first.  ``nodes``: node and bits (:func:`bitmap`).
    ``sets_of`` gives (node, set) of the nodes of a DataFrame, sets as sorted 64-bit values in
    a binary.  ``possible`` (left, right) may rule out pairs of sets before they are compared.
    """
    several = _shared(members)
    # sizes of a link's sets are at most one band apart; the bands are a little wider than that
    band = F.floor(F.log("size") / F.lit(math.log(100 / percent) * (1 + 1e-6)))
    banded = several.select(F.explode(F.array(band, band + 1)).alias("band"), "key", "node", "weight")
    open_ = _distinct_keys(_shared(banded.select(F.xxhash64("key", "band").alias("key"), "node", "weight")))

    links = labels = tried = None
    for _ in range(STARS):
        head = F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("h")
        if labels is None:
            first = open_.groupBy("key").agg(head).select("key", F.col("h.node").alias("head"))
            star = open_.join(first, "key").where("node <> head")
        else:  # the first stray, with all that aren't in its component
            known = open_.join(_main(open_), "key")
            first = known.where("comp <> main").groupBy("key").agg(head).select("key", F.col("h.node").alias("head"))
            own = open_.select("key", F.col("node").alias("head"), F.col("comp").alias("its"))
            star = open_.join(first, "key").join(own, ["key", "head"]).where("comp <> its")
        star = star.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()
        if tried is not None:
            star = star.join(tried, ["a", "b"], "left_anti")
        star = table(star)
        tried = star if tried is None else tried.union(star)
        near = table(with_both(star, nodes, "bits").mapInArrow(_likely(percent), "a long, b long"))
        sets = table(sets_of(near.select(F.col("a").alias("node")).union(near.select("b")).distinct()))
        new = table(with_both(near, sets, "set").mapInArrow(_confirmed(percent, possible), "a long, b long"))
        links = new if links is None else links.union(new)
        labels = components(links)
        known = open_.select("key", "node", "weight").join(labels, "node", "left")
        open_ = _open(known.select("key", "node", "weight", F.coalesce("component", "node").alias("comp")))
        if open_.isEmpty():
            return links

    alive = _grid(open_).join(nodes.select("node", "bits"), "node").groupBy("key", "i", "j").applyInArrow(_alive(percent), "key long, node long")
    open_ = _distinct_keys(_open(open_.join(table(alive.distinct()), ["key", "node"])))
    sets = table(sets_of(open_.select("node").distinct()))
    blocks = _grid(open_).join(sets, "node").groupBy("key", "i", "j").applyInArrow(block_links(percent, possible), "a long, b long")
    return links.union(table(blocks))


def _shared(members: DataFrame) -> DataFrame:
    """The members of keys that have several."""
    often = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return table(members.join(often, "key").select(*members.columns))


def _distinct_keys(rows: DataFrame) -> DataFrame:
    """One key of those with the same members."""
    same = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("least"))
    return table(rows.join(same.groupBy("n", "x", "least").agg(F.min("key").alias("key")).select("key"), "key"))


def _open(known: DataFrame) -> DataFrame:
    """The rows of keys whose members are in several components."""
    split = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    return table(known.join(split, "key"))


def _grid(open_: DataFrame) -> DataFrame:
    """key, node, comp, stray, i, j: each key's strays in parts i, all its members in parts j, so
    that every stray meets every member in one block (key, i, j)."""
    counted = open_.join(_main(open_), "key").withColumn("stray", F.col("comp") != F.col("main"))
    size = counted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("stray").alias("strays"))
    parts, chunks = F.ceil(F.col("n") / SIDE).cast("int"), F.ceil(F.col("strays") / SIDE).cast("int")
    own, chunk = F.pmod(F.xxhash64("node"), parts).cast("int"), F.pmod(F.xxhash64("node"), chunks).cast("int")
    rows = counted.join(size, "key")
    once = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    return rows.select("key", "node", "comp", F.lit(False).alias("stray"), own.alias("j"), once(chunks).alias("i")).unionByName(
        rows.where("stray").select("key", "node", "comp", F.lit(True).alias("stray"), chunk.alias("i"), once(parts).alias("j"))
    )


def _main(open_: DataFrame) -> DataFrame:
    """key, main: the component with most of a key's members."""
    often = open_.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    return often.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("m")).select("key", F.col("m.comp").alias("main"))
