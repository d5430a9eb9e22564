"""N-gram Jaccard self-join by prefix filters under several global token orders.

Two sets whose similarity reaches the threshold share a token among the first
``n - ceil(t * n) + 1`` of each, under any one global order of tokens.  So a pair must
share such prefix tokens under every order, and the filters of all orders are
intersected before a pair is verified on its whole sets:

* order 0 puts rare tokens first; its prefix tokens are the keys that bring documents
  together.  A token's frequency class comes from ``1 << SLOT_BITS`` counters over all
  documents; any classes give a right order, good ones keep common passages out of
  prefixes;
* orders 1 to ``ORDERS - 1`` are by hashes of the tokens.  Pairs of a key's head and its
  members, and those within blocks of members, are intersected with the filters of these
  orders before whole sets are compared.

Verified links become components by heads and bounded blocks
(:func:`~vaultscope.llm.linking.component_links`), so groups of copies and common
passages never become pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .linking import bitmap, component_links, shared_counts
from .neardup import _prints, distinct_sets, grouped, sets_of_nodes
from .shared import table

SLOT_BITS = 18  # the counters' table goes to the driver and to every task: 256 KB as classes
ORDERS = 3
_SEEDS = [np.uint64(0x9E6C63D0876A9A47 + 0x3C6EF372FE94F82A * k & (1 << 64) - 1) for k in range(ORDERS)]


def prefix_size(n, percent: int):
    """The number of a set's first tokens among which a pair at the threshold shares one."""
    return n - -(-percent * n // 100) + 1


def _slots(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _counted(size: int):
    """Slot counts of the documents' distinct shingles, summed over a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for _, data, offsets in tokens.blocks(batch.column(1)):
                total += np.bincount(_slots(tokens.shingle_sets(data, offsets, size)[0]), minlength=1 << SLOT_BITS)
        some = np.flatnonzero(total)
        for lo in range(0, len(some), 65536):
            own = some[lo : lo + 65536]
            yield pa.record_batch({"slot": pa.array(own), "n": pa.array(total[own])})

    return run


def frequency_classes(texts: DataFrame, size: int) -> np.ndarray:
    """The binary logarithm of each slot's count over all documents (a fixed-size table)."""
    counts = texts.mapInArrow(_counted(size), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    classes = np.zeros(1 << SLOT_BITS, np.uint8)
    classes[counts["slot"].to_numpy()] = np.log2(counts["n"].to_numpy()) + 1
    return classes


def in_order(values: np.ndarray, order: int, classes: np.ndarray | None = None) -> np.ndarray:
    """Each token's rank under a global order, distinct for distinct tokens of one class."""
    rank = tokens.mix(values ^ _SEEDS[order])
    if order == 0:
        rank = rank >> np.uint64(8) | classes[_slots(values)].astype(np.uint64) << np.uint64(56)
    return rank


def prefix(values: np.ndarray, order: int, percent: int, classes: np.ndarray | None = None) -> np.ndarray:
    """The set's prefix under a global order.

    Equal ranks (order 0 keeps 56 bits of hash) are kept together, so that ties can't
    tear two prefixes apart.
    """
    n = prefix_size(len(values), percent)
    if n >= len(values):
        return values
    rank = in_order(values, order, classes)
    return values[rank <= np.partition(rank, n - 1)[n - 1]]


def _keyed(size: int, percent: int, classes: np.ndarray):
    """Per document: set size, hashes of the set, order 0's prefix, mean class, bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in tokens.blocks(batch.column(1)):
                values, at = tokens.shingle_sets(data, offsets, size)
                n = np.diff(at)
                full = n > 0
                prints, weight = np.zeros((2, len(n)), np.uint64), np.zeros(len(n), np.int64)
                if full.any():
                    prints[:, full] = _prints(values, at[:-1][full])
                    common = np.add.reduceat(classes[_slots(values)].astype(np.int64), at[:-1][full])
                    weight[full] = common * 1000 // n[full]
                keys = [tokens.signed(prefix(values[a:b], 0, percent, classes)) for a, b in zip(at[:-1], at[1:])]
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(first, len(n)),
                        "n_shingles": pa.array(n),
                        "f1": pa.array(tokens.signed(prints[0].copy())),
                        "f2": pa.array(tokens.signed(prints[1].copy())),
                        "keys": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))),
                        "weight": pa.array(weight),
                        "bits": pa.array([bitmap(values[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    }
                )

    return run


def prefixes_meet(percent: int):
    """Pairs of sets whose prefixes share a token under each of the other orders."""

    def run(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        out = np.ones((len(left), len(right)), bool)
        for k in range(1, ORDERS):
            if out.any():
                out &= shared_counts([prefix(s, k, percent) for s in left], [prefix(s, k, percent) for s in right]) > 0
        return out

    return run


def ngram_join(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of word n-grams are linked, exactly.

    A document's set: the distinct runs of ``size`` words (no white space; A-Z lower-cased) of
    its whole text.  With fewer words, the whole sequence is its one member; a null text or
    one without words has an empty set and is linked with nothing.  Two documents are linked
    when 100 * intersection >= ``percent`` * union.  Returns one row per input row: doc_id,
    n_shingles and component_id (the smallest doc_id reachable, itself included).

    Rows with the same doc_id are one document, whatever their texts; each comes back.  A null
    doc_id is linked with nothing and has a null component_id.  Words are compared by 64-bit
    hashes.  Other columns are ignored; an empty table gives none.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    classes = frequency_classes(texts, size)
    schema = "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>, weight long, bits binary"
    marks = texts.mapInArrow(_keyed(size, percent, classes), schema)
    marks = table(marks.withColumn("row", F.monotonically_increasing_id()))
    some = marks.where("n_shingles > 0 and doc_id is not null")
    first = table(distinct_sets(some))
    own = ["node", "doc", "f1", "f2", "keys", "n_shingles", "weight", "bits"]
    nodes = table(some.join(first.select("node", "doc"), F.col("row") == F.col("node")).select(*own))
    members = nodes.select(F.explode("keys").alias("key"), "node", F.col("n_shingles").alias("size"), "weight")
    links = component_links(members, nodes, lambda n: sets_of_nodes(texts, nodes.join(n, "node"), size), percent, prefixes_meet(percent))
    groups = grouped(some, first, links)
    least = F.when(F.expr("n_shingles > 0 and doc_id is not null"), F.col("least"))
    return marks.join(groups, ["f1", "f2"], "left").select("doc_id", "n_shingles", F.coalesce(least, "doc_id").alias("component_id"))
