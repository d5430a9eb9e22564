"""MinHash near-duplicate groups by a multi-index Hamming join.

Signature: ``CHUNKS`` chunks of ``WIDTH`` symbols, each symbol the low 16 bits of
one MinHash.  If two signatures differ in at most ``CHUNKS * (ERRORS + 1) - 1``
symbols, some chunk differs in at most ``ERRORS`` (pigeonhole).  Enumerating the
chunk errors, here by leaving out each choice of ``ERRORS`` symbols, gives the
keys; any such pair shares a key.  Pairs that share a key are confirmed on their
full shingle sets, so the result has no false link.

Two sets of similarity 0.8 share no key with probability 1.2e-6 (``lost``); such a link is
missed unless the two are connected otherwise.  Nothing else drops a link.

Groups of copies never become pairs: equal sets are one node, and
:func:`~vaultscope.llm.linking.component_links` joins the members of a key by heads and
bounded blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .linking import bitmap, component_links
from .shared import components, table

CHUNKS, WIDTH, ERRORS = 8, 4, 1

_random = np.random.RandomState(20)
_MULTIPLY = _random.randint(0, 2**63, CHUNKS * WIDTH, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.randint(0, 2**63, CHUNKS * WIDTH, dtype=np.int64).astype(np.uint64)
_KEPT = [tuple(c * WIDTH + j for j in js) for c in range(CHUNKS) for js in combinations(range(WIDTH), WIDTH - ERRORS)]


def _marks(size: int):
    """Per document: set size, hashes of the set, keys and bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in tokens.blocks(batch.column(1)):
                values, at = tokens.shingle_sets(data, offsets, size)
                n = np.diff(at)
                full = n > 0
                starts = at[:-1][full]
                marks = np.zeros((len(n), CHUNKS * WIDTH), np.uint64)
                prints = np.zeros((len(n), 2), np.uint64)
                if len(starts):
                    for k in range(CHUNKS * WIDTH):
                        marks[full, k] = tokens.mix(np.minimum.reduceat(values * _MULTIPLY[k] + _ADD[k], starts))
                    prints[full, 0], prints[full, 1] = _prints(values, starts)
                low = marks & np.uint64(0xFFFF)
                keys = np.zeros((len(n), len(_KEPT)), np.uint64)
                for k, kept in enumerate(_KEPT):
                    for symbol in kept:
                        keys[:, k] = keys[:, k] << np.uint64(16) | low[:, symbol]
                    keys[:, k] |= np.uint64(k << 48)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(first, len(n)),
                        "n_shingles": pa.array(n.astype(np.int64)),
                        "f1": pa.array(tokens.signed(prints[:, 0].copy())),
                        "f2": pa.array(tokens.signed(prints[:, 1].copy())),
                        "keys": pa.ListArray.from_arrays(
                            pa.array(np.arange(0, keys.size + 1, len(_KEPT), dtype=np.int32)), pa.array(tokens.signed(keys.ravel()))
                        ),
                        "bits": pa.array([bitmap(values[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    }
                )

    return run


def _prints(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set of values."""
    seeds = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))
    return tuple(np.add.reduceat(tokens.mix(values ^ s), starts) for s in seeds)


def _sets(size: int):
    """The sets of documents, with their hashes; empty ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in tokens.blocks(batch.column(1)):
                values, at = tokens.shingle_sets(data, offsets, size)
                full = np.flatnonzero(np.diff(at))
                if len(full):
                    f1, f2 = _prints(values, at[full])
                    yield pa.record_batch(
                        {
                            "doc": batch.column(0).slice(first, len(at) - 1).take(pa.array(full)),
                            "f1": pa.array(tokens.signed(f1)),
                            "f2": pa.array(tokens.signed(f2)),
                            "set": pa.array([values[at[k] : at[k + 1]].tobytes() for k in full], pa.binary()),
                        }
                    )

    return run


def lost(similarity: float) -> float:
    """Probability that two sets of a similarity share no key."""
    p = similarity
    few = p**WIDTH + WIDTH * p ** (WIDTH - 1) * (1 - p)  # a chunk with at most one error
    return (1 - few) ** CHUNKS


def distinct_sets(rows: DataFrame) -> DataFrame:
    """One node per distinct set of ``rows`` (row, doc_id, f1, f2): f1, f2, node (a row's
    number) and doc, the smallest doc_id with that set."""
    first = rows.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "row")).alias("m"))
    return first.select("f1", "f2", F.col("m.row").alias("node"), F.col("m.doc_id").alias("doc"))


def sets_of_nodes(texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, set of ``nodes`` (node, doc, f1, f2) from ``texts`` (doc_id, text), each node once."""
    nodes = table(nodes.select("node", "doc", "f1", "f2"))  # of known size, so that few of them don't shuffle all texts
    some = texts.join(nodes.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = some.mapInArrow(_sets(size), "doc long, f1 long, f2 long, set binary")
    return sets.groupBy("doc", "f1", "f2").agg(F.first("set").alias("set")).join(nodes, ["doc", "f1", "f2"]).select("node", "set")


def grouped(rows: DataFrame, first: DataFrame, links: DataFrame) -> DataFrame:
    """f1, f2, group and least (the smallest doc_id of the group) of all nodes in ``first``.

    A doc_id with several sets is one document: its nodes are linked."""
    own = rows.join(first, ["f1", "f2"]).select("doc_id", "node").distinct()
    several = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    same = own.join(several, "doc_id").where("node <> a").select("a", F.col("node").alias("b"))
    labels = table(components(links.union(same)))
    group = first.join(labels, "node", "left").select("f1", "f2", "doc", F.coalesce("component", "node").alias("group"))
    group = table(group)
    return group.join(group.groupBy("group").agg(F.min("doc").alias("least")), "group").select("f1", "f2", "group", "least")


def _marked(docs: DataFrame, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """doc_id and text; and per row its number, doc_id, set size, set hashes, keys and bitmap."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    marks = texts.mapInArrow(_marks(size), "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>, bits binary")
    return texts, table(marks.withColumn("row", F.monotonically_increasing_id()))


def _linked(texts: DataFrame, some: DataFrame, size: int, percent: int) -> DataFrame:
    """f1, f2, group, least of all sets in ``some``, rows of ``_marked``."""
    first = table(distinct_sets(some))
    nodes = table(some.join(first.select("node", "doc"), F.col("row") == F.col("node")).select("node", "doc", "f1", "f2", "keys", "bits", "n_shingles"))
    members = nodes.select(F.explode("keys").alias("key"), "node", F.col("n_shingles").alias("size"), F.lit(0).alias("weight"))
    links = component_links(members, nodes, lambda n: sets_of_nodes(texts, nodes.join(n, "node"), size), percent)
    return grouped(some, first, links)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least ``percent``.

    A document's set: the distinct shingles of ``size`` words of its lower-cased
    (A-Z) whole text.  With fewer words, the whole sequence is its one shingle; a
    null text or one without words has an empty set and is linked with nothing.
    Returns one row per input row: doc_id, n_shingles, component_id (the smallest
    doc_id reachable, itself included) and kept (doc_id = component_id).  Rows
    with the same doc_id are the same document, whatever their texts: each comes back, and
    what is linked to one of them is linked to all; a row without words is linked with
    nothing even so.  A row with a null doc_id is linked with nothing, has a null component_id and is kept.
    Other columns, whatever their names, are ignored; an empty table gives none.
    """
    texts, marks = _marked(docs, size, id_col, text_col)
    groups = _linked(texts, marks.where("n_shingles > 0 and doc_id is not null"), size, percent)
    out = marks.join(groups, ["f1", "f2"], "left")
    least = F.when(F.expr("n_shingles > 0 and doc_id is not null"), F.col("least"))
    component = F.coalesce(least, "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicate texts: the smallest doc_id's, nulls last.

    Rows are told apart by their place in the table, not by doc_id: of repeated rows one
    stays, and rows with a null doc_id are rows like others.  Rows whose text is null or
    without words are near-duplicates of nothing and all stay.
    """
    place = "".join(docs.columns) + "_row"
    kept = table(docs.withColumn(place, F.monotonically_increasing_id()))
    texts, marks = _marked(kept, size, place, text_col)
    some = marks.where("n_shingles > 0")
    groups = _linked(texts, some, size, percent)
    group = some.select("doc_id", "f1", "f2").join(groups, ["f1", "f2"]).select(F.col("doc_id").alias("row"), "group")
    ids = kept.select(F.col(place).alias("row"), F.col(id_col).alias("id"))
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("row").alias("row"))
    member = group.join(ids, "row").select("group", "row", order.alias("order"))
    first = member.groupBy("group").agg(F.min("order").alias("stays"))
    gone = member.join(first, "group").where("order <> stays").select(F.col("row").alias(place))
    return kept.join(gone.hint("shuffle_hash"), place, "left_anti").select(*docs.columns)
