"""Approximate nearest neighbours: a forest of random-projection trees.

Vectors of largest inner product become vectors of smallest angle by one more
component, ``sqrt(longest**2 - norm**2)`` (zero for a query).  Each tree cuts a
bounded sample by hyperplanes between two random sample vectors at the median
until ``LEAF`` sample vectors are left.  Every row goes to one leaf of each tree.
A query walks all trees from one priority queue, the branch whose hyperplane is
nearest next, whichever tree it is in, until it has found its number of leaves.
The vectors of those leaves are then ranked by the exact inner product.

The number of leaves is measured, not set: ``ASKED`` sample vectors are searched in
the sample, and as many leaves are read as give them ``RECALL`` of their true
neighbours there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import table

SAMPLE = 20_000  # rows the trees are fitted on
TREES = 6
LEAF = 256  # sample vectors of a leaf
ASKED, RECALL = 200, 0.97
SIDE = 2048  # vectors, and queries, of a leaf that are compared in one block


class Tree:
    """Nodes as arrays: hyperplane, threshold and two children; a child below 0 is leaf ``-child - 1``."""

    def __init__(self, planes: np.ndarray, cuts: np.ndarray, children: np.ndarray):
        self.planes, self.cuts, self.children = planes, cuts, children

    @classmethod
    def fit(cls, sample: np.ndarray, leaf: int, random: np.random.RandomState) -> Tree:
        planes, cuts, children, leaves = [], [], [], 0
        open_ = [(np.arange(len(sample)), None, 0)]
        while open_:
            rows, parent, side = open_.pop()
            split = None
            if len(rows) > leaf:
                for _ in range(5):
                    a, b = random.choice(rows, 2, replace=False)
                    plane = sample[a] - sample[b]
                    at = sample[rows] @ plane
                    cut = float(np.median(at))
                    right = at > cut
                    if right.any() and not right.all():
                        split = plane, cut, right
                        break
            if split is None:  # small enough, or all alike
                me, leaves = -leaves - 1, leaves + 1
            else:
                me = len(planes)
                norm = float(np.linalg.norm(split[0]))
                planes.append(split[0] / norm)
                cuts.append(split[1] / norm)
                children.append([0, 0])
                open_ += [(rows[~split[2]], me, 0), (rows[split[2]], me, 1)]
            if parent is not None:
                children[parent][side] = me
        width = sample.shape[1]
        return cls(np.array(planes).reshape(-1, width), np.array(cuts), np.array(children, np.int64).reshape(-1, 2))

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.zeros(len(vectors), np.int64) if len(self.planes) else np.full(len(vectors), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.planes[node]) > self.cuts[node]
            at[inner] = self.children[node, side.astype(np.int64)]
        return -at - 1


def search(forest: list[Tree], vector: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The ``most`` (tree, leaf) nearest to a vector by one queue over all trees."""
    sides = [tree.planes @ vector - tree.cuts for tree in forest]
    queue = [(0.0, t, 0 if len(tree.planes) else -1) for t, tree in enumerate(forest)]
    found = []
    while queue and len(found) < most:
        far, t, node = heapq.heappop(queue)
        while node >= 0:
            side = sides[t][node]
            near, other = forest[t].children[node, int(side > 0)], forest[t].children[node, int(side <= 0)]
            heapq.heappush(queue, (max(far, abs(side)), t, int(other)))
            node = int(near)
        found.append((t, -node - 1))
    return found


def leaves_needed(forest: list[Tree], sample: np.ndarray, asked: np.ndarray, k: int) -> int:
    """How many leaves give the ``asked`` rows of the sample ``RECALL`` of their ``k`` nearest in it.

    Queries have 0 as their last component, as in a search."""
    leaf = [tree.leaves(sample) for tree in forest]
    seen = []
    for row in asked:
        query = np.append(sample[row, :-1], 0.0)
        score = sample @ query
        score[row] = -np.inf
        near = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
        place = {at: n for n, at in enumerate(search(forest, query, sum(len(t.planes) + 1 for t in forest)))}
        seen += [min(place[t, int(leaf[t][x])] for t in range(len(forest))) for x in near]
    if not seen:
        return sum(len(tree.planes) + 1 for tree in forest)
    return int(np.sort(seen)[min(len(seen) - 1, int(np.ceil(RECALL * len(seen))))]) + 1


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def nearest_neighbours(
    rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` rows of largest inner product found for each query row, but the query's own id.

    Returns query_id, rank (from 1), vec_id, score: nearest first, ties to the
    smaller vec_id; all candidates, if fewer than ``k`` are found.  Scores are sums of products in double
    precision over the original vectors.  Vectors that are null, empty, zero, of
    another width than the most frequent one, or hold a null or non-finite component take no part, nor
    do null ids.  Repeated rows with one id count once (the first vector in order).  Other columns are
    ignored; empty tables give no rows.

    The trees are fitted on a sample of at most ``SAMPLE`` distinct vectors (those with the
    least hashes); every row is indexed.  Equal vectors are indexed once: only
    the ``k + 1`` smallest ids of a vector can be among any query's nearest.
    """
    spark = rows.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col).cast("array<double>")
        good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
        return df.select(F.col(id_col).cast("long").alias("vec_id"), F.when(good, vector).alias("v")).where("vec_id is not null and v is not null")

    base = clean(rows)
    widths = base.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], schema)
    width = widths.w
    once = lambda df: df.where(F.size("v") == width).groupBy("vec_id").agg(F.min("v").alias("v"))
    mine = Window.partitionBy("v", "salt").orderBy("vec_id")
    salted = once(base).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    few = salted.withColumn("n", F.row_number().over(mine)).where(F.col("n") <= k + 1)
    distinct = table(few.groupBy("v").agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1).alias("ids")))
    longest = distinct.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]

    def lifted(vectors: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", vectors, vectors), 0.0))
        return np.hstack([vectors, more[:, None]])

    chosen = distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toArrow()["v"].combine_chunks()
    sample = lifted(_vectors(chosen, width))
    trees = [Tree.fit(sample, LEAF, np.random.RandomState(t)) for t in range(TREES)]
    reads = leaves_needed(trees, sample, np.linspace(0, len(sample) - 1, min(ASKED, len(sample))).astype(int), k)
    forest = spark.sparkContext.broadcast(trees)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = lifted(_vectors(batch.column("v"), width))
            for t, tree in enumerate(forest.value):
                leaf = pa.array(tree.leaves(vectors))
                yield pa.record_batch(
                    [pa.array(np.full(len(leaf), t, np.int32)), leaf, batch.column("v"), batch.column("ids")],
                    names=["tree", "leaf", "v", "ids"],
                )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("v"), width)
            found = [search(forest.value, np.append(x, 0.0), reads) for x in vectors]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            tree, leaf = zip(*(x for f in found for x in f)) if owner else ((), ())
            yield pa.record_batch(
                [pa.array(tree, pa.int32()), pa.array(leaf, pa.int64()), batch.column("v").take(owner), batch.column("vec_id").take(owner)],
                names=["tree", "leaf", "v", "vec_id"],
            )

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """The best of a block of a leaf for each of a block of its queries."""
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            vectors, asked = (_vectors(x["v"].combine_chunks(), width) for x in (left, right))
            ids = left["ids"].to_pylist()
            n = np.array([len(x) for x in ids])
            flat, owner = np.concatenate(ids), np.repeat(np.arange(len(ids)), n)
            for lo in range(0, len(asked), 256):
                scores = asked[lo : lo + 256] @ vectors.T
                for query, row in zip(right["vec_id"][lo : lo + 256].to_pylist(), scores):
                    best = np.flatnonzero(row >= np.partition(row, -min(k + 1, len(row)))[-min(k + 1, len(row))])
                    near = np.flatnonzero(np.isin(owner, best)) if len(best) < len(row) else np.arange(len(flat))
                    near = near[flat[near] != query]
                    near = near[np.lexsort((flat[near], -row[owner[near]]))[:k]]
                    out["query_id"] += [query] * len(near)
                    out["vec_id"] += flat[near].tolist()
                    out["score"] += [float(x) for x in row[owner[near]]]
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    asked = once(clean(queries))
    leaves = table(distinct.mapInArrow(place, "tree int, leaf long, v array<double>, ids array<long>"))
    probes = table(asked.select("vec_id", "v").mapInArrow(ask, "tree int, leaf long, v array<double>, vec_id long"))

    # A leaf that holds many rows or queries is compared in blocks.
    def parts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias(name))

    blocks = table(parts(leaves, "m").join(parts(probes, "q"), ["tree", "leaf"]))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("v", *(["vec_id"] if "vec_id" in df.columns else [])), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.join(blocks, ["tree", "leaf"]).select(*df.columns, mine.alias(f"{own}_block"), every.alias(f"{other}_block"))

    keys = ["tree", "leaf", "m_block", "q_block"]
    near = (
        dealt(leaves, "m", "q").groupBy(*keys).cogroup(dealt(probes, "q", "m").groupBy(*keys))
        .applyInArrow(compare, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
