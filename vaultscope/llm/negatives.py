"""Hard negatives by threshold joins in the manner of L2AP.

For an anchor, rows of its label with the largest inner products are positives, and
rows of other labels that score a little below a positive are its hard negatives.  Both
come from one threshold join: for each anchor all rows whose score reaches the anchor's
threshold.  Anchors and rows meet in a grid of blocks, each a task of bounded size:

* the block's inverted index leaves out a row's leading dimensions for as long as their
  norm stays below every anchor's threshold over the anchor's norm, since no anchor can
  reach its threshold through them alone (Cauchy-Schwarz);
* partial scores accumulate over the indexed dimensions, the strongest first, and a
  pair goes once its partial score plus the product of both remaining norms falls short;
* what is left is scored on whole integer vectors, so results are exact.

Thresholds start high, where a normal guess expects ``WANT`` rows, and are lowered
eightfold in rank for those anchors only whose windows aren't full, down to the end of the
window; a wrong guess costs time and never a row.  A block returns per anchor no more
than the rows that can be among its first ones, so hot vectors and labels stay bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import table

ANCHORS = 16384  # anchors of a block at most, about
ROWS = (2048, 65536)  # rows of a block: a 64th of all, between these
SAMPLE = 2000  # rows that the first thresholds are guessed from, fewer above 500 dimensions
WANT, LOWER = 16, 8
CHUNK = 8  # dimensions accumulated at a time
AT_ONCE = 128  # anchors scored together: their pairs with one block are what a task holds
EVERYTHING = -(2**62)
LARGEST = 2**31 - 1


def _vectors(column) -> np.ndarray:
    """A column of packed vectors as a matrix."""
    packed = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = b"".join(packed.to_pylist())
    return np.frombuffer(raw, np.int32).reshape(len(packed), -1)


def indexed(y: np.ndarray) -> tuple:
    """Rows with their dimensions from weak to strong, and the norms of all leading dimensions."""
    order = np.argsort((y.astype(np.float64) ** 2).sum(axis=0), kind="stable")  # weak ones first: they are left out
    y = y[:, order]
    return order, y, _leading(y)


def _leading(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.concatenate([np.zeros((len(m), 1)), np.cumsum(m.astype(np.float64) ** 2, axis=1)], axis=1))


def reaching(x: np.ndarray, limit: np.ndarray, index: tuple) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, x[i] . y[j]) of all pairs whose inner product is at least ``limit[i]``."""
    order, y, norm_y = index
    if not len(x) or not len(y) or not x.shape[1]:
        i, j = np.nonzero(np.broadcast_to((limit <= 0)[:, None], (len(x), len(y))))
        yield i, j, np.zeros(len(i), np.int64)
        return
    x = x[:, order]
    norm_x = _leading(x)
    edges = [*range(0, x.shape[1], CHUNK), x.shape[1]]
    whole = norm_x[:, -1]
    least = np.min(np.divide(limit, whole, out=np.zeros(len(x)), where=whole > 0))
    omitted = (norm_y[:, 1:] < least * (1 - 1e-9)).sum(axis=1)
    first = np.searchsorted(edges, omitted, side="right") - 1  # the first chunk that is indexed
    rows = np.argsort(first, kind="stable")
    rows = rows[: np.searchsorted(first[rows], len(edges) - 1)]  # the others are left out as a whole
    rest_x, rest_y = norm_x[:, edges], norm_y[:, edges]
    goal = (limit - 1e-6 - 1e-9 * np.abs(limit))[:, None]
    query = x.astype(np.float64)
    for lo in range(0, len(rows), 8192):
        own = rows[lo : lo + 8192]
        start, part = first[own], y[own].astype(np.float64)
        score = np.zeros((len(query), len(own)))
        for c in range(len(edges) - 2, -1, -1):
            n = np.searchsorted(start, c, side="right")  # rows with this chunk in the index
            if n:
                score[:, :n] += query[:, edges[c] : edges[c + 1]] @ part[:n, edges[c] : edges[c + 1]].T
            if c > len(edges) // 2:
                continue
            left = np.maximum(start, c)
            alive = score + rest_x[:, left] * rest_y[own, left] >= goal
            if not c or np.count_nonzero(alive) < 0.02 * alive.size:
                break
        i, j = np.nonzero(alive)
        for k in range(0, len(i), 65536):
            a, b = i[k : k + 65536], own[j[k : k + 65536]]
            exact = np.einsum("ij,ij->i", x[a].astype(np.int64), y[b].astype(np.int64))
            keep = exact >= limit[a]
            yield a[keep], b[keep], exact[keep]


def _ordered(x, limit, index, ids, allowed: Callable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Allowed pairs of ``AT_ONCE`` anchors at a time, each anchor's larger scores first, then smaller ids."""
    for lo in range(0, len(x), AT_ONCE):
        parts = [(a + lo, b, s) for a, b, s in reaching(x[lo : lo + AT_ONCE], limit[lo : lo + AT_ONCE], index)]
        a, b, s = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        keep = allowed(a, b)
        a, b, s = a[keep], b[keep], s[keep]
        turn = np.lexsort((ids[b], -s, a))
        yield a[turn], b[turn], s[turn]


_PAIRS = "anchor long, other long, score long"


def _found(anchor_ids, ids, a, b, s, keep) -> pa.Table:
    return pa.table({"anchor": pa.array(anchor_ids[a[keep]]), "other": pa.array(ids[b[keep]]), "score": pa.array(s[keep])})


def _sides(rows: pa.Table, anchors: pa.Table):
    return (
        _vectors(anchors["v"]), anchors["id"].to_numpy(), anchors["label"].to_numpy(), anchors["limit"].to_numpy(),
        _vectors(rows["v"]), rows["id"].to_numpy(), rows["label"].to_numpy(),
    )


def _best(count: int):
    """Per anchor the block's first ``count`` rows of its label that reach its threshold."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return pa.table({k: pa.array([], pa.int64()) for k in ("anchor", "other", "score")})
        x, anchor, mine, limit, y, ids, label = _sides(rows, anchors)
        out = []
        for one in np.unique(mine):
            i, j = np.flatnonzero(mine == one), np.flatnonzero(label == one)
            for a, b, s in _ordered(x[i], limit[i], indexed(y[j]), ids[j], lambda a, b: anchor[i[a]] != ids[j[b]]):
                place = np.arange(len(a)) - np.searchsorted(a, a)
                out.append(_found(anchor[i], ids[j], a, b, s, place < count))
        return pa.concat_tables(out)

    return run


def _below(count: int, low: int):
    """Per anchor and positive the block's first ``count`` rows of other labels in the window."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return pa.table({k: pa.array([], pa.int64()) for k in ("anchor", "other", "score")})
        x, anchor, mine, limit, y, ids, label = _sides(rows, anchors)
        goals = anchors["goals"].to_pylist()
        out = []
        for a, b, s in _ordered(x, limit, indexed(y), ids, lambda a, b: mine[a] != label[b]):
            keep = np.zeros(len(a), bool)
            for one in np.unique(a):
                lo, hi = np.searchsorted(a, [one, one + 1])
                falling = -s[lo:hi]
                for goal in goals[one]:
                    at = lo + np.searchsorted(falling, -goal)
                    own = np.arange(at, min(at + count, hi))
                    keep[own[100 * s[own] >= low * goal]] = True
            out.append(_found(anchor, ids, a, b, s, keep))
        return pa.concat_tables(out)

    return run


def _packed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for v in batch.column("v"):
                v = np.asarray(v.values, np.int32)
                raw.append(np.concatenate([v, np.zeros(width - len(v), np.int32)]).tobytes())
            yield pa.record_batch({"id": batch.column("id"), "label": batch.column("label"), "v": pa.array(raw, pa.binary())})

    return run


def _moments(sample: np.ndarray):
    """Mean and deviation of each anchor's scores over the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = _vectors(batch.column("v")).astype(np.float64) @ sample.T
                yield pa.record_batch([*batch.columns, pa.array(score.mean(axis=1)), pa.array(score.std(axis=1))], [*batch.schema.names, "mean", "spread"])

    return run


def _guess(want: int):
    """A threshold that about ``want`` of ``among`` rows lie above, or between it and ``floor_at``."""
    normal = NormalDist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limits = []
            for mean, spread, among, least, floor_at in zip(*(batch.column(k).to_pylist() for k in ("mean", "spread", "among", "least", "floor_at"))):
                above = 0.0 if least is None or not spread else 1 - normal.cdf((least - mean) / spread)
                share = above + want / among if among else 1.0
                guess = EVERYTHING if share >= 1 else int(np.ceil(mean + spread * normal.inv_cdf(1 - share)))
                limits.append(max(guess, floor_at))
            yield batch.append_column("limit", pa.array(limits, pa.int64()))

    return run


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Hard negatives of each anchor and each of its positives.

    A component x counts as floor(scale * x); scores are integer inner products.  An anchor's
    positives are its first ``positives`` other rows of the same label, larger scores first, then
    smaller ids (all, if fewer).  For each of them, the first ``negatives`` rows of other labels
    with ``low`` * positive_score <= 100 * negative_score <= 100 * positive_score come back:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  A positive with a
    negative score has no such rows.

    ``anchors`` has the anchors' ids; ids that ``rows`` lacks are ignored.  Rows with a null
    id, label or vector, or a null or non-finite component, take no part.  A shorter vector
    counts as if it ended in zeros, an empty one scores 0 with all.  An id stands for one row:
    of several rows with it, the least (label, vector) counts, so repeated rows count once.  A
    component beyond 2**31 after scaling is an error.  Other columns are ignored; empty tables
    give no rows.
    """
    vector = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    bad = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    large = F.exists("v", lambda x: F.abs(x) > LARGEST)
    given = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
    given = given.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("v"))
    given = given.withColumn("v", F.when(large, F.raise_error(F.lit("a component is too large to be an integer"))).otherwise(F.col("v")))
    width = given.agg(F.max(F.size("v"))).first()[0] or 0
    given = given.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    every = table(given.mapInArrow(_packed(width), "id long, label long, v binary"))
    total = every.count()

    taken = every.orderBy(F.xxhash64("id"), "id").limit(max(50, min(SAMPLE, 2**20 // max(width, 1)))).select("v").toArrow()
    sample = _vectors(taken["v"]).astype(np.float64) if total else np.zeros((1, 0))
    asked = anchors.select(F.col(id_col).cast("long").alias("id")).distinct()
    labels = every.groupBy("label").agg(F.count(F.lit(1)).alias("alike"))
    start = table(
        every.join(asked, "id", "left_semi").join(labels, "label").select("id", "label", "v", "alike")
        .mapInArrow(_moments(sample), "id long, label long, v binary, alike long, mean double, spread double")
    )

    blocks = -(-total // min(max(total // 64, ROWS[0]), ROWS[1])) or 1

    def joined(active: DataFrame, block: Callable) -> DataFrame:
        """Rows that ``block`` finds for the active anchors, over the grid of blocks."""
        sides = -(-active.count() // ANCHORS) or 1
        spread = every.select(
            "id", "label", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("j"),
            F.explode(F.sequence(F.lit(0), F.lit(sides - 1))).alias("i"),
        )
        own = active.select(
            "id", "label", "v", "limit", "goals", F.pmod(F.xxhash64("id"), F.lit(sides)).cast("int").alias("i"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("j"),
        )
        return table(spread.groupBy("i", "j").cogroup(own.groupBy("i", "j")).applyInArrow(block, _PAIRS))

    def rounds(open_: DataFrame, block: Callable, full: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """Lower the thresholds until ``full`` leaves no anchor open; the pairs of all rounds."""
        schema = "id long, label long, v binary, mean double, spread double, among long, least long, floor_at long, goals array<long>"
        want, done = WANT, None
        while True:
            active = table(open_.select(*[c.split()[0] for c in schema.split(", ")]).mapInArrow(_guess(want), f"{schema}, limit long"))
            pairs = joined(active, block)
            open_ = table(full(active, pairs).where(F.col("limit") > F.col("floor_at")))
            if open_.isEmpty():
                return pairs if done is None else done.union(pairs)
            kept = pairs.join(open_.select(F.col("id").alias("anchor")), "anchor", "left_anti")
            done = kept if done is None else done.union(kept)
            want *= LOWER

    # positives: an anchor is open until enough rows reach its threshold
    def few(active: DataFrame, pairs: DataFrame) -> DataFrame:
        enough = pairs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= positives).select("anchor")
        return active.join(enough, F.col("id") == F.col("anchor"), "left_anti")

    nothing = F.lit(None).cast("long")
    first = start.select(
        "*", F.col("alike").alias("among"), nothing.alias("least"), F.lit(EVERYTHING).alias("floor_at"), F.lit(None).cast("array<long>").alias("goals")
    )
    ranked = rounds(first, _best(positives), few)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "other"))
    chosen = table(ranked.withColumn("place", place).where(F.col("place") <= positives).where("score >= 0").drop("place"))

    # negatives: open until each positive's window is full or the threshold has passed its end
    def unfilled(active: DataFrame, pairs: DataFrame) -> DataFrame:
        each = active.select("id", "limit", F.explode(F.array_distinct("goals")).alias("goal"))
        hit = (F.col("anchor") == F.col("id")) & (F.col("score") <= F.col("goal")) & (100 * F.col("score") >= low * F.col("goal"))
        filled = each.join(pairs, hit).groupBy("id", "goal").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= negatives)
        short = each.where(100 * F.col("limit") > low * F.col("goal")).join(filled, ["id", "goal"], "left_anti")
        return active.join(short.select("id").distinct(), "id", "left_semi")

    goals = chosen.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("goals"))  # at most ``positives``
    second = start.join(goals, "id").select(
        "*", F.lit(total).cast("long").alias("among"), F.array_min("goals").alias("least"),
        F.expr(f"({low} * array_min(goals) + 99) div 100").alias("floor_at"),
    )
    found = rounds(second, _below(negatives, low), unfilled)
    both = chosen.select("anchor", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")).join(
        found.select(F.col("anchor").alias("of"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score")),
        (F.col("anchor") == F.col("of"))
        & (F.col("negative_score") <= F.col("positive_score"))
        & (100 * F.col("negative_score") >= low * F.col("positive_score")),
    )
    rank = F.row_number().over(Window.partitionBy("anchor", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return both.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
