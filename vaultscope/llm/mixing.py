"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame expressions only.

A document's key is an exponential variate divided by its quality weight; the
smallest keys of a source are its weighted sample without replacement.  The
prefix sum of sizes is taken in two steps, so that no source is ever one group:
sizes are summed by source and key bucket (pre-aggregated), running sums go over
the buckets, and only the documents of the one bucket that the budget cuts are
sorted, by ranges over many tasks.  Rows with one doc_id have one key: among them the
place in the input decides, so that a budget can cut a tie of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import group_positions
from .quality import SYMBOLS, words
from .shared import table, unused

BUCKETS = 4096
WEIGHTS = (3, 1, 2)
LEAST_WEIGHT = 0.05
NO_ID = -(2**63)


def _measured(text: Column, doc_id: Column, seed: int) -> Column:
    """size, key and bucket of a document, as a struct.

    Quality weight: the share of characters that are neither symbols nor digits,
    at least ``LEAST_WEIGHT``.
    """
    text = F.coalesce(text, F.lit(""))
    size = F.size(words(text)).cast("long")
    plain = F.length(F.translate(text, SYMBOLS + "0123456789", "")) / F.greatest(F.length(text), F.lit(1))
    uniform = (F.pmod(F.xxhash64(F.lit(seed), doc_id, size), F.lit(2**52)) + F.lit(0.5)) / F.lit(float(2**52))
    key = -F.log(uniform) / F.greatest(plain, F.lit(LEAST_WEIGHT))
    bucket = F.least(F.floor(F.lit(BUCKETS) * (F.lit(1.0) - F.exp(-key))), F.lit(BUCKETS - 1)).cast("int")
    return F.struct(size.alias("size"), key.alias("key"), bucket.alias("bucket"))


def _targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds the target to (source, source_size, weight): shares by weight, capped at
    ``most`` times the size, the excess reshared until no target is above its cap.
    Each round is one aggregate; the driver sees a few numbers."""
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    cap, level = F.col("source_size") * F.lit(most), 0.0
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        fixed, open_ = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        new = (total - fixed) / open_ if open_ else level
        if not open_ or new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap.cast("double")))


def plan(
    measured: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """One row per source of (source, doc_id, row, size, key, bucket): source_size, target, epochs, and where its last,
    partial epoch ends: all buckets below ``below``, and in that bucket keys up to (cut_key, cut_id, cut_row)."""
    by_bucket = table(measured.groupBy("source", "bucket").agg(F.sum("size").alias("size")))
    sizes = by_bucket.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = group_positions(sizes.withColumn("unnamed", F.col("source").isNull()), [], ["unnamed", "source"])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("_pos", F.lit(len(weights))) + 1).cast("int"))
    sources = table(ranked.select("source", "source_size", weight.alias("weight")))
    sources = _targets(sources, share, most).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    )
    sources = table(sources.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).drop("weight"))

    running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    right = sources.select(F.col("source").alias("__s"), "rest")
    filled = by_bucket.withColumn("upto", running).join(right, F.col("source").eqNullSafe(F.col("__s")))
    ends = filled.groupBy("source").agg(
        F.max(F.when(F.col("upto") <= F.col("rest"), F.struct("bucket", "upto"))).alias("done"),
        F.min(F.when((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")), F.col("bucket"))).alias("cut"),
    )
    ends = table(
        ends.select(
            F.col("source").alias("__s"),
            F.coalesce("cut", F.col("done.bucket") + 1, F.lit(0)).alias("below"),
            "cut",
            F.coalesce("done.upto", F.lit(0)).alias("before"),
        )
    )
    inside = measured.join(
        ends.where("cut is not null"), F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("cut"))
    ).join(right.withColumnRenamed("__s", "__r"), F.col("source").eqNullSafe(F.col("__r")))
    inside = inside.select("source", "key", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "row", "size", "before", "rest")
    placed = group_positions(inside, ["source"], ["key", "id", "row"], weight="size")
    middle = F.col("before") + F.col("_pos") + F.col("size") / 2
    cuts = (
        placed.where(middle <= F.col("rest")).groupBy("source").agg(F.max(F.struct("key", "id", "row")).alias("last"))
        .select(F.col("source").alias("__c"), F.col("last.key").alias("cut_key"), F.col("last.id").alias("cut_id"), F.col("last.row").alias("cut_row"))
    )
    return table(
        sources.join(ends.select("__s", "below"), F.col("source").eqNullSafe(F.col("__s")))
        .join(cuts, F.col("source").eqNullSafe(F.col("__c")), "left")
        .select("source", "source_size", "target", "epochs", "below", "cut_key", "cut_id", "cut_row")
    )


def _copies(doc_id: Column, row: Column, mark: Column, of: Column) -> Column:
    """How often a document is taken; ``of`` is its source's row of :func:`plan`, as a struct."""
    last = F.struct(mark.key, F.coalesce(doc_id, F.lit(NO_ID)), row) <= F.struct(of.cut_key, of.cut_id, of.cut_row)
    chosen = (mark.bucket < of.below) | ((mark.bucket == of.below) & of.cut_key.isNotNull() & last)
    return of.epochs + F.when(chosen, 1).otherwise(0)


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """What a mix of all documents takes: doc_id, size, source_size, target, taken.

    Size: number of words (``[^\\x20\\x09-\\x0D]+``) of the text, 0 for null.  Sources
    in code point order, null last, weigh ``weights``, repeating, and share ``share``
    times all sizes; a target stops at ``most`` times its source's size and the excess
    is reshared by weight.  Complete epochs take every document; the rest is the
    source's documents in key order, as many as bring it nearest to its target.
    Documents are taken whole.  The keys are hashes, so reruns agree.  One row per
    input row: repeated rows are documents of their own with the same key, taken in the
    order in which the input has them, and a null doc_id is allowed.  Other columns are
    ignored; an empty table gives no rows.
    """
    doc_id, source = F.col(id_col).cast("long"), F.col(source_col).cast("string")
    measured, sources = _plan(docs, doc_id, source, _measured(F.col(text_col), doc_id, seed), weights, share, most)
    mark = F.struct("size", "key", "bucket")
    return measured.join(sources, F.col("source").eqNullSafe(F.col("__plan.source"))).select(
        "doc_id", "size", "__plan.source_size", "__plan.target",
        (_copies(F.col("doc_id"), F.col("row"), mark, F.col("__plan")) * F.col("size")).cast("long").alias("taken"),
    )


def _plan(
    docs: DataFrame, doc_id: Column, source: Column, mark: Column, weights: Sequence[int], share: float, most: float
) -> tuple[DataFrame, DataFrame]:
    """The measured documents, without their texts, and the plan as one struct column ``__plan``."""
    measured = docs.select(doc_id.alias("doc_id"), F.monotonically_increasing_id().alias("row"), source.alias("source"), mark.alias("m"))
    measured = table(measured.select("doc_id", "row", "source", "m.*"))
    sources = plan(measured, weights, share, most)
    return measured, sources.select(F.struct(*sources.columns).alias("__plan"))


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix_sources` takes them.  Documents without words are taken for
    complete epochs only.  Texts are measured in place and never sorted; ``docs`` is read twice and has to come
    in the same order, as a written table does, for rows that share a doc_id to be told apart."""
    doc_id, source = F.col(id_col).cast("long"), F.col(source_col).cast("string")
    mark = _measured(F.col(text_col), doc_id, seed)
    _, sources = _plan(docs, doc_id, source, mark, weights, share, most)
    marked, planned, row, copy = (unused(docs, c) for c in ("mark", "plan", "row", "copy"))
    sources = sources.withColumnRenamed("__plan", planned)
    joined = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(marked, mark)
    joined = joined.join(sources, source.eqNullSafe(F.col(f"{planned}.source")))
    copies = _copies(doc_id, F.col(row), F.col(marked), F.col(planned))
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies))).select(*docs.columns)
