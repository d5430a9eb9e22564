"""Previous-row time gap (WIN-2), e.g. the publisher's pacing between
consecutive lines.

``lag(ts).over(Window.orderBy(ts))`` without a partition moves the whole table
to one task, and per-key partitions put a hot key in one task.  Here time is cut
into buckets.  Rows are shuffled once, by (group, bucket), and ``lag`` runs inside a
bucket; a bucket's first row takes the last value of the group's nearest earlier
bucket, from a table with one row per (group, bucket) made by an aggregate that
combines before its shuffle.  No ranges are sampled and nothing is checkpointed.

A bucket with more than ``most`` rows is cut again, into equal parts of its own time
span or, where all its rows have one time, of its span of tiebreaks, so that neither a
busy minute nor a dump of rows with one timestamp is one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "1 minute"
MOST = 1_000_000  # rows of a bucket that one task sorts


def _micros(duration: str) -> Column:
    return F.expr(f"unix_micros(timestamp_micros(0) + interval {duration})")


def _part(x: Column, lo: Column, hi: Column, parts: Column) -> Column:
    """The number of the equal part of lo..hi that holds x, in exact arithmetic."""
    wide = [c.cast("decimal(20,0)") for c in (x, lo, hi)]
    return F.floor((wide[0] - wide[1]) * parts / (wide[2] - wide[1] + 1)).cast("long")


def bucketed(
    df: DataFrame, ts: str, tiebreak: str, group_cols: list[str], bucket: str = BUCKET, most: int = MOST
) -> DataFrame:
    """``df`` with ``_group`` (the group columns as one), ``_bucket`` and ``_part``: their
    order within a group agrees with the order of (ts, tiebreak).  A null time comes first."""
    us = F.unix_micros(ts)
    # never null, so that equal keys meet by plain equality and share the lag's shuffle
    group = F.struct(*[F.struct(F.col(g).isNull().alias("n"), F.col(g).alias("v")) for g in group_cols]) if group_cols else F.lit(0)
    rows = df.withColumn("_group", group)
    rows = rows.withColumn("_bucket", F.coalesce(F.floor(us / _micros(bucket)).cast("long"), F.lit(-(2**62))))
    span = [F.min(us).alias("t0"), F.max(us).alias("t1"), F.min(tiebreak).alias("b0"), F.max(tiebreak).alias("b1")]
    hot = rows.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("n"), *span).where(F.col("n") > most)
    parts = F.ceil(F.col("n") / most).cast("decimal(20,0)")
    in_time, in_ties = _part(us, F.col("t0"), F.col("t1"), parts), _part(F.col(tiebreak).cast("long"), F.col("b0"), F.col("b1"), parts)
    part = F.when(F.col("n").isNull(), 0).when(F.col("t1") > F.col("t0"), in_time).otherwise(in_ties)
    return rows.join(hot, ["_group", "_bucket"], "left").select(*df.columns, "_group", "_bucket", F.coalesce(part, F.lit(0)).alias("_part"))


def previous_value(
    df: DataFrame,
    ts: str,
    tiebreak: str,
    value: str,
    group_cols: list[str] | None = None,
    out: str = "prev",
    bucket: str = BUCKET,
    most: int = MOST,
) -> DataFrame:
    """Adds ``out``: ``value`` of the previous row of the group in (ts, tiebreak) order,
    NULL for the first one.  ``tiebreak`` is an integer; a NULL group value is a group too."""
    rows = bucketed(df, ts, tiebreak, list(group_cols or []), bucket, most)
    by = ["_group", "_bucket", "_part"]
    local = Window.partitionBy(*by).orderBy(ts, tiebreak)
    lagged = rows.withColumn("_lag", F.lag(F.struct(value)).over(local))
    # when the value leads the order its last one is its max: a hash aggregate
    last = F.max(value) if value == ts else F.max_by(F.col(value), F.struct(ts, tiebreak))
    lasts = rows.groupBy(*by).agg(last.alias("_last"))
    carry = lasts.select(*by, F.lag("_last").over(Window.partitionBy("_group").orderBy("_bucket", "_part")).alias("_carry"))
    prev = F.when(F.col("_lag").isNotNull(), F.col(f"_lag.{value}")).otherwise(F.col("_carry"))
    return lagged.join(carry, by).select(*df.columns, prev.alias(out))


def time_gaps(
    df: DataFrame, ts: str = "ts", tiebreak: str = "event_id", group_cols: list[str] | None = None, bucket: str = BUCKET, most: int = MOST
) -> DataFrame:
    """Adds ``gap_ms``: milliseconds since the previous row (FN-9), 0 for the first."""
    prev = previous_value(df, ts, tiebreak, ts, group_cols, "_prev_ts", bucket, most)
    gap = F.coalesce(F.unix_millis(F.col(ts)) - F.unix_millis(F.col("_prev_ts")), F.lit(0))
    return prev.withColumn("gap_ms", gap).drop("_prev_ts")
