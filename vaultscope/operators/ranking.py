"""Position of each row inside its group in value order, without sending a
group to one task.

``row_number().over(partitionBy(g).orderBy(x))`` puts every row of a group in
one task; a group holding a third of the data would then be sorted by one
core.  Here the rows are range-partitioned on (g..., x) instead: Spark samples
the keys and cuts a large group across many partitions, each sorted locally.
A row's position is then

    (its index among the group's rows in its partition)
  + (rows of the same group in all lower partitions)

The second term comes from a table with one row per (partition, group), which
is at most ``partitions + groups`` rows (groups = result rows).  No broadcast is
forced: the planner and AQE broadcast whichever join side is below the
threshold by (runtime) size, and shuffle-join otherwise.  The ranged rows are checkpointed to
the shared checkpoint folder so that both uses see the same partitioning (a
second sampling could move the cut points) and so that a lost executor does
not re-run the range sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def group_positions(
    df: DataFrame,
    group_cols: list[str],
    order_col: str | list[str],
    num_partitions: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Adds ``_pos`` (0-based position in ascending ``order_col`` within the
    group; ties in arbitrary but consistent order), ``_n`` (group size) and
    ``_pid`` (the range partition the row was ranked in).

    With ``weight`` a row stands for that many rows: ``_pos`` is the position of its
    first one and ``_n`` the sum of the group's weights.  Rows pre-aggregated to
    (group, value, weight) leave no ties, however few values a hot group has.

    ``order_col`` may be a list (lexicographic order).  A NULL group value
    forms its own group.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    order_cols = [order_col] if isinstance(order_col, str) else list(order_col)
    keys = [*group_cols, *order_cols]
    ranged = (
        # without an explicit count AQE may merge small neighbouring ranges;
        # merged partitions are still contiguous ranges in key order
        (df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys))
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        # increasing inside a partition, in the sorted order
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    per_part = ranged.groupBy("_pid", *group_cols).agg(F.min("_mid").alias("_first"), rows.alias("_cnt"))
    by_group = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    offsets = per_part.select(
        "_pid",
        *group_cols,
        "_first",
        (F.sum("_cnt").over(by_group.orderBy("_pid")) - F.col("_cnt")).alias("_before"),
        F.sum("_cnt").over(by_group).alias("_n"),
    )
    # null-safe on the group columns: a NULL group value is a group too
    o = offsets.select(
        F.col("_pid").alias("_o_pid"), *[F.col(c).alias(f"_o_{c}") for c in group_cols], "_first", "_before", "_n"
    )
    cond = [F.col("_pid") == F.col("_o_pid")] + [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in group_cols]
    if weight:
        here = Window.partitionBy("_pid", *group_cols).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
        ranged = ranged.withColumn("_here", F.sum(weight).over(here) - F.col(weight))
    within = F.col("_here") if weight else F.col("_mid") - F.col("_first")
    return ranged.join(o, cond).select(
        *df.columns,
        (within + F.col("_before")).alias("_pos"),
        "_n",
        "_pid",
    )
