"""Per-group count, mean and sample deviation over tumbling windows (Query 1).

AGG-1..4: ``groupBy(window, key)`` with built-in aggregates.  Spark plans a
partial aggregate before the shuffle, so each map task sends at most one row per
(window, key) it saw: a vault holding a third of all readings costs no more
shuffle than any other vault.

AGG-5: exact roll-up of (n, sum, m2) partials to a coarser grain whose windows
contain whole finer windows (1 day -> 3 days -> 23 days).  The parallel form of
Welford's merge is used, with mean = sum / n:

    N = sum(n);  M = sum(sum) / N;  M2 = sum(m2) + sum(n * (sum / n - M)^2)

Carrying the raw sum (not the mean) keeps the rolled-up mean equal to what
``avg`` computes directly.

M is needed before the second sum, so the roll-up runs a window over
(coarse window, key) and then a group-by on the same keys; the second step
reuses the first one's partitioning (one shuffle of a table with one row per
(fine window, key)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..windows import Grain


def _stddev_or_zero(m2: Column, n: Column) -> Column:
    """Sample deviation that is 0.0 for n <= 1, as in the reference (AGG-4)."""
    return F.when(n > 1, F.sqrt(m2 / (n - 1))).otherwise(F.lit(0.0))


def window_stats(
    records: DataFrame,
    grain: Grain,
    value: str = "s194",
    key: str = "vault_id",
    ts: str = "ts",
) -> DataFrame:
    """Columns: window, <key>, count, mean_<value>, stddev_<value>.

    Rows with a NULL value are dropped first (FLT-8), so ``count`` counts readings.
    """
    x = F.col(value)
    return (
        records.where(x.isNotNull())
        .groupBy(grain.window(ts).alias("window"), F.col(key))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(x).alias(f"mean_{value}"),
            F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias(f"stddev_{value}"),
        )
    )


def window_partials(
    records: DataFrame,
    grain: Grain,
    value: str = "s194",
    key: str = "vault_id",
    ts: str = "ts",
) -> DataFrame:
    """Mergeable partial statistics: window, key, n, sum, m2 (sum of squared
    deviations from the mean), first_ts (earliest reading)."""
    x = F.col(value)
    return (
        records.where(x.isNotNull())
        .groupBy(grain.window(ts).alias("window"), F.col(key))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(x).alias("sum"),
            (F.var_pop(x) * F.count(F.lit(1))).alias("m2"),
            F.min(ts).alias("first_ts"),
        )
    )


def rollup_partials(partials: DataFrame, coarse: Grain, key: str = "vault_id") -> DataFrame:
    """Merge partials of a finer grain into ``coarse`` windows (AGG-5).

    The caller guarantees that each fine window lies inside one coarse window
    (``coarse.contains(fine)``); the fine window start then picks the coarse window.
    """
    grp = ["cwindow", key]
    w = Window.partitionBy(*grp)
    with_total = partials.select(
        coarse.window(F.col("window.start")).alias("cwindow"),
        F.col(key),
        "n",
        "sum",
        "m2",
        "first_ts",
    ).select(
        "*",
        (F.sum("sum").over(w) / F.sum("n").over(w)).alias("M"),
    )
    n = F.col("n")
    return with_total.groupBy(*grp).agg(
        F.sum(n).alias("n"),
        F.sum("sum").alias("sum"),
        (F.sum("m2") + F.sum(n * (F.col("sum") / n - F.col("M")) ** 2)).alias("m2"),
        F.min("first_ts").alias("first_ts"),
    ).withColumnRenamed("cwindow", "window")


def rollup_partials_multi(partials: DataFrame, grains, key: str = "vault_id") -> DataFrame:
    """Merge finer partials into several coarser grains in one pass.

    Each fine row is expanded into its window of every grain (a narrow
    ``explode`` of a fixed-size array), then all grains merge together under
    one partitioning on (grain, window, key).  The finest grain itself passes
    through unchanged (merging one partial adds exactly 0 to m2).  Output:
    grain, window, key, n, sum, m2, first_ts.
    """
    expanded = partials.select(
        F.explode(
            F.array(*[F.struct(F.lit(g.label).alias("grain"), g.window_of(F.col("window.start")).alias("cwindow")) for g in grains])
        ).alias("g"),
        F.col(key),
        "n",
        "sum",
        "m2",
        "first_ts",
    ).select("g.grain", "g.cwindow", key, "n", "sum", "m2", "first_ts")
    grp = ["grain", "cwindow", key]
    w = Window.partitionBy(*grp)
    n = F.col("n")
    return (
        expanded.select("*", (F.sum("sum").over(w) / F.sum("n").over(w)).alias("M"))
        .groupBy(*grp)
        .agg(
            F.sum(n).alias("n"),
            F.sum("sum").alias("sum"),
            (F.sum("m2") + F.sum(n * (F.col("sum") / n - F.col("M")) ** 2)).alias("m2"),
            F.min("first_ts").alias("first_ts"),
        )
        .withColumnRenamed("cwindow", "window")
    )


def partials_to_stats(partials: DataFrame, value: str = "s194", key: str = "vault_id", keep=()) -> DataFrame:
    """(window, key, n, sum, m2) -> (window, key, count, mean_<value>, stddev_<value>),
    after the ``keep`` columns."""
    n = F.col("n")
    return partials.select(
        *keep,
        "window",
        F.col(key),
        n.alias("count"),
        (F.col("sum") / n).alias(f"mean_{value}"),
        _stddev_or_zero(F.col("m2"), n).alias(f"stddev_{value}"),
    )
