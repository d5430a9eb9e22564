"""Query 1: per-vault temperature statistics over three grains.

Batch and stream share :func:`select_q1` and :func:`temperature_stats`; only the
source and sink differ (see :mod:`vaultscope.streaming`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import partials_to_stats, rollup_partials, rollup_partials_multi, window_partials, window_stats
from ..windows import DAY, GRAINS, Grain, window_text

# The vault range of Query 1 (inclusive).
Q1_VAULTS = (1000, 1020)

Q1_COLUMNS = ("ts", "vault_id", "count", "mean_s194", "stddev_s194")


def select_q1(records: DataFrame, vaults: tuple[int, int] | None = Q1_VAULTS) -> DataFrame:
    """FLT-5 and FLT-8: vault range and non-null temperature (pushed to the scan
    when the records come from Parquet)."""
    out = records.where(F.col("s194").isNotNull())
    if vaults is not None:
        out = out.where(F.col("vault_id").between(*vaults))
    return out


def _finish(stats: DataFrame) -> DataFrame:
    """UDF-4: window start as text, reference column order."""
    return stats.select(
        window_text("window.start").alias("ts"),
        "vault_id",
        "count",
        "mean_s194",
        "stddev_s194",
    )


def temperature_stats(records: DataFrame, grain: Grain = DAY, vaults=Q1_VAULTS) -> DataFrame:
    """One row per (window, vault): count, mean and sample stddev of s194."""
    return _finish(window_stats(select_q1(records, vaults), grain))


def temperature_stats_rollup(records: DataFrame, coarse: Grain, fine: Grain = DAY, vaults=Q1_VAULTS) -> DataFrame:
    """Same result as :func:`temperature_stats` for ``coarse``, computed by merging
    ``fine`` partials (AGG-5)."""
    if not coarse.contains(fine):
        raise ValueError(f"{coarse} windows do not contain whole {fine} windows")
    parts = window_partials(select_q1(records, vaults), fine)
    return _finish(partials_to_stats(rollup_partials(parts, coarse)))


def temperature_stats_all_grains(records: DataFrame, vaults=Q1_VAULTS, grains=GRAINS) -> DataFrame:
    """SET-2: one scan, day partials once, every grain merged from them in one
    pass (:func:`~vaultscope.operators.stats.rollup_partials_multi`).

    Output: grain, ts, vault_id, count, mean_s194, stddev_s194.
    """
    finest = grains[0]
    if not all(g.contains(finest) for g in grains):
        raise ValueError("every grain must contain whole windows of the first")
    parts = rollup_partials_multi(window_partials(select_q1(records, vaults), finest), grains)
    stats = partials_to_stats(parts, keep=("grain",))
    return stats.select(
        "grain", window_text("window.start").alias("ts"), "vault_id", "count", "mean_s194", "stddev_s194"
    )
