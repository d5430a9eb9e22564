"""Query 3: per vault, quantiles of the latest power-on hours of each disk.

``dedup_key`` picks what "one disk" is: ``serial_number`` (intended meaning,
default) or ``model`` (what the reference's parser actually reads as the key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import (
    approx_quantiles,
    hazen_quantiles,
    latest_per_key,
    merge_sketches,
    quantile_sketches,
    rank_errors,
    sketch_quantiles,
)
from ..windows import DAY, Grain, window_text

# The vault range of Query 3 (inclusive).
Q3_VAULTS = (1090, 1120)

Q3_COLUMNS = ("ts", "vault_id", "count", "min_hours", "p25_hours", "p50_hours", "p75_hours", "max_hours")


def select_q3(records: DataFrame, vaults=Q3_VAULTS, dedup_key: str = "serial_number") -> DataFrame:
    """FLT-2, FLT-6, PRJ-8: non-empty key, hours present, vault range."""
    out = records.where((F.length(F.col(dedup_key)) > 0) & F.col("s9").isNotNull())
    if vaults is not None:
        out = out.where(F.col("vault_id").between(*vaults))
    return out


def latest_hours(records: DataFrame, grain: Grain = DAY, vaults=Q3_VAULTS, dedup_key: str = "serial_number") -> DataFrame:
    """window, vault_id, key, s9: latest reading per (window, vault, key)."""
    return latest_per_key(select_q3(records, vaults, dedup_key), grain, key=dedup_key, value="s9")


def _finish(q: DataFrame) -> DataFrame:
    return q.select(window_text("window.start").alias("ts"), *[c for c in Q3_COLUMNS if c != "ts"])


def power_on_quantiles(records: DataFrame, grain: Grain = DAY, vaults=Q3_VAULTS, dedup_key: str = "serial_number") -> DataFrame:
    """ts, vault_id, count, min/p25/p50/p75/max of the latest hours (exact, Hazen)."""
    latest = latest_hours(records, grain, vaults, dedup_key)
    return _finish(hazen_quantiles(latest, ["window", "vault_id"], "s9", prefix="")
                   .select("window", "vault_id", "count",
                           *[F.col(c).alias(f"{c}_hours") for c in ("min", "p25", "p50", "p75", "max")]))


def power_on_quantiles_approx(records: DataFrame, grain: Grain = DAY, vaults=Q3_VAULTS,
                              dedup_key: str = "serial_number", accuracy: int = 10000) -> DataFrame:
    """AGG-12: the same columns from bounded ``percentile_approx`` sketches."""
    latest = latest_hours(records, grain, vaults, dedup_key)
    q = approx_quantiles(latest, ["window", "vault_id"], "s9", accuracy=accuracy)
    return _finish(q.select("window", "vault_id", "count",
                            *[F.col(c).alias(f"{c}_hours") for c in ("min", "p25", "p50", "p75", "max")]))


def day_sketches(records: DataFrame, vaults=Q3_VAULTS, dedup_key: str = "serial_number", k: int = 400) -> DataFrame:
    """AGG-12: window, vault_id, sketch, min, max: each disk's latest hours of each day as
    one mergeable sketch per (day, vault)."""
    return quantile_sketches(latest_hours(records, DAY, vaults, dedup_key), ["window", "vault_id"], "s9", k)


def _coarse(grain: Grain):
    return grain.window_of("window.start").alias("window")


def sketch_rollup(sketches: DataFrame, grain: Grain) -> DataFrame:
    """ts, vault_id, count, min/p25/p50/p75/max_hours of ``grain`` from day sketches: the
    distribution of daily latest readings, without going back to the readings."""
    if not grain.contains(DAY):
        raise ValueError(f"{grain} windows do not consist of whole days")
    merged = merge_sketches(sketches, [_coarse(grain), "vault_id"])
    q = sketch_quantiles(merged, ["window", "vault_id"])
    return _finish(q.select("window", "vault_id", "count", *[F.col(c).alias(f"{c}_hours") for c in ("min", "p25", "p50", "p75", "max")]))


def sketch_rollup_errors(records: DataFrame, grain: Grain, vaults=Q3_VAULTS, k: int = 400) -> DataFrame:
    """:func:`sketch_rollup` with the rank error of each quantile against the readings."""
    latest = latest_hours(records, DAY, vaults)
    merged = merge_sketches(quantile_sketches(latest, ["window", "vault_id"], "s9", k), [_coarse(grain), "vault_id"])
    daily = latest.select(_coarse(grain), "vault_id", "s9")
    q = rank_errors(sketch_quantiles(merged, ["window", "vault_id"]), daily, ["window", "vault_id"], "s9")
    return q.select(window_text("window.start").alias("ts"), *[c for c in q.columns if c != "window"])
