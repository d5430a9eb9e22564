"""Failure counts per vault and the per-window top-k (Query 2).

* AGG-6 ``failure_counts``: ``groupBy(window, vault).sum(failure)`` with a
  partial aggregate before the shuffle, so a hot vault costs one row per map task.
* WIN-1 / SRT-1 / LIM-1 ``rank_top_k``: ``row_number`` over the window,
  failures descending, vault ascending (fixes the reference's unordered ties).
  Its input has one row per (window, vault), bounded by the vault count, and
  Spark plans a ``WindowGroupLimit`` below the shuffle so each task ships at
  most k rows per window.
* AGG-7 re-aimed ``ranked_disks``: the failed disks are not collected per
  vault in the aggregation; the failure rows are joined back to the ranked
  vaults only (at most k per window).  The join's small side is sized at run
  time by AQE (broadcast when below its threshold, shuffle join otherwise).
* ``disk_details``: the reference's joined text per ranked vault.  It gathers
  the failed disks of one (window, vault) into one row, which is the content of
  that output row; use ``ranked_disks`` (one row per disk) when a vault can
  fail very often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import disk_text, rank_piece
from ..windows import Grain


def failed(records: DataFrame) -> DataFrame:
    """FLT-7: failure = 1."""
    return records.where(F.col("failure") == 1)


def failure_counts(records: DataFrame, grain: Grain, key: str = "vault_id") -> DataFrame:
    """window, <key>, failures (sum of the failure flags of failed rows)."""
    return (
        failed(records)
        .groupBy(grain.window("ts").alias("window"), F.col(key))
        .agg(F.sum("failure").cast("long").alias("failures"))
    )


def rank_top_k(counts: DataFrame, k: int = 10, key: str = "vault_id", by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``rank`` (1..k) per window (and ``by`` columns, e.g. a grain);
    rows ranked beyond k are dropped."""
    w = Window.partitionBy(*by, "window").orderBy(F.desc("failures"), F.asc(key))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranked_disks(records: DataFrame, ranked: DataFrame, grain: Grain, key: str = "vault_id") -> DataFrame:
    """One row per failed reading of a ranked vault:
    window, rank, <key>, failures, event_ts, model, serial_number."""
    rows = failed(records).select(
        grain.window("ts").alias("window"), F.col(key), F.col("ts").alias("event_ts"), "model", "serial_number"
    )
    return ranked.join(rows, ["window", key]).select("window", "rank", key, "failures", "event_ts", "model", "serial_number")


def disk_details(disks: DataFrame, key: str = "vault_id") -> DataFrame:
    """window, rank, <key>, failures, disk_details: the disks of a ranked vault
    as ``[model='..', serialNumber='..'], ...`` in event-time order."""
    ordered = F.array_sort(F.collect_list(F.struct("event_ts", "model", "serial_number")))
    return disks.groupBy("window", "rank", key, "failures").agg(
        F.array_join(F.transform(ordered, lambda d: disk_text(d["model"], d["serial_number"])), ", ").alias("disk_details")
    )


def ranking_line(details: DataFrame, window_text_col, key: str = "vault_id") -> DataFrame:
    """FN-6: one text line per window, ``<start>, `` followed by
    ``, <vault>, <failures> (<disks>)`` for each rank in order.  At most k
    pieces are gathered per window."""
    pieces = F.array_sort(F.collect_list(F.struct("rank", rank_piece(key, "failures", "disk_details").alias("p"))))
    return details.groupBy("window").agg(
        F.concat(window_text_col, F.lit(", "), F.array_join(F.transform(pieces, lambda s: s["p"]), "")).alias("line")
    )


def wide_ranking(details: DataFrame, k: int = 10, key: str = "vault_id") -> DataFrame:
    """TOP-2: one row per window with ``vault_idK, failuresK, disk_detailsK``
    for K = 1..k (NULL when fewer vaults failed)."""
    r = F.col("rank")
    aggs = []
    for i in range(1, k + 1):
        aggs += [
            F.max(F.when(r == i, F.col(key))).alias(f"{key}{i}"),
            F.max(F.when(r == i, F.col("failures"))).alias(f"failures{i}"),
            F.max(F.when(r == i, F.col("disk_details"))).alias(f"disk_details{i}"),
        ]
    return details.groupBy("window").agg(*aggs)
