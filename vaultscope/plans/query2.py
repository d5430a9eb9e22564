"""Query 2: per window, the 10 vaults with most failures and their failed disks
(batch form; the streaming form is in :mod:`vaultscope.streaming.queries`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import failures as fo
from ..windows import DAY, Grain, window_text

# Ranks kept per window.
TOP_K = 10


def top_vaults(records: DataFrame, grain: Grain = DAY, k: int = TOP_K) -> DataFrame:
    """ts, rank, vault_id, failures."""
    ranked = fo.rank_top_k(fo.failure_counts(records, grain), k)
    return ranked.select(window_text("window.start").alias("ts"), "rank", "vault_id", "failures")


def _details(records: DataFrame, grain: Grain, k: int) -> DataFrame:
    ranked = fo.rank_top_k(fo.failure_counts(records, grain), k)
    return fo.disk_details(fo.ranked_disks(records, ranked, grain))


def top_vault_disks(records: DataFrame, grain: Grain = DAY, k: int = TOP_K) -> DataFrame:
    """Long form, one row per failed reading of a ranked vault:
    ts, rank, vault_id, failures, event_ts, model, serial_number."""
    ranked = fo.rank_top_k(fo.failure_counts(records, grain), k)
    return fo.ranked_disks(records, ranked, grain).select(
        window_text("window.start").alias("ts"),
        "rank",
        "vault_id",
        "failures",
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"),
        "model",
        "serial_number",
    )


def top_vault_disk_arrays(records: DataFrame, grain: Grain = DAY, k: int = TOP_K) -> DataFrame:
    """The structured form: ts, rank, vault_id, failures,
    disks array<struct<model, serial_number>> in event-time order."""
    ranked = fo.rank_top_k(fo.failure_counts(records, grain), k)
    disks = fo.ranked_disks(records, ranked, grain)
    ordered = F.array_sort(F.collect_list(F.struct("event_ts", "model", "serial_number")))
    out = disks.groupBy("window", "rank", "vault_id", "failures").agg(
        F.transform(ordered, lambda d: F.struct(d["model"].alias("model"), d["serial_number"].alias("serial_number"))).alias("disks")
    )
    return out.select(window_text("window.start").alias("ts"), "rank", "vault_id", "failures", "disks")


def top_vault_details(records: DataFrame, grain: Grain = DAY, k: int = TOP_K) -> DataFrame:
    """ts, rank, vault_id, failures, disk_details (joined text)."""
    return _details(records, grain, k).select(
        window_text("window.start").alias("ts"), "rank", "vault_id", "failures", "disk_details"
    )


def ranking_lines(records: DataFrame, grain: Grain = DAY, k: int = TOP_K) -> DataFrame:
    """ts, ts_end, line: the reference's text line per window (FN-2, FN-6)."""
    return fo.ranking_line(_details(records, grain, k), window_text("window.start")).select(
        window_text("window.start").alias("ts"), window_text("window.end").alias("ts_end"), "line"
    )


def wide_ranking(records: DataFrame, grain: Grain = DAY, k: int = TOP_K) -> DataFrame:
    """TOP-2: ts, vault_id1, failures1, disk_details1, ..., disk_details<k>."""
    wide = fo.wide_ranking(_details(records, grain, k), k)
    return wide.select(window_text("window.start").alias("ts"), *[c for c in wide.columns if c != "window"])
