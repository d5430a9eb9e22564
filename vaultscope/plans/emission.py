"""Emission-time views of batch results: when each result row would be emitted
by the event-time stream, and the reference's throughput / latency metrics over
that (WIN-3, MET-1, MET-2), plus the publisher's inter-line gaps (WIN-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.gaps import time_gaps
from ..operators.metrics import emission_metrics
from ..operators.stats import rollup_partials_multi, window_partials
from ..windows import GRAINS, window_text
from .query1 import select_q1

# The watermark delay (30 s out of order) that decides the
# emission instant of a window: end + delay.
WATERMARK_DELAY_S = 30


def q1_emissions(records: DataFrame, grains=GRAINS, delay_s: int = WATERMARK_DELAY_S) -> DataFrame:
    """grain, ts, vault_id, emitted_at, first_ts: one row per Query 1 result row (all
    grains from one scan, as in :func:`~vaultscope.plans.query1.temperature_stats_all_grains`)."""
    parts = rollup_partials_multi(window_partials(select_q1(records), grains[0]), grains)
    return parts.select(
        "grain",
        window_text("window.start").alias("ts"),
        "vault_id",
        (F.col("window.end") + F.make_interval(secs=F.lit(delay_s))).alias("emitted_at"),
        "first_ts",
    )


def q1_emission_metrics(records: DataFrame, grains=GRAINS, delay_s: int = WATERMARK_DELAY_S) -> DataFrame:
    """grain, ts, vault_id, emitted_at (text), n, elapsed_ms, rows_per_s, ms_per_row.

    The clock starts at the first kept reading, as the operator would open
    then: the smallest ``first_ts`` of a grain's windows (every reading lies in
    one window of each grain), so the input is scanned once."""
    emitted = q1_emissions(records, grains, delay_s)
    m = emission_metrics(emitted, tiebreak=["vault_id"])
    return m.withColumn("emitted_at", F.date_format("emitted_at", "yyyy-MM-dd HH:mm:ss"))


def publish_gaps(records: DataFrame) -> DataFrame:
    """event_id, ts (text), gap_ms: ms since the previous record in (ts, event_id)
    order over the whole table, as the publisher paces its replay."""
    g = time_gaps(records.select("event_id", "ts"), "ts", "event_id")
    return g.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "gap_ms")


def vault_gaps(records: DataFrame) -> DataFrame:
    """vault_id, event_id, ts (text), gap_ms: gap to the previous reading of the
    same vault."""
    g = time_gaps(records.select("vault_id", "event_id", "ts"), "ts", "event_id", group_cols=["vault_id"])
    return g.select("vault_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "gap_ms")
