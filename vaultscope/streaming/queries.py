"""Structured Streaming forms of the three queries (STR-1..12).

Each takes a streaming DataFrame of raw lines (``value``), parses it with the
same column expressions as batch, assigns event time with a 30-second
watermark and aggregates per tumbling window in append mode: a window is
emitted once, when the watermark passes its end, and late rows are dropped by
the state store.

* Query 1: one windowed aggregation (same code as batch).
* Query 2: two chained windowed aggregations linked by ``window_time``: per
  (window, vault) failure count, then per window the top k from a sorted array
  of (-failures, vault) structs (streaming refuses ``row_number``; the second
  state holds one pair per failing vault of a window).  The detailed form with
  disks keeps the disks in the first stage only and ranks each micro-batch of
  closed (window, vault) rows in ``foreachBatch`` with the batch operators.
* Query 3: (window, vault, key) -> latest hours, then (window, vault) -> sorted
  array of the latest values -> Hazen quantiles.  The second state holds one
  value per key of a vault-window; ``approx=True`` keeps a bounded
  ``percentile_approx`` sketch instead, and ``q3_latest_stream`` +
  ``q3_quantiles_batch_writer`` keep only the first stage in state and compute
  exact quantiles of each micro-batch of closed windows with the skew-proof
  batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..functions.text import disks_text
from ..operators.failures import failed, rank_top_k
from ..operators.quantiles import QUANTILES, hazen_columns, hazen_quantiles
from ..plans.query1 import Q1_VAULTS, temperature_stats
from ..plans.query2 import TOP_K
from ..plans.query3 import Q3_VAULTS, select_q3
from ..windows import DAY, GRAINS, Grain, window_text

# The reference's out-of-order bound.
WATERMARK = "30 seconds"


def parsed_stream(lines: DataFrame, query: str, key: str = "serial_number", watermark: str = WATERMARK) -> DataFrame:
    """Good records of ``query`` with event time and watermark on ``ts``."""
    return parse.good_records(parse.parse_lines(lines, query, key=key)).withWatermark("ts", watermark)


def q1_stream(lines: DataFrame, grain: Grain = DAY, vaults=Q1_VAULTS, watermark: str = WATERMARK) -> DataFrame:
    """ts, vault_id, count, mean_s194, stddev_s194 per closed window."""
    return temperature_stats(parsed_stream(lines, "q1", watermark=watermark), grain, vaults)


def q1_stream_all_grains(lines: DataFrame, grains=GRAINS, watermark: str = WATERMARK) -> DataFrame:
    """SET-2 for Query 1 in one streaming query (see :func:`stream_all_grains`)."""
    return stream_all_grains(lines, "q1", grains, watermark=watermark)


def stream_all_grains(
    lines: DataFrame, query: str, grains=GRAINS, watermark: str = WATERMARK, dedup_key: str = "serial_number"
) -> DataFrame:
    """SET-2: one parsed stream fanned out to every grain in one streaming query,
    as the reference's jobs do: a ``grain`` column, then the query's columns.
    One source and checkpoint; each grain has its own stateful operator(s)."""
    recs = parsed_stream(lines, query, key=dedup_key, watermark=watermark)
    build = {
        "q1": lambda g: temperature_stats(recs, g, Q1_VAULTS),
        "q2": lambda g: _q2_from_records(recs, g, TOP_K),
        "q3": lambda g: _q3_from_records(recs, g, Q3_VAULTS, dedup_key),
    }[query]
    out = None
    for g in grains:
        part = build(g).select(F.lit(g.label).alias("grain"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def records_stream(lines: DataFrame, query: str, dedup_key: str = "serial_number") -> DataFrame:
    """The good records of ``query`` with what it needs only: the raw lines are read and
    parsed once, into a sink that every grain's stream then reads."""
    recs = parse.good_records(parse.parse_lines(lines, query, key=dedup_key))
    if query == "q1":
        return recs.select("ts", "vault_id", "s194")
    return failed(recs).select("ts", "vault_id", "failure") if query == "q2" else recs.select("ts", "vault_id", dedup_key, "s9")


def windows_of_records(
    records: DataFrame, query: str, grains=GRAINS, watermark: str = WATERMARK, dedup_key: str = "serial_number"
) -> DataFrame:
    """The bounded first stage of every grain over a stream of :func:`records_stream`: one
    value per (grain, window, vault), or per (grain, window, vault, key) for Query 3.
    :func:`finish_windows` makes the results of a micro-batch of closed windows."""
    recs = records.withWatermark("ts", watermark)
    build = {
        "q1": lambda g: temperature_stats(recs, g, Q1_VAULTS),
        "q2": lambda g: recs.groupBy(g.window("ts").alias("window"), "vault_id").agg(F.sum("failure").cast("long").alias("failures")),
        "q3": lambda g: _latest(select_q3(recs, Q3_VAULTS, dedup_key), g, dedup_key),
    }[query]
    out = None
    for g in grains:
        part = build(g).select(F.lit(g.label).alias("grain"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def finish_windows(closed: DataFrame, query: str, k: int = TOP_K) -> DataFrame:
    """The query's rows, after ``grain``, of a micro-batch of closed windows (a window's
    rows are all emitted in the batch that closes it): ranks and quantiles are the
    batch operators', not lists in a stream's state."""
    if query == "q1":
        return closed
    if query == "q2":
        ranked = rank_top_k(closed, k, by=("grain",))
        return ranked.select("grain", window_text("window.start").alias("ts"), "rank", "vault_id", "failures")
    quantiles = hazen_quantiles(closed, ["grain", "window", "vault_id"], "s9")
    hours = [F.col(c).alias(f"{c}_hours") for c in ("min", "p25", "p50", "p75", "max")]
    return quantiles.select("grain", window_text("window.start").alias("ts"), "vault_id", "count", *hours)


def _latest(records: DataFrame, grain: Grain, dedup_key: str) -> DataFrame:
    return records.groupBy(grain.window("ts").alias("window"), "vault_id", dedup_key).agg(
        F.max_by(F.col("s9"), F.struct("ts", "s9")).alias("s9")
    )


def q2_failures_stream(lines: DataFrame, grain: Grain = DAY, watermark: str = WATERMARK, disks: bool = True) -> DataFrame:
    """First stage of Query 2: window, vault_id, failures[, disks] per closed
    (window, vault).  ``disks`` (the failed disks of the vault-window, the
    content of the detailed output) is kept only when asked for."""
    return _q2_counts(parsed_stream(lines, "q2", watermark=watermark), grain, disks)


def _q2_counts(recs: DataFrame, grain: Grain, disks: bool) -> DataFrame:
    recs = failed(recs)
    aggs = [F.sum("failure").cast("long").alias("failures")]
    if disks:
        aggs.append(F.collect_list(F.struct(F.col("ts").alias("event_ts"), "model", "serial_number")).alias("disks"))
    return recs.groupBy(grain.window("ts").alias("window"), "vault_id").agg(*aggs)


def q2_stream(lines: DataFrame, grain: Grain = DAY, k: int = TOP_K, watermark: str = WATERMARK) -> DataFrame:
    """ts, rank, vault_id, failures per closed window (TOP-1): two chained
    windowed aggregations; the second keeps one (failures, vault) pair per
    failing vault of a window and emits the first k of their sorted array."""
    return _q2_from_records(parsed_stream(lines, "q2", watermark=watermark), grain, k)


def _q2_from_records(recs: DataFrame, grain: Grain, k: int) -> DataFrame:
    per_vault = _q2_counts(recs, grain, disks=False)
    per_window = per_vault.groupBy(grain.window(F.window_time("window")).alias("window")).agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("failures")).alias("neg"), "vault_id"))), 1, k).alias("top")
    )
    ranked = per_window.select("window", F.posexplode("top").alias("pos", "r"))
    return ranked.select(
        window_text("window.start").alias("ts"),
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("r.vault_id").alias("vault_id"),
        (-F.col("r.neg")).alias("failures"),
    )


def q2_failures_stream_all_grains(lines: DataFrame, grains=GRAINS, watermark: str = WATERMARK) -> DataFrame:
    """First stage of Query 2 with disks for every grain in one query: grain,
    window, vault_id, failures, disks."""
    recs = parsed_stream(lines, "q2", watermark=watermark)
    out = None
    for g in grains:
        part = _q2_counts(recs, g, disks=True).select(F.lit(g.label).alias("grain"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def rank_closed_windows(per_vault: DataFrame, k: int = TOP_K) -> DataFrame:
    """Batch ranking of first-stage rows (one micro-batch holds every vault of
    the windows it closes): [grain,] ts, rank, vault_id, failures, disk_details."""
    by = ("grain",) if "grain" in per_vault.columns else ()
    ranked = rank_top_k(per_vault, k, by=by)
    return ranked.select(
        *by,
        window_text("window.start").alias("ts"),
        "rank",
        "vault_id",
        "failures",
        disks_text(F.array_sort(F.col("disks"))).alias("disk_details"),
    )


def q2_details_batch_writer(write, k: int = TOP_K):
    """``foreachBatch`` function: rank the closed windows of a micro-batch and
    hand the detailed rows to ``write(df, batch_id)``."""

    def _each(batch: DataFrame, batch_id: int) -> None:
        write(rank_closed_windows(batch, k), batch_id)

    return _each


def q3_stream(
    lines: DataFrame,
    grain: Grain = DAY,
    vaults=Q3_VAULTS,
    dedup_key: str = "serial_number",
    watermark: str = WATERMARK,
    approx: bool = False,
) -> DataFrame:
    """ts, vault_id, count, min/p25/p50/p75/max_hours per closed window."""
    return _q3_from_records(parsed_stream(lines, "q3", key=dedup_key, watermark=watermark), grain, vaults, dedup_key, approx)


def _q3_from_records(recs: DataFrame, grain: Grain, vaults, dedup_key: str, approx: bool = False) -> DataFrame:
    recs = select_q3(recs, vaults, dedup_key)
    latest = _latest(recs, grain, dedup_key)
    by_vault = latest.groupBy(grain.window(F.window_time("window")).alias("window"), "vault_id")
    if approx:
        x = F.col("s9")
        agg = by_vault.agg(
            F.count(F.lit(1)).alias("count"),
            F.min(x).alias("min_hours"),
            F.percentile_approx(x, [q for q, _ in QUANTILES], 10000).alias("_qs"),
            F.max(x).alias("max_hours"),
        )
        cols = [F.col("_qs")[i].alias(f"{name}_hours") for i, (_, name) in enumerate(QUANTILES)]
        return agg.select(window_text("window.start").alias("ts"), "vault_id", "count", "min_hours", *cols, "max_hours")
    agg = by_vault.agg(F.array_sort(F.collect_list("s9")).alias("vals"))
    cols = hazen_columns(F.col("vals"))
    named = [cols[0], cols[1].alias("min_hours")] + [c.alias(f"{n}_hours") for c, (_, n) in zip(cols[2:5], QUANTILES)] + [
        cols[5].alias("max_hours")
    ]
    return agg.select(window_text("window.start").alias("ts"), "vault_id", *named)


def q3_latest_stream(
    lines: DataFrame, grain: Grain = DAY, vaults=Q3_VAULTS, dedup_key: str = "serial_number", watermark: str = WATERMARK
) -> DataFrame:
    """First stage of Query 3: window, vault_id, <key>, s9 (latest hours) per
    closed (window, vault, key).  State holds one value per key."""
    recs = select_q3(parsed_stream(lines, "q3", key=dedup_key, watermark=watermark), vaults, dedup_key)
    return _latest(recs, grain, dedup_key)


def q3_quantiles_batch_writer(write):
    """``foreachBatch`` function: exact Hazen quantiles of each micro-batch of
    closed windows with the batch operator (range-partitioned positions, so a
    hot vault is split across tasks), handed to ``write(df, batch_id)`` as
    ts, vault_id, count, min/p25/p50/p75/max_hours."""

    def _each(batch: DataFrame, batch_id: int) -> None:
        q = hazen_quantiles(batch, ["window", "vault_id"], "s9")
        write(
            q.select(
                window_text("window.start").alias("ts"),
                "vault_id",
                "count",
                *[F.col(c).alias(f"{c}_hours") for c in ("min", "p25", "p50", "p75", "max")],
            ),
            batch_id,
        )

    return _each
