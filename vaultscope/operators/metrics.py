"""Emission metrics (WIN-3, MET-1..4).

The reference reports, per window grain, the cumulative number of emitted
result rows over the time since the operator started: throughput = rows / s,
latency = ms / rows.  ``emission_metrics`` computes the same over any emission
log (a DataFrame with one row per emitted result and its emission time); the
running count is a skew-proof position from
:func:`vaultscope.operators.ranking.group_positions`.

``metric_log_lines`` renders the reference's two text lines per row (SNK-7)
and ``parse_metric_log`` reads them back into columns (MET-3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import group_positions

# The metric log line formats.
THROUGHPUT_LINE = "Window {grain} - Throughput: {value} tuples/s"
LATENCY_LINE = "Window {grain} - Latency: {value} ms/tuple"
METRIC_LINE_RE = r"^Window (.+) - (Throughput|Latency): (\S+) (tuples/s|ms/tuple)$"


def emission_metrics(
    emitted: DataFrame,
    start: DataFrame | None = None,
    group_col: str = "grain",
    at: str = "emitted_at",
    tiebreak: list[str] | None = None,
    first_col: str = "first_ts",
) -> DataFrame:
    """``emitted``: one row per emitted result with ``group_col`` and ``at``;
    ``start``: one row per ``group_col`` with ``started_at``.  Without
    ``start`` the clock of a group starts at the smallest ``first_col`` of its
    rows (read from the checkpointed positions, not from the input again).

    Adds n (running count in emission order), elapsed_ms, rows_per_s, ms_per_row.
    """
    order = [at, *(tiebreak or [])]
    pos = group_positions(emitted, [group_col], order)
    if start is None:
        start = pos.groupBy(group_col).agg(F.min(first_col).alias("started_at"))
    joined = pos.join(start, group_col)
    if first_col in emitted.columns:
        emitted = emitted.drop(first_col)
    n = (F.col("_pos") + 1).cast("long")
    elapsed_ms = F.unix_millis(F.col(at)) - F.unix_millis(F.col("started_at"))
    return joined.select(
        *emitted.columns,
        n.alias("n"),
        elapsed_ms.alias("elapsed_ms"),
        F.try_divide(n, elapsed_ms / 1000.0).alias("rows_per_s"),
        F.try_divide(elapsed_ms, n).alias("ms_per_row"),
    )


def _num_text(c: Column) -> Column:
    return c.cast("string")


def metric_log_lines(metrics: DataFrame, grain_label: str = "grain") -> DataFrame:
    """SNK-7: two lines per metric row, as ``value``."""
    g = F.col(grain_label)
    lines = F.array(
        F.concat(F.lit("Window "), g, F.lit(" - Throughput: "), _num_text(F.col("rows_per_s")), F.lit(" tuples/s")),
        F.concat(F.lit("Window "), g, F.lit(" - Latency: "), _num_text(F.col("ms_per_row")), F.lit(" ms/tuple")),
    )
    return metrics.select(F.explode(lines).alias("value"))


def parse_metric_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """MET-3: grain, metric, value (double), unit; other lines are dropped."""
    v = F.col(value)
    parsed = lines.select(
        F.regexp_extract(v, METRIC_LINE_RE, 1).alias("grain"),
        F.lower(F.regexp_extract(v, METRIC_LINE_RE, 2)).alias("metric"),
        F.regexp_extract(v, METRIC_LINE_RE, 3).try_cast("double").alias("value"),
        F.regexp_extract(v, METRIC_LINE_RE, 4).alias("unit"),
    )
    return parsed.where(F.col("grain") != "")
