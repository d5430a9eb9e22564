"""Every grain from one pass over the records: closed days rolled up in state.

The records are aggregated per day by a windowed aggregation.  The rows of closed days
go on, in the same streaming query, into a second one that merges them into the open
windows of all grains, with one state row per (grain, window, key):

======= ============================== =========================================
query   key                            buffer
======= ============================== =========================================
``q1``  vault                          n, sum and m2, with each day's n and sum
``q2``  vault                          failures
``q3``  vault, disk                    time and value of the latest reading
======= ============================== =========================================

One operator holds windows of every size as session windows: a day's session runs from
its end to the end of the coarser window, so that the days of a window overlap, merge
into one session and close together, when the watermark passes the window's end.
Variances are merged exactly as in :func:`~vaultscope.operators.stats.rollup_partials`:
a window of d days keeps d pairs (n, sum), since the mean they deviate from is known last.

So the raw lines are read and parsed once for all grains, and the state of a 23-day
window does not grow with its records.  Ranks and quantiles are made per micro-batch by
the batch operators (:func:`finish_closed`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.failures import failed, rank_top_k
from ..operators.quantiles import hazen_quantiles
from ..operators.stats import partials_to_stats
from ..plans.query1 import Q1_VAULTS, select_q1
from ..plans.query2 import TOP_K
from ..plans.query3 import Q3_VAULTS, select_q3
from ..windows import DAY, GRAINS, window_text

WATERMARK = "30 seconds"  # the reference's out-of-order bound, as in streaming/queries.py


def select_records(good: DataFrame, query: str, dedup_key: str = "serial_number") -> DataFrame:
    """The good records of ``query``, its own rows and columns only."""
    if query == "q1":
        return select_q1(good, Q1_VAULTS).select("ts", "vault_id", "s194")
    if query == "q2":
        return failed(good).select("ts", "vault_id", "failure", "model", "serial_number")
    return select_q3(good, Q3_VAULTS, dedup_key).select("ts", "vault_id", dedup_key, "s9")


def closed_windows(
    records: DataFrame, query: str, grains=GRAINS, watermark: str = WATERMARK, dedup_key: str = "serial_number"
) -> DataFrame:
    """A stream of closed windows of every grain from a stream of :func:`select_records`:
    grain, window, the key columns and the query's buffer (n, sum, m2; failures; s9).

    A column ``closing`` marks records that move the watermark on and count nowhere.
    """
    if not all(g.contains(DAY) for g in grains):
        raise ValueError("every grain must consist of whole days")
    recs = records.withWatermark("ts", watermark)
    if "closing" in records.columns:
        # the event time in the condition keeps Spark from testing it below the watermark
        recs = recs.where(~F.col("closing") | F.col("ts").isNull())
    keys = ["vault_id", dedup_key] if query == "q3" else ["vault_id"]
    x, rows = F.col("s194"), F.count(F.lit(1))
    per_day = {
        "q1": lambda: [rows.alias("n"), F.sum(x).alias("sum"), (F.var_pop(x) * rows).alias("m2")],
        "q2": lambda: [F.sum("failure").cast("long").alias("failures")],
        "q3": lambda: [F.max(F.struct("ts", "s9")).alias("last")],
    }[query]()
    days = recs.groupBy(DAY.window("ts").alias("window"), *keys).agg(*per_day)
    # the day's last moment carries the watermark into the second aggregation
    days = days.select("*", F.window_time("window").alias("at"))
    of = F.explode(F.array(*[F.struct(F.lit(g.label).alias("grain"), g.window_of("window.start").alias("whole")) for g in grains]))
    spread = days.select("*", of.alias("of")).select("*", "of.grain", "of.whole").drop("of")
    left = F.unix_micros("whole.end") - F.unix_micros("at")
    place = F.date_diff(F.col("window.start").cast("date"), F.col("whole.start").cast("date"))
    slots = range(max(g.size_days for g in grains))
    merged = {
        "q1": lambda: [F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("m2").alias("m2"),
                       *[F.max(F.when(place == k, F.col(c))).alias(f"{c}{k}") for k in slots for c in ("n", "sum")]],
        "q2": lambda: [F.sum("failures").alias("failures")],
        "q3": lambda: [F.max("last").alias("last")],
    }[query]()
    session = F.session_window("at", F.concat(left.cast("string"), F.lit(" microseconds")))
    closed = spread.groupBy("grain", "whole", *keys, session.alias("session")).agg(*merged)
    window = F.col("whole").alias("window")
    if query != "q1":
        return closed.select("grain", window, *keys, *(["failures"] if query == "q2" else ["last.s9"]))
    mean = F.col("sum") / F.col("n")
    apart = [F.coalesce(F.col(f"n{k}") * (F.col(f"sum{k}") / F.col(f"n{k}") - mean) ** 2, F.lit(0.0)) for k in slots]
    return closed.select("grain", window, *keys, "n", "sum", (F.col("m2") + reduce(lambda a, b: a + b, apart)).alias("m2"))


def finish_closed(closed: DataFrame, query: str, k: int = TOP_K) -> DataFrame:
    """The query's rows, after ``grain``, of a micro-batch of :func:`closed_windows`."""
    if query == "q1":
        stats = partials_to_stats(closed, keep=("grain",))
        return stats.select("grain", window_text("window.start").alias("ts"), "vault_id", "count", "mean_s194", "stddev_s194")
    if query == "q2":
        ranked = rank_top_k(closed, k, by=("grain",))
        return ranked.select("grain", window_text("window.start").alias("ts"), "rank", "vault_id", "failures")
    quantiles = hazen_quantiles(closed, ["grain", "window", "vault_id"], "s9")
    hours = [F.col(c).alias(f"{c}_hours") for c in ("min", "p25", "p50", "p75", "max")]
    return quantiles.select("grain", window_text("window.start").alias("ts"), "vault_id", "count", *hours)
