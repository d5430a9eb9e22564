"""Latest value per key and interpolated quantiles per group (Query 3).

AGG-8 ``latest_per_key``: one row per (window, group, key) holding the value of
the latest reading; ties on the timestamp go to the larger value, so the result
does not depend on arrival order.  ``max_by`` is a partial aggregate.  Its
struct ordering key makes Spark plan a sort-based aggregate (struct buffers do
not fit the hash map).  A decimal of the time beside the sign-flipped bits of
the double would be an exact ordering key that does fit, but Spark has no
function that gives a double's bits, and the hash-only alternative (max per
(key, ts), then ``max_by`` per key) costs a second shuffle of nearly every row, so
one shuffle with a sorted map-side combine is kept.

AGG-10 / AGG-11 quantile rule (Hazen): with the values sorted as x[0..n-1],

    h = clamp(q * n - 0.5, 0, n - 1)
    Q(q) = x[floor h] + (h - floor h) * (x[floor h + 1] - x[floor h])

so Q(0) is the minimum and Q(1) the maximum.

Forms:

* ``hazen_quantiles`` (batch, exact): positions from
  :func:`vaultscope.operators.ranking.group_positions`, then one group-by with
  conditional ``max(x) where pos = i`` aggregates.  Nothing is gathered per
  group; every step is a partial aggregate or a range-partitioned sort.
* ``hazen_from_sorted`` (stream, exact): Hazen on ``array_sort(collect_list)``.
  Streaming refuses window functions, so the second aggregation of the chained
  streaming query holds the group's values (one per key) in its state.
* ``approx_quantiles`` (AGG-12): ``percentile_approx`` over the values; bounded in size, for
  groups too large to hold.
* ``quantile_sketches``, ``merge_sketches``, ``sketch_quantiles`` (AGG-12): KLL sketches as
  values.  Sketches of fine windows are kept once and merged to any coarser grain or set of
  groups without the readings; ``rank_errors`` says how far off their quantiles are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..windows import Grain
from .ranking import group_positions

# The quantiles Query 3 reports, with their output names.
QUANTILES = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))


def latest_per_key(
    records: DataFrame,
    grain: Grain,
    key: str = "serial_number",
    value: str = "s9",
    group: str = "vault_id",
) -> DataFrame:
    """window, <group>, <key>, <value>: the latest reading per key."""
    return records.groupBy(grain.window("ts").alias("window"), F.col(group), F.col(key)).agg(
        F.max_by(F.col(value), F.struct(F.col("ts"), F.col(value))).alias(value)
    )


def _h(q: float, n: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(q) * n - F.lit(0.5), n - F.lit(1)))


def hazen_quantiles(df: DataFrame, group_cols: list[str], value: str, prefix: str = "") -> DataFrame:
    """group..., count, min, p25, p50, p75, max (names prefixed by ``prefix``)."""
    # equal values are one weighted row: combined before the shuffle, and no ties are left to cut
    values = df.groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_weight"))
    ranked = group_positions(values, group_cols, value, weight="_weight")
    pos, n, x = F.col("_pos"), F.col("_n"), F.col(value)
    holds = lambda k: (pos <= k) & (k < pos + F.col("_weight"))
    aggs = [F.sum("_weight").alias("count"), F.min(x).alias(f"{prefix}min")]
    for q, name in QUANTILES:
        lo = F.floor(_h(q, n))
        aggs += [F.max(F.when(holds(lo), x)).alias(f"_{name}_lo"), F.max(F.when(holds(lo + 1), x)).alias(f"_{name}_hi")]
    aggs.append(F.max(x).alias(f"{prefix}max"))
    agg = ranked.groupBy(*group_cols).agg(*aggs)
    cnt = F.col("count")
    cols = [*group_cols, "count", f"{prefix}min"]
    for q, name in QUANTILES:
        h = _h(q, cnt)
        lo_v, hi_v = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        cols.append((lo_v + (h - F.floor(h)) * (F.coalesce(hi_v, lo_v) - lo_v)).alias(f"{prefix}{name}"))
    cols.append(f"{prefix}max")
    return agg.select(*cols)


def hazen_from_sorted(sorted_values: Column, q: float) -> Column:
    """Hazen quantile of an ascending array (1-based ``element_at``)."""
    n = F.size(sorted_values)
    h = _h(q, n)
    lo = F.floor(h).cast("int")
    lo_v = F.element_at(sorted_values, lo + 1)
    hi_v = F.element_at(sorted_values, F.least(lo + 2, n))
    return lo_v + (h - lo) * (hi_v - lo_v)


def hazen_columns(sorted_values: Column, prefix: str = "") -> list[Column]:
    """count, min, p25, p50, p75, max from an ascending array."""
    return [
        F.size(sorted_values).cast("long").alias("count"),
        F.element_at(sorted_values, 1).alias(f"{prefix}min"),
        *[hazen_from_sorted(sorted_values, q).alias(f"{prefix}{name}") for q, name in QUANTILES],
        F.element_at(sorted_values, -1).alias(f"{prefix}max"),
    ]


def approx_quantiles(df: DataFrame, group_cols: list[str], value: str, prefix: str = "", accuracy: int = 10000) -> DataFrame:
    """AGG-12: count, min, p25, p50, p75, max with ``percentile_approx``
    (rank error about 1/accuracy of the group size; min and max exact)."""
    x = F.col(value)
    qs = F.percentile_approx(x, [q for q, _ in QUANTILES], accuracy)
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("count"), F.min(x).alias(f"{prefix}min"), qs.alias("_qs"), F.max(x).alias(f"{prefix}max")
    )
    return agg.select(
        *group_cols,
        "count",
        f"{prefix}min",
        *[F.col("_qs")[i].alias(f"{prefix}{name}") for i, (_, name) in enumerate(QUANTILES)],
        f"{prefix}max",
    )


def quantile_sketches(df: DataFrame, group_cols: list[str], value: str, k: int = 400) -> DataFrame:
    """group..., sketch (KLL, at most a few kilobytes), min and max of a numeric column.
    NULL values are left out; a group without any value has no row."""
    x = F.col(value).cast("double")
    return df.where(x.isNotNull()).groupBy(*group_cols).agg(
        F.kll_sketch_agg_double(x, k).alias("sketch"), F.min(x).alias("min"), F.max(x).alias("max")
    )


def merge_sketches(sketches: DataFrame, group_cols: list) -> DataFrame:
    """The sketches of coarser groups from those of finer ones (:func:`quantile_sketches`)."""
    return sketches.groupBy(*group_cols).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.min("min").alias("min"), F.max("max").alias("max")
    )


def sketch_quantiles(sketches: DataFrame, group_cols: list[str], prefix: str = "") -> DataFrame:
    """group..., count, min, p25, p50, p75, max from sketches; count, min and max are exact."""
    qs = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"{prefix}{name}") for q, name in QUANTILES]
    n = F.kll_sketch_get_n_double("sketch").alias("count")
    return sketches.select(*group_cols, n, F.col("min").alias(f"{prefix}min"), *qs, F.col("max").alias(f"{prefix}max"))


def rank_errors(quantiles: DataFrame, values: DataFrame, group_cols: list[str], value: str, prefix: str = "") -> DataFrame:
    """``quantiles`` with ``<name>_error`` for each of them: how far its place among the group's
    ``values`` is from q, as a share of them (0 where q lies within its ties).  One pass of
    counts that combine before their shuffle."""
    own = values.select(*[F.col(c).alias(f"_{c}") for c in group_cols], F.col(value).cast("double").alias("_x")).where("_x is not null")
    met = quantiles.join(own, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group_cols])
    counts = [F.count(F.lit(1)).alias("_n")]
    for _, name in QUANTILES:
        at = F.col(f"{prefix}{name}")
        counts += [F.count_if(F.col("_x") < at).alias(f"_{name}_lo"), F.count_if(F.col("_x") <= at).alias(f"_{name}_hi")]
    placed = met.groupBy(*quantiles.columns).agg(*counts)
    errors = [
        F.greatest(F.col(f"_{name}_lo") / F.col("_n") - q, q - F.col(f"_{name}_hi") / F.col("_n"), F.lit(0.0)).alias(f"{prefix}{name}_error")
        for q, name in QUANTILES
    ]
    return placed.select(*quantiles.columns, *errors)
