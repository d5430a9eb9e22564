import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from vaultscope.operators.quantiles import QUANTILES, approx_quantiles, hazen_quantiles
from vaultscope.operators.ranking import group_positions
from vaultscope.plans import query3
from vaultscope.windows import DAY

SCHEMA = "ts timestamp, vault_id int, failure int, model string, serial_number string, s194 double, s9 double"
T0 = dt.datetime(2023, 4, 1, 10)


def hazen(values, q):
    x = sorted(values)
    n = len(x)
    h = min(max(q * n - 0.5, 0), n - 1)
    lo = math.floor(h)
    hi = min(lo + 1, n - 1)
    return x[lo] + (h - lo) * (x[hi] - x[lo])


@pytest.mark.parametrize("n", [1, 2, 3, 5, 18, 20, 101])
def test_hazen_matches_rule(spark, n):
    rnd = random.Random(n)
    vals = [float(rnd.randint(0, 90000)) for _ in range(n)]
    df = spark.createDataFrame([(1, v) for v in vals], "g int, x double")
    (r,) = hazen_quantiles(df, ["g"], "x").collect()
    assert r["count"] == n and r["min"] == min(vals) and r["max"] == max(vals)
    for q, name in QUANTILES:
        assert r[name] == pytest.approx(hazen(vals, q))


def test_hazen_known_values(spark):
    # n = 4: h(0.25) = 0.5 -> midway x0..x1; h(0.5) = 1.5; h(0.75) = 2.5
    df = spark.createDataFrame([(1, v) for v in (10.0, 20.0, 40.0, 80.0)], "g int, x double")
    (r,) = hazen_quantiles(df, ["g"], "x").collect()
    assert (r.p25, r.p50, r.p75) == (15.0, 30.0, 60.0)


def test_latest_per_key_wins_and_ties(spark):
    rows = [
        (T0, 1095, 0, "m", "A", 0.0, 100.0),
        (T0 + dt.timedelta(hours=2), 1095, 0, "m", "A", 0.0, 50.0),  # later: wins though smaller
        (T0, 1095, 0, "m", "B", 0.0, 10.0),
        (T0, 1095, 0, "m", "B", 0.0, 30.0),  # same ts: larger wins
        (T0, 1095, 0, "m", "", 0.0, 999.0),  # empty key: dropped
        (T0, 1095, 0, "m", "C", 0.0, None),  # no hours: dropped
        (T0, 1089, 0, "m", "D", 0.0, 5.0),  # outside the vault range
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.serial_number: r.s9 for r in query3.latest_hours(df, DAY).collect()}
    assert got == {"A": 50.0, "B": 30.0}
    (q,) = query3.power_on_quantiles(df, DAY).collect()
    assert q["count"] == 2 and q.min_hours == 30.0 and q.max_hours == 50.0


def test_dedup_by_model(spark):
    rows = [(T0 + dt.timedelta(minutes=i), 1100, 0, "MOD", f"S{i}", 0.0, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    (a,) = query3.power_on_quantiles(df, DAY).collect()
    (b,) = query3.power_on_quantiles(df, DAY, dedup_key="model").collect()
    assert a["count"] == 5 and b["count"] == 1 and b.p50_hours == 4.0


def test_positions_split_a_hot_group(spark):
    """One group holds a third of the rows; positions still equal row_number
    and the group is spread over several range partitions."""
    n_hot, n_other = 3000, 6000
    rows = [(0, float(i % 997)) for i in range(n_hot)] + [(1 + i % 50, float(i)) for i in range(n_other)]
    df = spark.createDataFrame(rows, "g int, x double")
    pos = group_positions(df, ["g"], "x", num_partitions=8)
    parts = pos.where("g = 0").select("_pid").distinct().count()
    assert parts > 1
    ref = df.select("g", "x", (F.row_number().over(Window.partitionBy("g").orderBy("x")) - 1).alias("ref"))
    # positions are a permutation of 0..n-1 per group, consistent with value order
    got = pos.groupBy("g").agg(F.min("_pos").alias("lo"), F.max("_pos").alias("hi"), F.count("*").alias("n"),
                               F.max("_n").alias("nn")).collect()
    for r in got:
        assert r.lo == 0 and r.hi == r.n - 1 and r.nn == r.n
    a = sorted((r.g, r.x, r._pos) for r in pos.select("g", "x", "_pos").collect())
    b = sorted((r.g, r.x, r.ref) for r in ref.collect())
    # same value at every position
    va = {(g, p): x for g, x, p in a}
    vb = {(g, p): x for g, x, p in b}
    assert va == vb


def test_approx_quantiles_rank_error(spark):
    vals = np.random.default_rng(7).integers(0, 90000, 20000).astype(float)
    df = spark.createDataFrame([(1, float(v)) for v in vals], "g int, x double")
    (r,) = approx_quantiles(df, ["g"], "x").collect()
    s = np.sort(vals)
    for q, name in QUANTILES:
        rank = np.searchsorted(s, r[name], side="right") / len(s)
        assert abs(rank - q) < 0.01
    assert r["min"] == s[0] and r["max"] == s[-1]


def test_positions_null_group(spark):
    df = spark.createDataFrame([(None, 3.0), (None, 1.0), (1, 2.0)], "g int, x double")
    got = {(r.g, r.x): (r._pos, r._n) for r in group_positions(df, ["g"], "x").collect()}
    assert got == {(None, 1.0): (0, 2), (None, 3.0): (1, 2), (1, 2.0): (0, 1)}


def test_sketches_of_days_merge_to_the_sketch_of_all(spark):
    """Merged day sketches count every value; their quantiles keep the stated rank error, with
    ties, NULLs and one group far larger than a sketch."""
    from pyspark.sql import functions as F

    from vaultscope.operators.quantiles import merge_sketches, quantile_sketches, rank_errors, sketch_quantiles

    df = spark.range(90_000).select(
        (F.col("id") % 9).alias("day"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40 + 1).alias("g"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 5 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double")).alias("x"),
    )
    merged = merge_sketches(quantile_sketches(df, ["day", "g"], "x"), ["g"])
    exact = {r.g: (r.n, r.lo, r.hi) for r in df.groupBy("g").agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    out = rank_errors(sketch_quantiles(merged, ["g"]), df, ["g"], "x").collect()
    assert {r.g: (r["count"], r["min"], r["max"]) for r in out} == exact
    assert all(r[f"{p}_error"] <= 0.02 for r in out for p in ("p25", "p50", "p75"))
    assert any(r.p50_error == 0 for r in out)
    assert quantile_sketches(df.where("x is null"), ["g"], "x").count() == 0


def test_rank_error_is_the_distance_from_the_ties(spark):
    from vaultscope.operators.quantiles import rank_errors

    values = spark.createDataFrame([(1, float(v)) for v in (1, 2, 2, 2, 3, 4, 5, 6, 7, 8)], "g int, x double")
    q = spark.createDataFrame([(1, 2.0, 7.0, 2.0)], "g int, p25 double, p50 double, p75 double")
    r = rank_errors(q, values, ["g"], "x").first()
    assert (r.p25_error, round(r.p50_error, 9), round(r.p75_error, 9)) == (0.0, 0.3, 0.35)
