import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultscope.plans import query1
from vaultscope.sources.telemetry import telemetry
from vaultscope.windows import ALL_TIME, DAY, GRAINS, THREE_DAYS, Grain

SCHEMA = "ts timestamp, vault_id int, failure int, model string, serial_number string, s194 double, s9 double"


def recs(spark, rows):
    return spark.createDataFrame([(t, v, 0, "m", "s", x, 1.0) for t, v, x in rows], SCHEMA)


def T(*a):
    return dt.datetime(*a)


def test_count_mean_stddev_and_single_row(spark):
    rows = [(T(2023, 4, 1, 1), 1001, x) for x in (20.0, 22.0, 27.0)] + [(T(2023, 4, 1, 5), 1002, 30.0)]
    out = {r.vault_id: r for r in query1.temperature_stats(recs(spark, rows), DAY).collect()}
    assert out[1001]["count"] == 3
    assert out[1001].mean_s194 == pytest.approx(statistics.mean([20, 22, 27]))
    assert out[1001].stddev_s194 == pytest.approx(statistics.stdev([20, 22, 27]))
    # one reading: stddev 0.0, not NULL
    assert out[1002]["count"] == 1 and out[1002].stddev_s194 == 0.0
    assert out[1001].ts == "2023-04-01 00:00:00"


def test_vault_range_edges(spark):
    rows = [(T(2023, 4, 1), v, 1.0) for v in (999, 1000, 1020, 1021)]
    got = {r.vault_id for r in query1.temperature_stats(recs(spark, rows), DAY).collect()}
    assert got == {1000, 1020}


def test_null_temperature_not_counted(spark):
    rows = [(T(2023, 4, 1), 1000, 10.0), (T(2023, 4, 1), 1000, None)]
    (r,) = query1.temperature_stats(recs(spark, rows), DAY).collect()
    assert r["count"] == 1


@pytest.mark.parametrize(
    "grain,day,start",
    [
        (DAY, T(2023, 4, 2, 23, 59, 59), "2023-04-02 00:00:00"),
        (DAY, T(2023, 4, 3), "2023-04-03 00:00:00"),
        (THREE_DAYS, T(2023, 4, 2), "2023-04-01 00:00:00"),
        (THREE_DAYS, T(2023, 4, 4), "2023-04-04 00:00:00"),
        (ALL_TIME, T(2023, 4, 2), "2023-04-01 00:00:00"),
        (ALL_TIME, T(2023, 4, 23, 23), "2023-04-01 00:00:00"),
        (ALL_TIME, T(2023, 4, 24), "2023-04-24 00:00:00"),
    ],
)
def test_window_assignment(spark, grain, day, start):
    (r,) = query1.temperature_stats(recs(spark, [(day, 1000, 1.0)]), grain).collect()
    assert r.ts == start


def test_grain_validation():
    with pytest.raises(ValueError):
        Grain("bad", 3, 3)
    with pytest.raises(ValueError):
        Grain("bad", 0, 0)


def test_arithmetic_window_equals_window(spark):
    df = spark.createDataFrame([(T(2023, 4, d, h),) for d in range(1, 28) for h in (0, 13)], "ts timestamp")
    for g in GRAINS:
        bad = df.where(g.window("ts") != g.window_of("ts")).count()
        assert bad == 0, g


def test_grain_containment():
    assert THREE_DAYS.contains(DAY) and ALL_TIME.contains(DAY)
    assert not ALL_TIME.contains(THREE_DAYS)
    assert not Grain("x", 3, 1).contains(Grain("y", 2, 0))


@pytest.mark.parametrize("coarse", [THREE_DAYS, ALL_TIME], ids=lambda g: g.label)
def test_rollup_equals_direct(spark, coarse):
    """Property 1 of the stored results: rolling up day rows gives the coarse rows."""
    rec = telemetry(spark, SF_SMALL)
    direct = {(r.ts, r.vault_id): r for r in query1.temperature_stats(rec, coarse).collect()}
    rolled = {(r.ts, r.vault_id): r for r in query1.temperature_stats_rollup(rec, coarse).collect()}
    assert direct.keys() == rolled.keys() and direct
    for k, a in direct.items():
        b = rolled[k]
        assert a["count"] == b["count"]
        assert a.mean_s194 == pytest.approx(b.mean_s194, rel=1e-12)
        assert a.stddev_s194 == pytest.approx(b.stddev_s194, rel=1e-9, abs=1e-9)


def test_rollup_rejects_misaligned_grain(spark):
    with pytest.raises(ValueError):
        query1.temperature_stats_rollup(recs(spark, [(T(2023, 4, 1), 1000, 1.0)]), ALL_TIME, fine=THREE_DAYS)


def test_all_grains_one_scan(spark):
    rec = telemetry(spark, SF_SMALL)
    out = query1.temperature_stats_all_grains(rec)
    out.write.format("noop").mode("overwrite").save()
    counts = {r.grain: r["sum(count)"] for r in out.groupBy("grain").agg(F.sum("count")).collect()}
    # every grain sees every kept reading once
    assert len(set(counts.values())) == 1 and set(counts) == {g.label for g in GRAINS}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_filters_reach_parquet_scan(spark):
    rec = telemetry(spark, SF_SMALL, query1.Q1_VAULTS)
    plan = query1.temperature_stats(rec, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(user_id,0), LessThanOrEqual(user_id,20)" in plan
    # only the needed columns are read
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
