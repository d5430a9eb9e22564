"""Property tests: Spark operators against brute force in Python on random input."""

import datetime as dt
import math
import re
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vaultscope.functions import parse
from vaultscope.operators.quantiles import QUANTILES, hazen_quantiles
from vaultscope.plans import query1
from vaultscope.windows import ALL_TIME, THREE_DAYS

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "ts timestamp, vault_id int, failure int, model string, serial_number string, s194 double, s9 double"


def hazen(values, q):
    x = sorted(values)
    n = len(x)
    h = min(max(q * n - 0.5, 0), n - 1)
    lo = math.floor(h)
    return x[lo] + (h - lo) * (x[min(lo + 1, n - 1)] - x[lo])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-1000, 1000)), min_size=1, max_size=60))
def test_hazen_brute_force(spark, rows):
    df = spark.createDataFrame([(g, float(x)) for g, x in rows], "g int, x double")
    got = {r.g: r for r in hazen_quantiles(df, ["g"], "x").collect()}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(float(x))
    assert set(got) == set(groups)
    for g, xs in groups.items():
        r = got[g]
        assert r["count"] == len(xs) and r["min"] == min(xs) and r["max"] == max(xs)
        for q, name in QUANTILES:
            assert math.isclose(r[name], hazen(xs, q), rel_tol=1e-12, abs_tol=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 40 * 24), st.integers(1000, 1003), st.floats(-50, 150)), min_size=1, max_size=80))
def test_rollup_brute_force(spark, rows):
    base = dt.datetime(2023, 3, 20)
    recs = [(base + dt.timedelta(hours=h), v, 0, "m", "s", x, 1.0) for h, v, x in rows]
    df = spark.createDataFrame(recs, SCHEMA)
    for grain in (THREE_DAYS, ALL_TIME):
        got = {(r.ts, r.vault_id): r for r in query1.temperature_stats_rollup(df, grain).collect()}
        want = {}
        for t, v, _, _, _, x, _ in recs:
            days = (t - dt.datetime(1970, 1, 1)).days
            start = days - (days - grain.offset_days) % grain.size_days
            key = ((dt.datetime(1970, 1, 1) + dt.timedelta(days=start)).strftime("%Y-%m-%d %H:%M:%S"), v)
            want.setdefault(key, []).append(x)
        assert set(got) == set(want)
        for k, xs in want.items():
            r = got[k]
            assert r["count"] == len(xs)
            assert math.isclose(r.mean_s194, statistics.fmean(xs), rel_tol=1e-9, abs_tol=1e-9)
            sd = statistics.stdev(xs) if len(xs) > 1 else 0.0
            assert math.isclose(r.stddev_s194, sd, rel_tol=1e-7, abs_tol=1e-7)


INT_RE = re.compile(r"^[+-]?[0-9]+$")
TS_RE = re.compile(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}$")


def _java_like_reason(line: str, query: str) -> str | None:
    """The reference's parse rules, written out directly."""
    f = line.split(",")
    if len(f) < 26:
        return "too_few_fields"
    ts = f[0].replace("T", " ")
    if not TS_RE.match(ts):
        return "bad_timestamp"
    try:
        dt.datetime.strptime(ts, "%Y-%m-%d %H:%M:%S.%f")
    except ValueError:
        return "bad_timestamp"
    if not INT_RE.match(f[4]) or not -(2**31) <= int(f[4]) < 2**31:
        return "bad_vault_id"
    if query == "q2" and (not INT_RE.match(f[3]) or not -(2**31) <= int(f[3]) < 2**31):
        return "bad_failure"
    if query == "q1":
        if f[25] == "":
            return "empty_temperature"
        try:
            float(f[25])
        except ValueError:
            return "bad_temperature"
    if query == "q3":
        if f[1] == "":
            return "empty_key"
        if f[12] == "":
            return "empty_hours"
        try:
            float(f[12])
        except ValueError:
            return "bad_hours"
    return None


FIELD = st.sampled_from(["", "1", "-3", "+7", "12.5", "x", " 4 ", "99999999999", "NaN", "1e3"])
TS = st.sampled_from(
    ["2023-04-01T00:00:00.000000", "2023-04-01 12:30:00.123456", "2023-04-01T00:00:00", "2023-13-01T00:00:00.000000", "bad", ""]
)


@SETTINGS
@given(st.lists(st.tuples(TS, st.lists(FIELD, min_size=24, max_size=40)), min_size=1, max_size=25))
def test_reject_reasons_brute_force(spark, cases):
    lines = [",".join([ts, *fields]) for ts, fields in cases]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    for query in ("q1", "q2", "q3"):
        got = [r.reject_reason for r in parse.parse_lines(df, query).collect()]
        want = [_java_like_reason(x, query) for x in lines]
        assert sorted(map(str, got)) == sorted(map(str, want)), query
