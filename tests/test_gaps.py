"""Time gaps: hot buckets, one full shuffle, brute force."""

import datetime as dt
import random

from test_skew import _shuffle_records
from vaultscope.operators.gaps import bucketed, previous_value, time_gaps

BASE = dt.datetime(2023, 4, 1)
SCHEMA = "event_id long, ts timestamp, vault_id int, x string"


def brute(rows, grouped):
    last, out = {}, []
    for i, ts, vault, x in sorted(rows, key=lambda r: (r[1] or dt.datetime.min, r[0])):
        g = vault if grouped else 0
        before = last.get(g, (None, None))
        gap = (ts - before[0]) // dt.timedelta(milliseconds=1) if ts and before[0] else 0
        out.append((i, gap, before[1]))
        last[g] = (ts, x)
    return sorted(out)


def got(spark, rows, grouped, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    by = ["vault_id"] if grouped else None
    gaps = {r.event_id: r.gap_ms for r in time_gaps(df, group_cols=by, **kw).collect()}
    prev = {r.event_id: r.prev for r in previous_value(df, "ts", "event_id", "x", by, **kw).collect()}
    return sorted((i, gaps[i], prev[i]) for i in gaps)


def table(n, seed=2):
    """A third of the rows in one vault, a tenth at one instant, gaps of days, null vaults and values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ts = BASE + dt.timedelta(days=7) if i % 10 == 0 else BASE + dt.timedelta(seconds=rng.randrange(60) + 86400 * rng.choice([0, 0, 3, 20]), milliseconds=rng.randrange(1000))
        rows.append((i, ts, 1000 if i % 3 == 0 else rng.choice([1001, 1002, None]), rng.choice(["a", "b", None])))
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = table(900)
    for grouped in (False, True):
        want = brute(rows, grouped)
        assert got(spark, rows, grouped) == want
        assert got(spark, rows, grouped, bucket="3 seconds", most=20) == want
        assert got(spark, rows, grouped, bucket="400 days", most=1) == want
    assert got(spark, [], True) == []
    odd = [(1, None, 1000, "a"), (2, None, 1000, "b"), (3, BASE, 1000, "c"), (-(2**62), BASE, 1000, "d"), (2**62, BASE, 1000, "e")]
    assert got(spark, odd, True, most=1) == brute(odd, True)


def test_hot_buckets_are_cut(spark):
    """A dump of rows with one timestamp, and a busy minute, are spread over many tasks."""
    n, most = 9000, 500
    at = lambda i: BASE if i % 3 == 0 else BASE + dt.timedelta(days=1, milliseconds=i * 6)
    df = spark.createDataFrame([(i, at(i), 1000, "x") for i in range(n)], SCHEMA)
    sizes = [r["count"] for r in bucketed(df, "ts", "event_id", [], most=most).groupBy("_group", "_bucket", "_part").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 1.2 * most


def test_rows_are_shuffled_once(spark):
    """One full shuffle: the other exchanges carry combined rows of the bucket table."""
    n = 20_000
    df = spark.range(n).selectExpr("id as event_id", "timestamp_micros(1680000000000000 + id * 60000) as ts", "cast(1000 + id % 2 as int) as vault_id", "'x' as x")
    df = df.repartition(8).cache()
    df.count()
    for by in (None, ["vault_id"]):
        out = time_gaps(df, group_cols=by)
        out.write.format("noop").mode("overwrite").save()
        assert n <= _shuffle_records(out) < 1.3 * n
