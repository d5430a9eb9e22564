"""Stream = batch: the streaming form over files of raw lines plus closing
lines must give exactly the batch result over the same lines (STR-*)."""

import datetime as dt
import os

import pytest

from conftest import SF_ORACLE
from vaultscope.functions import parse
from vaultscope.plans import query1, query2, query3
from vaultscope.sources.telemetry import telemetry
from vaultscope.sources.text import read_lines_stream, telemetry_lines
from vaultscope.streaming import queries as sq
from vaultscope.streaming.run import closing_line, closing_lines_for, closing_time, run_to_table
from vaultscope.windows import ALL_TIME, DAY, THREE_DAYS


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def line_dir(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lines"))
    lines = telemetry_lines(telemetry(spark, SF_ORACLE))
    lines.coalesce(2).write.text(os.path.join(base, "data"))
    closing = closing_lines_for(lines)
    return base, lines, closing


def _stream_dir(spark, base, closing, name):
    src = os.path.join(base, f"src_{name}")
    os.makedirs(src)
    # data files first, then the closing file (its own file, as a late-arriving drop)
    for f in sorted(os.listdir(os.path.join(base, "data"))):
        if f.endswith(".txt"):
            os.link(os.path.join(base, "data", f), os.path.join(src, f))
    closing.coalesce(1).write.text(os.path.join(base, f"closing_{name}"))
    for f in os.listdir(os.path.join(base, f"closing_{name}")):
        if f.endswith(".txt"):
            os.link(os.path.join(base, f"closing_{name}", f), os.path.join(src, "zz-closing.txt"))
    return src


def test_closing_time_past_every_window():
    last = dt.datetime(2024, 1, 30, 23, 0)
    t = closing_time(last)
    assert t >= dt.datetime(2024, 2, 1)
    assert closing_line(t, 1000).count(",") == 38


@pytest.mark.parametrize("grain", [DAY, THREE_DAYS, ALL_TIME], ids=lambda g: g.label)
def test_q1_stream_equals_batch(spark, line_dir, scratch, grain):
    base, lines, closing = line_dir
    src = _stream_dir(spark, base, closing, f"q1_{grain.label}")
    out = run_to_table(spark, sq.q1_stream(read_lines_stream(spark, src), grain), os.path.join(scratch, "ck"), f"q1s_{grain.label}")
    batch = query1.temperature_stats(parse.good_records(parse.parse_lines(lines, "q1")), grain)
    assert out.count() > 0
    assert _rows(out) == _rows(batch)


def test_q1_all_grains_one_stream_equals_batch(spark, line_dir, scratch):
    base, lines, closing = line_dir
    src = _stream_dir(spark, base, closing, "q1_all")
    out = run_to_table(spark, sq.q1_stream_all_grains(read_lines_stream(spark, src)), os.path.join(scratch, "ck"), "q1s_all")
    batch = query1.temperature_stats_all_grains(parse.good_records(parse.parse_lines(lines, "q1")))
    assert {r.grain for r in out.select("grain").distinct().collect()} == {"1day", "3days", "alltime"}
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_q2_stream_equals_batch(spark, line_dir, scratch):
    base, lines, closing = line_dir
    src = _stream_dir(spark, base, closing, "q2")
    out = run_to_table(spark, sq.q2_stream(read_lines_stream(spark, src), THREE_DAYS), os.path.join(scratch, "ck"), "q2s")
    batch = query2.top_vaults(parse.good_records(parse.parse_lines(lines, "q2")), THREE_DAYS)
    assert out.count() > 0
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_q2_details_foreach_batch_equals_batch(spark, line_dir, scratch):
    base, lines, closing = line_dir
    src = _stream_dir(spark, base, closing, "q2d")
    out_dir = os.path.join(scratch, "q2d_out")

    def write(df, _batch_id):
        df.write.mode("append").parquet(out_dir)

    q = (
        sq.q2_failures_stream(read_lines_stream(spark, src), THREE_DAYS)
        .writeStream.outputMode("append")
        .foreachBatch(sq.q2_details_batch_writer(write))
        .option("checkpointLocation", os.path.join(scratch, "ck"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    out = spark.read.parquet(out_dir)
    batch = query2.top_vault_details(parse.good_records(parse.parse_lines(lines, "q2")), THREE_DAYS)
    assert out.count() > 0
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_q3_stream_equals_batch(spark, line_dir, scratch):
    base, lines, closing = line_dir
    src = _stream_dir(spark, base, closing, "q3")
    out = run_to_table(spark, sq.q3_stream(read_lines_stream(spark, src), THREE_DAYS), os.path.join(scratch, "ck"), "q3s")
    batch = query3.power_on_quantiles(parse.good_records(parse.parse_lines(lines, "q3")), THREE_DAYS)
    assert out.count() > 0
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_last_window_needs_closing_line(spark, line_dir, scratch):
    """STR-6: without the closing line the last window never closes."""
    base, lines, _ = line_dir
    src = os.path.join(base, "src_noclose")
    os.makedirs(src)
    for f in os.listdir(os.path.join(base, "data")):
        if f.endswith(".txt"):
            os.link(os.path.join(base, "data", f), os.path.join(src, f))
    out = run_to_table(spark, sq.q1_stream(read_lines_stream(spark, src), DAY), os.path.join(scratch, "ck"), "q1_noclose")
    batch = query1.temperature_stats(parse.good_records(parse.parse_lines(lines, "q1")), DAY)
    got = {r.ts for r in out.select("ts").distinct().collect()}
    want = {r.ts for r in batch.select("ts").distinct().collect()}
    assert got < want and max(want) not in got


def test_late_row_dropped(spark, scratch):
    """STR-4: a row two batches behind the watermark is dropped."""
    src = os.path.join(scratch, "late")
    os.makedirs(src)
    base = dt.datetime(2024, 1, 1, 12)

    def write(name, rows):
        with open(os.path.join(src, name), "w") as fh:
            fh.write("\n".join(closing_line(t, v).replace(",2.5,", f",{temp},") for t, v, temp in rows) + "\n")

    write("a.txt", [(base, 1000, 20.0), (base + dt.timedelta(days=2), 1000, 30.0)])
    lines = read_lines_stream(spark, src, max_files_per_trigger=1)
    q = (
        sq.q1_stream(lines, DAY)
        .writeStream.outputMode("append")
        .format("memory")
        .queryName("late_q1")
        .option("checkpointLocation", os.path.join(scratch, "ck"))
        .start()
    )
    try:
        q.processAllAvailable()
        write("b.txt", [(base + dt.timedelta(days=3), 1000, 40.0)])
        q.processAllAvailable()
        # a row for the first day, long closed, arrives two batches later
        write("c.txt", [(base + dt.timedelta(hours=1), 1000, 99.0)])
        q.processAllAvailable()
        write("d.txt", [(base + dt.timedelta(days=5), 1000, 50.0)])
        q.processAllAvailable()
        dropped = sum(
            op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators
        )
    finally:
        q.stop()
    rows = {r.ts: (r["count"], r.mean_s194) for r in spark.table("late_q1").collect()}
    assert rows["2024-01-01 00:00:00"] == (1, 20.0)
    assert dropped >= 1


def test_rocksdb_state_store_equals_batch(spark, line_dir, scratch):
    """The same stream on the RocksDB state store (the setting for scale)."""
    from vaultscope.session import configure_streaming

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    configure_streaming(spark)
    try:
        base, lines, closing = line_dir
        src = _stream_dir(spark, base, closing, "q1_rocks")
        out = run_to_table(spark, sq.q1_stream(read_lines_stream(spark, src), THREE_DAYS), os.path.join(scratch, "ck"), "q1_rocks")
        batch = query1.temperature_stats(parse.good_records(parse.parse_lines(lines, "q1")), THREE_DAYS)
        assert "RocksDB" in spark.conf.get(key)
        assert _rows(out) == _rows(batch)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def test_q3_stream_sketch_equals_batch_sketch(spark, line_dir, scratch):
    """The bounded-state form: the same percentile_approx sketches in stream and batch."""
    base, lines, closing = line_dir
    src = _stream_dir(spark, base, closing, "q3_approx")
    out = run_to_table(
        spark, sq.q3_stream(read_lines_stream(spark, src), THREE_DAYS, approx=True), os.path.join(scratch, "ck"), "q3s_approx"
    )
    batch = query3.power_on_quantiles_approx(parse.good_records(parse.parse_lines(lines, "q3")), THREE_DAYS)
    assert out.count() > 0
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_q3_exact_foreach_batch_equals_batch(spark, line_dir, scratch):
    """Exact quantiles with bounded state: latest per key in the stream, Hazen
    per micro-batch of closed windows with the skew-proof batch operator."""
    base, lines, closing = line_dir
    src = _stream_dir(spark, base, closing, "q3_exact")
    out_dir = os.path.join(scratch, "q3e_out")

    def write(df, _batch_id):
        df.write.mode("append").parquet(out_dir)

    q = (
        sq.q3_latest_stream(read_lines_stream(spark, src), THREE_DAYS)
        .writeStream.outputMode("append")
        .foreachBatch(sq.q3_quantiles_batch_writer(write))
        .option("checkpointLocation", os.path.join(scratch, "ck"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    out = spark.read.parquet(out_dir)
    batch = query3.power_on_quantiles(parse.good_records(parse.parse_lines(lines, "q3")), THREE_DAYS)
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_closing_lines_of_no_lines(spark):
    assert closing_lines_for(spark.createDataFrame([], "value string")).count() == 0
    assert closing_lines_for(spark.createDataFrame([("no time",)], "value string")).count() == 0


def test_all_grains_in_several_batches_parse_each_line_once(spark):
    """The raw source is read once for all grains, over several micro-batches, and the
    result is that of one batch."""
    from conftest import SF_ORACLE
    from pyspark.sql.streaming import StreamingQueryListener

    from vaultscope.plans import registry
    from vaultscope.sources.telemetry import telemetry
    from vaultscope.sources.text import telemetry_lines
    from vaultscope.streaming import run as stream_run

    seen = []

    class Seen(StreamingQueryListener):
        def onQueryStarted(self, event): ...
        def onQueryIdle(self, event): ...
        def onQueryProgress(self, event):
            if event.progress.numInputRows:
                seen.append((str(event.progress.id), event.progress.numInputRows, event.progress.sources[0].description))
        def onQueryTerminated(self, event):
            ended.append(str(event.id))

    import time

    ended, listener = [], Seen()
    spark.streams.addListener(listener)
    lines = telemetry_lines(telemetry(spark, SF_ORACLE))
    try:
        rows = stream_run.all_grains_over_lines(spark, lines, "q1", "once", slices=5).count()
        for _ in range(600):
            if len(ended) == 6:  # one run for each slice and one for the closing lines
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    raw = [n for _, n, _ in seen]
    assert len(raw) >= 5 and sum(raw) == lines.count() + 2
    assert len({i for i, *_ in seen}) == 1 and rows > 0
    assert rows == registry.QUERIES["stream_q1_all_grains"](spark, SF_ORACLE).count()
