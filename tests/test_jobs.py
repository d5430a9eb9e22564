"""The job entry point: batch and stream runs of every query over a folder of
raw lines give the same results for every grain."""

import os

import pytest

from conftest import SF_ORACLE
from vaultscope import jobs
from vaultscope.sinks import kafka as kafka_sink
from vaultscope.sources.telemetry import telemetry
from vaultscope.sources.text import telemetry_lines
from vaultscope.streaming.run import closing_lines_for


@pytest.fixture(scope="module")
def line_folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("job_lines"))
    lines = telemetry_lines(telemetry(spark, SF_ORACLE))
    lines.coalesce(1).write.text(os.path.join(base, "in", "a"))
    closing_lines_for(lines).coalesce(1).write.text(os.path.join(base, "in", "b"))
    return base


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("query", ["q1", "q2", "q3"])
def test_run_batch_and_stream_agree(spark, line_folder, scratch, query):
    inp = os.path.join(line_folder, "in", "*")
    out_b, out_s = os.path.join(scratch, "b"), os.path.join(scratch, "s")
    names = jobs.main(["run", "--query", query, "--input", inp, "--output", out_b, "--mode", "batch"], spark=spark)
    assert names == list(kafka_sink.TOPICS[f"query{query[1]}"].values())
    jobs.main(["run", "--query", query, "--input", inp, "--output", out_s, "--mode", "stream", "--once",
               "--checkpoint", os.path.join(scratch, "ck")], spark=spark)
    streamed = spark.read.parquet(out_s)
    assert {r.topic for r in streamed.select("topic").distinct().collect()} <= set(names)
    for name in names:
        b = spark.read.parquet(os.path.join(out_b, name))
        s = streamed.where(streamed.topic == name).drop("topic")
        if query == "q2":
            # the stream form ranks without the disk text; the batch run also drops the closing windows' rows
            b = b.select("ts", "rank", "vault_id", "failures")
        closing_ts = {r.ts for r in b.collect()} - {r.ts for r in s.collect()}
        # only the closing lines' own window never closes in the stream
        assert len(closing_ts) <= 1
        b = b.where(~b.ts.isin(list(closing_ts))) if closing_ts else b
        assert s.count() > 0 and b.count() > 0
        assert _rows(s.select(*b.columns)) == _rows(b)


@pytest.mark.parametrize("query, more", [("q1", []), ("q2", []), ("q2", ["--no-details"]), ("q3", ["--dedup-key", "model"])])
def test_closed_run_equals_batch(spark, line_folder, scratch, query, more):
    """--once --close: every window of every grain is there without closing lines in the input,
    and running it again changes nothing."""
    inp = os.path.join(line_folder, "in", "a")
    out_b, out_s = os.path.join(scratch, "b"), os.path.join(scratch, "s")
    given = ["run", "--query", query, "--input", inp, *more]
    names = jobs.main([*given, "--output", out_b, "--mode", "batch"], spark=spark)
    for _ in range(2):
        jobs.main([*given, "--output", out_s, "--once", "--close", "--checkpoint", os.path.join(scratch, "ck")], spark=spark)
        streamed = spark.read.parquet(out_s)
        for name in names:
            s = streamed.where(streamed.topic == name).drop("topic", "batch")
            b = spark.read.parquet(os.path.join(out_b, name)).select(*s.columns)
            assert _rows(s) == _rows(b) and b.count() > 0


def test_restart_halfway_and_rejects_of_a_stream(spark, scratch):
    """A stream that stops after a part of the lines and goes on from its checkpoint gives the
    batch result, each reject once, and a metric log whose counts go on."""
    from vaultscope.functions import parse
    from vaultscope.operators.metrics import parse_metric_log

    lines = telemetry_lines(telemetry(spark, SF_ORACLE))
    days = [r[0] for r in lines.selectExpr("substring(value, 1, 10) as day").distinct().orderBy("day").collect() if r[0][:2] == "20"]
    cut = days[len(days) // 2]
    inp, out, rejects, log = (os.path.join(scratch, x) for x in ("in", "out", "rejects", "log"))
    given = ["run", "--query", "q2", "--input", inp + "/*", "--output", out, "--checkpoint", os.path.join(scratch, "ck"), "--once",
             "--rejects", rejects, "--metrics", log]
    counts = []
    for k, part in enumerate((lines.where(f"substring(value, 1, 10) < '{cut}'"), lines.where(f"not (substring(value, 1, 10) < '{cut}')"))):
        part.coalesce(2).write.text(os.path.join(inp, f"part-{k}"))
        jobs.main(given if k == 0 else [*given, "--close"], spark=spark)
        counts.append(spark.read.parquet(out).count())
    assert 0 < counts[0] < counts[1]
    streamed = spark.read.parquet(out)
    for g in jobs.GRAINS:
        s = streamed.where(streamed.topic == kafka_sink.topic_name("query2", g.label)).drop("topic", "batch")
        assert _rows(s) == _rows(jobs.batch_result(lines, "q2", g).select(*s.columns))
    want = parse.rejects(parse.parse_lines(lines, "q2"))
    have = spark.read.parquet(rejects)
    assert sorted(map(tuple, have.collect())) == sorted(map(tuple, want.select(*have.columns).collect()))
    sent = spark.read.parquet(os.path.join(scratch, "ck", "query2", "emitted"))
    last = {r.grain: r.sent for r in sent.collect() if r.batch == max(x.batch for x in sent.collect())}
    totals = {g.label: streamed.where(streamed.topic == kafka_sink.topic_name("query2", g.label)).count() for g in jobs.GRAINS}
    assert last == totals and sent.select("started").distinct().count() == 1
    assert parse_metric_log(spark.read.text(log).select("value")).count() > 0


def test_replayed_batch_leaves_the_metric_log_of_one_run(spark, scratch):
    from vaultscope.sinks.files import log_emissions

    state, log = os.path.join(scratch, "state"), os.path.join(scratch, "log")
    for batch, n in ((0, 3), (1, 5), (1, 5), (2, 2), (2, 2)):
        log_emissions(spark, state, log, batch, {"1day": n, "3days": 0}, begun=1000.0 + batch)
    rows = {(r.batch, r.grain): (r.started, r.sent) for r in spark.read.parquet(state).collect()}
    assert rows == {(b, g): (1000.0, n) for b, n1 in enumerate((3, 8, 10)) for g, n in (("1day", n1), ("3days", 0))}
    assert spark.read.text(log).count() == 6  # two lines for each batch, none of them twice


def test_console_shows_every_row(spark, scratch, capfd):
    args = jobs.parser().parse_args(["run", "--query", "q1", "--sink", "console", "--checkpoint", scratch])
    write = jobs._batch_writer(spark, args, lambda batch: batch, list(jobs.GRAINS))
    write(spark.range(1500).selectExpr("'1day' as grain", "concat('row-', id, '.') as ts", "1000 as vault_id", "id as count"), 0)
    shown = capfd.readouterr().out
    assert all(f"row-{k}." in shown for k in range(1500)) and "only showing" not in shown


def test_stream_run_writes_metric_log(spark, line_folder, scratch):
    from vaultscope.operators.metrics import parse_metric_log

    inp = os.path.join(line_folder, "in", "*")
    metrics = os.path.join(scratch, "metrics")
    jobs.main(["run", "--query", "q1", "--input", inp, "--output", os.path.join(scratch, "o"), "--once",
               "--checkpoint", os.path.join(scratch, "ck"), "--grains", "1day", "3days", "--metrics", metrics], spark=spark)
    parsed = parse_metric_log(spark.read.text(metrics).select("value")).collect()
    assert {r.grain for r in parsed} == {"1day", "3days"}
    assert {r.metric for r in parsed} == {"throughput", "latency"} and all(r.value > 0 for r in parsed)


def test_q2_details_stream_equals_batch(spark, line_folder, scratch):
    inp = os.path.join(line_folder, "in", "*")
    out_b, out_s = os.path.join(scratch, "b"), os.path.join(scratch, "s")
    names = jobs.main(["run", "--query", "q2", "--input", inp, "--output", out_b, "--mode", "batch"], spark=spark)
    jobs.main(["run", "--query", "q2", "--details", "--input", inp, "--output", out_s, "--once",
               "--checkpoint", os.path.join(scratch, "ck")], spark=spark)
    streamed = spark.read.parquet(out_s)
    for name in names:
        b = spark.read.parquet(os.path.join(out_b, name))
        s = streamed.where(streamed.topic == name).drop("topic")
        closing_ts = {r.ts for r in b.collect()} - {r.ts for r in s.collect()}
        assert len(closing_ts) <= 1
        b = b.where(~b.ts.isin(list(closing_ts))) if closing_ts else b
        assert s.count() > 0
        assert _rows(s.select(*b.columns)) == _rows(b)


def test_run_needs_its_folders(spark):
    for given in (["--query", "q1"], ["--query", "q1", "--input", "x"], ["--query", "q1", "--input", "x", "--output", "y"],
                  ["--query", "q1", "--input", "x", "--checkpoint", "y", "--sink", "kafka"]):
        with pytest.raises(SystemExit):
            jobs.main(["run", *given], spark=spark)


def test_replayed_batch_leaves_no_duplicates(spark, scratch):
    args = jobs.parser().parse_args(["run", "--query", "q1", "--output", scratch])
    write = jobs._batch_writer(spark, args, lambda batch: batch, list(jobs.GRAINS))
    batch = spark.createDataFrame([("1day", "2023-04-01 00:00:00", 1000, 3)], "grain string, ts string, vault_id int, count long")
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(scratch).count() == 2


def test_rejects_of_a_batch_run(spark, line_folder, scratch):
    inp = os.path.join(line_folder, "in", "*")
    rejects = os.path.join(scratch, "r")
    jobs.main(["run", "--query", "q1", "--input", inp, "--output", os.path.join(scratch, "o"), "--mode", "batch", "--grains", "1day",
               "--rejects", rejects], spark=spark)
    assert {r.reject_reason for r in spark.read.parquet(rejects).collect()} >= {"too_few_fields", "bad_timestamp"}


def test_query2_messages_hold_one_line_per_window(spark):
    rows = spark.createDataFrame(
        [("t", "w1", 2, 7, 1, "d7"), ("t", "w1", 1, 5, 3, "d5"), ("t", "w2", 1, 9, 1, "d9")],
        "topic string, ts string, rank int, vault_id int, failures long, disk_details string",
    )
    assert sorted(r.value for r in jobs.result_messages(rows, "q2").collect()) == ["w1, 5, 3 (d5), 7, 1 (d7)", "w2, 9, 1 (d9)"]


def test_a_source_that_stands_still_holds_no_window_open(spark, scratch):
    """Two folders, one of which stops after the first day: the other's later lines close its windows."""
    from vaultscope.streaming.run import closing_line

    import datetime as dt

    day = lambda k, vault: closing_line(dt.datetime(2024, 1, 1 + k, 12), vault)
    folders = [os.path.join(scratch, x) for x in "ab"]
    for f in folders:
        os.makedirs(f)
    with open(os.path.join(folders[0], "1.txt"), "w") as fh:
        fh.write(day(0, 1000) + "\n")
    given = ["run", "--query", "q1", "--input", *folders, "--output", os.path.join(scratch, "o"), "--once", "--grains", "1day",
             "--checkpoint", os.path.join(scratch, "ck")]
    for k, file in enumerate(("1", "2", "3")):
        with open(os.path.join(folders[1], f"{file}.txt"), "w") as fh:
            fh.write(day(k, 1001) + "\n")
        jobs.main(given, spark=spark)
    rows = spark.read.parquet(os.path.join(scratch, "o")).collect()
    assert sorted((r.ts, r.vault_id) for r in rows) == [("2024-01-01 00:00:00", 1000), ("2024-01-01 00:00:00", 1001), ("2024-01-02 00:00:00", 1001)]
