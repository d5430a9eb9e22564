"""Job entry points: what a user runs instead of the reference's three jobs,
publisher and result consumer.

  python -m vaultscope run --query q1 --input DIR --output DIR [--mode stream|batch]
  python -m vaultscope publish --input DIR --bootstrap HOST:PORT [--topic input-data]
  python -m vaultscope collect --bootstrap HOST:PORT --output DIR

``run`` computes the query for every grain and writes one output per
(query, grain), named like its topic (see ``sinks/kafka.TOPICS``).  In
stream mode one query parses the lines once and computes every grain; for rejects and
for Query 2's disks the parsed rows are a table under ``--checkpoint`` first.  File sinks
are partitioned by micro-batch and ``topic``, the Kafka sink routes each row to its
topic.  ``--once`` processes what is available and stops; with ``--close`` it then closes
the last windows too.  Input is a folder of raw text lines or a Kafka topic.
"""

from __future__ import annotations

import argparse
import time
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions import parse
from .functions.text import tuple_text
from .plans import query1, query2, query3
from .session import configure, configure_streaming
from .sinks import files as file_sink
from .sinks import kafka as kafka_sink
from .sources import kafka as kafka_src
from .sources.text import read_lines, read_lines_stream
from .streaming import queries as sq
from .streaming import rollup, staged
from .streaming.run import closing_moment, finished, line_time, with_closing
from .windows import GRAINS, Grain

QUERY_NAMES = {"q1": "query1", "q2": "query2", "q3": "query3"}


def batch_result(lines: DataFrame, query: str, grain: Grain, dedup_key: str = "serial_number") -> DataFrame:
    """The batch form of ``query`` over raw lines for one grain."""
    good = parse.good_records(parse.parse_lines(lines, query, key=dedup_key))
    if query == "q1":
        return query1.temperature_stats(good, grain)
    if query == "q2":
        return query2.top_vault_details(good, grain)
    if query == "q3":
        return query3.power_on_quantiles(good, grain, dedup_key=dedup_key)
    raise ValueError(query)


def stream_result(lines: DataFrame, query: str, grain: Grain, dedup_key: str = "serial_number") -> DataFrame:
    """The streaming form of ``query`` over streaming raw lines for one grain."""
    if query == "q1":
        return sq.q1_stream(lines, grain)
    if query == "q2":
        return sq.q2_stream(lines, grain)
    if query == "q3":
        return sq.q3_stream(lines, grain, dedup_key=dedup_key)
    raise ValueError(query)


def _lines(spark: SparkSession, args, stream: bool) -> DataFrame:
    """The raw lines of all inputs.  Several folders or topics are one stream: event time is that
    of the furthest one, so a source that stands still doesn't hold windows open (STR-3); rows of
    a source that lags behind by more than the watermark are late."""
    if args.bootstrap:
        opts = kafka_src.kafka_source_options(args.bootstrap, args.topic, starting=args.starting)
        return kafka_src.read_kafka_lines(spark, opts, stream=stream).select("value")
    read = (lambda path: read_lines_stream(spark, path, args.max_files)) if stream else (lambda path: read_lines(spark, path))
    return reduce(lambda a, b: a.unionByName(b), map(read, args.input))


def run(spark: SparkSession, args) -> list[str]:
    """Compute ``args.query`` for every grain; returns the output names."""
    grains = [g for g in GRAINS if not args.grains or g.label in args.grains]
    if args.mode == "batch":
        return _run_batch(spark, args, grains)
    configure_streaming(spark)
    if args.state_partitions:
        # fixed for the life of the checkpoint: set it before the first start
        spark.conf.set("spark.sql.shuffle.partitions", str(args.state_partitions))
    if args.once:
        for q in _start(spark, args, grains):
            finished(q)
        if args.close:
            _write_closing(spark, args)
            for q in _start(spark, args, grains):
                finished(q)
    else:
        started = _start(spark, args, grains)
        spark.streams.awaitAnyTermination()
        for q in started:
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
    return [kafka_sink.topic_name(QUERY_NAMES[args.query], g.label) for g in grains]


def _run_batch(spark: SparkSession, args, grains: list[Grain]) -> list[str]:
    configure(spark)
    lines = _lines(spark, args, stream=False)
    if args.rejects:
        parse.rejects(parse.parse_lines(lines, args.query, key=args.dedup_key)).write.mode("overwrite").parquet(args.rejects)
    names = []
    for g in grains:
        name = kafka_sink.topic_name(QUERY_NAMES[args.query], g.label)
        batch_result(lines, args.query, g, args.dedup_key).write.mode("overwrite").parquet(f"{args.output}/{name}")
        names.append(name)
    return names


def _base(args) -> str:
    return f"{args.checkpoint}/{QUERY_NAMES[args.query]}"


def _staged(args) -> bool:
    """Whether the parse stage writes a table: for rejects and for the disks of Query 2."""
    return bool(args.rejects) or (args.query == "q2" and args.details)


def _records(spark: SparkSession, args, parsed_schema=None) -> DataFrame:
    """The stream of records and of closing records (``closing``: they only move the watermark)."""
    if parsed_schema is not None:
        records = staged.records_stream(spark, f"{_base(args)}/parsed", parsed_schema, args.max_files)
    else:
        good = parse.good_records(parse.parse_lines(_lines(spark, args, stream=True), args.query, key=args.dedup_key))
        records = rollup.select_records(good, args.query, args.dedup_key)
    folder = f"{_base(args)}/closing"
    spark.createDataFrame([], "ts timestamp").write.mode("ignore").parquet(folder)
    closing = spark.readStream.schema("ts timestamp").parquet(folder).withColumn("closing", F.lit(True))
    return records.withColumn("closing", F.lit(False)).unionByName(closing, allowMissingColumns=True)


def _start(spark: SparkSession, args, grains: list[Grain]) -> list:
    """Starts the job's queries.  One query parses the lines and makes every grain, or, where
    the parsed rows are needed again, one parses them into a table that the others read; with
    ``--once`` each stage is done before the next one starts."""
    trigger = (lambda w: w.trigger(availableNow=True)) if args.once else (lambda w: w)
    base, qname, schema, started = _base(args), QUERY_NAMES[args.query], None, []
    parsed = f"{base}/parsed"
    if _staged(args):
        rows = staged.parsed_rows(_lines(spark, args, stream=True), args.query, args.dedup_key)
        schema = rows.schema
        started.append(staged.start_parse(rows, args.query, parsed, f"{base}/parse", trigger))
        if args.once:
            finished(started[-1])
        if args.rejects:
            started.append(staged.start_rejects(spark, parsed, schema, args.rejects, f"{base}/rejects", trigger))
    if args.query == "q2" and args.details:
        finish = lambda batch: staged.ranked_disks_of_windows(spark, batch, parsed, tuple(grains))
    else:
        finish = lambda batch: rollup.finish_closed(batch, args.query)
    closed = rollup.closed_windows(_records(spark, args, schema), args.query, grains, dedup_key=args.dedup_key)
    q = closed.writeStream.outputMode("append").queryName(f"{qname}_all_grains").option("checkpointLocation", f"{base}/windows")
    started.append(trigger(q.foreachBatch(_batch_writer(spark, args, finish, grains))).start())
    return started


def _write_closing(spark: SparkSession, args) -> None:
    """STR-6: one record past the end of every window that holds the last record, so that all
    of them close.  It has no vault, so no result shows it; records older than it that come
    later are late."""
    if _staged(args):
        last = spark.read.parquet(f"{_base(args)}/parsed").where(~F.col("rejected")).agg(F.max("ts").alias("last"))
    else:
        last = _lines(spark, args, stream=False).agg(F.max(line_time("value")).alias("last"))
    last.where("last is not null").select(closing_moment("last").alias("ts")).write.mode("append").parquet(f"{_base(args)}/closing")


def _batch_writer(spark: SparkSession, args, finish, grains: list[Grain]):
    """``foreachBatch`` function: the results of the windows that a micro-batch closes, to the
    chosen sink.  Files go to ``batch=<id>`` folders, which a replay overwrites."""
    begun = time.time()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if batch.isEmpty():
            batch.unpersist()
            return
        counted = Observation(f"batch {batch_id}")
        rows = finish(batch).observe(counted, *(F.count_if(F.col("grain") == g.label).alias(g.label) for g in grains))
        rows = rows.select(kafka_sink.topic_column(QUERY_NAMES[args.query]).alias("topic"), *[c for c in rows.columns if c != "grain"])
        if args.sink == "kafka":
            kafka_sink.write_kafka(result_messages(rows, args.query), kafka_sink.kafka_sink_options(args.sink_bootstrap))
        elif args.sink == "console":
            rows = rows.persist()
            rows.show(rows.count(), truncate=False)  # all of them: a micro-batch's result rows are few
            rows.unpersist()
        else:
            out = rows.write.mode("overwrite").partitionBy("topic")
            out.option("header", True).format(args.sink).save(f"{args.output}/batch={batch_id}")
        if args.metrics:
            file_sink.log_emissions(spark, f"{args.checkpoint}/{QUERY_NAMES[args.query]}/emitted", args.metrics, batch_id, counted.get, begun)
        batch.unpersist()

    return write


def result_messages(rows: DataFrame, query: str) -> DataFrame:
    """Result rows as messages (topic, value).  Query 2 has one message per window: its
    ranking line with the disks, where they were kept; other queries one per row."""
    if query == "q2" and "disk_details" in rows.columns:
        entry = F.concat(F.lit(", "), F.col("vault_id"), F.lit(", "), F.col("failures"), F.lit(" ("), F.col("disk_details"), F.lit(")"))
        entries = F.array_sort(F.collect_list(F.struct("rank", entry.alias("text"))))
        windows = rows.groupBy("topic", "ts").agg(entries.alias("entries"))
        return windows.select("topic", F.concat("ts", F.array_join(F.transform("entries", lambda e: e.text), "")).alias("value"))
    return rows.select("topic", tuple_text(*[c for c in rows.columns if c != "topic"]).alias("value"))


def publish(spark: SparkSession, args) -> None:
    """SNK-2: raw lines to Kafka, key = first field.  Lines without a timestamp, headers
    among them, are not sent; ``--closing`` appends the lines that close every window.
    With ``--slice`` lines are sent in slices of that many seconds of event time, one after
    the other, so that a consumer with at least that watermark drops none; without, all at
    once and in parallel."""
    lines = read_lines(spark, args.input)
    lines = with_closing(lines) if args.closing else lines
    options = kafka_sink.kafka_sink_options(args.bootstrap, args.topic)
    if args.slice is None:
        kafka_sink.write_kafka(kafka_sink.publish_projection(lines), options)
    else:
        configure(spark)
        kafka_sink.publish_in_slices(lines, args.slice, args.staging, lambda rows, _: kafka_sink.write_kafka(rows, options))


def collect(spark: SparkSession, args) -> None:
    """SRC-4, SNK-4, SNK-5: every ``query*`` topic to CSV files with its header, one folder per
    topic and batch.  Query 2's messages are those with disks, one line per window."""
    opts = kafka_src.kafka_source_options(args.bootstrap, pattern=kafka_src.RESULT_TOPIC_PATTERN, starting="earliest")
    msgs = kafka_src.read_kafka_lines(spark, opts, stream=True)
    q = (
        msgs.writeStream.foreachBatch(file_sink.foreach_batch_topics(args.output))
        .option("checkpointLocation", args.checkpoint)
        .start()
    )
    q.awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vaultscope")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="compute a query for every grain")
    r.add_argument("--query", choices=sorted(QUERY_NAMES), required=True)
    r.add_argument("--input", nargs="+", help="folders of raw text lines")
    r.add_argument("--bootstrap", help="read lines from Kafka instead")
    r.add_argument("--topic", default=kafka_src.INPUT_TOPIC, help="topic, or several with commas")
    r.add_argument("--starting", default="latest")
    r.add_argument("--output", help="output folder (one sub-folder per grain)")
    r.add_argument("--mode", choices=["stream", "batch"], default="stream")
    r.add_argument("--sink", choices=["parquet", "csv", "console", "kafka"], default="parquet")
    r.add_argument("--sink-bootstrap", dest="sink_bootstrap")
    r.add_argument("--checkpoint", help="shared folder for streaming checkpoints")
    r.add_argument("--grains", nargs="*", help="subset of grain labels (default: all)")
    r.add_argument("--dedup-key", dest="dedup_key", default="serial_number", choices=["serial_number", "model"])
    r.add_argument("--once", action="store_true", help="process what is available, then stop")
    r.add_argument("--close", action="store_true", help="with --once: close the last windows when the input is done")
    r.add_argument("--metrics", help="throughput / latency log lines per micro-batch go here (stream mode)")
    r.add_argument("--details", action=argparse.BooleanOptionalAction, default=True, help="q2: the ranked vaults' failed disks")
    r.add_argument("--max-files", dest="max_files", type=int, help="stream: input files of a micro-batch, at most")
    r.add_argument("--rejects", help="write rejected lines with their reason here")
    r.add_argument("--state-partitions", dest="state_partitions", type=int,
                   help="stream: state-store partitions, fixed at the first start of a checkpoint")
    pb = sub.add_parser("publish", help="raw lines to Kafka")
    pb.add_argument("--input", required=True)
    pb.add_argument("--bootstrap", required=True)
    pb.add_argument("--topic", default=kafka_src.INPUT_TOPIC)
    pb.add_argument("--slice", type=int, help="send slices of so many seconds of event time in order (the watermark: 30)")
    pb.add_argument("--staging", help="with --slice: shared folder for the lines by day")
    pb.add_argument("--closing", action="store_true", help="append the lines that close every window")
    c = sub.add_parser("collect", help="result topics to files")
    c.add_argument("--bootstrap", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--checkpoint", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    options = parser()
    args = options.parse_args(argv)
    if args.command == "run":
        need = {"--input or --bootstrap": args.input or args.bootstrap}
        need["--output"] = args.output or (args.mode == "stream" and args.sink in ("console", "kafka"))
        need["--checkpoint"] = args.checkpoint or args.mode == "batch"
        need["--sink-bootstrap"] = args.sink_bootstrap or args.sink != "kafka"
        if missing := [name for name, given in need.items() if not given]:
            options.error(f"run needs {', '.join(missing)}")
    if args.command == "publish" and args.slice is not None and not args.staging:
        options.error("publish --slice needs --staging")
    if spark is None:
        spark = (
            SparkSession.builder.appName(f"vaultscope-{args.command}")
            .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
        )
    if args.command == "run":
        return run(spark, args)
    if args.command == "publish":
        return publish(spark, args)
    return collect(spark, args)
