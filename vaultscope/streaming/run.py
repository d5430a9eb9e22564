"""Running streaming queries: file sources, closing rows, sinks and triggers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..windows import GRAINS, Grain

# A closing line passes every test of every query; its own window never closes.
CLOSING_FIELDS = {S.IDX_SERIAL: "closing", S.IDX_MODEL: "closing", S.IDX_FAILURE: "1", S.IDX_POWER_ON_HOURS: "1.0", S.IDX_TEMPERATURE: "2.5"}
CLOSING_VAULTS = (1000, 1120)


def closing_time(last_event: dt.datetime, grains: tuple[Grain, ...] = GRAINS) -> dt.datetime:
    """An event time past the end of every window holding ``last_event`` by more
    than the watermark delay, so that all of them close (STR-6)."""
    epoch = dt.datetime(1970, 1, 1)
    end = last_event
    for g in grains:
        days = (last_event - epoch).total_seconds() / 86400.0
        k = (days - g.offset_days) // g.size_days
        w_end = epoch + dt.timedelta(days=(k + 1) * g.size_days + g.offset_days)
        end = max(end, w_end)
    return end + dt.timedelta(days=1)


def closing_line(ts: dt.datetime, vault: int) -> str:
    fields = [""] * S.N_FIELDS
    fields[S.IDX_TS] = ts.strftime("%Y-%m-%dT%H:%M:%S.%f")
    fields[S.IDX_VAULT] = str(vault)
    for i, v in CLOSING_FIELDS.items():
        fields[i] = v
    return ",".join(fields)


def line_time(value: str):
    """The event time of a raw line, null where it has none."""
    return F.try_to_timestamp(F.translate(F.split(value, ",")[0], "T", " "), F.lit(S.TS_PATTERN))


def closing_moment(last: str, grains: tuple[Grain, ...] = GRAINS):
    """A day past the end of every window that holds the time ``last`` (:func:`closing_time` as a column)."""
    secs, ends = F.unix_seconds(F.col(last)), []
    for g in grains:
        size, off = g.size_days * 86400, g.offset_days * 86400
        ends.append((F.floor((secs - off) / size) + 1) * size + off)
    return F.timestamp_seconds((F.greatest(*ends) if len(ends) > 1 else ends[0]) + 86400)


def closing_lines_for(lines: DataFrame, grains: tuple[Grain, ...] = GRAINS) -> DataFrame:
    """SET-1: closing lines derived from the data: one per closing vault, dated
    one day past the end of every window (of every grain) that holds the
    latest line.  Lines without a timestamp, or none at all, need no closing.  One
    aggregate over the lines; nothing goes through the driver."""
    close = closing_moment("last", grains)
    vaults = F.explode(F.array(*[F.lit(v) for v in CLOSING_VAULTS])).alias("vault")

    def field(i: int):
        if i == S.IDX_TS:
            return F.date_format("close", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        if i == S.IDX_VAULT:
            return F.col("vault").cast("string")
        return F.lit(CLOSING_FIELDS.get(i, ""))

    last = lines.agg(F.max(line_time("value")).alias("last"))
    return last.where("last is not null").select(close.alias("close"), vaults).select(
        F.concat_ws(",", *[field(i) for i in range(S.N_FIELDS)]).alias("value")
    )


def with_closing(lines: DataFrame) -> DataFrame:
    """The lines followed by their closing lines (batch)."""
    return lines.unionByName(closing_lines_for(lines))


def start_available_now(
    df: DataFrame,
    checkpoint: str,
    sink: str = "memory",
    name: str | None = None,
    path: str | None = None,
) -> StreamingQuery:
    """Append-mode query over everything available now, then stop.

    ``sink``: ``memory`` (tests; table ``name``), ``parquet``/``csv`` (``path``),
    or ``console`` (SNK-6)."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink == "memory":
        w = w.format("memory").queryName(name)
    elif sink == "console":
        w = w.format("console").option("truncate", False)
    else:
        w = w.format(sink).option("path", path)
        if sink == "csv":
            w = w.option("header", True)
    return w.start()


def run_to_table(spark: SparkSession, df: DataFrame, checkpoint: str, name: str) -> DataFrame:
    """Run ``df`` (streaming) to completion into a memory table and return it."""
    q = start_available_now(df, checkpoint, "memory", name)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.table(name)


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder (never a
    machine-local temporary folder)."""
    import uuid

    from ..session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/vaultscope-{name}-{uuid.uuid4().hex}"


def run_to_parquet(spark: SparkSession, df: DataFrame, base: str) -> DataFrame:
    """Run a streaming DataFrame to completion into a Parquet file sink under
    ``base`` (append mode, checkpointed) and return the sink as a batch table."""
    path = f"{base}/out"
    q = start_available_now(df, f"{base}/checkpoint", "parquet", path=path)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(df.schema).parquet(path)


def stream_over_lines(spark: SparkSession, lines: DataFrame, build, name: str) -> DataFrame:
    """Write ``lines`` and their closing lines as text files under a shared
    folder, run ``build(streaming lines)`` over them with ``availableNow`` and
    return the emitted rows."""
    from ..sources.text import read_lines_stream

    base = shared_scratch(spark, name)
    lines.write.text(f"{base}/in/data")
    closing_lines_for(lines).coalesce(1).write.text(f"{base}/in/zz-closing")
    return run_to_parquet(spark, build(read_lines_stream(spark, f"{base}/in/*")), base)


def stream_foreach_batch_over_lines(spark: SparkSession, lines: DataFrame, build, writer_factory, name: str) -> DataFrame:
    """Like :func:`stream_over_lines`, for a stream whose output is produced in
    ``foreachBatch``: ``writer_factory(write)`` wraps the per-batch computation,
    ``write`` appends to a Parquet folder in the shared scratch folder."""
    from ..sources.text import read_lines_stream

    base = shared_scratch(spark, name)
    lines.write.text(f"{base}/in/data")
    closing_lines_for(lines).coalesce(1).write.text(f"{base}/in/zz-closing")
    out = f"{base}/out"

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (
        build(read_lines_stream(spark, f"{base}/in/*"))
        .writeStream.outputMode("append")
        .foreachBatch(writer_factory(write))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).drop("batch")


def finished(q: StreamingQuery) -> None:
    """Waits for a query that stops by itself, and raises what it failed with."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def available_now(writer):
    return writer.trigger(availableNow=True)


def in_time_slices(spark: SparkSession, lines: DataFrame, base: str, slices: int):
    """Writes ``lines`` below ``base``/in in time order, one folder after the other, the closing
    lines last; yields after each.  The lines are rendered once, into a staging table."""
    day = F.to_date(F.try_to_timestamp(F.substring("value", 1, 10), F.lit("yyyy-MM-dd")))
    dated = lines.withColumn("day", day)
    cuts = dated.select(F.percentile_approx("day", [k / slices for k in range(1, slices)])).first()[0] or []
    number = F.lit(0)
    for cut in sorted(set(cuts)):
        number = number + F.coalesce(F.col("day") >= F.lit(cut), F.lit(False)).cast("int")
    dated.select("value", number.alias("slice")).write.partitionBy("slice").text(f"{base}/staged")
    staged = spark.read.text(f"{base}/staged")
    for k in range(len(set(cuts)) + 1):
        staged.where(F.col("slice") == k).select("value").write.text(f"{base}/in/slice-{k}")
        yield k
    closing_lines_for(staged.select("value")).write.text(f"{base}/in/zz-closing")
    yield None


def all_grains_over_lines(spark: SparkSession, lines: DataFrame, query: str, name: str, slices: int = 3, details: bool = False) -> DataFrame:
    """SET-2 over lines that arrive in time order: every grain from one pass
    (:mod:`vaultscope.streaming.rollup`), restarted from its checkpoint for each slice.

    With ``details`` Query 2 has the disks of its ranked vaults
    (:mod:`vaultscope.streaming.staged`)."""
    from ..functions import parse
    from ..session import configure_streaming
    from ..sources.text import read_lines_stream
    from . import rollup, staged

    configure_streaming(spark)
    base = shared_scratch(spark, name)
    out, parsed = f"{base}/out", f"{base}/parsed"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if not batch_id or not batch.isEmpty():  # the first batch gives the table its columns
            rows = staged.ranked_disks_of_windows(spark, batch, parsed) if details else rollup.finish_closed(batch, query)
            rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        batch.unpersist()

    for _ in in_time_slices(spark, lines, base, slices):
        arrived = read_lines_stream(spark, f"{base}/in/*")
        if details:
            rows = staged.parsed_rows(arrived, query)
            finished(staged.start_parse(rows, query, parsed, f"{base}/parse", available_now))
            records = staged.records_stream(spark, parsed, rows.schema)
        else:
            records = rollup.select_records(parse.good_records(parse.parse_lines(arrived, query)), query)
        closed = rollup.closed_windows(records, query).writeStream.outputMode("append").foreachBatch(write)
        finished(available_now(closed.option("checkpointLocation", f"{base}/checkpoint")).start())
    return spark.read.parquet(out).drop("batch")


def closed_windows_over_lines(spark: SparkSession, lines: DataFrame, query: str, grain: Grain, name: str) -> DataFrame:
    """One grain over lines in one stream: bounded state, ranks and quantiles per micro-batch."""
    from .queries import finish_windows, records_stream, windows_of_records

    def build(stream: DataFrame) -> DataFrame:
        return windows_of_records(records_stream(stream, query), query, (grain,))

    def writer(write):
        return lambda batch, batch_id: write(finish_windows(batch, query).drop("grain"), batch_id)

    return stream_foreach_batch_over_lines(spark, lines, build, writer, name)
