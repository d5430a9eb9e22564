"""File sinks: result CSVs per topic (SNK-4, SNK-5) and the metric log (SNK-7).

The reference's consumer appends each message to ``<topic>.csv`` after
stripping ``(``, ``)`` and ``"``, writing a header once.  Here a micro-batch of
messages is written per query with ``partitionBy("topic")``: one folder per topic and
batch, many part files with the topic's header, written in parallel by the executors.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ranking_columns, split_fields, strip_chars
from ..schema import CSV_HEADERS, FILE_COLUMNS
from ..operators.metrics import metric_log_lines


def header_for(topic: str) -> list[str] | None:
    """SNK-5: column names by topic prefix."""
    for prefix, header in CSV_HEADERS.items():
        if topic.startswith(prefix):
            return header.split(",") if prefix != "query2" else None
    return None


def with_reference_header(result: DataFrame, topic: str) -> DataFrame:
    """SNK-5: rename a Query 1 or Query 3 result positionally to the column
    names of the reference's CSV header for ``topic`` (Query 2's header is
    ragged text and has no column form; use the wide ranking instead)."""
    names = header_for(topic)
    if names is None or len(names) != len(result.columns):
        raise ValueError(f"no {len(result.columns)}-column header for topic {topic!r}")
    return result.select(*[F.col(c).alias(n) for c, n in zip(result.columns, names)])


def message_columns(messages: DataFrame, n: int, names: list[str] | None = None) -> DataFrame:
    """FN-7 + FN-8: strip ``()"`` and split on ``,`` into ``n`` string columns."""
    parts = split_fields(strip_chars("value"))
    names = names or [f"c{i}" for i in range(n)]
    return messages.select("topic", *[F.get(parts, i).alias(names[i]) for i in range(n)])


def write_topic_csv(messages: DataFrame, path: str, batch_id: int | None = None) -> None:
    """SNK-4: stripped messages as text under ``path/topic=<topic>/``, appended, or under
    ``path/batch=<batch_id>/topic=<topic>/``, which a replay of the batch overwrites."""
    rows = messages.select("topic", strip_chars("value").alias("value"))
    if batch_id is None:
        rows.write.mode("append").partitionBy("topic").text(path)
    else:
        rows.write.mode("overwrite").partitionBy("topic").text(f"{path}/batch={batch_id}")


def write_result_csv(result: DataFrame, path: str, header: bool = True) -> None:
    """A result DataFrame as CSV with its column names as header."""
    result.write.mode("append").option("header", header).csv(path)


def topic_columns(messages: DataFrame, query: str) -> DataFrame:
    """The messages of a query's topics as topic and the columns of its files (SNK-5).

    Query 2's lines are taken apart by their form, as disk texts hold commas; the others are
    stripped and split."""
    names = FILE_COLUMNS[query]
    own = messages.where(F.col("topic").startswith(query))
    if query == "query2":
        return own.select("topic", *ranking_columns("value"))
    return message_columns(own, len(names), names)


def write_topics(messages: DataFrame, path: str, batch_id: int) -> None:
    """SNK-4, SNK-5: a micro-batch's messages as CSV files with a header, below
    ``path``/<query>/batch=<batch_id>/topic=<topic>, which a replay overwrites."""
    messages = messages.persist()
    for query in FILE_COLUMNS:
        rows = topic_columns(messages, query)
        if not rows.isEmpty():
            rows.write.mode("overwrite").partitionBy("topic").option("header", True).csv(f"{path}/{query}/batch={batch_id}")
    messages.unpersist()


def read_topics(spark: SparkSession, path: str, query: str) -> DataFrame:
    """What :func:`write_topics` wrote for a query, as text columns with topic and batch."""
    columns = ", ".join(f"`{c}` string" for c in FILE_COLUMNS[query])
    return spark.read.schema(f"{columns}, batch long, topic string").option("header", True).csv(f"{path}/{query}")


def foreach_batch_csv(path: str):
    """``foreachBatch`` function writing each micro-batch of messages as text (SNK-4) once,
    however often it is replayed."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        write_topic_csv(batch, path, batch_id)

    return _write


def foreach_batch_topics(path: str):
    """``foreachBatch`` function for :func:`write_topics`."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        write_topics(batch, path, batch_id)

    return _write


def write_metric_log(metrics: DataFrame, path: str) -> None:
    """SNK-7: two text lines per metric row; what the folder held is replaced."""
    metric_log_lines(metrics).write.mode("overwrite").text(path)


def log_emissions(spark: SparkSession, state: str, path: str, batch_id: int, emitted: dict[str, int], begun: float) -> None:
    """MET-1, MET-2: cumulative throughput and latency per grain after a micro-batch, in
    ``path``/batch=<id>.

    The emission clock and the running counts are kept beside the checkpoint, one small
    folder per batch (``state``/batch=<id>), so that they go on after a restart; a replayed
    batch starts from the batches before it and overwrites both folders.  ``begun`` is when
    the job started, in seconds; a restarted job goes on with the clock of its first start.
    """
    folders = spark.createDataFrame([], "grain string, started double, sent long, batch long")
    folders.write.mode("ignore").partitionBy("batch").parquet(state)
    before = spark.read.schema(folders.schema).parquet(state).where(F.col("batch") < batch_id)
    last = before.groupBy("grain").agg(F.max_by(F.struct("started", "sent"), "batch").alias("x"))
    known = {r.grain: (r.x.started, r.x.sent) for r in last.collect()}  # a row per grain
    started = min((s for s, _ in known.values()), default=begun)
    sent = {g: known.get(g, (started, 0))[1] + n for g, n in emitted.items()}
    rows = spark.createDataFrame([(g, started, n) for g, n in sent.items()], "grain string, started double, sent long")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
    elapsed = max(time.time() - started, 1e-3) * 1000.0
    log = [(g, sent[g] / elapsed * 1000.0, elapsed / sent[g]) for g, n in emitted.items() if n]
    if log:
        write_metric_log(spark.createDataFrame(log, "grain string, rows_per_s double, ms_per_row double"), f"{path}/batch={batch_id}")
