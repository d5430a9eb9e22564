"""Kafka sinks (SNK-1..3): results as text messages, one topic per
(query, grain), and raw lines published with the first CSV field as key.

Only the writers are built here; the connector jar must be on the cluster's
classpath.  Spark's Kafka sink is at-least-once; ``enable.idempotence`` makes
producer retries idempotent (SNK-3).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import tuple_text


# The result topics by query and grain.
TOPICS = {
    "query1": {"1day": "query1-1day", "3days": "query1-3days", "alltime": "query1-all-time"},
    "query2": {"1day": "query2_1-day", "3days": "query2_3-days", "alltime": "query2_all-time"},
    "query3": {"1day": "query3_1-day", "3days": "query3_3-days", "alltime": "query3_all-time"},
}


def topic_name(query: str, grain_label: str) -> str:
    """The topic of a (query, grain); ``<query>-<grain>`` for grains of one's own."""
    return TOPICS.get(query, {}).get(grain_label, f"{query}-{grain_label}")


def topic_column(query: str, grain: str = "grain") -> Column:
    """:func:`topic_name` of a grain column."""
    out = F.concat(F.lit(f"{query}-"), F.col(grain))
    for label, name in TOPICS.get(query, {}).items():
        out = F.when(F.col(grain) == label, F.lit(name)).otherwise(out)
    return out


def publish_projection(lines: DataFrame, value: str = "value") -> DataFrame:
    """SNK-2: key = first CSV field, value = the whole line, of the lines whose first
    field is a timestamp (headers and other lines are not sent)."""
    key = F.split(F.col(value), ",")[0]
    stamp = F.translate(key, "T", " ")
    good = stamp.rlike(S.TS_TEXT_RE) & F.try_to_timestamp(stamp, F.lit(S.TS_PATTERN)).isNotNull()
    return lines.where(good).select(key.alias("key"), F.col(value).alias("value"))


def publish_in_slices(lines: DataFrame, seconds: int, staging: str, write: Callable[[DataFrame, int], None]) -> int:
    """SNK-2 in event-time order: ``write(rows, slice)`` gets key and value of one slice of
    ``seconds`` of event time after the other, and a slice starts when the one before is done.

    So no line arrives after one that is ``seconds`` or more younger, and a consumer whose
    watermark delay is at least that finds none late.
    The lines are staged once, by day and sorted by slice, so that a slice reads the row groups
    that hold it; a slice is sent in parallel.  Returns the number of slices; the driver holds
    their numbers for one day at a time.
    """
    stamp = F.translate(F.col("key"), "T", " ")
    number = F.floor(F.unix_seconds(F.try_to_timestamp(stamp, F.lit(S.TS_PATTERN))) / seconds).cast("long")
    rows = publish_projection(lines).select("key", "value", number.alias("slice"))
    rows = rows.withColumn("day", F.to_date(F.timestamp_seconds(F.col("slice") * seconds)))
    rows.repartition("day", F.pmod(F.xxhash64("value"), F.lit(16))).sortWithinPartitions("day", "slice").write.partitionBy("day").parquet(staging)
    staged, sent = lines.sparkSession.read.parquet(staging), 0
    for (day,) in staged.select("day").distinct().orderBy("day").collect():
        of_day = staged.where(F.col("day") == F.lit(day))
        for (k,) in of_day.select("slice").distinct().orderBy("slice").collect():
            write(of_day.where(F.col("slice") == k).select("key", "value"), k)
            sent += 1
    return sent


def as_messages(result: DataFrame, topic: str | Column) -> DataFrame:
    """Result rows as ``(a,b,c)`` text messages with a ``topic`` column."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    return result.select(t.alias("topic"), tuple_text(*result.columns).alias("value"))


def kafka_sink_options(bootstrap: str, topic: str | None = None, idempotent: bool = True) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap}
    if topic:
        opts["topic"] = topic
    if idempotent:
        opts["kafka.enable.idempotence"] = "true"
    return opts


def write_kafka(df: DataFrame, options: dict[str, str]) -> None:
    """Batch write (``key``/``value``/``topic`` columns)."""
    df.write.format("kafka").options(**options).save()


def write_kafka_stream(df: DataFrame, options: dict[str, str], checkpoint: str):
    """Streaming write; returns the started query."""
    return (
        df.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
        .outputMode("append").start()
    )
