"""Kafka source options (SRC-1..4).

The Kafka connector jar is not bundled with PySpark; these helpers only build
the reader, so a cluster with ``spark-sql-kafka`` on its classpath runs them
unchanged.  Consumer-group offsets are replaced by the query checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's input topic and result-topic pattern.
INPUT_TOPIC = "input-data"
RESULT_TOPIC_PATTERN = "query.*"


def kafka_source_options(
    bootstrap: str,
    topic: str | None = INPUT_TOPIC,
    pattern: str | None = None,
    starting: str = "latest",
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """SRC-1 (one topic), SRC-4 (regex), SRC-2 (``latest`` for jobs,
    ``earliest`` for the result reader)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "startingOffsets": starting}
    if pattern:
        opts["subscribePattern"] = pattern
    else:
        opts["subscribe"] = topic
    opts.update(extra or {})
    return opts


def read_kafka_lines(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """Lines as ``value`` (string), with ``key`` and ``topic``."""
    reader = spark.readStream if stream else spark.read
    raw = reader.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic"
    )
