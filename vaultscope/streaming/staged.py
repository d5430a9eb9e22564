"""The parse stage of a job: one parse per line, good records and rejects in one table.

A streaming query parses the raw lines and writes one Parquet table, partitioned by
``rejected`` and, for Query 2, by ``day``.  Its file sink commits a micro-batch as a
whole, so a replay adds nothing.  Three readers share it:

* the windows of every grain read the good records as a stream;
* the reject side channel (FLT-3) copies the rejected lines with their reasons;
* the disks of Query 2's ranked vaults (AGG-7, FN-5) are joined from it when windows
  close, so that no state holds disks: :func:`ranked_disks_of_windows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import parse
from ..functions.text import disk_text
from ..operators.failures import rank_top_k
from ..plans.query1 import Q1_VAULTS
from ..plans.query2 import TOP_K
from ..plans.query3 import Q3_VAULTS
from ..windows import GRAINS, Grain, window_text

_COLUMNS = {"q1": ("ts", "vault_id", "s194"), "q2": ("ts", "vault_id", "failure", "model", "serial_number")}


def _wanted(query: str, dedup_key: str) -> Column:
    """What the query keeps of its good records (FLT-2, FLT-5..8)."""
    vault = F.col("vault_id")
    if query == "q1":
        return F.col("s194").isNotNull() & vault.between(*Q1_VAULTS)
    if query == "q2":
        return F.col("failure") == 1
    return (F.length(dedup_key) > 0) & F.col("s9").isNotNull() & vault.between(*Q3_VAULTS)


def parsed_rows(lines: DataFrame, query: str, dedup_key: str = "serial_number") -> DataFrame:
    """The query's records and the rejected lines with their reasons, from one parse:
    the record's columns, line (of rejects only), reject_reason, rejected[, day]."""
    bad = F.col("reject_reason").isNotNull()
    columns = _COLUMNS.get(query, ("ts", "vault_id", dedup_key, "s9"))
    rows = parse.parse_lines(lines, query, key=dedup_key).where(bad | _wanted(query, dedup_key))
    day = [F.to_date("ts").alias("day")] if query == "q2" else []
    return rows.select(*columns, F.when(bad, F.col("line")).alias("line"), "reject_reason", bad.alias("rejected"), *day)


def partitions(query: str) -> list[str]:
    return ["rejected", "day"] if query == "q2" else ["rejected"]


def start_parse(rows: DataFrame, query: str, path: str, checkpoint: str, trigger) -> object:
    """Starts the parse stage's query into the table at ``path``."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return trigger(writer.partitionBy(*partitions(query)).outputMode("append").queryName(f"{query}_parse")).start()


def records_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """The good records of the table at ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).where(~F.col("rejected")).drop("line", "reject_reason", "rejected", "day")


def start_rejects(spark: SparkSession, path: str, schema, output: str, checkpoint: str, trigger) -> object:
    """Starts the reject side channel: line and reason of rejected lines, as Parquet."""
    rejected = spark.readStream.schema(schema).parquet(path).where("rejected").select("line", "reject_reason")
    writer = rejected.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
    return trigger(writer.outputMode("append").queryName("rejects")).start()


def ranked_disks_of_windows(spark: SparkSession, closed: DataFrame, path: str, grains: tuple[Grain, ...] = GRAINS, k: int = TOP_K) -> DataFrame:
    """The first ``k`` vaults of each closed window with their failed disks: grain, ts, rank,
    vault_id, failures, disk_details.

    ``closed`` (grain, window, vault_id, failures) is one micro-batch; the disks come from
    the days of its windows only.  A record too late for its window is in the table but
    not in ``failures``; it arrived after all that were counted, so the first
    ``failures`` of a vault in order of arrival are the ones, also when the batch is replayed.
    """
    ranked = rank_top_k(closed, k, by=("grain",))
    span = ranked.agg(F.min("window.start").alias("lo"), F.max("window.end").alias("hi")).first()
    records = spark.read.parquet(path)
    records = records.where(~F.col("rejected") & F.col("day").between(F.lit(span.lo).cast("date"), F.lit(span.hi).cast("date")))
    of = F.explode(F.array(*[F.struct(F.lit(g.label).alias("grain"), g.window_of("ts").alias("window")) for g in grains]))
    disks = records.select(
        of.alias("of"), "vault_id", F.col("ts").alias("event_ts"), "model", "serial_number",
        F.col("_metadata.file_modification_time").alias("arrived"),
    ).select("of.grain", "of.window", "vault_id", "event_ts", "model", "serial_number", "arrived")
    by = ["grain", "window", "vault_id"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy("arrived", "event_ts", "model", "serial_number"))
    counted = ranked.join(disks, by).withColumn("place", place).where(F.col("place") <= F.col("failures"))
    ordered = F.array_sort(F.collect_list(F.struct("event_ts", "model", "serial_number")))
    text = F.array_join(F.transform(ordered, lambda d: disk_text(d["model"], d["serial_number"])), ", ")
    out = counted.groupBy("grain", "window", "rank", "vault_id", "failures").agg(text.alias("disk_details"))
    return out.select("grain", window_text("window.start").alias("ts"), "rank", "vault_id", "failures", "disk_details")
