"""Telemetry view over the driver's ``events`` table.

The reference reads disk S.M.A.R.T. lines; the driver ships a generic event
table instead.  This adapter maps it onto the parsed-record columns every query
uses, so the work of every query grows with ``events``:

============== =============================================================
column          from ``events``
============== =============================================================
ts              ``ts`` (TIMESTAMP_NTZ, read as UTC wall clock)
vault_id        ``1000 + user_id``
failure         1 when ``event_type = 'error'`` else 0
model           ``event_type``
serial_number   ``'S' || user_id || '-' || event_id % 4``  (4 disks per vault)
s194            ``value``  (temperature, Query 1)
s9              ``(event_id * 7919) % 90000`` (power-on hours, Query 3)
============== =============================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

TELEMETRY_COLUMNS = ("event_id", "ts", "vault_id", "failure", "model", "serial_number", "s194", "s9")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """Project ``events`` to telemetry records (narrow: no shuffle)."""
    uid = F.col("user_id")
    eid = F.col("event_id")
    return events.select(
        eid.alias("event_id"),
        # NTZ -> TIMESTAMP under the UTC session zone keeps the wall clock and is
        # what withWatermark requires.
        F.col("ts").cast("timestamp").alias("ts"),
        (F.lit(1000) + uid).cast("int").alias("vault_id"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("failure"),
        F.col("event_type").alias("model"),
        F.concat(F.lit("S"), uid.cast("string"), F.lit("-"), (eid % 4).cast("string")).alias("serial_number"),
        F.col("value").alias("s194"),
        ((eid * 7919) % 90000).cast("double").alias("s9"),
    )


def telemetry(
    spark: SparkSession, sf_dir: str, vaults: tuple[int, int] | None = None, failures_only: bool = False
) -> DataFrame:
    """Telemetry records.  ``vaults`` (inclusive range) and ``failures_only``
    are applied to the raw columns (``user_id``, ``event_type``) so that they
    reach the Parquet scan as pushed filters; predicates on the derived
    ``vault_id`` / ``failure`` columns cannot be pushed (Catalyst rewrites
    ``failure = 1`` to ``(event_type = 'error') <=> true``)."""
    events = read_table(spark, sf_dir, "events")
    if vaults is not None:
        lo, hi = vaults
        events = events.where(F.col("user_id").between(lo - 1000, hi - 1000))
    if failures_only:
        events = events.where(F.col("event_type") == "error")
    return telemetry_from_events(events)


# The same view for DuckDB oracles (tables are pre-registered views there).
TELEMETRY_SQL = """
select event_id,
       ts,
       cast(1000 + user_id as integer) as vault_id,
       case when event_type = 'error' then 1 else 0 end as failure,
       event_type as model,
       concat('S', cast(user_id as varchar), '-', cast(event_id % 4 as varchar)) as serial_number,
       value as s194,
       cast((event_id * 7919) % 90000 as double) as s9
from events
""".strip()


def telemetry_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The same record columns over ``lineitem``, a wider and higher-cardinality
    input for the same operators:

    ts = ship date (midnight UTC), vault_id = supplier, failure = returned
    (``l_returnflag = 'R'``), model = return flag, serial_number = ``'P' || part``,
    s194 = extended price, s9 = quantity, event_id = order * 8 + line number.
    """
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_suppkey").cast("int").alias("vault_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("failure"),
        F.col("l_returnflag").alias("model"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("serial_number"),
        F.col("l_extendedprice").alias("s194"),
        F.col("l_quantity").alias("s9"),
    )


def lineitem_telemetry(spark: SparkSession, sf_dir: str, failures_only: bool = False) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    if failures_only:
        lineitem = lineitem.where(F.col("l_returnflag") == "R")
    return telemetry_from_lineitem(lineitem)


LINEITEM_SQL = """
select l_orderkey * 8 + l_linenumber as event_id,
       l_shipdate as ts,
       cast(l_suppkey as integer) as vault_id,
       case when l_returnflag = 'R' then 1 else 0 end as failure,
       l_returnflag as model,
       concat('P', cast(l_partkey as varchar)) as serial_number,
       l_extendedprice as s194,
       l_quantity as s9
from lineitem
""".strip()
