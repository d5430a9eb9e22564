"""Positional layout of a raw telemetry line and the output schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Field positions of a raw line (39 comma-separated fields, empty
# = missing); a line needs at least 26 fields.
N_FIELDS = 39
MIN_FIELDS = 26
IDX_TS = 0
IDX_SERIAL = 1
IDX_MODEL = 2
IDX_FAILURE = 3
IDX_VAULT = 4
IDX_POWER_ON_HOURS = 12
IDX_TEMPERATURE = 25
HEADER_PREFIX = "date,serial_number,model,failure,vault_id"
TS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_TEXT_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}$"
INT_TEXT_RE = r"^[+-]?[0-9]+$"

_NAMED = {
    IDX_TS: "date",
    IDX_SERIAL: "serial_number",
    IDX_MODEL: "model",
    IDX_FAILURE: "failure",
    IDX_VAULT: "vault_id",
    IDX_POWER_ON_HOURS: "s9_power_on_hours",
    IDX_TEMPERATURE: "s194_temperature_celsius",
}
FIELD_NAMES = tuple(_NAMED.get(i, f"f{i}") for i in range(N_FIELDS))

# All 39 fields as text (the CSV reader's view of a raw file).
RAW_SCHEMA = StructType([StructField(n, StringType()) for n in FIELD_NAMES])

# Parsed telemetry record (the union of what the three queries read).
RECORD_SCHEMA = StructType(
    [
        StructField("ts", TimestampType()),
        StructField("vault_id", IntegerType()),
        StructField("failure", IntegerType()),
        StructField("model", StringType()),
        StructField("serial_number", StringType()),
        StructField("s194", DoubleType()),
        StructField("s9", DoubleType()),
    ]
)

DISK = StructType([StructField("model", StringType()), StructField("serial_number", StringType())])

Q1_OUTPUT = StructType(
    [
        StructField("ts", StringType()),
        StructField("vault_id", IntegerType()),
        StructField("count", LongType()),
        StructField("mean_s194", DoubleType()),
        StructField("stddev_s194", DoubleType()),
    ]
)

Q2_OUTPUT = StructType(
    [
        StructField("ts", StringType()),
        StructField("rank", IntegerType()),
        StructField("vault_id", IntegerType()),
        StructField("failures", LongType()),
        StructField("disks", ArrayType(DISK)),
    ]
)

Q3_OUTPUT = StructType(
    [StructField("ts", StringType()), StructField("vault_id", IntegerType()), StructField("count", LongType())]
    + [StructField(f"{n}_hours", DoubleType()) for n in ("min", "p25", "p50", "p75", "max")]
)

# CSV headers of the reference's result files, by topic prefix.
CSV_HEADERS = {
    "query1": "ts,vault_id,count,mean_s194,stddev_s194",
    "query2": "ts," + ",".join(f"vault_id{k},failures{k},disk_details [model,serial]" for k in range(1, 11)),
    "query3": "ts,vault_id1,count,min,25perc,50perc,75perc,max",
}

# Column names for files, by topic prefix.  Query 2's header above repeats a name and has a
# comma inside another, so its columns are numbered.
FILE_COLUMNS = {
    "query1": CSV_HEADERS["query1"].split(","),
    "query2": ["ts", *(f"{c}{k}" for k in range(1, 11) for c in ("vault_id", "failures", "disk_details"))],
    "query3": CSV_HEADERS["query3"].split(","),
}
