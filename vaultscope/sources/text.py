"""Raw telemetry lines: text sources (SRC-5) and a printer that renders the
telemetry view as the reference's 39-field CSV lines.

The printer is how the parser is exercised on the driver's data: every event
becomes one line, and about one line in 97 (``event_id % 97 = 0``) is broken
in one of nine ways picked by ``(event_id / 97) % 9``, so each reject reason
occurs.  The same rendering exists as DuckDB SQL for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from .telemetry import TELEMETRY_SQL

# How a broken line is broken, by kind.
BREAK_KINDS = (
    "truncated",  # 0: only 20 fields
    "no_fraction",  # 1: timestamp without the six fraction digits
    "vault_text",  # 2: vault id 'v<id>'
    "failure_text",  # 3: failure 'x'
    "empty_temperature",  # 4
    "temperature_text",  # 5: 'hot'
    "empty_key",  # 6: serial number and model empty
    "empty_hours",  # 7
    "hours_text",  # 8: 'n/a'
)
BREAK_EVERY = 97


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5 batch: one row per line (``value``); the parser drops headers."""
    return spark.read.text(path)


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-5 stream: new files under ``path`` become new lines."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def telemetry_lines(telemetry: DataFrame, break_every: int = BREAK_EVERY) -> DataFrame:
    """``value``: one CSV line per telemetry record (narrow projection)."""
    eid = F.col("event_id")
    broken = (eid % break_every) == 0
    kind = F.floor(eid / break_every) % len(BREAK_KINDS)

    def brk(i: int, normal, bad):
        return F.when(broken & (kind == i), bad).otherwise(normal)

    ts_full = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ts_short = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    vault = F.col("vault_id").cast("string")
    fields = {
        S.IDX_TS: brk(1, ts_full, ts_short),
        S.IDX_SERIAL: brk(6, F.col("serial_number"), F.lit("")),
        S.IDX_MODEL: brk(6, F.col("model"), F.lit("")),
        S.IDX_FAILURE: brk(3, F.col("failure").cast("string"), F.lit("x")),
        S.IDX_VAULT: brk(2, vault, F.concat(F.lit("v"), vault)),
        S.IDX_POWER_ON_HOURS: F.when(broken & (kind == 7), F.lit(""))
        .when(broken & (kind == 8), F.lit("n/a"))
        .otherwise(F.coalesce(F.col("s9").cast("string"), F.lit(""))),
        S.IDX_TEMPERATURE: F.when(broken & (kind == 4), F.lit(""))
        .when(broken & (kind == 5), F.lit("hot"))
        .otherwise(F.coalesce(F.col("s194").cast("string"), F.lit(""))),
    }
    full = F.concat(*_join_sparse(fields, F.lit))
    # first 20 fields of the line
    short = F.substring_index(full, ",", 20)
    line = F.when(broken & (kind == 0), short).otherwise(full)
    # ``inline`` keeps the parser's header filter from being pushed below this
    # projection, which would render every line twice
    return telemetry.select(F.inline(F.array(F.struct(line.alias("value")))))


def _join_sparse(fields: dict, lit) -> list:
    """Pieces of a 39-field line: the given fields, with runs of empty fields
    as literal commas in between (keeps generated code small)."""
    pieces, last = [], -1
    for i in sorted(fields):
        sep = "," * (i - last - 1 + (1 if last >= 0 else 0))
        if last < 0:
            sep = "," * i
        if sep:
            pieces.append(lit(sep))
        pieces.append(fields[i])
        last = i
    tail = "," * (S.N_FIELDS - 1 - last)
    if tail:
        pieces.append(lit(tail))
    return pieces


def header_line(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(",".join(S.FIELD_NAMES),)], "value string")


def lines_sql(break_every: int = BREAK_EVERY) -> str:
    """DuckDB form of :func:`telemetry_lines` (a CTE body named ``lines``)."""
    b = f"(event_id % {break_every} = 0)"
    k = f"((event_id // {break_every}) % {len(BREAK_KINDS)})"

    def brk(i, normal, bad):
        return f"(case when {b} and {k} = {i} then {bad} else {normal} end)"

    fields = {
        S.IDX_TS: brk(1, "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')", "strftime(ts, '%Y-%m-%dT%H:%M:%S')"),
        S.IDX_SERIAL: brk(6, "serial_number", "''"),
        S.IDX_MODEL: brk(6, "model", "''"),
        S.IDX_FAILURE: brk(3, "cast(failure as varchar)", "'x'"),
        S.IDX_VAULT: brk(2, "cast(vault_id as varchar)", "'v' || cast(vault_id as varchar)"),
        S.IDX_POWER_ON_HOURS: f"(case when {b} and {k} = 7 then '' when {b} and {k} = 8 then 'n/a' "
        "else coalesce(cast(s9 as varchar), '') end)",
        S.IDX_TEMPERATURE: f"(case when {b} and {k} = 4 then '' when {b} and {k} = 5 then 'hot' "
        "else coalesce(cast(s194 as varchar), '') end)",
    }
    full = " || ".join(_join_sparse(fields, lambda t: f"'{t}'"))
    short = f"array_to_string(string_split({full}, ',')[1:20], ',')"
    return (
        f"tv as ({TELEMETRY_SQL}),\n"
        f"lines as (select case when {b} and {k} = 0 then {short} else {full} end as value from tv)"
    )


def parse_sql(query: str, key: str = "serial_number") -> str:
    """DuckDB form of the parser over ``lines``: CTE ``parsed`` with the record
    columns and ``reject_reason``."""
    key_idx = {"serial_number": S.IDX_SERIAL + 1, "model": S.IDX_MODEL + 1}[key]
    typed = (
        "typed as (select value as line, len(f) as n_fields, "
        "case when regexp_full_match(replace(f[1], 'T', ' '), '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{6}') "
        "then try_strptime(replace(f[1], 'T', ' '), '%Y-%m-%d %H:%M:%S.%f') end as ts, "
        "case when regexp_full_match(f[5], '[+-]?[0-9]+') then try_cast(f[5] as integer) end as vault_id, "
        "case when regexp_full_match(f[4], '[+-]?[0-9]+') then try_cast(f[4] as integer) end as failure, "
        f"f[{S.IDX_MODEL + 1}] as model, f[{S.IDX_SERIAL + 1}] as serial_number, "
        f"f[{key_idx}] as k, "
        f"f[{S.IDX_TEMPERATURE + 1}] as t194, try_cast(f[{S.IDX_TEMPERATURE + 1}] as double) as s194, "
        f"f[{S.IDX_POWER_ON_HOURS + 1}] as t9, try_cast(f[{S.IDX_POWER_ON_HOURS + 1}] as double) as s9 "
        "from (select value, string_split(value, ',') as f from lines where not starts_with(value, '" + S.HEADER_PREFIX + "')))"
    )
    tests = {
        "too_few_fields": f"n_fields < {S.MIN_FIELDS}",
        "bad_timestamp": "ts is null",
        "bad_vault_id": "vault_id is null",
        "bad_failure": "failure is null",
        "empty_temperature": "t194 = ''",
        "bad_temperature": "s194 is null",
        "empty_key": "k = ''",
        "empty_hours": "t9 = ''",
        "bad_hours": "s9 is null",
    }
    from ..functions.parse import REASONS

    case = "case " + " ".join(f"when {tests[r]} then '{r}'" for r in REASONS[query]) + " end"
    return f"{typed},\nparsed as (select *, {case} as reject_reason from typed)"
