"""Registered queries and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  Doubles are rounded to 6 digits in both the Spark result and
the oracle so that summation order cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import parse
from ..functions.text import record_text
from ..session import configure
from ..sinks import files as file_sink
from ..sinks import kafka as kafka_sink
from ..sources import text as text_src
from ..sources.telemetry import LINEITEM_SQL, TELEMETRY_SQL, lineitem_telemetry, telemetry
from ..streaming import queries as sq
from ..streaming import run as stream_run
from ..windows import ALL_TIME, DAY, GRAINS, THREE_DAYS, Grain, window_text
from . import emission, query1, query2, query3

DIGITS = 6

QueryFn = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column in two steps (digits + 3, then digits): two
    engines that sum in different orders differ in the last ulp, and a value on
    an exact half (e.g. 52.1984375) would otherwise round either way."""
    return df.select(
        *[
            F.round(F.round(F.col(f.name), digits + 3), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _r(expr: str, digits: int = DIGITS) -> str:
    """The oracle side of :func:`round_doubles`."""
    return f"round(round({expr}, {digits + 3}), {digits})"


def _telemetry(
    spark: SparkSession, sf_dir: str, vaults: tuple[int, int] | None = None, failures_only: bool = False
) -> DataFrame:
    return telemetry(configure(spark), sf_dir, vaults, failures_only)


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 2 reads failed rows only; the predicate reaches the scan."""
    return _telemetry(spark, sf_dir, failures_only=True)


def _fmt(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _with_view(body: str) -> str:
    return f"with t as ({TELEMETRY_SQL})\n{body}"


QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, fn: QueryFn, oracle: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir, _fn=fn: round_doubles(_fn(spark, sf_dir))
    if oracle is not None:
        ORACLES[name] = oracle


# ---------------------------------------------------------------- Query 1


def _q1_oracle(grain: Grain, vaults=query1.Q1_VAULTS, with_grain: bool = False) -> str:
    lo, hi = vaults
    g = f"'{grain.label}' as grain, " if with_grain else ""
    return (
        f"select {g}{_fmt(grain.duckdb_bucket())} as ts, vault_id, count(*) as count, "
        f"{_r('avg(s194)')} as mean_s194, "
        f"{_r('coalesce(stddev_samp(s194), 0.0)')} as stddev_s194 "
        f"from t where s194 is not null and vault_id between {lo} and {hi} group by all"
    )


for _g in GRAINS:
    register(
        f"q1_temperature_{_g.label}",
        lambda spark, d, g=_g: query1.temperature_stats(_telemetry(spark, d, query1.Q1_VAULTS), g),
        _with_view(_q1_oracle(_g)),
    )

for _g in (THREE_DAYS, ALL_TIME):
    register(
        f"q1_rollup_{_g.label}",
        lambda spark, d, g=_g: query1.temperature_stats_rollup(_telemetry(spark, d, query1.Q1_VAULTS), g),
        _with_view(_q1_oracle(_g)),
    )

register(
    "q1_all_grains",
    lambda spark, d: query1.temperature_stats_all_grains(_telemetry(spark, d, query1.Q1_VAULTS)),
    _with_view("\nunion all\n".join(_q1_oracle(g, with_grain=True) for g in GRAINS)),
)

# The same operator with the vault filter off: every event of the table counts.
register(
    "q1_temperature_1day_all_vaults",
    lambda spark, d: query1.temperature_stats(_telemetry(spark, d), DAY, vaults=None),
    _with_view(
        f"select {_fmt(DAY.duckdb_bucket())} as ts, vault_id, count(*) as count, "
        f"{_r('avg(s194)')} as mean_s194, {_r('coalesce(stddev_samp(s194), 0.0)')} as stddev_s194 "
        "from t where s194 is not null group by all"
    ),
)


# ---------------------------------------------------------------- Query 2


def _q2_ranked_sql(grain: Grain, k: int = 10) -> str:
    return (
        f"c as (select {grain.duckdb_bucket()} as w, vault_id, cast(sum(failure) as bigint) as failures "
        "from t where failure = 1 group by all),\n"
        "r as (select w, vault_id, failures, "
        "cast(row_number() over (partition by w order by failures desc, vault_id) as integer) as rank "
        f"from c qualify rank <= {k}),\n"
        f"d as (select {grain.duckdb_bucket()} as w, vault_id, ts as event_ts, model, serial_number from t where failure = 1),\n"
        "x as (select r.w, r.rank, r.vault_id, r.failures, "
        "string_agg('[model=''' || d.model || ''', serialNumber=''' || d.serial_number || ''']', ', ' "
        "order by d.event_ts, d.model, d.serial_number) as disk_details "
        "from r join d using (w, vault_id) group by all)"
    )


def _q2(grain: Grain, select: str) -> str:
    return f"with t as ({TELEMETRY_SQL}),\n{_q2_ranked_sql(grain)}\n{select}"


for _g in GRAINS:
    register(
        f"q2_top_vaults_{_g.label}",
        lambda spark, d, g=_g: query2.top_vaults(_failures(spark, d), g),
        _q2(_g, f"select {_fmt('w')} as ts, rank, vault_id, failures from r"),
    )
    register(
        f"q2_top_vaults_details_{_g.label}",
        lambda spark, d, g=_g: query2.top_vault_details(_failures(spark, d), g),
        _q2(_g, f"select {_fmt('w')} as ts, rank, vault_id, failures, disk_details from x"),
    )

register(
    "q2_top_vaults_disks_3days",
    lambda spark, d: query2.top_vault_disks(_failures(spark, d), THREE_DAYS),
    _q2(
        THREE_DAYS,
        f"select {_fmt('r.w')} as ts, r.rank, r.vault_id, r.failures, strftime(d.event_ts, '%Y-%m-%d %H:%M:%S.%f') as event_ts, "
        "d.model, d.serial_number from r join d using (w, vault_id)",
    ),
)

register(
    "q2_ranking_line_3days",
    lambda spark, d: query2.ranking_lines(_failures(spark, d), THREE_DAYS),
    _q2(
        THREE_DAYS,
        f"select {_fmt('w')} as ts, {_fmt('w + INTERVAL 3 days')} as ts_end, "
        f"{_fmt('w')} || ', ' || string_agg(', ' || cast(vault_id as varchar) || ', ' || cast(failures as varchar) "
        "|| ' (' || disk_details || ')', '' order by rank) as line from x group by w",
    ),
)

register(
    "q2_wide_1day",
    lambda spark, d: query2.wide_ranking(_failures(spark, d), DAY),
    _q2(
        DAY,
        f"select {_fmt('w')} as ts, "
        + ", ".join(
            f"max(case when rank = {i} then vault_id end) as vault_id{i}, "
            f"max(case when rank = {i} then failures end) as failures{i}, "
            f"max(case when rank = {i} then disk_details end) as disk_details{i}"
            for i in range(1, 11)
        )
        + " from x group by w",
    ),
)


# ---------------------------------------------------------------- Query 3


def _hazen_sql(q: float, x: str = "x") -> str:
    h = f"greatest(0.0, least({q} * n - 0.5, n - 1))"
    lo = f"max(case when pos = floor({h}) then {x} end)"
    hi = f"max(case when pos = floor({h}) + 1 then {x} end)"
    return f"({lo} + ({h} - floor({h})) * (coalesce({hi}, {lo}) - {lo}))"


def _q3_oracle(grain: Grain, key: str = "serial_number", vaults=query3.Q3_VAULTS) -> str:
    vault_pred = f"vault_id between {vaults[0]} and {vaults[1]} and " if vaults else ""
    return _with_view(
        f"""select {_fmt('w')} as ts, vault_id, count(*) as count, {_r('min(x)')} as min_hours,
       {_r(_hazen_sql(0.25))} as p25_hours, {_r(_hazen_sql(0.5))} as p50_hours, {_r(_hazen_sql(0.75))} as p75_hours,
       {_r('max(x)')} as max_hours
from (
  select w, vault_id, x, row_number() over (partition by w, vault_id order by x) - 1 as pos,
         count(*) over (partition by w, vault_id) as n
  from (
    select {grain.duckdb_bucket()} as w, vault_id, {key} as k, s9 as x,
           row_number() over (partition by {grain.duckdb_bucket()}, vault_id, {key} order by ts desc, s9 desc) as rn
    from t where {vault_pred}length({key}) > 0 and s9 is not null
  ) where rn = 1
) group by w, vault_id, n"""
    )


for _g in GRAINS:
    register(
        f"q3_power_on_{_g.label}",
        lambda spark, d, g=_g: query3.power_on_quantiles(_telemetry(spark, d, query3.Q3_VAULTS), g),
        _q3_oracle(_g),
    )

# The same operator with the vault filter off: every event of the table counts.
register(
    "q3_power_on_3days_all_vaults",
    lambda spark, d: query3.power_on_quantiles(_telemetry(spark, d), THREE_DAYS, vaults=None),
    _q3_oracle(THREE_DAYS, vaults=None),
)

register(
    "q3_power_on_3days_by_model",
    lambda spark, d: query3.power_on_quantiles(_telemetry(spark, d, query3.Q3_VAULTS), THREE_DAYS, dedup_key="model"),
    _q3_oracle(THREE_DAYS, key="model"),
)

# AGG-12.  A group of up to the accuracy's size keeps all its values, so that the sketch
# returns the value of rank ceil(q * n); a disk has one value per window, and a vault four disks.
register(
    "q3_power_on_approx_3days",
    lambda spark, d: query3.power_on_quantiles_approx(_telemetry(spark, d, query3.Q3_VAULTS), THREE_DAYS),
    _with_view(
        f"""select {_fmt('w')} as ts, vault_id, count(*) as count, {_r('min(x)')} as min_hours,
       """
        + ", ".join(
            f"{_r(f'max(case when pos = greatest(ceil({q} * n), 1) then x end)')} as {name}_hours"
            for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        )
        + f""", {_r('max(x)')} as max_hours
from (
  select w, vault_id, x, row_number() over (partition by w, vault_id order by x) as pos, count(*) over (partition by w, vault_id) as n
  from (
    select {THREE_DAYS.duckdb_bucket()} as w, vault_id, s9 as x, row_number() over (
      partition by {THREE_DAYS.duckdb_bucket()}, vault_id, serial_number order by ts desc, s9 desc) as rn
    from t where vault_id between 1090 and 1120 and length(serial_number) > 0 and s9 is not null)
  where rn = 1)
group by w, vault_id"""
    ),
)

# AGG-12, mergeable: day sketches merged to coarser windows.  The quantiles are a sketch's own
# choice, so the comparable columns say whether each lies within 2 % of its rank.
for _g in (THREE_DAYS, ALL_TIME):
    register(
        f"q3_sketch_rollup_{_g.label}",
        lambda spark, d, g=_g: query3.sketch_rollup_errors(_telemetry(spark, d), g, vaults=None).select(
            "ts", "vault_id", "count", F.col("min").alias("min_hours"), F.col("max").alias("max_hours"),
            *[(F.col(f"{p}_error") <= 0.02).alias(f"{p}_within") for p in ("p25", "p50", "p75")],
        ),
        _with_view(
            f"select {_fmt(_g.duckdb_bucket('w'))} as ts, vault_id, count(*) as count, {_r('min(x)')} as min_hours, "
            f"{_r('max(x)')} as max_hours, true as p25_within, true as p50_within, true as p75_within from ("
            f"select {DAY.duckdb_bucket()} as w, vault_id, s9 as x, row_number() over ("
            f"partition by {DAY.duckdb_bucket()}, vault_id, serial_number order by ts desc, s9 desc) as rn "
            "from t where length(serial_number) > 0 and s9 is not null) where rn = 1 group by 1, 2"
        ),
    )

register(
    "q3_latest_hours_1day",
    lambda spark, d: query3.latest_hours(_telemetry(spark, d, query3.Q3_VAULTS), DAY).select(
        window_text("window.start").alias("ts"), "vault_id", "serial_number", F.col("s9").alias("latest_hours")
    ),
    _with_view(
        f"select {_fmt('w')} as ts, vault_id, serial_number, {_r('x')} as latest_hours from ("
        f"select {DAY.duckdb_bucket()} as w, vault_id, serial_number, s9 as x, row_number() over ("
        f"partition by {DAY.duckdb_bucket()}, vault_id, serial_number order by ts desc, s9 desc) as rn "
        "from t where vault_id between 1090 and 1120 and length(serial_number) > 0 and s9 is not null) where rn = 1"
    ),
)


# ---------------------------------------------------------------- raw lines


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_src.telemetry_lines(_telemetry(spark, sf_dir))


def _parsed_good(spark: SparkSession, sf_dir: str, query: str, key: str = "serial_number") -> DataFrame:
    return parse.good_records(parse.parse_lines(_lines(spark, sf_dir), query, key=key))


def _lines_oracle(query: str, body: str, key: str = "serial_number") -> str:
    good = "t as (select ts, vault_id, failure, model, serial_number, s194, s9 from parsed where reject_reason is null)"
    return f"with {text_src.lines_sql()},\n{text_src.parse_sql(query, key)},\n{good}\n{body}"


# SNK-2 projection: key = first CSV field, value = the whole line.
register(
    "lines_publish_keyed",
    lambda spark, d: kafka_sink.publish_projection(_lines(spark, d)),
    f"with {text_src.lines_sql()}\nselect split_part(value, ',', 1) as key, value from lines "
    "where regexp_full_match(split_part(value, ',', 1), '[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{6}') "
    "and try_strptime(replace(split_part(value, ',', 1), 'T', ' '), '%Y-%m-%d %H:%M:%S.%f') is not null",
)

# SET-1: the lines that close every window of the data.
register(
    "closing_lines",
    lambda spark, d: stream_run.closing_lines_for(_lines(spark, d)),
    f"with {text_src.lines_sql()},\n"
    "l as (select max(try_strptime(replace(split_part(value, ',', 1), 'T', ' '), '%Y-%m-%d %H:%M:%S.%f')) as last from lines),\n"
    "c as (select greatest("
    + ", ".join(f"(floor((epoch(last) - {g.offset_days * 86400}) / {g.size_days * 86400}) + 1) * {g.size_days * 86400} + {g.offset_days * 86400}" for g in GRAINS)
    + ") + 86400 as secs from l where last is not null)\n"
    "select strftime(make_timestamp(cast(secs * 1000000 as bigint)), '%Y-%m-%dT%H:%M:%S.%f') || ',closing,closing,1,' || vault || ',,,,,,,,1.0,,,,,,,,,,,,,2.5,,,,,,,,,,,,,' as value "
    "from c, (select unnest([1000, 1120]) as vault)",
)

for _q in ("q1", "q2", "q3"):
    register(
        f"parse_rejects_{_q}",
        lambda spark, d, q=_q: parse.parse_lines(_lines(spark, d), q)
        .groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("reject_reason"))
        .agg(F.count(F.lit(1)).alias("n")),
        f"with {text_src.lines_sql()},\n{text_src.parse_sql(_q)}\n"
        "select coalesce(reject_reason, 'ok') as reject_reason, count(*) as n from parsed group by 1",
    )

register(
    "q1_from_lines_1day",
    lambda spark, d: query1.temperature_stats(_parsed_good(spark, d, "q1"), DAY),
    _lines_oracle("q1", _q1_oracle(DAY)),
)

register(
    "q2_from_lines_3days",
    lambda spark, d: query2.top_vault_details(_parsed_good(spark, d, "q2"), THREE_DAYS),
    _lines_oracle("q2", f", {_q2_ranked_sql(THREE_DAYS)}\nselect {_fmt('w')} as ts, rank, vault_id, failures, disk_details from x"),
)

register(
    "q3_from_lines_3days",
    lambda spark, d: query3.power_on_quantiles(_parsed_good(spark, d, "q3"), THREE_DAYS),
    _lines_oracle("q3", _q3_oracle(THREE_DAYS).replace(f"with t as ({TELEMETRY_SQL})\n", "")),
)


# ---------------------------------------------------------------- emission metrics and gaps


def _emission_oracle() -> str:
    parts = []
    for g in GRAINS:
        b = g.duckdb_bucket()
        parts.append(
            f"select '{g.label}' as grain, {b} as w, vault_id, "
            f"{b} + INTERVAL {g.size_days} days + INTERVAL 30 seconds as emitted_at from f group by all"
        )
    union = "\nunion all\n".join(parts)
    kept = "from t where s194 is not null and vault_id between 1000 and 1020"
    return _with_view(
        "select grain, " + _fmt("w") + " as ts, vault_id, " + _fmt("emitted_at") + " as emitted_at, n, elapsed_ms, "
        f"{_r('n / (elapsed_ms / 1000.0)')} as rows_per_s, {_r('elapsed_ms / n')} as ms_per_row from (\n"
        "select e.*, row_number() over (partition by grain order by emitted_at, vault_id) as n, "
        f"(epoch_us(emitted_at) // 1000) - (select epoch_us(min(ts)) // 1000 {kept}) as elapsed_ms from (\n"
        f"with f as (select * {kept})\n{union}\n"
        ") e)"
    )


register(
    "q1_emission_metrics",
    lambda spark, d: emission.q1_emission_metrics(_telemetry(spark, d, query1.Q1_VAULTS)),
    _emission_oracle(),
)

register(
    "publish_gaps",
    lambda spark, d: emission.publish_gaps(_telemetry(spark, d)),
    _with_view(
        "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, "
        "coalesce((epoch_us(ts) // 1000) - (epoch_us(lag(ts) over (order by ts, event_id)) // 1000), 0) as gap_ms from t"
    ),
)

register(
    "vault_gaps",
    lambda spark, d: emission.vault_gaps(_telemetry(spark, d)),
    _with_view(
        "select vault_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, "
        "coalesce((epoch_us(ts) // 1000) - (epoch_us(lag(ts) over (partition by vault_id order by ts, event_id)) // 1000), 0) as gap_ms from t"
    ),
)


# ---------------------------------------------------------------- messages (sink text and consumer parse)


def _q1_messages(spark: SparkSession, d: str) -> DataFrame:
    res = round_doubles(query1.temperature_stats(_telemetry(spark, d, query1.Q1_VAULTS), DAY))
    return kafka_sink.as_messages(res, kafka_sink.topic_name("query1", DAY.label))


_Q1_MSG_SQL = (
    f"select 'query1-1day' as topic, '(' || ts || ',' || cast(vault_id as varchar) || ',' || cast(count as varchar) "
    "|| ',' || cast(mean_s194 as varchar) || ',' || cast(stddev_s194 as varchar) || ')' as value "
    f"from ({_q1_oracle(DAY)})"
)

register("q1_messages_1day", _q1_messages, _with_view(_Q1_MSG_SQL))

register(
    "q1_consumer_columns_1day",
    lambda spark, d: file_sink.message_columns(_q1_messages(spark, d), 5, list(query1.Q1_COLUMNS)),
    _with_view(
        "select topic, "
        + ", ".join(
            f"string_split(replace(replace(replace(value, '(', ''), ')', ''), '\"', ''), ',')[{i + 1}] as {c}"
            for i, c in enumerate(query1.Q1_COLUMNS)
        )
        + f" from ({_Q1_MSG_SQL})"
    ),
)


# ---------------------------------------------------------------- CSV headers (SNK-5)

register(
    "q1_csv_1day",
    lambda spark, d: file_sink.with_reference_header(
        query1.temperature_stats(_telemetry(spark, d, query1.Q1_VAULTS), DAY), "query1-1day"
    ),
    _with_view(_q1_oracle(DAY)),
)

register(
    "q3_csv_3days",
    lambda spark, d: file_sink.with_reference_header(
        query3.power_on_quantiles(_telemetry(spark, d, query3.Q3_VAULTS), THREE_DAYS), "query3_3-days"
    ),
    "select ts, vault_id as vault_id1, count, min_hours as min, p25_hours as \"25perc\", p50_hours as \"50perc\", "
    "p75_hours as \"75perc\", max_hours as max from (" + _q3_oracle(THREE_DAYS) + ")",
)


# SNK-4, SNK-5: Query 2's ranking lines as messages, taken apart into the file's 31 columns.
register(
    "q2_csv_1day",
    lambda spark, d: file_sink.topic_columns(
        query2.ranking_lines(_failures(spark, d), DAY).select(
            F.lit(kafka_sink.topic_name("query2", DAY.label)).alias("topic"), F.col("line").alias("value")
        ),
        "query2",
    ).drop("topic"),
    ORACLES["q2_wide_1day"],
)


# ---------------------------------------------------------------- the same operators over lineitem


def _lineitem(spark: SparkSession, sf_dir: str, failures_only: bool = False) -> DataFrame:
    return lineitem_telemetry(configure(spark), sf_dir, failures_only)


def _with_lineitem(body: str) -> str:
    return f"with t as ({LINEITEM_SQL})\n{body}"


register(
    "q1_lineitem_all_grains",
    lambda spark, d: query1.temperature_stats_all_grains(_lineitem(spark, d), vaults=None),
    _with_lineitem(
        "\nunion all\n".join(
            f"select '{g.label}' as grain, {_fmt(g.duckdb_bucket())} as ts, vault_id, count(*) as count, "
            f"{_r('avg(s194)')} as mean_s194, {_r('coalesce(stddev_samp(s194), 0.0)')} as stddev_s194 "
            "from t where s194 is not null group by all"
            for g in GRAINS
        )
    ),
)

register(
    "q2_lineitem_top_vaults_3days",
    lambda spark, d: query2.top_vaults(_lineitem(spark, d, failures_only=True), THREE_DAYS),
    f"with t as ({LINEITEM_SQL}),\n{_q2_ranked_sql(THREE_DAYS)}\n"
    f"select {_fmt('w')} as ts, rank, vault_id, failures from r",
)

register(
    "q3_lineitem_quantiles_alltime",
    lambda spark, d: query3.power_on_quantiles(_lineitem(spark, d), ALL_TIME, vaults=None),
    _q3_oracle(ALL_TIME, vaults=None).replace(f"with t as ({TELEMETRY_SQL})", f"with t as ({LINEITEM_SQL})"),
)


# ---------------------------------------------------------------- streaming forms (stream = batch)
# Each runs the Structured Streaming query over the rendered lines (plus
# closing lines) with availableNow into a Parquet sink in the shared checkpoint
# folder; the oracle is the batch SQL over the same lines.

register(
    "stream_q1_1day",
    lambda spark, d: stream_run.stream_over_lines(spark, _lines(spark, d), lambda s: sq.q1_stream(s, DAY), "q1"),
    _lines_oracle("q1", _q1_oracle(DAY)),
)

register(
    "stream_q1_all_grains",
    lambda spark, d: stream_run.all_grains_over_lines(spark, _lines(spark, d), "q1", "q1all"),
    _lines_oracle("q1", "\nunion all\n".join(_q1_oracle(g, with_grain=True) for g in GRAINS)),
)

register(
    "stream_q2_top_vaults_3days",
    lambda spark, d: stream_run.closed_windows_over_lines(spark, _lines(spark, d), "q2", THREE_DAYS, "q2"),
    _lines_oracle("q2", f", {_q2_ranked_sql(THREE_DAYS)}\nselect {_fmt('w')} as ts, rank, vault_id, failures from r"),
)

register(
    "stream_q3_3days",
    lambda spark, d: stream_run.closed_windows_over_lines(spark, _lines(spark, d), "q3", THREE_DAYS, "q3"),
    _lines_oracle("q3", _q3_oracle(THREE_DAYS).replace(f"with t as ({TELEMETRY_SQL})\n", "")),
)

register(
    "stream_q2_all_grains",
    lambda spark, d: stream_run.all_grains_over_lines(spark, _lines(spark, d), "q2", "q2all"),
    f"with {text_src.lines_sql()},\n{text_src.parse_sql('q2')},\n"
    "t as (select ts, vault_id, failure, model, serial_number, s194, s9 from parsed where reject_reason is null)\n"
    + "\nunion all\n".join(
        f"(with {_q2_ranked_sql(g)}\nselect '{g.label}' as grain, {_fmt('w')} as ts, rank, vault_id, failures from r)"
        for g in GRAINS
    ),
)

register(
    "stream_q2_details_all_grains",
    lambda spark, d: stream_run.all_grains_over_lines(spark, _lines(spark, d), "q2", "q2details", details=True),
    f"with {text_src.lines_sql()},\n{text_src.parse_sql('q2')},\n"
    "t as (select ts, vault_id, failure, model, serial_number, s194, s9 from parsed where reject_reason is null)\n"
    + "\nunion all\n".join(
        f"(with {_q2_ranked_sql(g)}\nselect '{g.label}' as grain, {_fmt('w')} as ts, rank, vault_id, failures, disk_details from x)"
        for g in GRAINS
    ),
)

register(
    "stream_q3_all_grains",
    lambda spark, d: stream_run.all_grains_over_lines(spark, _lines(spark, d), "q3", "q3all"),
    _lines_oracle(
        "q3",
        "\nunion all\n".join(
            "select '" + g.label + "' as grain, * from ("
            + _q3_oracle(g).replace(f"with t as ({TELEMETRY_SQL})\n", "") + ")"
            for g in GRAINS
        ),
    ),
)


# ---------------------------------------------------------------- metric log and debug text


def _metric_log_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """SNK-7 then MET-3: metric log lines of the Query 1 emission metrics,
    parsed back into (grain, metric, value, unit)."""
    from ..operators.metrics import metric_log_lines, parse_metric_log

    m = emission.q1_emission_metrics(_telemetry(spark, d, query1.Q1_VAULTS))
    return parse_metric_log(metric_log_lines(m))


def _metric_log_oracle() -> str:
    inner = _emission_oracle().replace(f"with t as ({TELEMETRY_SQL})\n", "")
    return _with_view(
        f"select grain, 'throughput' as metric, {_r('rows_per_s')} as value, 'tuples/s' as unit from ({inner})\n"
        f"union all\nselect grain, 'latency' as metric, {_r('ms_per_row')} as value, 'ms/tuple' as unit from ({inner})"
    )


register("q1_metric_log_round_trip", _metric_log_round_trip, _metric_log_oracle())

register(
    "q1_debug_text_1day",
    lambda spark, d: round_doubles(query1.temperature_stats(_telemetry(spark, d, query1.Q1_VAULTS), DAY)).select(
        "ts",
        record_text("Statistics", "vault_id", "count", "mean_s194", "stddev_s194").alias("text"),
    ),
    _with_view(
        "select ts, 'Statistics{vault_id=' || cast(vault_id as varchar) || ', count=' || cast(count as varchar) "
        "|| ', mean_s194=' || cast(mean_s194 as varchar) || ', stddev_s194=' || cast(stddev_s194 as varchar) || '}' as text "
        f"from ({_q1_oracle(DAY)})"
    ),
)

register(
    "stream_q3_exact_3days",
    lambda spark, d: stream_run.stream_foreach_batch_over_lines(
        spark, _lines(spark, d), lambda s: sq.q3_latest_stream(s, THREE_DAYS), sq.q3_quantiles_batch_writer, "q3exact"
    ),
    _lines_oracle("q3", _q3_oracle(THREE_DAYS).replace(f"with t as ({TELEMETRY_SQL})\n", "")),
)
