import pytest

from vaultscope import schema as S
from vaultscope.functions import parse


def line(ts="2023-04-01T00:00:00.000000", serial="SER", model="MOD", failure="0", vault="1005", hours="100.0", temp="30.0", n=39):
    f = [""] * n
    vals = {0: ts, 1: serial, 2: model, 3: failure, 4: vault, 12: hours, 25: temp}
    for i, v in vals.items():
        if i < n:
            f[i] = v
    return ",".join(f)


CASES = [
    ("ok", line(), {"q1": None, "q2": None, "q3": None}),
    ("short", line(n=25), {"q1": "too_few_fields", "q2": "too_few_fields", "q3": "too_few_fields"}),
    ("26 fields", line(n=26), {"q1": None, "q2": None, "q3": None}),
    ("no fraction", line(ts="2023-04-01T00:00:00"), {"q1": "bad_timestamp"}),
    ("3 fraction digits", line(ts="2023-04-01T00:00:00.000"), {"q1": "bad_timestamp"}),
    ("garbage ts", line(ts="yesterday"), {"q2": "bad_timestamp"}),
    ("vault text", line(vault="v1"), {"q1": "bad_vault_id", "q3": "bad_vault_id"}),
    ("vault padded", line(vault=" 12 "), {"q1": "bad_vault_id"}),
    ("vault decimal", line(vault="1.0"), {"q2": "bad_vault_id"}),
    ("failure text", line(failure="x"), {"q1": None, "q2": "bad_failure"}),
    ("empty temperature", line(temp=""), {"q1": "empty_temperature", "q2": None}),
    ("temperature text", line(temp="hot"), {"q1": "bad_temperature"}),
    ("temperature NaN", line(temp="NaN"), {"q1": None}),
    ("empty serial", line(serial=""), {"q3": "empty_key", "q1": None}),
    ("empty hours", line(hours=""), {"q3": "empty_hours"}),
    ("hours text", line(hours="n/a"), {"q3": "bad_hours"}),
]


@pytest.mark.parametrize("name,text,expect", CASES, ids=[c[0] for c in CASES])
def test_reject_reasons(spark, name, text, expect):
    df = spark.createDataFrame([(text,)], "value string")
    for q, reason in expect.items():
        (r,) = parse.parse_lines(df, q).collect()
        assert r.reject_reason == reason, (q, name)


def test_header_skipped_and_typed(spark):
    df = spark.createDataFrame([(",".join(S.FIELD_NAMES),), (line(),)], "value string")
    rows = parse.good_records(parse.parse_lines(df, "q1")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.vault_id == 1005 and r.s194 == 30.0 and r.s9 == 100.0 and r.failure == 0
    assert r.model == "MOD" and r.serial_number == "SER"
    assert str(r.ts) == "2023-04-01 00:00:00"


def test_split_keeps_empty_fields(spark):
    df = spark.createDataFrame([("a,,b,,",)], "value string")
    (r,) = parse.split_line(df).collect()
    assert r.fields == ["a", "", "b", "", ""]


def test_rejects_side_channel(spark):
    df = spark.createDataFrame([(line(),), (line(vault="x"),)], "value string")
    rej = parse.rejects(parse.parse_lines(df, "q1")).collect()
    assert [(r.reject_reason) for r in rej] == ["bad_vault_id"]


def test_single_split_in_plan(spark):
    """The parse fence keeps one split per line in the generated plan."""
    df = spark.createDataFrame([(line(),)], "value string")
    good = parse.good_records(parse.parse_lines(df, "q3"))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_only_the_header_itself_is_skipped(spark):
    df = spark.createDataFrame([(",".join(S.FIELD_NAMES),), ("dated but no header",), (line(ts="date"),)], "value string")
    got = sorted(r.reject_reason for r in parse.parse_lines(df, "q1").collect())
    assert got == ["bad_timestamp", "too_few_fields"]
