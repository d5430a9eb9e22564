import datetime as dt

from vaultscope.plans import query2
from vaultscope.windows import DAY

SCHEMA = "ts timestamp, vault_id int, failure int, model string, serial_number string, s194 double, s9 double"
T0 = dt.datetime(2023, 4, 1, 10)


def fails(spark, per_vault):
    rows = []
    for vault, n in per_vault.items():
        for i in range(n):
            rows.append((T0 + dt.timedelta(minutes=i), vault, 1, f"M{vault}", f"S{vault}-{i}", 1.0, 1.0))
    rows.append((T0, 1500, 0, "M", "ok", 1.0, 1.0))  # not a failure
    return spark.createDataFrame(rows, SCHEMA)


def test_top_k_ties_and_eleventh_vault(spark):
    per_vault = {1000 + i: 1 for i in range(11)}
    per_vault[1050] = 3
    per_vault[1007] = 2
    per_vault[1003] = 2
    out = query2.top_vaults(fails(spark, per_vault), DAY).orderBy("rank").collect()
    assert [r.rank for r in out] == list(range(1, 11))
    assert [(r.vault_id, r.failures) for r in out[:3]] == [(1050, 3), (1003, 2), (1007, 2)]
    # ties at 1 ordered by vault id, the 12th and 13th failing vaults dropped
    assert [r.vault_id for r in out[3:]] == [1000, 1001, 1002, 1004, 1005, 1006, 1008]
    assert 1500 not in {r.vault_id for r in out}


def test_fewer_than_k_vaults(spark):
    out = query2.top_vaults(fails(spark, {1000: 1, 1001: 4}), DAY).collect()
    assert sorted((r.rank, r.vault_id) for r in out) == [(1, 1001), (2, 1000)]


def test_details_count_matches_disks(spark):
    """Property 2 of the stored results: failures = number of listed disks."""
    out = query2.top_vault_details(fails(spark, {1000: 3, 1001: 1}), DAY).collect()
    for r in out:
        assert r.disk_details.count("[model=") == r.failures
    top = [r for r in out if r.vault_id == 1000][0]
    assert top.disk_details == ", ".join(f"[model='M1000', serialNumber='S1000-{i}']" for i in range(3))


def test_ranking_line_and_wide(spark):
    df = fails(spark, {1000: 2, 1001: 1})
    (line,) = query2.ranking_lines(df, DAY).collect()
    assert line.ts == "2023-04-01 00:00:00" and line.ts_end == "2023-04-02 00:00:00"
    assert line.line.startswith("2023-04-01 00:00:00, , 1000, 2 ([model='M1000', serialNumber='S1000-0'], ")
    assert line.line.endswith(", 1001, 1 ([model='M1001', serialNumber='S1001-0'])")
    (wide,) = query2.wide_ranking(df, DAY).collect()
    assert wide.vault_id1 == 1000 and wide.failures2 == 1 and wide.vault_id3 is None


def test_disks_long_form(spark):
    out = query2.top_vault_disks(fails(spark, {1000: 2}), DAY).collect()
    assert len(out) == 2 and {r.serial_number for r in out} == {"S1000-0", "S1000-1"}


def test_disk_arrays_structured_form(spark):
    from vaultscope.schema import Q2_OUTPUT

    out = query2.top_vault_disk_arrays(fails(spark, {1000: 2, 1001: 1}), DAY)
    assert out.schema.simpleString() == Q2_OUTPUT.simpleString()
    top = out.where("rank = 1").first()
    assert top.vault_id == 1000 and [d.serial_number for d in top.disks] == ["S1000-0", "S1000-1"]
