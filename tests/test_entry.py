"""Driver contract: entry(), queries() and oracle_sql(); every oracle is
compared with its Spark query on the smallest tables."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROWS_ONLY = set()


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["ts", "vault_id", "count", "mean_s194", "stddev_s194"]
    assert df.count() > 0


def test_every_query_has_an_oracle_unless_rows_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    # the training-data queries (op..., pipeline) are tested beside their operators
    assert {x for x in set(q) - set(o) if not x.startswith("op") and x != "pipeline"} == ROWS_ONLY


def test_entry_without_the_training_data_queries():
    """Where vaultscope/llm and corpus_pipeline.py are absent, the other queries stay."""
    code = (
        "import sys\n"
        "class Absent:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('vaultscope.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Absent())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
        "assert not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(entry.__file__)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle_matches(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    rel = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(ocols)
    s = sorted((tuple(_norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect()), key=repr)
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    o = sorted((tuple(_norm(r[i]) for i in oi) for r in rel.fetchall()), key=repr)
    assert s == o
