"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import os
import subprocess
import sys

import duckdb
import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E  # noqa: E402
from tillflow.plans.catalog import QUERIES  # noqa: E402
from tools.check_oracle import TABLES, digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_vocabularies():
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as E; "
            "print(*sorted(E.queries())); print(*sorted(E.oracle_sql()))")
    root = os.path.dirname(os.path.abspath(E.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=60, check=True)
    assert [line.split() for line in out.stdout.splitlines()] == [sorted(QUERIES)] * 2


def test_oracle_takes_nothing_from_the_engine():
    import tillflow.plans.oracle as oracle
    with open(oracle.__file__) as f:
        assert "import" not in f.read().replace("from __future__ import annotations", "")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "sales", "share_pct"]
    assert 0 < df.count() <= 10
