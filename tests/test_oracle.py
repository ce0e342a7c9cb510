"""Every registered query against its DuckDB SQL on the driver tables."""

import os

import pytest

from tools.check_oracle import TABLES, digest

SF_DIR = os.environ.get("RAWLINE_TEST_SF", "/root/testdata/sf0.01")

import __spark_entry__ as E  # noqa: E402

from rawline.plans import queries as own  # noqa: E402

NAMES = sorted(own.queries())  # the optional subpackage has its own tests


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_DIR)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
