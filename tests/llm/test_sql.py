import os

import duckdb
import pytest

from rawline.llm.oracle import oracle_sql
from rawline.llm.queries import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(oracle_sql()[name])
    got = queries()[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_decontamination_sql_on_reordered_items(spark, tmp_path):
    """Documents that hold an item's parts in another order, or a part of it twice."""
    import random

    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.sample(words, 40 + 7 * i))) for i in range(8)]
    docs = []
    for i, text in items:
        w = text.split()
        for turn in (0, 3, 11, len(w) // 2):
            docs.append((len(docs), " ".join([*rng.sample(words, 12), *w[turn:], *w[:turn], *rng.sample(words, 9)])))
        docs.append((len(docs), " ".join(w + w)))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.sql(oracle_sql()["op5_decontamination"])
    got = sorted(map(tuple, queries()["op5_decontamination"](spark, str(tmp_path)).select(*want.columns).collect()))
    assert got == sorted(want.fetchall())
    assert len(got) > 24


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())
