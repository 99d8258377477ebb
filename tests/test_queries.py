"""Every gazette query against its SQL on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from diurna.plans import queries as q  # noqa: E402

SF = os.environ.get("DIURNA_TEST_DATA", "/root/testdata/sf0.001")
TABLES = ["documents", "pages", "nation", "customer", "lineitem"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(None if x != x else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, sql, name):
    got = q.QUERIES[name](spark, SF)
    rows = got.collect()
    if name not in q.ORACLE_SQL:
        assert rows
        return
    want = sql.execute(f"select {', '.join(f'"{c}"' for c in got.columns)} from ({q.ORACLE_SQL[name]})").fetchall()
    assert plain(map(tuple, rows)) == plain(want)


def test_spans_share_one_window(spark):
    from diurna.operators import index as ix
    from diurna.plans.views import notes_view

    df = ix.next_titled(ix.page_spans(notes_view(spark, SF)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
