"""Every registered query of the text-analytics engine against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from sparkloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(x) for x in r) for r in df.select(*cols).collect()), key=repr)
    rel = duck.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == cols
    want = sorted((tuple(norm(x) for x in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert df.columns and len(df.collect()) > 0 or name == "html_page_comments"
