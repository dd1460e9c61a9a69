"""The driver contract: entry() runs; every registered query matches its
oracle SQL on DuckDB at sf0.001 (row count, column names, value hash)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from synthtext.plans import registry as R
from tools.oracle_check import TABLES, digest


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["lang", "unique_tokens", "total_tokens", "unique_ratio", "entropy"]
    assert len(rows) >= 1


def test_every_query_has_an_oracle():
    missing = set(R.queries()) - set(R.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(R.queries()))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    sdf = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = [tuple(r) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(R.queries()))
def test_query_types_match_oracle(spark, duck, sf_dir, name):
    st = dict(E.queries()[name](spark, sf_dir).dtypes)
    rel = duck.sql(E.oracle_sql()[name])
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in st.items()} == dt
