"""Every registered query equals its DuckDB oracle (row multiset, column names) on sf0.001."""

import pytest

import __spark_entry__ as E
from tools.check_oracles import rows_of, TABLES
from vaultkit.plans.oracle import ORACLES, sql
from vaultkit.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_oracles_state_their_values_themselves():
    import ast
    import pathlib
    import vaultkit.plans.oracle as module
    tree = ast.parse(pathlib.Path(module.__file__).read_text())
    found = {n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)}
    assert {m for m in found if m.startswith("vaultkit")} == {"vaultkit.plans.oracle_values"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    scols = [c.lower() for c in df.columns]
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(sql(name))
    dcols = [c.lower() for c in rel.columns]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hashkey", "action", "dataset_product_id"]
    assert df.count() > 0
