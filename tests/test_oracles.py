"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from flotilla.plans import oracles, queries as Q
from tests.oracle import compare, duckdb_con

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracles.build()


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF)


def test_every_query_has_an_oracle():
    assert set(Q.ALL) == set(SQL)
    assert set(SQL) <= set(E.oracle_sql()) and set(Q.ALL) <= set(E.queries())


def test_oracles_import_nothing_that_they_check():
    import ast
    tree = ast.parse(open(oracles.__file__).read())
    names = {getattr(n, "module", "") or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)} | \
        {a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names}
    assert not any(n.startswith("flotilla") for n in names)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    problems = compare(spark, name, E.queries()[name], SQL[name], SF, con, verbose=False)
    assert not problems, problems


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "placa_vehiculo" and df.count() >= 0
