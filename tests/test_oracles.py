"""Every query of the library that SQL can express, against DuckDB over the same tables."""

import os

import duckdb
import pytest

from webloom.plans import catalog


def printable(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([printable(x) for x in value])
    if isinstance(value, dict):
        return str({k: printable(x) for k, x in value.items()})
    return str(value)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_its_oracle(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    found = sorted(tuple(printable(r[c]) for c in names) for r in df.collect())
    answer = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert found == sorted(tuple(printable(r[i]) for i in at) for r in answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_an_oracle_runs_and_repeats(spark, sf_dir, name):
    one, two = (sorted(map(str, catalog.QUERIES[name](spark, sf_dir).collect())) for _ in range(2))
    assert one == two
