"""The operators' queries that SQL can express, against DuckDB over the same tables."""

import pytest

from tests.test_oracles import duck, printable  # noqa: F401
from webloom.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_its_oracle(spark, sf_dir, duck, name):  # noqa: F811
    df = catalog.QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    answer = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert sorted(tuple(printable(r[c]) for c in names) for r in df.collect()) == sorted(tuple(printable(r[i]) for i in at) for r in answer.fetchall())
