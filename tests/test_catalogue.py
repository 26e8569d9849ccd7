"""Every registered query against its SQL on the smallest test set."""

import re

import pytest

import __spark_entry__ as catalogue
from compare import differences, duck

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_equals_sql(spark, con, sf_dir, name):
    rows, difference = differences(spark, con, sf_dir, QUERIES[name], SQL.get(name))
    assert difference == ""
    assert rows > 0


def test_each_query_has_sql():
    """Numbered operators and the pipeline may go without; these are tested by brute force."""
    assert set(SQL) <= set(QUERIES)
    assert all(n in SQL or re.match(r"op\d+_|pipeline$", n) for n in QUERIES)


def test_entry(spark):
    assert catalogue.entry(spark).columns == ["query_id", "n_retrieved", "precision_at_k", "recall_at_k"]
