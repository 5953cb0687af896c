"""Every registered query against its SQL, over the whole smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from catalog import ORACLES, QUERIES
from tests.compare import database, difference

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {
    "f04_rouge_l",
    "f05_rouge_lsum",
    "f08_short_scores",
}


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, FOLDER), db.sql(ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_other_queries_return_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).collect()


def test_registry_is_complete():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["idx", "prompt", "chosen", "rejected"]
    # the corpus operators add theirs where they are installed
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()
