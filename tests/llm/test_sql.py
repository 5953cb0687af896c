"""Corpus queries against their SQL, over the whole smallest tables."""

from __future__ import annotations

import pytest

from tests.compare import database, difference
from tunetables.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_corpus_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), database(FOLDER).sql(ORACLES[name])) is None
