"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import run_query, run_sql, same_rows

from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    types, found = run_query(QUERIES[name](spark, sf_dir))
    expected_types, expected = run_sql(ORACLES[name], sf_dir)
    assert types == expected_types
    assert found, "an empty result checks nothing"
    assert same_rows(found, expected)
