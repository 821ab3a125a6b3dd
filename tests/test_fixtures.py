"""Literal pages, files and answers against the rows that they must give."""

import fixture_queries
import pytest
from pyspark import cloudpickle

# Workers do not find the modules of this folder.
cloudpickle.register_pickle_by_value(fixture_queries)


@pytest.mark.parametrize("name", sorted(fixture_queries.QUERIES))
def test_case(spark, name):
    found = fixture_queries.QUERIES[name](spark, "")
    order = lambda rows: sorted(rows, key=lambda r: [str(r[c]) for c in sorted(r)])
    assert order([r.asDict() for r in found.collect()]) == order(fixture_queries.EXPECTED[name])
