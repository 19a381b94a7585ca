"""Every query against its expected result in SQL."""

import pytest
from compare import differences

from fixtures.queries import EXPECTED, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, small, name):
    df = QUERIES[name](spark, small)
    assert name in EXPECTED
    assert differences(df, oracle, EXPECTED[name]) is None
