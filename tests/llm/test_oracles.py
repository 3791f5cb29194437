"""Every query of the package that SQL expresses, value for value."""

import pytest
from parity import connect, difference, sides

from ebbtide.llm.oracles import ORACLES
from ebbtide.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert difference(*sides(spark, connect(small), QUERIES[name], ORACLES[name], small)) is None


def test_one_query_for_each_operator():
    assert sorted(int(n.removeprefix("op").split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
