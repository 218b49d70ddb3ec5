import compare
import pytest

from trailhead.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    assert compare.same(spark, name, QUERIES[name], ORACLE[name], "/root/testdata/sf0.01")
