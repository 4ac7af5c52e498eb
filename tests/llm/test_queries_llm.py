"""The registered queries against their SQL, whole tables."""

import pytest

from casewise.llm.queries import QUERIES
from checking import differences, plan


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_sql(name, spark, sf_dir, connection):
    df = QUERIES[name].build(spark, sf_dir)
    assert "CartesianProduct" not in plan(df)
    assert "BroadcastNestedLoopJoin" not in plan(df)
    assert differences(df, connection, QUERIES[name].sql) == []


def test_quality_is_native(spark, sf_dir):
    text = plan(QUERIES["op9_quality_divergence"].build(spark, sf_dir))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))
