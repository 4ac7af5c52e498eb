"""Every registered query against its SQL twin, on whole tables."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from casewise.plans import REGISTRY
from checking import differences, plan

SQL = {name: query.sql for name, query in REGISTRY.items() if query.sql}
BUILD = queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, sf_dir, connection):
    df = BUILD[name](spark, sf_dir)
    text = plan(df)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert name == "batch_score" or not re.search(r"Python|MapInPandas|ArrowEval", text)
    assert differences(df, connection, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(oracle_sql()) <= set(BUILD)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
