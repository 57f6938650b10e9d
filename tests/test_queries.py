from __future__ import annotations

import pytest

import __spark_entry__
from docmeter.plans.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small, compare, name):
    compare(QUERIES[name](spark, small), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scans_are_pruned(spark, small, capsys):
    QUERIES["jobs_older_than"](spark, small).explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThan(o_orderdate" in plan and "o_totalprice" not in plan.split("ReadSchema:")[1].split("\n")[0]
