"""Driver contract and plan hygiene of every registered query."""

import pytest

import __spark_entry__ as E
from strata.plans.queries import REGISTRY

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["account_id", "customer_id", "original_balance_amount", "interest_rate_pct",
                          "annual_interest_amount", "new_balance_amount", "calculated_at"]


def test_every_query_has_oracle_sql():
    q, o = E.queries(), E.oracle_sql()
    assert set(REGISTRY) <= set(q) and set(REGISTRY) <= set(o) <= set(q)
    assert len(REGISTRY) >= 70


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_hygiene(spark, sf, name):
    """No Python UDF, no Cartesian product, no nested-loop join; scans read
    only the columns they need."""
    df = REGISTRY[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    # no query needs every column of lineitem (11) or orders (6)
    for line in plan.split("\n"):
        for table, width in (("lineitem.parquet", 11), ("orders.parquet", 6)):
            if table in line and "ReadSchema: struct<" in line:
                cols = line.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
                assert cols.count(":") < width, f"{name}: reads all of {table}"


def test_flagship_prunes_columns_and_pushes_filters(spark, sf):
    from strata.plans import queries as Q
    df = Q.REGISTRY["incremental_watermark"](spark, sf)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in text
