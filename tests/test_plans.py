"""Scale guards on the physical plans of every registered query."""

import pytest

import __spark_entry__ as E
from conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_or_row_udf(spark, name):
    plan = physical(E.queries()[name](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_mg_plan_shape(spark):
    plan = physical(E.queries()["mg_hot_topics"](spark, SF001))
    assert "TakeOrderedAndProject" in plan and "HashAggregate" in plan
    # only the text column is read for the tokens
    from trendlens.plans.catalog import doc_tokens
    from trendlens.operators import misra_gries as mg

    explain = mg.misra_gries(doc_tokens(spark, SF001), 50)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<text:string>" in explain or "struct<text:string>" in explain


def test_verified_broadcasts_candidates(spark):
    plan = physical(E.queries()["mg_verified"](spark, SF001))
    assert "BroadcastHashJoin" in plan and "MapInArrow" in plan


def test_vocabulary_lookup_is_an_equi_join(spark):
    plan = physical(E.queries()["weighted_keywords"](spark, SF001))
    assert "BroadcastHashJoin" in plan
