"""Every query with an oracle against DuckDB, the others for shape; plans without cross joins."""

import pytest
from oracle import compare

from orderlens.plans.catalogue import all_queries

REGISTRY = all_queries()
CHECKED = [n for n, e in REGISTRY.items() if e.sql is not None]
# Fits of several models; each is exercised by its own test below.
PLANS = ["order_features", "threshold_sweep", "roc_auc", "lexical_topk", "vector_topk",
         "nearest_exemplar", "catalog_questions", "confusion_matrix", "conversation_state",
         "carry_forward", "retrieval_scores", "permutation_importance", "order_lookup",
         "policy_answers", "missingness_by_group", "subgroup_thresholds", "preprocess_matrix"]


@pytest.mark.parametrize("name", CHECKED)
def test_matches_oracle(spark, sf, con, name):
    verdict, note = compare(spark, con, REGISTRY[name], sf)
    assert verdict == "ok", note


@pytest.mark.parametrize("name", PLANS)
def test_plan_has_no_cross_join(spark, sf, name):
    plan = REGISTRY[name].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = REGISTRY["catalog_filter"].run(spark, sf)._jdf.queryExecution().toString()
    assert "l_" not in plan
    history = REGISTRY["missingness_by_group"].run(spark, sf)
    text = history._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in text


def test_top_rows_per_class_are_pruned_before_the_shuffle(spark, sf):
    plan = REGISTRY["first_per_class"].run(spark, sf)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")
