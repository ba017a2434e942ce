"""Physical-plan properties the scale design depends on (checked with AQE off, as planned)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF001


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _count(plan, pat):
    return len(re.findall(pat, plan))


def test_bm25_moves_matching_tokens_once(spark):
    p = _plan(spark, "rank_bm25")
    # the filtered counts move by document; statistics read the same exchange, scores need no other
    moved = [x for x in p.splitlines() if "Exchange hashpartitioning(doc_id" in x]
    assert len([x for x in moved if "ReusedExchange" not in x]) == 1
    assert "ReusedExchange" in p and "WindowGroupLimit" in p and "ObjectHashAggregate" not in p


@pytest.mark.parametrize("name", ["build_tf_postings", "build_postings", "build_positional", "token_positions"])
def test_document_indexes_need_no_exchange(spark, name):
    assert _count(_plan(spark, name), r"Exchange hashpartitioning") == 0


@pytest.mark.parametrize("name", ["eval_ndcg", "eval_precision_at_k"])
def test_top_ten_metrics_rank_partially(spark, name):
    p = _plan(spark, name)
    assert "WindowGroupLimit" in p and "rangepartitioning" not in p


def test_features_take_few_exchanges(spark):
    assert _count(_plan(spark, "ltr_features"), r"Exchange hashpartitioning") <= 5


def test_exact_knn_emits_no_pair_rows(spark):
    p = _plan(spark, "vec_exact_knn")
    assert "MapInPandas" in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_sampled_vocabulary_is_a_filter_not_a_join(spark):
    p = _plan(spark, "bulk_query_workload")
    assert "md5" in p and "BroadcastNestedLoopJoin" not in p


def test_boolean_plans_scan_once_and_move_no_text(spark):
    import __spark_entry__ as E
    from conftest import SF001

    for name in ("bool_and", "bool_or", "bool_and_not", "bool_nested", "or_with_tf", "and_with_positions", "bool_query"):
        plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
        assert len(scans) == 1, name
