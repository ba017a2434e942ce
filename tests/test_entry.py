"""Driver contract: entry runs, every registered query runs at sf0.001, oracle keys exist."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF001

BASE = sorted(n for n in E.queries() if not n.startswith("op") or not n[2].isdigit())
EMPTY_OK = {"hash_sample"}  # a 1 % sample of 200 rows can be empty


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


@pytest.mark.parametrize("name", [n for n in BASE if n != "pipeline"])
def test_query_runs(spark, name, monkeypatch):
    """Every query gives rows (the rankers with few rounds here; ``test_lambdamart`` tests the rounds)."""
    from quarry.plans import ltr_plans

    monkeypatch.setattr(ltr_plans, "ROUNDS", 3)
    df = E.queries()[name](spark, SF001)
    rows = df.collect()
    assert rows or name in EMPTY_OK
    assert len(df.columns) == len(set(df.columns))
    if name.startswith("ltr_rank") or name.endswith(("rerank", "reduced")):
        assert rows[0].n_queries > 0 and 0 < rows[0].mean_ndcg <= 1


def test_porter_postings_cover_the_corpus(spark):
    """The stemmed postings hold as many occurrences as the lower-cased tokens."""
    q = E.queries()
    total = q["token_count"](spark, SF001).agg({"len": "sum"}).first()[0]
    assert q["flt_porter_stem"](spark, SF001).agg({"tf": "sum"}).first()[0] == total


def test_sample_is_a_small_share(spark):
    from quarry.sources.tables import read_table

    docs = read_table(spark, SF001, "documents")
    assert E.queries()["sample_rows"](spark, SF001).join(docs, "doc_id", "left_anti").count() == 0
