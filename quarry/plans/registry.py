"""Name -> (spark, sf_dir) -> DataFrame registry, plus the equivalent SQL for the oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = [
    "quarry.plans.text_plans",
    "quarry.plans.match_plans",
    "quarry.plans.rank_plans",
    "quarry.plans.eval_plans",
    "quarry.plans.ltr_plans",
    "quarry.plans.vector_plans",
    "quarry.plans.lifecycle_plans",
    "quarry.plans.shard_plans",
]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)
