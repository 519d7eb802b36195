"""Reading physical plans: shuffles, join strategies, pushed filters."""
from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame, SparkSession

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def count_shuffles(df: DataFrame) -> int:
    """Exchanges in the plan before adaptive execution; broadcasts and reuse are not counted."""
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)\bExchange\b", plan_text(df, "simple")))


def join_strategies(df: DataFrame) -> list[str]:
    found = re.findall("|".join(JOINS), plan_text(df, "simple"))
    return found


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Temporarily change one session setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
