"""Plans: what reaches the scan, what shuffles, and what must never appear."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakeops.operators.windows import latest_wins, top_n
from lakeops.plans import inspect
from lakeops.session import load_table

SF = "/root/testdata/sf0.01"
QUERIES = entry.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("PythonUDF", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "FlatMapCoGroups")


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pair_joins_and_no_python(name, spark):
    text = inspect.plan_text(QUERIES[name](spark, SF), "simple")
    # the library works in built-in expressions; the training-data operators state their style each
    words = FORBIDDEN + (() if name.startswith("op") or name == "pipeline" else PYTHON)
    assert [w for w in words if w in text] == []


def test_filter_and_columns_reach_the_scan(spark):
    df = QUERIES["J8_fact_dim_chain"](spark, SF)
    assert any("GreaterThanOrEqual(l_shipdate" in f for f in inspect.pushed_filters(df))
    fact = [s for s in inspect.read_schemas(df) if "l_orderkey" in s]
    assert fact and "l_tax" not in fact[0] and "l_discount" not in fact[0]


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    li = load_table(spark, SF, "lineitem")
    one = latest_wins(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()])
    three = top_n(li, ["l_suppkey"], [F.col("l_quantity").desc()], 3)
    for df in (one, three):
        text = inspect.plan_text(df, "simple")
        assert text.count("WindowGroupLimit") == 2 and inspect.count_shuffles(df) == 1


def test_windowed_sums_cost_one_shuffle(spark):
    assert inspect.count_shuffles(QUERIES["A10_windowed_sums"](spark, SF)) == 1


def test_no_sketch_per_distinct_value(spark):
    text = inspect.plan_text(QUERIES["A4_approx_distinct"](spark, SF), "simple")
    keyed = [line for line in text.splitlines() if "Aggregate(key" in line.replace("keys", "key")]
    assert len(keyed) >= 4
    assert not [line for line in keyed if "l_partkey" in line.split("functions=")[0] and "approx_count_distinct" in line]


def test_sessions_and_runs_shuffle_once(spark):
    for name in ("W12_sessions", "W16_out_of_range_runs"):
        assert inspect.count_shuffles(QUERIES[name](spark, SF)) <= 2


def test_limit_does_not_sort_globally(spark):
    text = inspect.plan_text(QUERIES["O3_top_k"](spark, SF), "simple")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
    assert "rangepartitioning" in inspect.plan_text(QUERIES["O1_global_sort"](spark, SF), "simple")
    li = load_table(spark, SF, "lineitem")
    assert inspect.count_shuffles(li.sortWithinPartitions("l_quantity")) == 0
