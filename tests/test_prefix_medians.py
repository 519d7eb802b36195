"""Medians of the earlier rows for keys cut into segments, against a sorted list per row."""
import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import scans as S
from lakeops.operators import windows as W

SCHEMA = "k string, t int, v decimal(12,2)"


def brute(rows):
    out, earlier = {}, {}
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        before = sorted(earlier.setdefault(k, []))
        out[k, t] = before[(len(before) + 1) // 2 - 1] if before else None
        if v is not None:
            earlier[k].append(v)
    return out


def rows_of(kind):
    from decimal import Decimal

    draw, money = random.Random(kind), lambda x: Decimal(x).quantize(Decimal("0.01"))
    value = {"spread": lambda: money(draw.randint(-10**6, 10**6)) / 100, "ties": lambda: money(draw.randint(0, 3)),
             "constant": lambda: money(7), "nulls": lambda: None if draw.random() < 0.5 else money(draw.randint(0, 50)),
             "all null": lambda: None}[kind]
    times = draw.sample(range(10_000), 700)
    keys = ["hot"] * 500 + [None] * 150 + ["cold"] * 50
    return [(k, t, value()) for k, t in zip(keys, times)]


@pytest.mark.parametrize("kind", ["spread", "ties", "constant", "nulls", "all null"])
def test_cut_keys_equal_sorted_lists(spark, kind):
    rows = rows_of(kind)
    df = spark.createDataFrame(rows, SCHEMA)
    hot = S.find_hot(df, ["k"], F.col("t"), 60)
    assert hot
    out = W.trailing_median(df, ["k"], ["t"], "v", "m", hot, F.col("t"), 60)
    assert out.columns == ["k", "t", "v", "m"]
    got = {(r["k"], r["t"]): r["m"] for r in out.collect()}
    assert got == brute(rows) and len(got) == len(rows)


def test_one_key_for_the_whole_table(spark):
    rows = [(None, t, v) for _, t, v in rows_of("spread")]
    df = spark.createDataFrame(rows, SCHEMA)
    hot = S.find_hot(df, [], F.col("t"), 100)
    out = W.trailing_median(df, [], ["t"], "v", "m", hot, F.col("t"), 100)
    assert {(r["k"], r["t"]): r["m"] for r in out.collect()} == brute(rows)


def test_a_name_with_the_words_of_an_order(spark):
    name = "p DESC NULLS LAST"
    df = spark.createDataFrame([(1, i, None if i % 4 == 0 else i) for i in range(60)], ["k", "id", name])
    hot = S.find_hot(df, ["k"], F.col(f"`{name}`"), 10)
    assert hot
    order = [F.col(f"`{name}`"), F.col("id")]
    said = S.scan(df, ["k"], order, [S.row_number("n")], hot, F.col(f"`{name}`"), nulls_behind=False)
    in_order = S.scan(df, ["k"], [F.col(f"`{name}`").asc(), F.col("id")], [S.row_number("n")], hot, F.col(f"`{name}`"))
    want = {i: n for n, i in enumerate(sorted(range(60), key=lambda i: (i % 4 != 0, i)), 1)}
    for out in (said, in_order):
        assert {r["id"]: r["n"] for r in out.collect()} == want
