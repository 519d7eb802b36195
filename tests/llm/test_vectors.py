"""Centroid clustering and learned partitions against brute force, on vectors with nulls, ties, repeats and odd shapes."""
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from lakeops.llm import centroids
from lakeops.llm import learned_partitions as parts

DIMS = 8


def schema(*extra):
    return T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                         *[T.StructField(c, T.StringType()) for c in extra]])


def odd_vectors(seed=1, n=150, whole=False):
    """Rows (id, vector): usable ones with ties, repeats and a vector that a third of them hold, then unusable ones."""
    rng = np.random.default_rng(seed)
    make = lambda: (rng.integers(-2, 3, DIMS) if whole else rng.standard_normal(DIMS).astype(np.float32)).astype(float).tolist()
    common, rows = make(), []
    for i in range(n):
        rows.append((i, common if i % 3 == 0 else make()))
    rows += [rows[7], rows[7], (8, make()), (None, make()), (None, common)]
    bad = [(1000, None), (1020, []), (1040, [float("nan")] + make()[1:]), (1060, [None] + make()[1:]), (1080, make()[:-1] + [float("inf")])]
    return rows, bad


# ------------------------------------------------------------------ 12
def brute_clusters(rows, dims, clusters, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centre = [v for _, v in named[:clusters]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(centre))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        after = []
        for k, c in enumerate(centre):
            mine = [v for (_, v), o in zip(kept, own) if o == k]
            after.append([sum(x) // len(mine) for x in zip(*mine)] if mine else c)
        centre = after
    last = [(i, *near(v)) for i, v in kept]
    total = lambda k: sum(d for _, d, o in last if k is None or o == k)
    return sorted((i is None, i or 0, k, d, total(k), total(None), hashlib.sha256(",".join(map(str, centre[k])).encode()).hexdigest())
                  for i, d, k in last)


@pytest.mark.parametrize("clusters,rounds,n", [(40, 5, 150), (5, 3, 150), (500, 2, 40), (1, 1, 10)])
def test_clusters(spark, clusters, rounds, n):
    good, bad = odd_vectors(n=n)
    rows = good + bad + [(2000, [1.0] * (DIMS - 1)), (2001, [0.0] * DIMS)]
    names = ["cluster", "distance", "v", "row", "id", "x", "near", "a.b", "__none"]
    df = spark.createDataFrame([(*r, *names) for r in rows], schema(*names)).repartition(4)
    out = centroids.cluster(df, dims=DIMS, clusters=clusters, rounds=rounds)
    got = out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted((r[0] is None, r[0] or 0, *r[1:]) for r in got) == brute_clusters(rows, DIMS, clusters, rounds)
    assert [c for c in out.columns if out.columns.count(c) > 1] == []
    kept = out.select("v", "row", "`a.b`", "__none").distinct().collect()
    assert [tuple(r) for r in kept] == [("v", "row", "a.b", "__none")]


def test_no_clusters(spark):
    df = spark.createDataFrame([], schema("a.b"))
    assert centroids.cluster(df).collect() == []
    only_bad = spark.createDataFrame(odd_vectors()[1], schema())
    assert centroids.cluster(only_bad, dims=DIMS).collect() == []


def test_clusters_without_python_workers(spark):
    df = spark.createDataFrame(odd_vectors()[0], schema())
    near = centroids.whole_vectors(df, dims=DIMS).select(centroids.nearest([[0] * DIMS, [256] * DIMS]).alias("near"), "v")
    plan = near.groupBy("near.cluster").sum()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_a_component_beyond_64_bits_is_an_error(spark):
    rows = [(0, [1e30] * DIMS), (1, [-1e30] * DIMS)]
    with pytest.raises(Exception, match="(?i)overflow"):
        centroids.cluster(spark.createDataFrame(rows, schema()), dims=DIMS, clusters=2).collect()


# ------------------------------------------------------------------ 13
def brute_neighbours(rows, every, top):
    """(query, rank) -> (id, score); whole numbers, so scores are exact. Rows of one id and vector are one."""
    use = {(i, tuple(v)) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in use:
        if i is not None and i % every == 0:
            near = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in use if j != i))
            out += [(i, k + 1, None if none else j, -s) for k, (s, none, j) in enumerate(near[:top])]
    return sorted(out, key=str)


def answers(df, **how):
    index = parts.Index(df, recall=2.0, **how)
    return index, sorted((tuple(r) for r in index.search().select("query_id", "rank", "vec_id", "score").collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"leaf": 16, "block": 7}, {"leaf": 30, "sample": 40, "every": 5, "top": 3}, {"leaf": 16, "router_bytes": 5_000}])
def test_every_leaf_gives_the_true_neighbours(spark, how):
    good, bad = odd_vectors(whole=True)
    rows = good + bad + [(2000, [0.0] * DIMS), (2020, [2.0, 1.0]), (2021, [1.0])]
    names = ["key", "x", "low", "leaf", "a.b"]
    df = spark.createDataFrame([(*r, *names) for r in rows], schema(*names)).repartition(4)
    index, got = answers(df, **how)
    assert got == brute_neighbours(rows, how.get("every", 20), how.get("top", 20))
    assert sum(index.counts.values()) == len({tuple(v) for _, v in good} | {(2.0, 1.0), (1.0,)})
    if how:
        assert len(index.tree) >= 1 and len(index.counts) > 1


def test_few_rows_and_none(spark):
    empty = spark.createDataFrame([], schema())
    assert parts.search(empty).collect() == []
    assert parts.search(spark.createDataFrame(odd_vectors()[1], schema())).collect() == []
    none_ask = spark.createDataFrame([(1, [1.0] * 3), (2, [2.0] * 3)], schema())
    assert parts.search(none_ask).collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 2.0])], schema())
    assert sorted(tuple(r) for r in parts.search(two).collect()) == [(0, 1, 20, 1.0), (20, 1, 0, 1.0)]
    alone = spark.createDataFrame([(0, [1.0, 0.0])], schema())
    assert parts.search(alone).collect() == []
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(100)], schema())
    got = sorted(tuple(r)[:3] for r in parts.search(same, top=3).collect())
    assert got == [(q, k + 1, v) for q in range(0, 100, 20) for k, v in enumerate([x for x in range(5) if x != q][:3])]


def test_recall_is_reached_with_few_leaves_on_clustered_vectors(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((60, 16))
    x = (centre[rng.integers(0, 60, 6_000)] + 0.35 * rng.standard_normal((6_000, 16))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], schema()).repartition(6)
    index = parts.Index(df, leaf=100)
    found = index.search()
    assert len(index.counts) >= 32 and index.share <= 1 / 3
    assert max(index.counts.values()) <= 400
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, 6_000, 20):
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score)[:20].tolist()))
    assert hits / (300 * 20) >= 0.9


def test_another_level_stays_only_if_it_pays(spark):
    rng = np.random.default_rng(4)
    noise = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((3_000, 32)).astype(np.float32))], schema())
    index = parts.Index(noise, leaf=20, sample=500)
    assert len(index.counts) <= parts.PARTS and set(index.tree) == {parts.ROOT}
    centre = 3 * rng.standard_normal((600, 16))
    x = (centre[rng.integers(0, 600, 6_000)] + 0.1 * rng.standard_normal((6_000, 16))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    groups = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], schema()).repartition(6)
    assert len(parts.Index(groups, leaf=20, top=5).tree) > 1


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(3)
    x = np.repeat(np.eye(8) * 3, 50, axis=0) + 0.3 * rng.standard_normal((400, 8))
    a, b = parts.graph(x.astype(np.float32))
    label = parts.balanced(len(x), a, b, 8)
    assert np.bincount(label, minlength=8).max() <= 1.05 * 50 + 1
    assert (label[a] == label[b]).mean() > 0.9
