"""Centroid clustering over whole numbers, in built-in expressions only.

A vector is assigned by ``zip_with`` and ``aggregate`` over the centroids, which stand in the plan as literal arrays;
``array_min`` of (distance, number) picks the nearest, the smaller number at a tie. A round sums the components of every
cluster column by column (partial sums in the tasks, one row per cluster and task in the shuffle), so a cluster that holds
most vectors is no heavier than another. The driver holds the centroids alone: ``clusters`` rows of ``dims`` numbers.
Rounds read the input anew instead of keeping copies of it; the last assignment, three numbers a vector, is written once.

Defined cases: a vector that is null, has another number of components, or holds a null or non-finite one is left out.
Starts are ordered by hash, then by vector, rows without an id last; fewer vectors than clusters make fewer clusters.
Repeated rows are clustered each; equal starts leave the later one empty, and an empty centroid stays. No vectors: no rows.
Numbers are 64 bits wide: a component beyond them, or a sum or distance beyond them, raises Spark's arithmetic error.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import cut, without

DIMS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256


def whole_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """The rows with a full, finite vector: ``row`` (all columns), ``id`` and ``v``, its components times ``scale``, rounded down."""
    inside = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").alias("x"))
    # NaN stands above infinity in Spark's order, so one comparison rules out both
    finite = F.forall("x", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return inside.where((F.size("x") == dims) & finite).select(
        "row", "id", F.transform("x", lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))


def starts(vectors: DataFrame, clusters: int = CLUSTERS, salt: str = "2:") -> list[list[int]]:
    """The vectors with the smallest hashes of their ids."""
    named = vectors.select(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("h"), "v")
    return [r["v"] for r in named.orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters).collect()]


def nearest(centroids: Sequence[Sequence[int]]) -> Column:
    """Squared distance and number of the centroid nearest to ``v``."""
    literal = ", ".join(f"array({', '.join(f'{x}L' for x in c)})" for c in centroids)
    return F.expr(f"""array_min(transform(array({literal}), (c, number) -> struct(
        aggregate(zip_with(v, c, (x, y) -> (x - y) * (x - y)), 0L, (total, d) -> total + d) AS distance, number AS cluster)))""")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid at the mean of its vectors, rounded down."""
    own = vectors.select(nearest(centroids).alias("near"), "v")
    sums = own.groupBy("near.cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))])
    after = list(centroids)
    for row in sums.collect():                    # a row per cluster
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(len(centroids[0]))]
    return after


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> list[list[int]]:
    centroids = starts(vectors, clusters)
    for _ in range(rounds if centroids else 0):
        after = moved(vectors, centroids)
        if after == centroids:                    # further rounds change nothing
            break
        centroids = after
    return centroids


SUMMARY = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
                        T.StructField("inertia", T.LongType()), T.StructField("centroid", T.ArrayType(T.LongType())),
                        T.StructField("centroid_sha256", T.StringType())])


def cluster(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = DIMS, clusters: int = CLUSTERS,
            rounds: int = ROUNDS, keep: Sequence[str] | None = None) -> DataFrame:
    """Every row with a full vector (its columns ``keep``, or all), its cluster, distance, the sums of distances, and the centroid (array and digest).

    A column of the input of the same name as one of these is replaced.
    """
    vectors = whole_vectors(df, vec_id, vector, dims)
    centroids = fit(vectors, clusters, rounds)
    names = [c for c in without(df, ["distance", *SUMMARY.names]) if keep is None or c in keep]
    held_back = F.struct(F.lit(0).alias("c"), *[F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    near = nearest(centroids or [[0] * dims])     # without vectors there is no row to assign
    assigned = cut(vectors.select(held_back.alias("row"), near.alias("near"))).select("row", "near.cluster", "near.distance")
    held = {r["cluster"]: r["n"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    rows = [(i, held.get(i, 0), sum(held.values()), c, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids)]
    # a row per centroid
    return assigned.join(F.broadcast(df.sparkSession.createDataFrame(rows, SUMMARY)), "cluster").select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], "cluster", "distance", *SUMMARY.names[1:])
