"""Population stability index per feature between a baseline and a later population."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.scans import MAX_GROUP_ROWS, exact_percentiles

# Fixed values of the measure.
BINS = 10
EPSILON = 1e-6
MIN_ROWS = 100
DRIFTED = 0.25
MODERATE = 0.10


def _long(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(cast).alias("v")) for c in columns])
    return df.select(F.inline(pairs))


def _index(cells: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Index from one row per feature and bin with counts ``e``, ``a`` and totals ``en``, ``an``."""
    pct = lambda n, total: F.greatest(F.col(n) / F.col(total).cast("double"), F.lit(EPSILON))
    e, a = pct("e", "en"), pct("a", "an")
    return cells.groupBy("feature", "en", "an", *keep).agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


def frozen_edges(base: DataFrame, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Inner bin edges per feature from the baseline's deciles.

    Eleven numbers per feature: computed once and held, because both populations
    are binned with them.
    """
    points = {f"q{i}": i / BINS for i in range(BINS + 1)}
    quantiles = exact_percentiles(base, ["feature"], "v", points, max_rows)
    edges = quantiles.select("feature", F.array_sort(F.array_distinct(F.array(*points))).alias("edges")).select(
        "feature", F.size("edges").alias("n_edges"),
        F.when(F.size("edges") >= 3, F.slice("edges", F.lit(2), F.size("edges") - 2))
        .otherwise(F.array().cast("array<double>")).alias("inner"))
    return base.sparkSession.createDataFrame(edges.collect(), edges.schema)


def numeric_psi(baseline: DataFrame, today: DataFrame, columns: Sequence[str],
                max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Bins are the baseline's deciles, frozen; equal edges collapse and the outer bins are open.

    Fewer than 100 values on a side give NULL, fewer than three distinct edges give 0.
    """
    base, now = (_long(df, columns, "double").where(F.col("v").isNotNull()) for df in (baseline, today))
    edges = frozen_edges(base, max_rows)

    # both populations are binned and counted together: one broadcast of the edges, one shuffle of cells
    stacked = base.withColumn("old", F.lit(1)).unionByName(now.withColumn("old", F.lit(0)))
    counted = stacked.join(F.broadcast(edges), "feature").groupBy(
        "feature", F.size(F.filter("inner", lambda x: x <= F.col("v"))).alias("bin")).agg(
        F.sum("old").alias("e"), F.sum(1 - F.col("old")).alias("a"))
    every = edges.select("feature", "n_edges", F.explode(F.sequence(F.lit(0), F.size("inner"))).alias("bin"))
    cells = every.join(counted, ["feature", "bin"], "left").na.fill(0, ["e", "a"])
    # a feature has at most BINS cells
    feature = Window.partitionBy("feature")
    scored = _index(cells.withColumns({"en": F.sum("e").over(feature), "an": F.sum("a").over(feature)}), ["n_edges"])
    psi = F.when((F.col("en") >= MIN_ROWS) & (F.col("an") >= MIN_ROWS),
                 F.when(F.col("n_edges") < 3, F.lit(0.0)).otherwise(F.col("psi")))
    return scored.select("feature", F.lit("numeric").alias("kind"), psi.alias("psi"))


def categorical_psi(baseline: DataFrame, today: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Over the union of categories; NULL is a category of its own."""
    def side(df: DataFrame, e: int) -> DataFrame:
        return _long(df, columns, "string").groupBy("feature", F.coalesce("v", F.lit("__NULL__")).alias("bin")).agg(
            F.count("*").alias("n")).select("feature", "bin", (F.col("n") * e).alias("e"), (F.col("n") * (1 - e)).alias("a"))

    cells = side(baseline, 1).unionByName(side(today, 0)).groupBy("feature", "bin").agg(
        F.sum("e").alias("e"), F.sum("a").alias("a"))
    totals = cells.groupBy("feature").agg(F.sum("e").alias("en"), F.sum("a").alias("an"))
    return _index(cells.join(totals, "feature")).select("feature", F.lit("categorical").alias("kind"), "psi")


def psi(baseline: DataFrame, today: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Feature, kind, index and severity; skipped features are left out."""
    both = numeric_psi(baseline, today, numeric)
    if categorical:
        both = both.unionByName(categorical_psi(baseline, today, categorical))
    severity = (F.when(F.col("psi") > DRIFTED, "drifted").when(F.col("psi") >= MODERATE, "moderate")
                .otherwise("none"))
    return both.where(F.col("psi").isNotNull()).withColumn("severity", severity)


def headline(per_feature: DataFrame, gate: float = 0.20) -> DataFrame:
    """One row: the 90th percentile of the features' indexes, mean, maximum, and the gate's verdict.

    The input has one row per feature.
    """
    h = per_feature.agg(
        F.expr("percentile(psi, 0.9)").alias("overall_psi"), F.avg("psi").alias("mean_psi"),
        F.max("psi").alias("max_psi"), F.count("*").alias("features_compared"),
        F.count_if(F.col("psi") > DRIFTED).alias("drifted_count"))
    return h.withColumn("retrain", F.col("overall_psi") > gate)
