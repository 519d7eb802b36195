"""Stacking and comparing tables."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(*tables: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), tables)


def table_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed between two states with unique keys.

    Both states are stacked and grouped once, so a key on both sides meets itself
    without a full outer join.
    """
    payload = [c for c in before.columns if c not in keys]
    one = lambda df, side: df.select(*keys, F.lit(side).alias("__side"),
                                     F.struct(*[df[c] for c in payload]).alias("__row"))
    both = one(before, 0).unionByName(one(after, 1))
    folded = both.groupBy(*keys).agg(
        F.max(F.when(F.col("__side") == 0, F.struct("__row"))).alias("b"),
        F.max(F.when(F.col("__side") == 1, F.struct("__row"))).alias("a"))
    change = (F.when(F.col("b").isNull(), F.lit("added"))
              .when(F.col("a").isNull(), F.lit("removed"))
              .when(~F.col("a").eqNullSafe(F.col("b")), F.lit("changed")))
    return folded.withColumn("change", change).where("change IS NOT NULL").select(
        *keys, "change",
        *[F.col(f"b.__row.{c}").alias(f"old_{c}") for c in payload],
        *[F.col(f"a.__row.{c}").alias(f"new_{c}") for c in payload])


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows only in ``a``, only in ``b`` and in both, counting copies."""
    cols = a.columns
    tagged = a.select(*cols, F.lit(1).alias("__d")).union(b.select(*cols, F.lit(-1).alias("__d")))
    per_row = tagged.groupBy(*cols).agg(
        F.sum("__d").alias("d"), F.count_if(F.col("__d") == 1).alias("n"))
    return per_row.agg(
        F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("only_right"),
        F.coalesce(F.sum(F.least("n", F.col("n") - F.col("d"))), F.lit(0)).alias("in_both"))


# ------------------------------------------------------------------ content hashes
def content_hash(columns: Sequence[str]) -> list[Column]:
    """Aggregates that name a multiset of rows, whatever their order: ``rows`` and two sums of 64-bit row hashes.

    Two tables with the same three numbers hold the same rows, but for a chance of about one in 2**120. NULL takes part by a
    flag of its own, because the row hash passes over it.
    """
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    wide = lambda h: F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    return [F.count("*").alias("rows"), wide(F.xxhash64(*parts)).alias("h1"), wide(F.xxhash64(F.lit("second"), *parts)).alias("h2")]


def same_content(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: ``rows_left``, ``rows_right`` and ``same``. Each table is folded in its scan; a row per task is shuffled."""
    named = lambda df, side: df.agg(*content_hash(a.columns)).select(F.lit(side).alias("side"), F.struct("rows", "h1", "h2").alias("h"))
    both = named(a, 0).unionByName(named(b, 1))
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("h")))
    return both.agg(of(0).alias("l"), of(1).alias("r")).select(
        F.col("l.rows").alias("rows_left"), F.col("r.rows").alias("rows_right"), (F.col("l") == F.col("r")).alias("same"))


def changed_parts(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """The parts (values of ``by``) whose rows differ between two tables: a row per part and task is shuffled."""
    named = lambda df, side: df.groupBy(*by).agg(*content_hash(a.columns)).withColumn("side", F.lit(side))
    of = lambda side: F.max(F.when(F.col("side") == side, F.struct("rows", "h1", "h2")))
    both = named(a, 0).unionByName(named(b, 1)).groupBy(*by).agg(of(0).alias("l"), of(1).alias("r"))
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select(
        *by, F.coalesce("l.rows", F.lit(0)).alias("rows_left"), F.coalesce("r.rows", F.lit(0)).alias("rows_right"))


def row_changes(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """``same_rows`` per part, for the parts that differ; only their rows are shuffled where the list of them is small."""
    parts = changed_parts(a, b, by).select(*by)
    cols, null_safe = a.columns, lambda df: reduce(lambda x, y: x & y, [df[c].eqNullSafe(F.col(f"__p_{c}")) for c in by])
    named = parts.withColumnsRenamed({c: f"__p_{c}" for c in by})
    of = lambda df, d: df.join(named, null_safe(df), "left_semi").select(*cols, F.lit(d).alias("__d"))
    per_row = of(a, 1).union(of(b, -1)).groupBy(*cols).agg(F.sum("__d").alias("d"))
    return per_row.where("d != 0").groupBy(*by).agg(
        F.sum(F.greatest("d", F.lit(0))).alias("only_left"), F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("only_right"))
