"""Data-quality gates: each returns a one-row verdict; ``enforce`` raises on failure."""
from __future__ import annotations

import calendar
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateFailed(RuntimeError):
    """A gate said no; the message holds the verdict."""


def enforce(verdict: DataFrame) -> dict:
    """Run a verdict and raise unless it passed."""
    row = verdict.first().asDict(recursive=True)
    if not row["passed"]:
        raise GateFailed(str(row))
    return row


def _verdict(df: DataFrame, gate: str, passed: Column) -> DataFrame:
    return df.select(F.lit(gate).alias("gate"), *df.columns, F.coalesce(passed, F.lit(False)).alias("passed"))


def not_empty(df: DataFrame) -> DataFrame:
    """Looks at one row only."""
    seen = df.select(F.lit(1).alias("x")).limit(1).agg(F.count("*").alias("rows_seen"))
    return _verdict(seen, "not_empty", F.col("rows_seen") > 0)


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    dup = df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_keys"))
    return _verdict(dup, "unique", F.col("duplicate_keys") == 0)


def score_distribution(df: DataFrame, score: str, min_mean: float = 0.01, max_mean: float = 0.45,
                       min_sd: float = 0.02) -> DataFrame:
    """A broken model keeps the row count and loses the distribution."""
    s = df.agg(F.count_if(F.col(score).isNull()).alias("nulls"), F.avg(score).alias("mean"),
               F.stddev(score).alias("sd"))
    return _verdict(s, "score_distribution", (F.col("nulls") == 0)
                    & F.col("mean").between(min_mean, max_mean) & (F.col("sd") >= min_sd))


def parse_failures(df: DataFrame, columns: Sequence[str], max_ratio: float = 0.001) -> DataFrame:
    counted = df.agg(F.count("*").alias("total"),
                     *[F.count_if(F.col(c).isNull()).alias("bad_" + c) for c in columns])
    ok = F.col("total") > 0
    for c in columns:
        ok = ok & (F.col("bad_" + c) <= F.col("total") * max_ratio)
    return _verdict(counted, "parse_failures", ok)


def complete_month(df: DataFrame, day: str, month: str, expected: DataFrame | None = None) -> DataFrame:
    """Every day of ``month`` (YYYY-MM) is present: all of the calendar, or those of the table ``expected`` (column ``day``)."""
    start = F.lit(month + "-01").cast("date")
    inside = lambda table: table.where((F.col(day) >= start) & (F.col(day) < F.add_months(start, 1)))
    days = F.countDistinct(F.to_date(F.col(day)))
    if expected is None:
        wanted = F.lit(calendar.monthrange(int(month[:4]), int(month[5:7]))[1])
    else:
        wanted = inside(expected).agg(days).scalar()
    got = inside(df).agg(days.alias("days_present")).withColumn("days_expected", wanted)
    return _verdict(got, "complete_month", F.col("days_present") == F.col("days_expected"))


def lookup_coverage(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Keys with no lookup row are counted before any default can hide them."""
    from lakeops.operators.joins import broadcast_if_small
    known = broadcast_if_small(lookup.select(key).distinct())
    missing = df.join(known, key, "left_anti").agg(F.count("*").alias("missing_rows"))
    return _verdict(missing, "lookup_coverage", F.col("missing_rows") == 0)


def duplicate_share(df: DataFrame, keys: Sequence[str], max_pct: float = 0.5) -> DataFrame:
    per = df.groupBy(*keys).count().agg(F.sum("count").alias("total"), F.count("*").alias("distinct_keys"))
    pct = F.coalesce(F.try_divide(100.0 * (F.col("total") - F.col("distinct_keys")), F.col("total")), F.lit(0.0))
    return _verdict(per.withColumn("duplicate_pct", pct), "duplicate_share", F.col("duplicate_pct") <= max_pct)


def column_checks(df: DataFrame, rules: Sequence[tuple[str, str, float | None]]) -> DataFrame:
    """Declarative checks in one pass, one row per rule.

    A rule is (column, check, bound) with check in ``null`` (most NULLs allowed),
    ``unique`` (most repeated values allowed), ``min`` or ``max`` (bound of the value).
    """
    exprs = {
        "null": lambda c: F.count_if(F.col(c).isNull()),
        "min": lambda c: F.min(c), "max": lambda c: F.max(c),
    }
    measured = df.agg(F.lit(0), *[exprs[kind](c).cast("double").alias(f"m{i}") for i, (c, kind, _) in enumerate(rules) if kind != "unique"])
    for i, (c, kind, _) in enumerate(rules):
        if kind == "unique":
            # folded per column: several distinct counts in one aggregate would copy every row
            repeats = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double"))
            measured = measured.withColumn(f"m{i}", repeats.scalar())
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kind).alias("check"),
                              F.lit(float(bound)).alias("bound"), F.col(f"m{i}").alias("measured"))
                     for i, (c, kind, bound) in enumerate(rules)])
    flat = measured.select(F.inline(rows))
    ok = F.when(F.col("check") == "min", F.col("measured") >= F.col("bound")).otherwise(
        F.col("measured") <= F.col("bound"))
    return flat.withColumn("passed", F.coalesce(ok, F.lit(False)))


def table_check(df: DataFrame, measure: Column, kind: str, bound, tolerance: float = 0.0) -> DataFrame:
    """Compare one aggregate: ``value`` within a relative tolerance, ``interval`` (lo, hi),
    ``threshold`` (at most), or ``boolean``."""
    m = df.agg(measure.alias("measured"))
    v = F.col("measured")
    if kind == "value":
        ok = F.abs(v - F.lit(bound)) <= abs(bound) * tolerance
    elif kind == "interval":
        ok = v.between(bound[0], bound[1])
    elif kind == "threshold":
        ok = v <= F.lit(bound)
    elif kind == "boolean":
        ok = v == F.lit(bool(bound))
    else:
        raise ValueError(f"unknown table check {kind}")
    return _verdict(m, kind, ok)


def audit(df: DataFrame, required: str, amount: str, keys: Sequence[str]) -> DataFrame:
    """Staged rows: missing required value, negative amount, repeated key."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col(required).isNull()).alias("e"),
                                F.count_if(F.col(amount) < 0).alias("g"))
    counted = per.agg(F.coalesce(F.sum("e"), F.lit(0)).alias("missing_required"),
                      F.coalesce(F.sum("g"), F.lit(0)).alias("negative_amounts"),
                      F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    return _verdict(counted, "audit", (F.col("missing_required") == 0) & (F.col("negative_amounts") == 0)
                    & (F.col("duplicate_keys") == 0))


def no_rows(violations: DataFrame, gate: str) -> DataFrame:
    """An invariant query must come back empty."""
    n = violations.agg(F.count("*").alias("violations"))
    return _verdict(n, gate, F.col("violations") == 0)


def worst_variance(variances: DataFrame, key: str, value: str, limit: float) -> DataFrame:
    """Total and worst absolute variance; fails when the worst exceeds the money limit."""
    from lakeops.functions.aggregates import worst_contributor
    w = worst_contributor(variances, key, value)
    return _verdict(w, "worst_variance", F.col("worst_abs") <= limit)


def deadline_watch(requests: DataFrame, received: str, today: Column, limit_days: int = 30,
                   warn_days: int = 7) -> DataFrame:
    """Open requests that come within ``warn_days`` of their limit."""
    open_days = F.datediff(today, F.col(received))
    return requests.withColumn("days_open", open_days).where(F.col("days_open") > limit_days - warn_days)


def shares(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Percentage of rows per named condition, one pass."""
    return df.agg(F.count("*").alias("total"), *[
        F.round(100.0 * F.count_if(c) / F.count("*"), 4).alias(name + "_pct") for name, c in conditions.items()])


def same_totals(before: DataFrame, after: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """A full re-run must give the totals of the first run."""
    totals = lambda df, run: df.agg(*[m.alias(f"{n}_{run}") for n, m in measures.items()])
    stacked = totals(before, "before").unionByName(totals(after, "after"), allowMissingColumns=True)
    both = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    ok = F.lit(True)
    for n in measures:
        ok = ok & F.col(f"{n}_before").eqNullSafe(F.col(f"{n}_after"))
    return _verdict(both, "same_totals", ok)


def volume_route(df: DataFrame, threshold: int = 1_000_000) -> DataFrame:
    """Route by incoming volume."""
    n = df.agg(F.count("*").alias("n"))
    return n.select(F.when(F.col("n") > threshold, "large").otherwise("small").alias("route"))
