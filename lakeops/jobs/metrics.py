"""Hourly metrics table: first materialisation and window refresh."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalar import as_double, money
from lakeops.sinks.writers import refresh_window


def hourly_metrics(orders: DataFrame, by: Sequence[str], ts: str, amount: str) -> DataFrame:
    return orders.groupBy(*by, F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.count("*").alias("orders"), as_double(F.sum(money(amount)), "revenue"))


def refresh(current: DataFrame, orders: DataFrame, by: Sequence[str], ts: str, amount: str, start: str) -> DataFrame:
    """Recompute the hours from ``start`` on; only the late part of the facts is read."""
    edge = F.lit(start).cast("timestamp")
    late = orders.where(F.col(ts) >= edge)
    return refresh_window(current, hourly_metrics(late, by, ts, amount), F.col("hour") >= edge)
