"""Clickstream: price catalogue, price seen, elasticity around changes, abandoned carts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import scans as S
from lakeops.operators import windows as W
from lakeops.session import ensure_checkpoint_dir

HOUR = 3_600_000_000     # microseconds


def with_product(events: DataFrame) -> DataFrame:
    return events.withColumn("product", F.get_json_object("props", "$.k").cast("int"))


def catalog_days(events: DataFrame) -> DataFrame:
    """First price of each product and day: a row per product and day, whatever the traffic."""
    return with_product(events).groupBy("product", F.to_date("ts").alias("day")).agg(
        F.min_by("value", "ts").alias("price"))


def price_catalog(events: DataFrame) -> DataFrame:
    """Price intervals per product: product, price, previous_price, effective_start, effective_end."""
    daily = catalog_days(events).withColumn("day", F.col("day").cast("timestamp"))
    return W.close_intervals(daily, ["product"], "day", "price", S.HotKeys(("product",)))


def price_changes(daily: DataFrame, threshold: float, start: str = "day", price: str = "price") -> DataFrame:
    """Rows whose price moved by more than the threshold against the previous one."""
    known = S.scan(daily, ["product"], [start], [S.lag(price, "prev_price")], S.HotKeys(("product",)),
                   S.position(daily, start))
    pct = (F.col(price) - F.col("prev_price")) / F.col("prev_price")
    return known.where(F.col("prev_price") > 0).withColumn("pct_change", pct).where(F.abs("pct_change") > threshold)


def elasticity(events: DataFrame, catalog: DataFrame, hot: S.HotKeys, *, threshold: float = 0.15,
               post_hours: int = 2, base_days: int = 7, floor: int = 30, kind: str = "purchase") -> DataFrame:
    """Relative change of purchases over relative change of price, per price change.

    ``events`` carry the price seen. The baseline counts purchases at the old price
    in the days before, scaled to the length of the window after the change. Both
    counts come from running totals, so overlapping windows do not multiply rows.
    """
    changes = price_changes(catalog, threshold, "effective_start").select(
        "product", "effective_start", "price", "prev_price", "pct_change")
    # read three times below: a row per price change, found in all events
    ensure_checkpoint_dir(changes.sparkSession)
    changes = changes.checkpoint()
    bought = events.where(F.col("event_type") == kind).select(
        "product", "ts", F.col("price").alias("seen"), F.lit(1).alias("n"))
    start, at = F.unix_micros("effective_start"), F.unix_micros("ts")
    post = S.window_totals(changes, bought, ["product"], ["product", "effective_start"], start,
                           start + post_hours * HOUR, at, ["n"], hot).withColumnRenamed("n", "post_purchases")
    old = changes.withColumn("seen", F.col("prev_price"))
    wide_hot = S.find_hot(bought, ["product", "seen"], at) if hot else S.HotKeys(("product", "seen"))
    base = S.window_totals(old, bought, ["product", "seen"], ["product", "effective_start"], start - base_days * 24 * HOUR,
                           start, at, ["n"], wide_hot).select("product", "effective_start", F.col("n").alias("base_purchases"))
    blocks = base_days * 24 / post_hours
    both = changes.join(post, ["product", "effective_start"], "left").join(base, ["product", "effective_start"], "left")
    scaled = both.na.fill(0, ["post_purchases", "base_purchases"]).withColumn(
        "base_per_window", F.col("base_purchases") / F.lit(float(blocks)))
    moved = (F.col("post_purchases") - F.col("base_per_window")) / F.col("base_per_window")
    return scaled.withColumn("qualifies", F.col("base_purchases") >= floor).withColumn(
        "elasticity", F.when(F.col("qualifies") & (F.col("base_per_window") > 0), moved / F.col("pct_change")))


def abandoned_carts(events: DataFrame, catalog: DataFrame, cart: str, buyer: Sequence[str], hot: S.HotKeys, *,
                    min_change: float = 0.15, minutes: int = 30, purchase: str = "purchase") -> DataFrame:
    """Carts within minutes after a price increase that the buyer never paid for afterwards.

    A cart belongs to the latest increase before it. ``buyer`` names the columns a
    later purchase must share (session or user, and product).
    """
    raised = price_changes(catalog, min_change, "effective_start").where(F.col("pct_change") > 0).select(
        "product", F.col("effective_start").alias("raised_at"), F.col("price").alias("lost_revenue_at_cart"),
        F.col("prev_price").alias("lost_revenue_at_old"))
    carts = events.where(F.col("event_type") == cart)
    after = S.asof_join(carts, raised, ["product"], "ts", "raised_at",
                        ["raised_at", "lost_revenue_at_cart", "lost_revenue_at_old"], hot)
    soon = after.where(F.unix_micros("ts") - F.unix_micros("raised_at") < minutes * 60_000_000)
    # a later purchase exists if the buyer's last one is later: one row per buyer instead of all of them
    last_paid = events.where(F.col("event_type") == purchase).groupBy(*buyer).agg(F.max("ts").alias("__paid"))
    return soon.join(last_paid, list(buyer), "left").where(
        F.col("__paid").isNull() | (F.col("__paid") <= F.col("ts"))).drop("__paid")
