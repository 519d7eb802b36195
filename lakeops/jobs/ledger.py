"""Account ledger: balances in two times, daily summary, velocity alerts, settlement drift."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import aggregates as A
from lakeops.functions.scalar import first_match
from lakeops.operators import joins as J
from lakeops.operators import scans as S
from lakeops.operators import versions as V
from lakeops.operators import windows as W

CREDITS = ["CASH-IN"]
OUTFLOWS = ["CASH-OUT", "TRANSFER", "DEBIT"]


def net(amount: str = "amount", kind: str = "tx_type") -> Column:
    return A.signed(amount, kind, CREDITS)


def daily_account_summary(ledger: DataFrame) -> DataFrame:
    """Opening, credits, debits and closing per account, currency and business date."""
    live = ledger.where(~F.col("is_deleted"))
    credit = F.col("tx_type").isin(CREDITS)
    daily = live.groupBy("account_id", "currency", F.to_date("event_timestamp").alias("business_date")).agg(
        F.sum(F.when(credit, F.col("amount")).otherwise(F.lit(0))).alias("credit_volume"),
        F.sum(F.when(credit, F.lit(0)).otherwise(F.col("amount"))).alias("debit_volume"), F.count("*").alias("txn_count"))
    return A.rollforward(daily, ["account_id", "currency"], "business_date", "credit_volume", "debit_volume")


def velocity_alerts(ledger: DataFrame, opening: DataFrame, row_id: Sequence[str], hot: S.HotKeys,
                    window_seconds: int = 900, medium: float = 0.80, high: float = 0.90,
                    critical: float = 1.00) -> DataFrame:
    """Rolling outflow against the day's opening balance.

    The window runs over the account and currency, so it sees across midnight; the
    day only picks the opening balance of that currency. ``hot`` is by account and
    currency.
    """
    out = ledger.where(~F.col("is_deleted") & F.col("tx_type").isin(OUTFLOWS))
    rolled = W.rolling_sum(out, ["account_id", "currency"], "event_timestamp", "amount", window_seconds, row_id, hot, "rolling_outflow")
    day = rolled.withColumn("business_date", F.to_date("event_timestamp"))
    keys = ["account_id", "currency", "business_date"]
    joined = day.join(opening.select(*keys, "opening_balance"), keys)
    share = F.col("rolling_outflow").cast("double") / F.col("opening_balance").cast("double")
    alerts = joined.where(F.col("opening_balance") > 0).withColumn("pct_of_opening", share).where(
        F.col("pct_of_opening") >= medium)
    return alerts.withColumn("severity", first_match(
        [(F.col("pct_of_opening") >= critical, "CRITICAL"), (F.col("pct_of_opening") >= high, "HIGH")], "MEDIUM"))


def net_positions(state: DataFrame, event_time: str = "event_timestamp") -> DataFrame:
    return state.groupBy("currency", F.to_date(F.col(event_time)).alias("business_date")).agg(F.sum(net()).alias("net"))


def settlement_drift(log: DataFrame, keys: Sequence[str], at_close: int, order: Sequence[str] = (),
                     material: float = 0.001) -> DataFrame:
    """Published against restated net per currency and day."""
    published = net_positions(V.as_of_version(log, keys, at_close, order=order))
    restated = net_positions(V.as_of_version(log, keys, F.lit(1 << 60), order=order))
    d = J.compare_states(published, restated, ["currency", "business_date"], "net")
    return d.withColumn("material", F.coalesce(F.abs("drift_pct") > material, F.lit(False)))
