"""Radio counters to cell KPIs, and anomalies against a cell's own past."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.scalar import mbps, safe_ratio
from lakeops.operators.joins import broadcast_if_small

# The canonical counters; the output schema never depends on the data.
COUNTERS = ["rrc_attempts", "rrc_success", "call_attempts", "call_drops", "ho_attempts", "ho_success",
            "prb_used", "prb_available", "dl_bytes", "ul_bytes"]
RATES = {"rrc_success_rate": ("rrc_success", "rrc_attempts"), "drop_call_rate": ("call_drops", "call_attempts"),
         "handover_success_rate": ("ho_success", "ho_attempts"), "prb_utilisation": ("prb_used", "prb_available")}
WINDOW_SECONDS = 900


def cell_kpis(counters: DataFrame, mapping: DataFrame, topology: DataFrame | None,
              window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """One row per window and cell: ratios of summed counters, never means of ratios."""
    names = mapping.select(F.col("vendor").alias("__v"), F.col("vendor_counter").alias("__c"), "canonical_counter")
    canonical = counters.join(
        broadcast_if_small(names), (F.col("vendor") == F.col("__v")) & (F.col("counter_name") == F.col("__c")))
    start = F.timestamp_seconds(F.floor(F.unix_seconds("counter_ts") / window_seconds) * window_seconds)
    wide = (canonical.groupBy(start.alias("window_start"), "cell_id").pivot("canonical_counter", COUNTERS)
            .agg(F.sum("counter_value")).na.fill(0, COUNTERS))
    total = F.col("dl_bytes") + F.col("ul_bytes")
    kpis = wide.withColumns({name: safe_ratio(a, b, 4, 100.0) for name, (a, b) in RATES.items()}).withColumns({
        "total_bytes": total, "throughput_mbps": F.round(mbps(total.cast("double"), window_seconds), 3)})
    return kpis if topology is None else kpis.join(broadcast_if_small(topology), "cell_id", "left")


def for_window(counters: DataFrame, start: str, end: str) -> DataFrame:
    """Counters owned by one half-open window."""
    return counters.where((F.col("counter_ts") >= F.lit(start).cast("timestamp"))
                          & (F.col("counter_ts") < F.lit(end).cast("timestamp")))


def sigma_anomalies(daily: DataFrame, keys: Sequence[str], day: str, value: str, days: int = 28,
                    sigma: float = 3.0) -> DataFrame:
    """Values above mean + sigma * stddev of the key's own previous days.

    The limit is rounded to nine decimals, so a value that lies on it is judged the
    same whatever the order of summation. One row per key and day goes in, so a key's window holds at most its days.
    """
    w = Window.partitionBy(*keys).orderBy(F.unix_date(F.col(day))).rangeBetween(-days, -1)
    mean, sd = F.avg(value).over(w), F.stddev(value).over(w)
    return daily.withColumns({"baseline_days": F.count("*").over(w), "baseline_mean": mean, "baseline_sd": sd}).withColumn(
        "anomalous", (F.col("baseline_sd") > 0)
        & (F.col(value) > F.round(F.col("baseline_mean") + sigma * F.col("baseline_sd"), 9)))


def anomaly_summary(scored: DataFrame, day: str) -> DataFrame:
    return scored.groupBy(day).agg(F.count("*").alias("cells"), F.count_if("anomalous").alias("anomalous_cells"))
