"""Vital signs: plausibility, hourly resampling, deterioration lead time, ward summary."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.functions.aggregates import exact_mean, suppress_small
from lakeops.operators import joins as J
from lakeops.operators import windows as W

# Item codes of two source systems, (code, vital, unit to convert from).
ITEMS = [(220045, "heart_rate", None), (211, "heart_rate", None), (220277, "spo2", None), (646, "spo2", None),
         (220179, "sbp", None), (455, "sbp", None), (220180, "dbp", None), (8441, "dbp", None),
         (220210, "resp_rate", None), (618, "resp_rate", None), (223762, "temp_c", None), (676, "temp_c", None),
         (223761, "temp_c", "F"), (678, "temp_c", "F")]
# Plausible range per vital.
PLAUSIBLE = {"heart_rate": (20, 250), "spo2": (50, 100), "sbp": (40, 260), "dbp": (20, 160),
             "resp_rate": (4, 60), "temp_c": (30, 43)}
# Early-warning limits per vital, breached below the first or above the second.
LIMITS = {"heart_rate": (40, 130), "spo2": (92, None), "sbp": (90, None), "resp_rate": (8, 24), "temp_c": (35.0, 39.0)}
VITALS = list(PLAUSIBLE)


def plausible(vital: str = "vital", value: str = "value_norm") -> Column:
    chain = F
    for name, (lo, hi) in PLAUSIBLE.items():
        chain = chain.when(F.col(vital) == name, F.col(value).between(lo, hi))
    return chain


def clean_readings(chart: DataFrame, items: DataFrame) -> DataFrame:
    """Mapped, deduplicated, unit-corrected and flagged readings; nothing is deleted for its value."""
    mapped, _ = J.map_codes(chart, items, "itemid")
    newest = W.latest_wins(mapped, ["icustay_id", "itemid", "charttime"], [F.col("storetime").desc(), F.col("row_id").desc()])
    value = F.when(F.col("unit_fix") == "F", C.fahrenheit_to_celsius("valuenum")).otherwise(F.col("valuenum"))
    return newest.withColumn("value_norm", value).withColumn("plausible", plausible()).withColumn(
        "source_error", F.col("error") == 1)


def widen(clean: DataFrame, keys: Sequence[str] = ("icustay_id", "charttime")) -> DataFrame:
    """A column per vital; two codes of one vital at one time are averaged."""
    return clean.groupBy(*keys).pivot("vital", VITALS).agg(F.avg("value_norm"))


def hourly(clean: DataFrame, stays: DataFrame, vital: str, max_gap_minutes: float) -> DataFrame:
    """Stay-hour values of one vital with their source: observed, carried or gap."""
    bounds = stays.select("icustay_id", F.col("intime").alias("lo"), F.col("outtime").alias("hi"))
    r = W.resample(clean.where((F.col("vital") == vital) & F.col("plausible")), ["icustay_id"], "charttime", "value_norm", 3600,
                   int(max_gap_minutes * 60), bounds)
    return r.withColumn("vital", F.lit(vital))


def breached(vital: str, value: Column) -> Column:
    lo, hi = LIMITS[vital]
    rule = value < lo
    return rule if hi is None else rule | (value > hi)


def breach_rule(vital: str = "vital", value: str = "value") -> Column:
    chain = F
    for name in LIMITS:
        chain = chain.when(F.col(vital) == name, breached(name, F.col(value)))
    return F.coalesce(chain, F.lit(False))


def lead_times(hours: DataFrame, events: DataFrame, key: str = "icustay_id", look_back: int = 6) -> DataFrame:
    """Earliest breach in the hours before each event and the vital that showed it first; gaps never count."""
    near = J.within_hours_before(hours.where(F.col("source") != "gap"), events, [key], "slot", "event_ts", look_back)
    lead = (F.unix_seconds("event_ts") - F.unix_seconds("slot")) / 3600
    hit = near.where(breach_rule()).withColumn("lead_hours", lead)
    first = hit.groupBy(key, "event_ts").agg(F.max(F.struct("lead_hours", F.col("vital"))).alias("f"))
    return first.select(key, "event_ts", F.col("f.lead_hours").alias("earliest_lead_h"), F.col("f.vital").alias("first_signal"))


def ward_summary(readings: DataFrame, unit: str, ts: str, member: str, value: str, k: int = 5) -> DataFrame:
    """Care unit by hour of day; cells with fewer than ``k`` people are left out."""
    return suppress_small(readings.withColumn("hour_of_day", F.hour(F.col(ts))), [unit, "hour_of_day"], member, k,
                          exact_mean(value).alias("mean_value"), F.count(value).alias("readings"))
