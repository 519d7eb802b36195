"""Smart meters: cleaning, hourly load, outages and their blast radius, weather response."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.functions.aggregates import response_curve
from lakeops.operators import joins as J
from lakeops.operators import windows as W

GRID_SECONDS = 1800
CLUSTER_METERS = 5


def clean_readings(raw: DataFrame, grid_seconds: int = GRID_SECONDS) -> DataFrame:
    """One reading per meter and grid slot with status; missing and zero stay different things."""
    slot = C.snap_down("reading_ts", grid_seconds)
    typed = raw.withColumns({
        "slot": slot, "drift_seconds": F.unix_seconds("reading_ts") - F.unix_seconds(slot),
        "energy_kwh": C.parsed_reading("energy_raw")}).withColumn("reading_status", C.reading_status("energy_kwh"))
    return W.latest_wins(typed, ["meter_id", "slot"], [F.col("reading_ts").desc(), F.col("row_id").desc()])


def hourly_load(clean: DataFrame, slots_per_hour: float = 2.0) -> DataFrame:
    return clean.groupBy("meter_id", "block", F.date_trunc("hour", "slot").alias("hour")).agg(
        F.sum(F.col("energy_kwh").cast("decimal(18,4)")).cast("double").alias("kwh"),
        F.count_if(F.col("reading_status") == "OK").alias("ok_intervals"), F.count("*").alias("total_intervals")).withColumn(
        "completeness", F.col("ok_intervals") / F.lit(slots_per_hour))


def outages(clean: DataFrame, grid_seconds: int = GRID_SECONDS, min_slots: int = 3,
            cluster: int = CLUSTER_METERS) -> DataFrame:
    """Silent runs between a meter's first and last slot, and how many other meters of the block were silent too."""
    runs = W.missing_runs(clean, ["meter_id", "block"], "slot", grid_seconds, min_slots, F.col("reading_status") != "MISSING")
    counted = J.overlap_counts(runs, "block", "meter_id", "run_start", "run_end", grid_seconds, name="concurrent_meters")
    return counted.withColumn("duration_min", F.col("slots") * F.lit(grid_seconds // 60)).withColumn(
        "classification", F.when(F.col("concurrent_meters") >= cluster, "CLUSTERED").otherwise("ISOLATED"))


def with_weather(clean: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly weather for each reading; a reading without weather keeps NULL."""
    return clean.join(J.broadcast_if_small(weather), F.date_trunc("hour", "slot") == F.col("weather_hour"), "left")


def weather_response(load: DataFrame, group: str, temperature: str = "temperature", kwh: str = "kwh",
                     degrees: float = 1.0) -> DataFrame:
    """Mean load per temperature bin and group: the lowest point and the slope on either side of it."""
    return response_curve(load, [group], temperature, kwh, degrees)
