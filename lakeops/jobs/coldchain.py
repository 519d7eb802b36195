"""Cold chain: spike filter, breaches with evidence, route punctuality."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalar import first_match, gps_valid
from lakeops.operators import scans as S
from lakeops.operators import windows as W
from lakeops.operators.versions import as_of_version

# Allowed temperature per cargo class.
CARGO = {"vaccine": (2.0, 8.0), "frozen": (-25.0, -15.0), "ambient": (15.0, 25.0)}


def clean_telemetry(pings: DataFrame, hot: S.HotKeys, tie: Sequence[str], jump: float = 8.0, agree: float = 2.0) -> DataFrame:
    flagged = pings.withColumn("gps_valid", gps_valid("lat", "lon"))
    return W.smooth_spikes(flagged, ["shipment_id"], ["ping_ts", *tie], "cargo_temp_c", jump, agree, hot, F.unix_micros("ping_ts"))


def breach_severity(minutes: str, high: float = 60, critical: float = 120) -> Column:
    return first_match([(F.col(minutes) > critical, "CRITICAL"), (F.col(minutes) > high, "HIGH")], "MEDIUM")


def breaches(telemetry: DataFrame, shipments: DataFrame, hot: S.HotKeys, tie: Sequence[str], source_version: int,
             min_minutes: float = 30, high: float = 60, critical: float = 120) -> DataFrame:
    """Contiguous out-of-range runs longer than the limit, each with the version it was computed from."""
    ranged = telemetry.join(shipments, "shipment_id")
    out = (F.col("cargo_temp_c") < F.col("required_min_c")) | (F.col("cargo_temp_c") > F.col("required_max_c"))
    runs = W.state_runs(ranged.withColumn("out_of_range", out), ["shipment_id"], "ping_ts", "out_of_range", tie, hot)
    at = F.unix_micros("ping_ts")
    folded = runs.groupBy("shipment_id", "vehicle_id", "cargo_class", "required_min_c", "required_max_c", "run_id").agg(
        F.min("ping_ts").alias("breach_start"), F.max("ping_ts").alias("breach_end"),
        F.min("cargo_temp_c").alias("min_temp"), F.max("cargo_temp_c").alias("max_temp"),
        F.min("lat").alias("bbox_lat_min"), F.max("lat").alias("bbox_lat_max"), F.min("lon").alias("bbox_lon_min"),
        F.max("lon").alias("bbox_lon_max"), F.avg("driver_score").alias("driver_score_mean"), F.count("*").alias("pings"),
        ((F.max(at) - F.min(at)) / 60_000_000).alias("duration_min"))
    return folded.where(F.col("duration_min") > min_minutes).withColumn(
        "severity", breach_severity("duration_min", high, critical)).withColumn("source_version", F.lit(source_version))


def evidence(log: DataFrame, keys: Sequence[str], breach: Mapping, ts: str = "ping_ts") -> DataFrame:
    """The pings behind one breach row, read from the version the breach was computed from."""
    state = as_of_version(log, keys, breach["source_version"])
    margin = F.expr("INTERVAL 30 MINUTES")
    return state.where((F.col("shipment_id") == F.lit(breach["shipment_id"]))
                       & F.col(ts).between(F.lit(breach["breach_start"]) - margin, F.lit(breach["breach_end"]) + margin))


def eta_performance(trips: DataFrame, keys: Sequence[str], promised: str, actual: str) -> DataFrame:
    """Median, 90th percentile and worst delay per route; exact, whatever the size of a route."""
    late = trips.withColumn("variance_min", (F.unix_seconds(actual) - F.unix_seconds(promised)) / 60)
    p = S.exact_percentiles(late, keys, "variance_min", {"median_min": 0.5, "p90_min": 0.9})
    worst = late.groupBy(*keys).agg(F.max("variance_min").alias("worst_min"), F.count_if(F.col("variance_min") > 0).alias("late_trips"))
    return p.withColumnRenamed("n_values", "trips").join(worst, list(keys))


def lateness_predictors(trips: DataFrame, late: str, candidates: Sequence[str]) -> DataFrame:
    """Candidates by the strength of their correlation with lateness, strongest first."""
    one = trips.agg(*[F.corr(F.col(c).cast("double"), F.col(late).cast("double")).alias(c) for c in candidates])
    pairs = F.array(*[F.struct(F.lit(c).alias("predictor"), F.col(c).alias("correlation")) for c in candidates])
    return one.select(F.inline(pairs)).orderBy(F.abs("correlation").desc_nulls_last(), "predictor")
