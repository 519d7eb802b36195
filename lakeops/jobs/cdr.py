"""Call-record mediation: late window, dedup, normalise, rate, merge."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.operators import changes, windows
from lakeops.operators.joins import broadcast_if_small
from lakeops.sinks.writers import by_partition_keys
from lakeops.sources.readers import late_window

VERSION_ORDER = ("source_ts", "ingest_ts")


def mediate(raw: DataFrame, tariffs: DataFrame, market: str, run_date: str, late_hours: int = 6,
            tie: tuple[str, ...] = ()) -> DataFrame:
    """Rated records of the reprocessing window, one per ``cdr_id``.

    ``tariffs`` (market, service_type, tariff_plan_id, billing_increment_sec,
    unit_rate) is a price list; it is broadcast if its count allows.
    """
    start, end = late_window(run_date, late_hours)
    window = raw.where((F.col("event_ts") >= F.lit(start).cast("timestamp"))
                       & (F.col("event_ts") < F.lit(end).cast("timestamp")))
    newest = windows.latest_wins(window, ["cdr_id"], [F.col(c).desc() for c in (*VERSION_ORDER, *tie)])
    typed = newest.withColumns({
        "market": F.lit(market), "event_date": F.to_date("event_ts"), "event_hour": F.hour("event_ts"),
        "a_number": C.clean_number("a_number"), "b_number": C.clean_number("b_number"),
        "duration_sec": F.col("duration_sec").cast("int")})
    flagged = typed.withColumn("quality_flag", C.call_quality("duration_sec", "b_number")).withColumn(
        "duration_sec", F.greatest("duration_sec", F.lit(0)))
    prices = broadcast_if_small(tariffs.where(F.col("market") == market))
    rated = flagged.join(prices, ["market", "service_type", "tariff_plan_id"], "left")
    units = C.metered_units("service_type", "duration_sec", "billing_increment_sec", "bytes_total")
    return (rated.withColumn("charged_units", units)
            .withColumn("charge_amount", F.round(F.col("charged_units") * F.coalesce("unit_rate", F.lit(0.0)), 5))
            .withColumn("rated_flag", F.when(F.col("unit_rate").isNull(), "UNRATED_NO_TARIFF").otherwise("RATED"))
            .drop("billing_increment_sec", "unit_rate"))


def merge_mediated(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Table state after the batch: a record is replaced only by a later emission."""
    return changes.merge(target, batch.select(*target.columns), ["cdr_id", "event_date"],
                         newer=("source_ts", "source_ts"))


def for_write(batch: DataFrame, salt_buckets: int = 16) -> DataFrame:
    """Spread each hour over several writers; the hash of the record decides, so a retry agrees."""
    return by_partition_keys(batch, ["event_date", "event_hour"], salt_buckets=salt_buckets, salt_on=["cdr_id"])


def duplicate_pct(table: DataFrame, start: str, end: str) -> DataFrame:
    from lakeops.operators.gates import duplicate_share
    rows = table.where((F.col("event_ts") >= F.lit(start).cast("timestamp"))
                       & (F.col("event_ts") < F.lit(end).cast("timestamp")))
    return duplicate_share(rows, ["cdr_id"])
