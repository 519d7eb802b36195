"""Partner settlement files in four dialects, one common schema."""
from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import gates
from lakeops.sinks import writers
from lakeops.sources import readers

# The positional record of the fixed-width dialect.
FIXED_WIDTH = [("a_number", 1, 15), ("b_number", 16, 15), ("event_ts", 31, 14),
               ("duration_sec", 45, 8), ("charged_units", 53, 8), ("amount", 61, 15)]
IMPLIED_DECIMALS = 5


def _leg(a: str, b: str, at: Column, seconds: Column, units: str, amount: Column) -> list[Column]:
    return [F.col(a).alias("a_number"), F.col(b).alias("b_number"), at.alias("event_ts"),
            seconds.try_cast("int").alias("duration_sec"), F.col(units).try_cast("int").alias("charged_units"),
            amount.try_cast("decimal(18,5)").alias("charge_amount")]


def _tap3(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*_leg(
        "callingNumber", "calledNumber", F.try_to_timestamp(F.col("callEventStartTimeStamp").cast("string")),
        F.col("totalCallEventDuration"), "chargedUnits", F.col("chargeAmount")))


def _csv_v1(spark: SparkSession, path: str) -> DataFrame:
    names = ["a", "b", "day", "time", "duration", "units", "amount"]
    at = F.try_to_timestamp(F.concat_ws(" ", "day", "time"), F.lit("ddMMyyyy HHmmss"))
    return readers.read_csv_positional(spark, path, names).select(
        *_leg("a", "b", at, F.col("duration"), "units", F.col("amount")))


def _csv_v2(spark: SparkSession, path: str) -> DataFrame:
    schema = ("calling_msisdn string, called_msisdn string, start_time string, duration_minutes string, "
              "billed_units string, net_amount string")
    # decimal minutes in the file, seconds in the ledger
    seconds = F.round(F.col("duration_minutes").try_cast("double") * 60)
    return readers.read_csv(spark, path, schema).select(*_leg(
        "calling_msisdn", "called_msisdn", F.try_to_timestamp("start_time"), seconds, "billed_units",
        F.col("net_amount")))


def fixed_width_legs(fields: DataFrame) -> DataFrame:
    # fifteen digits with implied decimals need a wide integer before the point is set; a product is as exact as a quotient and cheaper
    amount = F.col("amount").try_cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-IMPLIED_DECIMALS))
    return fields.select(*_leg(
        "a_number", "b_number", F.try_to_timestamp("event_ts", F.lit("yyyyMMddHHmmss")),
        F.col("duration_sec"), "charged_units", amount))


def _fixed_width(spark: SparkSession, path: str) -> DataFrame:
    return fixed_width_legs(readers.read_fixed_width(spark, path, FIXED_WIDTH))


DIALECTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tap3": _tap3, "csv_v1": _csv_v1, "csv_v2": _csv_v2, "fixed_width": _fixed_width}


def read_partner(spark: SparkSession, path: str, dialect: str) -> DataFrame:
    """Legs in the common schema; an unknown dialect raises."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}; known: {sorted(DIALECTS)}")
    return DIALECTS[dialect](spark, path)


def _readable(legs: DataFrame, max_bad: float) -> dict:
    return gates.enforce(gates.parse_failures(legs, ["event_ts", "charge_amount"], max_bad))


def _labelled(legs: DataFrame, dialect: str, partner: str, currency: str, run_date: str) -> DataFrame:
    return legs.select("*", F.lit(partner).alias("partner_code"), F.lit(currency).alias("currency"),
                       F.lit(dialect).alias("source_format"),
                       F.lit(run_date).cast("date").alias("settlement_date"))


def ingest_partner(spark: SparkSession, path: str, dialect: str, partner: str, currency: str, run_date: str,
                   max_bad: float = 0.001) -> DataFrame:
    """Parse, refuse a file with too many unreadable rows, and label the legs."""
    legs = read_partner(spark, path, dialect)
    _readable(legs, max_bad)
    return _labelled(legs, dialect, partner, currency, run_date)


def load_partner(spark: SparkSession, path: str, dialect: str, partner: str, currency: str, run_date: str, target: str,
                 max_bad: float = 0.001) -> None:
    """``ingest_partner`` into the partner's slice of the day at ``target``; the file is parsed once and a refused one changes nothing."""
    legs = _labelled(read_partner(spark, path, dialect), dialect, partner, currency, run_date)
    writers.replace_slice(legs, target, {"settlement_date": run_date, "partner_code": partner},
                          lambda written: _readable(written, max_bad))
