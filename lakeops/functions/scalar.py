"""Column helpers: every function returns a Column or a list of Columns."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, scale: int = 2) -> Column:
    """Exact decimal for amounts, so sums do not depend on the order of addition."""
    return col(c).cast(f"decimal(18,{scale})")


def net_amount(price: Column | str, discount: Column | str) -> Column:
    return money(price) * (F.lit(1) - col(discount).cast("decimal(4,2)"))


def as_double(c: Column | str, name: str | None = None) -> Column:
    out = col(c).cast("double")
    return out.alias(name) if name else out


def stamp(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def safe_ratio(num: Column | str, den: Column | str, digits: int | None = None,
               scale: float = 1.0) -> Column:
    """``scale * num / den``; NULL unless the denominator is positive."""
    value = F.lit(scale) * col(num).cast("double") / col(den).cast("double")
    if digits is not None:
        value = F.round(value, digits)
    return F.when(col(den) > 0, value)


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Rename every column but ``keep`` to ``prefix__name``."""
    return df.select(*keep, *[F.col(c).alias(f"{prefix}__{c}") for c in df.columns if c not in keep])


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    """Name of the first rule that holds: a CASE chain from a list."""
    chain = F
    for cond, name in rules:
        chain = chain.when(cond, F.lit(name))
    return chain.otherwise(F.lit(otherwise)) if otherwise is not None else chain


def known_or_other(c: Column | str, known: Sequence[str]) -> Column:
    return F.when(col(c).isin(list(known)), col(c)).otherwise(F.lit("OTHER"))


def zero_needs_tenure(value: Column | str, tenure_days: Column | str, days: int) -> Column:
    """A zero counts only for a subscriber who existed during the whole window."""
    return F.when(col(tenure_days) >= days, col(value))


def clean_number(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"[^0-9+]", "")


def parsed_reading(raw: Column | str) -> Column:
    """Dirty meter text to a double; the literal ``Null``, blanks and junk give NULL."""
    text = F.trim(col(raw))
    return F.when(~text.isin("Null", ""), text.try_cast("double"))


def reading_status(value: Column | str) -> Column:
    return first_match([(col(value).isNull(), "MISSING"), (col(value) < 0, "NEGATIVE"),
                        (col(value) == 0, "ZERO")], "OK")


def gps_valid(lat: Column | str, lon: Column | str) -> Column:
    lat, lon = col(lat), col(lon)
    at_zero = (F.abs(lat) < 0.001) & (F.abs(lon) < 0.001)
    return (lat.isNotNull() & lon.isNotNull() & F.coalesce(
        ~at_zero & lat.between(-90, 90) & lon.between(-180, 180), F.lit(False)))


def call_quality(duration: Column | str, b_number: Column | str) -> Column:
    return first_match([(col(duration) < 0, "NEGATIVE_DURATION"),
                        (col(duration) > SECONDS_PER_DAY, "DURATION_OVER_24H"),
                        (col(b_number).isNull(), "MISSING_B_NUMBER")], "OK")


def metered_units(service: Column | str, duration: Column | str, increment: Column | str,
                  volume: Column | str) -> Column:
    """Voice per started increment, data per started MiB, everything else per event."""
    return (F.when(col(service) == "VOICE",
                   F.ceil(col(duration) / F.coalesce(col(increment), F.lit(60))))
            .when(col(service) == "DATA", F.ceil(col(volume) / F.lit(1024 * 1024)))
            .otherwise(F.lit(1)).cast("bigint"))


def snap_down(ts: Column | str, seconds: int) -> Column:
    """Timestamp floored to a grid of ``seconds``."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(col(ts)) / seconds) * seconds)


def fahrenheit_to_celsius(c: Column | str) -> Column:
    return (col(c) - 32) * 5 / 9


def mbps(total_bytes: Column | str, seconds: int) -> Column:
    return col(total_bytes) * 8 / F.lit(1_000_000) / F.lit(float(seconds))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket 0..buckets-1 by a hash of the keys; the same row lands in the same bucket on every run."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def stable_fraction(keys: Sequence[str], salt: str = "") -> Column:
    """A number in [0, 1) that depends on the key values only, not on the partitioning."""
    text = F.concat_ws("|", F.lit(salt), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint") / F.lit(2.0 ** 32)
