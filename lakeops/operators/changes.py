"""Change data: collapse a change stream, flatten envelopes, merge into current state."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.windows import latest_wins


class DuplicateSourceKeys(ValueError):
    """The change batch holds several rows for one key, so the merge is ambiguous."""


def collapse(changes: DataFrame, keys: Sequence[str], order: Sequence[str], is_delete: Column) -> DataFrame:
    """Last change per key along ``order``; deletes stay, marked ``_deleted``."""
    last = latest_wins(changes, keys, [F.col(c).desc() for c in order])
    return last.withColumn("_deleted", is_delete)


def require_unique(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise when a key repeats; returns the source for chaining."""
    bad = source.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if bad:
        raise DuplicateSourceKeys(f"merge source repeats key {bad[0].asDict()}")
    return source


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
          update: Sequence[str] | None = None, newer: tuple[str, str] | None = None,
          deleted: str | None = None, soft_delete: str | None = None) -> DataFrame:
    """Full state after merging ``source`` into ``target``, both with unique keys.

    ``update`` lists the columns a match overwrites (default: all the source has).
    ``newer`` = (source column, target column): a match updates only if the first
    is greater. ``deleted`` names a boolean source column: a match is removed, or
    flagged in the target column ``soft_delete``; a delete of an unknown key is
    ignored. The keys of both sides are unique, so one hash shuffle of each is
    balanced whatever the data.
    """
    keys = list(keys)
    payload = [c for c in target.columns if c not in keys]
    update = [c for c in (update or payload) if c in source.columns]
    t = target.select(*keys, F.struct(F.lit(True).alias("__in"), *payload).alias("t"))
    s = source.select(*keys, F.struct(F.lit(True).alias("__in"),
                                      *[c for c in source.columns if c not in keys]).alias("s"))
    both = t.join(s, keys, "full_outer")
    gone = F.coalesce(F.col(f"s.{deleted}"), F.lit(False)) if deleted else F.lit(False)
    old, new = F.col("t").isNotNull(), F.col("s").isNotNull()
    fresh = new & ~gone
    if newer:
        fresh = fresh & (~old | F.coalesce(F.col(f"s.{newer[0]}") > F.col(f"t.{newer[1]}"), F.lit(False)))
    keep = old | (new & ~gone)
    if deleted and not soft_delete:
        keep = keep & ~(old & gone)

    def value(c: str) -> Column:
        in_source = c in source.columns
        if c == soft_delete:
            return F.when(old & gone, F.lit(True)).when(~old, F.lit(False)).otherwise(F.col(f"t.{c}"))
        inserted = F.col(f"s.{c}") if in_source else F.lit(None)
        kept = F.when(fresh, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in update else F.col(f"t.{c}")
        return F.when(~old, inserted).otherwise(kept).cast(target.schema[c].dataType)

    return both.where(keep).select(*[F.col(c) if c in keys else value(c).alias(c) for c in target.columns])


def update_where(df: DataFrame, cond: Column, values: dict[str, Column]) -> DataFrame:
    """Overwrite columns in the rows where ``cond`` is true; NULL counts as false."""
    hit = F.coalesce(cond, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)).cast(df.schema[c].dataType)
                           for c, v in values.items()})


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(~F.coalesce(cond, F.lit(False)))


def insert_rows(df: DataFrame, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Append literal rows; columns that are not named become NULL."""
    schema = [df.schema[c] for c in columns]
    from pyspark.sql import types as T
    new = df.sparkSession.createDataFrame(rows, T.StructType(schema))
    return df.unionByName(new, allowMissingColumns=True)


def flatten_envelope(envelopes: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """Flat change rows from ``op, ts_ms, source{...}, before, after`` with JSON images.

    The key comes from the new image, or from the old one for a delete.
    ``fields`` maps payload names to types.
    """
    image = lambda side, name: F.get_json_object(F.col(side), f"$.{name}")
    millis = lambda c: F.timestamp_millis(c.cast("bigint"))
    return envelopes.select(
        F.coalesce(image("after", key), image("before", key)).alias(key),
        F.col("op").alias("cdc_operation"), millis(F.col("source.ts_ms")).alias("source_ts"),
        millis(F.col("ts_ms")).alias("arrival_ts"), F.col("source.lsn").alias("source_lsn"),
        *[image("after", n).cast(t).alias(n) for n, t in fields.items()],
        (F.col("op") == "d").alias("_deleted"))
