"""Erasure from request to attestation: delete, rewrite, expire, verify."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import erasure as E
from lakeops.operators import versions as V


def erase_from_log(log: DataFrame, erased: DataFrame, key: str, commit_id: int, committed_at: str,
                   keys: Sequence[str]) -> DataFrame:
    """Step 1: a new commit that deletes the keys; older versions still hold them."""
    hit = log.join(erased.select(key).distinct(), key, "left_semi").select(*keys).distinct()
    new = hit.select(F.lit(commit_id).cast("bigint").alias("commit_id"),
                     F.lit(committed_at).cast("timestamp").alias("committed_at"),
                     F.lit(V.MAIN).alias("branch"), F.lit("delete").alias("op"), *keys)
    return log.unionByName(new, allowMissingColumns=True)


def run(log: DataFrame, erased: DataFrame, key: str, keys: Sequence[str], commit_id: int, committed_at: str,
        order: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The state after each step; expiry comes after the delete, or the old rows stay reachable."""
    deleted = erase_from_log(log, erased, key, commit_id, committed_at, keys)
    expired = V.expire(deleted, keys, [commit_id], order)
    return {"log": log, "deleted": deleted, "expired": expired}


def evidence(steps: Mapping[str, DataFrame], erased: DataFrame, key: str, keys: Sequence[str],
             order: Sequence[str] = ()) -> DataFrame:
    """Per step: rows a reader still sees for the keys, and rows any retained version still holds."""
    ids = erased.select(key).distinct()
    rows = []
    for name, log in steps.items():
        now = V.as_of_version(log, keys, F.lit(1 << 60), order=order).join(ids, key, "left_semi")
        held = log.where("op <> 'delete'").join(ids, key, "left_semi")
        visible = now.agg(F.lit(name).alias("step"), F.count("*").alias("visible_rows"))
        rows.append(visible.withColumn("rows_in_history", held.agg(F.count("*")).scalar()))
    return reduce(DataFrame.unionByName, rows)


def rewrite_live(log: DataFrame, keys: Sequence[str], commit_id: int, committed_at: str, order: Sequence[str] = ()) -> DataFrame:
    """Step 2: the live rows written anew, so that no file of the current version holds an erased row."""
    live = V.as_of_version(log, keys, F.lit(1 << 60), order=order).withColumns({
        "commit_id": F.lit(commit_id).cast("bigint"), "committed_at": F.lit(committed_at).cast("timestamp"),
        "branch": F.lit(V.MAIN), "op": F.lit("upsert")})
    return log.unionByName(live.select(*log.columns))


def sequence(log: DataFrame, erased: DataFrame, key: str, keys: Sequence[str], commit_id: int, committed_at: str,
             order: Sequence[str] = ()) -> dict[str, tuple[DataFrame, DataFrame]]:
    """After each step what its versions can reach and what storage still holds: delete, rewrite, expire, remove unreferenced.

    Expiry only cuts the references; the rows leave storage when unreferenced files are removed.
    """
    deleted = erase_from_log(log, erased, key, commit_id, committed_at, keys)
    rewritten = rewrite_live(deleted, keys, commit_id + 1, committed_at, order)
    expired = V.expire(rewritten, keys, [commit_id + 1], order)
    return {"requested": (log, log), "deleted": (deleted, deleted), "rewritten": (rewritten, rewritten),
            "expired": (expired, rewritten), "unreferenced_removed": (expired, expired)}


def attest(steps: Mapping[str, tuple[DataFrame, DataFrame]], erased: DataFrame, key: str, keys: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """Per step: rows of the keys that a reader sees, that any version reaches, that storage holds; rows of all others; the verdict."""
    ids = erased.select(key).distinct().withColumn("__gone", F.lit(True))
    rows = []
    for name, (reached, stored) in steps.items():
        now = V.as_of_version(reached, keys, F.lit(1 << 60), order=order).join(ids, key, "left").agg(
            F.count_if("__gone").alias("visible_rows"), F.count_if(F.col("__gone").isNull()).alias("live_rows"))
        held = lambda df: df.where("op <> 'delete'").join(ids, key, "left_semi").agg(F.count("*")).scalar()
        rows.append(now.select(F.lit(name).alias("step"), "visible_rows", held(reached).alias("rows_in_history"),
                               held(stored).alias("rows_stored"), "live_rows"))
    told = reduce(DataFrame.unionByName, rows)
    return told.withColumn("erased", F.col("visible_rows") + F.col("rows_in_history") + F.col("rows_stored") == 0)


def scope_check(tables: Mapping[str, tuple[DataFrame, str]], erased: DataFrame, key: str,
                landed: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Residual rows per table after the erasure of the whole scope; ``landed`` holds what arrived in a table since."""
    return E.residual_rows(E.with_arrivals(E.erase(tables, erased, key), landed or {}), erased, key)
