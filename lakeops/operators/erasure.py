"""Deletes and erasure: delete sets, reconciliation, scope, evidence."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def copy_on_write(df: DataFrame, erased: DataFrame, key: str) -> DataFrame:
    """State rewritten without the erased keys."""
    return df.join(erased.select(key).distinct(), key, "left_anti")


def merge_on_read(base: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State read as base rows minus the delete set."""
    return base.join(deletes.select(*keys).distinct(), list(keys), "left_anti")


def position_deletes(files: DataFrame, cond) -> DataFrame:
    """Delete set by file and row position for the rows of a file scan where ``cond`` holds."""
    return files.where(cond).select(F.col("_metadata.file_path").alias("file_path"),
                                    F.col("_metadata.row_index").alias("row_index"))


def without_positions(files: DataFrame, deletes: DataFrame) -> DataFrame:
    located = files.select("*", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.row_index").alias("__i"))
    hidden = deletes.select(F.col("file_path").alias("__f"), F.col("row_index").alias("__i")).distinct()
    return located.join(hidden, ["__f", "__i"], "left_anti").drop("__f", "__i")


def delete_debt(base: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a reader must skip, one row: delete entries, hidden rows, live rows."""
    marks = deletes.select(*keys).distinct().withColumn("__gone", F.lit(True))
    rows = base.join(marks, list(keys), "left").agg(
        F.count_if("__gone").alias("hidden_rows"), F.count_if(F.col("__gone").isNull()).alias("live_rows"))
    return rows.withColumn("delete_entries", deletes.agg(F.count("*")).scalar())


def residual_rows(tables: Mapping[str, tuple[DataFrame, str]], erased: DataFrame, key: str) -> DataFrame:
    """Rows left per table for the erased keys; a table without any gives 0.

    ``tables`` maps a name to its data and the column that holds the key.
    """
    ids = erased.select(F.col(key).alias("__id")).distinct()
    parts = []
    for name, (df, column) in tables.items():
        hits = df.join(ids, F.col(column) == F.col("__id"), "left_semi")
        parts.append(hits.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def erase(tables: Mapping[str, tuple[DataFrame, str]], erased: DataFrame, key: str) -> dict[str, tuple[DataFrame, str]]:
    """Every table of the scope without the erased keys."""
    ids = erased.select(F.col(key).alias("__id")).distinct()
    return {name: (df.join(ids, F.col(column) == F.col("__id"), "left_anti"), column)
            for name, (df, column) in tables.items()}


def with_arrivals(tables: Mapping[str, tuple[DataFrame, str]], landed: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, str]]:
    """The tables with the rows that landed in them after the erasure, such as late files of a partner."""
    return {name: (df.unionByName(landed[name]) if name in landed else df, column) for name, (df, column) in tables.items()}


def audit_rows(tables: Mapping[str, tuple[DataFrame, str]], erased: DataFrame, key: str, mode: str) -> DataFrame:
    """What an erasure is about to remove, written before it runs."""
    before = residual_rows(tables, erased, key).withColumnRenamed("rows", "rows_targeted")
    return before.withColumns({"subjects": erased.agg(F.countDistinct(key)).scalar(), "delete_mode": F.lit(mode)})


def attestation(before: DataFrame, after: DataFrame, history: DataFrame, expires_at: str) -> DataFrame:
    """Evidence per table: rows before and after, rows history still reaches, and from when none does."""
    b = before.withColumnRenamed("rows", "rows_before")
    a = after.withColumnRenamed("rows", "rows_after")
    h = history.withColumnRenamed("rows", "rows_in_history")
    return (b.join(a, "table_name", "left").join(h, "table_name", "left")
            .withColumn("history_reachable", F.col("rows_in_history") > 0)
            .withColumn("unrecoverable_at", F.when(F.col("history_reachable"), F.lit(expires_at)))
            .withColumn("erased", (F.col("rows_after") == 0) & ~F.col("history_reachable")))
