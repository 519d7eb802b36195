"""Readers: declared schemas, layers, audit columns, partition and time ranges."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


class MissingInput(FileNotFoundError):
    """A required input of a job is not there."""


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_keep_malformed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Malformed lines stay, whole, in ``_corrupt``."""
    return (spark.read.schema(schema + ", _corrupt string").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").json(path))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_positional(spark: SparkSession, path: str, names: Sequence[str],
                        casts: dict[str, str] | None = None) -> DataFrame:
    """Headerless CSV: names by position, then casts; values that do not parse become NULL."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.schema(schema).option("header", False).csv(path)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in (casts or {}).items()})


def split_fixed_width(lines: DataFrame, layout: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Fields of positional text in column ``value``: (name, first character from 1, length), trimmed."""
    return lines.select(*[F.trim(F.substring("value", start, length)).alias(name) for name, start, length in layout])


def read_fixed_width(spark: SparkSession, path: str, layout: Sequence[tuple[str, int, int]]) -> DataFrame:
    return split_fixed_width(spark.read.text(path), layout)


def in_range(df: DataFrame, start: str, end: str, partition: str = "dt", event_time: str = "event_ts") -> DataFrame:
    """Rows in [start, end): the date of the partition column prunes, the event time is exact."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    last = F.to_date(hi - F.expr("INTERVAL 0.000001 SECONDS"))
    return df.where(F.col(partition).between(F.to_date(lo), last)).where(
        (F.col(event_time) >= lo) & (F.col(event_time) < hi))


def read_range(spark: SparkSession, path: str, start: str, end: str, partition: str = "dt",
               event_time: str = "event_ts") -> DataFrame:
    return in_range(spark.read.parquet(path), start, end, partition, event_time)


def read_layer(spark: SparkSession, root: str | None, layer: str, table: str) -> DataFrame:
    """A table of a layer: a folder below ``root``, or the catalog when there is no root."""
    return spark.read.parquet(f"{root}/{layer}/{table}") if root else spark.read.table(f"{layer}.{table}")


def read_hive_style(spark: SparkSession, base: str, pattern: str, schema: str | None = None,
                    fmt: str = "parquet") -> DataFrame:
    """Files by wildcard with the partition columns of the whole tree kept."""
    reader = spark.read.format(fmt).option("basePath", base)
    return (reader.schema(schema) if schema else reader).load(f"{base}/{pattern}")


def read_required(spark: SparkSession, path: str, what: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise MissingInput(f"{what} missing at {path}") from exc


def read_drifting(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose schema grew over time: columns of every file, NULL where a file lacks one."""
    return spark.read.option("mergeSchema", True).parquet(path)


def with_audit(df: DataFrame, batch_id: str, extract_date: str) -> DataFrame:
    """Source file, ingest time, batch and extract date; call it directly on a file scan."""
    return df.select("*", F.col("_metadata.file_path").alias("_src_file"),
                     F.current_timestamp().alias("_ingested_at"), F.lit(batch_id).alias("_batch_id"),
                     F.lit(extract_date).cast("date").alias("extract_date"))


def lookup_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def late_window(run_date: str, hours: int) -> tuple[str, str]:
    """Half-open [start, end): the run date and the ``hours`` before it."""
    end = datetime.strptime(run_date, "%Y-%m-%d") + timedelta(days=1)
    start = end - timedelta(hours=24 + hours)
    return start.strftime("%Y-%m-%d %H:%M:%S"), end.strftime("%Y-%m-%d %H:%M:%S")
