"""Structured Streaming forms of the micro-batch and late-data rules."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.windows import latest_wins
from lakeops.sinks.writers import merge_into, overwrite_partitions, path_exists


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None],
                  mode: str = "append") -> StreamingQuery:
    """Process what is there in micro-batches, then stop; ``each`` must be idempotent per batch id."""
    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).foreachBatch(each).start())
    q.awaitTermination()
    return q


def upsert_each(path: str, keys: Sequence[str], partition: str, order: Sequence[str],
                newer: tuple[str, str]) -> Callable[[DataFrame, int], None]:
    """Batch function that merges late and corrected rows into a partitioned data set.

    A batch is collapsed to its last row per key, and a stored row gives way only to
    a newer one, so a batch that runs twice changes nothing.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        last = latest_wins(batch, [k for k in keys if k != partition] or keys, [F.col(c).desc() for c in order])
        if not path_exists(batch.sparkSession, path):
            overwrite_partitions(last, path, [partition])      # first batch
            return
        merge_into(path, last, keys, partition, newer=newer)

    return each


def tumbling(stream: DataFrame, ts: str, window: str, late: str, keys: Sequence[str],
             aggs: dict[str, Column]) -> DataFrame:
    return (stream.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), *keys).agg(*_named(aggs))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                    *aggs))


def sessions(stream: DataFrame, ts: str, gap: str, late: str, keys: Sequence[str],
             aggs: dict[str, Column]) -> DataFrame:
    """Sessions per key: a gap of exactly ``gap`` stays in the session's reach, a longer one closes it."""
    return (stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(*_named(aggs))
            .select(F.col("w.start").alias("session_start"), *keys, *aggs))


def rolling(stream: DataFrame, ts: str, window: str, slide: str, late: str, keys: Sequence[str],
            aggs: dict[str, Column]) -> DataFrame:
    return (stream.withWatermark(ts, late).groupBy(F.window(ts, window, slide).alias("w"), *keys).agg(*_named(aggs))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                    *aggs))


def dedup_late(stream: DataFrame, ts: str, late: str, keys: Sequence[str]) -> DataFrame:
    """First copy of a key within the lateness bound."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def _named(aggs: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in aggs.items()]
