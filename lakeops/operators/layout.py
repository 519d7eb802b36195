"""Data-file layout: statistics, pruning estimates, compaction, clustering, clean-up."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE = "_metadata.file_path"


def file_stats(files: DataFrame, columns: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
    """One row per data file: rows, bytes and the bounds of ``columns``. Wants a plain file scan."""
    bounds = [agg(c).alias(f"{name}_{c}") for c in columns for name, agg in (("min", F.min), ("max", F.max))]
    return files.groupBy(F.col(FILE).alias("file_path"), *partition_by).agg(
        F.count("*").alias("records"), F.max("_metadata.file_size").alias("bytes"), *bounds)


def partition_diagnosis(stats: DataFrame, partition_by: Sequence[str], max_files: int = 500,
                        small_bytes: int = 8 * 1024 * 1024) -> DataFrame:
    """Files, rows and sizes per partition, and whether the file count calls for compaction."""
    return stats.groupBy(*partition_by).agg(
        F.count("*").alias("files"), F.sum("records").alias("records"), F.avg("bytes").alias("avg_bytes"),
        F.min("bytes").alias("min_bytes"), F.max("bytes").alias("max_bytes"),
        F.percentile_approx("bytes", 0.5).alias("median_bytes"),
        F.count_if(F.col("bytes") < small_bytes).alias("small_files")).withColumn(
        "needs_compaction", F.col("files") > max_files)


def pruning_estimate(stats: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Files whose bounds can hold a row inside all ``ranges`` (column: (lowest, highest)), of all files."""
    may = F.lit(True)
    for c, (lo, hi) in ranges.items():
        may = may & (F.col(f"max_{c}") >= F.lit(lo)) & (F.col(f"min_{c}") <= F.lit(hi))
    return stats.agg(F.count_if(may).alias("files_matching"), F.count("*").alias("files_total"))


def target_partitions(total_bytes: int, target_bytes: int) -> int:
    return max(1, -(-int(total_bytes) // int(target_bytes)))


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per partition folder ("" for a flat data set), from a listing: no data is read."""
    inside = F.regexp_extract("path", r"((?:/[^/=]+=[^/]*)*)/[^/]*$", 1)
    return listed_files(spark, path).groupBy(inside.alias("folder")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))


def compact(spark: SparkSession, path: str, out: str, *, target_bytes: int = 512 * 1024 * 1024,
            min_input_files: int = 5, strategy: str = "binpack", columns: Sequence[str] = (),
            rewrite_all: bool = False) -> dict:
    """Rewrite a data set into files near the target size, to a new folder with the same partition folders.

    ``binpack`` merges, ``sort`` clusters by the columns, ``zorder`` clusters by all
    of them at once, each within a partition. A data set with few files is left
    alone unless ``rewrite_all``. Sizes come from the file listing. Returns the
    counts; swapping ``out`` in is the caller's step.
    """
    folders = _listing(spark, path)
    total = folders.agg(F.sum("files").alias("n"), F.sum("bytes").alias("s"), F.max("folder").alias("f"),
                        F.sum(F.ceil(F.col("bytes") / target_bytes)).alias("out")).first()
    files = total["n"] or 0
    if files < min_input_files and not rewrite_all:
        return {"rewritten": False, "files_before": files, "files_after": files}
    parts = [p.split("=")[0] for p in (total["f"] or "").split("/") if p]
    # a task for each file of a folder, or one task would sort all folders that fit a file together
    n = max(target_partitions(total["s"], target_bytes), total["out"])
    df = spark.read.parquet(path)
    if strategy == "binpack" and not parts:
        done = df.coalesce(n) if n < files else df.repartition(n)
    elif strategy == "binpack":
        done = df.repartitionByRange(n, *parts, F.xxhash64(*[c for c in df.columns if c not in parts]))
        done = done.sortWithinPartitions(*parts)
    elif strategy == "sort":
        done = df.repartitionByRange(n, *parts, *columns).sortWithinPartitions(*parts, *columns)
    elif strategy == "zorder":
        done = zorder(df, columns, n, first=parts)
    else:
        raise ValueError(f"unknown strategy {strategy}")
    writer = done.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*parts) if parts else writer).parquet(out)
    return {"rewritten": True, "files_before": files, "files_after": _listing(spark, out).agg(F.sum("files")).first()[0]}


def zorder(df: DataFrame, columns: Sequence[str], partitions: int, bits: int = 10, first: Sequence[str] = ()) -> DataFrame:
    """Cluster by the interleaved bits of each column's rank bucket.

    The buckets come from approximate quantiles, so spread does not depend on the
    value distribution: at most 2**bits values per column reach the plan. Strings
    are compared whole: their cuts are the bounds of as many ranges.
    ``first`` columns lead the order, plainly sorted.
    """
    n = 2 ** bits
    probabilities = [i / n for i in range(1, n)]
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if c not in texts]
    cuts = df.agg(F.lit(0), *[F.percentile_approx(_number(df, c), probabilities, 10_000).alias(c) for c in numbers]).first().asDict()
    cuts |= {c: _text_cuts(df, c, n) for c in texts}
    buckets = []
    for c in columns:
        marks = sorted(set(cuts[c] or []), key=lambda m: m.encode() if isinstance(m, str) else m)
        # a column with few values is stretched over the full range, or it would only decide the low bits
        buckets.append(F.floor(_bucket(F.col(c) if c in texts else _number(df, c), marks) * n / F.lit(len(marks) + 1)))
    value = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, bucket in enumerate(buckets):
            moved = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            value = value.bitwiseOR(F.shiftleft(moved, bit * len(buckets) + i))
    return (df.withColumn("__z", value).repartitionByRange(partitions, *first, "__z")
            .sortWithinPartitions(*first, "__z").drop("__z"))


def _text_cuts(df: DataFrame, c: str, parts: int) -> list[str]:
    """Lowest value of each of ``parts`` ranges of a string column, whole strings in byte order."""
    dealt = df.where(F.col(c).isNotNull()).select(c).repartitionByRange(parts, c)
    return [r[0] for r in dealt.groupBy(F.spark_partition_id()).agg(F.min(c)).select(f"min({c})").collect()]


def _number(df: DataFrame, c: str) -> Column:
    return F.col(c).cast("timestamp").cast("double") if isinstance(
        df.schema[c].dataType, (T.DateType, T.TimestampType)) else F.col(c).cast("double")


def _bucket(value: Column, cuts: Sequence[float], width: int = 32) -> Column:
    """Number of cuts at or below the value, by comparing block heads first."""
    blocks = [list(cuts[i:i + width]) for i in range(0, len(cuts), width)]
    if not blocks:
        return F.lit(0).cast("bigint")
    heads = F.array(*[F.lit(b[0]) for b in blocks])
    nested = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    block = F.greatest(F.size(F.filter(heads, lambda h: h <= value)), F.lit(1))
    inner = F.size(F.filter(F.element_at(nested, block), lambda x: x <= value))
    return F.when(value.isNull(), F.lit(0)).otherwise((block - 1) * width + inner).cast("bigint")


def compare_layouts(spark: SparkSession, layouts: dict[str, str], shapes: dict[str, dict[str, tuple]]) -> DataFrame:
    """Files, average size and files touched per query shape, one row per layout."""
    columns = sorted({c for ranges in shapes.values() for c in ranges})
    rows = None
    for name, path in layouts.items():
        stats = file_stats(spark.read.parquet(path), columns)
        touched = []
        for shape, ranges in shapes.items():
            may = F.lit(True)
            for c, (lo, hi) in ranges.items():
                may = may & (F.col(f"max_{c}") >= F.lit(lo)) & (F.col(f"min_{c}") <= F.lit(hi))
            touched.append(F.count_if(may).alias("touched_" + shape))
        one = stats.agg(F.count("*").alias("files"), F.avg("bytes").alias("avg_bytes"), *touched).select(
            F.lit(name).alias("layout"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """Every data file below a folder with its modification time."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", True).load(path).select("path", "modificationTime", "length")


class UnsafeInterval(ValueError):
    """Files this young may belong to a write that has not finished."""


def unreferenced_files(listing: DataFrame, referenced: DataFrame, now: Column, older_than_hours: int = 72,
                       allow_unsafe: bool = False) -> DataFrame:
    """Listed files that nothing references and that are older than the limit; deletes nothing."""
    if older_than_hours < 24 and not allow_unsafe:
        raise UnsafeInterval("an interval under 24 hours can catch files of a running write")
    old = listing.where(F.col("modificationTime") < now - F.expr(f"INTERVAL {int(older_than_hours)} HOURS"))
    bare = lambda c: F.regexp_replace(F.col(c), "^file:/+", "/")
    known = referenced.select(bare("file_path").alias("__p")).distinct()
    return old.withColumn("__p", bare("path")).join(known, "__p", "left_anti").drop("__p")


def for_each_table(spark: SparkSession, tables: Sequence[str], action: Callable[[str], object]) -> DataFrame:
    """Run one maintenance action per table; a failure is recorded and the rest go on."""
    rows = []
    for t in tables:
        try:
            rows.append((t, True, str(action(t))))
        except Exception as exc:  # recorded, and raised together by require_all_done
            rows.append((t, False, f"{type(exc).__name__}: {exc}"))
    return spark.createDataFrame(rows, "table_name string, done boolean, detail string")


def require_all_done(results: DataFrame) -> None:
    failed = results.where(~F.col("done")).collect()
    if failed:
        raise RuntimeError(f"{len(failed)} tables failed: " + "; ".join(f"{r.table_name}: {r.detail}" for r in failed))


def drop_partitions(spark: SparkSession, table: str, predicate: dict[str, str]) -> None:
    """Remove whole partitions of a catalog table; no other file is rewritten."""
    spec = ", ".join(f"{k}='{v}'" for k, v in predicate.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
