"""Writers: overwrite rules, file layout, bucketing, reports."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.scalar import bucket_of


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole data set."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite").format("parquet")
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(table)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions the data holds; running it twice changes nothing."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def create_or_overwrite_partitions(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").partitionBy(*partition_by).saveAsTable(table)
        return
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    columns = spark.table(table).columns
    df.select(*columns).write.mode("overwrite").insertInto(table)


def create_table_as(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """CTAS in SQL, plain or partitioned."""
    spark = df.sparkSession
    view = "__ctas_" + table.replace(".", "_")
    df.createOrReplaceTempView(view)
    parts = f"PARTITIONED BY ({', '.join(partition_by)}) " if partition_by else ""
    spark.sql(f"CREATE TABLE {table} USING parquet {parts}AS SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


def merge_into(path: str, source: DataFrame, keys: Sequence[str], partition: str, **rules) -> list:
    """Merge a batch into a partitioned data set, reading and rewriting only the partitions it touches.

    ``rules`` are those of ``changes.merge``. Touched are the partitions of the batch,
    NULL among them, and those that hold a key of the batch now: a key that moves
    leaves its old partition. Their values, one per folder, become literals, so the
    scan is pruned to them. A partition that is left without rows is removed.
    Returns the values of the batch's and the moved keys' partitions.
    """
    from lakeops.operators import changes
    spark = source.sparkSession
    keys = [k for k in keys if k != partition] or list(keys)
    table = spark.read.parquet(path)
    kind = table.schema[partition].dataType
    source = source.withColumn(partition, F.col(partition).cast(kind))
    own = source.select(partition).distinct()
    moved = table.select(*keys, partition).join(source.select(*keys), list(keys), "left_semi").select(partition).distinct()
    touched = [r[0] for r in own.union(moved).distinct().collect()]
    if not touched:
        return touched
    known = [v for v in touched if v is not None]
    here = F.col(partition).isin(known) if known else F.lit(False)
    if None in touched:
        here = here | F.col(partition).isNull()
    if "update" in rules and rules["update"] is not None:
        rules["update"] = list(dict.fromkeys([*rules["update"], partition]))
    merged = changes.merge(table.where(here), source, keys, **rules)
    left = {r[0] for r in merged.select(partition).distinct().collect()}
    overwrite_partitions(merged, path, [partition])
    for value in touched:
        if value not in left:
            remove_partition(spark, path, partition, value)
    return touched


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return bool(files.exists(where))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that is of no more use."""
    where, files = _file_system(spark, path)
    files.delete(where, True)


def _partition_folder(spark: SparkSession, partition: str, value) -> str:
    # Spark itself says how it spells the value in a folder name
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(
        partition, None if value is None else str(value))


def remove_partition(spark: SparkSession, path: str, partition: str, value) -> None:
    """Delete the folder of one partition value."""
    where, files = _file_system(spark, f"{path.rstrip('/')}/{_partition_folder(spark, partition, value)}")
    files.delete(where, True)


def replace_slice(df: DataFrame, path: str, values: Mapping[str, object], check: Callable[[DataFrame], object]) -> None:
    """Write one partition's rows beside the data set, run ``check`` on what was written, then put it in the place of the partition.

    ``df`` is computed once, so a check of what is hard to read (text files) costs no second reading.
    ``values`` are the partition columns in their order; ``df`` need not have them. Where ``check`` raises, the
    partition stays as it was and the new rows are removed. Readers skip the folder the rows wait in.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    staged = f"{root}/.staged-{uuid.uuid4().hex}"
    waiting, files = _file_system(spark, staged)
    try:
        df.drop(*values).write.option("compression", "zstd").parquet(staged)
        check(spark.read.parquet(staged))
        place, _ = _file_system(spark, "/".join([root, *[_partition_folder(spark, c, v) for c, v in values.items()]]))
        files.mkdirs(place.getParent())
        files.delete(place, True)
        if not files.rename(waiting, place):
            raise OSError(f"could not move {staged} to {place}")
    finally:
        files.delete(waiting, True)


def single_csv(df: DataFrame, path: str) -> None:
    """One file for people to read; hand it statements, not tables."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def ml_split(df: DataFrame, path: str, features: Sequence[str], label: str | None = None,
             key: str | None = None) -> None:
    """Headerless CSV with the label (or key) first, everything else as double, missing as 0."""
    first = [F.col(c) for c in (label, key) if c]
    df.select(*first, *[F.col(c).cast("double").alias(c) for c in features]).na.fill(0).write.mode(
        "overwrite").option("header", False).csv(path)


def by_partition_keys(df: DataFrame, keys: Sequence[str], sort_by: Sequence[str] = (),
                      salt_buckets: int = 1, salt_on: Sequence[str] = ()) -> DataFrame:
    """Distribute by partition value before a write, so that one partition is not scattered over all tasks.

    ``salt_buckets`` spreads every partition over that many tasks by a hash of
    ``salt_on``; a hash gives the same split when a task is run again.
    """
    salt: list[Column] = []
    if salt_buckets > 1:
        salt = [bucket_of(list(salt_on or df.columns), salt_buckets)]
    out = df.repartition(*[F.col(k) for k in keys], *salt)
    return out.sortWithinPartitions(*sort_by) if sort_by else out


def file_count(df: DataFrame, n: int, shuffle: bool = False) -> DataFrame:
    return df.repartition(n) if shuffle else df.coalesce(n)


def bucketed_table(df: DataFrame, table: str, key: str, buckets: int, sort_by: str | None = None) -> None:
    """Bucketed and sorted table; tables joined on the key must share the bucket count."""
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(sort_by or key).saveAsTable(table)


def refresh_window(current: DataFrame, recomputed: DataFrame, cond: Column) -> DataFrame:
    """Materialised aggregate after its window is deleted and inserted again."""
    return current.where(~F.coalesce(cond, F.lit(False))).unionByName(recomputed.where(cond))


def replace_dates(current: DataFrame, staged: DataFrame, day: str) -> DataFrame:
    """Staged rows replace every row of the dates they carry."""
    return current.join(staged.select(day).distinct(), day, "left_anti").unionByName(staged)


def json_report(df: DataFrame, path: str) -> None:
    df.repartition(1).write.mode("overwrite").json(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
