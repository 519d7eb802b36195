"""Strings are told apart by as many ranges as numbers."""
from pyspark.sql import functions as F

from lakeops.operators import layout


def test_zorder_spreads_strings_over_more_than_64_parts(spark):
    df = spark.range(20_000).select(F.concat(F.lit("customer-"), F.sha2(F.col("id").cast("string"), 256)).alias("name"))
    parts = layout.zorder(df, ["name"], 200).groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("name").alias("low"), F.max("name").alias("high"), F.count("*").alias("n")).orderBy("low").collect()
    assert sum(r["n"] for r in parts) == 20_000
    assert len(parts) > 150 and all(a["high"] < b["low"] for a, b in zip(parts, parts[1:]))
