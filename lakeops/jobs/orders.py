"""Orders from raw files to cleaned, typed, deduplicated tables and revenue."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import schemas
from lakeops.functions.scalar import as_double, net_amount
from lakeops.operators.windows import latest_wins, top_n
from lakeops.sources import readers


def bronze_orders(spark: SparkSession, path: str, batch_id: str, extract_date: str) -> DataFrame:
    return readers.with_audit(readers.read_json(spark, path, schemas.ORDERS_RAW), batch_id, extract_date)


def bronze_items(spark: SparkSession, path: str, batch_id: str, extract_date: str) -> DataFrame:
    return readers.with_audit(readers.read_csv(spark, path, schemas.ORDER_ITEMS_RAW), batch_id, extract_date)


def silver_orders(bronze: DataFrame) -> DataFrame:
    """One row per order: the version that was ingested last."""
    ts = F.to_timestamp("order_ts")
    cleaned = bronze.select(
        "order_id", "customer_id", F.lower(F.trim("customer_email")).alias("customer_email"),
        F.upper(F.trim("region")).alias("region"), F.coalesce("channel", F.lit("unknown")).alias("channel"),
        F.lower(F.trim("order_status")).alias("order_status"), ts.alias("order_ts"), "currency", "promo_codes",
        F.to_timestamp("ingested_at").alias("ingested_at"), F.to_date(ts).alias("order_date"),
        F.col("ship_address.city").alias("city"), F.col("ship_address.state").alias("state"))
    return latest_wins(cleaned, ["order_id"], [F.col("ingested_at").desc(), F.col("order_status")])


def silver_items(bronze: DataFrame) -> DataFrame:
    gross = F.col("qty") * F.col("unit_price")
    return bronze.select(
        "order_id", "line_no", "sku", F.initcap(F.trim("department")).alias("department"), "qty", "unit_price",
        "discount_pct", F.round(gross, 2).alias("gross_amount"),
        F.round(gross * (1 - F.col("discount_pct")), 2).alias("net_amount"))


def medallion_revenue(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, nation: DataFrame,
                      region: DataFrame, best: int = 2) -> DataFrame:
    """Best months per region by completed revenue, over deduplicated lines."""
    lines = latest_wins(lineitem, ["l_orderkey", "l_linenumber"], [
        F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")])
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.upper(F.trim("r_name")).alias("region"))
    sales = (lines.join(orders.where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    monthly = sales.groupBy("region", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("lines"), F.sum(net_amount("l_extendedprice", "l_discount")).alias("net"))
    ranked = top_n(monthly, ["region"], [F.col("net").desc(), F.col("month")], best, "rank")
    return ranked.select("region", "month", "rank", "lines", as_double("net", "revenue"))
