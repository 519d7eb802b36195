"""Sources, sinks and layout on stored copies of the given tables (S, K, L), with what needs a write to show."""
from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops import schemas
from lakeops.functions import scalar as C
from lakeops.operators import changes, gates, layout, setops
from lakeops.plans import inspect
from lakeops.queries.state import TARGET, merge_sides
from lakeops.registry import query
from lakeops.session import ensure_checkpoint_dir
from lakeops.sinks import writers
from lakeops.sources import dialects, readers
from lakeops.streaming import streams


def folder(t) -> str:
    """A new folder below the shared one for a stored copy."""
    return f"{ensure_checkpoint_dir(t.spark)}/stored-{uuid.uuid4().hex}"


def table_name(kind: str) -> str:
    return f"lakeops_{kind}_{uuid.uuid4().hex}"


def dated(t):
    return t.events.withColumn("dt", F.to_date("ts"))


def per_day(df):
    return df.groupBy("dt").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


DT = "CAST(ts AS DATE)"
PER_DAY = f"SELECT {DT} AS dt, CAST(count(*) AS BIGINT) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1"


def by_day(t) -> str:
    """Stored events, one file a day."""
    path = folder(t)
    writers.overwrite(writers.by_partition_keys(dated(t), ["dt"], ["event_id"]), path, ["dt"])
    return path


# ------------------------------------------------------------------ sources
@query("S1_declared_json", """
    SELECT CAST(user_id AS VARCHAR) AS user_id, event_id AS source_lsn, value, event_type = 'error' AS _deleted FROM events""")
def s1(t):
    image = F.to_json(F.struct("user_id", "value"))
    op = F.when(F.col("event_type") == "error", "d").otherwise("u")
    millis = F.unix_millis("ts")
    source = F.struct(F.lit("events").alias("table"), F.col("event_id").alias("lsn"), millis.alias("ts_ms"))
    path = folder(t)
    t.events.select(F.to_json(F.struct(op.alias("op"), millis.alias("ts_ms"), source.alias("source"),
                                       image.alias("after")))).write.text(path)
    flat = changes.flatten_envelope(readers.read_json(t.spark, path, schemas.CDC_ENVELOPE), "user_id", {"value": "double"})
    return flat.select("user_id", "source_lsn", "value", "_deleted")


@query("S2_csv_with_header", """
    SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders""")
def s2(t):
    path = folder(t)
    t.orders.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_totalprice").write.option(
        "header", True).csv(path)
    return readers.read_csv(t.spark, path, "o_orderkey bigint, o_orderpriority string, day date, o_totalprice double")


@query("S3_positional_csv", """
    SELECT CAST(c_custkey AS VARCHAR) AS customer, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS score FROM customer""")
def s3(t):
    path = folder(t)
    score = F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(F.col("c_acctbal").cast("string"))
    t.customer.select("c_custkey", score.alias("score")).write.csv(path)
    return readers.read_csv_positional(t.spark, path, ["customer", "score"], {"score": "double"})


@query("S5_layer", "SELECT n_regionkey, CAST(count(*) AS BIGINT) AS n, TRUE AS found FROM nation GROUP BY 1")
def s5(t):
    root = folder(t)
    writers.overwrite(t.nation, f"{root}/silver/nation")
    return readers.read_layer(t.spark, root, "silver", "nation").groupBy("n_regionkey").agg(
        F.count("*").alias("n"), F.lit(True).alias("found"))


@query("S7_malformed_json", """
    SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
      CASE WHEN event_type = 'error' THEN '{broken ' || event_id END AS corrupt FROM events""")
def s7(t):
    path = folder(t)
    whole = F.to_json(F.struct("event_id", "user_id"))
    t.events.select(F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), F.col("event_id"))).otherwise(
        whole)).write.text(path)
    read = readers.read_json_keep_malformed(t.spark, path, "event_id bigint, user_id bigint")
    return read.select("event_id", F.col("_corrupt").alias("corrupt"))


DIALECT_LEGS = """
    SELECT '49' || l_orderkey AS a_number, CAST(count(*) AS BIGINT) AS legs, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS seconds,
      CAST(sum(l_linenumber) AS BIGINT) AS units, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS charge,
      strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS first_ts FROM lineitem GROUP BY 1"""


# a gzipped file is read by one task, so a file holds few legs; tasks read several
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100_000}


def _pre_decoded(t):
    """All line items as legs in the columns of tap3."""
    a, b = (F.concat(F.lit(p), F.col(c).cast("string")) for p, c in (("49", "l_orderkey"), ("44", "l_partkey")))
    return t.lineitem.select(
        a.alias("callingNumber"), b.alias("calledNumber"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("callEventStartTimeStamp"),
        F.col("l_quantity").cast("int").alias("totalCallEventDuration"), F.col("l_linenumber").alias("chargedUnits"),
        C.money("l_extendedprice").alias("chargeAmount"))


def _partner_file(t, dialect: str, legs=None) -> str:
    """The legs, of all line items if not given, in the format of a partner; text comes gzipped."""
    path, legs = folder(t), _pre_decoded(t) if legs is None else legs
    a, b, at, seconds, units, amount = (F.col(c) for c in legs.columns)
    part = lambda *starts: F.concat(*[F.substring(at, start, n) for start, n in starts])
    day, time = part((9, 2), (6, 2), (1, 4)), part((12, 2), (15, 2), (18, 2))
    if dialect == "tap3":
        legs.write.option("compression", "zstd").parquet(path)
    elif dialect == "csv_v1":
        # digits and points only, so a line needs no quotes; a missing value is an empty field
        fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (a, b, day, time, seconds, units, amount)]
        legs.select(F.concat_ws(",", *fields)).write.options(**GZIP).text(path)
    elif dialect == "csv_v2":
        minutes = (seconds.cast("decimal(18,0)") / F.lit(60)).cast("decimal(18,6)")
        legs.select(a.alias("calling_msisdn"), b.alias("called_msisdn"), at.alias("start_time"), minutes.alias("duration_minutes"),
                    units.alias("billed_units"), amount.alias("net_amount")).write.options(**GZIP).option("header", True).csv(path)
    else:
        digits = lambda c, n: F.lpad(c.cast("string"), n, "0")
        cents = (amount * 10 ** dialects.IMPLIED_DECIMALS).cast("bigint")
        stamp = part((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))
        legs.select(F.concat(F.rpad(a, 15, " "), F.rpad(b, 15, " "), stamp,
                             digits(seconds, 8), digits(units, 8), digits(cents, 15))).write.options(**GZIP).text(path)
    return path


def _legs_query(dialect: str):
    def legs(t):
        read = dialects.ingest_partner(t.spark, _partner_file(t, dialect), dialect, "DTAG", "EUR", "2026-09-03")
        return read.groupBy("a_number").agg(
            F.count("*").alias("legs"), F.sum("duration_sec").alias("seconds"), F.sum("charged_units").alias("units"),
            C.as_double(F.sum("charge_amount"), "charge"), C.stamp(F.min("event_ts")).alias("first_ts"))
    return legs


for _name, _dialect in (("S8_dialect_fixed_width", "fixed_width"), ("S9_dialect_nested_names", "tap3"),
                        ("S9_dialect_split_time", "csv_v1"), ("S9_dialect_minutes", "csv_v2")):
    query(_name, DIALECT_LEGS)(_legs_query(_dialect))


@query("E13_partner_ingest", """
    SELECT source_format, partner_code, 'EUR' AS currency, CAST(count(*) AS BIGINT) AS legs, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS charge
    FROM lineitem, (VALUES ('fixed_width', 'A'), ('tap3', 'B'), ('csv_v1', 'C'), ('csv_v2', 'D')) AS p(source_format, partner_code) GROUP BY 1, 2""")
def e13(t):
    out, tap3 = folder(t), _partner_file(t, "tap3")

    def deliver(dialect, partner):
        path = tap3 if dialect == "tap3" else _partner_file(t, dialect, t.spark.read.parquet(tap3))
        for _ in range(2):      # a partner's file that comes twice replaces its own slice
            dialects.load_partner(t.spark, path, dialect, partner, "EUR", "2026-09-03", out)
        if path != tap3:        # the other files are made from that one
            writers.remove(t.spark, path)

    partners = (("fixed_width", "A"), ("tap3", "B"), ("csv_v1", "C"), ("csv_v2", "D"))
    with ThreadPoolExecutor(2) as pool:     # a run per partner, two side by side: a delivered file and the slice that waits take room
        for run in [pool.submit(inheritable_thread_target(t.spark)(deliver), *p) for p in partners]:
            run.result()
    return t.spark.read.parquet(out).groupBy("source_format", "partner_code", "currency").agg(
        F.count("*").alias("legs"), C.as_double(F.sum("charge_amount"), "charge"))


@query("S10_hive_wildcard", """
    SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n FROM orders
    WHERE year(o_orderdate) = 1998 GROUP BY 1, 2""")
def s10(t):
    path, keys = folder(t), ["o_orderstatus", "year"]
    orders = t.orders.withColumn("year", F.year("o_orderdate"))
    writers.overwrite(writers.by_partition_keys(orders, keys), path, keys)
    return readers.read_hive_style(t.spark, path, "o_orderstatus=*/year=1998").groupBy(*keys).agg(F.count("*").alias("n"))


@query("S11_audit_by_file", """
    SELECT o_orderkey, 'orders.parquet' AS src_file, 'batch-7' AS _batch_id, DATE '2002-01-01' AS extract_date, TRUE AS stamped FROM orders""")
def s11_file(t):
    named = F.regexp_extract("_src_file", r"([^/]+\.parquet)", 1)
    return readers.with_audit(t.orders, "batch-7", "2002-01-01").select(
        "o_orderkey", named.alias("src_file"), "_batch_id", "extract_date", F.col("_ingested_at").isNotNull().alias("stamped"))


@query("S16_schema_drift", """
    SELECT CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderpriority END AS o_orderpriority, CAST(count(*) AS BIGINT) AS n
    FROM orders GROUP BY 1""")
def s16(t):
    path, late = folder(t), F.col("o_orderdate") >= "2000-01-01"
    writers.overwrite(t.orders.where(~late).drop("o_orderpriority"), path)
    writers.append(t.orders.where(late), path)
    return readers.read_drifting(t.spark, path).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ sinks
@query("K1_overwrite", PER_DAY)
def k1(t):
    path = folder(t)
    for df in (dated(t).withColumn("user_id", F.lit(0)), dated(t)):     # the second replaces the first
        writers.overwrite(writers.by_partition_keys(df, ["dt"]), path, ["dt"])
    return per_day(t.spark.read.parquet(path))


@query("K2_replace_table", "SELECT n_regionkey, CAST(count(*) AS BIGINT) AS n FROM nation GROUP BY 1")
def k2(t):
    name = table_name("replaced")
    for df in (t.nation.unionByName(t.nation), t.nation):
        writers.replace_table(df, name)
    return t.spark.table(name).groupBy("n_regionkey").agg(F.count("*").alias("n"))


@query("K3_append", f"""
    SELECT {DT} AS dt, CAST(count(*) + count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS n,
      CAST(sum(user_id) + COALESCE(sum(user_id) FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT) AS users FROM events GROUP BY 1""")
def k3(t):
    path = by_day(t)
    writers.append(dated(t).where("event_type = 'purchase'"), path, ["dt"])
    return per_day(t.spark.read.parquet(path))


AFTER_OVERWRITE = f"""
    SELECT {DT} AS dt, CAST(count(*) AS BIGINT) AS n, CAST(sum(user_id + CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 1000 ELSE 0 END) AS BIGINT) AS users
    FROM events GROUP BY 1"""


def second_half(t):
    return dated(t).where("ts >= TIMESTAMP '2024-01-15'").withColumn("user_id", F.col("user_id") + 1000)


@query("K4_dynamic_overwrite", AFTER_OVERWRITE)
def k4(t):
    path = by_day(t)
    writers.overwrite_partitions(writers.by_partition_keys(second_half(t), ["dt"]), path, ["dt"])
    return per_day(t.spark.read.parquet(path))


@query("K5_slice_overwrite", """
    SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n,
      CAST(sum(CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) = 1998 THEN 0 ELSE o_custkey END) AS BIGINT) AS customers FROM orders GROUP BY 1, 2""")
def k5(t):
    path, keys = folder(t), ["o_orderstatus", "year"]
    orders = t.orders.withColumn("year", F.year("o_orderdate"))
    writers.overwrite_partitions(writers.by_partition_keys(orders, keys), path, keys)
    writers.overwrite_partitions(orders.where("o_orderstatus = 'F' AND year = 1998").withColumn(
        "o_custkey", F.lit(0).cast("bigint")), path, keys)
    return t.spark.read.parquet(path).groupBy(*keys).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("customers"))


@query("K6_create_or_overwrite", AFTER_OVERWRITE)
def k6(t):
    name = table_name("dated")
    for df in (dated(t), second_half(t)):
        writers.create_or_overwrite_partitions(writers.by_partition_keys(df, ["dt"]), name, ["dt"])
    return per_day(t.spark.table(name))


@query("K7_create_table_as", f"SELECT 'parted' AS kind, * FROM ({PER_DAY}) UNION ALL SELECT 'plain', * FROM ({PER_DAY})")
def k7(t):
    out = None
    for kind, parts in (("parted", ["dt"]), ("plain", [])):
        name = table_name("ctas")
        writers.create_table_as(dated(t).select("event_id", "user_id", "dt"), name, parts)
        one = per_day(t.spark.table(name)).select(F.lit(kind).alias("kind"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("K8_single_csv", "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, CAST(1 AS BIGINT) AS files FROM orders GROUP BY 1")
def k8(t):
    path = folder(t)
    writers.single_csv(t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")), path)
    read = readers.read_csv(t.spark, path, "o_orderstatus string, n bigint")
    files = read.agg(F.countDistinct("_metadata.file_path").alias("files"))
    return read.withColumn("files", files.scalar())


@query("K9_ml_split", """
    SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS label, o_totalprice AS price, CASE WHEN o_orderpriority = '5-LOW' THEN 0.0::DOUBLE ELSE CAST(o_custkey AS DOUBLE) END AS customer
    FROM orders""")
def k9(t):
    path = folder(t)
    wide = t.orders.select((F.col("o_orderstatus") == "F").cast("int").alias("label"), F.col("o_totalprice").alias("price"),
                           F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer"))
    writers.ml_split(wide, path, ["price", "customer"], label="label")
    return readers.read_csv_positional(t.spark, path, ["label", "price", "customer"], {
        "label": "int", "price": "double", "customer": "double"})


@query("K10_distributed_write", f"SELECT {DT} AS dt, CAST(1 AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY 1")
def k10(t):
    stats = layout.file_stats(t.spark.read.parquet(by_day(t)), partition_by=["dt"])
    return stats.groupBy("dt").agg(F.count("*").alias("files"), F.sum("records").alias("records"))


@query("K11_file_count", "SELECT CAST(7 AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS records FROM events")
def k11(t):
    path = folder(t)
    writers.overwrite(writers.file_count(t.events, 7, shuffle=True), path)
    return layout.file_stats(t.spark.read.parquet(path)).agg(F.count("*").alias("files"), F.sum("records").alias("records"))


@query("K12_salted_write", f"SELECT {DT} AS dt, CAST(count(*) AS BIGINT) AS records, TRUE AS within FROM events GROUP BY 1")
def k12(t):
    path = folder(t)
    writers.overwrite(writers.by_partition_keys(dated(t), ["dt"], salt_buckets=4, salt_on=["event_id"]), path, ["dt"])
    stats = layout.file_stats(t.spark.read.parquet(path), partition_by=["dt"])
    return stats.groupBy("dt").agg(F.sum("records").alias("records"), F.count("*").between(1, 4).alias("within"))


ORDER_LINES = """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price, 0 AS shuffles
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1"""


def bucketed_join(t, item_buckets: int, order_buckets: int):
    """The join of two bucketed tables, and the shuffles it takes."""
    items, orders = table_name("items"), table_name("orders")
    writers.bucketed_table(t.lineitem, items, "l_orderkey", item_buckets)
    writers.bucketed_table(t.orders, orders, "o_orderkey", order_buckets)
    joined = t.spark.table(orders).join(t.spark.table(items), F.col("o_orderkey") == F.col("l_orderkey"))
    with inspect.setting(t.spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        shuffles = inspect.count_shuffles(t.spark.table(orders).join(t.spark.table(items), F.col("o_orderkey") == F.col("l_orderkey")))
    return joined.groupBy("o_orderstatus").agg(F.count("*").alias("n"), C.as_double(F.sum(C.money("l_extendedprice")), "price"),
                                               F.lit(shuffles).alias("shuffles"))


@query("K13_bucketed_tables", ORDER_LINES)
def k13(t):
    return bucketed_join(t, 8, 8)


@query("J27_other_bucket_count", ORDER_LINES.replace("0 AS", "1 AS"))
def j27(t):
    """With different bucket counts one side is shuffled to the other's."""
    return bucketed_join(t, 8, 4)


@query("K16_json_report", """
    SELECT CAST(count(*) AS BIGINT) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, max(o_orderkey) AS last_order FROM orders""")
def k16(t):
    path = folder(t)
    writers.json_report(t.orders.agg(F.count("*").alias("orders"), C.as_double(F.sum(C.money("o_totalprice")), "total"),
                                     F.max("o_orderkey").alias("last_order")), path)
    return readers.read_json(t.spark, path, "orders bigint, total double, last_order bigint")


@query("K17_load_twice", PER_DAY)
def k17(t):
    path = folder(t)
    for _ in range(2):
        writers.overwrite_partitions(writers.by_partition_keys(dated(t), ["dt"]), path, ["dt"])
    return per_day(t.spark.read.parquet(path))


# ------------------------------------------------------------------ layout
@query("L1_file_bounds", f"""
    SELECT {DT} AS dt, CAST(count(*) AS BIGINT) AS records, min(user_id) AS min_user_id, max(user_id) AS max_user_id, min(value) AS min_value,
      max(value) AS max_value FROM events GROUP BY 1""")
def l1(t):
    stats = layout.file_stats(t.spark.read.parquet(by_day(t)), ["user_id", "value"], ["dt"])
    return stats.drop("file_path", "bytes")


@query("L2_pruning_estimate", f"""
    SELECT CAST(count(*) FILTER (WHERE hi >= 9000 AND lo <= 9100) AS BIGINT) AS files_matching, CAST(count(*) AS BIGINT) AS files_total
    FROM (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events GROUP BY {DT})""")
def l2(t):
    stats = layout.file_stats(t.spark.read.parquet(by_day(t)), ["event_id"])
    return layout.pruning_estimate(stats, {"event_id": (9000, 9100)})


SMALL_FILES = f"""
    SELECT {DT} AS dt, CAST(1 + max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS files,
      CAST(count(*) + count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS records,
      CAST(1 + max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS small_files,
      bool_or(event_type = 'purchase') AS needs_compaction FROM events GROUP BY 1"""


def diagnosis(t):
    path = by_day(t)
    writers.append(writers.by_partition_keys(dated(t).where("event_type = 'purchase'"), ["dt"]), path, ["dt"])
    stats = layout.file_stats(t.spark.read.parquet(path), partition_by=["dt"])
    return layout.partition_diagnosis(stats, ["dt"], max_files=1, small_bytes=1 << 40)


@query("L3_small_files", SMALL_FILES)
def l3(t):
    return diagnosis(t).select("dt", "files", "records", "small_files", "needs_compaction")


@query("A34_partition_files", f"SELECT dt, files, records, TRUE AS ordered FROM ({SMALL_FILES})")
def a34(t):
    ordered = (F.col("min_bytes") <= F.col("median_bytes")) & (F.col("avg_bytes") <= F.col("max_bytes")) & (F.col("min_bytes") > 0)
    return diagnosis(t).select("dt", "files", "records", ordered.alias("ordered"))


@query("S14_file_statistics", f"SELECT CAST(count(DISTINCT {DT}) AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS records, TRUE AS sized FROM events")
def s14(t):
    path = by_day(t)
    listed = layout.listed_files(t.spark, path).agg(F.sum("length").alias("listed"))
    stats = layout.file_stats(t.spark.read.parquet(path))
    return stats.agg(F.count("*").alias("files"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes")).withColumn(
        "sized", F.col("bytes") == listed.scalar()).drop("bytes")


def _compaction(strategy: str, columns: list[str]):
    def compacted(t):
        path, out = by_day(t), folder(t)
        layout.compact(t.spark, path, out, strategy=strategy, columns=columns, rewrite_all=True)
        stats = layout.file_stats(t.spark.read.parquet(out), ["user_id", "value"], ["dt"])
        return stats.groupBy("dt").agg(F.sum("records").alias("n"), F.min("min_user_id").alias("low"), F.max("max_value").alias("high"))
    return compacted


for _name, _strategy, _columns in (("L4_compact_binpack", "binpack", []), ("L5_compact_sorted", "sort", ["user_id", "ts"]),
                                   ("L6_compact_zorder", "zorder", ["user_id", "ts"])):
    query(_name, f"SELECT {DT} AS dt, CAST(count(*) AS BIGINT) AS n, min(user_id) AS low, max(value) AS high FROM events GROUP BY 1")(
        _compaction(_strategy, _columns))


@query("L8_files_after_batches", """
    SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS batches, CAST(sum(count(*)) OVER (ORDER BY event_type) AS BIGINT) AS records,
      TRUE AS files_apart, TRUE AS files_grow FROM events GROUP BY event_type""")
def l8(t):
    """Stored files after each micro-batch; a batch writes as many files as it has tasks, and its number is stored with its rows."""
    path, seen, last = folder(t), [], 0
    kinds = sorted(r[0] for r in t.events.select("event_type").distinct().collect())    # one batch per kind of event
    for k, kind in enumerate(kinds):
        writers.append(t.events.where(F.col("event_type") == kind).withColumn("batch", F.lit(k)), path)
        # one row a batch, taken now: Spark holds two scans of one folder for the same, whatever files lie in it
        stats = layout.file_stats(t.spark.read.parquet(path), ["batch"]).agg(
            F.count("*").alias("files"), F.count_distinct("min_batch").alias("batches"), F.sum("records").alias("records"),
            F.bool_and(F.col("min_batch") == F.col("max_batch")).alias("apart")).first()
        seen.append((kind, stats["batches"], stats["records"], stats["apart"], stats["files"] > last))
        last = stats["files"]
    return t.spark.createDataFrame(seen, "event_type string, batches bigint, records bigint, files_apart boolean, files_grow boolean")


@query("L9_rows_kept", "SELECT CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, CAST(count(*) AS BIGINT) AS in_both FROM events")
def l9(t):
    path, out = by_day(t), folder(t)
    layout.compact(t.spark, path, out, strategy="sort", columns=["user_id"], rewrite_all=True)
    before = t.spark.read.parquet(path)
    return setops.same_rows(before, t.spark.read.parquet(out).select(*before.columns))


@query("L9_content_hash", "SELECT count(*) AS rows_left, count(*) AS rows_right, TRUE AS same FROM events")
def l9_hash(t):
    path, out = by_day(t), folder(t)
    layout.compact(t.spark, path, out, strategy="sort", columns=["user_id"], rewrite_all=True)
    before = t.spark.read.parquet(path)
    return setops.same_content(before, t.spark.read.parquet(out).select(*before.columns))


@query("U5_row_changes_by_part", """
    WITH e AS (SELECT *, event_type = (SELECT min(event_type) FROM events) AND value > 50 AS moved FROM events)
    SELECT event_type, CAST(count(*) AS BIGINT) AS only_left, CAST(count(*) AS BIGINT) AS only_right FROM e WHERE moved GROUP BY 1""")
def u5_parts(t):
    first = t.events.agg(F.min("event_type")).scalar()
    edited = F.when((F.col("event_type") == first) & (F.col("value") > 50), -F.col("value")).otherwise(F.col("value"))
    return setops.row_changes(t.events, t.events.withColumn("value", edited), ["event_type"])


@query("L10_unreferenced_files", f"SELECT DISTINCT strftime({DT}, '%Y-%m-%d') AS dt FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def l10(t):
    path = by_day(t)
    known = layout.file_stats(t.spark.read.parquet(path).where("dt < DATE '2024-01-15'")).select("file_path")
    later = F.current_timestamp() + F.expr("INTERVAL 10 DAYS")
    found = layout.unreferenced_files(layout.listed_files(t.spark, path), known, later)
    return found.select(F.regexp_extract("path", "dt=([0-9-]+)", 1).alias("dt"))


@query("L11_fault_isolation", """
    SELECT 'nation' AS table_name, TRUE AS done, CAST(count(*) AS VARCHAR) AS detail FROM nation
    UNION ALL SELECT 'no_such_table', FALSE, NULL UNION ALL SELECT 'orders', TRUE, CAST(count(*) AS VARCHAR) FROM orders""")
def l11(t):
    done = layout.for_each_table(t.spark, ["nation", "no_such_table", "orders"], lambda name: getattr(t, name).count())
    return done.select("table_name", "done", F.when(F.col("done"), F.col("detail")).alias("detail"))


@query("T20_partition_delete", f"SELECT * FROM ({PER_DAY}) WHERE dt <> DATE '2024-01-03'")
def t20(t):
    path = by_day(t)
    writers.remove_partition(t.spark, path, "dt", "2024-01-03")
    return per_day(t.spark.read.parquet(path))


# ------------------------------------------------------------------ distribution
@query("O2_local_sort", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS out_of_order FROM events")
def o2(t):
    """Rows that stand behind a later one in their partition, after a sort within partitions."""
    path = folder(t)
    t.events.repartition(8, "user_id").sortWithinPartitions("event_id").select(
        "event_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")).write.parquet(path)
    stored = t.spark.read.parquet(path)
    before = F.lag("event_id").over(Window.partitionBy("part").orderBy("place"))
    return stored.withColumn("before", before).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_id") < F.col("before")).alias("out_of_order"))


@query("O4_colocation", "SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS users, CAST(0 AS BIGINT) AS scattered FROM events")
def o4(t):
    placed = t.events.repartition(8, "user_id").select("user_id", F.spark_partition_id().alias("part")).distinct()
    return placed.groupBy("user_id").agg(F.count("*").alias("parts")).agg(
        F.count("*").alias("users"), F.count_if(F.col("parts") > 1).alias("scattered"))


@query("F22_bucket_of_key", "SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS users, CAST(0 AS BIGINT) AS scattered, TRUE AS inside FROM events")
def f22(t):
    placed = t.events.select("user_id", C.bucket_of(["user_id"], 16).alias("b")).distinct()
    return placed.groupBy("user_id").agg(F.count("*").alias("buckets"), F.min("b").alias("low"), F.max("b").alias("high")).agg(
        F.count("*").alias("users"), F.count_if(F.col("buckets") > 1).alias("scattered"),
        ((F.min("low") >= 0) & (F.max("high") < 16)).alias("inside"))


# ------------------------------------------------------------------ gates, merges, batches
@query("T5_duplicate_source_keys", """
    SELECT 'lineitem' AS batch, (SELECT count(*) = count(DISTINCT l_orderkey) FROM lineitem) AS accepted
    UNION ALL SELECT 'orders', (SELECT count(*) = count(DISTINCT o_orderkey) FROM orders)""")
def t5(t):
    def accepted(source, keys):
        try:
            changes.require_unique(source, keys)
        except changes.DuplicateSourceKeys:
            return False
        return True
    return t.spark.createDataFrame([("lineitem", accepted(t.lineitem, ["l_orderkey"])), ("orders", accepted(t.orders, ["o_orderkey"]))],
                                   "batch string, accepted boolean")


@query("G1_not_empty", """
    SELECT 'not_empty' AS gate, least(count(*), 1) AS rows_seen, count(*) > 0 AS passed FROM orders
    UNION ALL SELECT 'not_empty', least(count(*), 1), count(*) > 0 FROM orders WHERE o_totalprice < 0""")
def g1(t):
    return gates.not_empty(t.orders).unionByName(gates.not_empty(t.orders.where("o_totalprice < 0")))


@query("G17_rerun_totals", f"""
    SELECT 'same_totals' AS gate, CAST(count(*) AS BIGINT) AS rows_before, CAST(sum(amount) AS DOUBLE) AS amount_before,
      CAST(count(*) AS BIGINT) AS rows_after, CAST(sum(amount) AS DOUBLE) AS amount_after, TRUE AS passed
    FROM (SELECT k, amount FROM {TARGET} WHERE k NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
          UNION ALL SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) + 1 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')""")
def g17(t):
    target, source = merge_sides(t)
    once = changes.merge(target, source, ["k"])
    twice = changes.merge(once, source, ["k"])
    out = gates.same_totals(once, twice, {"rows": F.count("*"), "amount": F.sum("amount")})
    return out.withColumns({c: C.as_double(c) for c in ("amount_before", "amount_after")})


@query("R1_micro_batches", f"""
    SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(user_id) AS BIGINT) AS users, (SELECT CAST(count(DISTINCT {DT}) AS BIGINT) FROM events) AS commits
    FROM events GROUP BY 1""")
def r1(t):
    """One file a micro-batch, each written under its batch id, so a batch that runs again replaces itself."""
    incoming, out, state = by_day(t), folder(t), folder(t)
    stream = streams.file_stream(t.spark, incoming, dated(t).schema, files_per_batch=1)
    streams.run_available(stream, state, lambda batch, number: writers.overwrite_partitions(
        batch.withColumn("batch_id", F.lit(number)), out, ["batch_id"]))
    stored = t.spark.read.parquet(out)
    commits = stored.agg(F.countDistinct("batch_id").alias("commits"))
    return stored.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users")).withColumn(
        "commits", commits.scalar())


@query("R2_stored_late_merge", """
    SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, CASE WHEN event_type = 'purchase' THEN -1.0::DOUBLE ELSE value END AS value FROM events""")
def r2(t):
    """Late rows (errors) and corrections (purchases) meet the stored state; older copies of clicks change nothing."""
    path, columns = folder(t), ["event_id", "ts", "value", "dt"]
    rows = dated(t)
    writers.overwrite(writers.by_partition_keys(rows.where("event_type <> 'error'").select(*columns), ["dt"]), path, ["dt"])
    second = F.expr("INTERVAL 1 MICROSECOND")
    fixed = rows.where("event_type = 'purchase'").withColumns({"value": F.lit(-1.0), "ts": F.col("ts") + second})
    stale = rows.where("event_type = 'click'").withColumns({"value": F.lit(-2.0), "ts": F.col("ts") - second})
    batch = rows.where("event_type = 'error'").unionByName(fixed).unionByName(stale).select(*columns)
    merge = streams.upsert_each(path, ["event_id"], "dt", ["ts"], ("ts", "ts"))
    for number in range(2):     # a batch that is delivered twice changes nothing
        merge(batch, number)
    return t.spark.read.parquet(path).select("event_id", F.date_format("dt", "yyyy-MM-dd").alias("day"), "value")
