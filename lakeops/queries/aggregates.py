"""Aggregations (A)."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import aggregates as A
from lakeops.functions import scalar as C
from lakeops.operators import scans as S
from lakeops.queries.projections import NET
from lakeops.registry import half_up, query

PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"


@query("A1_group_agg", f"""
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS lines, CAST(sum({NET}) AS DOUBLE) AS revenue,
           {half_up("CAST(sum(" + PRICE + ") AS DOUBLE) / count(*)", 2)} AS avg_line,
           min(l_extendedprice) AS min_line, max(l_extendedprice) AS max_line FROM lineitem GROUP BY 1, 2""")
def a1(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), C.as_double(F.sum(C.net_amount("l_extendedprice", "l_discount")), "revenue"),
        F.round(C.as_double(F.sum(C.money("l_extendedprice"))) / F.count("*"), 2).alias("avg_line"),
        F.min("l_extendedprice").alias("min_line"), F.max("l_extendedprice").alias("max_line"))


@query("A2_count_gap", """
    SELECT c_nationkey, CAST(count(*) AS BIGINT) AS customers, CAST(count(seg) AS BIGINT) AS with_segment,
           CAST(count(*) - count(seg) AS BIGINT) AS missing_segment
    FROM (SELECT c_nationkey, NULLIF(c_mktsegment, 'BUILDING') AS seg FROM customer) GROUP BY 1""")
def a2(t):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.count(seg).alias("with_segment"),
        (F.count("*") - F.count(seg)).alias("missing_segment"))


@query("A3_count_distinct", """
    SELECT o_orderstatus, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers,
           CAST(count(DISTINCT (o_custkey, o_orderpriority)) AS BIGINT) AS combos FROM orders GROUP BY 1""")
def a3(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.countDistinct("o_custkey").alias("customers"),
        F.countDistinct("o_custkey", "o_orderpriority").alias("combos"))


@query("A4_approx_distinct", "SELECT l_returnflag, TRUE AS within_5pct, TRUE AS within_1pct FROM lineitem GROUP BY 1")
def a4(t):
    # folded first: beside a distinct count Spark would keep a sketch for every value
    values = t.lineitem.select("l_returnflag", "l_partkey").distinct()
    g = values.groupBy("l_returnflag").agg(
        F.count("l_partkey").alias("exact"), F.approx_count_distinct("l_partkey").alias("default"),
        F.approx_count_distinct("l_partkey", 0.01).alias("fine"))
    near = lambda c, rsd: F.abs(F.col(c) - F.col("exact")) <= 4 * rsd * F.col("exact")
    return g.select("l_returnflag", near("default", 0.05).alias("within_5pct"), near("fine", 0.01).alias("within_1pct"))


@query("A4_distinct_sketch", "SELECT TRUE AS within_rsd FROM region LIMIT 1")
def a4_sketch(t):
    # one sketch per month, merged: the distinct count over months without a second pass
    monthly = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("m")).agg(
        F.hll_sketch_agg("o_custkey", 12).alias("sketch"))
    merged = monthly.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    near = merged.withColumn("exact", t.orders.agg(F.countDistinct("o_custkey")).scalar())
    return near.select((F.abs(F.col("estimate") - F.col("exact")) <= 0.08 * F.col("exact")).alias("within_rsd"))


@query("A4_theta_set_changes", """
    WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month, o_custkey FROM orders),
    months AS (SELECT DISTINCT month FROM m)
    SELECT month,
      (SELECT count(*) FROM m WHERE m.month = s.month AND o_custkey NOT IN (SELECT o_custkey FROM m AS p WHERE p.month = s.month - INTERVAL 1 MONTH)) AS gained,
      (SELECT count(*) FROM m WHERE m.month = s.month AND o_custkey IN (SELECT o_custkey FROM m AS p WHERE p.month = s.month - INTERVAL 1 MONTH)) AS kept,
      (SELECT count(*) FROM m WHERE m.month = s.month - INTERVAL 1 MONTH AND o_custkey NOT IN (SELECT o_custkey FROM m AS p WHERE p.month = s.month)) AS lost
    FROM months AS s""")
def a4_theta(t):
    months = t.orders.select(F.trunc("o_orderdate", "month").alias("month"), "o_custkey")
    return A.set_changes(months, "month", F.add_months("month", -1), "o_custkey")


@query("A11_bitmap_windows", """
    WITH l AS (SELECT l_returnflag, l_partkey, date_trunc('month', l_shipdate)::DATE AS month FROM lineitem)
    SELECT l_returnflag, CAST(count(DISTINCT l_partkey) FILTER (WHERE month >= DATE '1998-01-01') AS BIGINT) AS parts_1998,
      CAST(count(DISTINCT l_partkey) FILTER (WHERE month BETWEEN DATE '1997-01-01' AND DATE '1997-03-01') AS BIGINT) AS parts_q1_1997,
      CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts_ever FROM l GROUP BY 1""")
def a11_bitmaps(t):
    monthly = A.bitmaps(t.lineitem.withColumn("month", F.trunc("l_shipdate", "month")), ["l_returnflag", "month"], "l_partkey")
    since = F.col("month") >= F.lit("1998-01-01").cast("date")
    quarter = F.col("month").between(F.lit("1997-01-01").cast("date"), F.lit("1997-03-01").cast("date"))
    return A.bitmap_distinct(monthly, ["l_returnflag"], {"parts_1998": since, "parts_q1_1997": quarter, "parts_ever": F.lit(True)})


@query("A5_collect", """
    SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags,
           CAST(count(DISTINCT l_linenumber) AS BIGINT) AS n_line_numbers,
           array_to_string(list_sort(list(DISTINCT l_linestatus || l_returnflag)), ',') AS combos
    FROM lineitem GROUP BY 1""")
def a5(t):
    # sets over fixed domains: their size does not grow with the rows of a group
    g = t.lineitem.groupBy("l_suppkey").agg(
        F.collect_set("l_returnflag").alias("flags"), F.collect_set("l_linenumber").alias("lines"),
        F.collect_set(F.concat("l_linestatus", "l_returnflag")).alias("combos"))
    return g.select("l_suppkey", F.array_join(F.sort_array("flags"), ",").alias("flags"),
                    F.size("lines").cast("bigint").alias("n_line_numbers"),
                    F.array_join(F.array_sort("combos"), ",").alias("combos"))


@query("A5_collect_list", """
    SELECT l_suppkey, string_agg(l_returnflag || ':' || n, ',' ORDER BY l_returnflag) AS lines_by_flag
    FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def a5_list(t):
    counted = t.lineitem.groupBy("l_suppkey", "l_returnflag").count()
    listed = counted.groupBy("l_suppkey").agg(F.collect_list(F.struct("l_returnflag", "count")).alias("l"))
    return listed.select("l_suppkey", F.array_join(F.transform(
        F.sort_array("l"), lambda s: F.concat_ws(":", s["l_returnflag"], s["count"].cast("string"))), ",")
        .alias("lines_by_flag"))


@query("A6_pivot", f"""
    SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'A' THEN {NET} END) AS DOUBLE) AS "A",
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN {NET} END) AS DOUBLE) AS "N",
           CAST(sum(CASE WHEN l_returnflag = 'X' THEN {NET} END) AS DOUBLE) AS "X" FROM lineitem GROUP BY 1""")
def a6(t):
    return (t.lineitem.groupBy("l_linestatus").pivot("l_returnflag", ["A", "N", "X"])
            .agg(C.as_double(F.sum(C.net_amount("l_extendedprice", "l_discount")))))


COUNTERS = ["click", "error", "purchase", "view", "absent"]


@query("A7_pivot_counters", "SELECT user_id, " + ", ".join(
    f"CAST(COALESCE(sum(CASE WHEN event_type = '{c}' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS {c}"
    for c in COUNTERS) + " FROM events GROUP BY 1")
def a7(t):
    return (t.events.groupBy("user_id").pivot("event_type", COUNTERS)
            .agg(C.as_double(F.sum(C.money("value")))).na.fill(0.0))


@query("A8_pivot_readings", """
    SELECT CAST(count(*) AS BIGINT) AS wide_rows, CAST(count(*) FILTER (WHERE present = 1) AS BIGINT) AS one,
           CAST(count(*) FILTER (WHERE present = 2) AS BIGINT) AS two,
           CAST(count(*) FILTER (WHERE present >= 3) AS BIGINT) AS three_up
    FROM (SELECT user_id, date_trunc('hour', ts) AS h, count(DISTINCT event_type) AS present
          FROM events WHERE event_type IN ('click','view','purchase','error') GROUP BY 1, 2)""")
def a8(t):
    kinds = ["click", "view", "purchase", "error"]
    from lakeops.operators.windows import latest_wins
    e = t.events.where(F.col("event_type").isin(kinds)).withColumn("h", F.date_trunc("hour", "ts"))
    one = latest_wins(e, ["user_id", "h", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    wide = one.groupBy("user_id", "h").pivot("event_type", kinds).agg(F.first("value"))
    present = sum(F.col(k).isNotNull().cast("int") for k in kinds)
    return wide.select(present.alias("p")).agg(
        F.count("*").alias("wide_rows"), F.count_if(F.col("p") == 1).alias("one"),
        F.count_if(F.col("p") == 2).alias("two"), F.count_if(F.col("p") >= 3).alias("three_up"))


@query("A9_group_by_expression", """
    SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""")
def a9(t):
    return t.events.groupBy(F.hour("ts").alias("hour_of_day")).agg(F.count("*").alias("n"))


RUN = "DATE '2000-06-30'"


@query("A10_windowed_sums", "SELECT o_custkey, " + ", ".join(
    f"CAST(sum(CASE WHEN d < {n} THEN {TOTAL} ELSE 0 END) AS DOUBLE) AS spend_{n}d, "
    f"CAST(count(*) FILTER (WHERE d < {n}) AS BIGINT) AS orders_{n}d" for n in (30, 90, 365)) + f"""
    FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), {RUN}) AS d FROM orders
          WHERE o_orderdate > {RUN} - INTERVAL 365 DAY AND o_orderdate <= {RUN}) GROUP BY 1""")
def a10(t):
    run = F.to_date(F.lit("2000-06-30"))
    o = (t.orders.where((F.col("o_orderdate") > F.date_sub(run, 365)) & (F.col("o_orderdate") <= run))
         .withColumn("d", F.datediff(run, "o_orderdate")))
    g = o.groupBy("o_custkey").agg(*A.windowed_sums("d", {
        "spend": (C.money("o_totalprice"), (30, 90, 365)), "orders": (F.lit(1), (30, 90, 365))}))
    return g.withColumns({f"spend_{n}d": C.as_double(f"spend_{n}d") for n in (30, 90, 365)})


@query("A11_windowed_distinct", f"""
    SELECT l_suppkey, CAST(count(DISTINCT CASE WHEN d < 90 THEN l_partkey END) AS BIGINT) AS parts_90d,
           CAST(count(DISTINCT CASE WHEN d < 365 THEN l_partkey END) AS BIGINT) AS parts_365d
    FROM (SELECT *, date_diff('day', CAST(l_shipdate AS DATE), {RUN}) AS d FROM lineitem
          WHERE l_shipdate > {RUN} - INTERVAL 365 DAY AND l_shipdate <= {RUN}) GROUP BY 1""")
def a11(t):
    run = F.to_date(F.lit("2000-06-30"))
    li = (t.lineitem.where((F.col("l_shipdate") > F.date_sub(run, 365)) & (F.col("l_shipdate") <= run))
          .withColumn("d", F.datediff(run, "l_shipdate")))
    return A.windowed_distinct(li, ["l_suppkey"], "d", "l_partkey", (90, 365), "parts")


@query("A12_category_matrix", "SELECT o_custkey, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE o_orderstatus = '{s}' AND d < {n}) AS BIGINT) AS status_{s.lower()}_{n}d"
    for s in "FOP" for n in (180, 365)) + f"""
    FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), {RUN}) AS d FROM orders
          WHERE o_orderdate > {RUN} - INTERVAL 365 DAY AND o_orderdate <= {RUN}) GROUP BY 1""")
def a12(t):
    run = F.to_date(F.lit("2000-06-30"))
    o = (t.orders.where((F.col("o_orderdate") > F.date_sub(run, 365)) & (F.col("o_orderdate") <= run))
         .withColumn("d", F.datediff(run, "o_orderdate")))
    return o.groupBy("o_custkey").agg(*A.category_matrix("o_orderstatus", ["F", "O", "P"], "d", (180, 365), "status"))


@query("A13_ratio_of_sums", f"""
    SELECT user_id, CASE WHEN den > 0 THEN {half_up("100.0 * CAST(num AS DOUBLE) / CAST(den AS DOUBLE)", 4)} END AS rate
    FROM (SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS num,
                 sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS den FROM events GROUP BY 1)""")
def a13(t):
    is_in = lambda *k: F.col("event_type").isin(*k).cast("int")
    return t.events.groupBy("user_id").agg(
        A.ratio_of_sums(is_in("error"), is_in("view", "click"), 4, 100.0).alias("rate"))


@query("A14_weighted_mean", f"""
    SELECT l_suppkey, {half_up("CAST(sum(m * q) AS DOUBLE) / CAST(sum(CASE WHEN m IS NOT NULL THEN q END) AS DOUBLE)", 4)} AS mean_tax,
           {half_up("CAST(sum(CASE WHEN m IS NOT NULL THEN q ELSE 0 END) AS DOUBLE) / CAST(sum(q) AS DOUBLE)", 4)} AS covered
    FROM (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS q,
                 CASE WHEN l_returnflag <> 'R' THEN CAST(l_tax AS DECIMAL(4,2)) END AS m FROM lineitem) GROUP BY 1""")
def a14(t):
    rows = t.lineitem.select("l_suppkey", F.col("l_quantity").cast("bigint").alias("q"),
                             F.when(F.col("l_returnflag") != "R", F.col("l_tax").cast("decimal(4,2)")).alias("m"))
    return rows.groupBy("l_suppkey").agg(A.weighted_mean("m", "q").alias("mean_tax"),
                                         A.covered_share("m", "q").alias("covered"))


@query("A15_trend", f"""
    SELECT o_custkey, CASE WHEN l > 0 THEN {half_up("(CAST(s AS DOUBLE) / 90) / (CAST(l AS DOUBLE) / 365)", 4)} END AS trend
    FROM (SELECT o_custkey, sum(CASE WHEN d < 90 THEN {TOTAL} ELSE 0 END) AS s, sum(CASE WHEN d < 365 THEN {TOTAL} ELSE 0 END) AS l
          FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), {RUN}) AS d FROM orders
                WHERE o_orderdate <= {RUN}) GROUP BY 1)""")
def a15(t):
    run = F.to_date(F.lit("2000-06-30"))
    o = t.orders.where(F.col("o_orderdate") <= run).withColumn("d", F.datediff(run, "o_orderdate"))
    g = o.groupBy("o_custkey").agg(*A.windowed_sums("d", {"spend": (C.money("o_totalprice"), (90, 365))}))
    return g.select("o_custkey", A.trend("spend_90d", "spend_365d", 90, 365).alias("trend"))


@query("A16_volatility", f"""
    SELECT o_custkey, {half_up("sd", 2)} AS sd, CASE WHEN mean > 0 THEN {half_up("sd / mean", 4)} END AS volatility
    FROM (SELECT o_custkey, stddev_samp(o_totalprice) AS sd, avg(o_totalprice) AS mean FROM orders GROUP BY 1)""")
def a16(t):
    g = t.orders.groupBy("o_custkey").agg(F.stddev("o_totalprice").alias("sd"), F.avg("o_totalprice").alias("mean"))
    return g.select("o_custkey", F.round("sd", 2).alias("sd"), C.safe_ratio("sd", "mean", 4).alias("volatility"))


@query("A17_approx_percentile", """
    SELECT o_custkey, quantile_disc(o_totalprice, 0.5) AS median_total FROM orders GROUP BY 1""")
def a17(t):
    return t.orders.groupBy("o_custkey").agg(F.percentile_approx("o_totalprice", 0.5).alias("median_total"))


@query("A18_exact_percentile", f"""
    SELECT l_suppkey, CAST(count(*) AS BIGINT) AS n_values, {half_up("quantile_cont(l_extendedprice, 0.5)", 6)} AS p50,
           {half_up("quantile_cont(l_extendedprice, 0.9)", 6)} AS p90 FROM lineitem GROUP BY 1""")
def a18(t):
    p = S.exact_percentiles(t.lineitem, ["l_suppkey"], "l_extendedprice", {"p50": 0.5, "p90": 0.9})
    return p.withColumns({"p50": F.round("p50", 6), "p90": F.round("p90", 6)})


@query("A18_percentile_within_group", f"""
    SELECT o_orderpriority, {half_up("quantile_cont(o_totalprice, 0.5)", 6)} AS p50,
           {half_up("quantile_cont(o_totalprice, 0.9)", 6)} AS p90 FROM orders GROUP BY 1""")
def a18_wide(t):
    # five groups over the whole table: each is far too large to be held in one task
    p = S.exact_percentiles(t.orders, ["o_orderpriority"], "o_totalprice", {"p50": 0.5, "p90": 0.9}, max_rows=1_000)
    return p.select("o_orderpriority", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"))


@query("A19_having", """
    SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def a19(t):
    return (t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies"))
            .filter("copies > 1"))


@query("A20_filter_clause", f"""
    SELECT l_returnflag, CAST(count(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS deep,
           CAST(sum({PRICE}) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) AS open_price FROM lineitem GROUP BY 1""")
def a20(t):
    t.lineitem.createOrReplaceTempView("lakeops_lineitem")
    return t.spark.sql("""
        SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05D) AS deep,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) AS open_price
        FROM lakeops_lineitem GROUP BY l_returnflag""")


@query("A21_global", f"""
    SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum({TOTAL}) AS DOUBLE) AS total,
           CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers FROM orders""")
def a21(t):
    return t.orders.agg(F.count("*").alias("n"), C.as_double(F.sum(C.money("o_totalprice")), "total"),
                        F.countDistinct("o_custkey").alias("customers"))


@query("A22_two_level", f"""
    SELECT CAST(count(*) AS BIGINT) AS customers, CAST(sum(s) AS DOUBLE) AS total, CAST(max(s) AS DOUBLE) AS top_customer
    FROM (SELECT o_custkey, sum({TOTAL}) AS s FROM orders GROUP BY 1)""")
def a22(t):
    per = t.orders.groupBy("o_custkey").agg(F.sum(C.money("o_totalprice")).alias("s"))
    return per.agg(F.count("*").alias("customers"), C.as_double(F.sum("s"), "total"),
                   C.as_double(F.max("s"), "top_customer"))


@query("A23_profile", f"""
    SELECT {half_up("avg(bal)", 4)} AS mean, {half_up("stddev_samp(bal)", 4)} AS sd, min(bal) AS mn, max(bal) AS mx,
           CAST(count(*) FILTER (WHERE bal IS NULL) AS BIGINT) AS nulls, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)""")
def a23(t):
    bal = t.customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    return bal.agg(*A.profile("bal")).withColumns({"mean": F.round("mean", 4), "sd": F.round("sd", 4)})


SIGNED = f"CASE WHEN o_orderstatus = 'F' THEN {TOTAL} ELSE -{TOTAL} END"


@query("A24_signed_sum", f"SELECT o_custkey, CAST(sum({SIGNED}) AS DOUBLE) AS net FROM orders GROUP BY 1")
def a24(t):
    return t.orders.groupBy("o_custkey").agg(
        C.as_double(F.sum(A.signed(C.money("o_totalprice"), "o_orderstatus", ["F"])), "net"))


def daily_summary(t):
    amount = C.money("o_totalprice")
    daily = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("business_date")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", amount).otherwise(F.lit(0))).alias("credit_volume"),
        F.sum(F.when(F.col("o_orderstatus") != "F", amount).otherwise(F.lit(0))).alias("debit_volume"),
        F.count("*").alias("txn_count"))
    return A.rollforward(daily, ["o_custkey"], "business_date", "credit_volume", "debit_volume")


DAILY = f"""SELECT o_custkey, business_date, sum(net) OVER w - net AS opening, credit, debit,
    sum(net) OVER w AS closing, txn_count FROM (
      SELECT o_custkey, CAST(o_orderdate AS DATE) AS business_date, CAST(count(*) AS BIGINT) AS txn_count,
             sum(CASE WHEN o_orderstatus = 'F' THEN {TOTAL} ELSE 0 END) AS credit,
             sum(CASE WHEN o_orderstatus <> 'F' THEN {TOTAL} ELSE 0 END) AS debit,
             sum({SIGNED}) AS net FROM orders GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY business_date)"""


@query("A25_rollforward", f"""
    SELECT o_custkey, business_date, CAST(opening AS DOUBLE) AS opening_balance, CAST(credit AS DOUBLE) AS credit_volume,
           CAST(debit AS DOUBLE) AS debit_volume, CAST(closing AS DOUBLE) AS closing_balance, txn_count FROM ({DAILY})""")
def a25(t):
    s = daily_summary(t)
    amounts = ["opening_balance", "credit_volume", "debit_volume", "closing_balance"]
    return s.select("o_custkey", "business_date", *[C.as_double(c, c) for c in amounts], "txn_count")


@query("A26_completeness", """
    SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
           CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS ok, CAST(count(*) AS BIGINT) AS total,
           count(*) FILTER (WHERE event_type <> 'error') / 2.0 AS completeness FROM events GROUP BY 1, 2""")
def a26(t):
    return t.events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count_if(F.col("event_type") != "error").alias("ok"), F.count("*").alias("total")).withColumn(
        "completeness", F.col("ok") / F.lit(2.0))


@query("A27_k_anonymous", """
    SELECT c_nationkey, c_mktsegment, CAST(count(DISTINCT c_custkey) AS BIGINT) AS members,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer GROUP BY 1, 2 HAVING count(DISTINCT c_custkey) >= 12""")
def a27(t):
    return A.suppress_small(t.customer, ["c_nationkey", "c_mktsegment"], "c_custkey", 12,
                            C.as_double(F.sum(C.money("c_acctbal")), "balance"))


@query("A28_response_curve", f"""
    WITH b AS (SELECT l_returnflag, floor(l_quantity) AS bin, CAST(sum({PRICE}) AS DOUBLE) / count(*) AS y
               FROM lineitem GROUP BY 1, 2),
         m AS (SELECT l_returnflag, bin AS inflection, y AS lowest FROM
               (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY y, bin) AS rn FROM b) WHERE rn = 1)
    SELECT l_returnflag, CAST(max(inflection) AS DOUBLE) AS inflection, {half_up("max(lowest)", 2)} AS lowest,
           CAST(count(*) AS BIGINT) AS bins,
           {half_up("regr_slope(CASE WHEN bin <= inflection THEN y END, CASE WHEN bin <= inflection THEN bin END)", 4)} AS slope_below,
           {half_up("regr_slope(CASE WHEN bin >= inflection THEN y END, CASE WHEN bin >= inflection THEN bin END)", 4)} AS slope_above
    FROM b JOIN m USING (l_returnflag) GROUP BY 1""")
def a28(t):
    curve = A.response_curve(t.lineitem.withColumn("y", C.money("l_extendedprice")), ["l_returnflag"], "l_quantity", "y")
    return curve.select("l_returnflag", C.as_double("inflection", "inflection"), F.round("lowest", 2).alias("lowest"),
                        "bins", F.round("slope_below", 4).alias("slope_below"), F.round("slope_above", 4).alias("slope_above"))


@query("A29_predictors", f"""
    SELECT l_linestatus, {half_up("corr(l_quantity, l_extendedprice)", 6)} AS corr_quantity,
           {half_up("corr(l_discount, l_extendedprice)", 6)} AS corr_discount,
           {half_up("CAST(sum(CASE WHEN l_tax > 0.04 THEN " + PRICE + " END) AS DOUBLE) / count(*) FILTER (WHERE l_tax > 0.04)", 2)} AS mean_high_tax,
           {half_up("CAST(sum(CASE WHEN l_tax <= 0.04 THEN " + PRICE + " END) AS DOUBLE) / count(*) FILTER (WHERE l_tax <= 0.04)", 2)} AS mean_low_tax
    FROM lineitem GROUP BY 1""")
def a29(t):
    high = F.col("l_tax") > 0.04
    mean = lambda c: F.round(C.as_double(F.sum(F.when(c, C.money("l_extendedprice")))) / F.count_if(c), 2)
    return t.lineitem.groupBy("l_linestatus").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr_quantity"),
        F.round(F.corr("l_discount", "l_extendedprice"), 6).alias("corr_discount"),
        mean(high).alias("mean_high_tax"), mean(~high).alias("mean_low_tax"))


@query("A30_precision_recall", """
    SELECT CAST(tp AS BIGINT) AS true_positive, CAST(fp AS BIGINT) AS false_positive, CAST(fn AS BIGINT) AS false_negative,
           CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / (tp + fn) AS recall
    FROM (SELECT count(*) FILTER (WHERE f AND g) AS tp, count(*) FILTER (WHERE f AND NOT g) AS fp,
                 count(*) FILTER (WHERE NOT f AND g) AS fn
          FROM (SELECT o_totalprice > 300000 AS f, o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS g FROM orders))""")
def a30(t):
    o = t.orders
    return A.confusion(o.where("o_totalprice > 300000"),
                       o.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"), ["o_orderkey"])


@query("A31_bounding_box", f"""
    SELECT user_id, event_type, min(value) AS lat_min, max(value) AS lat_max, min(value * 2) AS lon_min,
           max(value * 2) AS lon_max, {half_up("CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*)", 4)} AS mean_score,
           CAST(count(*) AS BIGINT) AS pings FROM events GROUP BY 1, 2""")
def a31(t):
    lat, lon = F.col("value"), F.col("value") * 2
    return t.events.groupBy("user_id", "event_type").agg(
        F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
        F.round(C.as_double(F.sum(C.money("value"))) / F.count("*"), 4).alias("mean_score"), F.count("*").alias("pings"))


@query("A32_monthly_rollup", f"""
    SELECT *, CASE WHEN variance > 0 THEN 'PARTNER_OWES_US' WHEN variance < 0 THEN 'WE_OWE_PARTNER' ELSE 'BALANCED' END AS direction
    FROM (SELECT l_suppkey, strftime(date_trunc('month', l_shipdate), '%Y-%m') AS month,
                 CAST(sum(CASE WHEN l_linestatus = 'F' THEN {PRICE} ELSE -{PRICE} END) AS DOUBLE) AS variance,
                 CAST(count(*) AS BIGINT) AS legs, CAST(count(DISTINCT l_shipdate) AS BIGINT) AS days
          FROM lineitem GROUP BY 1, 2)""")
def a32(t):
    from lakeops.jobs.settlement import direction
    g = t.lineitem.groupBy("l_suppkey", F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        C.as_double(F.sum(A.signed(C.money("l_extendedprice"), "l_linestatus", ["F"])), "variance"),
        F.count("*").alias("legs"), F.countDistinct("l_shipdate").alias("days"))
    return g.withColumn("direction", direction("variance"))


@query("A33_share_of_total", """
    SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share
    FROM customer GROUP BY 1""")
def a33(t):
    from pyspark.sql import Window
    # the window runs over one row per segment, not over the customers
    g = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return g.withColumn("share", F.col("n").cast("double") / total)


@query("A35_funnel", """
    SELECT product, hour, views, clicks, purchases, COALESCE(clicks / NULLIF(CAST(views AS DOUBLE), 0), 0.0) AS view_to_click,
           COALESCE(purchases / NULLIF(CAST(clicks AS DOUBLE), 0), 0.0) AS click_to_purchase,
           COALESCE(purchases / NULLIF(CAST(views AS DOUBLE), 0), 0.0) AS view_to_purchase
    FROM (SELECT CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS product,
                 strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour,
                 CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS views,
                 CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks,
                 CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases
          FROM events GROUP BY 1, 2)""")
def a35(t):
    e = t.events.select(F.get_json_object("props", "$.k").cast("int").alias("product"),
                        C.stamp(F.date_trunc("hour", "ts")).alias("hour"), "event_type")
    return A.funnel(e, ["product", "hour"], "event_type", ["view", "click", "purchase"])


@query("A36_worst_contributor", f"""
    WITH v AS (SELECT l_suppkey, sum(CASE WHEN l_linestatus = 'F' THEN {PRICE} ELSE -{PRICE} END) AS variance
               FROM lineitem GROUP BY 1)
    SELECT CAST(sum(abs(variance)) AS DOUBLE) AS total_abs, max_by(l_suppkey, abs(variance)) AS worst,
           CAST(max(abs(variance)) AS DOUBLE) AS worst_abs FROM v""")
def a36(t):
    v = t.lineitem.groupBy("l_suppkey").agg(
        F.sum(A.signed(C.money("l_extendedprice"), "l_linestatus", ["F"])).alias("variance"))
    w = A.worst_contributor(v, "l_suppkey", "variance")
    return w.select(C.as_double("total_abs", "total_abs"), "worst", C.as_double("worst_abs", "worst_abs"))


@query("A37_materiality", f"""
    SELECT CAST(count(*) AS BIGINT) AS days, CAST(count(*) FILTER (WHERE abs(CAST(net AS DOUBLE) / CAST(gross AS DOUBLE)) > 0.5) AS BIGINT) AS material_days
    FROM (SELECT o_orderdate, sum({SIGNED}) AS net, sum({TOTAL}) AS gross FROM orders GROUP BY 1)""")
def a37(t):
    amount = C.money("o_totalprice")
    d = t.orders.groupBy("o_orderdate").agg(F.sum(A.signed(amount, "o_orderstatus", ["F"])).alias("net"),
                                            F.sum(amount).alias("gross"))
    return d.agg(F.count("*").alias("days"),
                 F.count_if(F.abs(C.as_double("net") / C.as_double("gross")) > 0.5).alias("material_days"))


@query("A37_worst_days", f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(sum({SIGNED}) AS DOUBLE) AS net FROM orders GROUP BY 1
    ORDER BY abs(sum({SIGNED})) DESC, 1 LIMIT 3""")
def a37_worst(t):
    d = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(
        F.sum(A.signed(C.money("o_totalprice"), "o_orderstatus", ["F"])).alias("n"))
    return d.orderBy(F.abs("n").desc(), "day").limit(3).select("day", C.as_double("n", "net"))
