"""Projections, predicates, scalar functions and set operations (P, F, U, O)."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.operators import setops
from lakeops.registry import half_up, query

NET = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


# ------------------------------------------------------------------ projections
@query("P1_select", """
    SELECT o_orderkey, o_orderstatus AS status, o_orderpriority, o_orderstatus = 'F' AS is_final
    FROM orders""")
def p1(t):
    o = t.orders
    return o.select("o_orderkey", F.col("o_orderstatus").alias("status"), o["o_orderpriority"],
                    (F.col("o_orderstatus") == "F").alias("is_final"))


@query("P2_with_column", """
    SELECT o_orderkey, 'S-' || o_orderstatus AS o_orderstatus, lower(o_orderstatus) AS status_lc
    FROM orders""")
def p2(t):
    return (t.orders.select("o_orderkey", "o_orderstatus")
            .withColumn("status_lc", F.lower("o_orderstatus"))
            .withColumn("o_orderstatus", F.concat(F.lit("S-"), "o_orderstatus")))


@query("P3_with_columns", """
    SELECT c_custkey, 'silver' AS layer, 'load' AS loaded_by, c_name LIKE 'Customer#0000%' AS early
    FROM customer""")
def p3(t):
    return t.customer.select("c_custkey", "c_name").withColumns({
        "layer": F.lit("silver"), "loaded_by": F.lit("load"),
        "early": F.col("c_name").startswith("Customer#0000")}).drop("c_name")


@query("P4_cast_try_cast", """
    SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS bal_int,
           CAST(c_nationkey AS VARCHAR) AS nation_text,
           CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS bal_dec,
           TRY_CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 'not_a_number'
                         WHEN c_mktsegment = 'BUILDING' THEN NULL
                         ELSE CAST(c_custkey AS VARCHAR) END AS INTEGER) AS best_effort
    FROM customer""")
def p4(t):
    dirty = (F.when(F.col("c_mktsegment") == "MACHINERY", "not_a_number")
             .when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string")))
    return t.customer.select(
        "c_custkey", F.col("c_acctbal").cast("int").alias("bal_int"),
        F.col("c_nationkey").cast("string").alias("nation_text"),
        C.as_double(F.col("c_acctbal").cast("decimal(10,2)"), "bal_dec"),
        dirty.try_cast("int").alias("best_effort"))


@query("P5_rename_drop", """
    SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_totalprice AS total,
           strftime(o_orderdate, '%Y-%m-%d') AS event_day FROM orders""")
def p5(t):
    return (t.orders.withColumn("event_day", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .withColumnRenamed("o_orderstatus", "status").withColumnRenamed("o_totalprice", "total")
            .drop("o_orderpriority", "o_orderdate"))


@query("P6_prefix_columns", """
    SELECT c_custkey, c_name AS account__c_name, c_nationkey AS account__c_nationkey,
           c_acctbal AS account__c_acctbal, c_mktsegment AS account__c_mktsegment FROM customer""")
def p6(t):
    return C.prefixed(t.customer, "account", ["c_custkey"])


@query("P7_comparison_logic", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE (o_orderstatus = 'F' AND o_totalprice >= 100000)
       OR NOT (o_orderpriority <> '1-URGENT' OR o_totalprice > 50000)""")
def p7(t):
    o = t.orders
    return o.filter(((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 100000))
                    | ~((F.col("o_orderpriority") != "1-URGENT") | (F.col("o_totalprice") > 50000))
                    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("P8_in_between_like", """
    SELECT p_partkey, p_type, p_size FROM part
    WHERE p_type IN ('ECONOMY', 'SMALL', 'PROMO') AND p_size BETWEEN 5 AND 20
      AND starts_with(p_brand, 'Brand#1') AND regexp_matches(p_name, '(?i)(RING|widget)$')""")
def p8(t):
    return t.part.filter(
        F.col("p_type").isin("ECONOMY", "SMALL", "PROMO") & F.col("p_size").between(5, 20)
        & F.col("p_brand").startswith("Brand#1") & F.col("p_name").rlike("(?i)(RING|widget)$")
    ).select("p_partkey", "p_type", "p_size")


@query("P9_null_tests", """
    SELECT CAST(count(*) FILTER (WHERE seg IS NULL) AS BIGINT) AS is_null,
           CAST(count(*) FILTER (WHERE seg IS NOT NULL) AS BIGINT) AS is_not_null,
           CAST(count(*) FILTER (WHERE seg = NULL) AS BIGINT) AS equals_null,
           CAST(count(*) FILTER (WHERE seg IS NOT DISTINCT FROM NULL) AS BIGINT) AS null_safe
    FROM (SELECT NULLIF(c_mktsegment, 'BUILDING') AS seg FROM customer)""")
def p9(t):
    seg = F.col("seg")
    none = F.lit(None).cast("string")
    return t.customer.select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg")).agg(
        F.count_if(seg.isNull()).alias("is_null"), F.count_if(seg.isNotNull()).alias("is_not_null"),
        F.count_if(seg == none).alias("equals_null"),
        F.count_if(seg.eqNullSafe(none)).alias("null_safe"))


@query("P10_case_chain", """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           CASE WHEN l_quantity < 5 THEN 'few' WHEN l_extendedprice >= 50000 THEN 'high_value'
                WHEN l_extendedprice >= 5000 THEN 'standard' ELSE 'small' END AS band,
           CASE WHEN l_quantity > 40 THEN 'bulk' END AS no_otherwise FROM lineitem""")
def p10(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        C.first_match([(F.col("l_quantity") < 5, "few"), (F.col("l_extendedprice") >= 50000, "high_value"),
                       (F.col("l_extendedprice") >= 5000, "standard")], "small").alias("band"),
        F.when(F.col("l_quantity") > 40, "bulk").alias("no_otherwise"))


@query("P11_coalesce", """
    SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'),
           CASE WHEN c_acctbal > 0 THEN 'cust-' || c_custkey END, 'UNKNOWN') AS contact FROM customer""")
def p11(t):
    return t.customer.select("c_custkey", F.coalesce(
        F.nullif("c_mktsegment", F.lit("BUILDING")),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("cust-"), F.col("c_custkey").cast("string"))),
        F.lit("UNKNOWN")).alias("contact"))


HOLES = """(SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS seg,
             CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)"""


@query("P12_fill_drop", f"""
    SELECT c_custkey, COALESCE(seg, 'missing') AS seg, COALESCE(bal, 0.0) AS bal,
           bal IS NOT NULL AND seg IS NOT NULL AS survives_any, seg IS NOT NULL AS survives_subset
    FROM {HOLES}""")
def p12(t):
    holes = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
                              F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    kept_any = holes.na.drop(how="any").select("c_custkey", F.lit(True).alias("survives_any"))
    kept_sub = holes.na.drop(subset=["seg"]).select("c_custkey", F.lit(True).alias("survives_subset"))
    return (holes.na.fill({"seg": "missing", "bal": 0.0})
            .join(kept_any, "c_custkey", "left").join(kept_sub, "c_custkey", "left")
            .na.fill(False, ["survives_any", "survives_subset"]))


CALLS = """(SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity
    WHEN l_returnflag = 'A' THEN l_quantity * 3000 ELSE l_quantity END AS BIGINT) AS duration,
    CASE WHEN l_linestatus = 'O' THEN l_partkey END AS b_number FROM lineitem)"""


def calls(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", -q).when(F.col("l_returnflag") == "A", q * 3000)
        .otherwise(q).cast("bigint").alias("duration"),
        F.when(F.col("l_linestatus") == "O", F.col("l_partkey")).alias("b_number"))


@query("P13_quality_flag_clamp", f"""
    SELECT quality_flag, CAST(count(*) AS BIGINT) AS calls,
           CAST(sum(greatest(duration, 0)) AS BIGINT) AS seconds
    FROM (SELECT *, CASE WHEN duration < 0 THEN 'NEGATIVE_DURATION'
                 WHEN duration > 86400 THEN 'DURATION_OVER_24H'
                 WHEN b_number IS NULL THEN 'MISSING_B_NUMBER' ELSE 'OK' END AS quality_flag
          FROM {CALLS}) GROUP BY 1""")
def p13(t):
    flagged = calls(t).withColumn("quality_flag", C.call_quality("duration", "b_number")) \
        .withColumn("duration", F.greatest("duration", F.lit(0)))
    return flagged.groupBy("quality_flag").agg(F.count("*").alias("calls"),
                                               F.sum("duration").alias("seconds"))


RAW_READING = """CASE WHEN event_type = 'error' THEN 'Null' WHEN event_type = 'signup' THEN ' '
    WHEN event_type = 'click' THEN '0' WHEN event_type = 'view' THEN '-1.5'
    ELSE CAST(value AS VARCHAR) END"""


def raw_reading():
    e = F.col("event_type")
    return (F.when(e == "error", "Null").when(e == "signup", " ").when(e == "click", "0")
            .when(e == "view", "-1.5").otherwise(F.col("value").cast("string")))


@query("P14_reading_status", f"""
    SELECT event_id, kwh, CASE WHEN kwh IS NULL THEN 'MISSING' WHEN kwh < 0 THEN 'NEGATIVE'
           WHEN kwh = 0 THEN 'ZERO' ELSE 'OK' END AS status
    FROM (SELECT event_id, CASE WHEN trim(raw) NOT IN ('Null', '') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS kwh
          FROM (SELECT event_id, {RAW_READING} AS raw FROM events))""")
def p14(t):
    return (t.events.select("event_id", C.parsed_reading(raw_reading()).alias("kwh"))
            .withColumn("status", C.reading_status("kwh")))


@query("P15_zero_needs_tenure", """
    SELECT c_custkey, CASE WHEN tenure >= 30 THEN orders_30d END AS orders_30d, tenure FROM (
      SELECT c_custkey, date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '1995-02-15') AS tenure,
             CAST(count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1995-01-16'
                                   AND o_orderdate <= TIMESTAMP '1995-02-15') AS BIGINT) AS orders_30d
      FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)""")
def p15(t):
    day = F.to_date(F.lit("1995-02-15"))
    o = t.orders
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.datediff(day, F.min("o_orderdate")).alias("tenure"),
        F.count_if((F.col("o_orderdate") > F.date_sub(day, 30)) & (F.col("o_orderdate") <= day))
        .alias("orders_30d"))
    return (t.customer.select("c_custkey").join(per, "c_custkey")
            .withColumn("orders_30d", C.zero_needs_tenure("orders_30d", "tenure", 30)))


@query("P16_gps_valid", """
    SELECT event_id, lat IS NOT NULL AND COALESCE(NOT (abs(lat) < 0.001 AND abs(lon) < 0.001)
           AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, FALSE) AS gps_valid
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN 0.0
                 ELSE value END AS lat,
                 CASE WHEN event_type = 'signup' THEN 0.0 ELSE value * 2 END AS lon FROM events)""")
def p16(t):
    e = F.col("event_type")
    return (t.events.select(
        "event_id", F.when(e == "signup", 0.0).when(e != "error", F.col("value")).alias("lat"),
        F.when(e == "signup", 0.0).otherwise(F.col("value") * 2).alias("lon"))
        .select("event_id", C.gps_valid("lat", "lon").alias("gps_valid")))


TOPICS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query("P17_fixed_indicators", """
    SELECT o_custkey, CAST(count(*) FILTER (WHERE topic = '1-URGENT') AS BIGINT) AS is_1_urgent,
           CAST(count(*) FILTER (WHERE topic = '2-HIGH') AS BIGINT) AS is_2_high,
           CAST(count(*) FILTER (WHERE topic = '3-MEDIUM') AS BIGINT) AS is_3_medium,
           CAST(count(*) FILTER (WHERE topic = 'OTHER') AS BIGINT) AS is_other
    FROM (SELECT o_custkey, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM')
                 THEN o_orderpriority ELSE 'OTHER' END AS topic FROM orders) GROUP BY 1""")
def p17(t):
    o = t.orders.select("o_custkey", C.known_or_other("o_orderpriority", TOPICS).alias("topic"))
    return o.groupBy("o_custkey").agg(*[
        F.count_if(F.col("topic") == k).alias("is_" + k.lower().replace("-", "_"))
        for k in [*TOPICS, "OTHER"]])


@query("P18_not_exists", """
    SELECT c_custkey FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
                      AND o.o_totalprice > 200000)""")
def p18(t):
    t.customer.createOrReplaceTempView("lakeops_customer")
    t.orders.createOrReplaceTempView("lakeops_orders")
    return t.spark.sql("""
        SELECT c_custkey FROM lakeops_customer c WHERE NOT EXISTS (
            SELECT 1 FROM lakeops_orders o WHERE o.o_custkey = c.c_custkey
              AND o.o_orderstatus = 'F' AND o.o_totalprice > 200000)""")


@query("P19_nested_access", """
    SELECT o_orderkey, o_orderstatus AS status, split_part(o_orderpriority, '-', 1) AS level,
           o_totalprice AS total FROM orders""")
def p19(t):
    nested = t.orders.select(
        "o_orderkey", F.struct(F.col("o_orderstatus").alias("status")).alias("head"),
        F.split("o_orderpriority", "-").alias("parts"),
        F.create_map(F.lit("total"), F.col("o_totalprice")).alias("amounts"))
    return nested.select("o_orderkey", F.col("head.status").alias("status"),
                         F.col("parts").getItem(0).alias("level"), F.col("amounts")["total"].alias("total"))


# ------------------------------------------------------------------ scalar functions
@query("F1_trim_case", """
    SELECT c_custkey, trim('  ' || c_mktsegment || ' ') AS trimmed, lower(c_name) AS low,
           upper(c_name) AS up, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS cap FROM customer""")
def f1(t):
    return t.customer.select(
        "c_custkey", F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.lower("c_name").alias("low"), F.upper("c_name").alias("up"),
        F.initcap(F.lower("c_mktsegment")).alias("cap"))


@query("F2_split", """
    SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS level,
           string_split(o_orderpriority, '-')[2] AS label,
           CAST(len(string_split(o_orderpriority, '-')) AS BIGINT) AS n_parts FROM orders""")
def f2(t):
    parts = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", parts.getItem(0).alias("level"), parts[1].alias("label"),
                           F.size(parts).cast("bigint").alias("n_parts"))


@query("F3_regexp", """
    SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g') AS stripped,
           regexp_replace(c_name, '^Customer#', '') AS no_prefix,
           regexp_extract(c_name, '#0*([1-9][0-9]*)', 1) AS digits,
           regexp_extract(c_mktsegment, '(X[0-9])', 1) AS no_match FROM customer""")
def f3(t):
    return t.customer.select(
        "c_custkey", F.regexp_replace("c_name", "[^A-Za-z0-9]", "").alias("stripped"),
        F.regexp_replace("c_name", "^Customer#", "").alias("no_prefix"),
        F.regexp_extract("c_name", "#0*([1-9][0-9]*)", 1).alias("digits"),
        F.regexp_extract("c_mktsegment", "(X[0-9])", 1).alias("no_match"))


@query("F4_concat", """
    SELECT c_custkey, concat_ws(' | ', c_name, seg) AS ws, c_name || ' | ' || seg AS joined
    FROM (SELECT c_custkey, c_name, NULLIF(c_mktsegment, 'BUILDING') AS seg FROM customer)""")
def f4(t):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select("c_custkey", F.concat_ws(" | ", F.col("c_name"), seg).alias("ws"),
                             F.concat(F.col("c_name"), F.lit(" | "), seg).alias("joined"))


@query("F5_substring", """
    SELECT p_partkey, substring(p_name, 1, 4) AS head, trim(substring(p_name, 5, 6)) AS middle,
           starts_with(p_name, 'red') AS is_red, regexp_matches(p_type, '(?i)^eco') AS is_eco FROM part""")
def f5(t):
    return t.part.select(
        "p_partkey", F.substring("p_name", 1, 4).alias("head"),
        F.trim(F.substring("p_name", 5, 6)).alias("middle"),
        F.col("p_name").startswith("red").alias("is_red"), F.col("p_type").rlike("(?i)^eco").alias("is_eco"))


@query("F6_clean_number", """
    SELECT s_suppkey, regexp_replace('+44 (20) ' || s_suppkey || '-' || s_nationkey, '[^0-9+]', '', 'g') AS number
    FROM supplier""")
def f6(t):
    messy = F.concat(F.lit("+44 (20) "), F.col("s_suppkey").cast("string"), F.lit("-"),
                     F.col("s_nationkey").cast("string"))
    return t.supplier.select("s_suppkey", C.clean_number(messy).alias("number"))


@query("F7_parse_dates", """
    SELECT o_orderkey, CAST(strptime(iso, '%Y-%m-%d') AS DATE) AS iso_date,
           CAST(strptime(eu, '%d/%m/%Y') AS DATE) AS eu_date,
           CAST(try_strptime(eu, '%Y-%m-%d') AS DATE) AS wrong_format,
           strftime(strptime(iso || ' 07:08:09', '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS stamped
    FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso,
                 strftime(o_orderdate, '%d/%m/%Y') AS eu FROM orders)""")
def f7(t):
    texts = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
                            F.date_format("o_orderdate", "dd/MM/yyyy").alias("eu"))
    return texts.select(
        "o_orderkey", F.to_date("iso").alias("iso_date"), F.to_date("eu", "dd/MM/yyyy").alias("eu_date"),
        F.try_to_timestamp("eu", F.lit("yyyy-MM-dd")).cast("date").alias("wrong_format"),
        C.stamp(F.to_timestamp(F.concat("iso", F.lit(" 07:08:09")))).alias("stamped"))


@query("F8_date_trunc", "SELECT event_id, " + ", ".join(
    f"strftime(date_trunc('{u}', ts), '%Y-%m-%d %H:%M:%S') AS to_{u}"
    for u in ("minute", "hour", "day", "week", "month")) + " FROM events")
def f8(t):
    return t.events.select("event_id", *[C.stamp(F.date_trunc(u, "ts")).alias("to_" + u)
                                         for u in ("minute", "hour", "day", "week", "month")])


@query("F9_date_parts", """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS yr, CAST(month(ts) AS INTEGER) AS mo,
           CAST(day(ts) AS INTEGER) AS dy, CAST(hour(ts) AS INTEGER) AS hr,
           CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, strftime(ts, '%Y-%m-%d %H') AS hour_key FROM events""")
def f9(t):
    return t.events.select(
        "event_id", F.year("ts").alias("yr"), F.month("ts").alias("mo"), F.dayofmonth("ts").alias("dy"),
        F.hour("ts").alias("hr"), F.dayofweek("ts").alias("dow"),
        F.date_format("ts", "yyyy-MM-dd HH").alias("hour_key"))


@query("F10_date_math", """
    SELECT o_orderkey, CAST(date_diff('day', d, DATE '2001-12-31') AS INTEGER) AS days_before,
           CAST(d + INTERVAL 30 DAY AS DATE) AS plus_30, CAST(d - INTERVAL 7 DAY AS DATE) AS minus_7,
           CAST(d + INTERVAL 3 MONTH AS DATE) AS plus_3m, CAST(last_day(d) AS DATE) AS month_end
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def f10(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.datediff(F.to_date(F.lit("2001-12-31")), d).alias("days_before"),
        F.date_add(d, 30).alias("plus_30"), F.date_sub(d, 7).alias("minus_7"),
        F.add_months(d, 3).alias("plus_3m"), F.last_day(d).alias("month_end"))


@query("F11_epoch_grid", """
    SELECT event_id, s AS epoch_s, (s // 1800) * 1800 AS slot_s, s - (s // 1800) * 1800 AS drift_s
    FROM (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)""")
def f11(t):
    snapped = C.snap_down("ts", 1800)
    return t.events.select(
        "event_id", F.unix_seconds("ts").alias("epoch_s"), F.unix_seconds(snapped).alias("slot_s"),
        (F.unix_seconds("ts") - F.unix_seconds(snapped)).alias("drift_s"))


@query("F12_intervals", """
    SELECT event_id, strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS later,
           strftime(ts - INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS earlier FROM events
    WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 12:00:00'""")
def f12(t):
    e = t.events.where("ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 12:00:00'")
    return e.select("event_id", C.stamp(F.expr("ts + INTERVAL 2 HOURS")).alias("later"),
                    C.stamp(F.expr("ts - INTERVAL 7 DAYS")).alias("earlier"))


@query("F13_numeric", f"""
    SELECT l_orderkey, l_linenumber, {half_up("l_extendedprice", 1)} AS rounded,
           CAST(ceil(l_quantity / 7) AS BIGINT) AS ceiled, abs(l_tax - l_discount) AS gap,
           greatest(l_tax, l_discount) AS larger,
           CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS guarded,
           NULLIF(l_returnflag, 'N') AS flag FROM lineitem""")
def f13(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round("l_extendedprice", 1).alias("rounded"),
        F.ceil(F.col("l_quantity") / 7).alias("ceiled"), F.abs(F.col("l_tax") - F.col("l_discount")).alias("gap"),
        F.greatest("l_tax", "l_discount").alias("larger"), F.try_divide("l_tax", "l_discount").alias("guarded"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag"))


@query("F14_metered_charge", """
    SELECT l_orderkey, l_linenumber, units, CAST(round(units * CAST(0.0125 AS DECIMAL(10,5)), 5) AS DOUBLE) AS charge
    FROM (SELECT l_orderkey, l_linenumber, CAST(CASE l_returnflag WHEN 'R' THEN ceil(l_quantity * 7 / 60)
          WHEN 'A' THEN ceil(l_extendedprice * 100 / 1048576) ELSE 1 END AS BIGINT) AS units FROM lineitem)""")
def f14(t):
    service = F.when(F.col("l_returnflag") == "R", "VOICE").when(F.col("l_returnflag") == "A", "DATA") \
        .otherwise("SMS")
    units = C.metered_units(service, F.col("l_quantity") * 7, F.lit(None).cast("int"),
                            F.col("l_extendedprice") * 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", units.alias("units")).withColumn(
        "charge", C.as_double(F.round(F.col("units") * F.lit(0.0125).cast("decimal(10,5)"), 5)))


@query("F15_units", """
    SELECT event_id, (value - 32) * 5 / 9 AS celsius, value * 60 AS seconds,
           value * 8 / 1000000 / 900.0 AS mbps FROM events""")
def f15(t):
    return t.events.select("event_id", C.fahrenheit_to_celsius("value").alias("celsius"),
                           (F.col("value") * 60).alias("seconds"), C.mbps("value", 900).alias("mbps"))


@query("F16_json_path", """
    SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS k FROM events""")
def f16(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("F17_arrays", """
    SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS size_of,
           array_to_string(list_sort([max(l_linenumber), min(l_linenumber), 0]), ',') AS sorted
    FROM lineitem GROUP BY 1""")
def f17(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("hi"), F.min("l_linenumber").alias("lo"))
    return g.select(
        "l_orderkey", F.size(F.sequence(F.lit(1), "hi")).cast("bigint").alias("size_of"),
        F.array_join(F.sort_array(F.array("hi", "lo", F.lit(0))), ",").alias("sorted"))


@query("F18_maps_structs", """
    SELECT n_nationkey, n_name AS label, n_regionkey * 10 AS tens FROM nation""")
def f18(t):
    packed = t.nation.select("n_nationkey", F.struct("n_name").alias("s"),
                             F.create_map(F.lit("tens"), F.col("n_regionkey") * 10).alias("m"))
    return packed.select("n_nationkey", F.col("s.n_name").alias("label"), F.col("m")["tens"].alias("tens"))


PROMOS = """(SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
    WHEN o_orderpriority = '3-MEDIUM' THEN [] ELSE string_split(o_orderpriority, '-') END AS promos FROM orders)"""


def promos(t):
    p = F.col("o_orderpriority")
    return t.orders.select("o_orderkey", F.when(p == "3-MEDIUM", F.array().cast("array<string>"))
                           .when(p != "5-LOW", F.split(p, "-")).alias("promos"))


@query("F19_explode", f"SELECT o_orderkey, unnest(promos) AS promo FROM {PROMOS}")
def f19(t):
    return promos(t).select("o_orderkey", F.explode("promos").alias("promo"))


@query("F19_explode_outer", f"""
    SELECT o_orderkey, unnest(CASE WHEN promos IS NULL OR len(promos) = 0 THEN [NULL] ELSE promos END) AS promo
    FROM {PROMOS}""")
def f19_outer(t):
    return promos(t).select("o_orderkey", F.explode_outer("promos").alias("promo"))


@query("F19_posexplode", f"""
    SELECT o_orderkey, CAST(i - 1 AS INTEGER) AS pos, promos[i] AS promo
    FROM (SELECT o_orderkey, promos, unnest(range(1, len(promos) + 1)) AS i FROM {PROMOS})""")
def f19_pos(t):
    return promos(t).select("o_orderkey", F.posexplode("promos").alias("pos", "promo"))


@query("F20_time_grid", """
    SELECT user_id, CAST(count(*) AS BIGINT) AS slots, strftime(min(slot), '%Y-%m-%d %H:%M:%S') AS first_slot,
           strftime(max(slot), '%Y-%m-%d %H:%M:%S') AS last_slot
    FROM (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS slot FROM (
            SELECT user_id, date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi
            FROM events GROUP BY 1)) GROUP BY 1""")
def f20(t):
    ends = t.events.groupBy("user_id").agg(F.date_trunc("day", F.min("ts")).alias("lo"),
                                           F.date_trunc("day", F.max("ts")).alias("hi"))
    grid = ends.select("user_id", F.explode(F.expr("sequence(lo, hi, INTERVAL 6 HOURS)")).alias("slot"))
    return grid.groupBy("user_id").agg(F.count("*").alias("slots"), C.stamp(F.min("slot")).alias("first_slot"),
                                       C.stamp(F.max("slot")).alias("last_slot"))


@query("F21_checksum", f"""
    SELECT sha256(string_agg(line, chr(10) ORDER BY line)) AS checksum, CAST(count(*) AS BIGINT) AS lines
    FROM (SELECT n_name || '|' || CAST(CAST(sum({NET}) AS DECIMAL(18,2)) AS VARCHAR) || '|' || CAST(count(*) AS VARCHAR) AS line
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)""")
def f21(t):
    from lakeops.functions.aggregates import content_checksum
    sales = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    rolled = sales.groupBy("n_name").agg(
        F.sum(C.net_amount("l_extendedprice", "l_discount")).cast("decimal(18,2)").alias("net"),
        F.count("*").alias("n"))
    return content_checksum(rolled, ["n_name", "net", "n"])


@query("F23_variant", """
    SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k, TRUE AS has_no_z FROM events""")
def f23(t):
    v = F.parse_json("props")
    return t.events.select("event_id", F.variant_get(v, "$.k", "bigint").alias("k"),
                           F.variant_get(v, "$.z", "string").isNull().alias("has_no_z"))


# ------------------------------------------------------------------ set operations
@query("U1_union_by_position", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'P'""")
def u1(t):
    o = t.orders
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return a.union(o.where("o_orderstatus = 'P'").select("o_orderkey", "o_orderpriority", "o_orderstatus"))


@query("U2_union_by_name", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def u2(t):
    o = t.orders
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = o.where("o_orderstatus = 'P'").select("o_orderpriority", "o_orderkey", "o_orderstatus")
    return setops.stack(a, b)


@query("U3_union_missing_columns", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def u3(t):
    o = t.orders
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return setops.stack(a, o.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus"), fill_missing=True)


@query("U4_distinct", """
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS keys
    FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_orderkey, l_linenumber FROM lineitem) GROUP BY 1, 2""")
def u4(t):
    cols = ["l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber"]
    rows = t.lineitem.select(*cols).distinct().dropDuplicates(cols)
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("keys"))


@query("U5_table_diff", """
    WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'O'),
         a AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                      o_totalprice FROM orders WHERE o_orderstatus <> 'F')
    SELECT COALESCE(b.o_orderkey, a.o_orderkey) AS o_orderkey,
           CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN a.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
           b.o_orderstatus AS old_o_orderstatus, a.o_orderstatus AS new_o_orderstatus,
           b.o_totalprice AS old_o_totalprice, a.o_totalprice AS new_o_totalprice
    FROM b FULL JOIN a ON b.o_orderkey = a.o_orderkey
    WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR b.o_orderstatus <> a.o_orderstatus
       OR b.o_totalprice <> a.o_totalprice""")
def u5(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    before = o.where("o_orderstatus <> 'O'").drop("o_orderpriority")
    after = o.where("o_orderstatus <> 'F'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("o_orderstatus"))
    ).drop("o_orderpriority")
    return setops.table_diff(before, after, ["o_orderkey"])


# ------------------------------------------------------------------ sort, limit, split
@query("O1_global_sort", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""")
def o1(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query("O3_top_k", """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 5""")
def o3(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(
        F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber").limit(5)


@query("O6_stable_split", """
    SELECT CASE WHEN f < 0.8 THEN 'train' ELSE 'validation' END AS split, CAST(count(*) AS BIGINT) AS customers,
           CAST(sum(c_custkey) AS BIGINT) AS key_sum
    FROM (SELECT c_custkey, CAST(CAST('0x' || substring(sha256('split|' || c_custkey), 1, 8) AS BIGINT) AS DOUBLE)
                 / 4294967296.0 AS f FROM customer) GROUP BY 1""")
def o6(t):
    part = F.when(C.stable_fraction(["c_custkey"], "split") < 0.8, "train").otherwise("validation")
    return t.customer.groupBy(part.alias("split")).agg(
        F.count("*").alias("customers"), F.sum("c_custkey").alias("key_sum"))
