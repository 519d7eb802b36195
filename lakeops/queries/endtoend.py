"""End-to-end jobs (E) bound to the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.jobs import cdr, churn, clicks, coldchain, ledger, meters, metrics, orders, radio, settlement, vitals
from lakeops.jobs import erasure as erasure_job
from lakeops.operators import scans as S
from lakeops.queries.aggregates import PRICE, TOTAL
from lakeops.queries.joined import IV
from lakeops.queries.projections import NET, RAW_READING, raw_reading
from lakeops.queries.state import KEYS, LEDGER_LOG, LOG, ORDER, ledger_log, state_sql, version_log
from lakeops.queries.windowed import HISTORY, history, ts
from lakeops.registry import ORACLES, half_up, query

RUN_DATE = "2000-06-30"
RUN = f"DATE '{RUN_DATE}'"


@query("E1_medallion_revenue", f"""
    WITH lines AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1),
    m AS (SELECT upper(trim(r_name)) AS region, strftime(o_orderdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS lines, sum({NET}) AS net
          FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT region, month, CAST(rk AS INTEGER) AS rank, lines, CAST(net AS DOUBLE) AS revenue
    FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY net DESC, month) AS rk FROM m) WHERE rk <= 2""")
def e1(t):
    return orders.medallion_revenue(t.orders, t.lineitem, t.customer, t.nation, t.region)


# ------------------------------------------------------------------ call records
TARIFFS = [("UK", "VOICE", "F", 7, 0.0125), ("UK", "VOICE", "O", None, 0.02), ("UK", "DATA", "F", None, 0.4), ("UK", "SMS", "O", None, 0.05)]
TARIFF_SQL = ", ".join(f"('{s}', '{p}', {'NULL' if i is None else i}, {r})" for _, s, p, i, r in TARIFFS)
RAW_CDR = """(SELECT l_orderkey || '-' || l_linenumber AS cdr_id, l_shipdate AS event_ts, l_partkey, l_suppkey, l_quantity, l_linestatus AS plan, l_extendedprice,
      CASE WHEN l_discount = 0 THEN -l_quantity WHEN l_tax = 0.08 THEN l_quantity * 5000 ELSE l_quantity * 7 END AS dur,
      CASE WHEN l_discount <> 0.01 THEN '+' || l_partkey || '-0' END AS b, CASE l_returnflag WHEN 'R' THEN 'VOICE' WHEN 'A' THEN 'DATA' ELSE 'SMS' END AS service,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem)"""


def raw_cdr(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("cdr_id"), F.col("l_shipdate").alias("event_ts"),
        F.col("l_shipdate").alias("source_ts"), F.col("l_partkey").alias("ingest_ts"), "l_suppkey", "l_quantity",
        F.concat(F.lit("+"), F.col("l_orderkey").cast("string")).alias("a_number"),
        F.when(F.col("l_discount") != 0.01, F.concat(F.lit("+"), F.col("l_partkey").cast("string"), F.lit("-0"))).alias("b_number"),
        F.when(F.col("l_returnflag") == "R", "VOICE").when(F.col("l_returnflag") == "A", "DATA").otherwise("SMS").alias("service_type"),
        F.col("l_linestatus").alias("tariff_plan_id"),
        F.when(F.col("l_discount") == 0, -q).when(F.col("l_tax") == 0.08, q * 5000).otherwise(q * 7).alias("duration_sec"),
        (F.col("l_extendedprice") * 100).alias("bytes_total"))


def mediated(t):
    tariffs = t.spark.createDataFrame(TARIFFS, "market string, service_type string, tariff_plan_id string, billing_increment_sec int, unit_rate double")
    # a window long enough to take in the whole table
    return cdr.mediate(raw_cdr(t), tariffs, "UK", "2001-12-31", 24 * 3000, tie=("l_suppkey", "l_quantity"))


@query("E2_cdr_mediation", f"""
    SELECT cdr_id, regexp_replace(b, '[^0-9+]', '', 'g') AS b_number, service AS service_type, CAST(greatest(dur, 0) AS INTEGER) AS duration_sec,
           CASE WHEN dur < 0 THEN 'NEGATIVE_DURATION' WHEN dur > 86400 THEN 'DURATION_OVER_24H' WHEN b IS NULL THEN 'MISSING_B_NUMBER' ELSE 'OK' END AS quality_flag,
           CAST(units AS BIGINT) AS charged_units, {half_up("units * COALESCE(rate, 0)", 5)} AS charge_amount,
           CASE WHEN rate IS NULL THEN 'UNRATED_NO_TARIFF' ELSE 'RATED' END AS rated_flag
    FROM (SELECT *, CASE service WHEN 'VOICE' THEN ceil(greatest(dur, 0) / COALESCE(inc, 60)) WHEN 'DATA' THEN ceil(l_extendedprice * 100 / 1048576) ELSE 1 END AS units
          FROM {RAW_CDR} LEFT JOIN (VALUES {TARIFF_SQL}) AS tf(s, p, inc, rate) ON service = s AND plan = p WHERE rn = 1)""")
def e2(t):
    return mediated(t).select("cdr_id", "b_number", "service_type", "duration_sec", "quality_flag", "charged_units",
                              "charge_amount", "rated_flag")


@query("E2_cdr_merge", f"""
    WITH m AS (SELECT cdr_id, event_ts, greatest(dur, 0) AS dur FROM {RAW_CDR} WHERE rn = 1)
    SELECT cdr_id, {ts("CASE WHEN plan_f THEN event_ts ELSE event_ts END")} AS source_ts,
           CAST(CASE WHEN plan_f AND even THEN dur WHEN plan_f THEN 0 ELSE dur END AS INTEGER) AS duration_sec
    FROM (SELECT *, dur > 100 AS plan_f, dur > 200 AS even FROM m)""")
def e2_merge(t):
    batch = mediated(t).select("cdr_id", "event_date", "source_ts", "duration_sec")
    # the table already holds the long calls: some with an older emission, the rest up to date
    held = batch.where("duration_sec > 100").withColumn("duration_sec", F.lit(0))
    older = F.when(F.col("d") > 200, F.expr("source_ts - INTERVAL 1 HOUR")).otherwise(F.col("source_ts"))
    target = held.join(batch.select("cdr_id", F.col("duration_sec").alias("d")), "cdr_id").withColumn("source_ts", older).drop("d")
    return cdr.merge_mediated(target, batch).select("cdr_id", C.stamp("source_ts").alias("source_ts"), "duration_sec")


# ------------------------------------------------------------------ radio
MAPPING = [("acme", "click", "call_attempts"), ("acme", "error", "call_drops"), ("acme", "view", "rrc_attempts"),
           ("acme", "purchase", "rrc_success"), ("acme", "signup", "dl_bytes")]


def counters(t):
    return t.events.select(F.col("user_id").alias("cell_id"), F.lit("acme").alias("vendor"), F.col("event_type").alias("counter_name"),
                           C.money("value").alias("counter_value"), F.col("ts").alias("counter_ts"))


def kpis(t):
    mapping = t.spark.createDataFrame(MAPPING, "vendor string, vendor_counter string, canonical_counter string")
    topology = t.events.groupBy(F.col("user_id").alias("cell_id")).agg(F.max("event_type").alias("technology"))
    return radio.cell_kpis(counters(t), mapping, topology, 86_400)


@query("E3_cell_kpis", f"""
    SELECT user_id AS cell_id, {ts("date_trunc('day', ts)")} AS window_start, max(tech) AS technology,
           CAST(COALESCE(sum(v) FILTER (WHERE event_type = 'click'), 0) AS DOUBLE) AS call_attempts,
           CASE WHEN COALESCE(sum(v) FILTER (WHERE event_type = 'click'), 0) > 0 THEN
             {half_up("100.0 * CAST(COALESCE(sum(v) FILTER (WHERE event_type = 'error'), 0) AS DOUBLE) / CAST(sum(v) FILTER (WHERE event_type = 'click') AS DOUBLE)", 4)} END AS drop_call_rate,
           CASE WHEN COALESCE(sum(v) FILTER (WHERE event_type = 'view'), 0) > 0 THEN
             {half_up("100.0 * CAST(COALESCE(sum(v) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE) / CAST(sum(v) FILTER (WHERE event_type = 'view') AS DOUBLE)", 4)} END AS rrc_success_rate,
           CAST(COALESCE(sum(v) FILTER (WHERE event_type = 'signup'), 0) AS DOUBLE) AS total_bytes
    FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS v FROM events) JOIN (SELECT user_id, max(event_type) AS tech FROM events GROUP BY 1) USING (user_id)
    GROUP BY 1, 2""")
def e3(t):
    return kpis(t).select("cell_id", C.stamp("window_start").alias("window_start"), "technology", C.as_double("call_attempts", "call_attempts"),
                          "drop_call_rate", "rrc_success_rate", C.as_double("total_bytes", "total_bytes"))


@query("E16_anomaly_summary", """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2),
    b AS (SELECT *, avg(n) OVER w AS mean, stddev_samp(n) OVER w AS sd FROM d
          WINDOW w AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT day, CAST(count(*) AS BIGINT) AS cells, CAST(count(*) FILTER (WHERE sd > 0 AND n > round(mean + 3 * sd, 9)) AS BIGINT) AS anomalous_cells FROM b GROUP BY 1""")
def e16(t):
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return radio.anomaly_summary(radio.sigma_anomalies(daily, ["user_id"], "day", "n"), "day")


# ------------------------------------------------------------------ churn features
def usage_events(t):
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subscriber_id"))
    return t.lineitem.join(o, "l_orderkey").select(
        "subscriber_id", F.to_date("l_shipdate").alias("event_date"), F.col("l_quantity").cast("bigint").alias("duration_sec"),
        F.when(F.col("l_returnflag") == "R", "VOICE").when(F.col("l_returnflag") == "A", "DATA").otherwise("SMS").alias("service_type"),
        F.col("l_extendedprice").cast("bigint").alias("bytes_total"), C.money("l_tax").alias("charge_amount"),
        F.col("l_partkey").alias("b_number"), (F.col("l_linestatus") == "O").alias("is_onnet"),
        F.when(F.col("l_discount") > 0, "OK").otherwise("NEGATIVE_DURATION").alias("quality_flag"),
        F.col("l_suppkey").alias("cell_id"), F.when(F.col("l_returnflag") == "R", "DROPPED").otherwise("NORMAL").alias("call_end_cause"))


USAGE = """u AS (SELECT o_custkey AS id, CAST(l_shipdate AS DATE) AS d, CAST(l_quantity AS BIGINT) AS sec, l_returnflag AS f, l_linestatus AS st,
    CAST(trunc(l_extendedprice) AS BIGINT) AS bytes, CAST(l_tax AS DECIMAL(18,2)) AS charge, l_partkey AS b, l_suppkey AS cell, l_discount AS disc,
    date_diff('day', CAST(l_shipdate AS DATE), {run}) AS ago FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate > {run} - INTERVAL {days} DAY AND l_shipdate <= {run})"""


def subscribers(t):
    """Customers with activation and churn dates taken from their orders."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.min("o_orderdate")).alias("activation_date"), F.to_date(F.max("o_orderdate")).alias("last_order"))
    return t.customer.join(per, "c_custkey").select(
        F.col("c_custkey").alias("subscriber_id"), F.col("c_nationkey").alias("market"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") < 0, "SUSPENDED").otherwise("ACTIVE").alias("status"), "activation_date",
        F.when(F.col("c_mktsegment") == "BUILDING", F.date_sub("last_order", 400)).alias("churn_date"))


SUBSCRIBERS = """s AS (SELECT c_custkey AS id, c_nationkey AS market, c_mktsegment AS segment, CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status,
    CAST(min(o_orderdate) AS DATE) AS act, CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(CAST(max(o_orderdate) AS DATE) - INTERVAL 400 DAY AS DATE) END AS churn
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3, 4)"""


@query("E4_usage_features", f"""
    WITH {USAGE.format(run=RUN, days=90)}, {SUBSCRIBERS},
    g AS (SELECT id, CAST(sum(CASE WHEN ago < 7 THEN sec ELSE 0 END) AS BIGINT) AS v7, CAST(sum(sec) AS BIGINT) AS v90,
            CAST(sum(CASE WHEN ago < 30 THEN sec ELSE 0 END) AS BIGINT) AS v30, CAST(sum(CASE WHEN ago < 7 AND f = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS sms7,
            sum(CASE WHEN ago < 30 THEN bytes ELSE 0 END) AS b30, max(d) AS latest,
            CAST(sum(CASE WHEN ago < 30 AND f = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS sms30, sum(CASE WHEN ago < 7 THEN bytes ELSE 0 END) AS b7, sum(bytes) AS b90,
            sum(CASE WHEN ago < 30 THEN charge ELSE 0 END) AS c30, sum(charge) AS c90, count(DISTINCT CASE WHEN ago < 30 THEN b END) AS d30, count(DISTINCT b) AS d90,
            sum(CASE WHEN ago < 30 AND st <> 'O' THEN 1 ELSE 0 END) AS off30, sum(CASE WHEN ago < 30 THEN 1 ELSE 0 END) AS e30, min(ago) AS since
          FROM u WHERE disc > 0 GROUP BY 1)
    SELECT g.id AS subscriber_id, CASE WHEN date_diff('day', act, {RUN}) >= 7 THEN v7 END AS voice_sec_7d, v90 AS voice_sec_90d, sms30 AS sms_30d,
           CASE WHEN v90 > 0 THEN {half_up("(CAST(v7 AS DOUBLE) / 7) / (CAST(v90 AS DOUBLE) / 90)", 4)} END AS voice_trend_7_90,
           CASE WHEN b90 > 0 THEN {half_up("(CAST(b7 AS DOUBLE) / 7) / (CAST(b90 AS DOUBLE) / 90)", 4)} END AS data_trend_7_90,
           CASE WHEN c90 > 0 THEN {half_up("(CAST(c30 AS DOUBLE) / 30) / (CAST(c90 AS DOUBLE) / 90)", 4)} END AS spend_trend_30_90,
           CASE WHEN d90 > 0 THEN {half_up("CAST(d30 * 3 AS DOUBLE) / d90", 4)} END AS social_graph_shrink,
           CASE WHEN e30 > 0 THEN {half_up("CAST(off30 AS DOUBLE) / e30", 4)} END AS offnet_share_30d,
           CASE WHEN date_diff('day', act, {RUN}) >= 7 THEN since >= 7 END AS is_dormant_7d,
           v30 AS voice_sec_30d, sms7 AS sms_7d, CAST(b7 AS BIGINT) AS bytes_7d, CAST(b30 AS BIGINT) AS bytes_30d, CAST(b90 AS BIGINT) AS bytes_90d, CAST(c30 AS DOUBLE) AS charge_30d,
           CAST(c90 AS DOUBLE) AS charge_90d, CAST(off30 AS BIGINT) AS offnet_calls_30d, CAST(e30 AS BIGINT) AS events_30d, CAST(d30 AS BIGINT) AS distinct_b_30d,
           CAST(d90 AS BIGINT) AS distinct_b_90d, CAST(since AS INTEGER) AS days_since_last_event, latest AS last_event_date FROM g JOIN s ON g.id = s.id""")
def e4(t):
    return churn.usage_features(usage_events(t), subscribers(t), RUN_DATE).select(
        "subscriber_id", "voice_sec_7d", "voice_sec_90d", "sms_30d", "voice_trend_7_90", "data_trend_7_90", "spend_trend_30_90",
        "social_graph_shrink", "offnet_share_30d", "is_dormant_7d", "voice_sec_30d", "sms_7d", "bytes_7d", "bytes_30d", "bytes_90d",
        C.as_double("charge_30d", "charge_30d"), C.as_double("charge_90d", "charge_90d"), "offnet_calls_30d", "events_30d",
        "distinct_b_30d", "distinct_b_90d", "days_since_last_event", "last_event_date")


def bills(t):
    return t.orders.select(
        F.col("o_custkey").alias("subscriber_id"), F.to_date("o_orderdate").alias("bill_date"), "o_orderkey", C.money("o_totalprice").alias("bill_amount"),
        (F.col("o_orderstatus") == "F").alias("has_roaming"), (F.col("o_orderpriority") == "1-URGENT").alias("has_overage"))


def payments(t):
    return t.orders.select(
        F.col("o_custkey").alias("subscriber_id"), F.to_date("o_orderdate").alias("payment_date"),
        (F.split("o_orderpriority", "-")[0].cast("int") - 3).alias("days_late"),
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("PAID").alias("payment_status"))


@query("E5_billing_features", f"""
    WITH b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders
               WHERE CAST(o_orderdate AS DATE) <= {RUN} AND CAST(o_orderdate AS DATE) > {RUN} - INTERVAL 12 MONTH),
    g AS (SELECT o_custkey AS id, CAST(sum({TOTAL}) AS DOUBLE) / count(*) AS mean, stddev_samp(o_totalprice) AS sd, max(o_totalprice) AS top, count(*) AS n,
            count(*) FILTER (WHERE o_orderstatus = 'F') AS roam, max(o_totalprice) FILTER (WHERE rn = 1) AS last_bill,
            quantile_disc(o_totalprice, 0.5) FILTER (WHERE rn > 1) AS med, count(*) FILTER (WHERE CAST(o_orderpriority[1] AS INTEGER) > 3) AS late,
            max(CAST(o_orderpriority[1] AS INTEGER) - 3) AS worst, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed,
            CAST(sum(CAST(o_orderpriority[1] AS INTEGER) - 3) AS DOUBLE) / count(*) AS lateness, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS over,
            max(CAST(o_orderdate AS DATE)) AS last_date FROM b GROUP BY 1)
    SELECT id AS subscriber_id, {half_up("mean", 2)} AS avg_bill_12m, {half_up("sd", 2)} AS stddev_bill_12m, top AS max_bill_12m, CAST(n AS BIGINT) AS bills_12m,
           CAST(roam AS BIGINT) AS roaming_months_12m, last_bill AS last_bill_amount, med AS median_bill_amount,
           CASE WHEN med > 0 THEN {half_up("last_bill / med", 4)} END AS bill_shock_ratio, CAST(late AS BIGINT) AS late_payments_12m,
           CAST(failed AS BIGINT) AS failed_payments_12m, worst AS max_days_late_12m, {half_up("CAST(late AS DOUBLE) / n", 4)} AS late_payment_rate_12m,
           {half_up("lateness", 2)} AS avg_days_late_12m, CAST(over AS BIGINT) AS overage_months_12m, CAST(n AS BIGINT) AS payments_12m, last_date AS last_bill_date,
           {half_up(half_up("sd", 2) + " / " + half_up("mean", 2), 4)} AS bill_volatility FROM g""")
def e5(t):
    f = churn.billing_features(bills(t), payments(t), RUN_DATE, tie=["o_orderkey"])
    amounts = ("avg_bill_12m", "max_bill_12m", "last_bill_amount", "median_bill_amount")
    return f.withColumns({c: C.as_double(c) for c in amounts}).select(
        "subscriber_id", "avg_bill_12m", "stddev_bill_12m", "max_bill_12m", "bills_12m", "roaming_months_12m", "last_bill_amount",
        "median_bill_amount", "bill_shock_ratio", "late_payments_12m", "failed_payments_12m", "max_days_late_12m",
        "late_payment_rate_12m", "bill_volatility", "avg_days_late_12m", "overage_months_12m", "payments_12m", "last_bill_date")


def topups(t):
    return t.orders.select(
        F.col("o_custkey").alias("subscriber_id"), F.to_date("o_orderdate").alias("topup_date"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("SUCCESS").alias("status"), C.money("o_totalprice").alias("topup_amount"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "APP").otherwise(F.col("o_orderpriority")).alias("channel"))


@query("E6_topup_features", f"""
    WITH b AS (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS d, o_orderkey, {TOTAL} AS amount, o_orderpriority AS ch FROM orders
               WHERE CAST(o_orderdate AS DATE) <= {RUN} AND CAST(o_orderdate AS DATE) > {RUN} - INTERVAL 720 DAY AND o_orderstatus <> 'P'),
    x AS (SELECT *, CAST(date_diff('day', lag(d) OVER (PARTITION BY id ORDER BY d, o_orderkey), d) AS INTEGER) AS gap FROM b),
    g AS (SELECT id, count(*) AS n, sum(amount) AS total, avg(gap) AS mean, quantile_disc(gap, 0.5) AS med, stddev_samp(gap) AS sd,
            date_diff('day', max(d), {RUN}) AS since, max(d) AS latest, count(*) FILTER (WHERE ch = '1-URGENT') AS app, count(DISTINCT ch) AS chs FROM x GROUP BY 1),
    r AS (SELECT *, CASE WHEN med > 0 THEN {half_up("CAST(since AS DOUBLE) / med", 3)} END AS ratio FROM g)
    SELECT id AS subscriber_id, CAST(n AS BIGINT) AS topups_720d, CAST(total AS DOUBLE) AS topup_amount_720d, {half_up("CAST(total AS DOUBLE) / n", 2)} AS avg_topup_amount, CAST(app AS BIGINT) AS app_topups,
           latest AS last_topup_date, {half_up("sd", 2)} AS stddev_gap_days, {half_up("mean", 2)} AS avg_gap_days, med AS median_gap_days,
           CAST(since AS INTEGER) AS days_since_last_topup, ratio AS overdue_ratio, ratio >= 2.0 AS is_overdue_2x, CAST(chs AS BIGINT) AS distinct_channels,
           {half_up("CAST(app AS DOUBLE) / n", 4)} AS app_topup_share, CASE WHEN {half_up("mean", 2)} > 0 THEN {half_up(half_up("sd", 2) + " / " + half_up("mean", 2), 4)} END AS topup_regularity FROM r""")
def e6(t):
    return churn.topup_features(topups(t), RUN_DATE, 720, ["o_orderkey"]).select(
        "subscriber_id", "topups_720d", C.as_double("topup_amount_720d", "topup_amount_720d"), C.as_double("avg_topup_amount", "avg_topup_amount"),
        "app_topups", "last_topup_date", "stddev_gap_days", "avg_gap_days", "median_gap_days",
        "days_since_last_topup", "overdue_ratio", "is_overdue_2x", "distinct_channels", "app_topup_share", "topup_regularity")


@query("E7_network_features", f"""
    WITH {USAGE.format(run=RUN, days=30)}, use AS (SELECT id, cell, count(*) AS n, sum(sec) AS s, count(*) FILTER (WHERE f = 'R') AS dr FROM u GROUP BY 1, 2),
    busy AS (SELECT l_suppkey AS cell, {half_up("CAST(sum(load) AS DOUBLE) / count(*)", 2)} AS cong FROM (
      SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS load FROM lineitem
      WHERE l_shipdate > {RUN} - INTERVAL 30 DAY AND l_shipdate <= {RUN} AND l_linestatus = 'O' GROUP BY 1, 2) GROUP BY 1),
    q AS (SELECT l_suppkey AS cell, {half_up("100.0 * CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / count(*)", 4)} AS rate, max(l_linestatus) AS tech
          FROM lineitem WHERE l_shipdate > {RUN} - INTERVAL 30 DAY AND l_shipdate <= {RUN} AND l_linestatus = 'O' GROUP BY 1),
    j AS (SELECT use.*, rate, tech, cong, row_number() OVER (PARTITION BY id ORDER BY s DESC, use.cell) AS rn FROM use LEFT JOIN q ON use.cell = q.cell
          LEFT JOIN busy ON use.cell = busy.cell)
    SELECT id AS subscriber_id, CASE WHEN sum(CASE WHEN rate IS NOT NULL THEN s END) > 0 THEN
             {half_up("sum(rate * s) / CAST(sum(CASE WHEN rate IS NOT NULL THEN s END) AS DOUBLE)", 4)} END AS weighted_drop_rate_exposure,
           {half_up("CAST(sum(CASE WHEN rate IS NOT NULL THEN s ELSE 0 END) AS DOUBLE) / CAST(sum(s) AS DOUBLE)", 4)} AS rated_time_share,
           CAST(count(*) AS BIGINT) AS distinct_cells_30d, max(cell) FILTER (WHERE rn = 1) AS home_cell_id, max(rate) FILTER (WHERE rn = 1) AS home_cell_drop_rate,
           CASE WHEN sum(CASE WHEN cong IS NOT NULL THEN s END) > 0 THEN
             {half_up("sum(cong * s) / CAST(sum(CASE WHEN cong IS NOT NULL THEN s END) AS DOUBLE)", 4)} END AS weighted_congestion_exposure,
           max(cong) FILTER (WHERE rn = 1) AS home_cell_congestion, max(tech) FILTER (WHERE rn = 1) AS home_cell_technology,
           CAST(sum(dr) AS BIGINT) AS own_dropped_calls_30d, CAST(sum(n) AS BIGINT) AS cell_events_30d,
           {half_up("100.0 * CAST(sum(dr) AS DOUBLE) / CAST(sum(n) AS DOUBLE)", 4)} AS own_drop_rate_30d,
           CASE WHEN count(*) <= 3 THEN 'STATIC' WHEN count(*) <= 20 THEN 'LOCAL' ELSE 'MOBILE' END AS mobility_bucket FROM j GROUP BY 1""")
def e7(t):
    k = t.lineitem.where("l_linestatus = 'O'").groupBy(F.col("l_suppkey").alias("cell_id"), F.to_date("l_shipdate").alias("window_start")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("call_drops"), F.count("*").alias("call_attempts"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("prb_utilisation"), F.avg("l_quantity").alias("throughput_mbps"), F.max("l_linestatus").alias("technology"))
    return churn.network_features(usage_events(t), k, RUN_DATE).select(
        "subscriber_id", "weighted_drop_rate_exposure", "rated_time_share", "distinct_cells_30d", "home_cell_id",
        "home_cell_drop_rate", "own_drop_rate_30d", "mobility_bucket", "weighted_congestion_exposure", "home_cell_congestion",
        "home_cell_technology", "own_dropped_calls_30d", "cell_events_30d")


REASONS = {"1-URGENT": "BILLING", "2-HIGH": "NETWORK", "3-MEDIUM": "CANCELLATION", "4-NOT SPECIFIED": "DEVICE"}


def contacts(t):
    reason = F.lit("STRANGE")
    for priority, topic in REASONS.items():
        reason = F.when(F.col("o_orderpriority") == priority, topic).otherwise(reason)
    return t.orders.select(
        F.col("o_custkey").alias("subscriber_id"), F.to_date("o_orderdate").alias("contact_date"), "o_orderkey", reason.alias("reason_category"),
        F.col("o_custkey").alias("handling_time_sec"), F.split("o_orderpriority", "-")[0].cast("int").alias("csat_score"),
        (F.col("o_orderstatus") == "F").alias("resolved"), F.col("o_orderstatus").alias("channel"))


CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REASONS.items())


CARE_MATRIX = [f"care_{topic.lower()}_{n}d" for topic in churn.TOPICS for n in (720, 30)]
CARE_COUNTS = ", ".join(f"CAST(count(*) FILTER (WHERE topic = '{topic}' AND ago < {n}) AS BIGINT) AS care_{topic.lower()}_{n}d"
                        for topic in churn.TOPICS for n in (720, 30))


@query("E8_care_features", f"""
    WITH c AS (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS d, o_orderkey, CASE o_orderpriority {CASES} ELSE 'OTHER' END AS topic, o_orderstatus AS st,
                 CAST(o_orderpriority[1] AS INTEGER) AS csat, date_diff('day', CAST(o_orderdate AS DATE), {RUN}) AS ago FROM orders
               WHERE CAST(o_orderdate AS DATE) <= {RUN} AND CAST(o_orderdate AS DATE) > {RUN} - INTERVAL 720 DAY),
    r AS (SELECT *, COALESCE(date_diff('day', lag(d) OVER (PARTITION BY id, topic ORDER BY d, o_orderkey), d) <= 7, FALSE) AS rep FROM c),
    g AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE ago < 30) AS n30, count(*) FILTER (WHERE rep) AS reps, min(ago) AS since, avg(csat) AS csat, min(csat) AS lowest, avg(id) AS handling,
            count(*) FILTER (WHERE st <> 'F') AS un, count(*) FILTER (WHERE ago < 7) AS n7, count(DISTINCT st) AS chs, {CARE_COUNTS},
            count(*) FILTER (WHERE topic = 'CANCELLATION' AND ago < 720) AS canc FROM r GROUP BY 1)
    SELECT id AS subscriber_id, CAST(n AS BIGINT) AS care_contacts_720d, CAST(n30 AS BIGINT) AS care_contacts_30d, CAST(reps AS BIGINT) AS repeat_contacts_720d,
           CAST(since AS INTEGER) AS days_since_last_contact, {half_up("csat", 3)} AS avg_csat, CAST(lowest AS INTEGER) AS min_csat, {half_up("handling", 1)} AS avg_handling_time, {", ".join(CARE_MATRIX)},
           CAST(n7 AS BIGINT) AS care_contacts_7d, CAST(un AS BIGINT) AS unresolved_720d, CAST(chs AS BIGINT) AS distinct_channels,
           {half_up("CAST(un AS DOUBLE) / n", 4)} AS unresolved_rate, canc > 0 AS asked_about_cancellation, n30 >= 3 OR reps >= 2 AS recent_escalation FROM g""")
def e8(t):
    return churn.care_features(contacts(t), RUN_DATE, 720, ["o_orderkey"]).select(
        "subscriber_id", "care_contacts_720d", "care_contacts_30d", "repeat_contacts_720d", "days_since_last_contact", "avg_csat",
        *CARE_MATRIX, "care_contacts_7d", "unresolved_720d", "distinct_channels", "min_csat", "avg_handling_time", "unresolved_rate", "asked_about_cancellation", "recent_escalation")


@query("E9_device_features", f"""
    WITH h AS (SELECT * FROM {HISTORY} WHERE valid_from <= {RUN} AND (valid_to > {RUN} OR valid_to IS NULL)),
    f AS (SELECT o_custkey AS id, attribute, valid_from, CAST(valid_from + INTERVAL 730 DAY AS DATE) AS ends, CAST(valid_from - INTERVAL 100 DAY AS DATE) AS launched FROM h)
    SELECT id AS subscriber_id, attribute AS contract_type, CAST(date_diff('day', launched, {RUN}) AS INTEGER) AS device_age_days,
           CAST(date_diff('day', valid_from, {RUN}) AS INTEGER) AS days_on_current_device, CAST(date_diff('day', {RUN}, ends) AS INTEGER) AS days_to_contract_end,
           ends <= {RUN} AS out_of_contract, date_diff('day', {RUN}, ends) BETWEEN 0 AND 90 AS in_churn_window,
           date_diff('day', valid_from, {RUN}) > 730 AND date_diff('day', {RUN}, ends) < 90 AS device_upgrade_due,
           attribute <> '1-URGENT' AND attribute IN ('1-URGENT', '2-HIGH') AS paying_for_unusable_5g,
           CASE WHEN attribute IN ('1-URGENT', '2-HIGH') THEN 'Max 5G' ELSE 'Basic' END AS tariff_plan_id, ends AS contract_end_date,
           CAST(date_diff('day', valid_from, {RUN}) AS INTEGER) AS contract_tenure_days, attribute = '1-URGENT' AS is_5g_capable FROM f""")
def e9(t):
    h = history(t).withColumnRenamed("o_custkey", "subscriber_id")
    start = F.col("valid_from")
    con = h.select("subscriber_id", F.col("attribute").alias("contract_type"), start.alias("contract_start_date"),
                   F.date_add(start, 730).alias("contract_end_date"),
                   F.when(F.col("attribute").isin("1-URGENT", "2-HIGH"), "Max 5G").otherwise("Basic").alias("tariff_plan_id"), "valid_from", "valid_to")
    dev = h.select("subscriber_id", F.date_sub(start, 100).alias("device_launch_date"), start.alias("device_since"),
                   (F.col("attribute") == "1-URGENT").alias("is_5g_capable"), "valid_from", "valid_to")
    return churn.device_features(con, dev, RUN_DATE).select(
        "subscriber_id", "contract_type", "device_age_days", "days_on_current_device", "days_to_contract_end", "out_of_contract",
        "in_churn_window", "device_upgrade_due", "paying_for_unusable_5g", "tariff_plan_id", "contract_end_date", "contract_tenure_days",
        "is_5g_capable")


#: the six feature domains: name in the wide table and the query that builds them
DOMAINS = {"usage": ("E4_usage_features", e4), "billing": ("E5_billing_features", e5), "topup": ("E6_topup_features", e6),
           "network": ("E7_network_features", e7), "care": ("E8_care_features", e8), "device": ("E9_device_features", e9)}
DOMAIN_SQL = ", ".join(f"""{d}_in AS ({ORACLES[name]}), {d} AS (SELECT * EXCLUDE ({d}__subscriber_id) FROM (
    SELECT subscriber_id AS id, COLUMNS('^(.*)$') AS "{d}__\\1" FROM {d}_in))""" for d, (name, _) in DOMAINS.items())
WIDE = f"""{SUBSCRIBERS}, {DOMAIN_SQL}, wide AS (
    SELECT s.id AS subscriber_id, market, status, CAST(date_diff('day', act, {RUN}) AS INTEGER) AS tenure_days,
           {", ".join(f"{d}.* EXCLUDE (id)" for d in DOMAINS)}, CASE WHEN churn IS NULL THEN 0 WHEN churn <= {RUN} + INTERVAL 30 DAY THEN 1 ELSE 0 END AS label_churned_30d,
           TRUE AS label_is_observable, CASE WHEN CAST(CAST('0x' || substring(sha256('split|' || s.id), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.8 THEN 'train' ELSE 'validation' END AS split
    FROM s {" ".join(f"LEFT JOIN {d} ON s.id = {d}.id" for d in DOMAINS)} WHERE act <= {RUN} AND (churn IS NULL OR churn > {RUN}))"""


def subscriber_360(t):
    wide = churn.assemble(churn.active_base(subscribers(t), RUN_DATE), {d: build(t) for d, (_, build) in DOMAINS.items()}, ["subscriber_id"])
    return churn.with_label(wide, RUN_DATE, "2002-01-01").withColumn("split", churn.split_of(["subscriber_id"])).drop(
        "segment", "activation_date")


@query("E10_subscriber_360", f"WITH {WIDE} SELECT * FROM wide")
def e10(t):
    return subscriber_360(t)


MODEL_FEATURES = ["tenure_days", "usage__voice_sec_90d", "usage__voice_trend_7_90", "billing__bill_shock_ratio", "billing__late_payments_12m",
                  "topup__overdue_ratio", "network__weighted_drop_rate_exposure", "care__recent_escalation", "device__days_to_contract_end"]


@query("E10_model_sets", f"""
    WITH {WIDE}, told AS (SELECT subscriber_id, split, label_churned_30d AS label, {", ".join(f"CAST(COALESCE(CAST({c} AS DOUBLE), 0) AS DOUBLE) AS {c}" for c in MODEL_FEATURES)} FROM wide)
    SELECT split AS model_set, * EXCLUDE (split) FROM told UNION ALL SELECT 'inference', * EXCLUDE (split) REPLACE (NULL AS label) FROM told""")
def e10_sets(t):
    return churn.model_sets(subscriber_360(t), ["subscriber_id"], "label_churned_30d", "split", MODEL_FEATURES)


@query("E11_publish_scores", """
    SELECT DATE '2000-06-30' AS score_date, c_custkey AS subscriber_id, p AS churn_probability, tile AS risk_decile,
           CASE WHEN tile = 1 THEN 'CRITICAL' WHEN tile <= 2 THEN 'HIGH' WHEN tile <= 5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band, 'churn-xgb-20000630' AS model_version
    FROM (SELECT *, CAST(ntile(10) OVER (PARTITION BY c_nationkey ORDER BY p DESC, c_custkey) AS INTEGER) AS tile
          FROM (SELECT *, (c_acctbal + 1000) / 25000 AS p FROM customer))""")
def e11(t):
    scores = t.customer.select(F.col("c_custkey").alias("subscriber_id"), ((F.col("c_acctbal") + 1000) / 25000).alias("churn_probability"))
    subs = t.customer.select(F.col("c_custkey").alias("subscriber_id"), F.col("c_nationkey").alias("market"), F.col("c_mktsegment").alias("segment"))
    return churn.publish_scores(scores, subs, RUN_DATE).drop("market", "segment")


# ------------------------------------------------------------------ settlement
@query("E12_billing_changes", f"""
    WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn
                  FROM lineitem) WHERE rn = 1)
    SELECT COALESCE(o_orderkey, l_orderkey) AS bill_line_id, CAST(CASE WHEN o_orderkey IS NULL OR l_linenumber > 3 THEN l_linenumber ELSE 3 END AS INTEGER) AS transact_seq,
           CAST(CASE WHEN o_orderkey IS NULL OR l_linenumber > 3 THEN {PRICE} ELSE {TOTAL} END AS DOUBLE) AS bill_amount,
           CASE WHEN o_orderkey IS NULL OR l_linenumber > 3 THEN CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'P' || l_suppkey END ELSE 'PX' END AS partner_code
    FROM (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01') o FULL JOIN last ON o_orderkey = l_orderkey
    WHERE NOT (l_orderkey IS NOT NULL AND l_returnflag = 'R')""")
def e12(t):
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("bill_line_id"), F.col("l_linenumber").alias("transact_seq"), F.col("l_shipdate").alias("transact_ts"),
        F.when(F.col("l_returnflag") == "R", "D").when(F.col("l_returnflag") == "A", "U").otherwise("I").alias("Op"),
        F.col("l_extendedprice").alias("bill_amount"),
        F.when(F.col("l_linestatus") == "O", "OWN").otherwise(F.concat(F.lit("P"), F.col("l_suppkey").cast("string"))).alias("terminating_network"),
        "l_partkey", "l_suppkey", "l_quantity")
    target = t.orders.where("o_orderdate < TIMESTAMP '1999-01-01'").select(
        F.col("o_orderkey").alias("bill_line_id"), F.lit(3).alias("transact_seq"), C.money("o_totalprice", 5).alias("bill_amount"),
        F.lit("PX").alias("partner_code"))
    norm = settlement.normalise_billing(raw, ("l_partkey", "l_suppkey", "l_quantity"))
    return settlement.merge_billing(target, norm).withColumn("bill_amount", C.as_double("bill_amount"))


RATES = [("R", 0.92), ("N", 1.17)]
LEDGERS = f"""
    o AS (SELECT 'P' || l_suppkey AS partner, l_orderkey AS a, l_partkey AS b, l_shipdate AS m, l_quantity AS dur, {PRICE} AS charge,
            row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_partkey, l_shipdate ORDER BY l_quantity, l_linenumber) AS leg FROM lineitem WHERE l_tax > 0),
    p AS (SELECT 'P' || l_suppkey AS partner, l_orderkey AS a, l_partkey AS b, l_shipdate AS m, l_quantity + l_discount * 50 AS dur,
            round({PRICE} * CASE l_returnflag WHEN 'R' THEN CAST(0.92 AS DECIMAL(10,5)) ELSE CAST(1.17 AS DECIMAL(10,5)) END, 5) AS charge,
            row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_partkey, l_shipdate ORDER BY l_quantity + l_discount * 50, l_linenumber) AS leg FROM lineitem WHERE l_returnflag <> 'A'),
    j AS (SELECT COALESCE(o.partner, p.partner) AS partner, COALESCE(o.m, p.m) AS m, o.dur AS od, p.dur AS pd, o.charge AS oc, p.charge AS pc,
            CASE WHEN o.leg IS NULL THEN 'OURS' WHEN p.leg IS NULL THEN 'THEIRS' WHEN abs(o.dur - p.dur) <= 2 THEN 'MATCHED' ELSE 'MISMATCH' END AS st
          FROM o FULL JOIN p ON o.partner = p.partner AND o.a = p.a AND o.b = p.b AND o.m = p.m AND o.leg = p.leg)"""


def match(t):
    leg = lambda df, d, *more: df.select(
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("partner_code"), F.col("l_orderkey").alias("a_number"),
        F.col("l_partkey").alias("b_number"), F.col("l_shipdate").alias("event_ts"), d.alias("duration"),
        C.money("l_extendedprice").alias("charge"), F.col("l_linenumber").alias("leg_id"), *more)
    ours = leg(t.lineitem.where("l_tax > 0"), F.col("l_quantity"))
    theirs = leg(t.lineitem.where("l_returnflag <> 'A'"), F.col("l_quantity") + F.col("l_discount") * 50, F.col("l_returnflag").alias("currency"))
    fx = t.spark.createDataFrame(RATES, "currency string, rate double").withColumn("rate", F.col("rate").cast("decimal(10,5)"))
    return settlement.match_ledgers(ours, theirs, fx)


VARIANCE = """SELECT partner AS partner_code, CAST(count(*) AS BIGINT) AS total_legs, CAST(count(*) FILTER (WHERE st = 'MATCHED') AS BIGINT) AS matched_legs,
    CAST(count(*) FILTER (WHERE st = 'OURS') AS BIGINT) AS missing_ours, CAST(count(*) FILTER (WHERE st = 'THEIRS') AS BIGINT) AS missing_theirs,
    CAST(count(*) FILTER (WHERE st = 'MISMATCH') AS BIGINT) AS duration_mismatches, CAST(round(COALESCE(sum(oc), 0), 2) AS DOUBLE) AS our_charge_eur,
    CAST(round(COALESCE(sum(pc), 0), 2) AS DOUBLE) AS their_charge_eur"""


@query("E14_reconcile_ledgers", f"""
    WITH {LEDGERS} {VARIANCE}, {half_up("CAST(count(*) FILTER (WHERE st = 'MATCHED') AS DOUBLE) / count(*)", 5)} AS match_rate,
    CAST(round(COALESCE(sum(oc), 0), 2) - round(COALESCE(sum(pc), 0), 2) AS DOUBLE) AS variance_eur FROM j GROUP BY 1""")
def e14(t):
    v = settlement.variance(match(t))
    return v.drop("our_minutes", "their_minutes").withColumns({c: C.as_double(c) for c in ("our_charge_eur", "their_charge_eur", "variance_eur")})


def daily_variance(t):
    m = match(t).withColumn("settlement_date", F.to_date("call_minute"))
    return settlement.variance(m, ["partner_code", "settlement_date"])


STATEMENT = """d AS (SELECT partner, m, {0} AS om, {1} AS tm, round(COALESCE(sum(oc), 0), 2) AS oc, round(COALESCE(sum(pc), 0), 2) AS pc, count(*) AS legs, count(*) FILTER (WHERE st = 'MATCHED') AS ok
    FROM j WHERE strftime(m, '%Y-%m') = '1998-06' GROUP BY 1, 2)"""


@query("E15_settlement_statement", f"""
    WITH {LEDGERS}, {STATEMENT.format(*[f'CAST({half_up(f"CAST(sum(COALESCE(CAST({c} AS DECIMAL(18,4)), 0)) AS DOUBLE) / 60", 2)} AS DECIMAL(18,2))' for c in ("od", "pd")])},
    line AS (SELECT concat_ws('|', partner, sum(om), sum(tm), sum(oc), sum(pc), sum(oc - pc)) AS x FROM d GROUP BY partner)
    SELECT partner AS partner_code, CAST(sum(oc) AS DOUBLE) AS we_billed_eur, CAST(sum(pc) AS DOUBLE) AS they_billed_eur, CAST(sum(oc - pc) AS DOUBLE) AS net_variance_eur,
           CAST(sum(legs) AS BIGINT) AS total_legs, CAST(sum(ok) AS BIGINT) AS matched_legs, CAST(count(DISTINCT m) AS BIGINT) AS days_included,
           CASE WHEN sum(oc - pc) > 0 THEN 'PARTNER_OWES_US' WHEN sum(oc - pc) < 0 THEN 'WE_OWE_PARTNER' ELSE 'BALANCED' END AS settlement_direction,
           CAST(sum(om) AS DOUBLE) AS our_minutes, CAST(sum(tm) AS DOUBLE) AS their_minutes,
           'v42' AS source_version, (SELECT sha256(string_agg(x, chr(10) ORDER BY x)) FROM line) AS statement_checksum FROM d GROUP BY 1""")
def e15(t):
    legs = t.lineitem.where("l_tax > 0 OR l_returnflag <> 'A'").select(F.to_date("l_shipdate").alias("settlement_date"))
    s = settlement.monthly_statement(daily_variance(t), "1998-06", "v42", legs)
    return s.select("partner_code", *[C.as_double(c, c) for c in ("we_billed_eur", "they_billed_eur", "net_variance_eur")],
                    "total_legs", "matched_legs", "days_included", "settlement_direction", "source_version",
                    C.as_double("our_minutes", "our_minutes"), C.as_double("their_minutes", "their_minutes"), "statement_checksum")


@query("E23_leakage", f"""
    WITH {LEDGERS}, v AS (SELECT partner, round(COALESCE(sum(oc), 0), 2) - round(COALESCE(sum(pc), 0), 2) AS x FROM j GROUP BY 1)
    SELECT CAST(sum(abs(x)) AS DOUBLE) AS total_abs, max_by(partner, abs(x)) AS worst, CAST(max(abs(x)) AS DOUBLE) AS worst_abs, max(abs(x)) > 50000 AS dispute FROM v""")
def e23(t):
    return settlement.leakage(settlement.variance(match(t))).withColumns({c: C.as_double(c) for c in ("total_abs", "worst_abs")})


# ------------------------------------------------------------------ ledger
@query("E17_velocity_alerts", f"""
    WITH {LEDGER_LOG}, l AS (SELECT * FROM known), daily AS (
      SELECT account_id, currency, CAST(at_ts AS DATE) AS d, sum(CASE WHEN tx_type = 'CASH-IN' THEN amount ELSE -amount END) AS net FROM l GROUP BY ALL),
    opening AS (SELECT account_id, currency, d, sum(net) OVER (PARTITION BY account_id, currency ORDER BY d) - net AS opening FROM daily),
    r AS (SELECT *, sum(amount) OVER (PARTITION BY account_id, currency ORDER BY at_ts RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW) AS rolled FROM l WHERE tx_type <> 'CASH-IN')
    SELECT o_orderkey AS transaction_id, CAST(rolled AS DOUBLE) AS rolling_outflow, CAST(rolled AS DOUBLE) / CAST(opening AS DOUBLE) AS pct_of_opening,
           CASE WHEN CAST(rolled AS DOUBLE) / CAST(opening AS DOUBLE) >= 1.0 THEN 'CRITICAL' WHEN CAST(rolled AS DOUBLE) / CAST(opening AS DOUBLE) >= 0.9 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
    FROM r JOIN opening ON r.account_id = opening.account_id AND r.currency = opening.currency AND CAST(r.at_ts AS DATE) = opening.d WHERE opening > 0 AND CAST(rolled AS DOUBLE) / CAST(opening AS DOUBLE) >= 0.8""")
def e17(t):
    book = ledger_log(t).where("commit_id = 1")
    opening = ledger.daily_account_summary(book)
    hot = S.find_hot(book, ["account_id", "currency"], F.unix_micros("event_timestamp"))
    a = ledger.velocity_alerts(book, opening, ["transaction_id"], hot, 90 * 86_400)
    return a.select("transaction_id", C.as_double("rolling_outflow", "rolling_outflow"), "pct_of_opening", "severity")


# ------------------------------------------------------------------ clickstream
@query("E18_elasticity", f"""
    WITH {IV}, ch AS (SELECT * FROM (SELECT product, s, price, lag(price) OVER (PARTITION BY product ORDER BY s) AS prev FROM iv) WHERE prev > 0 AND abs((price - prev) / prev) > 0.15),
    bought AS (SELECT ev.product, ts, iv.price AS seen FROM ev JOIN iv ON ev.product = iv.product AND ts >= s AND (e IS NULL OR ts < e) WHERE event_type = 'purchase'),
    c AS (SELECT ch.product, ch.s, price, prev, (SELECT count(*) FROM bought b WHERE b.product = ch.product AND b.ts >= ch.s AND b.ts < ch.s + INTERVAL 48 HOUR) AS post,
            (SELECT count(*) FROM bought b WHERE b.product = ch.product AND b.ts < ch.s AND b.ts >= ch.s - INTERVAL 8 DAY AND b.seen = ch.prev) AS base FROM ch)
    SELECT product, {ts('s')} AS changed_at, CAST(post AS BIGINT) AS post_purchases, CAST(base AS BIGINT) AS base_purchases, base >= 1 AS qualifies,
           CASE WHEN base >= 1 THEN ((post - base / 4.0) / (base / 4.0)) / ((price - prev) / prev) END AS elasticity FROM c""")
def e18(t):
    e = clicks.with_product(t.events)
    hot = S.find_hot(e, ["product"], F.unix_micros("ts"))
    from lakeops.operators import joins as J
    catalog = clicks.price_catalog(t.events)
    seen = J.interval_join(e.select("event_id", "product", "ts", "event_type"), catalog, ["product"], "ts", "effective_start", "effective_end",
                           ["price"], hot)
    x = clicks.elasticity(seen, catalog.drop("previous_price"), hot, post_hours=48, base_days=8, floor=1)
    return x.select("product", C.stamp("effective_start").alias("changed_at"), "post_purchases", "base_purchases", "qualifies", "elasticity")


# ------------------------------------------------------------------ vital signs
VITAL_CODES = {"click": (211, "heart_rate"), "view": (646, "spo2"), "purchase": (455, "sbp"), "error": (678, "temp_c")}


def chart(t):
    code = F.lit(999)
    for kind, (item, _) in VITAL_CODES.items():
        code = F.when(F.col("event_type") == kind, item).otherwise(code)
    return t.events.select(
        F.col("user_id").alias("icustay_id"), code.alias("itemid"), F.col("ts").alias("charttime"), F.col("ts").alias("storetime"),
        F.col("event_id").alias("row_id"), F.col("value").alias("valuenum"), F.when(F.col("value") > 200, 1).otherwise(0).alias("error"))


def clean_vitals(t):
    items = t.spark.createDataFrame(vitals.ITEMS, "itemid int, vital string, unit_fix string")
    return vitals.clean_readings(chart(t), items)


VCLEAN = """v AS (SELECT user_id AS stay, ts, event_id, CASE event_type WHEN 'click' THEN 'heart_rate' WHEN 'view' THEN 'spo2' WHEN 'purchase' THEN 'sbp' ELSE 'temp_c' END AS vital,
    CASE WHEN event_type = 'error' THEN (value - 32) * 5 / 9 ELSE value END AS x FROM events WHERE event_type <> 'signup'),
    f AS (SELECT *, CASE vital WHEN 'heart_rate' THEN x BETWEEN 20 AND 250 WHEN 'spo2' THEN x BETWEEN 50 AND 100 WHEN 'sbp' THEN x BETWEEN 40 AND 260 ELSE x BETWEEN 30 AND 43 END AS plausible FROM v)"""


@query("E19_clean_vitals", f"""
    WITH {VCLEAN} SELECT vital, CAST(count(*) AS BIGINT) AS readings, CAST(count(*) FILTER (WHERE NOT plausible) AS BIGINT) AS implausible FROM f GROUP BY 1""")
def e19_clean(t):
    return clean_vitals(t).groupBy("vital").agg(F.count("*").alias("readings"), F.count_if(~F.col("plausible")).alias("implausible"))


def stays(t):
    return t.events.groupBy(F.col("user_id").alias("icustay_id")).agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime"))


HOURS = f"""{VCLEAN}, r AS (SELECT stay, ts, x, CAST(floor(epoch(ts)) AS BIGINT) // 3600 AS k FROM f WHERE vital = 'heart_rate' AND plausible),
    folded AS (SELECT stay, k, CAST(sum(CAST(x AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean, CAST(count(*) AS BIGINT) AS obs FROM r GROUP BY 1, 2),
    g AS (SELECT stay, unnest(generate_series(lo, hi)) AS k FROM (SELECT user_id AS stay, CAST(floor(epoch(min(ts))) AS BIGINT) // 3600 AS lo,
            CAST(floor(epoch(max(ts))) AS BIGINT) // 3600 AS hi FROM events GROUP BY 1)),
    gt AS (SELECT stay, k, make_timestamp(k * 3600000000) AS slot FROM g),
    c AS (SELECT gt.*, r.ts AS seen_at, r.x AS seen FROM gt ASOF LEFT JOIN r ON gt.stay = r.stay AND gt.slot > r.ts),
    hours AS (SELECT c.stay, c.slot, COALESCE(obs, 0) AS observations, CASE WHEN obs > 0 THEN mean WHEN epoch_us(c.slot) - epoch_us(seen_at) <= 172800000000 THEN seen END AS value,
            CASE WHEN obs > 0 THEN 'observed' WHEN epoch_us(c.slot) - epoch_us(seen_at) <= 172800000000 THEN 'carried' ELSE 'gap' END AS source
          FROM c LEFT JOIN folded ON c.stay = folded.stay AND c.k = folded.k)"""


def heart_hours(t):
    return vitals.hourly(clean_vitals(t), stays(t), "heart_rate", 2880)


@query("E19_hourly_resample", f"""
    WITH {HOURS} SELECT stay AS icustay_id, source, CAST(count(*) AS BIGINT) AS hours, CAST(sum(observations) AS BIGINT) AS readings, {half_up("max(value)", 4)} AS top FROM hours GROUP BY 1, 2""")
def e19_hourly(t):
    return heart_hours(t).groupBy("icustay_id", "source").agg(
        F.count("*").alias("hours"), F.sum("observations").alias("readings"), F.round(F.max("value"), 4).alias("top"))


@query("E19_lead_times", f"""
    WITH {HOURS}, x AS (SELECT user_id AS stay, max(ts) AS event_ts FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT hours.stay AS icustay_id, {half_up("max(epoch(event_ts) // 1 - epoch(slot)) / 3600", 4)} AS lead FROM hours JOIN x ON hours.stay = x.stay
      AND slot BETWEEN event_ts - INTERVAL 24 HOUR AND event_ts WHERE source <> 'gap' AND (value < 40 OR value > 130) GROUP BY 1""".replace(
    "epoch(event_ts) // 1", "floor(epoch(event_ts))"))
def e19_lead(t):
    x = t.events.where("event_type = 'error'").groupBy(F.col("user_id").alias("icustay_id")).agg(F.max("ts").alias("event_ts"))
    lead = vitals.lead_times(heart_hours(t), x, look_back=24)
    return lead.select("icustay_id", F.round("earliest_lead_h", 4).alias("lead"))


@query("E19_ward_summary", f"""
    SELECT event_type AS care_unit, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(count(DISTINCT user_id) AS BIGINT) AS members,
           {half_up("CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*)", 4)} AS mean_value, CAST(count(*) AS BIGINT) AS readings
    FROM events GROUP BY 1, 2 HAVING count(DISTINCT user_id) >= 60""")
def e19_ward(t):
    e = t.events.select(F.col("event_type").alias("care_unit"), "ts", "user_id", C.money("value").alias("value"))
    w = vitals.ward_summary(e, "care_unit", "ts", "user_id", "value", 60)
    return w.withColumn("mean_value", C.as_double(F.round("mean_value", 4)))


# ------------------------------------------------------------------ meters
def readings(t):
    return meters.clean_readings(t.events.select(
        F.col("user_id").alias("meter_id"), F.floor(F.col("user_id") / 10).alias("block"), F.col("ts").alias("reading_ts"),
        raw_reading().alias("energy_raw"), F.col("event_id").alias("row_id")), 21_600)


METERS = f"""raw AS (SELECT user_id, user_id // 10 AS block, ts, event_id, make_timestamp((epoch_us(ts) // 21600000000) * 21600000000) AS slot,
      CASE WHEN trim({RAW_READING}) NOT IN ('Null', '') THEN TRY_CAST(trim({RAW_READING}) AS DOUBLE) END AS kwh FROM events),
    clean AS (SELECT *, CASE WHEN kwh IS NULL THEN 'MISSING' WHEN kwh < 0 THEN 'NEGATIVE' WHEN kwh = 0 THEN 'ZERO' ELSE 'OK' END AS status FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id, slot ORDER BY ts DESC, event_id DESC) AS rn FROM raw) WHERE rn = 1)"""


@query("E20_hourly_load", f"""
    WITH {METERS} SELECT user_id AS meter_id, {ts("date_trunc('hour', slot)")} AS hour, CAST(sum(CAST(kwh AS DECIMAL(18,4))) AS DOUBLE) AS kwh,
      CAST(count(*) FILTER (WHERE status = 'OK') AS BIGINT) AS ok_intervals, CAST(count(*) AS BIGINT) AS total_intervals FROM clean GROUP BY 1, 2""")
def e20_load(t):
    return meters.hourly_load(readings(t)).select("meter_id", C.stamp("hour").alias("hour"), "kwh", "ok_intervals", "total_intervals")


@query("E20_outages", f"""
    WITH {METERS}, grid AS (SELECT user_id, block, unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS slot FROM
             (SELECT user_id, block, min(slot) AS lo, max(slot) AS hi FROM clean GROUP BY 1, 2)),
    silent AS (SELECT * FROM grid g WHERE NOT EXISTS (SELECT 1 FROM clean c WHERE c.user_id = g.user_id AND c.slot = g.slot AND status <> 'MISSING')),
    flagged AS (SELECT *, CASE WHEN p IS NULL OR epoch_us(slot) - epoch_us(p) > 21600000000 THEN 1 ELSE 0 END AS f FROM
                (SELECT *, lag(slot) OVER (PARTITION BY user_id ORDER BY slot) AS p FROM silent)),
    numbered AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY slot ROWS UNBOUNDED PRECEDING) AS run FROM flagged),
    o AS (SELECT user_id, block, min(slot) AS s, max(slot) AS e, CAST(count(*) AS BIGINT) AS slots FROM numbered GROUP BY user_id, block, run HAVING count(*) >= 3),
    k AS (SELECT a.user_id, a.s, count(DISTINCT b.user_id) AS n FROM o a LEFT JOIN o b ON a.block = b.block AND a.user_id <> b.user_id AND b.s <= a.e AND b.e >= a.s GROUP BY 1, 2)
    SELECT o.user_id AS meter_id, {ts('o.s')} AS outage_start, slots, CAST(n AS BIGINT) AS concurrent_meters, CASE WHEN n >= 5 THEN 'CLUSTERED' ELSE 'ISOLATED' END AS classification
    FROM o JOIN k ON o.user_id = k.user_id AND o.s = k.s""")
def e20_outages(t):
    return meters.outages(readings(t), 21_600).select("meter_id", C.stamp("run_start").alias("outage_start"), "slots", "concurrent_meters", "classification")


@query("E20_response_curve", f"""
    WITH {METERS}, w AS (SELECT date_trunc('hour', ts) AS h, max(value) AS temp FROM events WHERE event_type = 'view' GROUP BY 1),
    b AS (SELECT block, floor(temp / 20) * 20 AS bin, CAST(sum(CAST(kwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS y
          FROM clean JOIN w ON date_trunc('hour', slot) = h WHERE kwh IS NOT NULL GROUP BY 1, 2),
    m AS (SELECT block, bin AS inflection, y AS lowest FROM (SELECT *, row_number() OVER (PARTITION BY block ORDER BY y, bin) AS rn FROM b) WHERE rn = 1)
    SELECT b.block, CAST(max(inflection) AS DOUBLE) AS inflection, {half_up("max(lowest)", 4)} AS lowest, CAST(count(*) AS BIGINT) AS bins,
           CASE WHEN count(*) FILTER (WHERE bin >= inflection) > 1 THEN
             {half_up("regr_slope(CASE WHEN bin >= inflection THEN y END, CASE WHEN bin >= inflection THEN bin END)", 4)} END AS slope_above
    FROM b JOIN m ON b.block = m.block GROUP BY 1""")
def e20_curve(t):
    weather = t.events.where("event_type = 'view'").groupBy(F.date_trunc("hour", "ts").alias("weather_hour")).agg(F.max("value").alias("temperature"))
    load = meters.with_weather(readings(t), weather).where("energy_kwh IS NOT NULL AND temperature IS NOT NULL").withColumn(
        "kwh", F.col("energy_kwh").cast("decimal(18,4)"))
    c = meters.weather_response(load, "block", degrees=20.0)
    return c.select("block", C.as_double("inflection", "inflection"), F.round("lowest", 4).alias("lowest"), "bins",
                    F.round("slope_above", 4).alias("slope_above"))


@query("E20_weather_response", f"""
    WITH {METERS}, w AS (SELECT date_trunc('hour', ts) AS h, max(value) AS temp FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT CAST(count(*) AS BIGINT) AS readings, CAST(count(temp) AS BIGINT) AS with_weather FROM clean LEFT JOIN w ON date_trunc('hour', slot) = h""")
def e20_weather(t):
    weather = t.events.where("event_type = 'view'").groupBy(F.date_trunc("hour", "ts").alias("weather_hour")).agg(F.max("value").alias("temperature"))
    return meters.with_weather(readings(t), weather).agg(F.count("*").alias("readings"), F.count("temperature").alias("with_weather"))


# ------------------------------------------------------------------ cold chain
SHIPPED = """c AS (SELECT *, CASE WHEN abs(value - p) > 8 AND abs(value - n) > 8 AND abs(p - n) < 2 THEN (p + n) / 2 ELSE value END AS temp FROM
      (SELECT *, lag(value) OVER w AS p, lead(value) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))),
    f AS (SELECT *, temp < 2 OR temp > 30 AS oor FROM c),
    s AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM
      (SELECT *, CASE WHEN oor AND NOT COALESCE(lag(oor) OVER (PARTITION BY user_id ORDER BY ts, event_id), FALSE) THEN 1 ELSE 0 END AS st FROM f)),
    b AS (SELECT user_id, run, min(ts) AS a, max(ts) AS z, count(*) AS pings, min(temp) AS lo, max(temp) AS hi, (max(epoch_us(ts)) - min(epoch_us(ts))) / 60000000.0 AS minutes
          FROM s WHERE oor GROUP BY 1, 2)"""


@query("E21_breaches", f"""
    WITH {SHIPPED} SELECT user_id AS shipment_id, {ts('a')} AS breach_start, {ts('z')} AS breach_end, CAST(pings AS BIGINT) AS pings, {half_up("lo", 4)} AS min_temp, {half_up("hi", 4)} AS max_temp,
      CASE WHEN minutes > 1440 THEN 'CRITICAL' WHEN minutes > 720 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, 42 AS source_version FROM b WHERE minutes > 30""")
def e21(t):
    pings = t.events.select(F.col("user_id").alias("shipment_id"), F.col("ts").alias("ping_ts"), F.col("value").alias("cargo_temp_c"),
                            F.col("value").alias("lat"), (F.col("value") * 2).alias("lon"), F.col("value").alias("driver_score"), "event_id")
    hot = S.find_hot(pings, ["shipment_id"], F.unix_micros("ping_ts"))
    ships = t.events.select(F.col("user_id").alias("shipment_id")).distinct().select(
        "shipment_id", (F.col("shipment_id") + 1000).alias("vehicle_id"), F.lit("custom").alias("cargo_class"),
        F.lit(2.0).alias("required_min_c"), F.lit(30.0).alias("required_max_c"))
    clean = coldchain.clean_telemetry(pings, hot, ["event_id"])
    b = coldchain.breaches(clean, ships, hot, ["event_id"], 42, 30, 720, 1440)
    return b.select("shipment_id", C.stamp("breach_start").alias("breach_start"), C.stamp("breach_end").alias("breach_end"), "pings",
                    F.round("min_temp", 4).alias("min_temp"), F.round("max_temp", 4).alias("max_temp"), "severity", "source_version")


@query("E21_eta_performance", f"""
    WITH x AS (SELECT n_name AS route, o_orderpriority AS vehicle, (epoch(l_shipdate) - epoch(o_orderdate)) / 60 - 43200 AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
    SELECT route, vehicle, CAST(count(*) AS BIGINT) AS trips, {half_up("quantile_cont(late, 0.5)", 4)} AS median_min, {half_up("quantile_cont(late, 0.9)", 4)} AS p90_min,
           CAST(max(late) AS DOUBLE) AS worst_min, CAST(count(*) FILTER (WHERE late > 0) AS BIGINT) AS late_trips FROM x GROUP BY 1, 2""")
def e21_eta(t):
    trips = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
             .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("route"), F.col("o_orderpriority").alias("vehicle"), F.expr("o_orderdate + INTERVAL 30 DAYS").alias("promised"),
        F.col("l_shipdate").alias("actual")))
    p = coldchain.eta_performance(trips, ["route", "vehicle"], "promised", "actual")
    return p.withColumns({c: F.round(c, 4) for c in ("median_min", "p90_min")})


@query("E21_lateness_predictors", f"""
    WITH x AS (SELECT l_quantity, l_discount, l_tax, (epoch(l_shipdate) - epoch(o_orderdate)) / 86400 AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT 'l_quantity' AS predictor, {half_up("corr(l_quantity, late)", 6)} AS correlation FROM x UNION ALL SELECT 'l_discount', {half_up("corr(l_discount, late)", 6)} FROM x
    UNION ALL SELECT 'l_tax', {half_up("corr(l_tax, late)", 6)} FROM x""")
def e21_predictors(t):
    trips = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("late", F.datediff("l_shipdate", "o_orderdate"))
    return coldchain.lateness_predictors(trips, "late", ["l_quantity", "l_discount", "l_tax"]).withColumn("correlation", F.round("correlation", 6))


# ------------------------------------------------------------------ erasure and metrics
@query("E22_erasure_sequence", f"""
    WITH {LOG}, gone AS (SELECT DISTINCT user_id FROM events WHERE value > 200)
    SELECT 'log' AS step, CAST((SELECT count(*) FROM {state_sql(1000)} WHERE user_id IN (SELECT user_id FROM gone)) AS BIGINT) AS visible_rows,
           CAST((SELECT count(*) FROM log WHERE op <> 'delete' AND user_id IN (SELECT user_id FROM gone)) AS BIGINT) AS rows_in_history
    UNION ALL SELECT 'deleted', 0, CAST((SELECT count(*) FROM log WHERE op <> 'delete' AND user_id IN (SELECT user_id FROM gone)) AS BIGINT)
    UNION ALL SELECT 'expired', 0, 0""")
def e22(t):
    log = version_log(t)
    gone = t.events.where("value > 200").select("user_id").distinct()
    steps = erasure_job.run(log, gone, "user_id", KEYS, 31, "2024-02-01 00:00:00", ORDER)
    return erasure_job.evidence(steps, gone, "user_id", KEYS, ORDER)


@query("E22_full_sequence", f"""
    WITH {LOG}, gone AS (SELECT DISTINCT user_id FROM events WHERE value > 200), mine AS (SELECT * FROM log WHERE op <> 'delete' AND user_id IN (SELECT user_id FROM gone)),
    st AS (SELECT * FROM {state_sql(1000)}), late AS (SELECT * FROM log WHERE op <> 'delete' AND value > 250),
    n AS (SELECT (SELECT count(*) FROM mine) AS held, (SELECT count(*) FROM st WHERE user_id IN (SELECT user_id FROM gone)) AS seen,
            (SELECT count(*) FROM st WHERE user_id NOT IN (SELECT user_id FROM gone)) AS live, (SELECT count(*) FROM late) AS late_rows,
            (SELECT count(DISTINCT user_id) FROM late) AS late_users),
    steps AS (SELECT 'requested' AS step, seen AS v, held AS h, held AS s, live FROM n UNION ALL SELECT 'deleted', 0, held, held, live FROM n
      UNION ALL SELECT 'rewritten', 0, held, held, live FROM n UNION ALL SELECT 'expired', 0, 0, held, live FROM n
      UNION ALL SELECT 'unreferenced_removed', 0, 0, 0, live FROM n UNION ALL SELECT 'verified', late_users, late_rows, late_rows, live FROM n
      UNION ALL SELECT 'attested', 0, 0, 0, live FROM n)
    SELECT step, CAST(v AS BIGINT) AS visible_rows, CAST(h AS BIGINT) AS rows_in_history, CAST(s AS BIGINT) AS rows_stored, CAST(live AS BIGINT) AS live_rows,
           v + h + s = 0 AS erased FROM steps""")
def e22_full(t):
    log = version_log(t)
    gone = t.events.where("value > 200").select("user_id").distinct()
    steps = erasure_job.sequence(log, gone, "user_id", KEYS, 1000, "2024-02-01 00:00:00", ORDER)
    # rows that land before the check are found by it and take a second pass
    late = log.where("op <> 'delete' AND value > 250").withColumn("commit_id", F.col("commit_id") + 2000)
    landed = steps["unreferenced_removed"][0].unionByName(late)
    again = erasure_job.sequence(landed, gone, "user_id", KEYS, 9000, "2024-02-08 00:00:00", ORDER)
    return erasure_job.attest({**steps, "verified": (landed, landed), "attested": again["unreferenced_removed"]}, gone, "user_id", KEYS, ORDER)


@query("E24_hourly_metrics", f"""
    SELECT event_type, {ts("date_trunc('hour', ts)")} AS hour, CAST(count(*) AS BIGINT) AS orders, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM events GROUP BY 1, 2""")
def e24(t):
    return metrics.hourly_metrics(t.events, ["event_type"], "ts", "value").withColumn("hour", C.stamp("hour"))
