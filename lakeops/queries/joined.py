"""Joins (J)."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.operators import joins as J
from lakeops.operators import scans as S
from lakeops.queries.aggregates import PRICE, RUN, TOTAL
from lakeops.queries.projections import NET
from lakeops.queries.windowed import HISTORY, OUTAGES, history, outages, ts
from lakeops.registry import half_up, query


@query("J1_inner_using", f"""
    SELECT o_orderkey, o_orderstatus, l_linenumber, CAST({NET} AS DOUBLE) AS net FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def j1(t):
    items = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                              C.as_double(C.net_amount("l_extendedprice", "l_discount"), "net"))
    return t.orders.select("o_orderkey", "o_orderstatus").join(items, "o_orderkey", "inner")


SIDES = """a AS (SELECT o_custkey AS k, CAST(count(*) AS BIGINT) AS finals FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000 GROUP BY 1),
    b AS (SELECT c_custkey AS k, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING')"""


def sides(t):
    a = t.orders.where("o_orderstatus = 'F' AND o_totalprice > 250000").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count("*").alias("finals"))
    return a, t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k"), "c_acctbal")


for _how in ("left", "right", "full"):
    def _outer(t, how=_how):
        a, b = sides(t)
        return a.join(b, "k", how)
    query(f"J2_{_how}", f"WITH {SIDES} SELECT COALESCE(a.k, b.k) AS k, finals, c_acctbal FROM a {_how} JOIN b ON a.k = b.k")(_outer)


@query("J3_expression_join", """
    SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def j3(t):
    s, n, r = t.supplier, t.nation, t.region
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("s_suppkey", "n_name", "r_name"))


TARIFFS = [("R", "F", 0.0125), ("A", "F", 0.02), ("N", "O", 0.031)]
TARIFF_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', {c})" for a, b, c in TARIFFS) + ") AS tf(f, s, rate)"


@query("J4_composite_lookup", f"""
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, CAST(rate AS DOUBLE) AS rate FROM lineitem
    LEFT JOIN {TARIFF_SQL} ON l_returnflag = f AND l_linestatus = s""")
def j4(t):
    tariff = t.spark.createDataFrame(TARIFFS, "l_returnflag string, l_linestatus string, rate double")
    return t.lineitem.join(F.broadcast(tariff), ["l_returnflag", "l_linestatus"], "left").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "rate")


@query("J5_checked_broadcast", f"""
    SELECT n_name, CAST(sum({PRICE}) AS DOUBLE) AS price FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def j5(t):
    dim = t.supplier.join(J.broadcast_if_small(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return (t.lineitem.join(J.broadcast_if_small(dim), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("n_name").agg(C.as_double(F.sum(C.money("l_extendedprice")), "price")))


@query("J6_left_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j6(t):
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("J7_left_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j7(t):
    back = t.lineitem.where("l_returnflag = 'R'")
    return t.orders.join(back, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("J8_fact_dim_chain", f"""
    SELECT r_name, c_mktsegment, CAST(count(*) AS BIGINT) AS lines, CAST(sum({PRICE}) AS DOUBLE) AS price, max(l_quantity) AS top
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE l_shipdate >= TIMESTAMP '1998-06-01' AND l_shipdate < TIMESTAMP '1998-06-08' GROUP BY 1, 2""")
def j8(t):
    week = t.lineitem.where("l_shipdate >= TIMESTAMP '1998-06-01' AND l_shipdate < TIMESTAMP '1998-06-08'")
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (week.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("r_name", "c_mktsegment")
            .agg(F.count("*").alias("lines"), C.as_double(F.sum(C.money("l_extendedprice")), "price"),
                 F.max("l_quantity").alias("top")))


@query("J9_star_assembly", f"""
    SELECT c_custkey, orders__n, orders__total, lines__n FROM customer
    LEFT JOIN (SELECT o_custkey, CAST(count(*) AS BIGINT) AS orders__n, CAST(sum({TOTAL}) AS DOUBLE) AS orders__total FROM orders GROUP BY 1) a ON c_custkey = a.o_custkey
    LEFT JOIN (SELECT o_custkey, CAST(count(*) AS BIGINT) AS lines__n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
               WHERE l_returnflag = 'R' GROUP BY 1) b ON c_custkey = b.o_custkey""")
def j9(t):
    from lakeops.jobs.churn import assemble
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), C.as_double(F.sum(C.money("o_totalprice")), "total"))
    lines = (t.orders.join(t.lineitem.where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"))
             .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")))
    return assemble(t.customer.select("c_custkey"), {"orders": orders, "lines": lines}, ["c_custkey"])


@query("J10_history_as_of", f"""
    SELECT o_custkey, attribute, valid_from FROM {HISTORY} WHERE valid_from <= {RUN} AND (valid_to > {RUN} OR valid_to IS NULL)""")
def j10(t):
    return J.scd2_as_of(history(t), F.to_date(F.lit("2000-06-30"))).select("o_custkey", "attribute", "valid_from")


EV = """ev AS (SELECT *, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS product FROM events)"""
IV = EV + """, daily AS (SELECT product, date_trunc('day', ts) AS d, min_by(value, ts) AS price FROM ev GROUP BY 1, 2),
    iv AS (SELECT product, price, d AS s, lead(d) OVER (PARTITION BY product ORDER BY d) AS e FROM
           (SELECT *, lag(price) OVER (PARTITION BY product ORDER BY d) AS p FROM daily) WHERE p IS NULL OR p <> price)"""
BOUND = f"WITH {IV} SELECT event_id, ev.product, price FROM ev JOIN iv ON ev.product = iv.product AND ts >= s AND (e IS NULL OR ts < e)"


def bound_price(t, method, max_rows=S.MAX_GROUP_ROWS, **kw):
    from lakeops.jobs.clicks import price_catalog, with_product
    e = with_product(t.events).select("event_id", "product", "ts")
    hot = S.find_hot(e, ["product"], F.unix_micros("ts"), max_rows)
    got = J.interval_join(e, price_catalog(t.events), ["product"], "ts", "effective_start", "effective_end",
                          ["price"], hot, method=method, **kw)
    return got.select("event_id", "product", "price")


@query("J11_interval_join", BOUND)
def j11(t):
    return bound_price(t, "carry")


@query("J12_interval_join_broadcast", BOUND)
def j12(t):
    return bound_price(t, "broadcast")


@query("J12_interval_join_too_large_to_broadcast", BOUND)
def j12_large(t):
    from lakeops.jobs.clicks import price_catalog, with_product
    e = with_product(t.events).select("event_id", "product", "ts")
    hot = S.find_hot(e, ["product"], F.unix_micros("ts"), 40)
    return J.interval_join(e, price_catalog(t.events), ["product"], "ts", "effective_start", "effective_end",
                           ["price"], hot, method="broadcast", max_bytes=10).select("event_id", "product", "price")


@query("J13_interval_join_grid", BOUND)
def j13(t):
    return bound_price(t, "grid", cell_seconds=86_400)


@query("J14_as_of_join", """
    WITH p AS (SELECT user_id, ts, event_id AS paid_id, value FROM events WHERE event_type = 'purchase'),
         c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click')
    SELECT c.event_id, p.paid_id, p.value AS paid FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.ts >= p.ts""")
def j14(t):
    e = t.events
    paid = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("paid_id"),
                                                     F.col("value").alias("paid"))
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    hot = S.find_hot(e, ["user_id"], F.unix_micros("ts"))
    return S.asof_join(clicks, paid, ["user_id"], "ts", "at", ["paid_id", "paid"], hot, tie=["paid_id"]).select(
        "event_id", "paid_id", "paid")


AROUND = """
    WITH a AS (SELECT event_id AS anchor, user_id, ts FROM events WHERE event_type = 'signup'),
         f AS (SELECT user_id, ts, CAST(value AS DECIMAL(18,2)) AS v FROM events WHERE event_type = 'purchase')
    SELECT anchor, CAST(COALESCE(sum(CASE WHEN f.ts >= a.ts AND f.ts < a.ts + INTERVAL 48 HOUR THEN 1 END), 0) AS BIGINT) AS post_n,
           CAST(COALESCE(sum(CASE WHEN f.ts >= a.ts AND f.ts < a.ts + INTERVAL 48 HOUR THEN v END), 0) AS DOUBLE) AS post_value,
           CAST(COALESCE(sum(CASE WHEN f.ts < a.ts AND f.ts >= a.ts - INTERVAL 7 DAY THEN 1 END), 0) / 3.5 AS DOUBLE) AS base_n
    FROM a LEFT JOIN f ON a.user_id = f.user_id GROUP BY 1"""


def around(t, max_rows):
    e = t.events
    hot = S.find_hot(e, ["user_id"], F.unix_micros("ts"), max_rows)
    anchors = e.where("event_type = 'signup'").select(F.col("event_id").alias("anchor"), "user_id", "ts")
    facts = e.where("event_type = 'purchase'").select("user_id", "ts", F.lit(1).alias("n"), C.money("value").alias("v"))
    at, hour = F.unix_micros("ts"), 3_600_000_000
    post = S.window_totals(anchors, facts, ["user_id"], ["anchor"], at, at + 48 * hour, at, ["n", "v"], hot)
    base = S.window_totals(anchors, facts, ["user_id"], ["anchor"], at - 168 * hour, at, at, ["n"], hot)
    return post.select("anchor", F.col("n").alias("post_n"), C.as_double("v", "post_value")).join(
        base.select("anchor", (F.col("n") / F.lit(3.5)).alias("base_n")), "anchor")


@query("J15_windows_around_event", AROUND)
def j15(t):
    return around(t, S.MAX_GROUP_ROWS)


@query("J15_windows_around_event_cut_keys", AROUND)
def j15_cut(t):
    return around(t, 60)


@query("J16_after_increase_no_purchase", f"""
    WITH {IV}, inc AS (SELECT product, s, price, prev FROM (SELECT *, lag(price) OVER (PARTITION BY product ORDER BY s) AS prev FROM iv)
           WHERE prev > 0 AND (price - prev) / prev > 0.15),
    c AS (SELECT event_id, user_id, ev.product, ts, s, price, prev FROM (SELECT * FROM ev WHERE event_type = 'click') ev
          ASOF JOIN inc ON ev.product = inc.product AND ev.ts >= inc.s)
    SELECT event_id, product, price AS at_cart, prev AS at_old FROM c WHERE ts < s + INTERVAL 6 HOUR AND NOT EXISTS (
      SELECT 1 FROM ev p WHERE p.event_type = 'purchase' AND p.product = c.product AND p.user_id = c.user_id AND p.ts > c.ts)""")
def j16(t):
    from lakeops.jobs.clicks import abandoned_carts, price_catalog, with_product
    e = with_product(t.events)
    hot = S.find_hot(e, ["product"], F.unix_micros("ts"))
    a = abandoned_carts(e, price_catalog(t.events), "click", ["user_id", "product"], hot, min_change=0.15, minutes=360)
    return a.select("event_id", "product", F.col("lost_revenue_at_cart").alias("at_cart"),
                    F.col("lost_revenue_at_old").alias("at_old"))


CONCURRENT = f"""
    WITH {OUTAGES} SELECT a.user_id, {ts('a.s')} AS run_start, CAST(count(DISTINCT b.user_id) AS BIGINT) AS concurrent
    FROM outages a LEFT JOIN outages b ON a.block = b.block AND a.user_id <> b.user_id AND b.s <= a.e AND b.e >= a.s GROUP BY 1, 2"""


def concurrent(t, max_rows):
    runs = outages(t).withColumn("block", F.floor(F.col("user_id") / 10))
    return J.overlap_counts(runs, "block", "user_id", "run_start", "run_end", 21_600, max_rows).select(
        "user_id", C.stamp("run_start").alias("run_start"), "concurrent")


@query("J17_overlap_counts", CONCURRENT)
def j17(t):
    return concurrent(t, S.MAX_GROUP_ROWS)


@query("J17_overlap_counts_cut_keys", CONCURRENT)
def j17_cut(t):
    return concurrent(t, 30)


@query("J18_bucketed_grid", f"""
    WITH g AS (SELECT user_id, unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS h FROM events GROUP BY 1)
    SELECT user_id, CAST(count(*) AS BIGINT) AS hours, CAST(count(n) AS BIGINT) AS observed, CAST(sum(n) AS BIGINT) AS readings
    FROM g LEFT JOIN (SELECT user_id, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1, 2) USING (user_id, h) GROUP BY 1""")
def j18(t):
    hour = F.date_trunc("hour", "ts")
    g = t.events.groupBy("user_id").agg(F.min(hour).alias("a"), F.max(hour).alias("b")).select(
        "user_id", F.explode(F.expr("sequence(a, b, INTERVAL 1 HOUR)")).alias("h"))
    n = t.events.groupBy("user_id", hour.alias("h")).agg(F.count("*").alias("n"))
    return g.join(n, ["user_id", "h"], "left").groupBy("user_id").agg(
        F.count("*").alias("hours"), F.count("n").alias("observed"), F.sum("n").alias("readings"))


@query("J19_look_back", """
    WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour, max(value) AS top FROM events GROUP BY 1, 2),
         x AS (SELECT user_id, min(ts) AS err_at FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10' GROUP BY 1)
    SELECT h.user_id, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, top FROM h JOIN x ON h.user_id = x.user_id
     AND hour BETWEEN err_at - INTERVAL 24 HOUR AND err_at""")
def j19(t):
    h = t.events.groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.max("value").alias("top"))
    x = t.events.where("event_type = 'error' AND ts >= TIMESTAMP '2024-01-10'").groupBy("user_id").agg(F.min("ts").alias("at"))
    return J.within_hours_before(h, x, ["user_id"], "hour", "at", 24).select("user_id", C.stamp("hour").alias("hour"), "top")


LEGS = """
    WITH o AS (SELECT l_suppkey AS partner, l_orderkey AS a, l_partkey AS b, l_shipdate AS m, l_quantity AS dur, l_linenumber AS seq,
                 row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_partkey, l_shipdate ORDER BY l_quantity, l_linenumber) AS leg
               FROM lineitem WHERE l_tax > 0),
         p AS (SELECT l_suppkey AS partner, l_orderkey AS a, l_partkey AS b, l_shipdate AS m, l_quantity + l_discount * 50 AS dur, l_linenumber AS seq,
                 row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_partkey, l_shipdate ORDER BY l_quantity + l_discount * 50, l_linenumber) AS leg
               FROM lineitem WHERE l_returnflag <> 'A'),
         j AS (SELECT COALESCE(o.partner, p.partner) AS partner, CASE WHEN o.leg IS NULL THEN 'MISSING_ON_OUR_SIDE' WHEN p.leg IS NULL THEN 'MISSING_ON_THEIR_SIDE'
                 WHEN abs(o.dur - p.dur) <= 2 THEN 'MATCHED' ELSE 'DURATION_MISMATCH' END AS match_status
               FROM o FULL JOIN p ON o.partner = p.partner AND o.a = p.a AND o.b = p.b AND o.m = p.m AND o.leg = p.leg)
    SELECT partner, match_status, CAST(count(*) AS BIGINT) AS legs FROM j GROUP BY 1, 2"""


@query("J20_tolerance_match", LEGS)
def j20(t):
    leg = lambda df, d: df.select(F.col("l_suppkey").alias("partner"), F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"),
                                  F.date_trunc("minute", "l_shipdate").alias("m"), d.alias("dur"), F.col("l_linenumber").alias("seq"))
    ours = leg(t.lineitem.where("l_tax > 0"), F.col("l_quantity"))
    theirs = leg(t.lineitem.where("l_returnflag <> 'A'"), F.col("l_quantity") + F.col("l_discount") * 50)
    m = J.tolerance_match(ours, theirs, ["partner", "a", "b", "m"], "dur", ["seq"], ["seq"], 2)
    return m.groupBy("partner", "match_status").agg(F.count("*").alias("legs"))


@query("J21_hot_keys", "SELECT l_suppkey, CAST(count(*) AS BIGINT) AS rows FROM lineitem GROUP BY 1 HAVING count(*) > 600")
def j21(t):
    return J.hot_values(t.lineitem, ["l_suppkey"], 600)


@query("J22_salted_full_join", f"""
    WITH a AS (SELECT l_suppkey AS k, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey <> 7),
         b AS (SELECT s_suppkey AS k, s_acctbal FROM supplier WHERE s_acctbal > 0)
    SELECT COALESCE(a.k, b.k) AS k, s_acctbal, CAST(count(l_orderkey) AS BIGINT) AS n, CAST(sum(l_quantity) AS DOUBLE) AS q
    FROM a FULL JOIN b ON a.k = b.k GROUP BY 1, 2""")
def j22(t):
    a = t.lineitem.where("l_suppkey <> 7").select(F.col("l_suppkey").alias("k"), "l_orderkey", "l_linenumber", "l_quantity")
    b = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("k"), "s_acctbal")
    joined = J.salted_join(a, b, ["k"], "full", J.hot_values(a, ["k"], 600), 8)
    return joined.groupBy("k", "s_acctbal").agg(F.count("l_orderkey").alias("n"), F.sum("l_quantity").alias("q"))


RATES = [("R", 0.92), ("A", 1.17)]
RATE_SQL = "(VALUES " + ", ".join(f"('{c}', CAST({r} AS DECIMAL(10,5)))" for c, r in RATES) + ") AS fx(cur, rate)"


@query("J23_currency", f"""
    SELECT l_returnflag, CAST(sum(round({PRICE} * COALESCE(rate, 1), 5)) AS DOUBLE) AS eur,
           CAST(count(*) FILTER (WHERE rate IS NULL) AS BIGINT) AS missing FROM lineitem LEFT JOIN {RATE_SQL} ON l_returnflag = cur GROUP BY 1""")
def j23(t):
    fx = t.spark.createDataFrame(RATES, "l_returnflag string, rate double").withColumn("rate", F.col("rate").cast("decimal(10,5)"))
    c = J.convert_currency(t.lineitem.withColumn("amount", C.money("l_extendedprice")), fx, "amount", "l_returnflag", "eur")
    return c.groupBy("l_returnflag").agg(C.as_double(F.sum("eur"), "eur"), F.count_if("rate_missing").alias("missing"))


@query("J24_hourly_reference", """
    WITH w AS (SELECT date_trunc('hour', ts) AS h, max(value) AS temp FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT event_id, temp, temp IS NULL AS unmatched FROM events LEFT JOIN w ON date_trunc('hour', ts) = h""")
def j24(t):
    weather = t.events.where("event_type = 'view'").groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.max("value").alias("temp"))
    return t.events.join(J.broadcast_if_small(weather), F.date_trunc("hour", "ts") == F.col("h"), "left").select(
        "event_id", "temp", F.col("temp").isNull().alias("unmatched"))


@query("J25_versus_own_baseline", """
    WITH b AS (SELECT user_id, avg(n) AS mean, stddev_samp(n) AS sd FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events
               WHERE ts < TIMESTAMP '2024-01-29' GROUP BY 1, 2) GROUP BY 1),
         c AS (SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-30' GROUP BY 1)
    SELECT c.user_id, n, n > mean + 1.5 * sd AS anomalous FROM c JOIN b ON c.user_id = b.user_id WHERE sd > 0""")
def j25(t):
    days = t.events.where("ts < TIMESTAMP '2024-01-29'").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    base = days.groupBy("user_id").agg(F.avg("n").alias("mean"), F.stddev("n").alias("sd"))
    now = t.events.where("ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-30'").groupBy("user_id").agg(F.count("*").alias("n"))
    return now.join(base, "user_id").where("sd > 0").select(
        "user_id", "n", (F.col("n") > F.col("mean") + 1.5 * F.col("sd")).alias("anomalous"))


@query("J26_usage_weighted", f"""
    SELECT o_custkey, {half_up("CAST(sum(sec * CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(sec) AS DOUBLE)", 4)} AS exposure,
           CAST(count(*) AS BIGINT) AS cells FROM (SELECT o_custkey, l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS sec FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def j26(t):
    from lakeops.functions.aggregates import weighted_mean
    # fold to subscriber and cell first: the busy cell is one row per subscriber by then
    use = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "l_suppkey")
           .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("sec")))
    joined = use.join(t.supplier.withColumn("q", C.money("s_acctbal")), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("o_custkey").agg(weighted_mean("q", "sec").alias("exposure"), F.count("*").alias("cells"))


@query("J28_published_vs_restated", f"""
    WITH p AS (SELECT o_orderpriority AS k, sum({TOTAL}) AS v FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderpriority <> '5-LOW' GROUP BY 1),
         r AS (SELECT o_orderpriority AS k, sum({TOTAL}) AS v FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1)
    SELECT COALESCE(p.k, r.k) AS k, CAST(r.v - p.v AS DOUBLE) AS drift, CAST(r.v - p.v AS DOUBLE) / abs(CAST(p.v AS DOUBLE)) AS pct
    FROM p FULL JOIN r ON p.k = r.k""")
def j28(t):
    net = lambda df: df.groupBy(F.col("o_orderpriority").alias("k")).agg(F.sum(C.money("o_totalprice")).alias("v"))
    p = net(t.orders.where("o_orderdate < TIMESTAMP '2000-01-01' AND o_orderpriority <> '5-LOW'"))
    r = net(t.orders.where("o_orderpriority <> '1-URGENT'"))
    return J.compare_states(p, r, ["k"], "v").select("k", C.as_double("drift_amount", "drift"), F.col("drift_pct").alias("pct"))


@query("J29_left_join_group", """
    SELECT c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS orders, CAST(count(DISTINCT c_custkey) AS BIGINT) AS customers
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY 1""")
def j29(t):
    f = t.orders.where("o_orderstatus = 'F'")
    return t.customer.join(f, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_mktsegment").agg(
        F.count("o_orderkey").alias("orders"), F.countDistinct("c_custkey").alias("customers"))


CODES = [("click", "engage"), ("view", "engage"), ("purchase", "buy")]


@query("J30_code_mapping", """
    SELECT name, CAST(count(*) AS BIGINT) AS rows FROM (SELECT CASE event_type WHEN 'click' THEN 'engage' WHEN 'view' THEN 'engage'
      WHEN 'purchase' THEN 'buy' ELSE 'unmapped:' || event_type END AS name FROM events) GROUP BY 1""")
def j30(t):
    mapping = t.spark.createDataFrame(CODES, "event_type string, name string")
    mapped, unmapped = J.map_codes(t.events, mapping, "event_type")
    named = mapped.groupBy("name").agg(F.count("*").alias("rows"))
    return named.unionByName(unmapped.select(F.concat(F.lit("unmapped:"), "event_type").alias("name"), "rows"))
