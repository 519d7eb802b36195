"""Window operators (W) and late-data semantics (R)."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.operators import scans as S
from lakeops.operators import windows as W
from lakeops.registry import half_up, query

DAY = 86_400
TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def ts(expr):
    return TS.format(expr)


def user_hot(events, max_rows=S.MAX_GROUP_ROWS):
    return S.find_hot(events, ["user_id"], F.unix_micros("ts"), max_rows)


@query("W1_top_n", """
    SELECT c_nationkey, c_custkey, c_acctbal, rn FROM (SELECT *, CAST(row_number() OVER
      (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rn FROM customer) WHERE rn <= 2""")
def w1(t):
    return W.top_n(t.customer, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")], 2, "rn").select(
        "c_nationkey", "c_custkey", "c_acctbal", "rn")


@query("W2_ranks", """
    SELECT p_partkey, CAST(rank() OVER w AS BIGINT) AS rk, CAST(dense_rank() OVER w AS BIGINT) AS dr,
           percent_rank() OVER w AS pr, CAST(ntile(4) OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS INTEGER) AS quarter
    FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size DESC)""")
def w2(t):
    p, pos = t.part, -F.col("p_size")
    hot = S.find_hot(p, ["p_brand"], pos)
    ranked = S.scan(p, ["p_brand"], [F.col("p_size").desc()], [S.rank("rk"), S.dense_rank("dr")], hot, pos, nulls_behind=True)
    sized = S.keyed_join(ranked, p.groupBy("p_brand").agg(F.count("*").alias("n")), ["p_brand"])
    sized = sized.withColumn("pr", F.when(F.col("n") > 1, (F.col("rk") - 1) / (F.col("n") - 1)).otherwise(0.0))
    return W.bands(sized, ["p_brand"], [F.col("p_size").desc(), F.col("p_partkey")], pos, 4, hot, "quarter", nulls_behind=True).select(
        "p_partkey", "rk", "dr", "pr", "quarter")


NEIGHBOURS = f"""
    SELECT event_id, lag(event_id) OVER w AS prev_event, lead(event_id) OVER w AS next_event,
           {half_up("(epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 60000000.0", 1)} AS mins_since_prev,
           CAST(row_number() OVER w AS BIGINT) AS seq FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def neighbours(t, max_rows):
    e = t.events.withColumn("at", F.unix_micros("ts"))
    near = S.scan(e, ["user_id"], ["at", "event_id"],
                  [S.lag("event_id", "prev_event"), S.lead("event_id", "next_event"), S.lag("at", "before"),
                   S.row_number("seq")], user_hot(e, max_rows), F.col("at"))
    return near.select("event_id", "prev_event", "next_event",
                       F.round((F.col("at") - F.col("before")) / F.lit(60_000_000.0), 1).alias("mins_since_prev"), "seq")


@query("W3_lag_lead", NEIGHBOURS)
def w3(t):
    return neighbours(t, S.MAX_GROUP_ROWS)


@query("W3_lag_lead_cut_keys", NEIGHBOURS)
def w3_cut(t):
    return neighbours(t, 50)


RUNNING = """
    SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_total,
           CAST(count(*) OVER w AS BIGINT) AS so_far
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


def running(t, max_rows):
    e = t.events.withColumn("amount", C.money("value"))
    r = S.scan(e, ["user_id"], ["ts", "event_id"], [S.running_sum("amount", "running"), S.row_number("so_far")],
               user_hot(e, max_rows), F.unix_micros("ts"))
    return r.select("event_id", C.as_double("running", "running_total"), "so_far")


@query("W4_running_total", RUNNING)
def w4(t):
    return running(t, S.MAX_GROUP_ROWS)


@query("W4_running_total_cut_keys", RUNNING)
def w4_cut(t):
    return running(t, 60)


SEQUENCE = """
    SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS seq FROM orders"""


@query("W5_global_sequence", SEQUENCE)
def w5(t):
    o = t.orders
    # any table larger than this many rows is numbered in segments by many tasks
    return W.global_sequence(o, ["o_orderdate", "o_orderkey"], F.unix_micros("o_orderdate"), "seq",
                             max_rows=2_000).select("o_orderkey", "seq")


LINE_TIES = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]


@query("W6_latest_wins", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn
      FROM lineitem) WHERE rn = 1""")
def w6(t):
    return W.latest_wins(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in LINE_TIES]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("W7_natural_key_dedup", """
    SELECT user_id, event_type, hour, event_id FROM (SELECT user_id, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour,
      event_id, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""")
def w7(t):
    e = t.events.withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    return W.latest_wins(e, ["user_id", "event_type", "hour"], [F.col("ts").desc(), F.col("event_id").desc()]).select(
        "user_id", "event_type", "hour", "event_id")


@query("W8_collapse_changes", """
    SELECT user_id, day, event_id, event_type = 'error' AS deleted FROM (SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (
      PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def w8(t):
    from lakeops.operators.changes import collapse
    e = t.events.withColumn("day", F.to_date("ts"))
    return collapse(e, ["user_id", "day"], ["ts", "event_id"], F.col("event_type") == "error").select(
        "user_id", "day", "event_id", F.col("_deleted").alias("deleted"))


ROLLING = """
    SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts
           RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS DOUBLE) AS outflow FROM events"""


def rolling(t, max_rows):
    e = t.events.withColumn("amount", C.money("value"))
    r = W.rolling_sum(e, ["user_id"], "ts", "amount", DAY, ["event_id"], user_hot(e, max_rows), "rolled")
    return r.select("event_id", C.as_double("rolled", "outflow"))


@query("W9_rolling_range_sum", ROLLING)
def w9(t):
    return rolling(t, S.MAX_GROUP_ROWS)


@query("W9_rolling_range_sum_cut_keys", ROLLING)
def w9_cut(t):
    return rolling(t, 60)


MEDIAN_PRIOR = """
    SELECT o_orderkey, quantile_disc(o_totalprice, 0.5) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS median_prior FROM orders"""


def median_prior(t, max_rows):
    pos = S.position(t.orders, "o_orderdate")
    hot = S.find_hot(t.orders, ["o_custkey"], pos, max_rows)
    return W.trailing_median(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "median_prior",
                             hot, pos, max_rows).select("o_orderkey", "median_prior")


@query("W10_trailing_median", MEDIAN_PRIOR)
def w10(t):
    return median_prior(t, S.MAX_GROUP_ROWS)


@query("W10_trailing_median_cut_keys", MEDIAN_PRIOR)
def w10_cut(t):
    return median_prior(t, 12)


@query("W11_latest_over_median", f"""
    SELECT o_custkey, CASE WHEN med > 0 THEN {half_up("last_total / med", 4)} END AS shock FROM (
      SELECT o_custkey, max(o_totalprice) FILTER (WHERE rn = 1) AS last_total,
             quantile_disc(o_totalprice, 0.5) FILTER (WHERE rn > 1) AS med FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
      GROUP BY 1)""")
def w11(t):
    from lakeops.jobs.churn import bill_shock
    return bill_shock(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice").select(
        "o_custkey", F.col("bill_shock_ratio").alias("shock"))


SESSIONS = """
    SELECT event_id, user_id || '#' || sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_key
    FROM (SELECT *, CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > {gap} THEN 1 ELSE 0 END AS fresh
          FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events))"""


def sessions(t, max_rows, gap=6 * 3600):
    e = t.events
    s = W.sessionize(e, ["user_id"], "ts", gap, ["event_id"], user_hot(e, max_rows))
    return s.select("event_id", F.concat_ws("#", "user_id", "session_seq").alias("session_key"))


@query("W12_sessions", SESSIONS.format(gap=6 * 3600 * 1_000_000))
def w12(t):
    return sessions(t, S.MAX_GROUP_ROWS)


@query("W12_sessions_cut_keys", SESSIONS.format(gap=6 * 3600 * 1_000_000))
def w12_cut(t):
    return sessions(t, 50)


@query("W13_gap_rhythm", f"""
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS topups, {half_up("avg(gap)", 2)} AS avg_gap, quantile_disc(gap, 0.5) AS median_gap,
           {half_up("stddev_samp(gap)", 2)} AS sd_gap,
           CASE WHEN quantile_disc(gap, 0.5) > 0 THEN {half_up("date_diff('day', max(d), DATE '2001-08-02') / CAST(quantile_disc(gap, 0.5) AS DOUBLE)", 3)} END AS overdue_ratio
    FROM (SELECT o_custkey, d, CAST(date_diff('day', lag(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey), d) AS INTEGER) AS gap
          FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)) GROUP BY 1""")
def w13(t):
    from lakeops.jobs.churn import topup_gaps
    o = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"))
    gaps = topup_gaps(o, ["o_custkey"], "d", ["o_orderkey"])
    g = gaps.groupBy("o_custkey").agg(
        F.count("*").alias("topups"), F.round(F.avg("gap_days"), 2).alias("avg_gap"),
        F.percentile_approx("gap_days", 0.5).alias("median_gap"), F.round(F.stddev("gap_days"), 2).alias("sd_gap"),
        F.max("d").alias("last"))
    since = F.datediff(F.to_date(F.lit("2001-08-02")), "last")
    return g.withColumn("overdue_ratio", C.safe_ratio(since, "median_gap", 3)).drop("last")


@query("W14_repeat_contact", """
    SELECT o_orderkey, COALESCE(date_diff('day', lag(d) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY d, o_orderkey), d) <= 60, FALSE) AS is_repeat
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def w14(t):
    from lakeops.jobs.churn import repeat_contacts
    o = t.orders.withColumn("d", F.to_date("o_orderdate"))
    return repeat_contacts(o, ["o_custkey", "o_orderpriority"], "d", ["o_orderkey"], 60).select("o_orderkey", "is_repeat")


OUTAGES = """
    slots AS (SELECT DISTINCT user_id, to_timestamp(epoch_us(ts) // 1000000 // 21600 * 21600)::TIMESTAMP AS slot FROM events),
    grid AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS slot FROM
             (SELECT user_id, min(slot) AS lo, max(slot) AS hi FROM slots GROUP BY 1)),
    silent AS (SELECT * FROM grid g WHERE NOT EXISTS (SELECT 1 FROM slots s WHERE s.user_id = g.user_id AND s.slot = g.slot)),
    flagged AS (SELECT *, CASE WHEN p IS NULL OR epoch(slot) - epoch(p) > 21600 THEN 1 ELSE 0 END AS f FROM
                (SELECT *, lag(slot) OVER (PARTITION BY user_id ORDER BY slot) AS p FROM silent)),
    numbered AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY slot ROWS UNBOUNDED PRECEDING) AS run FROM flagged),
    outages AS (SELECT user_id, user_id // 10 AS block, min(slot) AS s, max(slot) AS e, CAST(count(*) AS BIGINT) AS slots
                FROM numbered GROUP BY user_id, run HAVING count(*) >= 3)"""


def outages(t):
    present = t.events.select("user_id", C.snap_down("ts", 21_600).alias("slot")).distinct()
    return W.missing_runs(present, ["user_id"], "slot", 21_600, 3)


@query("W15_missing_runs", f"""
    WITH {OUTAGES} SELECT user_id, {ts('s')} AS run_start, {ts('e')} AS run_end, slots FROM outages""")
def w15(t):
    return outages(t).select("user_id", C.stamp("run_start").alias("run_start"), C.stamp("run_end").alias("run_end"), "slots")


BREACHES = f"""
    SELECT user_id, {ts('min(ts)')} AS breach_start, CAST(count(*) AS BIGINT) AS pings, max(value) AS worst,
           CASE WHEN max(epoch_us(ts)) - min(epoch_us(ts)) > 36000000000 THEN 'CRITICAL'
                WHEN max(epoch_us(ts)) - min(epoch_us(ts)) > 18000000000 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
    FROM (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (
            SELECT *, CASE WHEN oor AND NOT COALESCE(lag(oor) OVER (PARTITION BY user_id ORDER BY ts, event_id), FALSE) THEN 1 ELSE 0 END AS st
            FROM (SELECT *, value > 40 AS oor FROM events)))
    WHERE oor GROUP BY user_id, run HAVING max(epoch_us(ts)) - min(epoch_us(ts)) > 1800000000"""


def breach_runs(t, max_rows):
    from lakeops.jobs.coldchain import breach_severity
    e = t.events.withColumn("oor", F.col("value") > 40)
    runs = W.state_runs(e, ["user_id"], "ts", "oor", ["event_id"], user_hot(t.events, max_rows))
    g = runs.groupBy("user_id", "run_id").agg(
        C.stamp(F.min("ts")).alias("breach_start"), F.count("*").alias("pings"), F.max("value").alias("worst"),
        ((F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / 60_000_000).alias("minutes"))
    return g.where("minutes > 30").select("user_id", "breach_start", "pings", "worst",
                                          breach_severity("minutes", 300, 600).alias("severity"))


@query("W16_out_of_range_runs", BREACHES)
def w16(t):
    return breach_runs(t, S.MAX_GROUP_ROWS)


@query("W16_out_of_range_runs_cut_keys", BREACHES)
def w16_cut(t):
    return breach_runs(t, 50)


@query("W17_spikes", """
    SELECT event_id, value AS value_raw, spike AS is_spike, CASE WHEN spike THEN (p + n) / 2 ELSE value END AS value FROM (
      SELECT *, COALESCE(abs(value - p) > 8 AND abs(value - n) > 8 AND abs(p - n) < 2, FALSE) AS spike FROM (
        SELECT *, lag(value) OVER w AS p, lead(value) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))""")
def w17(t):
    e = t.events
    return W.smooth_spikes(e, ["user_id"], ["ts", "event_id"], "value", 8, 2, user_hot(e), F.unix_micros("ts")).select(
        "event_id", "value_raw", "is_spike", "value")


@query("W18_carry_forward_grid", f"""
    WITH r AS (SELECT user_id, ts, value, epoch_us(ts) // 1000000 // 21600 AS k FROM events WHERE event_type = 'view'),
    f AS (SELECT user_id, k, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean, CAST(count(*) AS BIGINT) AS obs FROM r GROUP BY 1, 2),
    g AS (SELECT user_id, unnest(generate_series(min(CAST(k AS BIGINT)), max(CAST(k AS BIGINT)))) AS k FROM r GROUP BY 1),
    gt AS (SELECT user_id, k, to_timestamp(k * 21600)::TIMESTAMP AS slot FROM g),
    c AS (SELECT gt.*, r.ts AS seen_at, r.value AS v FROM gt ASOF LEFT JOIN r ON gt.user_id = r.user_id AND gt.slot > r.ts)
    SELECT c.user_id, {ts('c.slot')} AS slot, COALESCE(obs, 0) AS observations,
           {half_up("CASE WHEN obs > 0 THEN mean WHEN epoch_us(c.slot) - epoch_us(seen_at) <= 129600000000 THEN v END", 4)} AS value,
           CASE WHEN obs > 0 THEN 'observed' WHEN epoch_us(c.slot) - epoch_us(seen_at) <= 129600000000 THEN 'carried' ELSE 'gap' END AS source
    FROM c LEFT JOIN f ON c.user_id = f.user_id AND c.k = f.k""")
def w18(t):
    r = W.resample(t.events.where("event_type = 'view'"), ["user_id"], "ts", "value", 21_600, 36 * 3600)
    return r.select("user_id", C.stamp("slot").alias("slot"), "observations", F.round("value", 4).alias("value"), "source")


HISTORY = """(SELECT o_custkey, o_orderpriority AS attribute, d AS valid_from, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS valid_to
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d) AS rn, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY d) AS prev
          FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max_by(o_orderpriority, o_orderkey) AS o_orderpriority
                FROM orders GROUP BY 1, 2))
    WHERE rn = 1 OR o_orderpriority <> prev)"""


def history(t):
    """Slowly changing attribute per customer: the priority of the last order of a day."""
    daily = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(
        F.max_by("o_orderpriority", "o_orderkey").alias("attribute"))
    return W.close_intervals(daily, ["o_custkey"], "d", "attribute", S.HotKeys(("o_custkey",)),
                             "valid_from", "valid_to").drop("previous_attribute")


@query("W19_close_intervals", f"SELECT o_custkey, attribute, valid_from, valid_to FROM {HISTORY}")
def w19(t):
    return history(t)


@query("W20_percent_change", """
    SELECT product, day, prev, price, (price - prev) / prev AS pct FROM (SELECT *, lag(price) OVER (PARTITION BY product ORDER BY day) AS prev
      FROM (SELECT CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS product, CAST(ts AS DATE) AS day, min_by(value, ts) AS price
            FROM events GROUP BY 1, 2)) WHERE prev > 0 AND abs((price - prev) / prev) > 0.15""")
def w20(t):
    from lakeops.jobs.clicks import catalog_days, price_changes
    return price_changes(catalog_days(t.events), 0.15).select("product", "day", F.col("prev_price").alias("prev"), "price",
                                                              F.col("pct_change").alias("pct"))


BANDS = """
    SELECT c_custkey, tile, CASE WHEN tile = 1 THEN 'CRITICAL' WHEN tile <= 2 THEN 'HIGH' WHEN tile <= 5 THEN 'MEDIUM' ELSE 'LOW' END AS band
    FROM (SELECT c_custkey, CAST(ntile(10) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS tile FROM customer)"""


def risk(t, max_rows):
    from lakeops.jobs.churn import risk_band
    c, pos = t.customer, -F.col("c_acctbal")
    hot = S.find_hot(c, ["c_mktsegment"], pos, max_rows)
    b = W.bands(c, ["c_mktsegment"], [F.col("c_acctbal").desc(), F.col("c_custkey")], pos, 10, hot, "tile", nulls_behind=True)
    return b.select("c_custkey", "tile", risk_band("tile").alias("band"))


@query("W21_deciles", BANDS)
def w21(t):
    return risk(t, S.MAX_GROUP_ROWS)


@query("W21_deciles_cut_keys", BANDS)
def w21_cut(t):
    return risk(t, 100)


@query("W22_home_entity", """
    SELECT o_custkey, o_orderpriority AS home, share FROM (SELECT *, n / CAST(sum(n) OVER (PARTITION BY o_custkey) AS DOUBLE) AS share,
      row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS rn
      FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn = 1""")
def w22(t):
    n = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    total = n.groupBy("o_custkey").agg(F.sum("n").alias("total"))
    home = W.top_n(n, ["o_custkey"], [F.col("n").desc(), F.col("o_orderpriority")], 1)
    return home.join(total, "o_custkey").select("o_custkey", F.col("o_orderpriority").alias("home"),
                                                (F.col("n") / F.col("total").cast("double")).alias("share"))


@query("W23_gap_percentiles", f"""
    SELECT user_id, CAST(count(g) AS BIGINT) AS gaps, {half_up("quantile_cont(g, 0.5)", 4)} AS p50, {half_up("quantile_cont(g, 0.95)", 4)} AS p95
    FROM (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 60000000.0 AS g FROM events)
    WHERE g IS NOT NULL GROUP BY 1""")
def w23(t):
    e = t.events.withColumn("at", F.unix_micros("ts"))
    g = S.scan(e, ["user_id"], ["at", "event_id"], [S.lag("at", "before")], user_hot(e), F.col("at")).withColumn(
        "g", (F.col("at") - F.col("before")) / F.lit(60_000_000.0))
    p = S.exact_percentiles(g, ["user_id"], "g", {"p50": 0.5, "p95": 0.95})
    return p.select("user_id", F.col("n_values").alias("gaps"), F.round("p50", 4).alias("p50"), F.round("p95", 4).alias("p95"))


@query("W24_sigma_rule", """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2),
    b AS (SELECT *, count(*) OVER w AS days, avg(n) OVER w AS mean, stddev_samp(n) OVER w AS sd FROM d
          WINDOW w AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT user_id, day, n, sd > 0 AND n > round(mean + 2 * sd, 9) AS anomalous FROM b WHERE days >= 5""")
def w24(t):
    from lakeops.jobs.radio import sigma_anomalies
    d = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return sigma_anomalies(d, ["user_id"], "day", "n", 28, 2.0).where("baseline_days >= 5").select(
        "user_id", "day", "n", "anomalous")


# ------------------------------------------------------------------ late and windowed data
@query("R2_late_merge", """
    SELECT user_id, CAST(count(*) AS BIGINT) AS kept, max(event_id) AS newest FROM events
    WHERE ts >= TIMESTAMP '2024-01-14 18:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1""")
def r2(t):
    from lakeops.sources.readers import late_window
    start, end = late_window("2024-01-15", 6)
    return t.events.where((F.col("ts") >= start) & (F.col("ts") < end)).groupBy("user_id").agg(
        F.count("*").alias("kept"), F.max("event_id").alias("newest"))


@query("R3_tumbling_window", f"""
    SELECT event_type, {ts("to_timestamp(epoch_us(ts) // 1000000 // 900 * 900)::TIMESTAMP")} AS window_start, CAST(count(*) AS BIGINT) AS n,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def r3(t):
    g = t.events.groupBy(F.window("ts", "15 minutes").alias("w"), "event_type").agg(
        F.count("*").alias("n"), C.as_double(F.sum(C.money("value")), "total"))
    return g.select("event_type", C.stamp("w.start").alias("window_start"), "n", "total")


@query("R4_rolling_not_tumbling", ROLLING.replace("24 HOUR", "15 MINUTE"))
def r4(t):
    e = t.events.withColumn("amount", C.money("value"))
    r = W.rolling_sum(e, ["user_id"], "ts", "amount", 900, ["event_id"], user_hot(e), "rolled")
    return r.select("event_id", C.as_double("rolled", "outflow"))


@query("R5_session_window", f"""
    SELECT user_id, {ts('min(ts)')} AS session_start, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT ts, user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM
      (SELECT *, CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > 1800000000 THEN 1 ELSE 0 END AS fresh
       FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events))) GROUP BY user_id, s""")
def r5(t):
    # session_window merges partial sessions map-side, so a busy user arrives pre-aggregated
    s = t.events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", C.stamp("w.start").alias("session_start"), "n")


@query("R6_half_open_ownership", """
    SELECT CAST(count(*) AS BIGINT) AS rows_owned, CAST(sum(CASE WHEN owner IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS owned_once,
           CAST(count(DISTINCT owner) AS BIGINT) AS windows FROM (SELECT epoch_us(ts) // 1000000 // 900 AS owner FROM events)""")
def r6(t):
    w = t.events.select(F.window("ts", "15 minutes").alias("w"), "ts")
    return w.agg(F.count("*").alias("rows_owned"),
                 F.count_if((F.col("ts") >= F.col("w.start")) & (F.col("ts") < F.col("w.end"))).alias("owned_once"),
                 F.countDistinct("w.start").alias("windows"))


@query("R7_out_of_order", """
    SELECT user_id, max_by(event_id, (ts, event_id)) AS last_event, max_by(event_type, (ts, event_id)) AS state FROM events GROUP BY 1""")
def r7(t):
    # the source time decides, whatever order the rows arrive in
    arrived = t.events.repartition(7, "event_id")
    return W.latest_wins(arrived, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select(
        "user_id", F.col("event_id").alias("last_event"), F.col("event_type").alias("state"))
