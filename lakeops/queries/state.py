"""Table state (T), sources and sinks that can be checked in SQL (S, K), gates (G, X)."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import scalar as C
from lakeops.jobs import erasure as erasure_job
from lakeops.operators import changes, drift, erasure, evolve, gates
from lakeops.operators import versions as V
from lakeops.queries.aggregates import DAILY, PRICE, TOTAL, daily_summary
from lakeops.queries.windowed import ts
from lakeops.registry import half_up, query
from lakeops.sinks import writers
from lakeops.sources import dialects, readers

# ------------------------------------------------------------------ merge
TARGET = f"(SELECT o_orderkey AS k, o_orderstatus AS status, {TOTAL} AS amount, o_orderdate AS d, FALSE AS is_deleted FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
SOURCE = f"""(SELECT o_orderkey AS k, lower(o_orderstatus) AS status, {TOTAL} + 1 AS amount,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate + INTERVAL 1 DAY END AS d,
    o_orderpriority = '5-LOW' AS gone FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""


def merge_sides(t):
    o = t.orders
    amount = C.money("o_totalprice")
    target = o.where("o_orderdate < TIMESTAMP '2000-01-01'").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), amount.alias("amount"),
        F.col("o_orderdate").alias("d"), F.lit(False).alias("is_deleted"))
    shift = F.when(F.col("o_orderpriority") == "1-URGENT", F.expr("o_orderdate - INTERVAL 1 DAY")).otherwise(
        F.expr("o_orderdate + INTERVAL 1 DAY"))
    source = o.where("o_orderdate >= TIMESTAMP '1998-01-01'").select(
        F.col("o_orderkey").alias("k"), F.lower("o_orderstatus").alias("status"), (amount + 1).alias("amount"),
        shift.alias("d"), (F.col("o_orderpriority") == "5-LOW").alias("gone"))
    return target, source


def shown(df):
    return df.select("k", "status", C.as_double("amount", "amount"), C.stamp("d").alias("d"), "is_deleted")


def merged_sql(status, amount, d, deleted="COALESCE(t.is_deleted, FALSE)", keep="TRUE"):
    return f"""SELECT COALESCE(t.k, s.k) AS k, {status} AS status, CAST({amount} AS DOUBLE) AS amount, {ts(d)} AS d, {deleted} AS is_deleted
        FROM {TARGET} t FULL JOIN {SOURCE} s ON t.k = s.k WHERE {keep}"""


def pick(c, cond):
    return f"CASE WHEN t.k IS NULL OR ({cond}) THEN s.{c} ELSE t.{c} END"


@query("T1_merge", merged_sql(pick("status", "s.k IS NOT NULL"), pick("amount", "s.k IS NOT NULL"), pick("d", "FALSE"), "t.is_deleted"))
def t1(t):
    target, source = merge_sides(t)
    return shown(changes.merge(target, source.drop("gone"), ["k"], update=["status", "amount"]))


@query("T2_merge_newer_only", merged_sql(*[pick(c, "s.d > t.d") for c in ("status", "amount", "d")], "t.is_deleted"))
def t2(t):
    target, source = merge_sides(t)
    return shown(changes.merge(target, source.drop("gone"), ["k"], newer=("d", "d")))


@query("T3_merge_with_deletes", merged_sql(*[pick(c, "s.d > t.d") for c in ("status", "amount", "d")], "t.is_deleted",
                                            "NOT COALESCE(s.gone, FALSE)"))
def t3(t):
    target, source = merge_sides(t)
    return shown(changes.merge(target, source, ["k"], newer=("d", "d"), deleted="gone"))


@query("T4_merge_soft_delete", merged_sql(
    *[pick(c, "NOT s.gone AND s.d > t.d") for c in ("status", "amount", "d")],
    "COALESCE(t.k IS NOT NULL AND s.gone, FALSE)", "t.k IS NOT NULL OR NOT s.gone"))
def t4(t):
    target, source = merge_sides(t)
    return shown(changes.merge(target, source, ["k"], newer=("d", "d"), deleted="gone", soft_delete="is_deleted"))


@query("T6_update_delete_insert", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT -1, 10.5, 'NEW' UNION ALL SELECT -2, 20.0, NULL""")
def t6(t):
    c = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    c = changes.update_where(c, F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0)})
    c = changes.delete_where(c, F.col("c_mktsegment") == "BUILDING")
    c = changes.insert_rows(c, [(-1, 10.5, "NEW")], ["c_custkey", "c_acctbal", "c_mktsegment"])
    return changes.insert_rows(c, [(-2, 20.0)], ["c_custkey", "c_acctbal"])


@query("T7_flatten_envelope", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CASE WHEN o_orderstatus = 'P' THEN 'd' ELSE 'u' END AS cdc_operation,
           {ts('o_orderdate')} AS source_ts, o_custkey AS source_lsn,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST({TOTAL} AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS status, o_orderstatus = 'P' AS deleted FROM orders""")
def t7(t):
    image = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("transaction_id"),
                               C.money("o_totalprice").cast("string").alias("amount"), F.col("o_orderpriority").alias("status")))
    gone = F.col("o_orderstatus") == "P"
    millis = F.unix_millis("o_orderdate")
    env = t.orders.select(
        F.when(gone, "d").otherwise("u").alias("op"), (millis + 5000).alias("ts_ms"),
        F.struct(F.lit("ledger").alias("table"), F.col("o_custkey").alias("lsn"), millis.alias("ts_ms")).alias("source"),
        image.alias("before"), F.when(~gone, image).alias("after"))
    flat = changes.flatten_envelope(env, "transaction_id", {"amount": "decimal(18,2)", "status": "string"})
    return flat.select("transaction_id", "cdc_operation", C.stamp("source_ts").alias("source_ts"), "source_lsn",
                       C.as_double("amount", "amount"), "status", F.col("_deleted").alias("deleted"))


# ------------------------------------------------------------------ version log over events: one commit per day
LOG = """log AS (SELECT user_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS BIGINT) AS commit_id,
    date_trunc('day', ts) + INTERVAL 1 DAY AS committed_at, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
    event_id, value FROM events)"""


def state_sql(version, where="TRUE"):
    return f"""(SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY commit_id DESC, event_id DESC) AS rn
        FROM log WHERE commit_id <= {version} AND {where}) WHERE rn = 1 AND op <> 'delete')"""


def version_log(t):
    day = F.to_date("ts")
    return t.events.select(
        (F.datediff(day, F.lit("2024-01-01").cast("date")) + 1).cast("bigint").alias("commit_id"),
        F.date_add(day, 1).cast("timestamp").alias("committed_at"), F.lit(V.MAIN).alias("branch"),
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"), "user_id", "event_id", "value")


KEYS, ORDER = ["user_id"], ["event_id"]


def commits(t):
    """One row per commit, each on top of the one before."""
    c = version_log(t).groupBy("commit_id", "committed_at").agg(F.count("*").alias("n"))
    parent = F.when(F.col("commit_id") > 1, F.col("commit_id") - 1)
    return c.select("commit_id", parent.alias("parent_id"), "committed_at", F.lit("append").alias("operation"))


@query("T8_as_of_version", f"WITH {LOG} SELECT * FROM {state_sql(12)}")
def t8(t):
    return V.as_of_version(version_log(t), KEYS, 12, order=ORDER)


@query("T9_as_of_time", f"""
    WITH {LOG} SELECT * FROM {state_sql("(SELECT max(commit_id) FROM log WHERE committed_at < TIMESTAMP '2024-01-16 00:00:00')")}""")
def t9(t):
    return V.as_of_time(version_log(t), KEYS, "2024-01-16 00:00:00", ORDER)


@query("T10_commit_summary", f"""
    WITH {LOG}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, commit_id ORDER BY event_id DESC) AS rn FROM log) WHERE rn = 1),
    m AS (SELECT *, COALESCE(lag(op) OVER (PARTITION BY user_id ORDER BY commit_id) = 'upsert', FALSE) AS live FROM l),
    p AS (SELECT commit_id, CAST(count(*) FILTER (WHERE op = 'upsert' AND NOT live) AS BIGINT) AS added,
                 CAST(count(*) FILTER (WHERE op = 'upsert' AND live) AS BIGINT) AS updated,
                 CAST(count(*) FILTER (WHERE op = 'delete' AND live) AS BIGINT) AS deleted FROM m GROUP BY 1)
    SELECT *, CAST(sum(added - deleted) OVER (ORDER BY commit_id) AS BIGINT) AS live_keys FROM p""")
def t10(t):
    return V.commit_summary(version_log(t), KEYS, ORDER).drop("committed_at")


CHAIN = """c AS (SELECT DISTINCT commit_id, CASE WHEN commit_id > 1 THEN commit_id - 1 END AS parent_id FROM log
             UNION ALL SELECT max(commit_id) + 1, 18 FROM log),
    a AS (SELECT commit_id, parent_id FROM c WHERE commit_id = 31 UNION ALL SELECT c.commit_id, c.parent_id FROM c JOIN a ON c.commit_id = a.parent_id)"""


@query("T11_rollback_abandoned", f"WITH RECURSIVE {LOG}, {CHAIN} SELECT commit_id FROM c WHERE commit_id NOT IN (SELECT commit_id FROM a)")
def t11(t):
    rolled = V.with_rollback(commits(t), 18)
    head = rolled.agg(F.max("commit_id").alias("h")).first()["h"]
    return V.abandoned(rolled, head).select("commit_id")


@query("T12_roll_forward", f"WITH {LOG} SELECT 'main' AS branch, CAST(count(*) AS BIGINT) AS live_keys, max(event_id) AS newest FROM {state_sql(30)}")
def t12(t):
    log = version_log(t)
    pointers = t.spark.createDataFrame([("main", 18)], "branch string, commit_id bigint")
    forward = V.set_current(pointers, "main", 30)
    version = forward.where("branch = 'main'").first()["commit_id"]
    return V.as_of_version(log, KEYS, version, order=ORDER).agg(
        F.lit("main").alias("branch"), F.count("*").alias("live_keys"), F.max("event_id").alias("newest"))


# ledger log over orders: booked, then restated and deleted by a second commit
LEDGER_LOG = f"""ledger AS (
    SELECT 1 AS commit_id, 'upsert' AS op, o_orderkey, o_custkey AS account_id, {TOTAL} AS amount, o_orderpriority AS currency,
           CASE o_orderstatus WHEN 'F' THEN 'CASH-IN' WHEN 'O' THEN 'CASH-OUT' ELSE 'TRANSFER' END AS tx_type, o_orderdate AS at_ts FROM orders
    UNION ALL
    SELECT 2, CASE WHEN o_orderpriority = '5-LOW' THEN 'delete' ELSE 'upsert' END, o_orderkey, o_custkey, {TOTAL} + 100, o_orderpriority,
           CASE o_orderstatus WHEN 'F' THEN 'CASH-IN' WHEN 'O' THEN 'CASH-OUT' ELSE 'TRANSFER' END, o_orderdate FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus <> 'O'),
    known AS (SELECT * FROM ledger WHERE commit_id = 1),
    now AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY commit_id DESC) AS rn FROM ledger) WHERE rn = 1 AND op <> 'delete')"""
NET = "CASE WHEN tx_type = 'CASH-IN' THEN amount ELSE -amount END"


def ledger_log(t):
    kind = F.when(F.col("o_orderstatus") == "F", "CASH-IN").when(F.col("o_orderstatus") == "O", "CASH-OUT").otherwise("TRANSFER")
    low = F.col("o_orderpriority") == "5-LOW"

    def commit(n, df, op, extra):
        return df.select(
            F.lit(n).cast("bigint").alias("commit_id"), F.lit(f"2002-01-0{n} 00:00:00").cast("timestamp").alias("committed_at"),
            F.lit(V.MAIN).alias("branch"), op.alias("op"), F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("account_id"), (C.money("o_totalprice") + extra).cast("decimal(18,2)").alias("amount"),
            F.col("o_orderpriority").alias("currency"), kind.alias("tx_type"), F.col("o_orderdate").alias("event_timestamp"),
            F.lit(False).alias("is_deleted"))

    changed = t.orders.where("o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus <> 'O'")
    return commit(1, t.orders, F.lit("upsert"), F.lit(0)).unionByName(
        commit(2, changed, F.when(low, "delete").otherwise("upsert"), F.lit(100)))


@query("T13_bitemporal_balance", f"""
    WITH {LEDGER_LOG}, a AS (SELECT account_id, sum({NET}) AS k FROM known WHERE at_ts <= TIMESTAMP '2000-06-30' GROUP BY 1),
    b AS (SELECT account_id, sum({NET}) AS r FROM now WHERE at_ts <= TIMESTAMP '2000-06-30' GROUP BY 1)
    SELECT COALESCE(a.account_id, b.account_id) AS account_id, CAST(k AS DOUBLE) AS as_known, CAST(r AS DOUBLE) AS as_restated,
           CAST(COALESCE(r, 0) - COALESCE(k, 0) AS DOUBLE) AS late_impact FROM a FULL JOIN b ON a.account_id = b.account_id""")
def t13(t):
    from lakeops.jobs.ledger import net
    b = V.bitemporal_balance(ledger_log(t), ["transaction_id"], 1, ["account_id"], "event_timestamp", "2000-06-30 00:00:00", net())
    return b.select("account_id", *[C.as_double(c, c) for c in ("as_known", "as_restated", "late_impact")])


@query("T14_read_tag", f"WITH {LOG} SELECT * FROM {state_sql(7)}")
def t14(t):
    tags = t.spark.createDataFrame([("close", 7, "2034-01-01")], "tag string, commit_id bigint, retain_until string")
    # the log keeps growing after the tag; what the tag shows does not
    return V.read_tag(version_log(t), KEYS, tags, "close", ORDER)


@query("T15_branch_publish", f"""
    WITH {LOG} SELECT 'main' AS view_of, CAST(count(*) AS BIGINT) AS live_keys, max(event_id) AS newest FROM {state_sql(30, 'commit_id <= 25')}
    UNION ALL SELECT 'branch', CAST(count(*) AS BIGINT), max(event_id) FROM {state_sql(30)}
    UNION ALL SELECT 'published', CAST(count(*) AS BIGINT), max(event_id) FROM {state_sql(30)}
    UNION ALL SELECT 'discarded', CAST(count(*) AS BIGINT), max(event_id) FROM {state_sql(30, 'commit_id <= 25')}""")
def t15(t):
    log = version_log(t)
    staged = log.withColumn("branch", F.when(F.col("commit_id") > 25, "audit_0126").otherwise(F.col("branch")))
    look = lambda name, df, branch: V.as_of_version(df, KEYS, 30, branch, ORDER).agg(
        F.lit(name).alias("view_of"), F.count("*").alias("live_keys"), F.max("event_id").alias("newest"))
    views = [look("main", staged, V.MAIN), look("branch", staged, "audit_0126"),
             look("published", V.publish(staged, "audit_0126"), V.MAIN),
             look("discarded", V.discard(staged, "audit_0126"), V.MAIN)]
    out = views[0]
    for v in views[1:]:
        out = out.unionByName(v)
    return out


@query("T16_expire_keeps_tag_and_horizon", f"""
    WITH {LOG} SELECT 5 AS version, * FROM {state_sql(5)} UNION ALL SELECT 20 AS version, * FROM {state_sql(20)}
    UNION ALL SELECT 28 AS version, * FROM {state_sql(28)}""")
def t16(t):
    log = version_log(t)
    tags = t.spark.createDataFrame([("q", 5)], "tag string, commit_id bigint")
    points = V.retained_points(commits(t), "2024-01-21 12:00:00", 3, tags)
    folded = V.expire(log, KEYS, points, ORDER)
    out = None
    for v in (5, 20, 28):
        one = V.as_of_version(folded, KEYS, V.require_readable(v, points), order=ORDER).withColumn("version", F.lit(v))
        out = one if out is None else out.unionByName(one)
    return out


@query("T17_copy_on_write_and_merge_on_read", """
    SELECT mode, o_orderkey, o_totalprice FROM orders, (VALUES ('copy-on-write'), ('merge-on-read')) AS m(mode)
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def t17(t):
    gone = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    cow = erasure.copy_on_write(t.orders, gone, "o_custkey").withColumn("mode", F.lit("copy-on-write"))
    mor = erasure.merge_on_read(t.orders, gone, ["o_custkey"]).withColumn("mode", F.lit("merge-on-read"))
    return cow.unionByName(mor).select("mode", "o_orderkey", "o_totalprice")


@query("T18_equality_and_position_deletes", """
    SELECT 'equality' AS kind, CAST(count(*) AS BIGINT) AS rows_left FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
    UNION ALL SELECT 'position', CAST(count(*) AS BIGINT) FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_quantity > 40)""")
def t18(t):
    li = t.lineitem
    by_key = erasure.merge_on_read(li, t.supplier.where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey")), ["l_suppkey"])
    marks = erasure.position_deletes(li, (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40))
    by_position = erasure.without_positions(li, marks)
    n = lambda df, k: df.agg(F.lit(k).alias("kind"), F.count("*").alias("rows_left"))
    return n(by_key, "equality").unionByName(n(by_position, "position"))


@query("T19_delete_debt", """
    SELECT 'before' AS stage, CAST((SELECT count(*) FROM customer WHERE c_acctbal < 0) AS BIGINT) AS delete_entries,
           CAST(count(*) FILTER (WHERE g) AS BIGINT) AS hidden_rows, CAST(count(*) FILTER (WHERE NOT g) AS BIGINT) AS live_rows
    FROM (SELECT o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS g FROM orders)
    UNION ALL SELECT 'compacted', 0, 0, CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def t19(t):
    deletes = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    folded = erasure.merge_on_read(t.orders, deletes, ["o_custkey"])
    # after compaction the delete set starts empty
    before = erasure.delete_debt(t.orders, deletes, ["o_custkey"]).withColumn("stage", F.lit("before"))
    after = erasure.delete_debt(folded, deletes.where(F.lit(False)), ["o_custkey"]).withColumn("stage", F.lit("compacted"))
    return before.unionByName(after)


@query("T21_schema_evolution", """
    SELECT o_orderkey AS id, o_totalprice AS order_total, CAST(o_custkey AS BIGINT) AS customer, CAST(NULL AS VARCHAR) AS loyalty_tier FROM orders""")
def t21(t):
    written = [evolve.Field(1, "o_orderkey", "bigint"), evolve.Field(2, "o_custkey", "int"),
               evolve.Field(3, "o_totalprice", "double"), evolve.Field(4, "o_orderstatus", "string")]
    now = evolve.rename(evolve.rename(evolve.rename(written, "o_orderkey", "id"), "o_totalprice", "order_total"), "o_custkey", "customer")
    now = evolve.drop(evolve.add(evolve.widen(now, "customer", "bigint"), "loyalty_tier", "string"), "o_orderstatus")
    now = evolve.reorder(now, ["id", "order_total", "customer", "loyalty_tier"])
    return evolve.read_as(t.orders.withColumn("o_custkey", F.col("o_custkey").cast("int")), written, now)


@query("T22_mixed_layouts", f"SELECT l_returnflag, CAST(sum({PRICE}) AS DOUBLE) AS price FROM lineitem GROUP BY 1")
def t22(t):
    # earlier rows carry a month, later ones a day: both read under one logical schema
    old = t.lineitem.where("l_shipdate < TIMESTAMP '1998-01-01'").withColumn("part_month", F.date_format("l_shipdate", "yyyy-MM"))
    new = t.lineitem.where("l_shipdate >= TIMESTAMP '1998-01-01'").withColumn("part_day", F.to_date("l_shipdate"))
    whole = evolve.union_layouts([old, new], ["l_returnflag", "l_extendedprice"])
    return whole.groupBy("l_returnflag").agg(C.as_double(F.sum(C.money("l_extendedprice")), "price"))


def erasure_scope(t):
    lines = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return {"customer": (t.customer, "c_custkey"), "lines": (lines, "o_custkey"), "orders": (t.orders, "o_custkey")}


GONE = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"
IN_SCOPE = f"""(SELECT 'customer' AS table_name, CAST(count(*) AS BIGINT) AS n FROM customer WHERE c_custkey IN {GONE}
    UNION ALL SELECT 'lines', CAST(count(*) AS BIGINT) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey IN {GONE}
    UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey IN {GONE})"""


def erased_customers(t):
    return t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("subject"))


@query("T23_erasure_audit", f"""
    SELECT table_name, n AS rows_targeted, CAST((SELECT count(*) FROM customer WHERE c_acctbal < 0) AS BIGINT) AS subjects,
           'merge-on-read' AS delete_mode FROM {IN_SCOPE}""")
def t23(t):
    return erasure.audit_rows(erasure_scope(t), erased_customers(t), "subject", "merge-on-read")


def landed_later(t):
    """Lines of late shipments and urgent orders arrive again after the erasure."""
    scope = erasure_scope(t)
    return {"lines": scope["lines"][0].where("l_shipdate >= TIMESTAMP '2001-01-01'"),
            "orders": scope["orders"][0].where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")}


RESIDUAL = f"""(SELECT 'customer' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM customer WHERE c_custkey IN {GONE} AND c_acctbal >= 0
    UNION ALL SELECT 'lines', CAST(count(*) AS BIGINT) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey IN {GONE} AND l_shipdate >= TIMESTAMP '2001-01-01'
    UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey IN {GONE} AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"""


@query("T24_erasure_residual", f"SELECT * FROM {RESIDUAL}")
def t24(t):
    return erasure_job.scope_check(erasure_scope(t), erased_customers(t), "subject", landed_later(t))


@query("T25_attestation", f"""
    SELECT table_name, n AS rows_before, rows AS rows_after, CASE WHEN table_name = 'orders' THEN n ELSE 0 END AS rows_in_history,
           table_name = 'orders' AND n > 0 AS history_reachable, CASE WHEN table_name = 'orders' AND n > 0 THEN '2024-02-07' END AS unrecoverable_at,
           rows = 0 AND NOT (table_name = 'orders' AND n > 0) AS erased FROM {IN_SCOPE} JOIN {RESIDUAL} USING (table_name)""")
def t25(t):
    scope, gone = erasure_scope(t), erased_customers(t)
    after = erasure_job.scope_check(scope, gone, "subject", landed_later(t))
    # an unexpired version of orders still holds the rows; the other tables have no old versions
    history = {k: (v if k == "orders" else (v[0].where(F.lit(False)), v[1])) for k, v in scope.items()}
    held = erasure.residual_rows(history, gone, "subject")
    return erasure.attestation(erasure.residual_rows(scope, gone, "subject"), after, held, "2024-02-07")


@query("T26_evidence_reproduction", f"WITH {LOG} SELECT 14 AS source_version, * FROM {state_sql(14)}")
def t26(t):
    log = version_log(t)
    live_update = log.where("commit_id = 30").withColumn("commit_id", F.lit(31).cast("bigint")).withColumn("value", F.lit(-1.0))
    after = log.unionByName(live_update)
    return V.as_of_version(after, KEYS, 14, order=ORDER).withColumn("source_version", F.lit(14))


@query("T27_late_row_kept_out", f"""
    SELECT CAST((SELECT count(*) FROM {SOURCE} s JOIN {TARGET} t ON s.k = t.k WHERE s.d <= t.d) AS BIGINT) AS late_in_bronze,
           CAST((SELECT count(*) FROM ({merged_sql(*[pick(c, "s.d > t.d") for c in ("status", "amount", "d")], "t.is_deleted")}) m
                 JOIN {SOURCE} s ON m.k = s.k JOIN {TARGET} t ON m.k = t.k WHERE s.d <= t.d AND m.status = s.status) AS BIGINT) AS overwritten""")
def t27(t):
    target, source = merge_sides(t)
    silver = changes.merge(target, source.drop("gone"), ["k"], newer=("d", "d"))
    late = source.select("k", F.col("status").alias("late_status"), F.col("d").alias("late_d")).join(
        target.select("k", F.col("d").alias("old_d")), "k").where("late_d <= old_d")
    checked = late.join(silver.select("k", "status"), "k")
    return checked.agg(F.count("*").alias("late_in_bronze"), F.count_if(F.col("status") == F.col("late_status")).alias("overwritten"))


@query("T28_settlement_drift", f"""
    WITH {LEDGER_LOG}, p AS (SELECT currency, CAST(at_ts AS DATE) AS business_date, sum({NET}) AS v FROM known GROUP BY 1, 2),
    r AS (SELECT currency, CAST(at_ts AS DATE) AS business_date, sum({NET}) AS v FROM now GROUP BY 1, 2)
    SELECT COALESCE(p.currency, r.currency) AS currency, COALESCE(p.business_date, r.business_date) AS business_date,
           CAST(p.v AS DOUBLE) AS published, CAST(r.v AS DOUBLE) AS restated,
           COALESCE(abs(CAST(r.v - p.v AS DOUBLE) / abs(CAST(p.v AS DOUBLE))) > 0.001, FALSE) AS material
    FROM p FULL JOIN r ON p.currency = r.currency AND p.business_date = r.business_date""")
def t28(t):
    from lakeops.jobs.ledger import settlement_drift
    d = settlement_drift(ledger_log(t), ["transaction_id"], 1)
    return d.select("currency", "business_date", C.as_double("published", "published"), C.as_double("restated", "restated"), "material")


@query("T29_changed_between", f"""
    WITH {LOG} SELECT COALESCE(a.user_id, b.user_id) AS user_id,
      CASE WHEN a.user_id IS NULL THEN 'added' WHEN b.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
      a.event_id AS old_event_id, b.event_id AS new_event_id, a.value AS old_value, b.value AS new_value
    FROM {state_sql(10)} a FULL JOIN {state_sql(11)} b ON a.user_id = b.user_id
    WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.event_id <> b.event_id""")
def t29(t):
    return V.changed_between(version_log(t), KEYS, 10, 11, ORDER)


# ------------------------------------------------------------------ sources and sinks
@query("S4_partition_and_time_range", """
    SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-19 00:00:00'""")
def s4(t):
    e = t.events.withColumn("dt", F.to_date("ts"))
    return readers.in_range(e, "2024-01-05 06:00:00", "2024-01-19 00:00:00", "dt", "ts").select("event_id", "user_id")


@query("S6_fixed_width", """
    SELECT '49' || l_orderkey AS a_number, '44' || l_partkey AS b_number, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS event_ts,
           CAST(l_quantity AS INTEGER) AS duration_sec, l_linenumber AS charged_units,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS charge FROM lineitem""")
def s6(t):
    pad = lambda c, n: F.rpad(c, n, " ")
    digits = lambda c, n: F.lpad(c.cast("string"), n, "0")
    cents = (C.money("l_extendedprice") * 100_000).cast("bigint")
    lines = t.lineitem.select(F.concat(
        pad(F.concat(F.lit("49"), F.col("l_orderkey").cast("string")), 15), pad(F.concat(F.lit("44"), F.col("l_partkey").cast("string")), 15),
        F.date_format("l_shipdate", "yyyyMMddHHmmss"), digits(F.col("l_quantity").cast("int"), 8),
        digits(F.col("l_linenumber"), 8), digits(cents, 15)).alias("value"))
    legs = dialects.fixed_width_legs(readers.split_fixed_width(lines, dialects.FIXED_WIDTH))
    return legs.select("a_number", "b_number", C.stamp("event_ts").alias("event_ts"), "duration_sec", "charged_units",
                       C.as_double("charge_amount", "charge"))


@query("S11_audit_columns")
def s11(t):
    return readers.with_audit(t.orders, "batch-7", "2002-01-01").select(
        "o_orderkey", "_src_file", "_batch_id", "extract_date")


@query("S12_lookup_rows", """
    SELECT event_type, label FROM (SELECT DISTINCT event_type FROM events) LEFT JOIN (VALUES ('click', 'engaged'), ('purchase', 'paid')) AS v(e, label) ON event_type = e""")
def s12(t):
    names = readers.lookup_table(t.spark, [("click", "engaged"), ("purchase", "paid")], "event_type string, label string")
    return t.events.select("event_type").distinct().join(F.broadcast(names), "event_type", "left")


@query("S13_late_window", """
    SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM events
    WHERE ts >= TIMESTAMP '2024-01-13 18:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""")
def s13(t):
    start, end = readers.late_window("2024-01-14", 6)
    return t.events.where((F.col("ts") >= start) & (F.col("ts") < end)).groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"))


HOURLY = """SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, CAST(count(*) AS BIGINT) AS orders,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM events GROUP BY 1, 2"""


@query("K14_window_refresh", HOURLY)
def k14(t):
    from lakeops.jobs.metrics import hourly_metrics, refresh
    stale = hourly_metrics(t.events.where("ts < TIMESTAMP '2024-01-29 05:30:00'"), ["event_type"], "ts", "value")
    fresh = refresh(stale, t.events, ["event_type"], "ts", "value", "2024-01-29 05:00:00")
    return fresh.withColumn("hour", C.stamp("hour"))


@query("K15_replace_dates", """
    SELECT CAST(o_orderdate AS DATE) AS d, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 2 ELSE 1 END) AS BIGINT) AS w
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderstatus = 'F' OR o_orderdate NOT IN (SELECT o_orderdate FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def k15(t):
    o = t.orders.withColumn("d", F.to_date("o_orderdate"))
    current = o.select("d", "o_orderkey", F.when(F.col("o_orderdate") >= "2000-01-01", 2).otherwise(1).alias("w"))
    staged = o.where("o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'F'").select("d", "o_orderkey", F.lit(2).alias("w"))
    return writers.replace_dates(current, staged, "d").groupBy("d").agg(F.count("*").alias("n"), F.sum("w").alias("w"))


@query("K18_temp_view", "SELECT n_regionkey, CAST(count(*) AS BIGINT) AS count FROM nation GROUP BY 1")
def k18(t):
    return writers.register_view(t.nation, "lakeops_nation").groupBy("n_regionkey").count()


# ------------------------------------------------------------------ gates
@query("G2_unique", """
    SELECT 'unique' AS gate, CAST(count(*) AS BIGINT) AS duplicate_keys, count(*) = 0 AS passed
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def g2(t):
    return gates.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("G3_score_distribution", f"""
    SELECT 'score_distribution' AS gate, CAST(count(*) FILTER (WHERE s IS NULL) AS BIGINT) AS nulls, {half_up("avg(s)", 6)} AS mean,
           {half_up("stddev_samp(s)", 6)} AS sd, count(*) FILTER (WHERE s IS NULL) = 0 AND avg(s) BETWEEN 0.01 AND 0.45 AND stddev_samp(s) >= 0.02 AS passed
    FROM (SELECT (c_acctbal + 1000) / 25000 AS s FROM customer)""")
def g3(t):
    s = t.customer.select(((F.col("c_acctbal") + 1000) / 25000).alias("s"))
    return gates.score_distribution(s, "s").withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


@query("G4_parse_failures", """
    SELECT 'parse_failures' AS gate, CAST(count(*) AS BIGINT) AS total, CAST(count(*) - count(n) AS BIGINT) AS bad_n,
           count(*) > 0 AND count(*) - count(n) <= count(*) * 0.001 AS passed
    FROM (SELECT TRY_CAST(split_part(o_orderpriority, '-', CASE WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 1 END) AS INTEGER) AS n FROM orders)""")
def g4(t):
    parts = F.split("o_orderpriority", "-")
    n = F.when(F.col("o_orderpriority") == "5-LOW", parts[1]).otherwise(parts[0]).try_cast("int")
    return gates.parse_failures(t.orders.select(n.alias("n")), ["n"])


@query("G5_complete_month", """
    SELECT 'complete_month' AS gate, CAST(count(DISTINCT CAST(l_shipdate AS DATE)) AS BIGINT) AS days_present, 30 AS days_expected,
           count(DISTINCT CAST(l_shipdate AS DATE)) = 30 AS passed FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') = '1998-06'""")
def g5(t):
    return gates.complete_month(t.lineitem, "l_shipdate", "1998-06")


@query("G6_lookup_coverage", """
    SELECT 'lookup_coverage' AS gate, CAST(count(*) AS BIGINT) AS missing_rows, count(*) = 0 AS passed FROM lineitem WHERE l_returnflag NOT IN ('R', 'A')""")
def g6(t):
    rates = t.spark.createDataFrame([("R", 0.92), ("A", 1.17)], "l_returnflag string, rate double")
    return gates.lookup_coverage(t.lineitem, rates, "l_returnflag")


@query("G7_duplicate_share", """
    SELECT 'duplicate_share' AS gate, CAST(sum(n) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS distinct_keys,
           CAST(100.0 * (sum(n) - count(*)) AS DOUBLE) / sum(n) AS duplicate_pct, CAST(100.0 * (sum(n) - count(*)) AS DOUBLE) / sum(n) <= 0.5 AS passed
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def g7(t):
    return gates.duplicate_share(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("G8_column_checks", """
    SELECT * FROM (SELECT 'c_custkey' AS "column", 'unique' AS "check", 0.0::DOUBLE AS bound, CAST(count(c_custkey) - count(DISTINCT c_custkey) AS DOUBLE) AS measured,
      count(c_custkey) - count(DISTINCT c_custkey) <= 0 AS passed FROM customer
    UNION ALL SELECT 'c_mktsegment', 'null', 0.0, CAST(count(*) - count(c_mktsegment) AS DOUBLE), count(*) - count(c_mktsegment) <= 0 FROM customer
    UNION ALL SELECT 'c_acctbal', 'min', 0.0, CAST(min(c_acctbal) AS DOUBLE), min(c_acctbal) >= 0 FROM customer
    UNION ALL SELECT 'c_acctbal', 'max', 10000.0, CAST(max(c_acctbal) AS DOUBLE), max(c_acctbal) <= 10000 FROM customer)""")
def g8(t):
    return gates.column_checks(t.customer, [("c_custkey", "unique", 0), ("c_mktsegment", "null", 0),
                                            ("c_acctbal", "min", 0), ("c_acctbal", "max", 10_000)])


@query("G9_table_checks", """
    SELECT 'value' AS gate, CAST(count(*) AS DOUBLE) AS measured, abs(count(*) - 15000) <= 15000 * 0.1 AS passed FROM orders
    UNION ALL SELECT 'interval', max(o_totalprice), max(o_totalprice) BETWEEN 1000 AND 600000 FROM orders
    UNION ALL SELECT 'threshold', CAST(count(*) FILTER (WHERE o_totalprice < 0) AS DOUBLE), count(*) FILTER (WHERE o_totalprice < 0) <= 0 FROM orders
    UNION ALL SELECT 'boolean', CASE WHEN bool_and(o_custkey >= 0) THEN 1.0 ELSE 0.0 END, bool_and(o_custkey >= 0) FROM orders""")
def g9(t):
    o = t.orders
    checks = [gates.table_check(o, F.count("*"), "value", 15_000, 0.1), gates.table_check(o, F.max("o_totalprice"), "interval", (1000, 600_000)),
              gates.table_check(o, F.count_if(F.col("o_totalprice") < 0), "threshold", 0),
              gates.table_check(o, F.bool_and(F.col("o_custkey") >= 0), "boolean", True)]
    shaped = [c.withColumn("measured", F.col("measured").cast("int").cast("double") if i == 3 else F.col("measured").cast("double"))
              for i, c in enumerate(checks)]
    out = shaped[0]
    for c in shaped[1:]:
        out = out.unionByName(c)
    return out


@query("G10_audit", """
    SELECT 'audit' AS gate, CAST(sum(e) AS BIGINT) AS missing_required, CAST(sum(g) AS BIGINT) AS negative_amounts,
           CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys, FALSE AS passed
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'N') AS e, count(*) FILTER (WHERE l_quantity - 10 < 0) AS g
          FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def g10(t):
    staged = t.lineitem.select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("region"),
                               (F.col("l_quantity") - 10).alias("amount"))
    return gates.audit(staged, "region", "amount", ["l_orderkey", "l_linenumber"])


@query("G11_invariant", f"""
    SELECT 'rollforward' AS gate, CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed FROM ({DAILY}) WHERE abs(opening + credit - debit - closing) > 0.01""")
def g11(t):
    from lakeops.functions.aggregates import rollforward_breaks
    return gates.no_rows(rollforward_breaks(daily_summary(t)), "rollforward")


@query("G13_worst_variance", f"""
    WITH v AS (SELECT l_suppkey, sum(CASE WHEN l_linestatus = 'F' THEN {PRICE} ELSE -{PRICE} END) AS variance FROM lineitem GROUP BY 1)
    SELECT 'worst_variance' AS gate, CAST(sum(abs(variance)) AS DOUBLE) AS total_abs, max_by(l_suppkey, abs(variance)) AS worst,
           CAST(max(abs(variance)) AS DOUBLE) AS worst_abs, max(abs(variance)) <= 50000 AS passed FROM v""")
def g13(t):
    from lakeops.functions.aggregates import signed
    v = t.lineitem.groupBy("l_suppkey").agg(F.sum(signed(C.money("l_extendedprice"), "l_linestatus", ["F"])).alias("variance"))
    g = gates.worst_variance(v, "l_suppkey", "variance", 50_000)
    return g.withColumns({c: C.as_double(c) for c in ("total_abs", "worst_abs")})


@query("G14_residual_after_erasure", f"SELECT 'erasure_residual' AS gate, CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed FROM {RESIDUAL} WHERE rows > 0")
def g14(t):
    left = erasure_job.scope_check(erasure_scope(t), erased_customers(t), "subject", landed_later(t))
    return gates.no_rows(left.where("rows > 0"), "erasure_residual")


@query("G15_deadline_watch", """
    SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS days_open FROM orders
    WHERE o_orderstatus = 'O' AND date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') > 23""")
def g15(t):
    open_orders = t.orders.where("o_orderstatus = 'O'")
    return gates.deadline_watch(open_orders, "o_orderdate", F.lit("2001-08-02").cast("date")).select("o_orderkey", "days_open")


@query("G16_profile_shares", f"""
    SELECT CAST(count(*) AS BIGINT) AS total, {half_up("100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*)", 4)} AS orphan_pct,
           {half_up("100.0 * count(*) FILTER (WHERE value > 200) / count(*)", 4)} AS implausible_pct FROM events""")
def g16(t):
    return gates.shares(t.events, {"orphan": F.col("event_type") == "error", "implausible": F.col("value") > 200})


@query("G18_volume_route", "SELECT CASE WHEN count(*) > 50000 THEN 'large' ELSE 'small' END AS route FROM lineitem")
def g18(t):
    return gates.volume_route(t.lineitem, 50_000)


PSI_BINS = """
    q AS (SELECT list_sort(list_distinct(quantile_cont({c}, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]))) AS e FROM base),
    inner_edges AS (SELECT e[2:len(e)-1] AS i, len(e) AS ne FROM q),
    cells AS (SELECT unnest(range(0, len(i) + 1)) AS bin, i FROM inner_edges),
    b AS (SELECT len(list_filter(i, lambda x: x <= {c})) AS bin, count(*) AS n FROM base, inner_edges GROUP BY 1),
    a AS (SELECT len(list_filter(i, lambda x: x <= {c})) AS bin, count(*) AS n FROM today, inner_edges GROUP BY 1),
    p AS (SELECT greatest(COALESCE(b.n, 0) / CAST((SELECT count(*) FROM base) AS DOUBLE), 1e-6) AS e,
                 greatest(COALESCE(a.n, 0) / CAST((SELECT count(*) FROM today) AS DOUBLE), 1e-6) AS a
          FROM cells LEFT JOIN b ON cells.bin = b.bin LEFT JOIN a ON cells.bin = a.bin)"""
BASE = "base AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'), today AS (SELECT l_orderkey, l_quantity * 1.2 AS l_quantity, l_extendedprice, l_returnflag, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND NOT (l_returnflag = 'R' AND l_quantity > 25))"
PSI_SUM = "sum((a - e) * ln(a / e))"


def populations(t):
    base = t.lineitem.where("l_shipdate < TIMESTAMP '1998-01-01'")
    today = t.lineitem.where("l_shipdate >= TIMESTAMP '1998-01-01' AND NOT (l_returnflag = 'R' AND l_quantity > 25)").withColumn(
        "l_quantity", F.col("l_quantity") * 1.2)
    return base, today


def psi_feature(c):
    return f"(WITH {BASE}, {PSI_BINS.format(c=c)} SELECT '{c}' AS feature, {half_up(PSI_SUM, 6)} AS psi FROM p)"


CATEGORICAL = f"""(WITH {BASE}, k AS (SELECT DISTINCT l_returnflag AS f FROM lineitem),
    p AS (SELECT greatest((SELECT count(*) FROM base WHERE l_returnflag = f) / CAST((SELECT count(*) FROM base) AS DOUBLE), 1e-6) AS e,
                 greatest((SELECT count(*) FROM today WHERE l_returnflag = f) / CAST((SELECT count(*) FROM today) AS DOUBLE), 1e-6) AS a FROM k)
    SELECT 'l_returnflag' AS feature, {half_up(PSI_SUM, 6)} AS psi FROM p)"""
ALL_PSI = f"(SELECT * FROM {psi_feature('l_quantity')} UNION ALL SELECT * FROM {psi_feature('l_extendedprice')} UNION ALL SELECT * FROM {CATEGORICAL})"


@query("X1_psi", f"""
    SELECT feature, psi, CASE WHEN psi > 0.25 THEN 'drifted' WHEN psi >= 0.10 THEN 'moderate' ELSE 'none' END AS severity FROM {ALL_PSI}""")
def x1(t):
    base, today = populations(t)
    return drift.psi(base, today, ["l_quantity", "l_extendedprice"], ["l_returnflag"]).select(
        "feature", F.round("psi", 6).alias("psi"), "severity")


@query("G12_drift_gate", f"""
    SELECT {half_up("quantile_cont(psi, 0.9)", 5)} AS overall_psi, {half_up("max(psi)", 5)} AS max_psi, CAST(count(*) AS BIGINT) AS features_compared,
           CAST(count(*) FILTER (WHERE psi > 0.25) AS BIGINT) AS drifted_count, quantile_cont(psi, 0.9) > 0.2 AS retrain FROM {ALL_PSI}""")
def g12(t):
    base, today = populations(t)
    h = drift.headline(drift.psi(base, today, ["l_quantity", "l_extendedprice"], ["l_returnflag"]).withColumn("psi", F.round("psi", 6)))
    return h.select(F.round("overall_psi", 5).alias("overall_psi"), F.round("max_psi", 5).alias("max_psi"),
                    "features_compared", "drifted_count", "retrain")
