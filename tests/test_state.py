"""Merge, versions, branches, erasure: raising cases and published expectations."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeops import schemas
from lakeops.jobs import coldchain
from lakeops.operators import changes, erasure, evolve, gates, setops
from lakeops.operators import joins as J
from lakeops.operators import scans as S
from lakeops.operators import versions as V
from lakeops.session import load_table
from lakeops.streaming import streams

SF = "/root/testdata/sf0.001"
WAP = "order_id bigint, region string, order_amount decimal(10,2)"


def seed_orders(spark, lo, hi, commit):
    k = F.col("id")
    return spark.range(lo, hi).select(
        F.lit(commit).cast("bigint").alias("commit_id"), F.timestamp_seconds(F.lit(1_700_000_000 + commit * 60)).alias("committed_at"),
        F.lit("main").alias("branch"), F.lit("upsert").alias("op"), k.alias("order_id"),
        F.element_at(F.array(F.lit("NA"), F.lit("EMEA"), F.lit("APAC")), (k % 3 + 1).cast("int")).alias("region"),
        F.lit("open").alias("status"), (k * 10).cast("decimal(10,2)").alias("order_amount"),
        F.date_add(F.lit("2026-09-01").cast("date"), (k % 6).cast("int")).alias("order_day"))


@pytest.fixture(scope="module")
def log(spark):
    """240 rows in three appends of 80, then a merge of 12 updates and 8 inserts."""
    appended = seed_orders(spark, 0, 80, 1).union(seed_orders(spark, 80, 160, 2)).union(seed_orders(spark, 160, 240, 3))
    merged = seed_orders(spark, 0, 12, 4).union(seed_orders(spark, 240, 248, 4)).withColumns(
        {"status": F.lit("refunded"), "order_amount": F.lit("999.99").cast("decimal(10,2)")})
    return appended.union(merged).cache()


def test_versions_of_the_seed(log):
    at = lambda v: V.as_of_version(log, ["order_id"], v)
    assert [at(v).count() for v in (1, 2, 3, 4)] == [80, 160, 240, 248]
    assert at(3).select("order_day").distinct().count() == 6
    assert at(4).where("status = 'refunded'").count() == 20 and at(1).where("status = 'refunded'").count() == 0
    assert at(4).groupBy("order_id").count().where("count > 1").count() == 0
    summary = {r.commit_id: r for r in V.commit_summary(log, ["order_id"]).collect()}
    assert (summary[4].added, summary[4].updated, summary[4].deleted, summary[4].live_keys) == (8, 12, 0, 248)


def test_time_travel_is_strictly_older(spark, log):
    times = {r.commit_id: r.t for r in log.select("commit_id", F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss").alias("t")).distinct().collect()}
    assert V.as_of_time(log, ["order_id"], times[2]).count() == 80
    with pytest.raises(V.NoSuchVersion):
        V.as_of_time(log, ["order_id"], times[1])


def test_rollback_leaves_an_abandoned_commit(spark, log):
    commits = spark.createDataFrame([(1, None, 10, "append"), (2, 1, 20, "append"), (3, 2, 30, "merge")],
                                    "commit_id bigint, parent_id bigint, s int, operation string").withColumn(
        "committed_at", F.timestamp_seconds("s")).drop("s")
    rolled = V.with_rollback(commits, 1)
    assert {r.commit_id for r in V.ancestors(rolled, 4).collect()} == {4, 1}
    assert {r.commit_id for r in V.abandoned(rolled, 4).collect()} == {2, 3}
    with pytest.raises(V.NoSuchVersion):
        V.with_rollback(commits, 77)


def test_long_parent_chain(spark):
    chain = spark.range(1, 101).select(F.col("id").alias("commit_id"), F.when(F.col("id") > 1, F.col("id") - 1).alias("parent_id"),
                                       F.timestamp_seconds("id").alias("committed_at"), F.lit("a").alias("operation"))
    assert V.ancestors(chain, 60).count() == 60


def test_expired_version_raises_and_tag_survives(spark, log):
    commits = log.select("commit_id", "committed_at").distinct().withColumns({"parent_id": F.lit(None).cast("bigint"), "operation": F.lit("x")})
    tags = spark.createDataFrame([("close", 1)], "tag string, commit_id bigint")
    points = V.retained_points(commits, "2030-01-01", 2, tags)
    assert points == [1, 3]
    folded = V.expire(log, ["order_id"], points)
    assert V.as_of_version(folded, ["order_id"], V.require_readable(3, points)).count() == 240
    assert V.read_tag(folded, ["order_id"], tags, "close").count() == 80
    assert V.as_of_version(folded, ["order_id"], 4).count() == 248
    with pytest.raises(V.NoSuchVersion):
        V.require_readable(2, points)
    with pytest.raises(V.NoSuchVersion):
        V.read_tag(log, ["order_id"], tags, "missing")


def test_write_audit_publish(spark):
    base = spark.createDataFrame([(1, "NA", Decimal(10)), (2, "EMEA", Decimal(20)), (3, "APAC", Decimal(30))], WAP)
    bad = spark.createDataFrame([(4, "NA", Decimal(40)), (5, None, Decimal(50)), (5, None, Decimal(50)), (6, "EMEA", Decimal(-99))], WAP)
    good = spark.createDataFrame([(4, "NA", Decimal(40)), (5, "APAC", Decimal(50))], WAP)
    entry = lambda df, n, branch: df.withColumns({"commit_id": F.lit(n).cast("bigint"), "committed_at": F.timestamp_seconds(F.lit(n)),
                                                  "branch": F.lit(branch), "op": F.lit("upsert")})
    verdict = gates.audit(bad, "region", "order_amount", ["order_id"]).first()
    assert (verdict.missing_required, verdict.negative_amounts, verdict.duplicate_keys, verdict.passed) == (2, 1, 1, False)
    with pytest.raises(gates.GateFailed):
        gates.enforce(gates.audit(bad, "region", "order_amount", ["order_id"]))
    staged = entry(base, 1, "main").unionByName(entry(bad, 2, "audit"))
    assert V.as_of_version(staged, ["order_id"], 9).count() == 3
    cleared = V.discard(staged, "audit").unionByName(entry(good, 3, "audit2"))
    gates.enforce(gates.audit(good, "region", "order_amount", ["order_id"]))
    assert V.as_of_version(V.publish(cleared, "audit2"), ["order_id"], 9).count() == 5


def test_duplicate_source_aborts_merge(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(changes.DuplicateSourceKeys):
        changes.require_unique(s, ["k"])
    assert changes.require_unique(s.dropDuplicates(["k"]), ["k"]).count() == 1


def test_merge_of_null_keys_and_unknown_deletes(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, seq int")
    s = spark.createDataFrame([(1, "z", 0, False), (2, "y", 2, True), (3, "c", 1, True), (4, "d", 1, False)], "k int, v string, seq int, gone boolean")
    got = changes.merge(t, s, ["k"], newer=("seq", "seq"), deleted="gone")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1), (4, "d", 1)]


def test_delete_key_of_envelope_comes_from_before(spark):
    rows = [("d", 2000, ("l", 7, 1000), '{"transaction_id":"T1"}', None), ("c", 2000, ("l", 8, 1000), None, '{"transaction_id":"T2","amount":"5.5"}')]
    env = spark.createDataFrame(rows, schemas.CDC_ENVELOPE)
    flat = changes.flatten_envelope(env, "transaction_id", {"amount": "decimal(18,2)"})
    assert {(r.transaction_id, r._deleted, r.source_lsn) for r in flat.collect()} == {("T1", True, 7), ("T2", False, 8)}


def test_narrowing_is_refused():
    assert evolve.check_widening("int", "bigint") == "bigint"
    assert evolve.check_widening("decimal(10,2)", "decimal(18,2)") == "decimal(18,2)"
    for old, new in (("decimal(10,2)", "int"), ("bigint", "int"), ("decimal(10,2)", "decimal(10,4)"), ("string", "int")):
        with pytest.raises(evolve.NarrowingRefused):
            evolve.check_widening(old, new)


def test_rename_keeps_values_and_added_is_null(spark):
    written = [evolve.Field(1, "id", "bigint"), evolve.Field(2, "amt", "int")]
    now = evolve.add(evolve.widen(evolve.rename(written, "amt", "amount"), "amount", "bigint"), "note", "string")
    got = evolve.read_as(spark.range(3).withColumn("amt", F.lit(5)), written, now)
    assert got.where("amount = 5 AND note IS NULL").count() == 3
    assert evolve.add(evolve.drop(now, "id"), "x", "int")[-1].id == 4


def test_both_delete_modes_agree(spark, log):
    state = V.as_of_version(log, ["order_id"], 3)
    gone = spark.createDataFrame([(7,)], "order_id bigint")
    a, b = erasure.copy_on_write(state, gone, "order_id"), erasure.merge_on_read(state, gone, ["order_id"])
    same = setops.same_rows(a, b).first()
    assert (same.only_left, same.only_right, same.in_both) == (0, 0, 239)
    debt = erasure.delete_debt(state, gone, ["order_id"]).first()
    assert (debt.delete_entries, debt.hidden_rows, debt.live_rows) == (1, 1, 239)


def test_gates_raise(spark):
    empty = spark.range(0)
    with pytest.raises(gates.GateFailed):
        gates.enforce(gates.not_empty(empty))
    assert gates.enforce(gates.not_empty(spark.range(1)))["passed"]
    with pytest.raises(gates.GateFailed):
        gates.enforce(gates.unique(spark.range(3).select(F.lit(1).alias("k")), ["k"]))
    with pytest.raises(gates.GateFailed):
        gates.enforce(gates.same_totals(spark.range(3), spark.range(4), {"n": F.count("*")}))
    assert gates.enforce(gates.same_totals(spark.range(3), spark.range(3), {"n": F.count("*")}))["passed"]
    assert gates.volume_route(spark.range(10), 9).first().route == "large"
    assert gates.volume_route(spark.range(9), 9).first().route == "small"


def test_salted_join_equals_plain(spark):
    li, su = load_table(spark, SF, "lineitem"), load_table(spark, SF, "supplier")
    a = li.select(F.when(F.col("l_quantity") > 20, 1).otherwise(F.col("l_suppkey")).alias("k"), "l_orderkey", "l_linenumber", "l_shipdate").where("k <> 3")
    b = su.select(F.col("s_suppkey").alias("k"), "s_name").where("k <> 4")
    hot = J.hot_values(a, ["k"], 500)
    assert hot.count() >= 1
    for how in ("inner", "left", "full"):
        same = setops.same_rows(a.join(b, "k", how).select("k", "l_orderkey", "l_linenumber", "l_shipdate", "s_name"),
                                J.salted_join(a, b, ["k"], how, hot, 8).select("k", "l_orderkey", "l_linenumber", "l_shipdate", "s_name")).first()
        assert (same.only_left, same.only_right) == (0, 0), how
    with pytest.raises(ValueError):
        J.salted_join(a, b, ["k"], "right", hot)


def test_tolerance_match_pairs_copies_once(spark):
    schema = "p string, m int, dur double, leg int"
    ours = spark.createDataFrame([("A", 1, 60.0, 1), ("A", 1, 61.0, 2), ("A", 2, 10.0, 3)], schema)
    theirs = spark.createDataFrame([("A", 1, 61.0, 1), ("A", 1, 70.0, 2), ("A", 3, 5.0, 3)], schema)
    for limit in (S.MAX_GROUP_ROWS, 1):
        got = J.tolerance_match(ours, theirs, ["p", "m"], "dur", ["leg"], ["leg"], 2, limit)
        assert sorted(r.match_status for r in got.collect()) == ["DURATION_MISMATCH", "MATCHED", "MISSING_ON_OUR_SIDE", "MISSING_ON_THEIR_SIDE"]


def test_breach_evidence_is_reproducible(spark):
    start = 1_780_000_000
    pings = spark.range(0, 30).select(
        F.lit("S1").alias("shipment_id"), F.timestamp_seconds(F.lit(start) + F.col("id") * 300).alias("ping_ts"),
        F.when(F.col("id").between(8, 20), 12.0).when(F.col("id") == 3, 25.0).otherwise(5.0).alias("cargo_temp_c"),
        F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.lit(90.0).alias("driver_score"), F.col("id").alias("seq"))
    ships = spark.createDataFrame([("S1", "V1", "vaccine", 2.0, 8.0)], "shipment_id string, vehicle_id string, cargo_class string, required_min_c double, required_max_c double")
    hot = S.HotKeys(("shipment_id",))
    clean = coldchain.clean_telemetry(pings, hot, ["seq"])
    assert [r.seq for r in clean.where("is_spike").collect()] == [3]
    found = coldchain.breaches(clean, ships, hot, ["seq"], 1).collect()
    assert len(found) == 1 and found[0].duration_min == 60.0 and found[0].severity == "MEDIUM"
    log = clean.withColumns({"commit_id": F.lit(1).cast("bigint"), "committed_at": F.timestamp_seconds(F.lit(1)), "branch": F.lit("main"), "op": F.lit("upsert")})
    first = coldchain.evidence(log, ["shipment_id", "seq"], found[0].asDict())
    later = log.unionByName(log.withColumns({"commit_id": F.lit(2).cast("bigint"), "cargo_temp_c": F.lit(0.0)}))
    again = coldchain.evidence(later, ["shipment_id", "seq"], found[0].asDict())
    same = setops.same_rows(first, again).first()
    assert same.in_both == 25 and same.only_left == same.only_right == 0


# ------------------------------------------------------------------ streams
@pytest.fixture()
def landed(spark, tmp_path):
    events = load_table(spark, SF, "events")
    events.orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 250).parquet(str(tmp_path / "in"))
    return events, str(tmp_path / "in"), tmp_path


def test_micro_batches_rerun_without_duplicates(spark, landed):
    from lakeops.sinks.writers import overwrite_partitions
    events, path, tmp = landed
    seen = []

    def each(df, batch_id):
        seen.append(batch_id)
        for _ in range(2):          # a retried batch replaces its own partition
            overwrite_partitions(df.withColumn("batch", F.lit(batch_id)), str(tmp / "out"), ["batch"])

    stream = streams.file_stream(spark, path, events.schema, files_per_batch=1)
    streams.run_available(stream, str(tmp / "cp"), each)
    assert len(seen) == 4
    assert spark.read.parquet(str(tmp / "out")).count() == events.count()
    streams.run_available(streams.file_stream(spark, path, events.schema, files_per_batch=1), str(tmp / "cp"), each)
    assert spark.read.parquet(str(tmp / "out")).count() == events.count()


def test_late_rows_are_merged_by_batch(spark, landed):
    events, path, tmp = landed
    keyed = events.withColumn("dt", F.to_date("ts"))
    src = str(tmp / "src")
    keyed.coalesce(1).write.parquet(src)
    corrected = keyed.where("event_type = 'click'").withColumns({"value": F.lit(-1.0), "ts": F.col("ts") + F.expr("INTERVAL 1 SECOND")})
    stale = keyed.where("event_type = 'view'").withColumns({"value": F.lit(-2.0), "ts": F.col("ts") - F.expr("INTERVAL 1 SECOND")})
    corrected.unionByName(stale).coalesce(1).write.mode("append").parquet(src)
    each = streams.upsert_each(str(tmp / "state"), ["event_id"], "dt", ["ts"], ("ts", "ts"))
    for checkpoint in ("c1", "c2"):          # the second run replays every batch
        streams.run_available(streams.file_stream(spark, src, keyed.schema, files_per_batch=1), str(tmp / checkpoint), each)
        got = spark.read.parquet(str(tmp / "state"))
        assert got.count() == events.count() and got.where("value = -2.0").count() == 0
        assert got.where("value = -1.0").count() == events.where("event_type = 'click'").count()


def run(spark, df, tmp, name, mode="complete"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_stream_windows_equal_batch(spark, landed):
    events, path, tmp = landed
    stream = lambda: streams.file_stream(spark, path, events.schema)
    got = run(spark, streams.tumbling(stream(), "ts", "15 minutes", "1 hour", ["event_type"], {"n": F.count("*")}), tmp, "tumble")
    want = events.groupBy(F.window("ts", "15 minutes"), "event_type").count()
    assert got.count() == want.count() and got.agg(F.sum("n")).first()[0] == events.count()
    rolled = run(spark, streams.rolling(stream(), "ts", "15 minutes", "5 minutes", "1 hour", [], {"n": F.count("*")}), tmp, "roll")
    assert rolled.agg(F.sum("n")).first()[0] == 3 * events.count()
    sessions = run(spark, streams.sessions(stream(), "ts", "30 minutes", "1 hour", ["user_id"], {"n": F.count("*")}), tmp, "sess")
    assert sessions.count() == events.groupBy("user_id", F.session_window("ts", "30 minutes")).count().count()


def test_stream_dedup_within_lateness(spark, landed):
    events, path, tmp = landed
    twice = str(tmp / "twice")
    events.coalesce(1).write.parquet(twice)
    events.coalesce(1).write.mode("append").parquet(twice)
    got = run(spark, streams.dedup_late(streams.file_stream(spark, twice, events.schema), "ts", "6 hours", ["event_id"]), tmp, "dedup", "append")
    assert got.count() == events.count()
