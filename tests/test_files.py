"""Sources, sinks and layout jobs against real files."""
import glob
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from lakeops import schemas
from lakeops.jobs.cdr import for_write
from lakeops.operators import erasure, gates, layout, setops
from lakeops.operators import joins as J
from lakeops.plans import inspect
from lakeops.session import Tables, load_table
from lakeops.sinks import writers as K
from lakeops.sources import dialects, readers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return load_table(spark, SF, "events").withColumn("dt", F.to_date("ts"))


@pytest.fixture(scope="module")
def lineitem(spark):
    return load_table(spark, SF, "lineitem")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def data_files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


# ------------------------------------------------------------------ sources
def test_declared_json_keeps_malformed(spark, tmp_path):
    p = tmp_path / "cdc"
    p.mkdir()
    good = {"op": "u", "ts_ms": 1, "source": {"table": "t", "lsn": 5, "ts_ms": 1}, "before": None, "after": "{}"}
    (p / "a.json").write_text(json.dumps(good) + "\n{broken\n")
    got = readers.read_json_keep_malformed(spark, str(p), schemas.CDC_ENVELOPE).cache()
    assert got.count() == 2 and [r._corrupt for r in got.where("op IS NULL").collect()] == ["{broken"]


def test_positional_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("7,0.25\n8,oops\n")
    got = readers.read_csv_positional(spark, str(tmp_path / "s.csv"), schemas.SCORES, {"churn_probability": "double"})
    assert rows(got) == [("7", 0.25), ("8", None)]


def test_range_read_prunes_folders(spark, events, tmp_path):
    path = str(tmp_path / "e")
    K.overwrite(events, path, ["dt"])
    got = readers.read_range(spark, path, "2024-01-03 12:00:00", "2024-01-05 00:00:00", "dt", "ts")
    want = events.where("ts >= '2024-01-03 12:00:00' AND ts < '2024-01-05 00:00:00'")
    assert got.count() == want.count() > 0
    text = inspect.plan_text(got)
    assert "PartitionFilters: [isnotnull(dt" in text and "GreaterThanOrEqual(ts" in text


def test_layers_and_required_inputs(spark, events, tmp_path):
    K.overwrite(events, str(tmp_path / "silver" / "events"))
    assert readers.read_layer(spark, str(tmp_path), "silver", "events").count() == events.count()
    with pytest.raises(readers.MissingInput, match="usage"):
        readers.read_required(spark, str(tmp_path / "nowhere"), "usage")


def test_hive_style_wildcard_and_drift(spark, tmp_path):
    base = str(tmp_path / "b")
    spark.range(4).select("id", F.lit("x").alias("block"), (F.col("id") % 2).alias("hh")).write.partitionBy("block", "hh").parquet(base)
    got = readers.read_hive_style(spark, base, "block=*/hh=1")
    assert got.columns == ["id", "block", "hh"] and got.count() == 2
    two = str(tmp_path / "d")
    spark.range(2).write.parquet(two)
    spark.range(2).withColumn("extra", F.lit(1)).write.mode("append").parquet(two)
    assert readers.read_drifting(spark, two).where("extra IS NULL").count() == 2


def test_partner_dialects_give_one_schema(spark, tmp_path):
    at = "2026-09-03 10:15:00"
    spark.createDataFrame([("49111", "44222", at, 75, 2, "12.50000")], "callingNumber string, calledNumber string, "
                          "callEventStartTimeStamp string, totalCallEventDuration int, chargedUnits int, chargeAmount string").write.parquet(str(tmp_path / "tap"))
    (tmp_path / "v1.csv").write_text("49111,44222,03092026,101500,75,2,12.5\n")
    (tmp_path / "v2.csv").write_text("calling_msisdn,called_msisdn,start_time,duration_minutes,billed_units,net_amount\n"
                                     f"49111,44222,{at},1.25,2,12.5\n")
    fixed = "49111".ljust(15) + "44222".ljust(15) + "20260903101500" + "75".zfill(8) + "2".zfill(8) + str(1_250_000).zfill(15)
    (tmp_path / "fw.txt").write_text(fixed + "\n")
    paths = {"tap3": "tap", "csv_v1": "v1.csv", "csv_v2": "v2.csv", "fixed_width": "fw.txt"}
    got = {d: rows(dialects.read_partner(spark, str(tmp_path / p), d)) for d, p in paths.items()}
    assert len({str(v) for v in got.values()}) == 1, got
    assert set(dialects.DIALECTS) == set(paths)
    with pytest.raises(ValueError, match="unknown dialect"):
        dialects.read_partner(spark, str(tmp_path), "edifact")


def test_fixed_width_amount_beyond_thirteen_digits(spark, tmp_path):
    line = "1".ljust(15) + "2".ljust(15) + "20260903101500" + "1".zfill(8) + "1".zfill(8) + "999999999999999"
    (tmp_path / "fw.txt").write_text(line)
    assert str(dialects.read_partner(spark, str(tmp_path / "fw.txt"), "fixed_width").first().charge_amount) == "9999999999.99999"


def test_bad_partner_file_is_refused(spark, tmp_path):
    (tmp_path / "v1.csv").write_text("1,2,03092026,101500,75,2,12.5\n1,2,garbage,101500,75,2,12.5\n")
    with pytest.raises(gates.GateFailed):
        dialects.ingest_partner(spark, str(tmp_path / "v1.csv"), "csv_v1", "DTAG", "EUR", "2026-09-03")
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(gates.GateFailed):
        dialects.ingest_partner(spark, str(tmp_path / "empty.csv"), "csv_v1", "DTAG", "EUR", "2026-09-03")


def test_partner_ingest_replaces_its_own_slice(spark, tmp_path):
    (tmp_path / "v1.csv").write_text("1,2,03092026,101500,75,2,12.5\n3,4,03092026,101600,5,1,0.5\n")
    legs = dialects.ingest_partner(spark, str(tmp_path / "v1.csv"), "csv_v1", "DTAG", "EUR", "2026-09-03")
    keys = ["settlement_date", "partner_code"]
    for _ in range(2):
        K.overwrite_partitions(legs, str(tmp_path / "out"), keys)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 2 and {r.currency for r in got.collect()} == {"EUR"}


def test_partner_load_refuses_without_a_trace_and_leaves_the_others(spark, tmp_path):
    out = str(tmp_path / "legs")
    load = lambda name, text, partner: ((tmp_path / name).write_text(text), dialects.load_partner(
        spark, str(tmp_path / name), "csv_v1", partner, "EUR", "2026-09-03", out))
    good = "1,2,03092026,101500,75,2,12.5\n3,4,03092026,101600,5,1,0.5\n"
    load("a.csv", good, "A")
    load("b.csv", good, "B/ 1")
    held = rows(spark.read.parquet(out))
    for _ in range(2):
        load("a.csv", good, "A")
        assert rows(spark.read.parquet(out)) == held
    for bad in (good + "1,2,garbage,101500,75,2,12.5\n", good + "1,2,03092026,101500,75,2,x\n", ""):
        with pytest.raises(gates.GateFailed):
            load("bad.csv", bad, "A")
        assert rows(spark.read.parquet(out)) == held
    load("a.csv", "7,8,03092026,101500,75,2,1\n", "A")
    legs = spark.read.parquet(out)
    assert rows(legs.select("partner_code", "a_number", "settlement_date").where("partner_code = 'A'").selectExpr(
        "a_number", "CAST(settlement_date AS STRING)")) == [("7", "2026-09-03")]
    assert legs.where("partner_code = 'B/ 1'").count() == 2
    assert not glob.glob(f"{out}/.staged-*")
    same = dialects.ingest_partner(spark, str(tmp_path / "a.csv"), "csv_v1", "A", "EUR", "2026-09-03")
    assert rows(legs.where("partner_code = 'A'").select(same.columns)) == rows(same)


def test_partner_ingest_parses_a_delivery_once(spark, monkeypatch):
    from lakeops.queries import stored
    parsed = spark.sparkContext.accumulator(0)

    def counted(at):
        parsed.add(1)
        return at

    read = dialects.read_partner
    monkeypatch.setattr(dialects, "read_partner", lambda *args: read(*args).withColumn(
        "event_ts", F.udf(counted, "timestamp")("event_ts")))
    got = stored.e13(Tables(spark, SF)).collect()
    lines = load_table(spark, SF, "lineitem").count()
    assert [r.legs for r in got] == [lines] * 4
    assert parsed.value == 4 * 2 * lines        # four partners, each file delivered twice


def test_partner_ingest_holds_little_beside_its_slices(spark, monkeypatch, tmp_path):
    from lakeops.queries import stored
    n, load, lock, running, seen = 20_000, dialects.load_partner, threading.Lock(), [], []
    spark.range(n).selectExpr(
        "id AS l_orderkey", "id * 7919 % 20000 AS l_partkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber", "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity",
        "CAST(id * 104729 % 10000000 AS DOUBLE) / 100 AS l_extendedprice",
        "TIMESTAMP '1995-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 2500 AS INT)) AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    size = lambda path: sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*"))

    def watched(session, path, dialect, *rest):
        local = path.removeprefix("file:")
        with lock:
            running.append(path)
            seen.append((dialect, local, size(local), len(running)))
        load(session, path, dialect, *rest)
        with lock:
            running.remove(path)

    monkeypatch.setattr(dialects, "load_partner", watched)
    got = stored.e13(Tables(spark, str(tmp_path))).collect()
    assert [r.legs for r in got] == [n] * 4 and len({r.charge for r in got}) == 1
    assert len(seen) == 8 and max(s[3] for s in seen) <= 2
    for dialect, path, held, _ in seen:
        assert 0 < held < 35 * n                            # as plain text a leg takes 45 to 76 bytes
        assert os.path.exists(path) == (dialect == "tap3")  # loaded twice, the text is gone


# ------------------------------------------------------------------ sinks
def test_partition_overwrite_is_idempotent_and_local(spark, events, tmp_path):
    path = str(tmp_path / "p")
    K.overwrite_partitions(events, path, ["dt"])
    before = set(data_files(path))
    day = events.where("dt = '2024-01-02'")
    for _ in range(2):
        K.overwrite_partitions(day, path, ["dt"])
    assert rows(spark.read.parquet(path).groupBy("dt").count()) == rows(events.groupBy("dt").count())
    assert {f for f in before if "2024-01-02" not in f} <= set(data_files(path))


def test_partner_slice_leaves_the_others(spark, tmp_path):
    path, keys = str(tmp_path / "legs"), ["settlement_date", "partner_code"]
    legs = spark.createDataFrame([("2026-09-03", "A", 1), ("2026-09-03", "B", 2)], "settlement_date string, partner_code string, n int")
    K.overwrite_partitions(legs, path, keys)
    K.overwrite_partitions(legs.where("partner_code = 'A'").withColumn("n", F.lit(9)), path, keys)
    assert {(r.partner_code, r.n) for r in spark.read.parquet(path).collect()} == {("A", 9), ("B", 2)}


def test_merge_rewrites_touched_partitions_only(spark, events, tmp_path):
    from lakeops.operators import changes
    path = str(tmp_path / "m")
    table = events.select("event_id", "ts", "value", "dt")
    K.overwrite(table, path, ["dt"])
    before = set(data_files(path))
    batch = table.where("dt IN ('2024-01-02', '2024-01-05')").withColumns(
        {"value": F.lit(-1.0), "ts": F.col("ts") + F.expr("INTERVAL 1 SECOND")}).unionByName(
        table.where("dt = '2024-01-02'").limit(2).withColumn("event_id", F.col("event_id") + 1_000_000))
    want = rows(changes.merge(table, batch, ["event_id", "dt"], newer=("ts", "ts")))
    assert len(K.merge_into(path, batch, ["event_id"], "dt", newer=("ts", "ts"))) == 2
    assert rows(spark.read.parquet(path).select(*table.columns)) == want
    kept = {f for f in before if "2024-01-02" not in f and "2024-01-05" not in f}
    assert kept <= set(data_files(path))
    assert K.merge_into(path, batch.limit(0), ["event_id"], "dt") == []


def test_tables_ctas_and_partitioned(spark, events):
    for name in ("t_replace", "t_ctas", "t_parts"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    day = events.select("event_id", "user_id", "dt")
    K.replace_table(day, "t_replace")
    K.replace_table(day.limit(3), "t_replace")
    assert spark.table("t_replace").count() == 3
    K.create_table_as(day, "t_ctas", ["dt"])
    assert spark.table("t_ctas").count() == day.count()
    K.create_or_overwrite_partitions(day, "t_parts", ["dt"])
    K.create_or_overwrite_partitions(day.where("dt = '2024-01-02'").limit(2), "t_parts", ["dt"])
    assert spark.table("t_parts").where("dt = '2024-01-02'").count() == 2
    assert spark.table("t_parts").where("dt <> '2024-01-02'").count() == day.where("dt <> '2024-01-02'").count()
    layout.drop_partitions(spark, "t_parts", {"dt": "2024-01-03"})
    assert spark.table("t_parts").where("dt = '2024-01-03'").count() == 0
    for name in ("t_replace", "t_ctas", "t_parts"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_csv_json_and_splits(spark, events, tmp_path):
    small = events.groupBy("event_type").count()
    K.single_csv(small, str(tmp_path / "c"))
    assert len(glob.glob(str(tmp_path / "c" / "*.csv"))) == 1
    K.json_report(small.agg(F.sum("count").alias("n")), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().n == events.count()
    wide = spark.createDataFrame([(1, 5, None, "a")], "label int, x int, y double, k string")
    K.ml_split(wide, str(tmp_path / "m"), ["x", "y"], label="label")
    assert spark.read.text(str(tmp_path / "m")).first().value == "1,5.0,0.0"


def test_write_distribution(spark, events, tmp_path):
    scattered, grouped = str(tmp_path / "s"), str(tmp_path / "g")
    spread = events.repartition(6, "event_id")
    K.overwrite(spread, scattered, ["dt"])
    K.overwrite(K.by_partition_keys(spread, ["dt"], ["user_id"]), grouped, ["dt"])
    assert len(data_files(grouped)) == events.select("dt").distinct().count() < len(data_files(scattered))
    from lakeops.functions.scalar import bucket_of
    placed = events.select(bucket_of(["user_id"], 4).alias("b"), "user_id").distinct()
    assert placed.groupBy("user_id").count().where("count > 1").count() == 0 and placed.where("b NOT BETWEEN 0 AND 3").count() == 0
    salted = K.by_partition_keys(spread, ["dt"], salt_buckets=4, salt_on=["event_id"])
    assert rows(salted) == rows(events)
    assert "rand(" not in inspect.plan_text(salted, "simple")
    hourly = events.withColumnsRenamed({"dt": "event_date"}).withColumns({"event_hour": F.hour("ts"), "cdr_id": F.col("event_id")})
    assert for_write(hourly).count() == events.count()


def test_bucketed_join_has_no_shuffle(spark, lineitem):
    orders = load_table(spark, SF, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    for name in ("b_items", "b_orders", "b_orders4"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    K.bucketed_table(lineitem, "b_items", "l_orderkey", 8)
    K.bucketed_table(orders, "b_orders", "l_orderkey", 8)
    K.bucketed_table(orders, "b_orders4", "l_orderkey", 4)
    with inspect.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        same = spark.table("b_items").join(spark.table("b_orders"), "l_orderkey")
        assert inspect.join_strategies(same) == ["SortMergeJoin"] and inspect.count_shuffles(same) == 0
        other = spark.table("b_items").join(spark.table("b_orders4"), "l_orderkey")
        assert inspect.count_shuffles(other) == 1
        with inspect.setting(spark, "spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true"):
            assert inspect.count_shuffles(spark.table("b_items").join(spark.table("b_orders4"), "l_orderkey")) == 0
    for name in ("b_items", "b_orders", "b_orders4"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# ------------------------------------------------------------------ layout
@pytest.fixture(scope="module")
def many_files(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("many") / "e")
    K.overwrite(events.drop("dt").repartition(18, "event_id"), path)
    K.append(events.drop("dt").limit(0), path)
    return path


def test_file_stats_and_pruning(spark, events, many_files, tmp_path):
    stats = layout.file_stats(spark.read.parquet(many_files), ["ts", "user_id"])
    assert stats.agg(F.sum("records")).first()[0] == events.count() and stats.count() == 18
    day = {"ts": ("2024-01-02 00:00:00", "2024-01-02 23:59:59")}
    scattered = layout.pruning_estimate(stats, day).first()
    sorted_path = str(tmp_path / "sorted")
    done = layout.compact(spark, many_files, sorted_path, target_bytes=3_000, strategy="sort", columns=["ts"])
    assert done["rewritten"]
    clustered = layout.pruning_estimate(layout.file_stats(spark.read.parquet(sorted_path), ["ts"]), day).first()
    assert scattered.files_matching >= 16 and clustered.files_matching * 3 < clustered.files_total
    diagnosis = layout.partition_diagnosis(stats.withColumn("p", F.lit(1)), ["p"], max_files=10).first()
    assert diagnosis.files == 18 and diagnosis.needs_compaction and diagnosis.small_files == 18


def test_compaction_keeps_rows(spark, events, many_files, tmp_path):
    before = spark.read.parquet(many_files)
    for strategy, columns in (("binpack", []), ("sort", ["user_id", "ts"]), ("zorder", ["user_id", "ts"])):
        out = str(tmp_path / strategy)
        got = layout.compact(spark, many_files, out, strategy=strategy, columns=columns)
        assert got["files_before"] >= 18 and got["files_after"] == 1
        same = setops.same_rows(before, spark.read.parquet(out)).first()
        assert (same.only_left, same.only_right, same.in_both) == (0, 0, events.count())
    again = layout.compact(spark, str(tmp_path / "binpack"), str(tmp_path / "x"))
    assert not again["rewritten"]


def test_layout_comparison(spark, many_files, tmp_path):
    paths = {"scattered": many_files}
    for strategy in ("sort", "zorder"):
        paths[strategy] = str(tmp_path / strategy)
        layout.compact(spark, many_files, paths[strategy], target_bytes=2_500, strategy=strategy, columns=["user_id", "ts"])
    shapes = {"user": {"user_id": (3, 3)}, "day": {"ts": ("2024-01-09 00:00:00", "2024-01-09 23:00:00")}}
    got = {r.layout: r for r in layout.compare_layouts(spark, paths, shapes).collect()}
    assert got["sort"].touched_user < got["scattered"].touched_user
    assert got["zorder"].touched_user < got["zorder"].files and got["zorder"].touched_day < got["zorder"].files


def test_degradation_after_more_batches(spark, events, tmp_path):
    path = str(tmp_path / "d")
    K.overwrite(events.coalesce(1), path)
    counts = []
    for day in range(1, 4):
        K.append(events.where(F.dayofmonth("ts") == day).repartition(2), path)
        counts.append(layout.file_stats(spark.read.parquet(path)).count())
    assert counts == [3, 5, 7]


def test_unreferenced_files(spark, many_files):
    listing = layout.listed_files(spark, many_files)
    stats = layout.file_stats(spark.read.parquet(many_files))
    later = F.current_timestamp() + F.expr("INTERVAL 10 DAYS")
    assert layout.unreferenced_files(listing, stats.select("file_path"), later).count() == listing.count() - 18
    assert layout.unreferenced_files(listing, stats.limit(10).select("file_path"), later).count() >= 8
    assert layout.unreferenced_files(listing, stats.limit(10).select("file_path"), F.current_timestamp()).count() == 0
    with pytest.raises(layout.UnsafeInterval):
        layout.unreferenced_files(listing, stats, later, older_than_hours=1)


def test_per_table_failures_are_collected(spark):
    def act(t):
        if t == "bad":
            raise ValueError("broken table")
        return "fine"
    got = layout.for_each_table(spark, ["a", "bad", "c"], act)
    assert {r.table_name: r.done for r in got.collect()} == {"a": True, "bad": False, "c": True}
    with pytest.raises(RuntimeError, match="1 tables failed"):
        layout.require_all_done(got)


def test_position_deletes_and_compaction_of_deletes(spark, many_files, tmp_path):
    files = spark.read.parquet(many_files)
    marks = erasure.position_deletes(files, F.col("event_type") == "error")
    live = erasure.without_positions(files, marks)
    assert live.count() == files.where("event_type <> 'error'").count()
    out = str(tmp_path / "folded")
    K.overwrite(live, out)
    assert spark.read.parquet(out).where("event_type = 'error'").count() == 0


def test_broadcast_is_checked(spark, lineitem):
    supplier = load_table(spark, SF, "supplier")
    with inspect.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        join = lambda side: lineitem.join(side, F.col("l_suppkey") == F.col("s_suppkey"))
        assert inspect.join_strategies(join(J.broadcast_if_small(supplier))) == ["BroadcastHashJoin"]
        assert inspect.join_strategies(join(J.broadcast_if_small(supplier, max_bytes=3))) == ["SortMergeJoin"]
