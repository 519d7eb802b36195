"""One answer at every size: the paths for small and for large inputs on awkward rows; merges that move and empty."""
import os
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import joins as J
from lakeops.operators import layout
from lakeops.operators import scans as S
from lakeops.operators import windows as W
from lakeops.plans import inspect
from lakeops.session import load_table
from lakeops.sinks import writers as K


def rows(df):
    return sorted(map(str, df.collect()))


def readings(spark):
    rng = random.Random(8)
    out = [(1, i, None if rng.random() < 0.1 else 1_700_000_000 + rng.randint(0, 4_000), None if rng.random() < 0.3 else rng.choice([0.1, 0.2, 1e17])) for i in range(300)]
    out += [(2, 1000, 1_700_000_000, None), (2, 1001, None, 3.0), (2, 1001, None, 3.0), (None, 1002, 1_700_000_100, 2.0)]
    return spark.createDataFrame(out, "k int, id int, s long, v double").withColumn("ts", F.timestamp_seconds("s"))


def test_overlapping_intervals_give_the_same_rows_beyond_the_limit(spark):
    day = 86_400
    intervals = spark.createDataFrame([(1, 0, 100 * day, "a"), (1, 10 * day, 20 * day, "b"), (1, 90 * day, None, "c"), (None, 0, 5, "n")],
                                      "k int, a long, b long, name string").select("k", *[F.timestamp_seconds(c).alias(c) for c in "ab"], "name")
    facts = spark.createDataFrame([(1, 15 * day), (1, 25 * day), (1, 10 * day), (1, 20 * day), (1, 95 * day), (None, 3), (2, 3), (1, None)],
                                  "k int, t long").select("k", F.timestamp_seconds("t").alias("t"))
    got = [rows(J.interval_join(facts, intervals, ["k"], "t", "a", "b", ["name"], S.HotKeys(("k",)), method=m, max_bytes=n))
           for m, n in (("broadcast", J.BROADCAST_BYTES), ("broadcast", 1), ("grid", 1))]
    assert len(got[0]) == 8 and got[0] == got[1] == got[2]


def test_rolling_sum_is_the_same_on_cut_keys(spark):
    df = readings(spark)
    plain = W.rolling_sum(df, ["k"], "ts", "v", 300, ["id"], S.HotKeys(("k",)), "sum")
    hot = S.find_hot(df, ["k"], F.unix_micros("ts"), 40)
    assert hot
    cut = W.rolling_sum(df, ["k"], "ts", "v", 300, ["id"], hot, "sum")
    short = lambda d: sorted((r["k"] or 0, r["id"], str(r["ts"]), r["v"] is None, r["sum"] is None) for r in d.collect())
    assert short(plain) == short(cut)
    exact = lambda d: sorted((r["id"], round(r["sum"], 6)) for r in d.collect() if r["sum"] is not None and r["sum"] < 1e10)
    assert exact(plain) == exact(cut)


def test_descending_orders_put_nulls_last_on_cut_keys(spark):
    df = spark.createDataFrame([(1, i, None if i % 4 == 0 else float(i % 17)) for i in range(60)], "k int, id int, p double")
    order, pos = [F.col("p").desc(), F.col("id")], -F.col("p")
    hot = S.find_hot(df, ["k"], pos, 10)
    assert hot
    w = Window.partitionBy("k").orderBy(*order)
    assert rows(W.bands(df, ["k"], order, pos, 10, hot, "t")) == rows(df.withColumn("t", F.ntile(10).over(w)))
    ranks = S.scan(df, ["k"], [F.col("p").desc()], [S.rank("r"), S.dense_rank("d")], hot, pos)
    by_p = Window.partitionBy("k").orderBy(F.col("p").desc())
    assert rows(ranks) == rows(df.withColumns({"r": F.rank().over(by_p).cast("bigint"), "d": F.dense_rank().over(by_p).cast("bigint")}))


def table(spark, path, data):
    df = spark.createDataFrame(data, "id int, v int, gone boolean, dt string")
    K.overwrite(df, path, ["dt"])
    return df


def state(spark, path):
    return sorted((r["id"], r["v"], str(r["dt"])) for r in spark.read.schema("id int, v int, gone boolean, dt string").parquet(path).collect())


def test_merge_keeps_the_rows_of_a_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [(1, 1, False, "a"), (3, 3, False, None), (4, 4, False, None)])
    batch = spark.createDataFrame([(5, 5, False, None), (3, 30, False, None)], "id int, v int, gone boolean, dt string")
    K.merge_into(path, batch, ["id"], "dt")
    assert state(spark, path) == [(1, 1, "a"), (3, 30, "None"), (4, 4, "None"), (5, 5, "None")]


def test_merge_removes_an_emptied_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [(1, 1, False, "a b/c"), (2, 2, False, "b"), (3, 3, False, None)])
    batch = spark.createDataFrame([(1, 1, True, "a b/c"), (3, 3, True, None)], "id int, v int, gone boolean, dt string")
    K.merge_into(path, batch, ["id"], "dt", deleted="gone")
    assert state(spark, path) == [(2, 2, "b")] and len([d for d in os.listdir(path) if d.startswith("dt=")]) == 1


def test_merge_moves_a_key_to_its_new_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [(1, 1, False, "a"), (2, 2, False, "a"), (3, 3, False, "b")])
    batch = spark.createDataFrame([(1, 10, False, "b"), (3, 30, False, "c")], "id int, v int, gone boolean, dt string")
    K.merge_into(path, batch, ["id"], "dt")
    assert state(spark, path) == [(1, 10, "b"), (2, 2, "a"), (3, 30, "c")]


def test_compaction_keeps_partition_folders(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(400).select("id", (F.col("id") % 4).cast("string").alias("dt"), F.concat(F.lit("customer-"), F.lpad(F.col("id") % 100, 3, "0"), F.lit("ü")).alias("name"))
    K.overwrite(df.repartition(6), path, ["dt"])
    for strategy in ("binpack", "sort", "zorder"):
        out = str(tmp_path / strategy)
        done = layout.compact(spark, path, out, strategy=strategy, columns=["name", "id"])
        assert done["rewritten"] and done["files_after"] < done["files_before"]
        assert sorted(d for d in os.listdir(out) if d.startswith("dt=")) == [f"dt={i}" for i in range(4)]
        assert spark.read.parquet(out).select("id", "name").exceptAll(df.select("id", "name")).count() == 0 and spark.read.parquet(out).count() == 400


def test_small_folders_are_not_sorted_in_one_task(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(4_000).select("id", (F.col("id") % 40).alias("v"), (F.col("id") % 8).alias("dt"))
    K.overwrite(df, path, ["dt"])
    for strategy in ("sort", "zorder"):
        out = str(tmp_path / strategy)
        layout.compact(spark, path, out, strategy=strategy, columns=["v", "id"], rewrite_all=True)
        wrote = F.regexp_extract("_metadata.file_path", r"part-(\d+)", 1)
        tasks = spark.read.parquet(out).groupBy(wrote).count()
        assert tasks.count() >= 4 and tasks.agg(F.max("count")).first()[0] <= 2_000
        assert spark.read.parquet(out).select(*df.columns).exceptAll(df).count() == 0 and spark.read.parquet(out).count() == 4_000


def brute_grid(rows, ranges, step, most):
    """The grid of ``resample`` slot by slot: rows (key, id, seconds, value), ranges (key, lo, hi) or None."""
    out = {}
    rows = [r for r in rows if r[2] is not None and r[3] is not None]
    if ranges is None:
        ranges = [(k, min(r[2] for r in rows if r[0] == k), max(r[2] for r in rows if r[0] == k)) for k in {r[0] for r in rows}]
    for k, lo, hi in ranges:
        if lo is None or hi is None:
            continue
        for n in range(min(lo, hi) // step, max(lo, hi) // step + 1):
            here = [r[3] for r in rows if r[0] == k and r[2] // step == n]
            before = [r for r in rows if r[0] == k and r[2] // step < n]
            at = max((r[2] for r in before), default=None)
            if here:
                out[k, n * step] = (len(here), min(here), max(here), round(sum(here) / len(here), 9), "observed")
            elif at is not None and n * step - at <= most:
                out[k, n * step] = (0, None, None, [r[3] for r in before if r[2] == at][0], "carried")
            else:
                out[k, n * step] = (0, None, None, None, "gap")
    return out


def test_resampled_grid_is_made_after_the_window(spark):
    rng = random.Random(5)
    rows = [(k, i, 1_000_000 + t, rng.randrange(9)) for k in (1, 2, None) for i, t in enumerate(sorted(rng.sample(range(40_000), 12)))]
    rows += [(3, 0, 1_000_000, 5), (1, 99, None, 5), (2, 98, 1_000_005, None)]
    ranges = [(1, 1_010_000, 1_030_000), (2, 990_000, 1_005_000), (2, 1_004_000, 1_009_000), (2, 1_035_000, 1_020_000), (None, 1_000_000, 1_050_000),
              (4, 1_000_000, 1_003_000), (5, None, 1_000_000)]
    df = spark.createDataFrame([(k, i, s, None if v is None else float(v)) for k, i, s, v in rows], "k int, id int, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    bounds = spark.createDataFrame(ranges, "k int, a long, b long").select("k", F.timestamp_seconds("a").alias("lo"), F.timestamp_seconds("b").alias("hi"))
    for given, table in ((None, None), (ranges, bounds)):
        got = W.resample(df, ["k"], "ts", "v", 1_000, 4_000, table)
        found = got.select("k", F.unix_seconds("slot"), "observations", "low", "high", F.round("value", 9), "source").collect()
        assert len(found) == len({tuple(r)[:2] for r in found})
        assert {tuple(r)[:2]: tuple(r)[2:] for r in found} == brute_grid(rows, given, 1_000, 4_000)
        # the tree stands upside down: what is made last comes first, and nothing sorts or gathers the slots
        text = inspect.plan_text(got, "simple")
        assert text.index("Generate") < min(text.index(x) for x in ("Window", "Sort", "Aggregate", "Exchange"))


def test_zorder_tells_strings_with_a_shared_start_apart(spark):
    df = spark.createDataFrame([(f"customer-名-{i:03d}",) for i in range(100)], "name string")
    spread = layout.zorder(df, ["name"], 4).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.min("name").alias("lo"), F.max("name").alias("hi")).orderBy("lo").collect()
    assert len(spread) >= 3 and all(a["hi"] < b["lo"] for a, b in zip(spread, spread[1:]))


def test_salted_join_spreads_null_keys(spark):
    left = spark.createDataFrame([(None, i) for i in range(50)] + [(1, i) for i in range(50)] + [(2, 1)], "k int, a int")
    right = spark.createDataFrame([(1, 7), (3, 8), (None, 9)], "k int, b int")
    hot = J.hot_values(left, ["k"], 20)
    for how in ("inner", "left", "full"):
        assert rows(J.salted_join(left, right, ["k"], how, hot).select("k", "a", "b")) == rows(left.join(right, "k", how).select("k", "a", "b"))


def test_silent_runs_are_those_of_the_slot_grid(spark):
    rng = random.Random(3)
    at = {(k, s): rng.random() < 0.7 for k in range(6) for s in rng.sample(range(60), 25)}
    at.update({(6, 5): False, (6, 9): False, (7, 4): True, (None, 2): True, (None, 7): True})
    df = spark.createDataFrame([(k, 1800 * s, here) for (k, s), here in at.items()], "k int, s long, here boolean").withColumn("slot", F.timestamp_seconds("s"))
    want = []
    for k in {k for k, _ in at}:
        mine = [s for j, s in at if j == k]
        silent = [s for s in range(min(mine), max(mine) + 1) if not at.get((k, s), False)]
        starts = [s for s in silent if s - 1 not in silent]
        runs = [(s, next(e for e in range(s, 99) if e + 1 not in silent)) for s in starts]
        want += [(k, 1800 * a, 1800 * b, b - a + 1) for a, b in runs if b - a >= 1]
    got = W.missing_runs(df, ["k"], "slot", 1800, 2, F.col("here")).select("k", F.unix_seconds("run_start"), F.unix_seconds("run_end"), "slots")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_a_stray_early_reading_costs_no_slots(spark):
    df = spark.createDataFrame([(1, 0), (1, 1_700_000_000 // 1800 * 1800)], "k int, s long").withColumn("slot", F.timestamp_seconds("s"))
    runs = W.missing_runs(df, ["k"], "slot", 1800)
    assert [r["slots"] for r in runs.collect()] == [1_700_000_000 // 1800 - 1]
    assert "Generate" not in inspect.plan_text(runs, "simple")


def test_size_checks_run_no_job(spark):
    orders = load_table(spark, "/root/testdata/sf0.01", "orders")
    tracker, group = spark.sparkContext.statusTracker(), "size-check"
    derived = orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
    spark.sparkContext.setJobGroup(group, group)
    try:
        sizes = [J.is_small(df, n) for df in (orders, derived) for n in (1, J.BROADCAST_BYTES)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sizes == [False, True, False, True] and not tracker.getJobIdsForGroup(group)
