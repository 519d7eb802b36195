"""Cut keys must give exactly what the plain window gives."""
import pytest
from pyspark.sql import functions as F

from lakeops.operators import scans as S
from lakeops.session import load_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    # one user holds a third of all rows
    df = load_table(spark, SF, "events")
    return df.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1)
                         .otherwise(F.col("user_id"))).withColumn(
        "amount", F.when(F.col("event_type") != "error", F.col("value").cast("decimal(18,2)"))).cache()


def both(events, specs, order, pos, max_rows=40):
    plain = S.scan(events, ["user_id"], order, specs, S.HotKeys(("user_id",)), pos)
    hot = S.find_hot(events, ["user_id"], pos, max_rows)
    assert hot, "fixture must hold a hot key"
    cut = S.scan(events, ["user_id"], order, specs, hot, pos)
    names = [s.name for s in specs]
    key = lambda df: sorted(map(tuple, df.select("event_id", *names).collect()))
    return key(plain), key(cut)


@pytest.mark.parametrize("max_rows", [5, 40, 300])
def test_all_outputs_agree(events, max_rows):
    specs = [S.lag("value", "prev"), S.lead("value", "next"), S.running_sum("amount", "total"),
             S.carried("amount", "known"), S.row_number("rn"), S.rank("rk"), S.dense_rank("dr")]
    plain, cut = both(events, specs, ["ts", "event_id"], F.unix_micros("ts"), max_rows)
    assert plain == cut


def test_descending_order_with_ties(events):
    tied = events.withColumn("score", F.floor(F.col("value") / 20))
    specs = [S.rank("rk"), S.dense_rank("dr")]
    order, pos = [F.col("score").desc()], -F.col("score")
    plain, cut = both(tied, specs, order, pos)
    assert plain == cut
    specs = [S.row_number("rn")]
    plain, cut = both(tied, specs, [F.col("score").desc(), "event_id"], pos)
    assert plain == cut


def test_percentiles_match_builtin(events):
    got = S.exact_percentiles(events, ["event_type"], "value", {"p50": 0.5, "p95": 0.95}, max_rows=30)
    want = events.groupBy("event_type").agg(F.expr("percentile(value, 0.5)").alias("p50"),
                                            F.expr("percentile(value, 0.95)").alias("p95"))
    a = {r["event_type"]: (round(r["p50"], 9), round(r["p95"], 9)) for r in got.collect()}
    b = {r["event_type"]: (round(r["p50"], 9), round(r["p95"], 9)) for r in want.collect()}
    assert a == b


def test_asof_and_window_totals_on_cut_keys(events):
    probes = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    facts = events.where("event_type = 'purchase'").select("user_id", "ts", "amount")
    hot = S.find_hot(events, ["user_id"], F.unix_micros("ts"), 40)
    none = S.HotKeys(("user_id",))
    key = lambda df: sorted(map(str, df.collect()))
    right = facts.withColumnRenamed("ts", "paid_at")
    assert key(S.asof_join(probes, right, ["user_id"], "ts", "paid_at", ["paid_at", "amount"], hot)) == \
        key(S.asof_join(probes, right, ["user_id"], "ts", "paid_at", ["paid_at", "amount"], none))
    at = F.unix_micros("ts")
    day = 86_400_000_000
    totals = lambda h: S.window_totals(probes, facts, ["user_id"], ["event_id"], at - 3 * day, at,
                                       at, ["amount"], h)
    assert key(totals(hot)) == key(totals(none))
    naive = (probes.alias("p").join(facts.alias("f"), "user_id")
             .where("f.ts >= p.ts - INTERVAL 3 DAYS AND f.ts < p.ts")
             .groupBy("event_id").agg(F.sum("amount").alias("amount")))
    want = {r["event_id"]: r["amount"] for r in naive.collect()}
    assert {r["event_id"]: r["amount"] for r in totals(hot).collect() if r["amount"]} == want
