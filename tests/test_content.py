"""Content hashes, bitmaps and theta sketches against plain counts."""
import random

from pyspark.sql import functions as F

from lakeops.functions import aggregates as A
from lakeops.operators import setops
from lakeops.plans import inspect

ROWS = [(1, "a", None), (1, "a", None), (2, None, "a"), (2, "a", None), (3, "x", "y"), (None, None, None)]
SCHEMA = "p int, x string, y string"


def test_content_hash_tells_rows_copies_and_nulls_apart(spark):
    a = spark.createDataFrame(ROWS, SCHEMA)
    same = lambda rows: setops.same_content(a, spark.createDataFrame(rows, SCHEMA).repartition(3)).first()
    shuffled = random.Random(1).sample(ROWS, len(ROWS))
    assert tuple(same(shuffled)) == (6, 6, True)
    assert tuple(same(ROWS[1:])) == (6, 5, False)
    assert not same(ROWS[1:] + ROWS[-1:])["same"]                    # another row twice
    assert not same([(1, None, "a"), *ROWS[1:]])["same"]             # NULL in another column
    assert tuple(setops.same_content(a.limit(0), a.limit(0)).first()) == (0, 0, True)


def test_content_hash_shuffles_a_row_per_task(spark):
    a = spark.range(0, 100_000, 1, 8).selectExpr("id", "id % 7 AS k")
    assert "HashAggregate" in inspect.plan_text(setops.same_content(a, a.where("k < 9")), "simple")
    assert inspect.count_shuffles(a.agg(*setops.content_hash(a.columns))) == 1


def test_row_changes_look_into_changed_parts_only(spark):
    a = spark.createDataFrame(ROWS, SCHEMA)
    b = spark.createDataFrame([*ROWS[1:4], (3, "x", "z"), (4, None, None)], SCHEMA)
    got = {r["p"]: (r["only_left"], r["only_right"]) for r in setops.row_changes(a, b, ["p"]).collect()}
    assert got == {1: (1, 0), 3: (1, 1), None: (1, 0), 4: (0, 1)}
    parts = {r["p"]: (r["rows_left"], r["rows_right"]) for r in setops.changed_parts(a, b, ["p"]).collect()}
    assert parts == {1: (2, 1), 3: (1, 1), None: (1, 0), 4: (0, 1)}
    assert setops.row_changes(a, a, ["p"]).count() == 0


def test_bitmaps_count_exactly_over_any_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(10), rng.choice([None, rng.randrange(200_000)])) for _ in range(3_000)]
    maps = A.bitmaps(spark.createDataFrame(rows, "k string, day int, v long"), ["k", "day"], "v")
    windows = {"late": F.col("day") >= 7, "one": F.col("day") == 3, "none": F.col("day") > 99}
    got = {r["k"]: (r["late"], r["one"], r["none"]) for r in A.bitmap_distinct(maps, ["k"], windows).collect()}
    count = lambda k, keep: len({v for x, d, v in rows if x == k and v is not None and keep(d)})
    assert got == {k: (count(k, lambda d: d >= 7), count(k, lambda d: d == 3), 0) for k in "ab"}


def test_theta_sketches_subtract_within_their_bound(spark):
    sets = {1: range(0, 40_000), 2: range(10_000, 60_000), 4: range(5)}
    rows = spark.createDataFrame([(m, v) for m, s in sets.items() for v in s], "m int, v long")
    exact = {1: (40_000, 0, 0), 2: (20_000, 30_000, 10_000), 4: (5, 0, 0)}
    fine = {r["m"]: tuple(r)[1:] for r in A.set_changes(rows, "m", F.col("m") - 1, "v").collect()}
    assert fine == exact
    rough = {r["m"]: tuple(r)[1:] for r in A.set_changes(rows, "m", F.col("m") - 1, "v", 10).collect()}
    for m, want in exact.items():
        assert all(abs(g - w) <= 4 * 60_000 / 2 ** 5 for g, w in zip(rough[m], want))


def test_set_changes_are_exact_beyond_one_sketch(spark):
    sets = {1: range(0, 40_000), 2: range(10_000, 60_000), 4: range(5), 5: range(0), 6: [7]}
    rows = [(m, v) for m, s in sets.items() for v in s] + [(5, None), (2, None), (None, 3)]
    df = spark.createDataFrame(rows, "m int, v long")
    got = {r["m"]: tuple(r)[1:] for r in A.set_changes(df, "m", F.col("m") - 1, "v", 10).collect()}
    assert got == {1: (40_000, 0, 0), 2: (20_000, 30_000, 10_000), 4: (5, 0, 0), 5: (0, 0, 5), 6: (1, 0, 0), None: (0, 0, 0)}
    assert A.set_changes(df.limit(0), "m", F.col("m") - 1, "v").count() == 0
