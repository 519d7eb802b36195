"""Ordered scans per key that survive a hot key.

A window ``PARTITION BY key ORDER BY t`` puts one key in one task. That is the
right plan while every key is small. Where a key is too large for a task, its
rows are cut into segments along the order; every segment is scanned by its own
task, and what a segment must inherit (a running total, the last value, a row
count) comes from a table with one row per segment. Results are the same as the
plain window's.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_GROUP_ROWS = 5_000_000      # a key with fewer rows is always left whole
MAX_HOT_KEYS = 1 << 20          # a key below total / this is left whole as well: no effect below 5 * 10**12 rows
BUCKETS = 65_536                # hash buckets of the first count
CUT_GRID = 1_024                # fewest places at which cuts can lie; more where a key needs more segments
COARSE = 32
LAST_SEG = 1 << 30              # segment of rows without a position in an order that has them last

SEG = "__seg"


@dataclass(frozen=True)
class HotKeys:
    """Keys too large for one task, with the positions that cut them.

    ``table`` is None when there is none; it holds at most MAX_HOT_KEYS rows, and
    the cuts of all keys together number at most twice that, so it may be broadcast.
    Without key columns the whole table is one key and ``cuts`` holds its cuts.
    """

    keys: tuple[str, ...]
    table: DataFrame | None = None
    cuts: list[list[float]] | None = None

    def __bool__(self) -> bool:
        return self.table is not None or self.cuts is not None


def position(df: DataFrame, name: str) -> Column:
    """A number that ascends with the column, whole for times and dates."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(name))
    return F.col(name)


def find_hot(df: DataFrame, keys: Sequence[str], pos: Column, max_rows: int = MAX_GROUP_ROWS,
             rows_per_key: DataFrame | None = None) -> HotKeys:
    """Find the keys with more rows than a task should take, and cut them.

    The first pass counts rows per hash bucket of the key, so however many keys
    there are it shuffles at most BUCKETS counters per task. A bucket holds at
    least as many rows as any key in it, hence no heavy bucket means no heavy key;
    only rows of heavy buckets are counted by key. Call it on a base table once and
    hand the result to every operator with the same key: it reads only the key and
    order columns. ``rows_per_key`` (keys, n) replaces the first pass where the
    rows are themselves the result of a costly aggregation.
    """
    spark = df.sparkSession
    keys = tuple(keys)
    slim = df.select(*keys, pos.alias("__pos"))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int") if keys else F.lit(0)
    if rows_per_key is None:
        sizes = slim.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    else:
        sizes = rows_per_key.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"))
    whole = sizes.agg(F.max("n").alias("top"), F.sum("n").alias("total")).first()
    total = whole["total"] or 0
    limit = max(max_rows, total // MAX_HOT_KEYS)
    if (whole["top"] or 0) <= limit:
        return HotKeys(keys)
    heavy = [(r["b"],) for r in sizes.where(F.col("n") > limit).select("b").collect()]   # at most MAX_HOT_KEYS
    suspects = slim.withColumn("b", bucket).join(
        F.broadcast(spark.createDataFrame(heavy, "b int")), "b", "left_semi").drop("b")
    big = suspects.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > limit)
    rows = keyed_join(suspects, big, keys, "inner", small=True) if keys else suspects.withColumn(
        "__n", F.lit(total))
    # as many segments as the largest key needs, however large it is
    largest = big.agg(F.max("__n")).first()[0] if keys else total
    places = max(CUT_GRID, 2 * -(-(largest or 0) // limit))
    grid = [i / places for i in range(1, places)]
    cuts = (
        rows.where(F.col("__pos").isNotNull())
        .groupBy(*keys)
        .agg(F.percentile_approx("__pos", grid, max(10_000, 10 * places)).alias("q"), F.max("__n").alias("__n"))
        .withColumn("parts", F.least(F.lit(places), F.ceil(F.col("__n") / F.lit(limit)) + 1)
                    .cast("int"))
        .select(*keys, F.array_sort(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.col("parts") - 1),
            lambda i: F.element_at("q", (i * places / F.col("parts")).cast("int"))))).alias("c"))
        # two levels, so that finding a row's segment takes 2 * 32 comparisons
        .select(*keys, F.transform(
            F.sequence(F.lit(0), ((F.size("c") - 1) / COARSE).cast("int")),
            lambda b: F.slice("c", (b * COARSE + 1).cast("int"), F.lit(COARSE))).alias("__cuts"))
    )
    found = cuts.collect()
    if not found:
        return HotKeys(keys)
    if not keys:
        return HotKeys(keys, None, found[0]["__cuts"])
    return HotKeys(keys, spark.createDataFrame(found, cuts.schema))


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
               small: bool = False) -> DataFrame:
    """Join on equal keys where NULL equals NULL, keeping the left side's key columns.

    ``small`` marks a right side whose size is bounded by construction.
    """
    renamed = right.withColumnsRenamed({k: "__k_" + k for k in keys})
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col("__k_" + k))
        cond = one if cond is None else cond & one
    joined = left.join(F.broadcast(renamed) if small else renamed, cond, how)
    return joined.drop(*["__k_" + k for k in keys])


def nulls_last(order: Sequence[Column | str]) -> bool:
    """Whether the leading column of an order is an order of its own that puts NULL behind all values."""
    return bool(order) and isinstance(order[0], Column) and str(order[0]).endswith((" DESC NULLS LAST'>", " ASC NULLS LAST'>"))


def with_segment(df: DataFrame, hot: HotKeys, pos: Column, name: str = SEG, nulls_behind: bool = False) -> DataFrame:
    """Add the segment number: 0 for a whole key, ascending along ``pos`` for a cut one.

    Rows of a cut key without a position go to the first segment, or to one behind all others.
    """
    if not hot:
        return df.withColumn(name, F.lit(0))
    placed = df.withColumn("__p", pos)
    if hot.cuts is not None:
        joined = placed.withColumn("__cuts", F.array(*[F.array(*[F.lit(x) for x in b]) for b in hot.cuts]))
    else:
        joined = keyed_join(placed, hot.table, hot.keys, small=True)
    block = F.greatest(
        F.size(F.filter("__cuts", lambda b: F.element_at(b, 1) <= F.col("__p"))), F.lit(1))
    inner = F.size(F.filter(F.element_at("__cuts", F.col("__block")),
                            lambda c: c <= F.col("__p")))
    return (
        joined.withColumn("__block", F.when(F.col("__cuts").isNotNull(), block))
        .withColumn(name, F.when(F.col("__cuts").isNull(), F.lit(0))
                    .when(F.col("__p").isNull(), F.lit(LAST_SEG if nulls_behind else 0))
                    .otherwise((F.col("__block") - 1) * COARSE + inner).cast("int"))
        .drop("__cuts", "__block", "__p")
    )


# ------------------------------------------------------------------ scan outputs
@dataclass(frozen=True)
class Spec:
    """One output column of a scan: ``kind`` over ``value`` named ``name``."""

    kind: str
    name: str
    value: str | None = None


def lag(value: str, name: str) -> Spec:
    return Spec("lag", name, value)


def lead(value: str, name: str) -> Spec:
    return Spec("lead", name, value)


def running_sum(value: str, name: str) -> Spec:
    return Spec("sum", name, value)


def carried(value: str, name: str) -> Spec:
    """Last non-null value up to and with the row."""
    return Spec("last", name, value)


def row_number(name: str) -> Spec:
    return Spec("number", name)


def rank(name: str) -> Spec:
    return Spec("rank", name)


def dense_rank(name: str) -> Spec:
    return Spec("dense", name)


def _local(spec: Spec, w, running) -> Column:
    if spec.kind == "lag":
        return F.lag(spec.value).over(w)
    if spec.kind == "lead":
        return F.lead(spec.value).over(w)
    if spec.kind == "sum":
        return F.sum(spec.value).over(running)
    if spec.kind == "last":
        return F.last(spec.value, ignorenulls=True).over(running)
    return {"number": F.row_number, "rank": F.rank, "dense": F.dense_rank}[spec.kind]().over(w)


def _widened(spec: Spec, column: Column) -> Column:
    return column.cast("bigint") if spec.kind in ("number", "rank", "dense") else column


def _handed_on(spec: Spec) -> Column:
    """What a segment hands to its neighbours."""
    if spec.kind == "lag":
        return F.max_by(spec.value, "__rn")
    if spec.kind == "lead":
        return F.min_by(spec.value, "__rn")
    if spec.kind == "sum":
        return F.sum(spec.value)
    if spec.kind == "last":
        return F.max_by(spec.name, "__rn")
    return F.max(spec.name) if spec.kind == "dense" else F.count("*")


def _inherited(spec: Spec, w, before) -> Column:
    if spec.kind == "lag":
        return F.lag(spec.name).over(w)
    if spec.kind == "lead":
        return F.lead(spec.name).over(w)
    if spec.kind == "last":
        return F.last(spec.name, ignorenulls=True).over(before)
    return F.sum(spec.name).over(before)


def _combined(spec: Spec) -> Column:
    own, got = F.col(spec.name), F.col("__in_" + spec.name)
    if spec.kind == "lag":
        return F.when(F.col("__rn") == 1, got).otherwise(own)
    if spec.kind == "lead":
        return F.when(F.col("__rn") == F.col("__size"), got).otherwise(own)
    if spec.kind == "last":
        return F.coalesce(own, got)
    if spec.kind == "sum":
        return F.when(own.isNull(), got).otherwise(own + F.coalesce(got, F.lit(0)))
    return _widened(spec, own + F.coalesce(got, F.lit(0)))


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
         specs: Sequence[Spec], hot: HotKeys, pos: Column, nulls_behind: bool | None = None) -> DataFrame:
    """Add every ``specs`` column, computed per ``keys`` along ``order``.

    ``order`` must be total within a key wherever the answer depends on ties, and
    ``pos`` is the number its leading column ascends with (negate it for a
    descending order). Rank-like outputs need ties to share ``pos``. ``nulls_behind``
    says whether the leading column puts NULL behind all values, as a descending one does;
    left out, it is read from the order.
    """
    keys = list(keys)
    if not hot:
        w = Window.partitionBy(*keys).orderBy(*order)
        running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({s.name: _widened(s, _local(s, w, running)) for s in specs})
    w = Window.partitionBy(*keys, SEG).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outputs = {s.name: _local(s, w, running) for s in specs}
    outputs["__rn"] = F.row_number().over(w)
    behind = nulls_last(order) if nulls_behind is None else nulls_behind
    scanned = lambda rows: with_segment(rows, hot, pos, nulls_behind=behind).withColumns(outputs)
    local = scanned(df)
    # Only cut keys hand anything on: at most two rows per 1 / MAX_HOT_KEYS of the data.
    cut = df if hot.table is None else keyed_join(df, hot.table.select(*keys), keys, "left_semi", small=True)
    handed = (
        scanned(cut).groupBy(*keys, SEG)
        .agg(*[_handed_on(s).alias(s.name) for s in specs], F.max("__rn").alias("__size"))
    )
    along = Window.partitionBy(*keys).orderBy(SEG)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    inherited = handed.select(
        *keys, SEG, "__size",
        *[_inherited(s, along, before).alias("__in_" + s.name) for s in specs])
    joined = keyed_join(local, inherited, [*keys, SEG], small=True)
    return joined.withColumns({s.name: _combined(s) for s in specs}).select(
        *df.columns, *[s.name for s in specs])


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_pos: str,
              right_pos: str, columns: Sequence[str], hot: HotKeys, *,
              strict: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """For each left row the newest right row of the same keys at or before it.

    Both sides are stacked and the right row is carried forward, so the work is
    linear in the rows: no pairs are formed. ``strict`` wants the right row
    earlier than the left one. ``tie`` orders right rows with equal positions.
    """
    keys = list(keys)
    lrows = left.select(
        *keys, position(left, left_pos).alias("__pos"), F.lit(0 if strict else 1).alias("__side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("__l"))
    rrows = right.select(
        *keys, position(right, right_pos).alias("__pos"), F.lit(1 if strict else 0).alias("__side"),
        F.struct(*[F.col(c) for c in columns]).alias("__r"),
        F.struct(F.lit(0), *[F.col(c) for c in tie]).alias("__tie"))
    both = lrows.unionByName(rrows, allowMissingColumns=True)
    done = scan(both, keys, ["__pos", "__side", "__tie"], [carried("__r", "__match")], hot,
                F.col("__pos"))
    return done.where(F.col("__l").isNotNull()).select(
        "__l.*", *[F.col(f"__match.{c}").alias(c) for c in columns])


def window_totals(anchors: DataFrame, facts: DataFrame, keys: Sequence[str], anchor_id: Sequence[str],
                  lo: Column, hi: Column, fact_pos: Column, measures: Sequence[str],
                  hot: HotKeys) -> DataFrame:
    """Sum ``measures`` of the facts in [lo, hi) for every anchor row of the same keys.

    Each anchor asks for the running total at its two ends, so overlapping windows
    cost two rows each instead of one pair per fact inside.
    """
    keys, anchor_id = list(keys), list(anchor_id)
    ends = anchors.select(
        *keys, F.struct(*anchor_id).alias("__anchor"),
        F.explode(F.array(F.struct(lo.alias("p"), F.lit(-1).alias("s")),
                          F.struct(hi.alias("p"), F.lit(1).alias("s")))).alias("__end"))
    ends = ends.select(*keys, "__anchor", F.col("__end.p").alias("__pos"),
                       F.col("__end.s").alias("__sign"), F.lit(0).alias("__side"))
    rows = facts.select(*keys, fact_pos.alias("__pos"), F.lit(1).alias("__side"), *measures)
    both = rows.unionByName(ends, allowMissingColumns=True)
    done = scan(both, keys, ["__pos", "__side"],
                [running_sum(m, "__cum_" + m) for m in measures], hot, F.col("__pos"))
    return (
        done.where(F.col("__anchor").isNotNull())
        .groupBy(*keys, "__anchor")
        .agg(*[F.sum(F.col("__sign") * F.coalesce(F.col("__cum_" + m), F.lit(0))).alias(m)
               for m in measures])
        .select(*[k for k in keys if k not in anchor_id], "__anchor.*", *measures)
    )


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      points: dict[str, float], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Interpolated percentiles per key from value counts, without holding a group in one task."""
    keys = list(keys)
    present = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("v"))
    counts = present.groupBy(*keys, "v").agg(F.count("*").alias("c"))
    # a sketch of the distinct values per key tells whether a key's counts fit one task
    distinct = present.groupBy(*keys).agg(F.approx_count_distinct("v").alias("n"))
    hot = find_hot(counts, keys, F.col("v"), max_rows, rows_per_key=distinct)
    upto = scan(counts, keys, ["v"], [running_sum("c", "upto")], hot, F.col("v"))
    totals = counts.groupBy(*keys).agg(F.sum("c").alias("n"))
    ranked = keyed_join(upto, totals, keys) if keys else upto.withColumn("n", totals.scalar())
    ps = F.array(*[F.lit(float(p)) for p in points.values()])
    rank_of = lambda p: p * (F.col("n") - 1)
    # keep the few rows that hold a wanted rank or the one after it
    near = lambda p: (F.col("upto") > F.floor(rank_of(p))) & (F.col("upto") - F.col("c") <= F.floor(rank_of(p)) + 1)
    # at most two rows per point are left of a key
    folded = ranked.where(F.exists(ps, near)).groupBy(*keys).agg(
        F.max("n").alias("n"), F.collect_list(F.struct("upto", "c", "v")).alias("hits"))

    def value_at(rank: Column) -> Column:
        held = F.filter("hits", lambda h: (h["upto"] > rank) & (h["upto"] - h["c"] <= rank))
        return F.element_at(held, 1)["v"]

    def interpolated(p: Column) -> Column:
        x = rank_of(p)
        low, high = value_at(F.floor(x)), value_at(F.ceil(x))
        return low + (high - low) * (x - F.floor(x))

    found = folded.select(*keys, F.col("n").alias("n_values"), F.transform(ps, interpolated).alias("__found"))
    return found.select(*keys, "n_values", *[F.col("__found")[i].alias(name) for i, name in enumerate(points)])
