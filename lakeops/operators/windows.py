"""Operators that need rows in order: dedup, sessions, runs, rolling sums, carry-forward."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators import scans as S
from lakeops.session import ensure_checkpoint_dir

DIGIT = 4       # bits of a value's rank that one level of the prefix medians settles


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int,
          rank_name: str | None = None) -> DataFrame:
    """First ``n`` rows per key; Spark keeps only ``n`` per key and task before the shuffle."""
    rn = rank_name or "__rn"
    out = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.where(F.col(rn) <= n)
    return out if rank_name else out.drop(rn)


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first along ``order``, which must be total for a stable result."""
    return top_n(df, keys, order, 1)


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: float, tie: Sequence[str],
               hot: S.HotKeys, name: str = "session_seq") -> DataFrame:
    """Number sessions per key; a new one starts after a silence longer than the gap."""
    at = F.unix_micros(F.col(ts))
    before = S.scan(df.withColumn("__at", at), keys, ["__at", *tie], [S.lag("__at", "__prev")], hot,
                    F.col("__at"))
    fresh = F.col("__prev").isNull() | (F.col("__at") - F.col("__prev") > int(gap_seconds * 1_000_000))
    flagged = before.withColumn("__new", fresh.cast("bigint"))
    numbered = S.scan(flagged, keys, ["__at", *tie], [S.running_sum("__new", name)], hot, F.col("__at"))
    return numbered.drop("__at", "__prev", "__new")


def state_runs(df: DataFrame, keys: Sequence[str], ts: str, state: str, tie: Sequence[str],
               hot: S.HotKeys, name: str = "run_id") -> DataFrame:
    """Number the contiguous runs in which ``state`` is true; rows outside runs are dropped."""
    at = F.unix_micros(F.col(ts))
    rows = df.withColumn("__at", at).withColumn("__on", F.coalesce(F.col(state), F.lit(False)))
    before = S.scan(rows, keys, ["__at", *tie], [S.lag("__on", "__was")], hot, F.col("__at"))
    flagged = before.withColumn(
        "__start", (F.col("__on") & ~F.coalesce(F.col("__was"), F.lit(False))).cast("bigint"))
    numbered = S.scan(flagged, keys, ["__at", *tie], [S.running_sum("__start", name)], hot, F.col("__at"))
    return numbered.where("__on").drop("__at", "__on", "__was", "__start")


def missing_slots(present: DataFrame, keys: Sequence[str], slot: str, step_seconds: int) -> DataFrame:
    """Grid slots between a key's first and last presence in which it is absent.

    ``present`` may repeat a slot. One row per key and slot is what the grid holds,
    so its size follows from the observed time span, not from the row count.
    """
    seen = present.select(*keys, slot).distinct()
    ends = seen.groupBy(*keys).agg(F.min(slot).alias("lo"), F.max(slot).alias("hi"))
    grid = ends.select(*keys, F.explode(F.expr(
        f"sequence(lo, hi, INTERVAL {int(step_seconds)} SECONDS)")).alias(slot))
    return S.keyed_join(grid, seen, [*keys, slot], "left_anti")


def slot_runs(slots: DataFrame, keys: Sequence[str], slot: str, step_seconds: int,
              min_length: int = 1) -> DataFrame:
    """Runs of consecutive grid slots with at least ``min_length`` members."""
    # consecutive slots share (slot number - rank): one window instead of lag and sum
    number = (F.unix_seconds(F.col(slot)) / step_seconds).cast("bigint")
    w = Window.partitionBy(*keys).orderBy(slot)
    tagged = slots.withColumn("__g", number - F.row_number().over(w))
    runs = tagged.groupBy(*keys, "__g").agg(
        F.min(slot).alias("run_start"), F.max(slot).alias("run_end"), F.count("*").alias("slots"))
    numbered = runs.where(F.col("slots") >= min_length).drop("__g")
    return numbered


def missing_runs(rows: DataFrame, keys: Sequence[str], slot: str, step_seconds: int, min_length: int = 1,
                 present: Column | None = None) -> DataFrame:
    """Runs of absent grid slots between a key's first and last row: keys, run_start, run_end, slots.

    ``rows`` has one row per key and slot; where ``present`` does not hold, the row counts as absent and only
    stretches the key's range. A run is the gap between two present slots (or an end of the range), so the
    cost follows from the rows, however long a key is silent.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    number = F.floor(F.unix_seconds(F.col(slot)) / step_seconds)
    along = Window.partitionBy(*keys).orderBy("__at")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.select(*keys, number.alias("__at"), here.alias("__here")).withColumns({
        "__since": F.last(F.when(F.col("__here"), F.col("__at")), ignorenulls=True).over(earlier),
        "__low": F.first("__at").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__end": F.lead("__at").over(along).isNull()})
    # a present row ends the gap before it, the key's last row ends one that is still open
    gaps = seen.where(F.col("__here") | F.col("__end")).select(
        *keys, F.coalesce(F.col("__since") + 1, "__low").alias("__from"),
        F.when(F.col("__here"), F.col("__at") - 1).otherwise(F.col("__at")).alias("__to"))
    start = lambda c: F.timestamp_seconds(F.col(c) * step_seconds)
    return gaps.withColumn("slots", F.col("__to") - F.col("__from") + 1).where(F.col("slots") >= max(1, min_length)).select(
        *keys, start("__from").alias("run_start"), start("__to").alias("run_end"), "slots")


def rolling_sum(df: DataFrame, keys: Sequence[str], ts: str, value: str, lookback_seconds: int,
                row_id: Sequence[str], hot: S.HotKeys, name: str) -> DataFrame:
    """Sum of ``value`` over the last ``lookback_seconds`` up to and with each row.

    A cut key runs segment by segment: a row is copied to the later segments in
    whose look-back it lies, so every frame holds the rows it holds in the plain
    window, NULLs, ties and doubles included. Rows without a time are each
    other's frame. ``row_id`` is not needed for that and kept for callers.
    """
    at, back = F.unix_micros(F.col(ts)), lookback_seconds * 1_000_000
    if not hot:
        w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-back, Window.currentRow)
        return df.withColumn(name, F.sum(value).over(w))
    placed = S.with_segment(S.with_segment(df, hot, at, "__own"), hot, at + back, "__last")
    copies = placed.withColumn(S.SEG, F.explode(F.sequence("__own", "__last")))
    w = Window.partitionBy(*keys, S.SEG).orderBy(at).rangeBetween(-back, Window.currentRow)
    summed = copies.withColumn("__sum", F.sum(value).over(w)).where(F.col(S.SEG) == F.col("__own"))
    return summed.select(*df.columns, F.col("__sum").alias(name))


def trailing_median(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str,
                    hot: S.HotKeys | None = None, pos: Column | None = None,
                    max_rows: int = S.MAX_GROUP_ROWS) -> DataFrame:
    """Lower median of the earlier rows of the key, the current one excluded; NULL values do not count.

    ``order`` must be total. A key that ``hot`` cuts goes through ``prefix_medians``, the others through the plain window.
    """
    plain = lambda rows: rows.withColumn(name, F.percentile_approx(value, 0.5).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)))
    if not hot:
        return plain(df)
    if hot.table is None:
        return prefix_medians(df, keys, order, value, name, hot, pos, max_rows)
    part = lambda how: S.keyed_join(df, hot.table.select(*keys), keys, how, small=True)
    return plain(part("left_anti")).unionByName(prefix_medians(part("left_semi"), keys, order, value, name, hot, pos, max_rows))


def prefix_medians(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, hot: S.HotKeys,
                   pos: Column, max_rows: int = S.MAX_GROUP_ROWS) -> DataFrame:
    """Exact lower median of the earlier values, for keys that no single task can hold.

    Values are replaced by their ranks, and the ranks are settled digit by digit from the highest: every row asks how many
    earlier values of its key begin with the digits settled so far and go on with each next digit. These counts are running sums
    per prefix along the order, so each level is one segmented scan, and there are log16(distinct values) levels.
    """
    keys, base = list(keys), 1 << DIGIT
    ensure_checkpoint_dir(df.sparkSession)
    counted = df.withColumn("__has", F.col(value).isNotNull().cast("bigint"))
    # the numbers name the rows below and must not change
    rows = S.scan(counted, keys, order, [S.row_number("__i"), S.running_sum("__has", "__n")], hot, pos).checkpoint()
    present = rows.where("__has = 1").select(*keys, "__i", F.col(value).alias("__v"))
    by_value = F.col("__v").cast("double")
    ranked = S.scan(present, keys, ["__v"], [S.dense_rank("__code")], S.find_hot(present, keys, by_value, max_rows), by_value)
    points = ranked.select(*keys, "__i", "__v", (F.col("__code") - 1).alias("__code")).checkpoint()
    levels = -(-int(points.agg(F.max("__code")).first()[0] or 0).bit_length() // DIGIT) or 1
    earlier = F.col("__n") - F.col("__has")
    asks = rows.where(earlier > 0).select(
        *keys, "__i", F.lit(0).cast("bigint").alias("__node"), F.floor((earlier + 1) / 2).cast("bigint").alias("__k"))
    ones, sums, lasts = ([f"__{c}{d}" for d in range(base)] for c in "dsw")
    for level in reversed(range(levels)):
        digit = F.shiftright("__code", level * DIGIT).bitwiseAND(F.lit(base - 1))
        here = points.select(*keys, "__i", F.shiftright("__code", (level + 1) * DIGIT).alias("__node"), F.lit(1).alias("__side"),
                             *[(digit == d).cast("bigint").alias(c) for d, c in enumerate(ones)],
                             *[F.when(digit == d, F.col("__v")).alias("__v" + c) for d, c in enumerate(ones) if level == 0])
        both = here.unionByName(asks.withColumn("__side", F.lit(0)), allowMissingColumns=True)
        along = [*keys, "__node"]
        # a row asks before it counts
        seen = S.scan(both, along, ["__i", "__side"],
                      [*[S.running_sum(c, s) for c, s in zip(ones, sums)],
                       *[S.carried("__v" + c, w) for c, w in zip(ones, lasts) if level == 0]],
                      S.find_hot(both, along, F.col("__i"), max_rows), F.col("__i")).where("__side = 0")
        upto, total = [], F.lit(0).cast("bigint")
        for s in sums:
            total = total + F.coalesce(F.col(s), F.lit(0))
            upto.append(total)
        passed = F.array(*upto)
        found = seen.withColumn("__below", F.filter(passed, lambda c: c < F.col("__k")))
        step = F.size("__below").cast("bigint")
        if level:
            asks = found.select(*keys, "__i", (F.col("__node") * base + step).alias("__node"),
                                (F.col("__k") - F.coalesce(F.array_max("__below"), F.lit(0))).alias("__k")).checkpoint()
        else:
            asks = found.select(*keys, "__i", F.element_at(F.array(*lasts), (step + 1).cast("int")).alias(name))
    return S.keyed_join(rows, asks, [*keys, "__i"]).select(*[c for c in df.columns if c != name], name)


def smooth_spikes(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, jump: float,
                  agree: float, hot: S.HotKeys, pos: Column) -> DataFrame:
    """Flag a reading far from both neighbours while they agree; replace it by their mean, keep the raw one."""
    near = S.scan(df, keys, order, [S.lag(value, "__p"), S.lead(value, "__n")], hot, pos)
    v, p, n = F.col(value), F.col("__p"), F.col("__n")
    spike = F.coalesce((F.abs(v - p) > jump) & (F.abs(v - n) > jump) & (F.abs(p - n) < agree), F.lit(False))
    return (near.withColumn("is_spike", spike).withColumn(value + "_raw", v)
            .withColumn(value, F.when(F.col("is_spike"), (p + n) / 2).otherwise(v)).drop("__p", "__n"))


def resample(readings: DataFrame, keys: Sequence[str], ts: str, value: str, step_seconds: int,
             max_age_seconds: int, bounds: DataFrame | None = None) -> DataFrame:
    """Regular grid per key: observed mean, else the last value if young enough, else a gap.

    Readings are folded to one row per key and slot before anything is ordered, so
    a busy key costs its slots, not its readings. ``bounds`` (keys, lo, hi) sets the
    grid; without it the grid runs from a key's first to its last reading. The slots
    between two readings are made after the window, from the reading before them:
    the grid itself is neither shuffled nor sorted nor held in memory.
    """
    slot_of = lambda c: F.floor(F.unix_seconds(F.col(c)) / step_seconds)
    folded = readings.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).groupBy(*keys, slot_of(ts).alias("__slot")).agg(
        F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.count("*").alias("observations"), F.max(ts).alias("__at"), F.max_by(value, ts).alias("__v"))
    if bounds is None:
        along = Window.partitionBy(*keys).orderBy("__slot")
        runs = folded.withColumns({"__known_at": F.col("__at"), "__known_v": F.col("__v"),
                                   "__stop": F.coalesce(F.lead("__slot").over(along) - 1, "__slot")})
    else:
        # a row without a reading opens each range, before the reading of the same slot
        both = folded.unionByName(_ranges(bounds.select(*keys, slot_of("lo").alias("a"), slot_of("hi").alias("b")), keys), allowMissingColumns=True)
        along = Window.partitionBy(*keys).orderBy("__slot", F.col("__end").isNull())
        last = lambda c: F.last(c, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
        runs = both.withColumns({"__known_at": last("__at"), "__known_v": last("__v"), "__within": last("__end"),
                                 "__next": F.lead("__slot").over(along)}).where("__within IS NOT NULL").withColumn(
            "__stop", F.least(F.col("__next") - 1, "__within")).where("__slot <= __stop")
    done = runs.withColumn("__n", F.explode(F.sequence("__slot", "__stop")))
    start = F.timestamp_seconds(F.col("__n") * step_seconds)
    fresh = F.unix_micros(start) - F.unix_micros(F.col("__known_at")) <= max_age_seconds * 1_000_000
    seen = (F.col("__n") == F.col("__slot")) & F.col("observations").isNotNull()
    return done.select(
        *keys, start.alias("slot"), F.when(seen, F.col("observations")).otherwise(F.lit(0)).alias("observations"),
        F.when(seen, F.col("low")).alias("low"), F.when(seen, F.col("high")).alias("high"),
        F.when(seen, F.col("mean")).when(fresh, F.col("__known_v")).alias("value"),
        F.when(seen, "observed").when(fresh, "carried").otherwise("gap").alias("source"))


def _ranges(ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranges (a, b) of slots with those that meet made one: (keys, __slot, __end)."""
    along = Window.partitionBy(*keys).orderBy("a", "b")
    reach = F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1))
    known = ends.where("a IS NOT NULL AND b IS NOT NULL").select(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    fresh = known.withColumn("__new", F.coalesce(F.col("a") > reach, F.lit(True)).cast("int"))
    return fresh.withColumn("__range", F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "__range").agg(
        F.min("a").alias("__slot"), F.max("b").alias("__end")).drop("__range")


def close_intervals(changes: DataFrame, keys: Sequence[str], ts: str, value: str, hot: S.HotKeys,
                    start: str = "effective_start", end: str = "effective_end") -> DataFrame:
    """History intervals from dated values: repeats are dropped, each interval ends where the next begins."""
    pos = S.position(changes, ts)
    known = S.scan(changes, keys, [ts], [S.lag(value, "__prev"), S.row_number("__rn")], hot, pos)
    moved = known.where((F.col("__rn") == 1) | ~F.col(value).eqNullSafe(F.col("__prev")))
    closed = S.scan(moved.drop("__rn"), keys, [ts], [S.lead(ts, end)], hot, pos)
    return closed.withColumnRenamed("__prev", "previous_" + value).withColumnRenamed(ts, start)


def bands(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pos: Column, n: int,
          hot: S.HotKeys, name: str, nulls_behind: bool | None = None) -> DataFrame:
    """``ntile(n)`` per key along ``order``, also for keys too large for one task; ``nulls_behind`` as in ``scan``."""
    if not hot:
        return df.withColumn(name, F.ntile(n).over(Window.partitionBy(*keys).orderBy(*order)))
    numbered = S.scan(df, keys, order, [S.row_number("__i")], hot, pos, nulls_behind)
    sized = S.keyed_join(numbered, df.groupBy(*keys).agg(F.count("*").alias("__n")), keys)
    q, r = F.floor(F.col("__n") / n), F.col("__n") % n
    split = r * (q + 1)
    tile = F.when(F.col("__i") <= split, F.ceil(F.col("__i") / (q + 1))).otherwise(
        r + F.ceil((F.col("__i") - split) / F.greatest(q, F.lit(1))))
    return sized.withColumn(name, tile.cast("int")).drop("__i", "__n")


def global_sequence(df: DataFrame, order: Sequence[str], pos: Column, name: str,
                    max_rows: int = S.MAX_GROUP_ROWS) -> DataFrame:
    """1..n over the whole table along ``order``, numbered segment by segment."""
    hot = S.find_hot(df, [], pos, max_rows)
    return S.scan(df, [], order, [S.row_number(name)], hot, pos)
