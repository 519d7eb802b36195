"""Join operators: size-checked broadcast, intervals, salting, tolerance, coverage."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalar import bucket_of
from lakeops.operators import scans as S
from lakeops.session import ensure_checkpoint_dir

BROADCAST_BYTES = 32 * 1024 * 1024    # by the planner's estimate, which counts files as they are stored
BROADCAST_ROWS = 100_000              # for rows handed over from the driver, which have no estimate
UNKNOWN = 1 << 62                     # estimates from here on mean that there is none


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the planner puts the table at ``max_bytes`` or less; nothing runs for a stored or derived table.

    A derived table counts with the size of what it is derived from, so one that turns out small is left to
    adaptive execution. Rows handed over from the driver are counted up to BROADCAST_ROWS.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < UNKNOWN:
        return size <= max_bytes
    return max_bytes >= BROADCAST_BYTES and df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a table of checked size; any other is left to adaptive execution."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def scd2_as_of(history: DataFrame, day: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows of a history table that were valid on ``day``."""
    return history.where((F.col(start) <= day) & ((F.col(end) > day) | F.col(end).isNull()))


# ------------------------------------------------------------------ intervals
def interval_join(facts: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str, start: str,
                  end: str, columns: Sequence[str], hot: S.HotKeys, *, method: str = "carry",
                  cell_seconds: int = 86_400, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of each fact with the interval [start, end) of its key that holds its time.

    ``carry`` (default) wants non-overlapping intervals and is linear in the rows;
    ``broadcast`` ships a small interval table and goes over to ``grid`` beyond the
    limit; ``grid`` turns the range into an equality on time cells and keeps the
    exact range as a residual. Both of these give every interval that holds the
    fact, so they agree on overlapping intervals. An open end is NULL.
    """
    if method == "broadcast":
        if not is_small(intervals, max_bytes):
            return _grid_join(facts, intervals, keys, ts, start, end, columns, cell_seconds)
        slim = F.broadcast(intervals.select(*keys, start, end, *columns))
        return facts.join(slim, list(keys)).where(_holds(ts, start, end)).drop(start, end)
    if method == "grid":
        return _grid_join(facts, intervals, keys, ts, start, end, columns, cell_seconds)
    got = S.asof_join(facts, intervals, keys, ts, start, [start, end, *columns], hot)
    return got.where(F.col(start).isNotNull() & _holds(ts, start, end)).drop(start, end)


def _holds(ts: str, start: str, end: str) -> Column:
    return (F.col(ts) >= F.col(start)) & (F.col(end).isNull() | (F.col(ts) < F.col(end)))


def _grid_join(facts, intervals, keys, ts, start, end, columns, cell_seconds):
    cell = lambda c: F.floor(F.unix_seconds(c) / cell_seconds)
    # no cell past a key's last fact is of use, which also closes the open intervals
    last = facts.groupBy(*keys).agg(F.max(cell(F.col(ts))).alias("__last"))
    closed = intervals.select(*keys, start, end, *columns).join(last, list(keys))
    top = F.when(F.col(end).isNull(), F.col("__last")).otherwise(
        F.least(F.col("__last"), F.floor((F.unix_micros(F.col(end)) - 1) / (cell_seconds * 1_000_000))))
    spread = closed.where(top >= cell(F.col(start))).select(
        *keys, start, end, *columns, F.explode(F.sequence(cell(F.col(start)), top)).alias("__cell"))
    return (facts.withColumn("__cell", cell(F.col(ts))).join(spread, [*keys, "__cell"])
            .where(_holds(ts, start, end)).drop("__cell", start, end))


def overlap_counts(runs: DataFrame, block: str, member: str, start: str, end: str, step_seconds: int,
                   max_rows: int = S.MAX_GROUP_ROWS, name: str = "concurrent") -> DataFrame:
    """How many other members of the block have a run overlapping each run, without forming pairs.

    Runs of one member must not overlap. A run meets another member for the first
    time either because that member is already in a run at the start, or in a later
    run that begins inside while the member's previous run ended before. The first
    part is a running count per block and slot; the second counts points in a range
    of starts with an earlier previous end, for which every point is filed under the
    power-of-two ranges that hold its start, and every run asks the few ranges that
    tile its own.
    """
    slot = lambda c: F.floor(F.unix_seconds(F.col(c)) / step_seconds)
    # read five times below and far smaller than what it was found in
    ensure_checkpoint_dir(runs.sparkSession)
    runs = runs.checkpoint()
    base = runs.withColumn("__s", slot(start)).withColumn("__e", slot(end))
    whole = S.HotKeys((block, member))
    linked = S.scan(base, [block, member], ["__s"], [S.lag("__e", "__before")], whole, F.col("__s"))
    # already in a run when this one starts
    edges = base.select(block, F.explode(F.array(
        F.struct(F.col("__s").alias("i"), F.lit(1).alias("d")),
        F.struct((F.col("__e") + 1).alias("i"), F.lit(-1).alias("d")))).alias("x"))
    per_slot = edges.groupBy(block, F.col("x.i").alias("__s")).agg(
        F.sum("x.d").alias("d"), F.count_if(F.col("x.d") == 1).alias("starting"))
    at = S.scan(per_slot, [block], ["__s"], [S.running_sum("d", "active")], S.HotKeys((block,)), F.col("__s"))
    already = at.select(block, "__s", (F.col("active") - F.col("starting")).alias("already"))
    # beginning inside, not met before
    longest = base.agg(F.max(F.col("__e") - F.col("__s") + 1).alias("m")).first()["m"] or 1
    levels = F.array(*[F.lit(i) for i in range(int(longest).bit_length() + 1)])
    power = lambda i: F.pow(F.lit(2.0), i).cast("bigint")
    points = linked.select(
        block, F.explode(levels).alias("level"), "__s",
        F.coalesce("__before", F.lit(-(1 << 60))).alias("p")).select(
        block, "level", F.floor(F.col("__s") / power(F.col("level"))).alias("node"), "p",
        F.lit(1).alias("one"), F.lit(1).alias("side"))
    asked = linked.select(block, member, "__s", "__e", F.explode(levels).alias("level")).select(
        "*", F.ceil(F.col("__s") / power(F.col("level"))).alias("l"),
        F.floor((F.col("__e") + 1) / power(F.col("level"))).alias("r")).where("l < r")
    tiles = asked.select(block, member, "__s", "level", F.explode(F.array_compact(F.array(
        F.when(F.col("l") % 2 != 0, F.col("l")), F.when(F.col("r") % 2 != 0, F.col("r") - 1)))).alias("node"),
        F.col("__s").alias("p"), F.lit(0).alias("side"))
    filed = points.unionByName(tiles, allowMissingColumns=True)
    keys = [block, "level", "node"]
    hot = S.find_hot(filed, keys, F.col("p"), max_rows)
    counted = S.scan(filed, keys, ["p", "side"], [S.running_sum("one", "n")], hot, F.col("p"))
    inside = counted.where(F.col("side") == 0).groupBy(block, member, "__s").agg(
        F.sum(F.coalesce("n", F.lit(0))).alias("inside"))
    out = base.join(already, [block, "__s"]).join(inside, [block, member, "__s"], "left")
    # the run itself is among those beginning inside
    return out.withColumn(name, (F.col("already") + F.coalesce("inside", F.lit(0)) - 1).cast("bigint")).drop(
        "__s", "__e", "already", "inside")


# ------------------------------------------------------------------ skew
def hot_values(df: DataFrame, key: Sequence[str], threshold: int) -> DataFrame:
    """Key values with more than ``threshold`` rows: at most rows / threshold of them."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > threshold)


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot: DataFrame,
                buckets: int = 32) -> DataFrame:
    """Equi-join in which the rows of hot keys are spread over ``buckets`` on the left and copied on the right.

    Only hot keys are copied. For ``full`` the unmatched right rows come from a
    separate, unsalted anti-join, so a copy can never show up as unmatched.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"salted join supports inner, left and full, not {how}")
    keys = list(keys)
    # the marker goes to the rows and not the rows to it, while the hot keys are as few as they should be
    marked = hot.select(*keys, F.lit(True).alias("__hot")).distinct()
    if marked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        marked = F.broadcast(marked)
    spread = bucket_of(left.columns, buckets)
    # rows with a NULL key match nothing; they are spread, too, instead of meeting in one task
    unmatched_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    lhs = left.join(marked, keys, "left").withColumn(
        "__salt", F.when(F.col("__hot") | unmatched_key, spread).otherwise(F.lit(0))).drop("__hot")
    copies = F.explode(F.when(F.col("__hot"), F.array(*[F.lit(i) for i in range(buckets)]))
                       .otherwise(F.array(F.lit(0))))
    rhs = right.join(marked, keys, "left").withColumn("__salt", copies).drop("__hot")
    joined = lhs.join(rhs, [*keys, "__salt"], "inner" if how == "inner" else "left").drop("__salt")
    if how != "full":
        return joined
    unmatched = right.join(left.select(*keys).distinct(), keys, "left_anti")
    return joined.unionByName(unmatched, allowMissingColumns=True)


# ------------------------------------------------------------------ ledgers and lookups
MATCH_STATUSES = ("MATCHED", "DURATION_MISMATCH", "MISSING_ON_OUR_SIDE", "MISSING_ON_THEIR_SIDE")


def tolerance_match(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], duration: str,
                    our_order: Sequence[str], their_order: Sequence[str], tolerance: float,
                    max_rows: int = S.MAX_GROUP_ROWS) -> DataFrame:
    """Pair the legs of two ledgers on their key and name the status of every leg.

    Legs with the same key are numbered on both sides by duration and paired by
    number, so a key with n legs on one side gives n pairs, not n times m. Both
    sides are stacked: one shuffle by the key serves the numbering and the pairing.
    Columns that are not keys come back as ``our_*`` and ``their_*``.
    """
    keys = list(keys)
    pos = F.coalesce(F.col(duration).cast("double"), F.lit(0.0))
    sides = []
    for n, (df, order, prefix) in enumerate(((ours, our_order, "our"), (theirs, their_order, "their"))):
        sides.append(df.select(
            *keys, F.lit(n).alias("__side"), pos.alias("__pos"), F.struct(*order).alias(f"__tie{n}"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in keys]))
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    payload = [c for c in stacked.columns if c not in keys and not c.startswith("__")]
    by_side = [*keys, "__side"]
    hot = S.find_hot(stacked, by_side, F.col("__pos"), max_rows)
    placed = stacked if hot else stacked.repartition(*[F.col(k) for k in keys])
    numbered = S.scan(placed, by_side, ["__pos", "__tie0", "__tie1"], [S.row_number("__leg")], hot, F.col("__pos"))
    pairs = numbered.groupBy(*keys, "__leg").agg(
        F.max(F.col("__side") == 0).alias("__ours"), F.max(F.col("__side") == 1).alias("__theirs"),
        *[F.max(c).alias(c) for c in payload])
    close = F.abs(F.col(f"our_{duration}") - F.col(f"their_{duration}")) <= tolerance
    status = (F.when(~F.col("__ours"), "MISSING_ON_OUR_SIDE").when(~F.col("__theirs"), "MISSING_ON_THEIR_SIDE")
              .when(close, "MATCHED").otherwise("DURATION_MISMATCH"))
    return pairs.withColumn("match_status", status).drop("__leg", "__ours", "__theirs")


def convert_currency(df: DataFrame, rates: DataFrame, amount: str, currency: str, out: str) -> DataFrame:
    """Amount times the rate of its currency; the missing rate stays visible in ``rate_missing``."""
    joined = df.join(broadcast_if_small(rates), currency, "left")
    return (joined.withColumn("rate_missing", F.col("rate").isNull())
            .withColumn(out, F.round(F.col(amount) * F.coalesce(F.col("rate"), F.lit(1)), 5)).drop("rate"))


def map_codes(df: DataFrame, mapping: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their mapped name, and the unmapped codes with their counts."""
    lookup = broadcast_if_small(mapping)
    return df.join(lookup, code), df.join(lookup, code, "left_anti").groupBy(code).agg(
        F.count("*").alias("rows"))


def compare_states(published: DataFrame, restated: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Signed and relative drift of a value per key between two states with unique keys."""
    p = published.select(*keys, F.col(value).alias("published"), F.lit(None).cast(
        restated.schema[value].dataType).alias("restated"))
    r = restated.select(*keys, F.lit(None).cast(published.schema[value].dataType).alias("published"),
                        F.col(value).alias("restated"))
    one = p.unionByName(r).groupBy(*keys).agg(F.max("published").alias("published"), F.max("restated").alias("restated"))
    drift = F.col("restated") - F.col("published")
    return one.withColumn("drift_amount", drift).withColumn(
        "drift_pct", F.try_divide(drift.cast("double"), F.abs(F.col("published")).cast("double")))


def within_hours_before(grid: DataFrame, events: DataFrame, keys: Sequence[str], slot: str, ts: str,
                        hours: int) -> DataFrame:
    """Hourly grid rows in the ``hours`` up to each event: the event is spread over its hours, then joined by equality."""
    spread = events.withColumn(slot, F.explode(F.expr(
        f"sequence(date_trunc('hour', {ts}) - INTERVAL {int(hours)} HOURS, date_trunc('hour', {ts}), INTERVAL 1 HOUR)")))
    inside = (F.col(slot) >= F.col(ts) - F.expr(f"INTERVAL {int(hours)} HOURS")) & (F.col(slot) <= F.col(ts))
    return grid.join(spread.where(inside), [*keys, slot])
