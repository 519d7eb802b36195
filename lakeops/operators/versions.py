"""Version logs: read as of a version or a time, roll back, tag, branch, expire.

A log has one row per change: ``commit_id, committed_at, branch, op`` (``upsert``
or ``delete``), the key columns and the payload. A commit table has one row per
commit: ``commit_id, parent_id, committed_at, operation``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.setops import table_diff
from lakeops.operators.windows import latest_wins
from lakeops.session import ensure_checkpoint_dir

META = ("commit_id", "committed_at", "branch", "op")
MAIN = "main"


class NoSuchVersion(LookupError):
    """The asked version never existed, lies before the first commit, or was expired."""


def on_branch(log: DataFrame, branch: str = MAIN) -> DataFrame:
    """Rows a reader of the branch sees: the main line, and the branch's own rows."""
    return log.where(F.col("branch").isin(MAIN, branch))


def as_of_version(log: DataFrame, keys: Sequence[str], version: int | Column, branch: str = MAIN,
                  order: Sequence[str] = ()) -> DataFrame:
    """State after commit ``version``: newest row per key, deletes dropped.

    Within a commit ``order`` decides which row of a key is the newest.
    """
    seen = on_branch(log, branch).where(F.col("commit_id") <= version)
    last = latest_wins(seen, keys, [F.col("commit_id").desc(), *[F.col(c).desc() for c in order]])
    return last.where(F.col("op") != "delete").drop(*META)


def commit_before(log: DataFrame, when: str) -> int:
    """Newest commit strictly older than ``when``; raises before the first one."""
    got = log.where(F.col("branch") == MAIN).where(F.col("committed_at") < F.lit(when).cast("timestamp")) \
        .agg(F.max("commit_id").alias("v")).first()["v"]
    if got is None:
        raise NoSuchVersion(f"no commit older than {when}")
    return got


def as_of_time(log: DataFrame, keys: Sequence[str], when: str, order: Sequence[str] = ()) -> DataFrame:
    return as_of_version(log, keys, commit_before(log, when), order=order)


def commit_summary(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Per commit: keys added, updated and deleted, and the live keys after it."""
    last = latest_wins(log.where(F.col("branch") == MAIN), [*keys, "commit_id"],
                       [F.col(c).desc() for c in order] or [F.col("op").desc()])
    # a key has one row per commit here, so its window holds at most the number of commits
    was = F.lag("op").over(Window.partitionBy(*keys).orderBy("commit_id"))
    live_before = F.coalesce(was == "upsert", F.lit(False))
    moves = last.select("commit_id", "committed_at", "op", live_before.alias("live"))
    up, down = F.col("op") == "upsert", F.col("op") == "delete"
    per = moves.groupBy("commit_id", "committed_at").agg(
        F.count_if(up & ~F.col("live")).alias("added"), F.count_if(up & F.col("live")).alias("updated"),
        F.count_if(down & F.col("live")).alias("deleted"))
    running = Window.partitionBy(F.lit(0)).orderBy("commit_id").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("live_keys", F.sum(F.col("added") - F.col("deleted")).over(running))


def ancestors(commits: DataFrame, head: int) -> DataFrame:
    """Commits on the parent chain of ``head``, found in log2(depth) joins."""
    spark = commits.sparkSession
    ensure_checkpoint_dir(spark)
    jump = commits.where(F.col("parent_id").isNotNull()).select(
        F.col("commit_id").alias("a"), F.col("parent_id").alias("b"))
    found = commits.where(F.col("commit_id") == head).select("commit_id")
    size = 0
    while True:
        found = found.checkpoint()
        now = found.count()
        if now == size:
            return found
        size = now
        further = found.join(jump, F.col("commit_id") == F.col("a")).select(F.col("b").alias("commit_id"))
        found = found.union(further).distinct()
        jump = (jump.alias("x").join(jump.alias("y"), F.col("x.b") == F.col("y.a"))
                .select(F.col("x.a").alias("a"), F.col("y.b").alias("b"))).checkpoint()


def with_rollback(commits: DataFrame, target: int) -> DataFrame:
    """Commit table after a rollback: a new head whose parent is ``target``."""
    if commits.where(F.col("commit_id") == target).isEmpty():
        raise NoSuchVersion(f"commit {target} does not exist")
    new = commits.agg((F.max("commit_id") + 1).alias("commit_id"),
                      F.lit(target).cast(commits.schema["parent_id"].dataType).alias("parent_id"),
                      (F.max("committed_at") + F.expr("INTERVAL 1 SECOND")).alias("committed_at"),
                      F.lit("rollback").alias("operation"))
    return commits.unionByName(new)


def abandoned(commits: DataFrame, head: int) -> DataFrame:
    """Commits that are not on the chain of the current head."""
    return commits.join(ancestors(commits, head), "commit_id", "left_anti")


def set_current(pointers: DataFrame, branch: str, commit_id: int) -> DataFrame:
    """Pointer table (branch, commit_id) after moving one branch to a chosen commit."""
    return pointers.withColumn("commit_id", F.when(F.col("branch") == branch, F.lit(commit_id))
                               .otherwise(F.col("commit_id")).cast("bigint"))


def read_tag(log: DataFrame, keys: Sequence[str], tags: DataFrame, name: str,
             order: Sequence[str] = ()) -> DataFrame:
    """State pinned by a named tag."""
    row = tags.where(F.col("tag") == name).select("commit_id").first()
    if row is None:
        raise NoSuchVersion(f"no tag {name}")
    return as_of_version(log, keys, row["commit_id"], order=order)


def publish(log: DataFrame, branch: str) -> DataFrame:
    """The branch's rows become part of the main line."""
    return log.withColumn("branch", F.when(F.col("branch") == branch, F.lit(MAIN)).otherwise(F.col("branch")))


def discard(log: DataFrame, branch: str) -> DataFrame:
    return log.where(F.col("branch") != branch)


def retained_points(commits: DataFrame, older_than: str, keep_last: int, tags: DataFrame | None = None) -> list[int]:
    """Horizon and tagged commits that stay readable after expiry; the horizon comes last.

    The horizon is the newest commit that is older than the time and not among the
    last ``keep_last``. At most one entry per tag comes back to the driver.
    """
    newest = commits.orderBy(F.col("commit_id").desc()).limit(keep_last).agg(F.min("commit_id").alias("c"))
    oldest_kept = newest.first()["c"]
    old = commits.where((F.col("committed_at") < F.lit(older_than).cast("timestamp"))
                        & (F.col("commit_id") <= oldest_kept))
    horizon = old.agg(F.max("commit_id").alias("c")).first()["c"]
    if horizon is None:
        return []
    tagged = [] if tags is None else [
        r["commit_id"] for r in tags.where(F.col("commit_id") < horizon).select("commit_id").distinct().collect()]
    return sorted({*tagged, horizon})


def expire(log: DataFrame, keys: Sequence[str], points: Sequence[int], order: Sequence[str] = ()) -> DataFrame:
    """Fold the log up to the horizon so that only the retained points stay readable.

    Each old row is filed under the first retained point at or after it and only
    the newest row per key and point is kept.
    """
    if not points:
        return log
    horizon = points[-1]
    point = F.element_at(F.filter(F.array(*[F.lit(p) for p in points]),
                                  lambda p: p >= F.col("commit_id")), 1)
    old = log.where((F.col("commit_id") <= horizon) & (F.col("branch") == MAIN)).withColumn("__point", point)
    kept = latest_wins(old, [*keys, "__point"], [F.col("commit_id").desc(), *[F.col(c).desc() for c in order]])
    # nothing lies before the first point, so a delete there has nothing left to hide
    kept = kept.where(~((F.col("op") == "delete") & (F.col("__point") == points[0]))).drop("__point")
    return kept.unionByName(log.where((F.col("commit_id") > horizon) | (F.col("branch") != MAIN)))


def require_readable(version: int, points: Sequence[int]) -> int:
    """Raise for a version that expiry has folded away."""
    if points and version < points[-1] and version not in points:
        raise NoSuchVersion(f"version {version} was expired")
    return version


def changed_between(log: DataFrame, keys: Sequence[str], before: int, after: int,
                    order: Sequence[str] = ()) -> DataFrame:
    return table_diff(as_of_version(log, keys, before, order=order),
                      as_of_version(log, keys, after, order=order), keys)


def bitemporal_balance(log: DataFrame, keys: Sequence[str], known_at: int, account: Sequence[str],
                       event_time: str, cutoff: str, signed: Column, order: Sequence[str] = ()) -> DataFrame:
    """Balance as known at a version and as restated now, for events up to one cutoff."""
    upto = F.col(event_time) <= F.lit(cutoff).cast("timestamp")
    known = as_of_version(log, keys, known_at, order=order).where(upto).select(
        *account, signed.alias("k"), F.lit(None).cast("decimal(18,2)").alias("r"))
    now = as_of_version(log, keys, F.lit(1 << 60), order=order).where(upto).select(
        *account, F.lit(None).cast("decimal(18,2)").alias("k"), signed.alias("r"))
    both = known.unionByName(now).groupBy(*account).agg(F.sum("k").alias("as_known"), F.sum("r").alias("as_restated"))
    return both.withColumn("late_impact", F.coalesce("as_restated", F.lit(0)) - F.coalesce("as_known", F.lit(0)))
