"""Per-key latest row and the slowly-changing (zipper) dimension merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key in descending ``order`` (ties broken by the later
    order columns). Planned as an aggregate with ``max_by`` over a struct,
    so partial aggregation collapses each key map-side: a key holding a third
    of the rows costs one struct per task, not a sorted partition."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order_cols)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in rest])


def zipper_merge(history: DataFrame, changes: DataFrame, key: str, run_date: str,
                 start: str = "start_date", end: str = "end_date", open_end: str = "9999-12-31",
                 order: list[str] | None = None) -> DataFrame:
    """Daily SCD2 merge; running it again for the same day changes nothing.

    ``history`` holds versions with [start, end]; ``changes`` the rows that are
    new or changed on ``run_date``, of which each key keeps the last by
    ``order`` (all columns by default). What an earlier run for the day opened
    is taken back first, and what it closed is open again. Then open versions
    of changed keys close the day before ``run_date`` and the changed rows
    open on it. One left join on the key against the day's change set (no
    per-key sort), so a key with many versions does not serialise into one task.
    """
    before = F.date_format(F.date_sub(F.lit(run_date).cast("date"), 1), "yyyy-MM-dd")
    last = latest_per_key(changes, [key], order or [c for c in changes.columns if c not in (key, start, end)])
    changed = last.select(F.col(key).alias("__ck"), F.lit(True).alias("__chg"))
    undone = history.where(F.col(start) == run_date).select(F.col(key).alias("__ck"), F.lit(True).alias("__undo"))
    touched = changed.join(undone.distinct(), "__ck", "full_outer")
    h = history.where(~F.col(start).eqNullSafe(F.lit(run_date))).join(touched, F.col(key) == F.col("__ck"), "left")
    was = F.when(F.col("__undo") & (F.col(end) == before), F.lit(open_end)).otherwise(F.col(end))
    now = F.when((was == open_end) & F.col("__chg"), before).otherwise(was)
    closed = h.select(*[now.alias(end) if c == end else F.col(c) for c in history.columns])
    opened = last.select(*[F.lit(run_date).alias(start) if c == start else
                           F.lit(open_end).alias(end) if c == end else F.col(c) for c in history.columns])
    return closed.unionByName(opened)
