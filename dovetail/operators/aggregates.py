"""Aggregation operators shared by the roll-up and report jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_grain(df: DataFrame, keys: list[str], amount: str, out: str | None = None) -> DataFrame:
    """Collapse detail rows to one row per ``keys`` keeping ``max(amount)``
    (an order-level amount repeated on each detail line). Partial aggregation
    happens map-side, so a hot key never ships its raw rows."""
    return df.groupBy(*keys).agg(F.max(amount).alias(out or amount))


def recent_days(df: DataFrame, keys: list[str], measures: dict[str, Column], run_date: str,
                windows: tuple[int, ...] = (7, 30), dt_col: str = "dt") -> DataFrame:
    """N-day roll-ups in one scan: rows of the widest window are fanned out to
    every window they fall in (``explode``), then grouped once by
    ``recent_days`` + keys. The widest-window date filter sits below the
    explode so it reaches the scan."""
    widest = max(windows)
    d = F.lit(run_date).cast("date")
    base = df.where((F.col(dt_col).cast("date") > F.date_sub(d, widest)) & (F.col(dt_col).cast("date") <= d))
    fan = base.withColumn("recent_days", F.explode(F.array(*[F.lit(w) for w in windows])))
    fan = fan.where(F.col(dt_col).cast("date") >= F.date_add(d, 1 - F.col("recent_days")))
    return fan.groupBy("recent_days", *keys).agg(*[c.alias(n) for n, c in measures.items()])


def union_group(parts: list[DataFrame], keys: list[str], agg: str = "sum") -> DataFrame:
    """Merge metric sets that share ``keys`` (the full-outer-join chain of the
    reports) as one union + one grouped aggregation: one shuffle instead of a
    shuffle per join, no null-key fan-out. Metrics absent from a part are
    null there; ``sum``/``max`` ignore the nulls. A metric is null in the
    result when no part carried it for that key."""
    metrics: list[str] = []
    for p in parts:
        metrics += [c for c in p.columns if c not in keys and c not in metrics]
    aligned = [p.select(*keys, *[(F.col(m) if m in p.columns else F.lit(None)).alias(m) for m in metrics])
               for p in parts]
    u = reduce(lambda a, b: a.unionByName(b), aligned)
    fn = getattr(F, agg)
    return u.groupBy(*keys).agg(*[fn(m).alias(m) for m in metrics])


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; null when the denominator is 0 or null.

    Left unrounded: decimal rounding of a binary quotient is not portable
    between engines, the IEEE quotient of the same two doubles is.
    """
    return F.try_divide(num.cast("double"), den.cast("double"))
