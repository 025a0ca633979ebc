"""Join operators: decode, parent walk, interval join, column merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """A side that is usually small. Whether it is broadcast is left to the
    session's ``autoBroadcastJoinThreshold`` (by its size in the plan) and to
    adaptive execution (by its size in the shuffle); no hint overrides them."""
    return df


def decode(df: DataFrame, code: str | Column, dic: DataFrame, out: str, how: str = "left",
           key: str = "id", name: str = "name", default: str | None = None, unique: bool = False) -> DataFrame:
    """Look a code up in a dictionary ``dic(key, name)`` and add column ``out``.

    The dictionary is de-duplicated on ``key`` first (first-match semantics),
    so a decode never multiplies rows; ``unique=True`` skips that step for
    dictionaries whose keys are distinct by construction. Repeated calls with
    the same ``dic`` decode the same dictionary under different roles.
    """
    code_col = F.col(code) if isinstance(code, str) else code
    k = f"__k_{out}"
    if unique:
        d = dic.select(F.col(key).alias(k), F.col(name).alias(out))
    else:
        d = dic.groupBy(F.col(key).alias(k)).agg(F.min(name).alias(out))
    res = df.join(maybe_broadcast(d), code_col.cast("string") == F.col(k), how).drop(k)
    if default is not None:
        res = res.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return res


def hierarchy(df: DataFrame, key: str, tree: DataFrame, levels: list[str],
              id_col: str = "id", parent_col: str = "parent_id", name_col: str = "name") -> DataFrame:
    """Walk a parent chain a fixed number of steps.

    ``levels = ["city", "province"]`` adds ``city_id, city_name, province_id,
    province_name``: the parent of ``key``, then its parent. The node row of
    ``key`` gives the first parent id; each level's own row gives its name and
    the next parent id -- ``1 + len(levels)`` left joins against the (small,
    broadcast when bounded) tree.
    """
    t = maybe_broadcast(tree.select(id_col, parent_col, name_col))
    first = t.select(F.col(id_col).alias("__k0"), F.col(parent_col).alias(f"{levels[0]}_id"))
    out = df.join(first, F.col(key) == F.col("__k0"), "left").drop("__k0")
    for i, lvl in enumerate(levels):
        cols = [F.col(id_col).alias(f"__n_{lvl}"), F.col(name_col).alias(f"{lvl}_name")]
        if i + 1 < len(levels):
            cols.append(F.col(parent_col).alias(f"{levels[i + 1]}_id"))
        out = out.join(t.select(*cols), F.col(f"{lvl}_id") == F.col(f"__n_{lvl}"), "left").drop(f"__n_{lvl}")
    return out


def interval_join(left: DataFrame, right: DataFrame, key: str | list[str], l_ts: str, r_ts: str,
                  lower: str, upper: str, how: str = "inner") -> DataFrame:
    """Rows of ``right`` whose ``r_ts`` lies in ``[l_ts + lower, l_ts + upper]``
    for the same key. ``lower``/``upper`` are interval literals such as
    ``"-30 minutes"`` / ``"5 seconds"``. Works for batch and for streams with
    watermarks on both time columns (the range then bounds the join state).
    Key columns of ``right`` must be renamed by the caller when they collide.
    """
    keys = [key] if isinstance(key, str) else key
    cond = None
    for k in keys:
        c = F.col(f"l.{k}") == F.col(f"r.{k}")
        cond = c if cond is None else cond & c
    rng = ((F.col(f"r.{r_ts}") >= F.col(f"l.{l_ts}") + F.expr(f"INTERVAL {_iv(lower)}"))
           & (F.col(f"r.{r_ts}") <= F.col(f"l.{l_ts}") + F.expr(f"INTERVAL {_iv(upper)}")))
    return left.alias("l").join(right.alias("r"), cond & rng, how)


def asof_lookup(rows: DataFrame, versions: DataFrame, key: str, at: str, out: str,
                code: str = "code", name: str = "name", since: str = "since") -> DataFrame:
    """Each row with the name its code had at its time: of the versions (code,
    name, since) the last one that is not later. A version holds until the next
    one of its code, so the lookup is an equi-join on the code with a range:
    rows are neither sorted nor grouped by code, and a hot code stays spread."""
    nxt = F.lead(since).over(Window.partitionBy(code).orderBy(since))
    v = versions.select(F.col(code).alias("__code"), F.col(name).alias(out), F.col(since).alias("__since"), nxt.alias("__until"))
    now = F.col(at)
    cond = (F.col(key) == F.col("__code")) & (now >= F.col("__since")) & (F.col("__until").isNull() | (now < F.col("__until")))
    return rows.join(v, cond, "left").drop("__code", "__since", "__until")


def binned_interval_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, before_ms: int, after_ms: int) -> DataFrame:
    """Rows with equal ``key`` and ``r_ts`` in [l_ts - before_ms, l_ts + after_ms]
    (both epoch millis), as an equi-join on (key, bin): bins are as wide as the
    interval, a left row lies in one, a right row is dealt to the one or two
    whose left rows can reach it. A key with very many rows is spread over its
    bins instead of meeting in one task."""
    width = max(before_ms + after_ms, 1)
    low, high = F.col(r_ts) - after_ms, F.col(r_ts) + before_ms
    lf = left.withColumn("__bin", F.floor(F.col(l_ts) / width))
    rt = right.withColumn("__bin", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))))
    j = lf.alias("l").join(rt.alias("r"), (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l.__bin") == F.col("r.__bin"))
                           & F.col(f"r.{r_ts}").between(F.col(f"l.{l_ts}") - before_ms, F.col(f"l.{l_ts}") + after_ms))
    return j.select(*[F.col(f"l.`{c}`") for c in left.columns], *[F.col(f"r.`{c}`") for c in right.columns if c != key])


def _iv(text: str) -> str:
    """``"-30 minutes"`` -> ``'-30' MINUTE`` (interval literal body)."""
    n, unit = text.split()
    return f"'{n}' {unit.rstrip('s').upper()}"


def prefixed(df: DataFrame, prefix: str, keep: list[str] = ()) -> DataFrame:
    """Rename every column but ``keep`` to ``prefix + name`` (join-side tagging)."""
    return df.select([F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def overlay(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join and merge columns of equal name: the right value wins when not null."""
    shared = [c for c in right.columns if c in left.columns and c not in on]
    l2 = left.select([F.col(c).alias(f"__l_{c}") if c in shared else F.col(c) for c in left.columns])
    j = l2.join(right, on, how)
    return j.select([F.coalesce(F.col(c), F.col(f"__l_{c}")).alias(c) if c in shared else F.col(c)
                     for c in left.columns] + [c for c in right.columns if c not in left.columns])
