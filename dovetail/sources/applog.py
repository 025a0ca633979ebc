"""Application log records (JSON text) derived from ``events``.

Per event: ``common`` (uid, mid = 'mid_' + user, is_new = 1 for sign-ups, os by
value), ``ts`` in millis, and by type: sign-up -> ``start``; view -> ``page``
+ two ``displays``; click -> ``page`` + one ``action``; error -> ``page`` +
``err``; other -> ``page``. Events with value below 0.5 arrive as truncated,
unparsable text (dirty records).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dovetail.functions.dates import epoch_ms

COMMON = T.StructType([T.StructField(n, T.StringType()) for n in ("uid", "mid", "is_new", "os")])
PAGE = T.StructType([T.StructField("page_id", T.StringType()), T.StructField("item", T.StringType())])
DISPLAY = T.StructType([T.StructField("item", T.StringType()), T.StructField("pos_id", T.IntegerType())])
ACTION = T.StructType([T.StructField("action_id", T.StringType()), T.StructField("item", T.StringType()),
                       T.StructField("ts", T.LongType())])
LOG = T.StructType([
    T.StructField("common", COMMON), T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(DISPLAY)), T.StructField("actions", T.ArrayType(ACTION)),
    T.StructField("start", T.StructType([T.StructField("entry", T.StringType())])),
    T.StructField("err", T.StructType([T.StructField("error_code", T.LongType()), T.StructField("msg", T.StringType())])),
    T.StructField("ts", T.LongType()),
])


def log_lines(events: DataFrame, *more) -> DataFrame:
    """``(event_id, line)`` and ``more`` columns for a batch or streaming events frame."""
    k = F.get_json_object("props", "$.k")
    ms = epoch_ms(F.col("ts"))
    et = F.col("event_type")
    common = F.struct(F.col("user_id").cast("string").alias("uid"),
                      F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
                      F.when(et == "signup", "1").otherwise("0").alias("is_new"),
                      F.when(F.col("value") < 10, "iOS").otherwise("Android").alias("os"))
    page = F.when(et != "signup", F.struct(et.alias("page_id"), k.alias("item")))
    displays = F.when(et == "view", F.array(F.struct(k.alias("item"), F.lit(1).alias("pos_id")),
                                            F.struct((k.cast("int") + 1).cast("string").alias("item"),
                                                     F.lit(2).alias("pos_id"))))
    actions = F.when(et == "click", F.array(F.struct(F.lit("cart_add").alias("action_id"), k.alias("item"),
                                                     (ms + 100).alias("ts"))))
    start = F.when(et == "signup", F.struct(F.lit("icon").alias("entry")))
    err = F.when(et == "error", F.struct(k.cast("bigint").alias("error_code"),
                                         F.concat(F.lit("failure "), k).alias("msg")))
    rec = F.struct(common.alias("common"), page.alias("page"), displays.alias("displays"), actions.alias("actions"),
                   start.alias("start"), err.alias("err"), ms.alias("ts"))
    dirty = F.concat(F.lit('{"common":{"mid":"mid_'), F.col("user_id").cast("string"), F.lit('"'))
    line = F.when(F.col("value") < 0.5, dirty).otherwise(F.to_json(rec))
    return events.select("event_id", line.alias("line"), *more)


def parse(lines: DataFrame) -> DataFrame:
    """Parse lines; unparsable text keeps its raw line in ``dirty``."""
    p = lines.select("event_id", "line", F.from_json("line", LOG).alias("r"))
    ok = F.col("r.ts").isNotNull() & F.col("r.common").isNotNull()
    return p.select("event_id", F.when(~ok, F.col("line")).alias("dirty"), F.when(ok, F.col("r")).alias("r"))


def split_log(parsed: DataFrame) -> dict[str, DataFrame]:
    """Six outputs of one parsed frame: err, start, display, action, page, dirty."""
    r = F.col("r")
    good = parsed.where(r.isNotNull())
    page_rec = good.where(r["start"].isNull())
    return {
        "err": good.where(r["err"].isNotNull()).select("event_id", r["err"]["error_code"].alias("error_code"),
                                                       r["err"]["msg"].alias("msg")),
        "start": good.where(r["start"].isNotNull()).select("event_id", r["common"]["mid"].alias("mid"),
                                                           r["start"]["entry"].alias("entry"), r["ts"].alias("ts")),
        "display": page_rec.select("event_id", r["common"]["mid"].alias("mid"), r["page"]["page_id"].alias("page_id"),
                                   F.explode(r["displays"]).alias("d"), r["ts"].alias("ts"))
                           .select("event_id", "mid", "page_id", F.col("d.item").alias("item"),
                                   F.col("d.pos_id").alias("pos_id"), "ts"),
        "action": page_rec.select("event_id", r["common"]["mid"].alias("mid"), r["page"]["page_id"].alias("page_id"),
                                  F.explode(r["actions"]).alias("a"), r["ts"].alias("ts"))
                          .select("event_id", "mid", "page_id", F.col("a.action_id").alias("action_id"),
                                  F.col("a.item").alias("item"), "ts"),
        "page": page_rec.select("event_id", r["common"]["mid"].alias("mid"), r["page"]["page_id"].alias("page_id"),
                                r["page"]["item"].alias("item"), r["ts"].alias("ts")),
        "dirty": parsed.where(F.col("dirty").isNotNull()).select("event_id", F.col("dirty").alias("raw")),
    }
