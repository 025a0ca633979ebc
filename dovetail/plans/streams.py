"""Streaming jobs. Each key drains a file stream over the driver tables (or
over envelopes Spark staged from them) with ``availableNow`` into a
checkpointed sink and returns the sink as a DataFrame. Oracles are the batch
equivalents; for append-mode aggregations only windows the final watermark
has closed are emitted, and the SQL keeps exactly those."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dovetail.functions.dates import epoch_ms
from dovetail.operators.joins import asof_lookup, interval_join, prefixed
from dovetail.plans.cdc import LINES, RDIC_SQL, T_ORDER, rdic
from dovetail.registry import query
from dovetail.sources import applog
from dovetail.sources import envelopes as E
from dovetail.sources.tables import load
from dovetail.streaming import operators as S
from dovetail.streaming.runner import ROWS_A_JOINING_CORE, SLICES, KeyedState, Topic, bounds, current, join_to_table, rows_a_part, \
    run_foreach_batch, run_to_table, slice_sql, stage
from dovetail.streaming.sinks import Change, Sink, SinkCatalog

TS_MS = "(epoch_us(ts) // 1000)"


def event_topic(spark, sf_dir, *cols):
    e = load(spark, sf_dir, "events").withColumn("ts_ms", epoch_ms(F.col("ts")))
    return Topic("events", e.select(*cols, "ts_ms") if cols else e, F.col("ts_ms"), source=(sf_dir, ("events",)))


def timed(s, delay="3 seconds"):
    return S.with_event_time(s, F.col("ts_ms"), delay)


# -- watermark / windows / dedup -------------------------------------------------------------------

@query("stream_watermark", f"""
    WITH w AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS ws FROM events)
    SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM w
    WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 3 SECOND
    GROUP BY ws, event_type""")
def stream_watermark(spark, sf_dir, **how):
    """Hourly counts per event type with a 3 s out-of-order bound; append mode
    emits a window once the watermark passes its end, later rows for it are
    dropped as late. Error records carry no millisecond field: their time
    falls back to the first item of a list of epoch seconds."""
    def plan(e):
        ms = F.when(F.col("event_type") != "error", epoch_ms(F.col("ts")))
        seconds_list = F.array((epoch_ms(F.col("ts")) / 1000).cast("bigint"))
        s = S.with_event_time(e, ms, "3 seconds", fallback=F.element_at(seconds_list, 1), fallback_in_seconds=True)
        return hourly(s)

    return run_to_table(spark, [event_topic(spark, sf_dir, "ts", "event_type")], plan, "watermark", **how)


def hourly(s):
    agg = s.groupBy(F.window("event_time", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return agg.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


# Every 20th event reaches the topic four days late: in a later slice, or in
# its own where that slice has not ended by then.
LATE_MS = 4 * 86_400_000


@query("stream_late_rows", f"""
    WITH e AS (SELECT {TS_MS} AS t, event_type, ts, event_id FROM events),
    a AS (SELECT *, CASE WHEN event_id % 20 = 0 THEN t + {LATE_MS} ELSE t END AS arrives FROM e),
    b AS (SELECT min(arrives) AS lo, max(arrives) AS hi FROM a),
    s AS (SELECT a.*, {slice_sql('arrives', 'lo', 'hi')} AS sl FROM a, b),
    marks AS (SELECT sl, max(t) OVER (ORDER BY sl) - 3000 AS mark FROM (SELECT sl, max(t) AS t FROM s GROUP BY sl)),
    kept AS (SELECT s.*, t // 3600000 * 3600000 AS ws FROM s LEFT JOIN marks ON marks.sl = s.sl - 1
             WHERE mark IS NULL OR t // 3600000 * 3600000 + 3600000 > mark)
    SELECT strftime(epoch_ms(ws), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM kept
    WHERE ws + 3600000 <= (SELECT max(mark) FROM marks) GROUP BY ws, event_type""")
def stream_late_rows(spark, sf_dir, **how):
    """Hourly counts where some events arrive days late: a row whose window
    the watermark has closed by the end of the slice before is dropped, every
    other row counts."""
    e = event_topic(spark, sf_dir, "ts", "event_type", "event_id")
    late = F.col("ts_ms") + F.when(F.col("event_id") % 20 == 0, LATE_MS).otherwise(0)
    topic = Topic("events-late", e.rows, e.at, arrives=late, source=e.source)
    return run_to_table(spark, [topic], lambda s: hourly(timed(s)), "late_rows", **how)


@query("stream_tumble_last", f"""
    WITH b AS (SELECT *, {TS_MS} // 120000 * 120000 AS ws FROM events)
    SELECT strftime(epoch_ms(ws), '%Y-%m-%d %H:%M:%S') AS window_start, user_id, event_id, event_type, value
    FROM b WHERE ws + 120000 <= (SELECT {TS_MS} - 3000 FROM events ORDER BY ts DESC LIMIT 1)
    QUALIFY row_number() OVER (PARTITION BY ws, user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_tumble_last(spark, sf_dir, **how):
    """Last event per user in each 2-minute tumbling window (event time)."""
    def plan(s):
        t = S.tumble_last(timed(s).select("user_id", "event_id", "event_type", "value", "event_time"),
                          "user_id", "event_time", "2 minutes")
        return t.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                        "user_id", "event_id", "event_type", "value")

    return run_to_table(spark, [event_topic(spark, sf_dir, "user_id", "event_id", "event_type", "value")], plan,
                        "tumble_last", **how)


@query("stream_dedup_exact", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def stream_dedup_exact(spark, sf_dir, **how):
    """Full-record duplicates (purchases are replayed by a second source)
    dropped per user by a hash of the whole record, over a horizon of a day."""
    cols = ["event_id", "user_id", "event_type", "value"]

    def plan(s):
        a = timed(s, "1 day")
        u = a.unionByName(a.where(F.col("event_type") == "purchase")).withColumn("rec_hash", S.record_hash(a, cols))
        return S.dedup(u, ["user_id", "rec_hash"]).select(*cols)

    return run_to_table(spark, [event_topic(spark, sf_dir, *cols)], plan, "dedup_exact", **how)


@query("stream_dedup_composite", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, ts_ms, status FROM (
        SELECT o_orderkey, {T_ORDER.replace('o_orderdate', 'o_orderdate')} AS ts_ms, '1001' AS status FROM orders
        UNION ALL SELECT o_orderkey, {T_ORDER} + 60000, '1002' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, {T_ORDER} + 120000, '1003' FROM orders
                  WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
        UNION ALL SELECT o_orderkey, {T_ORDER} + 180000, '1005' FROM orders
                  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT o_orderkey, {T_ORDER} + 240000, '1006' FROM orders
                  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') x""")
def stream_dedup_composite(spark, sf_dir, **how):
    """Order envelopes delivered twice (at-least-once relay) de-duplicated on
    (id, ts_ms) over a horizon of an hour: exact, where the reference's
    per-key Bloom filter is approximate."""
    env = E.of_table(E.order_envelopes(spark, sf_dir), "order_info").select(
        F.col("after")["id"].alias("id"), "ts_ms", F.col("after")["order_status"].alias("status"))

    def plan(s):
        a = timed(s, "1 hour")
        return S.dedup(a.unionByName(a), ["id", "ts_ms"]).select("id", "ts_ms", "status")

    topic = Topic("order-moves", env, F.col("ts_ms"), source=(sf_dir, ("orders",)))
    return run_to_table(spark, [topic], plan, "dedup_composite", **how)


BLOOM_RATE = 0.01


@query("stream_dedup_bloom", """
    SELECT 2 * count(*) AS delivered, count(*) AS distinct_rows, 0 AS kept_twice, 0 AS kept_unknown, TRUE AS rate_held FROM orders""")
def stream_dedup_bloom(spark, sf_dir, **how):
    """Snapshot envelopes of orders, each delivered a second time up to a year later,
    de-duplicated on ``id_ts`` through a Bloom filter: blocks of bits as state,
    as large as the number of orders and the rate ask for and no larger.
    Reports what was kept beside the exact key: no row twice, no row that was
    not delivered, and at most twice the rate of the new rows lost."""
    o = E.of_table(E.order_envelopes(spark, sf_dir), "order_info").where(F.col("op") == "r")
    o = o.select(F.col("after")["id"].alias("id"), "ts_ms")
    again = F.col("ts_ms") + F.pmod(F.xxhash64("id"), F.lit(365)) * 86_400_000
    sent = o.withColumn("sent_ms", F.col("ts_ms")).unionByName(o.withColumn("sent_ms", again))
    shape = S.bloom_shape(load(spark, sf_dir, "orders").count(), BLOOM_RATE)
    key = F.concat_ws("_", "id", "ts_ms")
    kept = _with_state(spark, Topic("order-twice", sent, F.col("ts_ms"), arrives=F.col("sent_ms")), "dedup_bloom", "block",
                       lambda b, st: S.bloom_new(b, st, key, shape), after=lambda rows, st: S.bloom_marked(rows, st, key, shape), **how)
    both = sent.select("id", "ts_ms", F.lit(1).alias("sent"), F.lit(0).alias("kept")).unionByName(
        kept.select("id", "ts_ms", F.lit(0).alias("sent"), F.lit(1).alias("kept")))
    g = both.groupBy("id", "ts_ms").agg(F.sum("sent").alias("sent"), F.sum("kept").alias("kept"))
    n = F.count(F.when(F.col("sent") > 0, 1))
    return g.agg(F.sum("sent").alias("delivered"), n.alias("distinct_rows"),
                 F.count(F.when(F.col("kept") > 1, 1)).alias("kept_twice"),
                 F.count(F.when(F.col("sent") == 0, 1)).alias("kept_unknown"),
                 (F.count(F.when(F.col("kept") == 0, 1)) <= 2 * BLOOM_RATE * n).alias("rate_held"))


# -- keyed state ---------------------------------------------------------------------------------------

def _with_state(spark, topic, name, key, step, drop=None, after=None, **how):
    """Drain a topic through ``step(batch, state) -> (rows, state of the batch's
    keys)``; state is stored as changes by batch, rows are returned as written.
    ``after(rows, state)``: the batch's state where its written rows tell it."""
    def write(batch: DataFrame, bid: int, out: str):
        store = KeyedState(os.path.join(out, "state"), key, drop=drop)
        stored = store.read(spark, bid)
        known = None if stored is None else stored.drop("__at")
        rows, state = step(batch, known)
        written = os.path.join(out, "rows", f"batch={bid}")
        rows.write.mode("overwrite").parquet(written)
        store.write(after(spark.read.schema(rows.schema).parquet(written), known) if after else state, bid)

    out = run_foreach_batch(spark, [topic], lambda s: s, name, write, **how)
    return spark.read.parquet(os.path.join(out, "rows")).drop("batch")


# An event's time as its device has it: every third clock is up to an hour slow.
CLOCK_TTL_MS = 3_600_000
CLOCK = "(ts_ms - CASE WHEN event_id % 3 = 0 THEN (event_id * 7919) % 3600000 ELSE 0 END)"


@query("stream_monotonic_filter", f"""
    WITH e AS (SELECT event_id, user_id, {CLOCK} AS clock FROM (SELECT event_id, user_id, {TS_MS} AS ts_ms FROM events))
    SELECT event_id, user_id, clock FROM (
        SELECT event_id, user_id, clock,
               max(clock) OVER (PARTITION BY user_id ORDER BY event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
        FROM e) x
    WHERE prior IS NULL OR clock > prior""")
def stream_monotonic_filter(spark, sf_dir, **how):
    """Per user, pass an event only when its time is later than that of every
    event that arrived before it (newest-only filter with keyed state). State
    is forgotten an hour after a user's newest time: clocks are at most that
    slow, so whatever arrives then is newer anyway and passes."""
    e = event_topic(spark, sf_dir, "event_id", "user_id")
    topic = Topic("events-clock", e.rows.select("event_id", "user_id", "ts_ms", F.expr(CLOCK).cast("bigint").alias("clock")), e.at,
                  source=e.source)

    def forget(state: DataFrame) -> DataFrame:
        newest = state.agg(F.max("clock").alias("__now"))
        return state.join(F.broadcast(newest), F.col("clock") >= F.col("__now") - CLOCK_TTL_MS).drop("__now")

    return _with_state(spark, topic, "monotonic", "user_id", lambda b, st: S.newest_only(
        b.select("event_id", "user_id", "clock"), st, "user_id", "event_id", "clock", ttl_ms=CLOCK_TTL_MS), drop=forget, **how)


@query("log_fix_is_new", f"""
    WITH e AS (SELECT event_id, 'mid_' || CAST(user_id AS VARCHAR) AS mid,
                      CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new, {TS_MS} AS ts_ms FROM events),
         f AS (SELECT mid, CASE WHEN is_new = '1' THEN strftime(epoch_ms(ts_ms), '%Y-%m-%d')
                                ELSE strftime(epoch_ms(ts_ms) - INTERVAL 1 DAY, '%Y-%m-%d') END AS first_day
               FROM e QUALIFY row_number() OVER (PARTITION BY mid ORDER BY ts_ms, event_id) = 1)
    SELECT e.event_id, e.mid, e.is_new,
           CASE WHEN e.is_new = '1' AND strftime(epoch_ms(e.ts_ms), '%Y-%m-%d') <> f.first_day THEN '0'
                ELSE e.is_new END AS fixed_is_new
    FROM e JOIN f ON e.mid = f.mid""")
def log_fix_is_new(spark, sf_dir, **how):
    """New-visitor flag repair on the log stream, keyed by device."""
    e = load(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"),
        epoch_ms(F.col("ts")).alias("ts_ms"))
    topic = Topic("log-visits", e, F.col("ts_ms"), source=(sf_dir, ("events",)))
    return _with_state(spark, topic, "is_new", "mid", S.repair_is_new, **how).drop("ts_ms")


# -- log split ------------------------------------------------------------------------------------------

DISPLAY_SQL = f"""
    SELECT event_id, 'mid_' || CAST(user_id AS VARCHAR) AS mid, event_type AS page_id,
           json_extract_string(props, '$.k') AS item, 1 AS pos_id, {TS_MS} AS ts
    FROM events WHERE event_type = 'view' AND value >= 0.5
    UNION ALL
    SELECT event_id, 'mid_' || CAST(user_id AS VARCHAR), event_type,
           CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS VARCHAR), 2, {TS_MS}
    FROM events WHERE event_type = 'view' AND value >= 0.5"""

ACTION_SQL = f"""
    SELECT event_id, 'mid_' || CAST(user_id AS VARCHAR) AS mid, event_type AS page_id, 'cart_add' AS action_id,
           json_extract_string(props, '$.k') AS item, {TS_MS} AS ts
    FROM events WHERE event_type = 'click' AND value >= 0.5"""

DIRTY_SQL = """SELECT event_id, '{"common":{"mid":"mid_' || CAST(user_id AS VARCHAR) || '"' AS raw
               FROM events WHERE value < 0.5"""


def split_batch(spark, sf_dir):
    return applog.split_log(applog.parse(applog.log_lines(load(spark, sf_dir, "events"))))


@query("log_split_display", DISPLAY_SQL)
def log_split_display(spark, sf_dir):
    """Display side output: one row per exposure, with common / page / ts."""
    return split_batch(spark, sf_dir)["display"]


@query("log_split_action", ACTION_SQL)
def log_split_action(spark, sf_dir):
    """Action side output; keeps ``ts`` (the reference drops it)."""
    return split_batch(spark, sf_dir)["action"]


@query("log_dirty", DIRTY_SQL)
def log_dirty(spark, sf_dir):
    """Unparsable records, raw text kept."""
    return split_batch(spark, sf_dir)["dirty"]


_PAGE_OK = "FROM events WHERE value >= 0.5 AND event_type"


@query("stream_log_split", f"""
    SELECT 'err' AS kind, event_id, 'failure ' || json_extract_string(props, '$.k') AS a, json_extract_string(props, '$.k') AS b
    {_PAGE_OK} = 'error'
    UNION ALL SELECT 'start', event_id, 'mid_' || CAST(user_id AS VARCHAR), 'icon' {_PAGE_OK} = 'signup'
    UNION ALL SELECT 'display', event_id, item, CAST(pos_id AS VARCHAR) FROM ({DISPLAY_SQL}) d
    UNION ALL SELECT 'action', event_id, item, action_id FROM ({ACTION_SQL}) a
    UNION ALL SELECT 'page', event_id, event_type, json_extract_string(props, '$.k') {_PAGE_OK} <> 'signup'
    UNION ALL SELECT 'dirty', event_id, raw, NULL FROM ({DIRTY_SQL}) x""")
def stream_log_split(spark, sf_dir, **how):
    """Log stream split into six outputs inside one ``foreachBatch``: the
    micro-batch is parsed once, persisted, and each output is written to its
    own folder keyed by batch id (a replayed batch overwrites itself). Returns
    two columns of content from each output."""
    e = load(spark, sf_dir, "events")
    lines = applog.log_lines(e, epoch_ms(F.col("ts")).alias("ts_ms"))

    def write(batch: DataFrame, bid: int, out: str):
        parsed = applog.parse(batch).persist()
        try:
            for kind, df in applog.split_log(parsed).items():
                df.write.mode("overwrite").parquet(os.path.join(out, kind, f"batch={bid}"))
        finally:
            parsed.unpersist()

    out = run_foreach_batch(spark, [Topic("log-lines", lines, F.col("ts_ms"), source=(sf_dir, ("events",)))], lambda s: s, "log_split",
                            write, **how)
    shown = {"err": ("msg", "error_code"), "start": ("mid", "entry"), "display": ("item", "pos_id"),
             "action": ("item", "action_id"), "page": ("page_id", "item"), "dirty": ("raw", None)}
    parts = [spark.read.parquet(os.path.join(out, kind)).select(
        F.lit(kind).alias("kind"), "event_id", F.col(a).cast("string").alias("a"),
        (F.col(b) if b else F.lit(None)).cast("string").alias("b")) for kind, (a, b) in shown.items()]
    return reduce(DataFrame.unionByName, parts)


# -- stream joins -------------------------------------------------------------------------------------

def _order_topic(spark, sf_dir, name, table, *cols, where=None):
    """Rows of one order-side change table, typed and cut to what a join reads."""
    env = E.of_table(E.order_envelopes(spark, sf_dir, tables={table}), table)
    return Topic(name, (env.where(where) if where is not None else env).select(*cols, "ts_ms"), F.col("ts_ms"),
                 source=(sf_dir, ("orders",)))


def _lines(spark, sf_dir, job, run=None):
    """Lines with their order's attributes, joined once for all topics of a job."""
    lines = E.order_lines(spark, sf_dir)
    return spark.read.schema(lines.schema).parquet(stage(spark, lines, f"lines-{job}", run))


def _detail_topic(spark, sf_dir, lines):
    a = F.col("after")
    env = E.of_table(E.line_envelopes(spark, sf_dir, tables={"order_detail"}, lines=lines,
                                      fields={"id", "order_id", "sku_id", "sku_num"}), "order_detail")
    return Topic("order-detail", env.select(
        a["order_id"].alias("k"), a["id"].alias("id"), a["sku_id"].cast("bigint").alias("sku_id"),
        a["sku_num"].cast("int").alias("sku_num"), "ts_ms"), F.col("ts_ms"), source=(sf_dir, ("lineitem", "orders")))


def _timed_as(s, name):
    return timed(s, "5 seconds").withColumnRenamed("event_time", name)


@query("stream_cancel_join", f"""
    SELECT line_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           CAST(l_quantity AS INTEGER) AS sku_num, {T_ORDER} + 120000 AS cancel_ts
    FROM ({LINES}) x WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'""")
def stream_cancel_join(spark, sf_dir, **how):
    """Cancellations (status 1001 -> 1003) ⋈ order details, both watermarked;
    details within [cancel - 30 min, cancel + 5 s], which also bounds the
    join state (the reference's 30 min + 5 s idle retention). The topics hold
    typed rows of the events the join reads, written once."""
    a = F.col("after")
    cancel = _order_topic(spark, sf_dir, "order-cancels", "order_info", a["id"].alias("k"), a["user_id"].cast("bigint").alias("user_id"),
                          where=(F.col("op") == "u") & (F.col("before")["order_status"] == "1001") & (a["order_status"] == "1003"))

    def plan(c, d):
        j = interval_join(_timed_as(c, "ct").withColumnRenamed("ts_ms", "cancel_ts"), _timed_as(d, "dt_"), "k", "ct", "dt_",
                          "-30 minutes", "5 seconds")
        return j.select(F.col("r.id").alias("id"), F.col("l.k").alias("order_id"), F.col("l.user_id").alias("user_id"),
                        F.col("r.sku_id").alias("sku_id"), F.col("r.sku_num").alias("sku_num"),
                        F.col("l.cancel_ts").alias("cancel_ts"))

    return run_to_table(spark, [cancel, _detail_topic(spark, sf_dir, _lines(spark, sf_dir, "cancel_join", how.get("run")))], plan,
                        "cancel_join", rows_a_part=rows_a_part(spark), **how)


@query("stream_pay_interval_join", f"""
    WITH d AS ({RDIC_SQL})
    SELECT line_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           '1103' AS payment_type, d.name AS payment_type_name,
           strftime(o_orderdate + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS callback_time
    FROM ({LINES}) x LEFT JOIN d ON d.id = '1103' WHERE o_orderstatus = 'F'""")
def stream_pay_interval_join(spark, sf_dir, **how):
    """Successful payments ⋈ details in [pay - 30 min, pay + 5 s] (asymmetric
    interval join on watermarked streams) + stream-static payment-type lookup."""
    a = F.col("after")
    pay = _order_topic(spark, sf_dir, "payments-done", "payment_info", a["order_id"].alias("k"), a["user_id"].cast("bigint").alias("user_id"),
                       a["payment_type"].alias("payment_type"), a["callback_time"].alias("callback_time"),
                       where=a["payment_status"] == "1602")
    d = rdic(spark).select(F.col("id").alias("__code"), F.col("name").alias("payment_type_name"))

    def plan(p, det):
        j = interval_join(_timed_as(p, "pt"), _timed_as(det, "dt_"), "k", "pt", "dt_", "-30 minutes", "5 seconds")
        return (j.select(F.col("r.id").alias("id"), F.col("l.k").alias("order_id"), F.col("l.user_id").alias("user_id"),
                         F.col("r.sku_id").alias("sku_id"), F.col("l.payment_type").alias("payment_type"),
                         F.col("l.callback_time").alias("callback_time"))
                 .join(F.broadcast(d), F.col("payment_type") == F.col("__code"), "left").drop("__code"))

    return run_to_table(spark, [pay, _detail_topic(spark, sf_dir, _lines(spark, sf_dir, "pay_join", how.get("run")))], plan,
                        "pay_join", rows_a_part=rows_a_part(spark), **how)


@query("interval_join_symmetric", """
    SELECT p.event_id, p.user_id, c.event_id AS info_event_id, c.value AS info_value
    FROM events p JOIN events c ON p.user_id = c.user_id AND c.event_type = 'click'
     AND c.ts >= p.ts - INTERVAL 5 MINUTE AND c.ts <= p.ts + INTERVAL 5 MINUTE
    WHERE p.event_type = 'purchase'""")
def interval_join_symmetric(spark, sf_dir, **how):
    """Purchases ⋈ the same user's clicks within ±5 minutes, right columns
    merged under an ``info_`` prefix. Both sides watermarked: state older
    than the bound is evicted."""
    def plan(e):
        s = timed(e)
        pur = s.where(F.col("event_type") == "purchase").select(F.col("user_id").alias("k"), "event_id", "event_time")
        clk = prefixed(s.where(F.col("event_type") == "click")
                       .select(F.col("user_id").alias("k"), "event_id", "value", "event_time"), "info_", keep=["k"])
        j = interval_join(pur, clk, "k", "event_time", "info_event_time", "-5 minutes", "5 minutes")
        return j.select(F.col("l.event_id").alias("event_id"), F.col("l.k").alias("user_id"),
                        F.col("r.info_event_id").alias("info_event_id"), F.col("r.info_value").alias("info_value"))

    return run_to_table(spark, [event_topic(spark, sf_dir, "user_id", "event_id", "event_type", "value")], plan,
                        "interval_sym", rows_a_part=rows_a_part(spark), **how)


# When the activity and the coupon of an order line are recorded,
# after the line: usually within seconds, for some lines past the bound.
_ACT_LATE, _CPN_LATE, _BOUND = "l_linenumber >= 5", "l_quantity > 45", "10 minutes"
_BOUND_MS, _DELAY_MS = 600_000, 5_000


def _split_topic(sf_dir, lines, name, where, late, value):
    """Activity or coupon records of order lines, as a topic of their own."""
    ts = epoch_ms(F.col("o_orderdate")) + F.col("l_linenumber") * 1000 + F.when(F.expr(late), 1_200_000).otherwise(4000)
    rows = lines.where(where).select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey").alias("k"), F.col(value).cast("bigint").alias("v"),
        ts.cast("bigint").alias("ts_ms"))
    return Topic(name, rows, F.col("ts_ms"), source=(sf_dir, ("lineitem", "orders")))


def with_heartbeat(spark, topics: list[Topic]) -> list[Topic]:
    """Each topic with one last record a day after all others, under a key (the
    first column) of its own: the watermark then passes everything before, so
    that every outer row comes out. (A null key would not do: joins filter it
    before the watermark sees the row.)"""
    lo, hi = bounds(spark, topics)
    out = []
    for t in topics:
        known = {"ts_ms": F.lit(hi + 86_400_000), t.rows.columns[0]: F.lit(f"last of {t.name}")}
        beat = spark.range(1).select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in t.rows.schema.fields])
        out.append(Topic(f"{t.name}-{hi}", t.rows.unionByName(beat), t.at, t.arrives, t.source, (lo, hi + 86_400_000)))
    return out


@query("stream_order_detail_wide", f"""
    SELECT x.line_id AS id, CAST(x.l_orderkey AS VARCHAR) AS order_id, x.o_custkey AS user_id, x.l_partkey AS sku_id,
           CAST(x.l_quantity AS INTEGER) AS sku_num, a.l_suppkey AS activity_id, c.l_partkey AS coupon_id, x.t AS ts_ms
    FROM ({LINES}) x
    LEFT JOIN (SELECT * FROM ({LINES}) y WHERE l_discount > 0.05 AND NOT ({_ACT_LATE})) a ON x.line_id = a.line_id
    LEFT JOIN (SELECT * FROM ({LINES}) z WHERE l_tax > 0.04 AND NOT ({_CPN_LATE})) c ON x.line_id = c.line_id""")
def stream_order_detail_wide(spark, sf_dir, **how):
    """Order details ⋈ orders ⟕ activities ⟕ coupons, four streams in a chain,
    all watermarked. A detail whose activity or coupon has not come within ten
    minutes comes out once, with null, when the watermark has passed the
    bound; a record that comes later finds no detail and is dropped. The bounds
    let each join forget its rows."""
    a = F.col("after")
    orders = _order_topic(spark, sf_dir, "orders-read", "order_info", a["id"].alias("k"),
                          a["user_id"].cast("bigint").alias("user_id"), where=F.col("op") == "r")
    lines = _lines(spark, sf_dir, "detail_wide", how.get("run"))
    topics = with_heartbeat(spark, [
        _detail_topic(spark, sf_dir, lines), orders,
        _split_topic(sf_dir, lines, "detail-activity", "l_discount > 0.05", _ACT_LATE, "l_suppkey"),
        _split_topic(sf_dir, lines, "detail-coupon", "l_tax > 0.04", _CPN_LATE, "l_partkey")])

    def plan(frames, before, now):
        det, o, act, cou = frames
        d = _timed_as(det, "t_d").withColumnsRenamed({"k": "order_id", "__new": "d_new"})
        o, act, cou = (_timed_as(x.withColumnRenamed("__new", "new"), f"t_{n}").select(
            *[F.col(c).alias(f"{n}_{c}") for c in x.withColumnRenamed("__new", "new").columns if c != "ts_ms"], f"t_{n}")
            for n, x in (("o", o), ("a", act), ("c", cou)))
        bound = F.expr(f"INTERVAL {_BOUND}")
        j = d.join(o, (F.col("order_id") == F.col("o_k")) & F.col("t_o").between(F.col("t_d") - bound, F.col("t_d")))
        for n in ("a", "c"):
            right = act if n == "a" else cou
            j = j.join(right, (F.col("id") == F.col(f"{n}_k")) & F.col(f"t_{n}").between(F.col("t_d"), F.col("t_d") + bound), "left")
        j = S.newly_known(j, ["d_new", "o_new"], {f"{n}_new": F.col("t_d") + bound for n in ("a", "c")}, before, now)
        return j.select("id", "order_id", F.col("o_user_id").alias("user_id"), "sku_id", "sku_num",
                        F.col("a_v").alias("activity_id"), F.col("c_v").alias("coupon_id"), "ts_ms")

    return join_to_table(spark, topics, plan, "detail_wide", _DELAY_MS, 2 * _BOUND_MS, rows_a_part=rows_a_part(spark, ROWS_A_JOINING_CORE), **how)


# -- snapshot phase -----------------------------------------------------------------------------------

SILENCE = "15 seconds"


@query("stream_snapshot_end", f"""
    WITH e AS (
        SELECT 'order_info' AS tbl, {T_ORDER} AS t, TRUE AS snap FROM orders
        UNION ALL SELECT 'order_info', {T_ORDER} + 60000, FALSE FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'order_info', {T_ORDER} + 120000, FALSE FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
        UNION ALL SELECT 'order_info', {T_ORDER} + 180000, FALSE FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'order_info', {T_ORDER} + 240000, FALSE FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'order_detail', t, TRUE FROM ({LINES}) x
        UNION ALL SELECT 'cart_info', t, l_linestatus = 'F' FROM ({LINES}) x
        UNION ALL SELECT 'cart_info', t + 60000, FALSE FROM ({LINES}) x WHERE l_returnflag = 'R'
        UNION ALL SELECT 'cart_info', t + 120000, FALSE FROM ({LINES}) x WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
    g AS (SELECT *, t - lag(t) OVER (PARTITION BY tbl ORDER BY t) > 15000 AS cut FROM e),
    n AS (SELECT *, count(*) FILTER (cut) OVER (PARTITION BY tbl ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM g)
    SELECT tbl, min(t) AS began_ms, coalesce(min(t) FILTER (NOT snap), max(t) + 15000) AS ended_ms,
           CASE WHEN count(*) FILTER (NOT snap) > 0 THEN 'live row' ELSE 'silence' END AS reason
    FROM n WHERE session = 0 GROUP BY tbl""")
def stream_snapshot_end(spark, sf_dir, **how):
    """End of each table's snapshot phase: its first live row, or 15 seconds
    without any row. A session window is the silence timer: it stays open while
    rows keep coming and closes when the watermark is that far past the last
    one; rows of a task are combined before they meet, so a busy table is no
    bottleneck. The first session of a table is its snapshot phase."""
    env = E.envelopes(spark, sf_dir, ["order_info", "order_detail", "cart_info"])
    rows = env.select(F.col("source")["table"].alias("tbl"), (F.col("op") == "r").alias("snap"), "ts_ms")

    def plan(s):
        g = timed(s).groupBy("tbl", F.session_window("event_time", SILENCE).alias("w")).agg(
            F.min("ts_ms").alias("began_ms"), F.min(F.when(~F.col("snap"), F.col("ts_ms"))).alias("live_ms"))
        return g.select("tbl", "began_ms", "live_ms", F.unix_millis("w.end").alias("silent_ms"))

    sessions = run_to_table(spark, [Topic("table-activity", rows, F.col("ts_ms"), source=(sf_dir, ("lineitem", "orders")))], plan,
                            "snapshot_end", **how)
    first = sessions.groupBy("tbl").agg(F.min_by(F.struct("began_ms", "live_ms", "silent_ms"), "began_ms").alias("f"))
    return first.select("tbl", "f.began_ms", F.coalesce("f.live_ms", "f.silent_ms").alias("ended_ms"),
                        F.when(F.col("f.live_ms").isNull(), "silence").otherwise("live row").alias("reason"))


def _comment_topic(spark, sf_dir):
    a = F.col("after")
    c = E.comment_envelopes(spark, sf_dir).select(a["id"].cast("bigint").alias("id"), a["appraise"].alias("appraise"), "ts_ms")
    return Topic("comment-codes", c, F.col("ts_ms"), source=(sf_dir, ("documents", "orders")))


_COMMENT_CODES = """SELECT doc_id AS id, '120' || CAST(CAST(trunc(least(n_chars / 2000, 3)) AS INTEGER) + 1 AS VARCHAR)
                           AS appraise FROM documents"""


@query("stream_lookup_join", f"""
    WITH d AS ({RDIC_SQL})
    SELECT c.id, c.appraise, d.name AS appraise_name FROM ({_COMMENT_CODES}) c JOIN d ON md5(c.appraise) = md5(d.id)""")
def stream_lookup_join(spark, sf_dir, **how):
    """Comments ⋈ appraise dictionary at processing time (stream-static inner
    join). The dictionary is keyed by ``md5(code)`` as in the row store; the
    stream hashes its code for the join and keeps the plain code."""
    d = rdic(spark).select(F.md5("id").alias("row_key"), F.col("name").alias("appraise_name"))
    return run_to_table(spark, [_comment_topic(spark, sf_dir)], lambda s: s.join(
        F.broadcast(d), F.md5("appraise") == F.col("row_key")).select("id", "appraise", "appraise_name"), "lookup_inner", **how)


@query("stream_lookup_left", f"""
    WITH d AS ({RDIC_SQL})
    SELECT c.id, c.appraise, coalesce(d.name, 'N/A') AS appraise_name FROM ({_COMMENT_CODES}) c
    LEFT JOIN d ON c.appraise = d.id""")
def stream_lookup_left(spark, sf_dir, **how):
    """Cached asynchronous lookup re-expressed as a broadcast left join: a miss
    yields ``N/A``; no per-row remote call, no cache to expire."""
    d = rdic(spark).select(F.col("id").alias("__code"), F.col("name").alias("appraise_name"))
    return run_to_table(spark, [_comment_topic(spark, sf_dir)], lambda s: s.join(
        F.broadcast(d), F.col("appraise") == F.col("__code"), "left").select(
        "id", "appraise", F.coalesce("appraise_name", F.lit("N/A")).alias("appraise_name")), "lookup_left", **how)


# Changes of the appraise dictionary (code, name, from this time, delivered before slice).
RENAMES = [("1201", "good", 0, 0), ("1202", "average", 0, 0), ("1203", "poor", 0, 0), ("1201", "very good", 820_454_400_000, 1),
           ("1203", "bad", 915_148_800_000, 2), ("1204", "new code", 915_148_800_000, 2)]
_RENAMES_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{n}', {t}, {i})" for c, n, t, i in RENAMES) + ") AS v(code, name, since, known)"


@query("stream_lookup_asof", f"""
    WITH v AS ({_RENAMES_SQL}),
    c AS (SELECT c.*, {T_ORDER} + 30000 AS ts_ms FROM ({_COMMENT_CODES}) c LEFT JOIN orders ON id = o_orderkey),
    s AS (SELECT c.*, coalesce({slice_sql('ts_ms', 'lo', 'hi')}, 0) AS slice FROM c, (SELECT min(ts_ms) AS lo, max(ts_ms) AS hi FROM c) b)
    SELECT id, appraise, ts_ms, coalesce(v.name, 'N/A') AS appraise_name FROM s
    LEFT JOIN v ON appraise = code AND ts_ms >= since AND known <= slice
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY since DESC NULLS LAST) = 1""")
def stream_lookup_asof(spark, sf_dir, **how):
    """Comments decoded by the dictionary as it was at their time. Its changes
    arrive while the stream runs: each micro-batch reads the versions known by
    then and takes, for every comment, the last one before it."""
    from dovetail.session import scratch_dir
    folder = scratch_dir(spark, "dictionary")

    def change(i: int):
        rows = [(c, n, t) for c, n, t, when in RENAMES if when == i]
        spark.createDataFrame(rows, "code string, name string, since bigint").coalesce(1).write.mode("overwrite") \
            .parquet(os.path.join(folder, f"batch={i}"))

    def write(batch: DataFrame, bid: int, out: str):
        versions = spark.read.parquet(folder).select("code", "name", "since")
        asof_lookup(batch, versions, "appraise", "ts_ms", "appraise_name").withColumn(
            "appraise_name", F.coalesce("appraise_name", F.lit("N/A"))).write.mode("overwrite").parquet(os.path.join(out, f"batch={bid}"))

    out = run_foreach_batch(spark, [_comment_topic(spark, sf_dir)], lambda s: s, "lookup_asof", write, before=change, **how)
    return spark.read.parquet(out).select("id", "appraise", "ts_ms", "appraise_name")


# Routing config (source table -> sink table, row-key column,
# sink columns) as it stands while each slice arrives: orders are created,
# then updated to fewer columns; carts are created, then deleted.
ROUTING = [
    [("order_info", "dim_order_status", "id", "id,order_status"), ("cart_info", "dim_cart", "id", "sku_id,sku_num")],
    [("order_info", "dim_order_status", "id", "order_status"), ("cart_info", "dim_cart", "id", "sku_id,sku_num")],
    [("order_info", "dim_order_status", "id", "order_status")],
]
assert len(ROUTING) == SLICES


@query("stream_dim_routing", f"""
    WITH o AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS id, status, {T_ORDER} + plus AS t FROM orders, (VALUES ('1001', 0), ('1002', 60000),
            ('1003', 120000), ('1005', 180000), ('1006', 240000)) AS v(status, plus)
        WHERE status = '1001' OR (status = '1002' AND o_orderstatus = 'F')
           OR (status = '1003' AND o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
           OR (status IN ('1005', '1006') AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')),
    c AS (
        SELECT line_id, CAST(l_partkey AS VARCHAR) || ',' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS payload, t, TRUE AS live
        FROM ({LINES}) x
        UNION ALL
        SELECT line_id, CAST(l_partkey AS VARCHAR) || ',' || CAST(CAST(l_quantity AS INTEGER) + l_linenumber AS VARCHAR),
               t + 60000, TRUE
        FROM ({LINES}) y WHERE l_returnflag = 'R'
        UNION ALL
        SELECT line_id, NULL, t + 120000, FALSE FROM ({LINES}) z WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
    b AS (SELECT min(t) AS lo, max(t) AS hi FROM (SELECT t FROM o UNION ALL SELECT t FROM c)),
    r AS (
        SELECT 'dim_order_status' AS sink_table, md5(id) AS row_key, t,
               CASE WHEN {slice_sql('t', 'lo', 'hi')} = 0 THEN id || ',' || status ELSE status END AS payload FROM o, b
        UNION ALL
        SELECT 'dim_cart', md5(line_id), t, payload FROM c, b WHERE live AND {slice_sql('t', 'lo', 'hi')} < 2)
    SELECT sink_table, row_key, payload FROM r
    QUALIFY row_number() OVER (PARTITION BY sink_table, row_key ORDER BY t DESC, payload DESC) = 1""")
def stream_dim_routing(spark, sf_dir, **how):
    """Config-driven dimension routing. Each micro-batch joins the envelopes
    to the routing config as it is then (re-read, bounded), builds row key
    ``md5(after[key])`` and the configured columns, keeps the latest row per
    sink key and writes it keyed by batch id. Deletes of data rows are
    ignored; a deleted route drops what arrives later. Reading merges the
    batches (latest per key): an upsert store that never rewrites old files."""
    from dovetail.operators.windows import latest_per_key
    from dovetail.session import scratch_dir
    config = scratch_dir(spark, "routing")
    env = E.envelopes(spark, sf_dir, ["order_info", "cart_info"]).drop("before")  # routing reads the image after a change

    def change(i: int):
        spark.createDataFrame(ROUTING[i], "source_table string, sink_table string, sink_row_key string, sink_columns string") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(config, f"batch={i}"))

    def write(batch: DataFrame, bid: int, out: str):
        cfg = spark.read.parquet(current(spark, config))  # re-read per batch: config changes apply live
        j = batch.where(F.col("op") != "d").join(cfg, F.col("source")["table"] == cfg.source_table)
        a = F.col("after")
        rows = j.select("sink_table", F.md5(F.element_at(a, F.col("sink_row_key"))).alias("row_key"),
                        F.array_join(F.transform(F.split("sink_columns", ","), lambda c: F.element_at(a, c)), ",")
                        .alias("payload"), "ts_ms")
        latest_per_key(rows, ["sink_table", "row_key"], ["ts_ms", "payload"]).write.mode("overwrite") \
            .partitionBy("sink_table").parquet(os.path.join(out, f"batch={bid}"))

    out = run_foreach_batch(spark, [Topic("relay", env, F.col("ts_ms"))], lambda s: s, "dim_routing", write, before=change, **how)
    store = spark.read.option("basePath", out).parquet(os.path.join(out, "batch=*"))
    return latest_per_key(store.select("sink_table", "row_key", "payload", "ts_ms"), ["sink_table", "row_key"],
                          ["ts_ms", "payload"]).select("sink_table", "row_key", "payload")


@query("stream_sink_catalog", """
    WITH g AS (SELECT p_type, min(2 * p_partkey) AS made, min(2 * p_partkey + 1) FILTER (p_size > 45) AS anew
               FROM part WHERE p_type <> 'PROMO' GROUP BY p_type)
    SELECT 'dim_' || lower(p_type) AS sink_table, md5(CAST(p_partkey // 8 AS VARCHAR)) AS row_key,
           CASE WHEN anew IS NULL THEN 'name,partkey' ELSE 'name,partkey,size' END AS sink_columns,
           p_name AS name, CAST(p_partkey AS VARCHAR) AS partkey,
           CASE WHEN anew IS NOT NULL THEN CAST(p_size AS VARCHAR) END AS size
    FROM part JOIN g USING (p_type) WHERE 2 * p_partkey >= coalesce(anew, made)
    QUALIFY row_number() OVER (PARTITION BY p_type, p_partkey // 8 ORDER BY p_partkey DESC) = 1""")
def stream_sink_catalog(spark, sf_dir, **how):
    """Sink tables made, made anew and dropped by a stream of config changes
    among the rows they route: a table holds the latest row per key since it was
    made, with the columns it was made with; what comes before or after its
    life is dropped. Returns the rows of every table there is in the end."""
    topic = sink_topic(spark, sf_dir)

    def write(batch: DataFrame, bid: int, out: str):
        config = batch.where("op <> 'row'").collect()  # table definitions, as many as the config has
        changes = [Change(c["op"], Sink(c["sink_table"], c["source"], "slot", c["sink_columns"] or "", c["ts_ms"])) for c in config]
        SinkCatalog(os.path.join(out, "sinks")).run(spark, bid, changes, batch.where("op = 'row'").select("source", "after", "ts_ms"))

    out = run_foreach_batch(spark, [topic], lambda s: s, "sink_catalog", write, **how)
    catalog = SinkCatalog(os.path.join(out, "sinks"))
    none = spark.createDataFrame([], "sink_table string, row_key string, sink_columns string, name string, partkey string, size string")
    parts = [none]
    for s in catalog.at(spark).values():
        t = catalog.read(spark, s.table)
        parts.append(t.select(F.lit(s.table).alias("sink_table"), "row_key", F.lit(s.columns).alias("sink_columns"),
                              *[(F.col(c) if c in t.columns else F.lit(None).cast("string")).alias(c) for c in ("name", "partkey", "size")]))
    return reduce(DataFrame.unionByName, parts)


def sink_topic(spark, sf_dir) -> Topic:
    """Parts as rows of their type's table, among the changes of the routing
    config: a type's table is made at its first part, made anew with a size
    column at its first large one, and that of PROMO is dropped after its last."""
    p = load(spark, sf_dir, "part")
    text = lambda c: F.col(c).cast("string")
    slot = F.floor(F.col("p_partkey") / 8).cast("string")
    rows = p.select(F.lit("row").alias("op"), F.lower("p_type").alias("source"), F.lit(None).cast("string").alias("sink_table"),
                    F.lit(None).cast("string").alias("sink_columns"),
                    F.create_map(F.lit("slot"), slot, F.lit("name"), F.col("p_name"), F.lit("partkey"), text("p_partkey"),
                                 F.lit("size"), text("p_size")).alias("after"), (F.col("p_partkey") * 2).cast("bigint").alias("ts_ms"))
    at = F.col("p_partkey").cast("bigint") * 2
    g = p.groupBy(F.lower("p_type").alias("source")).agg(
        F.min(at).alias("made"), F.min(F.when(F.col("p_size") > 45, at + 1)).alias("anew"), (F.max(at) + 2).alias("end"))
    def change(op, ts, columns):
        return g.select(F.lit(op).alias("op"), "source", F.concat(F.lit("dim_"), "source").alias("sink_table"),
                        F.lit(columns).cast("string").alias("sink_columns"),
                        F.lit(None).cast(rows.schema["after"].dataType).alias("after"), F.col(ts).alias("ts_ms")).where("ts_ms IS NOT NULL")

    config = change("c", "made", "name,partkey").unionByName(change("u", "anew", "name,partkey,size")) \
        .unionByName(change("d", "end", None).where("source = 'promo'"))
    return Topic("parts-and-config", rows.unionByName(config), F.col("ts_ms"), source=(sf_dir, ("part",)))
