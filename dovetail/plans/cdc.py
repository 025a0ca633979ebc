"""Batch twins of the change-event jobs: parse, normalise, route, the
DWD trade facts built from envelopes, and the upsert / partial-update /
day-bucket sinks. The streaming versions live in ``plans.streams``."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dovetail.functions.dates import epoch_ms
from dovetail.operators.joins import decode, interval_join, maybe_broadcast, prefixed
from dovetail.operators.windows import latest_per_key
from dovetail.registry import query
from dovetail.sources import envelopes as E
from dovetail.sources.literal import literal_table
from dovetail.sources.tables import load
from dovetail.streaming.runner import BucketTable, Topic, run_foreach_batch

# Retail code dictionary (dic_code, dic_name); names descriptive.
RETAIL_DIC = [("1103", "card payment"), ("1502", "refund only"), ("1301", "quality issue"),
              ("1302", "changed mind"), ("1201", "good"), ("1202", "average"), ("1203", "poor")]
assert len({k for k, _ in RETAIL_DIC}) == len(RETAIL_DIC)
RDIC_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in RETAIL_DIC) + ") AS t(id, name)"


def rdic(spark):
    return literal_table(spark, RETAIL_DIC, "id string, name string")


T_ORDER = "(epoch_us(o_orderdate) // 1000)"
LINE_ID = "CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '_' || CAST(l_partkey AS VARCHAR)"
LINES = f"""SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority,
                   {T_ORDER} + l_linenumber * 1000 AS t, {LINE_ID} AS line_id
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


# -- parse / normalise / route ------------------------------------------------------------------

@query("cdc_parse", f"""
    SELECT 'r' AS op, 'order_info' AS tbl, {T_ORDER} AS ts_ms, CAST(o_orderkey AS VARCHAR) AS rec_id,
           '1001' AS order_status FROM orders
    UNION ALL SELECT 'u', 'order_info', {T_ORDER} + 60000, CAST(o_orderkey AS VARCHAR), '1002'
              FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'u', 'order_info', {T_ORDER} + 120000, CAST(o_orderkey AS VARCHAR), '1003'
              FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
    UNION ALL SELECT 'u', 'order_info', {T_ORDER} + 180000, CAST(o_orderkey AS VARCHAR), '1005'
              FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'u', 'order_info', {T_ORDER} + 240000, CAST(o_orderkey AS VARCHAR), '1006'
              FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'c', 'payment_info', {T_ORDER} + 65000, CAST(o_orderkey AS VARCHAR), NULL
              FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'""")
def cdc_parse(spark, sf_dir):
    """Envelopes as topic text (``to_json``), parsed back with a fixed schema.
    Tombstones (null payloads, one per cancelled order) parse to null rows
    instead of failing the job."""
    env = E.order_envelopes(spark, sf_dir)
    text = env.select(F.to_json(F.struct(*env.columns)).alias("value"))
    tomb = load(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")) \
        .select(F.lit(None).cast("string").alias("value"))
    p = text.unionByName(tomb).select(F.from_json("value", E.ENVELOPE).alias("e"))
    return p.select(F.col("e.op").alias("op"), F.col("e.source")["table"].alias("tbl"), F.col("e.ts_ms").alias("ts_ms"),
                    F.col("e.after")["id"].alias("rec_id"), F.col("e.after")["order_status"].alias("order_status"))


CART_SQL = f"""
    SELECT CASE WHEN l_linestatus = 'F' THEN 'r' ELSE 'c' END AS op, line_id, o_custkey AS user_id,
           l_partkey AS sku_id, NULL AS before_num, CAST(l_quantity AS INTEGER) AS sku_num, t AS ts_ms FROM ({LINES}) a
    UNION ALL SELECT 'u', line_id, o_custkey, l_partkey, CAST(l_quantity AS INTEGER),
                     CAST(l_quantity AS INTEGER) + l_linenumber, t + 60000 FROM ({LINES}) b WHERE l_returnflag = 'R'
    UNION ALL SELECT 'd', line_id, o_custkey, l_partkey, CAST(l_quantity AS INTEGER), NULL, t + 120000
              FROM ({LINES}) c WHERE l_returnflag = 'A' AND l_linestatus = 'F'"""


def normalise(env: DataFrame) -> DataFrame:
    """db / table / op and the row image: ``before`` for deletes, else
    ``after``; record key = id suffixed by the event time."""
    data = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return env.select(F.col("source")["db"].alias("db"), F.col("source")["table"].alias("tbl"), "op",
                      data.alias("data"), "ts_ms").select(
        "db", "tbl", "op", F.concat_ws("_", F.col("data")["id"], F.col("ts_ms").cast("string")).alias("rec_key"),
        F.col("data")["sku_num"].cast("int").alias("sku_num"))


@query("cdc_normalise", f"""
    SELECT 'retail' AS db, 'cart_info' AS tbl, op, line_id || '_' || CAST(ts_ms AS VARCHAR) AS rec_key,
           CASE WHEN op = 'd' THEN before_num ELSE sku_num END AS sku_num
    FROM ({CART_SQL}) x""")
def cdc_normalise(spark, sf_dir):
    return normalise(E.of_table(E.line_envelopes(spark, sf_dir), "cart_info"))


@query("cdc_route_table", f"""
    SELECT tbl, count(*) AS n FROM (
        SELECT 'order_info' AS tbl FROM orders
        UNION ALL SELECT 'order_info' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'order_info' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
        UNION ALL SELECT 'order_info' FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'order_info' FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'payment_info' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'order_detail' FROM lineitem
        UNION ALL SELECT 'cart_info' FROM lineitem
        UNION ALL SELECT 'cart_info' FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT 'order_refund_info' FROM ({LINES}) r
                  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND l_returnflag = 'R'
        UNION ALL SELECT 'refund_payment' FROM ({LINES}) r
                  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND l_returnflag = 'R'
        UNION ALL SELECT 'comment_info' FROM documents) u
    GROUP BY tbl""")
def cdc_route_table(spark, sf_dir):
    """Route every envelope by ``source.table``, keep rows with a non-empty
    ``after.id`` (deletes carry none) and count per route."""
    env = E.envelopes(spark, sf_dir)
    k = F.col("after")["id"]
    return env.where(k.isNotNull() & (F.length(k) > 0)).groupBy(F.col("source")["table"].alias("tbl")) \
        .agg(F.count("*").alias("n"))


SILENCE_MS = 15_000


def snapshot_row() -> Column:
    """Read by the initial snapshot: ``op='r'``, or marked so by its source. A
    row that says neither is a live one."""
    return F.coalesce(F.col("op") == "r", F.lit(False)) | F.coalesce(F.col("source")["snapshot"] == "true", F.lit(False))


def snapshot_gate(env: DataFrame) -> DataFrame:
    """Per table the rows that pass the gate (``n``), and when and why its
    snapshot phase ended: its first live row, or 15 seconds without any row.

    Silence is found over spans of 15 seconds, so that no task holds the rows of
    a table in order: inside a span there is none, and what follows the last row
    of one in time is in the next."""
    span = F.floor(F.col("ts_ms") / SILENCE_MS)
    spans = env.select(F.col("source")["table"].alias("tbl"), span.alias("span"), "ts_ms", snapshot_row().alias("snap")) \
        .groupBy("tbl", "span").agg(F.count(F.when(F.col("snap"), 1)).alias("n"), F.min("ts_ms").alias("lo"), F.max("ts_ms").alias("hi"),
                                    F.min(F.when(~F.col("snap"), F.col("ts_ms"))).alias("live"))
    none = F.lit(None).cast("bigint")
    here = F.struct("span", "n", "hi", "live", none.alias("next"))
    before = F.struct((F.col("span") - 1).alias("span"), F.lit(0).cast("bigint").alias("n"), none.alias("hi"), none.alias("live"),
                      F.col("lo").alias("next"))
    g = spans.select("tbl", F.explode(F.array(here, before)).alias("s")).select("tbl", "s.*").groupBy("tbl", "span").agg(
        F.sum("n").alias("n"), F.max("hi").alias("hi"), F.min("live").alias("live"), F.min("next").alias("next"))
    silent = F.col("next").isNull() | (F.col("next") - F.col("hi") > SILENCE_MS)
    t = g.groupBy("tbl").agg(F.sum("n").alias("n"), F.min("live").alias("live"), F.min(F.when(silent, F.col("hi"))).alias("last"))
    live = F.col("live") <= F.col("last")
    return t.where("n > 0").select("tbl", "n", F.when(live, F.col("live")).otherwise(F.col("last") + SILENCE_MS).alias("ended_ms"),
                                   F.when(live, "live row").when(F.col("last").isNotNull(), "silence").alias("reason"))


@query("cdc_snapshot_only", f"""
    WITH e AS (
        SELECT 'order_info' AS tbl, {T_ORDER} AS t, TRUE AS snap FROM orders
        UNION ALL SELECT 'order_info', {T_ORDER} + 60000, FALSE FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'order_info', {T_ORDER} + 120000, FALSE FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
        UNION ALL SELECT 'order_info', {T_ORDER} + 180000, FALSE FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'order_info', {T_ORDER} + 240000, FALSE FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'order_detail', t, TRUE FROM ({LINES}) x
        UNION ALL SELECT 'cart_info', t, coalesce(l_linestatus = 'F', FALSE) FROM ({LINES}) x
        UNION ALL SELECT 'cart_info', t + 60000, FALSE FROM ({LINES}) x WHERE l_returnflag = 'R'
        UNION ALL SELECT 'cart_info', t + 120000, FALSE FROM ({LINES}) x WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
    d AS (SELECT tbl, t, bool_and(snap) AS snap FROM e WHERE t IS NOT NULL GROUP BY tbl, t),
    g AS (SELECT *, lead(t) OVER (PARTITION BY tbl ORDER BY t) AS next FROM d),
    q AS (SELECT tbl, min(t) AS last FROM g WHERE next IS NULL OR next - t > {SILENCE_MS} GROUP BY tbl),
    p AS (SELECT tbl, coalesce(min(t) FILTER (NOT snap), max(t) + {SILENCE_MS}) AS ended_ms,
                 CASE WHEN count(*) FILTER (NOT snap) > 0 THEN 'live row' ELSE 'silence' END AS reason
          FROM d JOIN q USING (tbl) WHERE t <= last GROUP BY tbl),
    c AS (SELECT tbl, count(*) AS n FROM (
        SELECT 'order_info' AS tbl FROM orders
        UNION ALL SELECT 'order_detail' FROM lineitem
        UNION ALL SELECT 'cart_info' FROM lineitem WHERE l_linestatus = 'F') s GROUP BY tbl)
    SELECT c.tbl, n, ended_ms, reason FROM c LEFT JOIN p ON c.tbl = p.tbl""")
def cdc_snapshot_only(spark, sf_dir):
    """Snapshot-phase gate over all envelopes: only rows read by the initial
    snapshot pass, counted per table, and the phase of each table that has some
    ends at its first live row or after 15 seconds of silence."""
    return snapshot_gate(E.envelopes(spark, sf_dir))


# -- trade facts from envelopes -----------------------------------------------------------------------

def cart_add(env: DataFrame) -> DataFrame:
    """Cart additions: snapshot rows and inserts with their quantity, updates
    that raised the quantity with the increase."""
    c = E.of_table(env, "cart_info")
    after, before = F.col("after"), F.col("before")
    inc = after["sku_num"].cast("int") - before["sku_num"].cast("int")
    keep = (F.col("op").isin("r", "c")) | ((F.col("op") == "u") & before["sku_num"].isNotNull() & (inc > 0))
    return c.where(keep).select(
        after["id"].alias("id"), after["user_id"].cast("bigint").alias("user_id"),
        after["sku_id"].cast("bigint").alias("sku_id"),
        F.when(F.col("op") == "u", inc).otherwise(after["sku_num"].cast("int")).alias("sku_num"), "ts_ms")


@query("cdc_cart_add", f"""
    SELECT line_id AS id, user_id, sku_id, CASE WHEN op = 'u' THEN sku_num - before_num ELSE sku_num END AS sku_num, ts_ms
    FROM ({CART_SQL}) x WHERE op IN ('r', 'c') OR (op = 'u' AND sku_num > before_num)""")
def cdc_cart_add(spark, sf_dir):
    return cart_add(E.line_envelopes(spark, sf_dir))


def order_detail_wide(spark, sf_dir) -> DataFrame:
    env = E.envelopes(spark, sf_dir, ["order_detail", "order_info"])
    a = F.col("after")
    d = E.of_table(env, "order_detail").select(
        a["id"].alias("id"), a["order_id"].alias("order_id"), a["sku_id"].cast("bigint").alias("sku_id"),
        a["sku_num"].cast("int").alias("sku_num"), a["order_price"].cast("decimal(16,2)").alias("order_price"),
        a["split_activity_amount"].cast("decimal(16,2)").alias("split_activity_amount"),
        a["split_coupon_amount"].cast("decimal(16,2)").alias("split_coupon_amount"),
        a["activity_id"].cast("bigint").alias("activity_id"), a["coupon_id"].cast("bigint").alias("coupon_id"), "ts_ms")
    o = E.of_table(env, "order_info").where(F.col("op") == "r").select(
        a["id"].alias("__oid"), a["user_id"].cast("bigint").alias("user_id"))
    act = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("__act"),
                                                 F.concat(F.lit("ACT_"), "s_suppkey").alias("activity_name"))
    cou = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("__cou"),
                                             F.concat(F.lit("CPN_"), "p_brand").alias("coupon_name"))
    j = (d.join(o, d.order_id == o["__oid"]).join(maybe_broadcast(act), F.col("activity_id") == F.col("__act"), "left")
          .join(cou, F.col("coupon_id") == F.col("__cou"), "left"))
    return j.select("id", "order_id", "user_id", "sku_id", "sku_num", "order_price",
                    (F.col("sku_num").cast("decimal(10,0)") * F.col("order_price")).alias("split_original_amount"),
                    "split_activity_amount", "split_coupon_amount", "activity_name", "coupon_name", "ts_ms")


WIDE_SQL = f"""
    SELECT line_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           CAST(l_quantity AS INTEGER) AS sku_num, CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
           CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(16,2)) AS split_original_amount,
           CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2))
               AS split_activity_amount,
           CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2))
               AS split_coupon_amount,
           CASE WHEN l_discount > 0.05 THEN 'ACT_' || CAST(l_suppkey AS VARCHAR) END AS activity_name,
           CASE WHEN l_tax > 0.04 THEN 'CPN_' || p_brand END AS coupon_name, t AS ts_ms
    FROM ({LINES}) x LEFT JOIN part ON l_partkey = p_partkey"""


@query("cdc_order_detail_wide", WIDE_SQL)
def cdc_order_detail_wide(spark, sf_dir):
    """detail ⋈ order ⟕ activity ⟕ coupon; original amount = quantity × price (decimal)."""
    return order_detail_wide(spark, sf_dir)


def status_moves(env: DataFrame, frm: str, to: str) -> DataFrame:
    """Order updates whose status moved ``frm`` -> ``to`` (state-transition filter)."""
    o = E.of_table(env, "order_info")
    return o.where((F.col("op") == "u") & (F.col("before")["order_status"] == frm)
                   & (F.col("after")["order_status"] == to)).select(
        F.col("after")["id"].alias("order_id"), F.col("after")["user_id"].cast("bigint").alias("user_id"),
        F.col("ts_ms").alias("move_ts"))


@query("cdc_order_cancel", f"""
    SELECT line_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           CAST(l_quantity AS INTEGER) AS sku_num, {T_ORDER} + 120000 AS cancel_ts
    FROM ({LINES}) x WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'""")
def cdc_order_cancel(spark, sf_dir):
    env = E.envelopes(spark, sf_dir, ["order_info", "order_detail"])
    c = status_moves(env, "1001", "1003")
    a = F.col("after")
    d = E.of_table(env, "order_detail").select(a["id"].alias("id"), a["order_id"].alias("__oid"),
                                               a["sku_id"].cast("bigint").alias("sku_id"),
                                               a["sku_num"].cast("int").alias("sku_num"))
    return d.join(c, d["__oid"] == c.order_id).select("id", "order_id", "user_id", "sku_id", "sku_num",
                                                     F.col("move_ts").alias("cancel_ts"))


REFUND_LINES = f"SELECT * FROM ({LINES}) r WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND l_returnflag = 'R'"


@query("cdc_refund", f"""
    WITH d AS ({RDIC_SQL})
    SELECT line_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           '1502' AS refund_type, d1.name AS refund_type_name,
           CASE WHEN l_discount > 0.05 THEN '1301' ELSE '1302' END AS refund_reason_type, d2.name AS refund_reason_name,
           CAST(l_quantity AS INTEGER) AS refund_num, CAST(l_extendedprice AS DECIMAL(16,2)) AS refund_amount
    FROM ({REFUND_LINES}) r LEFT JOIN d d1 ON d1.id = '1502'
    LEFT JOIN d d2 ON d2.id = CASE WHEN l_discount > 0.05 THEN '1301' ELSE '1302' END""")
def cdc_refund(spark, sf_dir):
    """Refund requests joined to orders that moved to 1005, with refund type
    and reason decoded by two lookups on one dictionary."""
    env = E.envelopes(spark, sf_dir, ["order_refund_info", "order_info"])
    a = F.col("after")
    r = E.of_table(env, "order_refund_info").select(
        a["id"].alias("id"), a["order_id"].alias("__oid"), a["sku_id"].cast("bigint").alias("sku_id"),
        a["refund_type"].alias("refund_type"), a["refund_reason_type"].alias("refund_reason_type"),
        a["refund_num"].cast("int").alias("refund_num"), a["refund_amount"].cast("decimal(16,2)").alias("refund_amount"))
    o = status_moves(env, "1002", "1005")
    j = r.join(o, r["__oid"] == o.order_id)
    d = rdic(spark)
    j = decode(j, "refund_type", d, "refund_type_name", unique=True)
    j = decode(j, "refund_reason_type", d, "refund_reason_name", unique=True)
    return j.select("id", "order_id", "user_id", "sku_id", "refund_type", "refund_type_name", "refund_reason_type",
                    "refund_reason_name", "refund_num", "refund_amount")


@query("cdc_refund_pay", f"""
    WITH d AS ({RDIC_SQL})
    SELECT line_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           '1103' AS payment_type, d.name AS payment_type_name, CAST(l_quantity AS INTEGER) AS refund_num,
           CAST(l_extendedprice AS DECIMAL(16,2)) AS refund_amount,
           strftime(o_orderdate + INTERVAL 4 MINUTE, '%Y-%m-%d %H:%M:%S') AS callback_time
    FROM ({REFUND_LINES}) r LEFT JOIN d ON d.id = '1103'""")
def cdc_refund_pay(spark, sf_dir):
    """Refund payment (1602) ⋈ refund (0705) on (order, sku) ⋈ order moved to 1006, payment type decoded."""
    env = E.envelopes(spark, sf_dir, ["refund_payment", "order_refund_info", "order_info"])
    a = F.col("after")
    p = E.of_table(env, "refund_payment").where(a["refund_status"] == "1602").select(
        a["id"].alias("id"), a["order_id"].alias("order_id"), a["sku_id"].alias("sku_id"),
        a["payment_type"].alias("payment_type"), a["callback_time"].alias("callback_time"))
    r = E.of_table(env, "order_refund_info").where(a["refund_status"] == "0705").select(
        a["order_id"].alias("order_id"), a["sku_id"].alias("sku_id"), a["refund_num"].cast("int").alias("refund_num"),
        a["refund_amount"].cast("decimal(16,2)").alias("refund_amount"))
    o = status_moves(env, "1005", "1006").select("order_id", "user_id")
    j = p.join(r, ["order_id", "sku_id"]).join(o, "order_id")
    j = decode(j, "payment_type", rdic(spark), "payment_type_name", unique=True)
    return j.select("id", "order_id", "user_id", F.col("sku_id").cast("bigint").alias("sku_id"), "payment_type",
                    "payment_type_name", "refund_num", "refund_amount", "callback_time")


# -- sinks ----------------------------------------------------------------------------------------

@query("sink_upsert_latest", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '1006'
                WHEN o_orderstatus = 'F' THEN '1002'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '1003' ELSE '1001' END AS order_status,
           {T_ORDER} + CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 240000
                WHEN o_orderstatus = 'F' THEN 60000
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 120000 ELSE 0 END AS ts_ms
    FROM orders""")
def sink_upsert_latest(spark, sf_dir, **how):
    """Upsert sink: a stream of order changes, each micro-batch merged into
    the key-hash buckets it touches, where the last value per primary key wins
    (``max_by`` on event time; partial aggregation map-side)."""
    o = E.of_table(E.order_envelopes(spark, sf_dir), "order_info").select(
        F.col("after")["id"].alias("id"), F.col("after")["order_status"].alias("order_status"), "ts_ms")

    def write(batch: DataFrame, bid: int, out: str):
        BucketTable(os.path.join(out, "table"), ("id",)).merge(batch, bid, lambda rows: latest_per_key(rows, ["id"], ["ts_ms"]))

    topic = Topic("order-status", o, F.col("ts_ms"), source=(sf_dir, ("orders",)))
    out = run_foreach_batch(spark, [topic], lambda x: x, "upsert", write, **how)
    return BucketTable(os.path.join(out, "table"), ("id",)).read(spark, o.schema)


def cart_rows(env: DataFrame) -> DataFrame:
    """Typed cart rows: inserts / snapshots carry every column, updates only
    the changed quantity; deletes are ignored by the sink."""
    c = E.of_table(env, "cart_info").where(F.col("op") != "d")
    a = F.col("after")
    upd = F.col("op") == "u"
    return c.select(a["id"].alias("id"), F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd").alias("ds"),
                    F.when(~upd, a["user_id"].cast("bigint")).alias("user_id"),
                    F.when(~upd, a["sku_id"].cast("bigint")).alias("sku_id"),
                    a["sku_num"].cast("int").alias("sku_num"),
                    F.when(~upd, a["sku_name"]).alias("sku_name"), "ts_ms")


def partial_update(rows: DataFrame, keys: list[str], values: list[str], seq: str) -> DataFrame:
    """Per key, each column takes its latest non-null value by the number in
    its own ``<column>_at`` (max of ``struct(at, value)``: one aggregate). The
    numbers stay with the values, so the result can be merged again."""
    best = [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}_at").alias("at"), F.col(c).alias("v")))).alias(c) for c in values]
    g = rows.groupBy(*keys).agg(*best, F.max(seq).alias(seq))
    return g.select(*keys, *[F.col(c)["v"].alias(c) for c in values], *[F.col(c)["at"].alias(f"{c}_at") for c in values], seq)


@query("sink_partial_update", f"""
    SELECT id, ds, max_by(user_id, CASE WHEN user_id IS NOT NULL THEN ts_ms END) AS user_id,
           max_by(sku_id, CASE WHEN sku_id IS NOT NULL THEN ts_ms END) AS sku_id,
           max_by(sku_num, CASE WHEN sku_num IS NOT NULL THEN ts_ms END) AS sku_num,
           max_by(sku_name, CASE WHEN sku_name IS NOT NULL THEN ts_ms END) AS sku_name, max(ts_ms) AS ts_ms
    FROM (SELECT line_id AS id, strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS ds,
                 CASE WHEN op <> 'u' THEN user_id END AS user_id, CASE WHEN op <> 'u' THEN sku_id END AS sku_id,
                 sku_num, CASE WHEN op <> 'u' THEN 'sku-' || CAST(sku_id AS VARCHAR) END AS sku_name, ts_ms
          FROM ({CART_SQL}) x WHERE op <> 'd') r
    GROUP BY id, ds""")
def sink_partial_update(spark, sf_dir, **how):
    """Partial-update sink: cart changes as a stream, each micro-batch merged
    column by column into the stored rows of the key-hash buckets it touches."""
    values = ["user_id", "sku_id", "sku_num", "sku_name"]
    rows = cart_rows(E.line_envelopes(spark, sf_dir, tables={"cart_info"}))
    rows = rows.select("id", "ds", *values, *[F.col("ts_ms").alias(f"{c}_at") for c in values], "ts_ms")

    def write(batch: DataFrame, bid: int, out: str):
        BucketTable(os.path.join(out, "table"), ("id", "ds")).merge(
            batch, bid, lambda r: partial_update(r, ["id", "ds"], values, "ts_ms"))

    topic = Topic("cart-rows", rows, F.col("ts_ms"), source=(sf_dir, ("lineitem", "orders")))
    out = run_foreach_batch(spark, [topic], lambda x: x, "partial_update", write, **how)
    return BucketTable(os.path.join(out, "table"), ("id", "ds")).read(spark, rows.schema).select("id", "ds", *values, "ts_ms")


def day_bucket(epoch_text):
    """``yyyyMMdd`` from an epoch value in seconds (< 1e10) or millis;
    unparsable text goes to ``error_bucket``."""
    n = epoch_text.try_cast("bigint")
    ms = F.when(n < F.lit(10_000_000_000), n * 1000).otherwise(n)
    return F.coalesce(F.date_format(F.timestamp_millis(ms), "yyyyMMdd"), F.lit("error_bucket"))


@query("sink_day_bucket", """
    SELECT bucket, count(*) AS n FROM (
        SELECT coalesce(strftime(epoch_ms(CASE WHEN TRY_CAST(f AS BIGINT) < 10000000000 THEN TRY_CAST(f AS BIGINT) * 1000
                                            ELSE TRY_CAST(f AS BIGINT) END), '%Y%m%d'), 'error_bucket') AS bucket
        FROM (SELECT CASE WHEN event_type = 'view' THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
                          WHEN event_type = 'error' THEN 'n/a-' || CAST(event_id AS VARCHAR)
                          ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS f FROM events) e) b
    GROUP BY bucket""")
def sink_day_bucket(spark, sf_dir):
    """Day-bucketed file sink: records are written partitioned by a ``day``
    computed from their epoch field (seconds or millis; unparsable text to
    ``error_bucket``); the key reports the rows found in each bucket folder."""
    from dovetail.session import scratch_dir
    from dovetail.sources import io
    e = load(spark, sf_dir, "events")
    ms = epoch_ms(F.col("ts"))
    f = (F.when(F.col("event_type") == "view", (ms / 1000).cast("bigint").cast("string"))
          .when(F.col("event_type") == "error", F.concat(F.lit("n/a-"), F.col("event_id").cast("string")))
          .otherwise(ms.cast("string")))
    out = scratch_dir(spark, "day-bucket-sink")
    io.write_partitions(e.select("event_id", f.alias("epoch"), day_bucket(f).alias("day")), out, partition_col="day")
    written = io.read_table(spark, out, partition_col="day")
    return written.groupBy(F.col("day").alias("bucket")).agg(F.count("*").alias("n"))


def config_changes(spark, sf_dir) -> DataFrame:
    """Routing-config change log derived from part types: every type creates
    its sink at its first part key, types with a large part (size over 45)
    update it at the last such part, the PROMO sink is deleted at the end.
    Times are part keys, doubled so that two changes never coincide."""
    p = load(spark, sf_dir, "part")
    g = p.groupBy("p_type").agg((2 * F.min("p_partkey")).alias("lo"), (2 * F.max("p_partkey")).alias("hi"),
                                (2 * F.max(F.when(F.col("p_size") > 45, F.col("p_partkey"))) + 1).alias("large"))
    sink = F.concat(F.lit("dim_"), F.lower("p_type"))
    c = g.select(sink.alias("sink_table"), F.lit("c").alias("op"), F.col("lo").alias("ts"),
                 F.lit("id,name").alias("sink_columns"))
    u = g.where("large is not null").select(sink.alias("sink_table"), F.lit("u").alias("op"), F.col("large").alias("ts"),
                                         F.lit("id,name,size").alias("sink_columns"))
    d = g.where(F.col("p_type") == "PROMO").select(sink.alias("sink_table"), F.lit("d").alias("op"),
                                                   (F.col("hi") + 2).alias("ts"), F.lit(None).cast("string").alias("sink_columns"))
    return c.unionByName(u).unionByName(d)


@query("dim_sink_lifecycle", """
    WITH g AS (SELECT 'dim_' || lower(p_type) AS sink_table, count(*) FILTER (WHERE p_size > 45) AS large, p_type
               FROM part GROUP BY p_type)
    SELECT sink_table, CASE WHEN large > 0 THEN 'id,name,size' ELSE 'id,name' END AS sink_columns,
           CASE WHEN large > 0 THEN 2 ELSE 1 END AS version
    FROM g WHERE p_type <> 'PROMO'""")
def dim_sink_lifecycle(spark, sf_dir):
    """Active sinks from the config change log: latest op per sink decides;
    a delete drops it, an update re-creates it (version counts creations)."""
    ch = config_changes(spark, sf_dir)
    latest = latest_per_key(ch, ["sink_table"], ["ts"])
    versions = ch.where(F.col("op") != "d").groupBy("sink_table").agg(F.count("*").alias("version"))
    return latest.where(F.col("op") != "d").join(versions, "sink_table").select(
        "sink_table", "sink_columns", F.col("version").cast("bigint").alias("version"))


# -- comment fact ---------------------------------------------------------------------------------

def comments(spark, sf_dir) -> DataFrame:
    a = F.col("after")
    return E.of_table(E.comment_envelopes(spark, sf_dir), "comment_info").select(
        a["id"].cast("bigint").alias("id"), a["user_id"].cast("bigint").alias("user_id"),
        a["order_id"].alias("order_id"), a["appraise"].alias("appraise"), a["comment_txt"].alias("comment_txt"),
        F.timestamp_millis("ts_ms").alias("ts"))


@query("comment_fact", f"""
    WITH d AS ({RDIC_SQL})
    SELECT doc_id AS id, o_custkey AS user_id, '120' || CAST(CAST(trunc(least(n_chars / 2000, 3)) AS INTEGER) + 1 AS VARCHAR)
               AS appraise,
           coalesce(d.name, 'N/A') AS appraise_name, CAST(o_orderkey AS VARCHAR) AS info_order_id,
           CASE WHEN o_orderkey IS NOT NULL THEN '1001' END AS info_order_status, CAST(o_totalprice AS DECIMAL(16,2)) AS info_total_amount,
           strftime(o_orderdate, '%Y-%m-%d') AS ds
    FROM documents LEFT JOIN orders ON doc_id = o_orderkey
    LEFT JOIN d ON d.id = '120' || CAST(CAST(trunc(least(n_chars / 2000, 3)) AS INTEGER) + 1 AS VARCHAR)""")
def comment_fact(spark, sf_dir):
    """Comments: appraise code decoded with ``N/A`` on a miss (left lookup),
    left interval-joined (±1 min) to the order snapshot, order columns
    prefixed ``info_``, plus a day column."""
    c = decode(comments(spark, sf_dir), "appraise", rdic(spark), "appraise_name", unique=True, default="N/A")
    a = F.col("after")
    o = E.of_table(E.order_envelopes(spark, sf_dir), "order_info").where(F.col("op") == "r").select(
        a["id"].alias("order_id"), a["order_status"].alias("order_status"),
        a["total_amount"].cast("decimal(16,2)").alias("total_amount"), F.timestamp_millis("ts_ms").alias("ots"))
    info = prefixed(o, "info_")
    left = c.withColumnRenamed("order_id", "k")
    right = info.withColumnRenamed("info_order_id", "k").withColumn("info_order_id", F.col("k"))
    j = interval_join(left, right, "k", "ts", "info_ots", "-1 minutes", "1 minutes", how="left")
    return j.select(F.col("l.id").alias("id"), F.col("l.user_id").alias("user_id"), F.col("l.appraise").alias("appraise"),
                    F.col("l.appraise_name").alias("appraise_name"), F.col("r.info_order_id").alias("info_order_id"),
                    F.col("r.info_order_status").alias("info_order_status"),
                    F.col("r.info_total_amount").alias("info_total_amount"),
                    F.date_format("r.info_ots", "yyyy-MM-dd").alias("ds"))
