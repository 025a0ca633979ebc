"""Change-event envelopes derived from the driver tables.

An envelope is ``(op, before map, after map, source map, ts_ms)``, the shape a
database log reader emits. Rows are derived deterministically:

* ``order_info``: a snapshot row (``r``, status 1001) per order; paid orders
  (``F``) get an update 1001 -> 1002; cancelled ones (``P``/``5-LOW``)
  1001 -> 1003; urgent paid ones a refund 1002 -> 1005 and 1005 -> 1006.
* ``order_detail``: a snapshot row per line, one second per line number after
  its order.
* ``cart_info``: closed lines are snapshot rows, open lines inserts; lines
  with return flag ``R`` raise their quantity, flag ``A`` on closed lines
  deletes them.
* ``payment_info`` (status 1602) for paid orders; ``order_refund_info``
  (0705) and ``refund_payment`` (1602) for returned lines of refunded orders.
* ``comment_info``: one comment per document whose id is an order, 30 s
  after the order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dovetail.functions.dates import epoch_ms
from dovetail.sources.tables import dealt, load

ENVELOPE = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("before", T.MapType(T.StringType(), T.StringType())),
    T.StructField("after", T.MapType(T.StringType(), T.StringType())),
    T.StructField("source", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts_ms", T.LongType()),
])

MIN = 60000


def _m(**cols: Column) -> Column:
    """string map literal from named columns (null values kept as null)."""
    return F.create_map(*[x for k, v in cols.items() for x in (F.lit(k), v.cast("string"))])


def _null_map() -> Column:
    return F.lit(None).cast("map<string,string>")


def _events(df: DataFrame, table: str, events: list[tuple[Column, Column | str, Column | None, Column | None, Column]]
            ) -> DataFrame:
    """All change events one source row produces, from one scan: the row is
    repeated once for each ``(condition, op, before, after, ts)`` whose
    condition holds, and the fields are chosen by the event's number after that,
    so that a job builds the maps it reads and no others. ``source`` is a literal
    added after the explode, so a filter on the table prunes whole groups."""
    literal = F.create_map(F.lit("db"), F.lit("retail"), F.lit("table"), F.lit(table)).alias("source")
    if len(events) == 1:  # one event: a plain projection, which lets Catalyst fold the maps away
        cond, op, before, after, ts = events[0]
        return df.where(cond).select(
            (op if isinstance(op, Column) else F.lit(op)).alias("op"), (before if before is not None else _null_map()).alias("before"),
            (after if after is not None else _null_map()).alias("after"), literal, ts.cast("bigint").alias("ts_ms"))
    which = F.array(*[F.when(e[0], F.lit(i)) for i, e in enumerate(events)])
    rows = df.select("*", F.explode(which).alias("__event")).where(F.col("__event").isNotNull())

    def chosen(fields: list[Column]) -> Column:
        out = F.when(F.col("__event") == 0, fields[0])
        for i, f in enumerate(fields[1:], 1):
            out = out.when(F.col("__event") == i, f)
        return out

    images = [chosen([_null_map() if e[k] is None else e[k] for e in events]) for k in (2, 3)]
    return rows.select(
        chosen([e[1] if isinstance(e[1], Column) else F.lit(e[1]) for e in events]).alias("op"), images[0].alias("before"),
        images[1].alias("after"), literal, chosen([e[4].cast("bigint") for e in events]).alias("ts_ms"))


def _always() -> Column:
    return F.lit(True)


def _pick(groups: dict[str, DataFrame], tables) -> DataFrame:
    chosen = [df for t, df in groups.items() if tables is None or t in tables]
    return reduce(DataFrame.unionByName, chosen)


def order_envelopes(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None,
                    tables: set[str] | None = None) -> DataFrame:
    """Order and payment envelopes; ``orders`` may be a streaming frame over
    the same table (the derivation is a stateless projection)."""
    o = orders if orders is not None else load(spark, sf_dir, "orders")
    t = epoch_ms(F.col("o_orderdate"))
    base = dict(id=F.col("o_orderkey"), user_id=F.col("o_custkey"),
                total_amount=F.col("o_totalprice").cast("decimal(16,2)"))

    def st(code):
        return _m(**base, order_status=F.lit(code))

    def was(code):
        return _m(order_status=F.lit(code))
    paid = F.col("o_orderstatus") == "F"
    cancelled = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    urgent = paid & (F.col("o_orderpriority") == "1-URGENT")
    info = _events(o, "order_info", [
        (_always(), "r", None, st("1001"), t),
        (paid, "u", was("1001"), st("1002"), t + MIN),
        (cancelled, "u", was("1001"), st("1003"), t + 2 * MIN),
        (urgent, "u", was("1002"), st("1005"), t + 3 * MIN),
        (urgent, "u", was("1005"), st("1006"), t + 4 * MIN),
    ])
    payment = _events(o, "payment_info", [
        (paid, "c", None, _m(id=F.col("o_orderkey"), order_id=F.col("o_orderkey"), user_id=F.col("o_custkey"),
                             payment_type=F.lit("1103"), payment_status=F.lit("1602"),
                             callback_time=F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 MINUTE"),
                                                         "yyyy-MM-dd HH:mm:ss")), t + MIN + 5000)])
    return _pick({"order_info": info, "payment_info": payment}, tables)


def order_lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Lines with the attributes of their order."""
    li = lineitem if lineitem is not None else load(spark, sf_dir, "lineitem")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                            "o_orderpriority")
    if lineitem is None:
        li, o = dealt(li.count(), li, "l_orderkey", o, "o_orderkey")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def line_envelopes(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None,
                   tables: set[str] | None = None, lines: DataFrame | None = None, fields: set[str] | None = None) -> DataFrame:
    """Detail, cart and refund envelopes; ``lineitem`` may be a streaming frame
    (the order attributes then come from a stream-static join); ``lines``:
    ``order_lines``, where a job has them stored; ``fields``: those a job reads of
    the details' images, which are built whole otherwise, amounts as text too."""
    j = order_lines(spark, sf_dir, lineitem) if lines is None else lines
    t = epoch_ms(F.col("o_orderdate")) + F.col("l_linenumber") * 1000
    line_id = F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey")
    qty = F.col("l_quantity").cast("int")
    detail_after = dict(
        id=line_id, order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"), sku_num=qty,
        order_price=F.col("l_extendedprice").cast("decimal(16,2)"),
        split_activity_amount=(F.col("l_extendedprice").cast("decimal(16,2)")
                               * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(16,2)"),
        split_coupon_amount=(F.col("l_extendedprice").cast("decimal(16,2)")
                             * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(16,2)"),
        activity_id=F.when(F.col("l_discount") > 0.05, F.col("l_suppkey")),
        coupon_id=F.when(F.col("l_tax") > 0.04, F.col("l_partkey")))
    detail = _events(j, "order_detail", [
        (_always(), "r", None, _m(**{k: v for k, v in detail_after.items() if fields is None or k in fields}), t)])
    cart_after = dict(id=line_id, user_id=F.col("o_custkey"), sku_id=F.col("l_partkey"), sku_num=qty,
                      sku_name=F.concat(F.lit("sku-"), "l_partkey"))
    cart = _events(j, "cart_info", [
        (_always(), F.when(F.col("l_linestatus") == "F", "r").otherwise("c"), None, _m(**cart_after), t),
        (F.col("l_returnflag") == "R", "u", _m(**cart_after),
         _m(**{**cart_after, "sku_num": qty + F.col("l_linenumber")}), t + MIN),
        ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "d", _m(**cart_after), None, t + 2 * MIN),
    ])
    refunded = ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
                & (F.col("l_returnflag") == "R"))
    t0 = epoch_ms(F.col("o_orderdate"))
    refund = _events(j, "order_refund_info", [(refunded, "c", None, _m(
        id=line_id, order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"), refund_type=F.lit("1502"),
        refund_num=qty, refund_amount=F.col("l_extendedprice").cast("decimal(16,2)"),
        refund_reason_type=F.when(F.col("l_discount") > 0.05, "1301").otherwise("1302"),
        refund_status=F.lit("0705")), t0 + 3 * MIN + F.col("l_linenumber") * 1000)])
    rpay = _events(j, "refund_payment", [(refunded, "c", None, _m(
        id=line_id, order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"), payment_type=F.lit("1103"),
        total_amount=F.col("l_extendedprice").cast("decimal(16,2)"), refund_status=F.lit("1602"),
        callback_time=F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 4 MINUTE"), "yyyy-MM-dd HH:mm:ss")),
        t0 + 4 * MIN + F.col("l_linenumber") * 1000)])
    return _pick({"order_detail": detail, "cart_info": cart, "order_refund_info": refund, "refund_payment": rpay},
                 tables)


def comment_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = d.join(o, d.doc_id == o.o_orderkey, "left")  # a comment whose order is not there stays
    return _events(j, "comment_info", [(_always(), "c", None, _m(
        id=F.col("doc_id"), user_id=F.col("o_custkey"), order_id=F.col("doc_id"),
        appraise=F.concat(F.lit("120"), (F.least(F.col("n_chars") / 2000, F.lit(3)).cast("int") + 1).cast("string")),
        comment_txt=F.col("text")), epoch_ms(F.col("o_orderdate")) + 30000)])


def envelopes(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> DataFrame:
    """All envelopes, or only those of ``tables`` (other groups are pruned
    from the plan, not computed and filtered)."""
    env = reduce(DataFrame.unionByName, [order_envelopes(spark, sf_dir), line_envelopes(spark, sf_dir),
                                         comment_envelopes(spark, sf_dir)])
    return env.where(F.col("source")["table"].isin(*tables)) if tables else env


def of_table(env: DataFrame, table: str) -> DataFrame:
    """Route by ``source.table``."""
    return env.where(F.col("source")["table"] == F.lit(table))
