"""I/O keys: each writes derived rows to the shared folder, reads them back
and returns what a reader sees (the oracle is the input it must equal)."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dovetail.plans.reports import report_orders, windows_sql
from dovetail.plans import rollups as R_
from dovetail.registry import query
from dovetail.session import scratch_dir
from dovetail.sources import io
from dovetail.sources.model import RUN_DATE
from dovetail.sources.model_sql import with_model
from dovetail.sources.tables import load

DAY_SQL = f"o_orderdate >= TIMESTAMP '{RUN_DATE}' AND o_orderdate < TIMESTAMP '{RUN_DATE}' + INTERVAL 1 DAY"


def orders_by_day(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(16,2)").alias("amount"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"))


ORDERS_BY_DAY_SQL = """SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS status,
                              CAST(o_totalprice AS DECIMAL(16,2)) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS dt
                       FROM orders"""


@query("write_static_partition", f"SELECT * FROM ({ORDERS_BY_DAY_SQL}) x WHERE dt = '{RUN_DATE}'")
def write_static_partition(spark, sf_dir):
    """``insert overwrite ... partition (dt=D)`` twice: the second write replaces
    the first, nothing doubles; the read prunes to that one folder."""
    path = scratch_dir(spark, "static")
    day = orders_by_day(spark, sf_dir).where(F.col("dt") == RUN_DATE)
    io.write_partitions(day, path)
    io.write_partitions(day, path)
    return io.read_table(spark, path, schema=day.schema).where(F.col("dt") == RUN_DATE) \
        .select("order_id", "user_id", "status", "amount", "dt")


@query("write_dynamic_partition", f"SELECT dt, count(*) AS n, sum(amount) AS amount FROM ({ORDERS_BY_DAY_SQL}) x GROUP BY dt")
def write_dynamic_partition(spark, sf_dir):
    """All days written with ``dt`` computed per row, then the last 30 days
    re-written: dynamic overwrite replaces only those partitions."""
    path = scratch_dir(spark, "dynamic")
    all_days = orders_by_day(spark, sf_dir)
    io.write_partitions(all_days, path)
    recent = all_days.where(F.col("dt") > F.date_format(F.date_sub(F.lit(RUN_DATE).cast("date"), 30), "yyyy-MM-dd"))
    io.write_partitions(recent, path)
    t = io.read_table(spark, path)
    return t.groupBy("dt").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@query("io_round_trip", f"""
    SELECT 'orc' AS fmt, order_id, user_id, status, amount, dt FROM ({ORDERS_BY_DAY_SQL}) a
    UNION ALL SELECT 'text', order_id, user_id, status, amount, dt FROM ({ORDERS_BY_DAY_SQL}) b""")
def io_round_trip(spark, sf_dir):
    """ORC (snappy) and tab-delimited text round trips, read back with an
    explicit schema (no inference)."""
    base = scratch_dir(spark, "roundtrip")
    df = orders_by_day(spark, sf_dir)
    schema = "order_id long, user_id long, status string, amount decimal(16,2), dt string"
    df.write.mode("overwrite").option("compression", "snappy").orc(os.path.join(base, "orc"))
    df.write.mode("overwrite").option("sep", "\t").csv(os.path.join(base, "text"))
    orc = spark.read.orc(os.path.join(base, "orc")).select(F.lit("orc").alias("fmt"), *df.columns)
    txt = spark.read.schema(schema).option("sep", "\t").csv(os.path.join(base, "text")) \
        .select(F.lit("text").alias("fmt"), *df.columns)
    return orc.unionByName(txt)


@query("load_if_absent", f"""
    SELECT 'first' AS step, 'loaded' AS status, (SELECT count(*) FROM orders WHERE {DAY_SQL}) AS n
    UNION ALL SELECT 'second', CASE WHEN (SELECT count(*) FROM orders WHERE {DAY_SQL}) > 0 THEN 'skipped'
                                    ELSE 'loaded' END, (SELECT count(*) FROM orders WHERE {DAY_SQL})""")
def load_if_absent(spark, sf_dir):
    """Guarded daily load run twice: loaded, then skipped; the partition holds
    the day once. (A day without rows writes no partition, so its re-run
    loads again -- the probe finds nothing, as in the reference.)"""
    path = scratch_dir(spark, "guarded")

    def build():
        return orders_by_day(spark, sf_dir).where(F.col("dt") == RUN_DATE)
    s1 = io.load_if_absent(spark, path, RUN_DATE, build)
    s2 = io.load_if_absent(spark, path, RUN_DATE, build)
    n = io.count_partition(spark, path, RUN_DATE)
    return spark.createDataFrame([("first", s1, n), ("second", s2, n)], "step string, status string, n long")


@query("list_partitions", f"SELECT DISTINCT dt FROM ({ORDERS_BY_DAY_SQL}) x")
def list_partitions(spark, sf_dir):
    path = scratch_dir(spark, "listing")
    io.write_partitions(orders_by_day(spark, sf_dir), path)
    return io.list_partitions(spark, path)


NEW_DT = "2099-01-01"


@query("copy_partition_redate", f"SELECT order_id, user_id, status, amount, '{NEW_DT}' AS dt FROM ({ORDERS_BY_DAY_SQL}) x")
def copy_partition_redate(spark, sf_dir):
    """Every day of a table copied into one new day (source excludes the target day)."""
    base = scratch_dir(spark, "redate")
    src, dst = os.path.join(base, "orders"), os.path.join(base, "orders_copy")
    io.write_partitions(orders_by_day(spark, sf_dir), src)
    io.copy_redate(spark, src, dst, NEW_DT)
    return io.read_table(spark, dst).where(F.col("dt") == NEW_DT).select("order_id", "user_id", "status", "amount", "dt")


@query("copy_reconcile", f"""
    SELECT 'orders' AS "table", (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders) AS target_rows,
           'success' AS status
    UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer), 'success'
    UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), NULL, 'skipped'
    UNION ALL SELECT 'missing_table', NULL, NULL, 'failed'""")
def copy_reconcile(spark, sf_dir):
    """Re-date copies of several tables with a status each: success when
    counts agree, mismatch when not, skipped when the target day already
    exists, failed when the source cannot be read."""
    base = scratch_dir(spark, "reconcile")
    rows = []
    for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"),
                      ("missing_table", None)):
        src, dst = os.path.join(base, name), os.path.join(base, name + "_copy")
        try:
            t = load(spark, sf_dir, name).withColumn("dt", F.lit("2000-01-01"))
        except (KeyError, AnalysisException):  # no such table, or no such path
            rows.append((name, None, None, "failed"))
            continue
        io.write_partitions(t, src)
        if name == "supplier":   # target day present before the copy
            io.write_partitions(t.withColumn("dt", F.lit(NEW_DT)), dst)
        if io.partition_exists(spark, dst, NEW_DT):
            rows.append((name, spark.read.parquet(src).count(), None, "skipped"))
            continue
        r = io.copy_redate(spark, src, dst, NEW_DT).collect()[0]
        rows.append((name, r.source_rows, r.target_rows, r.status))
    return spark.createDataFrame(rows, "table string, source_rows long, target_rows long, status string")


PREV = "1998-08-01"


@query("report_merge", with_model(f"""
    SELECT dt, recent_days, order_count, order_amount FROM (
        {windows_sql(R_.ORDER_CARGO_1D_SQL, '', 'sum(order_count) AS order_count, sum(order_amount) AS order_amount')}
    ) cur
    UNION ALL
    SELECT '{PREV}' AS dt, w.recent_days, sum(order_count), sum(order_amount)
    FROM ({R_.ORDER_CARGO_1D_SQL}) one, (VALUES (1), (7), (30)) AS w(recent_days)
    WHERE CAST(one.dt AS DATE) > DATE '{PREV}' - w.recent_days AND CAST(one.dt AS DATE) <= DATE '{PREV}'
    GROUP BY w.recent_days""", "dic", "order_info", "order_cargo", "areas", "organ", "region_info"))
def report_merge(spark, sf_dir):
    """Report upsert: yesterday's stored report plus a stale version of today's
    rows; today's recomputation replaces rows by (dt, recent_days) and the
    result is staged to a new version folder and swapped in."""
    from dovetail.operators.aggregates import recent_days
    table = scratch_dir(spark, "ads_order_stats")
    one_prev = R_.order_cargo_1d(spark, sf_dir, days=("1998-07-02", PREV))
    prev = recent_days(one_prev, [], {"order_count": F.sum("order_count"), "order_amount": F.sum("order_amount")},
                       PREV, windows=(1, 7, 30)).withColumn("dt", F.lit(PREV))
    new = report_orders(spark, sf_dir)
    stale = new.withColumn("order_count", F.col("order_count") - 1)
    io.stage_and_swap(spark, prev.unionByName(stale), table)
    stored = spark.read.parquet(io.current_version(spark, table))
    io.stage_and_swap(spark, io.merge_report(stored, new, ["dt", "recent_days"]), table)
    return spark.read.parquet(io.current_version(spark, table)).select("dt", "recent_days", "order_count", "order_amount")
